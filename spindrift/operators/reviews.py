"""What annotators and reviewers get to see: details of pairs, messages within a token budget, texts of issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.functions.text import tokens, within_budget

#: Fields of an entry that a comparison shows. Fixed values.
SHOWN = ["name", "description", "repository", "webpage", "source", "license", "authors", "publication", "documentation"]

#: Tokens of one part, and of a whole conversation. Fixed values.
PART_TOKENS, ALL_TOKENS = 8_000, 130_000


def pair_details(pairs: DataFrame, entries: DataFrame, id_col: str = "id") -> DataFrame:
    """(block, pair_no, entry, anchors, disconnected, remaining): pairs with the shown fields of both sides, as a struct and as an array in the order of the anchors."""
    shown = [c for c in SHOWN if c in entries.columns]
    one = entries.select(F.col(id_col).alias("_id"), F.struct(F.col(id_col).alias("id"), *shown).alias("_x"))
    left = pairs.join(one, pairs["entry"] == one["_id"], "left").select(*pairs.columns, F.col("_x").alias("disconnected"))
    anchors = pairs.select("block", "pair_no", F.posexplode("anchors").alias("_p", "_a")).join(one, F.col("_a") == F.col("_id"), "left")
    right = anchors.groupBy("block", "pair_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_x"))), lambda s: s["_x"]).alias("remaining"))
    return left.join(right, ["block", "pair_no"], "left")


def with_publications(entries: DataFrame, id_col: str, ids_col: str, cited: DataFrame, cited_id: str) -> DataFrame:
    """entries with their publications in place of the ids, without citations and abstract, in the order of the ids."""
    kept = cited.drop("citations", "abstract")
    x = entries.select(F.col(id_col).alias("_e"), F.posexplode(ids_col).alias("_p", "_i")).join(kept.select(F.col(cited_id).alias("_i"), F.struct(*kept.columns).alias("_x")), "_i")
    g = x.groupBy("_e").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_x"))), lambda s: s["_x"]).alias("_new"))
    return entries.join(g, F.col(id_col) == F.col("_e"), "left").drop("_e", ids_col).withColumnRenamed("_new", ids_col)


def parts(items: Column, most: int = PART_TOKENS) -> Column:
    """Texts in order, gathered into parts of up to `most` tokens; a longer text is a part of its own."""
    start = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).cast("long").alias("n"))

    def add(s, item):
        fits = (F.size(s["open"]) == 0) | (s["n"] + tokens(item) <= most)
        return F.struct(
            F.when(fits, s["done"]).otherwise(F.array_append(s["done"], s["open"])).alias("done"),
            F.when(fits, F.array_append(s["open"], item)).otherwise(F.array(item)).alias("open"),
            F.when(fits, s["n"] + tokens(item)).otherwise(tokens(item)).alias("n"),
        )

    return F.aggregate(items, start, add, lambda s: F.when(F.size(s["open"]) > 0, F.array_append(s["done"], s["open"])).otherwise(s["done"]))


def conversations(details: DataFrame, instruction: str, closing: str, content: DataFrame | None = None) -> DataFrame:
    """(block, pair_no, messages, fits): the conversation that compares a pair: instruction, entries in parts, fetched content (url, label, body), closing; fits tells whether it stays in the budget."""
    role = lambda text: F.struct(F.lit("user").alias("role"), text.alias("content"))
    said = lambda head, items: F.transform(parts(items), lambda p, i: role(F.concat(F.lit(f"{head} - part "), (i + 1).cast("string"), F.lit(":\n```json\n["), F.array_join(p, ",\n"), F.lit("]\n```"))))
    known = said("Entries that are one software", F.transform("remaining", lambda e: F.to_json(e)))
    open_ = said("Entry in question", F.array(F.to_json("disconnected")))
    rows = details
    fetched = F.array().cast("array<struct<role: string, content: string>>")
    if content is not None:
        urls = F.flatten(F.array(*(F.coalesce(F.transform(f"disconnected.{c}", lambda u: u["url"] if c == "repository" else u), F.array().cast("array<string>")) for c in ("repository", "webpage"))))
        x = details.select("block", "pair_no", F.explode(F.array_distinct(urls)).alias("url")).join(content, "url")
        body = role(F.concat(F.lit("Content from "), "url", F.lit(":\n```\n"), "label", F.lit(":\n"), "body", F.lit("```")))
        rows = rows.join(x.groupBy("block", "pair_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("url", "label", body.alias("m")))), lambda s: s["m"]).alias("_fetched")), ["block", "pair_no"], "left")
        fetched = F.coalesce("_fetched", fetched)
    messages = F.concat(F.array(role(F.lit(instruction))), known, open_, fetched, F.array(role(F.lit(closing))))
    rows = rows.select("block", "pair_no", messages.alias("messages"))
    return rows.withColumn("fits", within_budget(F.transform("messages", lambda m: m["content"]), ALL_TOKENS))


def _list(items: Column, line, nothing: str) -> Column:
    lines = F.filter(F.transform(items, line), lambda x: x.isNotNull())
    return F.when(F.coalesce(F.size(lines), F.lit(0)) > 0, F.concat(F.lit("\n\t- "), F.array_join(lines, "\n\t- "))).otherwise(F.lit(nothing))


def _said(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def _link(text: Column, url: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit("]("), url, F.lit(")"))


def website_lines(pages: Column) -> Column:
    return _list(pages, lambda p: _link(_said(p), _said(p)), "No website available.")


def licence_lines(licences: Column) -> Column:
    """Names with their addresses; one that has neither is left out."""
    line = lambda x: F.coalesce(_link(_said(x["name"]), _said(x["url"])), _said(x["name"]), _link(F.lit("License link"), _said(x["url"])))
    return _list(licences, line, "No license information.")


def author_lines(authors: Column) -> Column:
    line = lambda a: F.concat_ws(" ", _said(a["name"]), F.when(_said(a["email"]).isNotNull(), F.concat(F.lit("<"), a["email"], F.lit(">"))), F.when(a["maintainer"], F.lit("(maintainer)")))
    return _list(authors, lambda a: F.nullif(line(a), F.lit("")), "No authors listed.")


def publication_lines(publications: Column) -> Column:
    def line(p):
        title = F.concat(F.lit("**"), _said(p["title"]), F.lit("**"), F.coalesce(F.concat(F.lit(" ("), p["year"].cast("string"), F.lit(")")), F.lit("")))
        at = F.coalesce(_said(p["url"]), F.concat(F.lit("https://doi.org/"), _said(p["doi"])))
        ids = F.concat_ws(", ", *(F.concat(F.lit(f"{k.upper()}: "), _said(p[k])) for k in ("doi", "pmid", "pmcid")))
        return F.concat_ws(" – ", title, _link(F.lit("Link"), at), F.nullif(ids, F.lit("")))

    return _list(publications, line, "No publications listed.")


def issue_texts(conflicts: DataFrame, entries: DataFrame, id_col: str = "id") -> DataFrame:
    """(block, body): Markdown that shows a reviewer the entries of a block by their role."""
    shown = entries.select(
        F.col(id_col).alias("entry"),
        F.concat(
            F.lit("### "), F.col(id_col).cast("string"), F.lit("\n- name: "), F.coalesce("name", F.lit("-")), F.lit("\n- description: "), F.coalesce(F.nullif(F.array_join("description", " "), F.lit("")), F.lit("No description available.")),
            F.lit("\n- website: "), website_lines(F.col("webpage")), F.lit("\n- repository: "), website_lines(F.transform("repository", lambda r: r["url"])), F.lit("\n- license: "), licence_lines(F.col("license")),
            F.lit("\n- authors: "), author_lines(F.col("authors")),
        ).alias("text"),
    )
    x = conflicts.join(shown, "entry").groupBy("block", "role").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "entry", "text"))), lambda s: s["text"]), "\n\n").alias("t"))
    by = x.groupBy("block").agg(F.max(F.when(F.col("role") == "disconnected", F.col("t"))).alias("d"), F.max(F.when(F.col("role") == "remaining", F.col("t"))).alias("r"))
    body = F.concat(F.lit("## Disconnected\n\n"), F.coalesce("d", F.lit("none")), F.lit("\n\n## Remaining\n\n"), F.coalesce("r", F.lit("none")))
    return by.select("block", body.alias("body"))
