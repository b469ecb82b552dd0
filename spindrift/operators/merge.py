"""Merging the entries of a block into one tool, field by field.

Each rule is a grouped aggregate over (block, ord, ...); ord decides what comes
first. Rules that keep one item for each key group the exploded items by
(block, key) and gather them again, so that partial aggregation works.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_value(value: Column, order: Column) -> Column:
    """The first value that is neither null nor empty."""
    some = value.isNotNull() & (value.cast("string") != "")
    return F.min_by(value, F.when(some, order))


def set_union(array: Column) -> Column:
    """Sorted distinct elements of all arrays."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(array))))


def names(name: Column, order: Column) -> list[Column]:
    """name of the first entry, and other_names."""
    first = F.min_by(name, order)
    return [first.alias("name"), F.array_sort(F.array_except(F.collect_set(name), F.array(first))).alias("other_names")]


def one_per_key(rows: DataFrame, block: str, order: str, array: str, keys: list[str], values: dict[str, str], out: str) -> DataFrame:
    """(block, out): items of a struct array, one for each key, in the order they are first seen.

    values maps the other fields to a rule: 'first' (first that says something),
    'any' (true if any is), 'longest' (longest text, the first of several).
    """
    x = rows.select(F.col(block).alias("_b"), F.col(order).alias("_o"), F.posexplode(array).alias("_p", "_x"))
    place = F.struct("_o", "_p")
    rules = {
        "first": lambda c: first_value(c, place),
        "any": lambda c: F.coalesce(F.bool_or(c), F.lit(False)),
        "longest": lambda c: F.max_by(c, F.struct(F.coalesce(F.length(c), F.lit(-1)), -F.col("_o"), -F.col("_p"))),
    }
    kept = x.groupBy("_b", *(F.col(f"_x.{k}").alias(k) for k in keys)).agg(F.min(place).alias("_first"), *(rules[r](F.col(f"_x.{c}")).alias(c) for c, r in values.items()))
    items = F.array_sort(F.collect_list(F.struct("_first", F.struct(*keys, *values).alias("_v"))))
    return kept.groupBy(F.col("_b").alias(block)).agg(F.transform(items, lambda v: v["_v"]).alias(out))


def repositories(rows: DataFrame, block: str, order: str, array: str = "repository") -> DataFrame:
    """One repository for each address, as first seen."""
    return one_per_key(rows, block, order, array, ["url"], {"kind": "first"}, array)


def formats(rows: DataFrame, block: str, order: str, array: str) -> DataFrame:
    """One input or output for each vocabulary and term; the first address and datatype that are given."""
    return one_per_key(rows, block, order, array, ["vocabulary", "term"], {"uri": "first", "datatype": "first"}, array)


def documentation(rows: DataFrame, block: str, order: str, array: str = "documentation") -> DataFrame:
    """One item for each type and address, with its longest content."""
    return one_per_key(rows, block, order, array, ["type", "url"], {"content": "longest"}, array)


def licences(rows: DataFrame, block: str, order: str, array: str = "license") -> DataFrame:
    """One licence for each name, with the first address that is given."""
    return one_per_key(rows, block, order, array, ["name"], {"url": "first"}, array)


def authors(rows: DataFrame, block: str, order: str, array: str = "authors") -> DataFrame:
    """One author for each name: the first of every detail, a maintainer if ever one."""
    return one_per_key(rows, block, order, array, ["name"], {"type": "first", "email": "first", "maintainer": "any", "url": "first", "orcid": "first"}, array)


def vocabulary_items(rows: DataFrame, block: str, order: str, array: str) -> DataFrame:
    """One topic or operation for each address and term."""
    return one_per_key(rows, block, order, array, ["uri", "term"], {"vocabulary": "first"}, array)


def citations(rows: DataFrame, block: str, order: str, array: str = "citation", keys: tuple[str, ...] = ("title", "year", "DOI")) -> DataFrame:
    """Citations (maps), one for each key with the first value of each field; those whose filled fields another has too are left out."""
    x = rows.select(F.col(block).alias("_b"), F.col(order).alias("_o"), F.posexplode(array).alias("_p", "_m"))
    x = x.select("_b", "_o", "_p", *(F.try_element_at("_m", F.lit(k)).alias(f"_k{i}") for i, k in enumerate(keys)), F.explode("_m").alias("f", "v")).where("v IS NOT NULL AND v <> ''")
    ks = [f"_k{i}" for i in range(len(keys))]
    field = x.groupBy("_b", *ks, "f").agg(F.min_by("v", F.struct("_o", "_p")).alias("v"), F.min(F.struct("_o", "_p")).alias("at"))
    whole = field.groupBy("_b", *ks).agg(F.min("at").alias("at"), F.array_sort(F.collect_list(F.struct("f", "v"))).alias("m"))
    all_ = whole.groupBy("_b").agg(F.array_sort(F.collect_list(F.struct("at", "m"))).alias("c"))
    inside = lambda a, b: (F.size(a["m"]) < F.size(b["m"])) & (F.size(F.array_except(a["m"], b["m"])) == 0)
    kept = F.filter("c", lambda a: ~F.exists("c", lambda b: inside(a, b)))
    return all_.select(F.col("_b").alias(block), F.transform(kept, lambda a: F.map_from_entries(a["m"])).alias(array))


#: Fields of one rule. Fixed values.
UNION_FIELDS = ["type", "version", "label", "links", "webpage", "download", "operating_system", "source_code", "source", "edam_topics", "edam_operations", "description", "dependencies", "tags", "publication", "languages"]
OR_FIELDS = ["https", "ssl", "operational", "bioschemas", "test", "inst_instr", "contribution_policy", "termsUse"]


def merge_entries(rows: DataFrame, block: str = "block", order: str = "ord", id_col: str = "entry") -> DataFrame:
    """One merged row for each block; fields that rows lack are left out. `type` may be a string or an array."""
    if "type" in rows.columns and dict(rows.dtypes)["type"] == "string":
        rows = rows.withColumn("type", F.filter(F.array("type"), lambda x: x.isNotNull()))
    o = F.col(order)
    plain = [F.transform(F.array_sort(F.collect_list(F.struct(o, F.col(id_col)))), lambda x: x[id_col]).alias("entries")]
    if "name" in rows.columns:
        plain += names(F.col("name"), o)
    plain += [set_union(F.col(c)).alias(c) for c in UNION_FIELDS if c in rows.columns]
    plain += [F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in OR_FIELDS if c in rows.columns]
    parts = [rows.groupBy(block).agg(*plain)]
    special = {"repository": repositories, "documentation": documentation, "license": licences, "authors": authors, "citation": citations}
    parts += [f(rows, block, order) for c, f in special.items() if c in rows.columns]
    parts += [formats(rows, block, order, c) for c in ("input", "output") if c in rows.columns]
    parts += [vocabulary_items(rows, block, order, c) for c in ("topics", "operations") if c in rows.columns]
    return reduce(lambda a, b: a.join(b, block, "left"), parts)


def tools_of(records: DataFrame) -> DataFrame:
    """(tool, entry, ord): which entries make a tool by the records: the merged ones, and a single unmerged one of a partial record."""
    done = records.where(F.col("resolution").isin("no_conflict", "merged", "partial"))
    one = done.where(F.size("merged") > 0).select(F.col("block").alias("tool"), F.posexplode("merged").alias("ord", "entry"))
    apart = done.where((F.col("resolution") == "partial") & (F.size("unmerged") == 1)).select(F.concat("block", F.lit("#unmerged")).alias("tool"), F.lit(0).alias("ord"), F.get("unmerged", F.lit(0)).alias("entry"))
    return one.unionByName(apart)


def as_stored(tools: DataFrame, stamp: Column | None = None, block: str = "block", entries: str = "entries") -> DataFrame:
    """(tool_id, source, timestamp, data): merged tools as they are kept; data holds all merged fields."""
    fields = [c for c in tools.columns if c not in (block, entries)]
    return tools.select(F.col(block).alias("tool_id"), F.col(entries).alias("source"), (stamp if stamp is not None else F.current_timestamp()).alias("timestamp"), F.struct(*fields).alias("data"))
