"""Publications: extraction from raw documents, a common schema, and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.functions.bibtex import bibtex_entries

from .components import components

#: Identifying fields in the order in which they are tried. Fixed values.
KEYS = ["doi", "title", "url", "pmid", "pmcid"]


def clean_doi(doi: Column) -> Column:
    """Without the resolver's address."""
    return F.regexp_replace(doi, r"^https://doi\.org/", "")


def valid_publication(rows: DataFrame) -> DataFrame:
    """Fields that break their pattern become null: doi 10.NNNN/..., pmid digits, pmcid PMC digits."""
    keep = lambda c, p: F.when(F.col(c).rlike(p), F.col(c))
    return rows.withColumn("doi", clean_doi(F.col("doi"))).withColumns({"doi": keep("doi", r"^10\.\d{4,9}/\S+$"), "pmid": keep("pmid", r"^\d+$"), "pmcid": keep("pmcid", r"^PMC\d+$")})


def _json(path: str) -> Column:
    return F.get_json_object("data", path)


_ONE = "array<struct<doi: string, pmid: string, pmcid: string, title: string, url: string, year: string, journal: string, abstract: string>>"


def _standard(rows: DataFrame, item: Column, year: str = "year") -> DataFrame:
    x = rows.select("_id", F.explode(item).alias("x"))
    get = lambda c: F.col(f"x.{c}")
    out = x.select("_id", *(get(c).alias(c) for c in ("doi", "pmid", "pmcid", "title", "url")), get(year).cast("int").alias("year"), get("journal").alias("journal"), get("abstract").alias("abstract"))
    return valid_publication(out)


def _biotools(rows):
    return _standard(rows, F.from_json(_json("$.publications"), _ONE))


def _bioconductor(rows):
    return _standard(rows, F.from_json(_json("$.publication"), _ONE.replace("year: string", "published_year: string")), "published_year")


def _metrics(rows):
    entries = F.from_json(_json("$.project.publications"), f"array<struct<entries: {_ONE}>>")
    return _standard(rows, F.flatten(F.transform(entries, lambda p: p["entries"])))


def _recipes(rows):
    ids = F.coalesce(F.from_json(_json("$.extra.identifiers"), "array<string>"), F.array().cast("array<string>"))
    found = F.filter(F.transform(ids, lambda s: F.regexp_extract(s, r"^(?:https://doi\.org/|doi:)(\S+)", 1)), lambda s: s != "")
    more = F.filter(F.coalesce(F.from_json(_json("$.extra.doi"), "array<string>"), F.array().cast("array<string>")), lambda s: s.isNotNull() & (s != "NA"))
    none = F.lit(None).cast("string")
    dois = F.transform(F.array_distinct(F.transform(F.concat(found, more), clean_doi)), lambda d: F.struct(d.alias("doi"), *(none.alias(c) for c in ("pmid", "pmcid", "title", "url", "year", "journal", "abstract"))))
    return _standard(rows, dois)


def _toolshed(rows):
    c = rows.select("_id", F.explode(F.from_json(_json("$.citation"), "array<struct<type: string, value: string>>")).alias("c"))
    none = F.lit(None).cast("string")
    plain = c.where("c.type = 'doi'").select("_id", F.array(F.struct(F.col("c.value").alias("doi"), *(none.alias(k) for k in ("pmid", "pmcid", "title", "url", "year", "journal", "abstract")))).alias("items"))
    entries = c.where("c.type = 'bibtex'").select("_id", F.filter(bibtex_entries("c.value"), lambda e: e["type"] != "misc").alias("e"))
    get = lambda e, k: F.try_element_at(e["fields"], F.lit(k)).alias(k)
    parsed = entries.select("_id", F.transform("e", lambda e: F.struct(*(get(e, k) for k in ("doi", "pmid", "pmcid", "title", "url", "year", "journal", "abstract")))).alias("items"))
    return _standard(plain.unionByName(parsed), F.col("items"))


#: Extractors by source.
EXTRACTORS = {"bioconda_recipes": _recipes, "bioconductor": _bioconductor, "biotools": _biotools, "opeb_metrics": _metrics, "toolshed": _toolshed}


def extract(raw: DataFrame, source: str) -> DataFrame:
    """Publications (_id of the document and the common fields) of one source; raw has _id, data_source, data (JSON)."""
    if source not in EXTRACTORS:
        raise ValueError(f"no publications are known for source {source!r}")
    return EXTRACTORS[source](raw.where(F.col("data_source") == source))


def deduplicate(rows: DataFrame, id_col: str, keys: list[str] = KEYS) -> DataFrame:
    """(id, publication): rows that share a value of any key, directly or through others, are one publication, named by its least id. This is the closure of looking the keys up one after another. Values are compared by 128-bit hashes, so long ones, as titles may be, are not shuffled."""
    here = F.concat(F.lit("p:"), F.lpad(F.col(id_col).cast("string"), 20, "0"))
    edges = [rows.select(here.alias("a"), F.concat(F.lit(f"~{k}:"), F.md5(F.col(k).cast("string"))).alias("b")).where(F.col(k).isNotNull() & (F.col(k).cast("string") != "")) for k in keys]
    both = edges[0]
    for e in edges[1:]:
        both = both.union(e)
    found = components(both, "a", "b").where("vertex LIKE 'p:%'").withColumnRenamed("vertex", "_v")
    names = rows.select(F.col(id_col).alias("id"), here.alias("_v")).join(found, "_v", "left").select("id", F.coalesce("component", "_v").alias("_c"))
    first = names.groupBy("_c").agg(F.min("id").alias("publication"))
    return names.join(first, "_c").select("id", "publication")


def look_up(rows: DataFrame, known: DataFrame, id_col: str, known_id: str, keys: list[str] = KEYS) -> DataFrame:
    """rows with the id of the known publication that the first matching key, in their order, names."""
    for i, k in enumerate(keys):
        one = known.where(F.col(k).isNotNull()).groupBy(F.col(k).alias(f"_key{i}")).agg(F.min(known_id).alias(f"_hit{i}"))
        rows = rows.join(one, F.col(k) == F.col(f"_key{i}"), "left").drop(f"_key{i}")
    hit = F.coalesce(*(F.col(f"_hit{i}") for i in range(len(keys)))).alias("known_id")
    return rows.select(*(c for c in rows.columns if not c.startswith("_hit")), hit)
