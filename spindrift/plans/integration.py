"""The three jobs end to end: transform raw documents, integrate entries, compute statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.functions.text import contributor_type
from spindrift.functions.urls import is_code_host, normalize_url
from spindrift.operators import merge, publications, resolve, statistics
from spindrift.sources.documents import upsert_provenance
from spindrift.sources.standardize import quarantine, standardize
from spindrift.storage import materialise

#: Tags whose tools have statistics of their own. Fixed values.
COLLECTIONS = ["RIS3CAT VEIS", "ELIXIR-ES", "PerMedCoE", "IMPaCT-Data", "Proteomics"]


def transform(raw: DataFrame, sources: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, publications, rejected) of raw documents; an entry names its publications by id. Of entries with one id the last by _id counts."""
    entries = standardize(raw, sources)
    found = [publications.extract(raw, s) for s in (sources or list(publications.EXTRACTORS)) if s in publications.EXTRACTORS]
    cited = found[0]
    for f in found[1:]:
        cited = cited.unionByName(f)
    cited = materialise(cited.withColumn("pub_no", F.xxhash64("_id", *publications.KEYS)))
    same = materialise(publications.deduplicate(cited.dropDuplicates(["pub_no"]), "pub_no"))
    named = cited.join(same, cited["pub_no"] == same["id"]).drop("id")
    order = F.struct("_id", "pub_no")
    merged = named.groupBy(F.col("publication").cast("string").alias("pub_id")).agg(*(merge.first_value(F.col(c), order).alias(c) for c in ("doi", "pmid", "pmcid", "title", "url", "year", "journal", "abstract")))
    ids = named.groupBy("_id").agg(F.array_sort(F.collect_set(F.col("publication").cast("string"))).alias("publication"))
    entries = entries.join(ids, "_id", "left").withColumn("publication", F.coalesce("publication", F.array().cast("array<string>")))
    columns = [c for c in entries.columns if c != "id"]
    last = entries.groupBy("id").agg(F.max_by(F.struct(*columns), "_id").alias("x")).select("id", "x.*")
    return last, merged, quarantine(raw, sources)


def save(old: DataFrame, new: DataFrame, by: Column, log: Column, stamp: Column | None = None) -> DataFrame:
    """The table with new entries written over those of the same id; a given stamp makes runs repeatable."""
    stamp = stamp if stamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return upsert_provenance(old, new, "id", stamp, by, log)


def entry_links(entries: DataFrame) -> DataFrame:
    """(entry, link): normalised repository and web addresses of each entry."""
    both = F.concat(F.transform("repository", lambda r: r["url"]), "webpage")
    return entries.select(F.col("id").alias("entry"), F.explode(F.array_distinct(F.transform(both, normalize_url))).alias("link")).where("link IS NOT NULL")


def integrate(entries: DataFrame, provider: Callable[[DataFrame], DataFrame], decisions: DataFrame | None = None, solved: DataFrame | None = None, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, tools): entries grouped by name and type or by code-host links, blocks recovered, conflicts judged, and merged.

    provider gives verdicts for pairs; decisions (block, decision, confidence)
    override what awaits review; solved (block) is not judged again. stored holds
    records of an earlier run: their blocks are not judged again either, and the
    records returned and merged are theirs and the new ones.
    """
    if stored is not None:
        known = stored.select("block")
        solved = known if solved is None else known.union(solved.select("block"))
    entries = entries.withColumn("ord", F.col("id"))
    links = materialise(entry_links(entries))
    hosts = links.where(is_code_host(F.col("link")))
    members = resolve.group_entities(entries, "id", "ord", resolve.block_key(F.col("name"), F.col("type")), hosts, "entry", "link")
    members = materialise(members.select("block", "entry"))
    by_block = members.join(links, "entry").select("block", "entry", "link")
    members = materialise(resolve.recover_blocks(members, by_block.select("block", "link")))
    rows = members.join(entries.select(F.col("id").alias("entry"), "name", "source"), "entry").withColumn("ord", F.col("entry"))
    conflicts = resolve.detect_conflicts(rows, members.join(links, "entry").select("block", "entry", "link"))
    conflicts = materialise(resolve.merge_by_source_name(conflicts.join(rows.select("block", "entry", "source"), ["block", "entry"])))
    records = materialise(resolve.resolve(rows.select("block", "entry", "ord"), conflicts, provider, solved))
    if stored is not None:
        records = materialise(stored.select(*records.columns).unionByName(records))
    if decisions is not None:
        pending = records.where("resolution = 'manual_review_pending'").select("block")
        human = resolve.human_records(decisions.join(pending, "block", "left_semi"), conflicts)
        human = human.withColumns({"confidence": F.create_map(F.lit("human"), F.col("confidence").cast("string")), "notes": resolve.caution(F.col("merged"))})
        records = materialise(records.join(human.select("block"), "block", "left_anti").unionByName(human.select(*records.columns)))
    return records, merged(entries, records)


def merged(entries: DataFrame, records: DataFrame) -> DataFrame:
    """The tools that records make of entries."""
    parts = merge.tools_of(records).join(entries.drop("ord").withColumnRenamed("id", "entry"), "entry")
    return merge.merge_entries(parts.withColumnRenamed("tool", "block"), "block", "ord", "entry")


def tool_statistics(tools: DataFrame, tags: list[str] | None = None) -> dict[str, DataFrame]:
    """Results by name over merged tools, by collection where it has one."""
    by = materialise(statistics.collections(tools, "tags", tags or COLLECTIONS))
    features = [f for f in statistics.OVERVIEW if f in tools.columns]
    complete = [f for f in statistics.COMPLETE if f in tools.columns]
    names = tools.withColumn("_names", F.transform("license", lambda x: x["name"]))
    verdicts = statistics.licence_verdicts(names, "block", "_names", F.array_contains("source", "opeb_metrics"))
    links = tools.withColumn("_links", F.concat(F.transform("repository", lambda r: r["url"]), "links"))
    covered = {k: v for k, v in statistics.SOURCE_LABELS.items() if v not in statistics.NOT_COVERED}
    return {
        "tools_count": statistics.count_rows(by, ["collection"]),
        "tools_counts_per_source": statistics.tools_per_source(tools, "source"),
        "coverage_sources": statistics.coverage(tools.withColumn("_n", F.size(statistics.mapped_labels(F.col("source"), covered))), "_n"),
        "coverage_matrix": statistics.coverage_matrix(tools, "source"),
        "features_overview": statistics.feature_presence(by, features, ["collection"]),
        "features_cummulative": statistics.feature_counts(tools, complete),
        "types_count": statistics.value_share(tools, F.explode("type")),
        "licenses_summary_sunburst": statistics.licence_summary(verdicts),
        "licenses_open_source": statistics.open_source_licences(verdicts),
        "semantic_versioning": statistics.value_share(tools, statistics.version_scheme(F.col("version")), ()),
        "version_control": statistics.host_counts(links, "block", "_links"),
    }


def scorer_input(tools: DataFrame, cited: DataFrame) -> DataFrame:
    """Tools as an external scorer takes them: first type and version with the others beside, authors with a type, repository addresses, publications without citations or abstract."""
    pubs = tools.select("block", F.explode("publication").alias("pub_id")).join(cited.drop("abstract", "citations"), "pub_id").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pub_id", "doi", "pmid", "pmcid", "title", "url", "year", "journal"))).alias("publications"))
    return tools.join(pubs, "block", "left").select(
        "block", "name", F.get("type", F.lit(0)).alias("type"), F.slice("type", F.lit(2), F.greatest(F.size("type") - 1, F.lit(0))).alias("other_types"), F.get("version", F.lit(0)).alias("version"),
        F.slice("version", F.lit(2), F.greatest(F.size("version") - 1, F.lit(0))).alias("other_versions"), F.transform("repository", lambda r: r["url"]).alias("repository"), "publications",
        F.transform("authors", lambda a: a.withField("type", F.coalesce(contributor_type(a["type"], a["orcid"]), F.lit("Person")))).alias("authors"),
    )
