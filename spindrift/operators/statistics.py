"""Statistics over merged tools and publications.

Every function takes the columns it needs and groups by `by` (such as the
collection), so that one scan serves all collections. Shares are raw ratios;
rounding is for presentation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.functions.licensing import LICENCE_GROUPS, LICENCE_HIERARCHY, licence_class
from spindrift.functions.meaningful import completeness, is_meaningful
from spindrift.functions.urls import repository_kind
from spindrift.storage import materialise

#: Source and the label that it counts for. Fixed values.
SOURCE_LABELS = {
    "bioconda": "bioconda",
    "bioconda_recipes": "bioconda",
    "bioconda_conda": "bioconda",
    "galaxy_metadata": "toolshed",
    "toolshed": "toolshed",
    "github": "github",
    "biotools": "biotools",
    "bioconductor": "bioconductor",
    "sourceforge": "sourceforge",
    "bitbucket": "bitbucket",
    "opeb_metrics": "opeb_metrics",
    "galaxy": "galaxy",
}
#: Labels that coverage leaves out. Fixed values.
NOT_COVERED = ("bitbucket", "opeb_metrics")

#: Features of the overview, and of completeness. Fixed values.
OVERVIEW = ["name", "description", "version", "type", "publication", "download", "webpage", "source_code", "operating_system", "input", "output", "dependencies", "test", "documentation", "license", "authors", "repository", "topics"]
COMPLETE = ["name", "type", "version", "label", "description", "source_code", "download", "license", "documentation", "operating_system", "repository", "webpage", "input", "output", "dependencies", "authors", "publication", "topics", "operations", "test"]

#: Indicators by principle. Fixed values.
INDICATORS = {"F": ["F1", "F2", "F3"], "A": ["A1", "A3"], "I": ["I1", "I2", "I3"], "R": ["R1", "R2", "R3", "R4"]}

#: Citation source and years of a journal's impact. Fixed values.
IMPACT_SOURCE, IMPACT_YEARS = "Semantic Scholar", ["2022", "2023", "2024"]


def collections(tools: DataFrame, tags_col: str, names: list[str], whole: str = "tools") -> DataFrame:
    """tools once for the whole and once for each of the named tags they bear, in column `collection`."""
    tags = F.filter(F.coalesce(F.col(tags_col), F.array().cast("array<string>")), lambda x: x.isin(names))
    return tools.withColumn("collection", F.explode(F.array_distinct(F.concat(F.array(F.lit(whole)), tags))))


def count_rows(tools: DataFrame, by: list[str]) -> DataFrame:
    return tools.groupBy(*by).agg(F.count("*").alias("n_tools"))


def mapped_labels(values: Column, labels: dict[str, str]) -> Column:
    """Distinct labels of an array's known values."""
    table = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))
    return F.array_distinct(F.filter(F.transform(values, lambda v: F.try_element_at(table, v)), lambda v: v.isNotNull()))


def counts_zero_filled(rows: DataFrame, label_col: str, labels: list[str]) -> DataFrame:
    """(label, n): rows of each label, also of labels without any; other labels are left out."""
    every = rows.sparkSession.createDataFrame([(x,) for x in dict.fromkeys(labels)], "label string")
    counted = rows.where(F.col(label_col).isin(labels)).groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    return every.join(counted, "label", "left").select("label", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def tools_per_source(tools: DataFrame, sources_col: str, labels: dict[str, str] = SOURCE_LABELS) -> DataFrame:
    """(label, n): tools of each label of sources, zeros included."""
    return counts_zero_filled(tools.select(F.explode(mapped_labels(F.col(sources_col), labels)).alias("l")), "l", list(labels.values()))


def coverage(rows: DataFrame, count_col: str, most: int = 9) -> DataFrame:
    """(bucket, n, running): rows with 1..most in count_col, empty buckets included, and their running total."""
    buckets = rows.sparkSession.range(1, most + 1).select(F.col("id").cast("int").alias("bucket"))
    counted = rows.groupBy(F.col(count_col).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    filled = buckets.join(counted, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    return filled.withColumn("running", F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))


def coverage_matrix(tools: DataFrame, sources_col: str, most: int = 6) -> DataFrame:
    """(label, bucket, n): tools of a label by how many labels they have, up to `most`."""
    labels = mapped_labels(F.col(sources_col), {k: v for k, v in SOURCE_LABELS.items() if v not in NOT_COVERED})
    return tools.select(labels.alias("l")).select(F.explode("l").alias("label"), F.size("l").alias("bucket")).where(F.col("bucket") <= most).groupBy("label", "bucket").agg(F.count("*").alias("n"))


def feature_presence(tools: DataFrame, features: list[str], by: list[str] | None = None) -> DataFrame:
    """(by, feature, share): share of rows with a meaningful value."""
    by = by or []
    shares = tools.groupBy(*by).agg(*(F.avg(is_meaningful(F.col(f), tools.schema[f].dataType).cast("int")).alias(f) for f in features))
    return shares.select(*by, F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("share")) for f in features))).alias("x")).select(*by, "x.*")


def feature_counts(tools: DataFrame, features: list[str]) -> DataFrame:
    """(n_features, n, share, running_share): rows by how many features are meaningful; false values count as such here."""
    counted = tools.select(completeness(tools.schema, features, false_counts=True).alias("n_features")).groupBy("n_features").agg(F.count("*").alias("n"))
    total, up = Window.partitionBy(), Window.orderBy("n_features").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select("n_features", "n", (F.col("n") / F.sum("n").over(total)).alias("share"), (F.sum("n").over(up) / F.sum("n").over(total)).alias("running_share"))


def value_share(rows: DataFrame, value: Column, nothing: tuple[str, ...] = ("unknown", "None")) -> DataFrame:
    """(value, n, share): how often each value occurs; null and the values that say nothing are left out."""
    counted = rows.select(value.alias("value")).where(F.col("value").isNotNull() & ~F.col("value").isin(*nothing)).groupBy("value").agg(F.count("*").alias("n"))
    counted = materialise(counted)
    total = counted.agg(F.sum("n")).first()[0] or 0
    return counted.withColumn("share", F.col("n") / F.lit(total))


def licence_verdicts(tools: DataFrame, id_col: str, names_col: str, metrics_only: Column | None = None) -> DataFrame:
    """(id, verdict, class): None, Unambiguous (with its class) or Ambiguous by the distinct classes of a tool's licence names; 'unlicensed' beside one other class does not count."""
    classes = F.array_distinct(F.filter(F.transform(F.coalesce(F.col(names_col), F.array().cast("array<string>")), licence_class), lambda x: x.isNotNull()))
    if metrics_only is not None:
        classes = F.when(metrics_only, F.array_remove(classes, "not-software")).otherwise(classes)
    rows = tools.select(F.col(id_col), classes.alias("c")).withColumn("real", F.array_remove("c", "unlicensed"))
    verdict = F.when(F.size("real") == 0, F.lit("None")).when(F.size("real") == 1, F.lit("Unambiguous")).otherwise(F.lit("Ambiguous"))
    return rows.select(id_col, verdict.alias("verdict"), F.when(F.size("real") == 1, F.get("real", F.lit(0))).alias("class"))


def licence_summary(verdicts: DataFrame) -> DataFrame:
    """(id, parent, n): the hierarchy of verdicts, with open-source and other unambiguous licences."""
    n = verdicts.agg(
        F.count("*").alias("Total"),
        *(F.count_if(F.col("verdict") == v).alias(v) for v in ("None", "Unambiguous", "Ambiguous")),
        F.count_if((F.col("verdict") == "Unambiguous") & (F.col("class") != "other")).alias("Open Source"),
        F.count_if(F.col("class") == "other").alias("other"),
    )
    return n.select(F.explode(F.array(*(F.struct(F.lit(k).alias("id"), F.lit(p).alias("parent"), F.col(f"`{k}`").alias("n")) for k, p in LICENCE_HIERARCHY))).alias("x")).select("x.*")


def open_source_licences(verdicts: DataFrame) -> DataFrame:
    """(licence_group, class, n) of unambiguous open-source classes."""
    group = F.create_map(*(F.lit(x) for g, cs in LICENCE_GROUPS.items() for c in cs for x in (c, g)))
    counted = verdicts.where("verdict = 'Unambiguous'").groupBy("class").agg(F.count("*").alias("n"))
    return counted.select(F.try_element_at(group, F.col("class")).alias("licence_group"), "class", "n").where("licence_group IS NOT NULL")


def version_scheme(versions: Column, null_text_is_none: bool = False) -> Column:
    """Semantic, Other or None, whichever most versions are; in this order on ties. A text 'None' is Other unless null_text_is_none."""
    nothing = lambda v: v.isNull() | (F.trim(v) == "") | (F.lower(v) == "unknown") | (F.lit(null_text_is_none) & (v == "None"))
    semantic = lambda v: ~nothing(v) & ((F.lower(v) == "v1") | (F.size(F.split(v, r"\.")) >= 2))
    n = F.size(F.filter(versions, nothing))
    s = F.size(F.filter(versions, semantic))
    o = F.size(versions) - n - s
    some = versions.isNotNull() & (F.size(versions) > 0)
    return F.when(~F.coalesce(some, F.lit(False)), F.lit("None")).when((s >= o) & (s >= n), F.lit("Semantic")).when(o >= n, F.lit("Other")).otherwise(F.lit("None"))


def host_counts(tools: DataFrame, id_col: str, links_col: str, hosts: tuple[str, ...] = ("github", "gitlab", "bitbucket", "sourceforge")) -> DataFrame:
    """(kind, n_links, n_tools): distinct links of a tool by the kind of repository, zeros included."""
    links = tools.select(id_col, F.explode(F.array_distinct(links_col)).alias("link")).select(id_col, repository_kind(F.col("link")).alias("kind"))
    counted = links.where(F.col("kind").isin(*hosts)).groupBy("kind").agg(F.count("*").alias("n_links"), F.countDistinct(id_col).alias("n_tools"))
    every = tools.sparkSession.createDataFrame([(h,) for h in hosts], "kind string")
    zero = F.lit(0).cast("long")
    return every.join(counted, "kind", "left").select("kind", F.coalesce("n_links", zero).alias("n_links"), F.coalesce("n_tools", zero).alias("n_tools"))


def _impacts(publications: DataFrame, id_col: str, journal_col: str, citations_col: str, years: list[str] | None) -> DataFrame:
    """(id, journal, impact) of each citation record of the impact source."""
    c = publications.where(F.col(journal_col).isNotNull() & (F.col(journal_col) != "")).select(F.col(id_col).alias("id"), F.col(journal_col).alias("journal"), F.explode(citations_col).alias("c"))
    impact = sum((F.coalesce(F.try_element_at(F.col("c.count"), F.lit(y)), F.lit(0)) for y in years or IMPACT_YEARS), F.lit(0).cast("long"))
    return c.where((F.col("c.source") == IMPACT_SOURCE) & (F.size("c.count") > 0)).select("id", "journal", impact.alias("impact"))


def journal_impact(publications: DataFrame, id_col: str, journal_col: str, citations_col: str, years: list[str] | None = None) -> DataFrame:
    """(journal, impact, n_publications): citations of the years by the impact source; citations are array<struct<source, count map<string, bigint>>>. A publication counts once for each such citation record."""
    c = _impacts(publications, id_col, journal_col, citations_col, years)
    return c.groupBy("journal").agg(F.sum("impact").cast("long").alias("impact"), F.count("*").alias("n_publications"))


def top_journals(impact: DataFrame, n: int = 10) -> DataFrame:
    """The journals with the highest impact; ties go by name."""
    return impact.orderBy(F.desc("impact"), "journal").limit(n)


def journal_tools(publications: DataFrame, id_col: str, journal_col: str, citations_col: str, tools: DataFrame, publications_col: str, n: int = 10, years: list[str] | None = None) -> DataFrame:
    """(journal, impact, n_publications, n_tools) of the top journals; n_tools is how often tools name one of a journal's publications."""
    top = materialise(top_journals(journal_impact(publications, id_col, journal_col, citations_col, years), n))
    ids = _impacts(publications, id_col, journal_col, citations_col, years).select("id", "journal").distinct().join(F.broadcast(top.select("journal")), "journal")
    named = tools.select(F.explode(publications_col).alias("id"))
    counted = named.join(ids, "id").groupBy("journal").agg(F.count("*").alias("n_tools"))
    return top.join(counted, "journal", "left").select("journal", "impact", "n_publications", F.coalesce("n_tools", F.lit(0).cast("long")).alias("n_tools"))


def journals_by_collection(publications: DataFrame, id_col: str, journal_col: str, citations_col: str, tools: DataFrame, collection_col: str, publications_col: str, n: int = 10, years: list[str] | None = None) -> DataFrame:
    """(collection, journal, impact, n_publications, place): the top journals of each collection of tools, where a publication counts once for each tool that names it."""
    c = _impacts(publications, id_col, journal_col, citations_col, years)
    named = tools.select(F.col(collection_col).alias("collection"), F.explode(publications_col).alias("id"))
    per = named.join(c, "id").groupBy("collection", "journal").agg(F.sum("impact").cast("long").alias("impact"), F.count("*").alias("n_publications"))
    place = F.row_number().over(Window.partitionBy("collection").orderBy(F.desc("impact"), "journal"))
    return per.withColumn("place", place).where(F.col("place") <= n)


def indicator_frequency(scores: DataFrame) -> DataFrame:
    """(indicator, score, n, share) of a table (tool_id, indicator, score): share of the indicator's scores; nulls are left out."""
    counted = scores.where("score IS NOT NULL").groupBy("indicator", "score").agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("indicator")))


def indicator_summary(scores: DataFrame) -> DataFrame:
    """(principle, indicator, scores, counts, shares): arrays in the order of scores, for the known indicators."""
    principle = F.create_map(*(F.lit(x) for p, xs in INDICATORS.items() for i in xs for x in (i, p)))
    f = indicator_frequency(scores).withColumn("principle", F.try_element_at(principle, F.col("indicator"))).where("principle IS NOT NULL")
    g = f.groupBy("principle", "indicator").agg(F.array_sort(F.collect_list(F.struct("score", "n", "share"))).alias("x"))
    return g.select("principle", "indicator", F.col("x.score").alias("scores"), F.col("x.n").alias("counts"), F.col("x.share").alias("shares"))


def indicator_mean(scores: DataFrame, digits: int = 4) -> DataFrame:
    """(indicator, mean) over scores that are not null."""
    return scores.where("score IS NOT NULL").groupBy("indicator").agg(F.round(F.avg("score"), digits).alias("mean"))


def fixed_size_bins(rows: DataFrame, value_col: str, tie_col: str, size: int = 700) -> DataFrame:
    """(bin, n, mean): rows in the order of value_col, `size` to a bin.

    Ranks come from counts of the value's ranges, not from one sorted partition:
    the number of rows before a range partition is added to the rank inside it.
    """
    # written once: both reads of it see the same ranges, whatever adaptive execution makes of them
    parts = materialise(rows.select(value_col, tie_col).repartitionByRange(value_col, tie_col).withColumn("part", F.spark_partition_id()))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(value_col, tie_col))
    sizes = parts.groupBy("part").agg(F.count("*").alias("c"))
    before = sizes.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))
    ranked = parts.withColumn("inside", inside).join(F.broadcast(before), "part").select(F.floor((F.col("before") + F.col("inside") - 1) / size).alias("bin"), value_col)
    return ranked.groupBy("bin").agg(F.count("*").alias("n"), F.avg(value_col).alias("mean"))


def normalised_share(rows: DataFrame, ok: Column) -> DataFrame:
    """(n, n_normalised, share): how many rows meet a condition."""
    return rows.agg(F.count("*").alias("n"), F.count_if(ok).alias("n_normalised")).withColumn("share", F.col("n_normalised") / F.nullif(F.col("n"), F.lit(0)))


def source_features(provided: dict[str, list[str]], features: list[str], spark) -> DataFrame:
    """(source, feature, place): the feature's place in the list from 1 if the source provides it, else 0."""
    rows = [(s, f, i + 1 if f in has else 0) for s, has in provided.items() for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "source string, feature string, place int")


def computation(result: DataFrame, variable: str, collection: str, version: Column | None = None) -> DataFrame:
    """(variable, version, collection, data): a result's rows for the sink of computations, each as JSON; a result is all rows of one variable and version."""
    stamp = version if version is not None else F.date_format(F.current_timestamp(), "dd/MM/yyyy HH:mm:ss")
    return result.select(F.lit(variable).alias("variable"), stamp.alias("version"), F.lit(collection).alias("collection"), F.to_json(F.struct(*result.columns)).alias("data"))


#: Features of a publication, and the citation sources that count as one more each. Fixed values.
PUBLICATION_FEATURES = ["year", "title", "abstract", "journal", "authors", "url", "pmcid", "pmid", "doi"]
CITATION_SOURCES = ["Europe PMC", "Semantic Scholar"]


def share_complete(rows: DataFrame, features: list[str]) -> Column:
    """Share of the features that are meaningful; those that rows lack are not."""
    return completeness(rows.schema, [f for f in features if f in rows.columns]) / len(features)


def source_completeness(tools: DataFrame, ids_col: str, entries: DataFrame, id_col: str, source: str, features: list[str] = COMPLETE) -> DataFrame:
    """(tool, score): the mean completeness of a tool's entries whose id has `source`/ in it."""
    scored = entries.select(F.col(id_col).alias("_id"), share_complete(entries, features).alias("_s"))
    ids = tools.select(F.col("block").alias("tool"), F.explode(ids_col).alias("_id")).where(F.col("_id").contains(f"{source}/"))
    return ids.join(scored, "_id").groupBy("tool").agg(F.avg("_s").alias("score"))


def total_completeness(tools: DataFrame, id_col: str, features: list[str] = COMPLETE) -> DataFrame:
    """(tool, score): completeness of merged tools themselves."""
    return tools.select(F.col(id_col).alias("tool"), share_complete(tools, features).alias("score"))


def enrichment_completeness(records: DataFrame, features: list[str] = PUBLICATION_FEATURES, out_of: int = 11) -> DataFrame:
    """(source, score) of records (source, citations, total, error and features) that enrichment services gave: the share of meaningful features for the first source, and one feature for every record of the second with a citation."""
    first, second = CITATION_SOURCES
    n = completeness(records.schema, [f for f in features if f in records.columns])
    score = F.when(F.col("source") == first, n / out_of).when((F.col("source") == second) & (F.col("total") > 0), F.lit(1 / out_of))
    return records.where("error IS NULL").select("source", score.alias("score")).where("score IS NOT NULL")


def score_bins(scores: DataFrame, bins: int = 10) -> DataFrame:
    """(bin, n): scores from 0 to 1 by tenths; 1 belongs to the last."""
    return scores.groupBy(F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def publication_completeness(publications: DataFrame, id_col: str, citations_col: str, features: list[str] = PUBLICATION_FEATURES, out_of: int = 11) -> DataFrame:
    """(id, score): meaningful features and known citation sources of a publication, out of `out_of`."""
    known = F.coalesce(F.size(F.filter(citations_col, lambda c: c["source"].isin(CITATION_SOURCES))), F.lit(0))
    n = completeness(publications.schema, [f for f in features if f in publications.columns]) + F.greatest(known, F.lit(0))
    return publications.select(F.col(id_col).alias("id"), (n / out_of).alias("score"))


def normalised_formats(entries: DataFrame, id_col: str, source: str = "biotools") -> DataFrame:
    """(id, n): inputs and outputs of an entry of the source that have an address themselves or for their datatype."""
    both = F.concat(*(F.coalesce(F.transform(c, lambda x: F.coalesce(F.nullif(x["uri"], F.lit("")), F.nullif(x["datatype"]["uri"], F.lit("")))), F.array().cast("array<string>")) for c in ("input", "output")))
    rows = entries.where(F.array_contains("source", source)).select(F.col(id_col).alias("id"), F.size(F.filter(both, lambda u: u.isNotNull())).alias("n"))
    return rows.where("n > 0")


def tools_with_any(tools: DataFrame, ids_col: str, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Tools that name any of the ids."""
    named = tools.select("block", F.explode(ids_col).alias(id_col)).join(ids.select(id_col), id_col, "left_semi")
    return tools.join(named.select("block").distinct(), "block", "left_semi")


def types_by_name(entries: DataFrame, source: str = "bioconda") -> DataFrame:
    """(name, types) of the entries that come from the source alone."""
    return entries.where(F.col("source") == F.array(F.lit(source))).groupBy("name").agg(F.array_sort(F.collect_set("type")).alias("types"))
