"""Queries on whole tables for resolution, merging and statistics: blocks of parts by name, and unfiltered twins of the block queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindrift.catalogue import query
from spindrift.functions import text
from spindrift.operators import merge, resolve, reviews, statistics
from spindrift.operators.components import components
from spindrift.plans.demos import _t, _text_ids
from spindrift.storage import materialise

# --- blocks of whole tables: parts are entries, a block is a part's name, orders in one year are links


_WHOLE_SQL = """
e AS (SELECT p_partkey AS entry, p_name AS block, p_brand AS brand, p_type AS type FROM part),
l AS (SELECT DISTINCT p_name AS block, p_partkey AS entry, l_suppkey AS link FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber = 1),
s AS (SELECT block, entry, max(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS shares FROM (SELECT *, count(*) OVER (PARTITION BY block, link) AS c FROM l) GROUP BY block, entry),
r AS (SELECT e.*, CASE WHEN coalesce(s.shares, 0) = 1 THEN 'remaining' ELSE 'disconnected' END AS role FROM e LEFT JOIN s USING (block, entry) WHERE block IN (SELECT block FROM e GROUP BY block HAVING count(*) > 1)),
c AS (SELECT * FROM r WHERE block IN (SELECT block FROM r WHERE role = 'disconnected')),
m AS (SELECT block, entry, brand, type, CASE WHEN role = 'disconnected' AND (block, brand, lower(type)) IN (SELECT (block, brand, lower(type)) FROM c WHERE role = 'remaining') THEN 'remaining' ELSE role END AS role FROM c)"""


def _whole(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    entries = part.select(F.col("p_name").alias("block"), F.col("p_partkey").alias("entry"), F.col("p_partkey").alias("ord"), F.col("p_type").alias("name"), F.array("p_brand").alias("source"))
    sold = _t(spark, sf_dir, "lineitem").where("l_linenumber = 1").select("l_partkey", "l_suppkey")
    links = sold.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_name").alias("block"), F.col("p_partkey").alias("entry"), F.col("l_suppkey").cast("string").alias("link")).distinct()
    return entries, links


def _found(spark, sf_dir):
    """(entries, conflicts, conflicts after the merge by source and name), read from the tables once."""
    entries, links = _whole(spark, sf_dir)
    found = materialise(resolve.detect_conflicts(entries, links).join(entries.select("block", "entry", "source"), ["block", "entry"]))
    return entries, found, resolve.merge_by_source_name(found)


@query("whole_disconnected_entries", f"WITH {_WHOLE_SQL} SELECT block, entry, role FROM c")
def whole_disconnected_entries(spark, sf_dir):
    """Every part and its first sales, no filter on either."""
    return resolve.detect_conflicts(*_whole(spark, sf_dir)).select("block", "entry", "role")


@query("whole_source_name_merge", f"WITH {_WHOLE_SQL} SELECT block, entry, role FROM m")
def whole_source_name_merge(spark, sf_dir):
    return _found(spark, sf_dir)[2].select("block", "entry", "role")


@query(
    "conflict_counts",
    f"""WITH {_WHOLE_SQL} SELECT 'blocks' AS measure, count(DISTINCT block) AS n FROM e UNION ALL SELECT 'conflicts', count(DISTINCT block) FROM c
    UNION ALL SELECT 'disconnected', count(*) FROM c WHERE role = 'disconnected' UNION ALL SELECT 'disconnected_after_merge', count(*) FROM m WHERE role = 'disconnected'""",
)
def conflict_counts(spark, sf_dir):
    return resolve.conflict_counts(*_found(spark, sf_dir))


@query("unique_ids", f"WITH {_WHOLE_SQL} SELECT role, count(*) AS n_entries, count(DISTINCT entry) AS n_unique FROM m GROUP BY role")
def unique_ids(spark, sf_dir):
    return resolve.unique_ids(_found(spark, sf_dir)[2])


_GROUPS = (
    _WHOLE_SQL
    + """,
g AS (SELECT block, coalesce(list_sort(list(entry) FILTER (role = 'disconnected')), []) AS d, coalesce(list_sort(list(entry) FILTER (role = 'remaining')), []) AS r FROM m GROUP BY block),
p AS (SELECT block, unnest(CASE WHEN len(r) > 0 THEN d WHEN len(d) > 1 THEN d[2:] END) AS entry, CASE WHEN len(r) > 0 THEN r WHEN len(d) > 1 THEN d[1:1] END AS anchors FROM g)"""
)


def _provider(pairs):
    """Verdicts by rule: the remainder of the entry's number."""
    verdict = F.when(F.col("entry").cast("long") % 50 == 0, F.lit("disagreement")).when(F.col("entry").cast("long") % 2 == 0, F.lit("Same")).otherwise(F.lit("Different"))
    return pairs.withColumns({"verdict": verdict, "confidence": F.lit("high")})


@query("whole_pairs", f"WITH {_GROUPS} SELECT block, entry, CAST(len(anchors) AS INTEGER) AS n_anchors, anchors[1] AS first_anchor FROM p")
def whole_pairs(spark, sf_dir):
    pairs = resolve.build_pairs(_found(spark, sf_dir)[2])
    return pairs.select("block", "entry", F.size("anchors").alias("n_anchors"), F.get("anchors", F.lit(0)).alias("first_anchor"))


@query("verdict_counts", f"WITH {_GROUPS}, v AS (SELECT CASE WHEN entry % 50 = 0 THEN 'disagreement' WHEN entry % 2 = 0 THEN 'same' ELSE 'different' END AS verdict FROM p) SELECT verdict, count(*) AS n, count(*) / (SELECT count(*) FROM v) AS share FROM v GROUP BY verdict")
def verdict_counts(spark, sf_dir):
    return resolve.verdict_counts(materialise(_provider(resolve.build_pairs(_found(spark, sf_dir)[2]))), F.col("verdict"))


#: Rounds in SQL: state is (block, merged, unmerged, pending, round); a round's new block holds what the one before left unmerged.
_ROUNDS = (
    "WITH RECURSIVE "
    + _GROUPS
    + """,
first AS (SELECT block, CASE WHEN len(r) > 0 THEN r ELSE d[1:1] END AS a, CASE WHEN len(r) > 0 THEN d ELSE d[2:] END AS o, len(r) AS n_r FROM g),
x AS (
  SELECT block, 0 AS round, a, o, n_r FROM first
  UNION ALL
  SELECT block || '_secondary_1', round + 1, u[1:1], u[2:], 1 FROM (SELECT block, round, n_r, list_filter(o, lambda e: e % 2 <> 0) AS u, o FROM x WHERE len(list_filter(o, lambda e: e % 50 = 0)) = 0) WHERE len(u) > 1),
done AS (
  SELECT block, CASE WHEN len(list_filter(o, lambda e: e % 50 = 0)) > 0 THEN 'manual_review_pending' WHEN len(o) = 0 AND n_r = 0 THEN 'partial' WHEN len(list_filter(o, lambda e: e % 2 <> 0)) > 0 THEN 'partial' ELSE 'merged' END AS resolution,
    CASE WHEN len(list_filter(o, lambda e: e % 50 = 0)) > 0 OR (len(o) = 0 AND n_r = 0) THEN [] ELSE list_concat(a, list_filter(o, lambda e: e % 2 = 0)) END AS merged,
    CASE WHEN len(list_filter(o, lambda e: e % 50 = 0)) > 0 THEN list_concat(a, o) WHEN len(o) = 0 AND n_r = 0 THEN a ELSE list_filter(o, lambda e: e % 2 <> 0) END AS unmerged FROM x
  UNION ALL
  SELECT block, 'no_conflict', list_sort(list(entry)), [] FROM e WHERE block NOT IN (SELECT block FROM c) GROUP BY block)"""
)


def _records(spark, sf_dir):
    entries, _, merged = _found(spark, sf_dir)
    return resolve.resolve(_text_ids(entries.select("block", "entry", "ord")), _text_ids(merged), _provider)


@query("whole_resolution", _ROUNDS + " SELECT block, resolution, array_to_string(merged, '|') AS merged, array_to_string(unmerged, '|') AS unmerged FROM done")
def whole_resolution(spark, sf_dir):
    """All rounds on all parts, to the end."""
    return _records(spark, sf_dir).select("block", "resolution", F.array_join("merged", "|").alias("merged"), F.array_join("unmerged", "|").alias("unmerged"))


@query(
    "whole_funnel",
    _ROUNDS
    + """ SELECT count(*) FILTER (resolution = 'no_conflict') AS n_no_conflict, count(*) FILTER (resolution IN ('merged', 'partial')) AS n_auto, count(*) FILTER (resolution = 'manual_review_pending') AS n_pending, CAST(0 AS BIGINT) AS n_human, CAST(0 AS BIGINT) AS n_unclear
    FROM done WHERE NOT contains(block, '_secondary_')""",
)
def whole_funnel(spark, sf_dir):
    return resolve.funnel(_records(spark, sf_dir))


@query("tools_of_records", _ROUNDS + ", t AS (SELECT block AS tool, unnest(merged) AS entry FROM done UNION ALL SELECT block || '#unmerged', unmerged[1] FROM done WHERE resolution = 'partial' AND len(unmerged) = 1) SELECT tool, CAST(entry AS VARCHAR) AS entry FROM t WHERE tool NOT IN (SELECT block FROM done WHERE resolution = 'manual_review_pending')")
def tools_of_records(spark, sf_dir):
    return merge.tools_of(_records(spark, sf_dir)).select("tool", "entry")


@query(
    "human_records",
    f"""WITH {_GROUPS}, t AS (SELECT block, CASE WHEN len(r) = 0 AND len(d) = 2 THEN d[2:] ELSE r END AS r, CASE WHEN len(r) = 0 AND len(d) = 2 THEN d[1:1] ELSE d END AS d, length(block) % 4 AS k FROM g)
    SELECT block, CASE k WHEN 0 THEN 'merged' WHEN 1 THEN 'partial' WHEN 2 THEN 'unclear' ELSE 'manual_review_pending' END AS resolution, CAST(CASE k WHEN 0 THEN len(r) + len(d) WHEN 1 THEN len(r) ELSE 0 END AS INTEGER) AS n_merged,
      CAST(CASE k WHEN 0 THEN 0 WHEN 1 THEN len(d) ELSE len(r) + len(d) END AS INTEGER) AS n_unmerged FROM t""",
)
def human_records(spark, sf_dir):
    conflicts = materialise(_text_ids(_found(spark, sf_dir)[2]))
    k = F.length("block") % 4
    word = F.when(k == 0, F.lit("Same")).when(k == 1, F.lit("different")).when(k == 2, F.lit("Unclear")).otherwise(F.lit("what"))
    decisions = conflicts.select("block").distinct().select("block", word.alias("decision"), F.lit("high").alias("confidence"))
    return resolve.human_records(decisions, conflicts).select("block", "resolution", F.size("merged").alias("n_merged"), F.size("unmerged").alias("n_unmerged"))


@query("human_key_check", "SELECT key, problem FROM (SELECT c_custkey AS key, CASE WHEN c_custkey % 10 = 0 THEN 'missing' WHEN c_mktsegment <> 'BUILDING' THEN 'not pending' END AS problem FROM customer) WHERE problem IS NOT NULL")
def human_key_check(spark, sf_dir):
    """Decisions on blocks that have no record or one that does not wait; customers stand for blocks."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("block"), F.when(F.col("c_mktsegment") == "BUILDING", F.lit("manual_review_pending")).otherwise(F.lit("merged")).alias("resolution"))
    return resolve.human_key_check(c.select("block"), c.where("block % 10 <> 0"))


@query("merge_notes", "SELECT p_brand, CASE WHEN count(DISTINCT p_name) > 1 THEN 'Entries with different names were merged. Please check.' END AS note FROM part GROUP BY p_brand")
def merge_notes(spark, sf_dir):
    ids = _t(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_list(text.entry_id(F.lit("s"), F.col("p_name"), F.lit("cmd"), F.lit("1"))).alias("ids"))
    return ids.select("p_brand", resolve.caution(F.col("ids")).alias("note"))


@query("dropped_sources", "SELECT count(*) FILTER (p_brand = 'Brand#2') AS n_entries, (SELECT count(*) FROM (SELECT p_name, p_type FROM part GROUP BY ALL HAVING bool_and(p_brand = 'Brand#2'))) AS n_blocks FROM part")
def dropped_sources(spark, sf_dir):
    members = _t(spark, sf_dir, "part").select(F.concat_ws("/", "p_name", "p_type").alias("block"), F.col("p_partkey").alias("entry"), F.array("p_brand").alias("source"))
    return resolve.drop_sources(members, ["Brand#2"])[1]


@query("alias_blocks", "SELECT p_type AS block, name FROM (SELECT DISTINCT p_type, p_name AS name FROM part WHERE p_size <= 25) JOIN (SELECT DISTINCT p_type, p_name AS name FROM part WHERE p_size > 25) USING (p_type, name)")
def alias_blocks(spark, sf_dir):
    name = F.when(F.col("p_size") > 25, F.concat(F.lit("bioconductor-"), "p_name")).otherwise(F.col("p_name"))
    return resolve.alias_blocks(_t(spark, sf_dir, "part").select(F.col("p_type").alias("block"), name.alias("name")))


@query("whole_components", "WITH RECURSIVE s AS (SELECT DISTINCT a.l_orderkey AS a, b.l_orderkey AS b FROM lineitem AS a JOIN lineitem AS b USING (l_partkey, l_suppkey) WHERE a.l_orderkey <= b.l_orderkey), k AS (SELECT a, b FROM s UNION SELECT b, a FROM s), r AS (SELECT a AS v, a AS w FROM k UNION SELECT r.v, k.b FROM r JOIN k ON r.w = k.a WHERE k.b < r.v) SELECT CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_vertices FROM lineitem")
def whole_components(spark, sf_dir):
    """All orders and parts of the table, one edge a line; how many orders have a component."""
    rows = _t(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 2).alias("a"), (F.col("l_partkey") * 2 + 1).alias("b"))
    return components(rows, "a", "b").where("vertex % 2 = 0").agg(F.count("*").alias("n_vertices"))


@query("ids_to_documents", "SELECT o_orderkey, array_to_string(list_sort(list(p_name || '')), '|') AS names FROM (SELECT DISTINCT l_orderkey AS o_orderkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey GROUP BY o_orderkey")
def ids_to_documents(spark, sf_dir):
    """Orders as tools, their parts as publications named by ids."""
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("pub"), F.col("p_name").alias("title"))
    tools = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_set("l_partkey")).alias("publication"))
    found = reviews.with_publications(tools, "o_orderkey", "publication", part, "pub")
    return found.select("o_orderkey", F.array_join(F.array_sort(F.transform("publication", lambda p: p["title"])), "|").alias("names"))


# --- merging -----------------------------------------------------------------


def _items(fields: dict, kind: str | None = None):
    item = F.array(F.struct(*(c.alias(k) for k, c in fields.items())))
    return item.cast(kind) if kind else item


@query(
    "merge_formats",
    """WITH x AS (SELECT p_type, p_brand, arg_min(CASE WHEN p_size > 25 THEN 'u' || p_partkey END, p_partkey) FILTER (p_size > 25) AS uri, min(p_partkey) AS place FROM part GROUP BY p_type, p_brand)
    SELECT p_type, string_agg('EDAM=' || p_brand || '=' || coalesce(uri, ''), '|' ORDER BY place) AS items FROM x GROUP BY p_type""",
)
def merge_formats(spark, sf_dir):
    """One input for each vocabulary and term, the first address that is given."""
    uri = F.when(F.col("p_size") > 25, F.concat(F.lit("u"), F.col("p_partkey").cast("string"))).otherwise(F.lit(""))
    none = F.lit(None).cast("struct<vocabulary: string, term: string, uri: string>")
    rows = _t(spark, sf_dir, "part").select("p_type", "p_partkey", _items({"vocabulary": F.lit("EDAM"), "term": F.col("p_brand"), "uri": uri, "datatype": none}).alias("input"))
    x = merge.formats(rows, "p_type", "p_partkey", "input")
    return x.select("p_type", F.array_join(F.transform("input", lambda i: F.concat_ws("=", i["vocabulary"], i["term"], F.coalesce(i["uri"], F.lit("")))), "|").alias("items"))


@query(
    "merge_licences",
    """WITH x AS (SELECT p_name, p_brand, arg_min('https://l/' || p_partkey, p_partkey) FILTER (p_size % 3 = 0) AS url, min(p_partkey) AS place FROM part GROUP BY p_name, p_brand)
    SELECT p_name, string_agg(p_brand || '=' || coalesce(url, ''), '|' ORDER BY place) AS items FROM x GROUP BY p_name""",
)
def merge_licences(spark, sf_dir):
    url = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("https://l/"), F.col("p_partkey").cast("string")))
    rows = _t(spark, sf_dir, "part").select("p_name", "p_partkey", _items({"name": F.col("p_brand"), "url": url}).alias("license"))
    return merge.licences(rows, "p_name", "p_partkey").select("p_name", F.array_join(F.transform("license", lambda i: F.concat_ws("=", i["name"], F.coalesce(i["url"], F.lit("")))), "|").alias("items"))


@query(
    "merge_authors",
    """WITH x AS (SELECT c_nationkey, c_mktsegment, arg_min(c_name, c_custkey) FILTER (c_custkey % 2 = 0) AS email, bool_or(c_acctbal < 0) AS maintainer, min(c_custkey) AS place FROM customer GROUP BY ALL)
    SELECT c_nationkey, string_agg(c_mktsegment || '=' || coalesce(email, '') || '=' || CAST(maintainer AS VARCHAR), '|' ORDER BY place) AS items FROM x GROUP BY c_nationkey""",
)
def merge_authors(spark, sf_dir):
    """One author for each name: the first of every detail, a maintainer if ever one."""
    none = F.lit(None).cast("string")
    email = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))
    item = _items({"type": F.lit("Person"), "name": F.col("c_mktsegment"), "email": email, "maintainer": F.col("c_acctbal") < 0, "url": none, "orcid": none})
    rows = merge.authors(_t(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", item.alias("authors")), "c_nationkey", "c_custkey")
    return rows.select("c_nationkey", F.array_join(F.transform("authors", lambda a: F.concat_ws("=", a["name"], F.coalesce(a["email"], F.lit("")), a["maintainer"].cast("string"))), "|").alias("items"))


@query(
    "merge_topics",
    """WITH x AS (SELECT p_brand, p_type, p_size % 4 AS k, arg_min('V' || p_partkey, p_partkey) FILTER (p_partkey % 2 = 0) AS v, min(p_partkey) AS place FROM part GROUP BY ALL)
    SELECT p_brand, string_agg('t_000' || k || '=' || p_type || '=' || coalesce(v, ''), '|' ORDER BY place) AS items FROM x GROUP BY p_brand""",
)
def merge_topics(spark, sf_dir):
    uri, vocabulary = F.concat(F.lit("t_000"), (F.col("p_size") % 4).cast("string")), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("V"), F.col("p_partkey").cast("string")))
    rows = _t(spark, sf_dir, "part").select("p_brand", "p_partkey", _items({"vocabulary": vocabulary, "term": F.col("p_type"), "uri": uri}).alias("topics"))
    x = merge.vocabulary_items(rows, "p_brand", "p_partkey", "topics")
    return x.select("p_brand", F.array_join(F.transform("topics", lambda i: F.concat_ws("=", i["uri"], i["term"], F.coalesce(i["vocabulary"], F.lit("")))), "|").alias("items"))


@query(
    "merge_citations",
    """WITH x AS (SELECT p_brand, p_type, min(p_partkey) AS place, bool_or(p_size > 25) AS has_note FROM part GROUP BY ALL)
    SELECT p_brand, string_agg(p_type || CASE WHEN has_note THEN '=noted' ELSE '' END, '|' ORDER BY place) AS items FROM x GROUP BY p_brand""",
)
def merge_citations(spark, sf_dir):
    """One citation for each title; a field that any copy has is kept."""
    note = F.when(F.col("p_size") > 25, F.lit("noted")).otherwise(F.lit(""))
    item = F.array(F.create_map(F.lit("title"), F.col("p_type"), F.lit("note"), note))
    x = merge.citations(_t(spark, sf_dir, "part").select("p_brand", "p_partkey", item.alias("citation")), "p_brand", "p_partkey")
    return x.select("p_brand", F.array_join(F.transform("citation", lambda m: F.concat_ws("=", F.try_element_at(m, F.lit("title")), F.try_element_at(m, F.lit("note")))), "|").alias("items"))


@query(
    "merged_tools",
    """SELECT p_name AS tool_id, CAST(count(*) AS INTEGER) AS n_entries, arg_min(p_brand, p_partkey) AS name, array_to_string(list_sort(list(DISTINCT p_type)), '|') AS type, bool_or(p_size > 45) AS test, CAST(count(DISTINCT p_size % 3) AS INTEGER) AS n_repositories FROM part GROUP BY p_name""",
)
def merged_tools(spark, sf_dir):
    """Whole entries merged, and as they are stored."""
    url = F.concat(F.lit("https://r/"), (F.col("p_size") % 3).cast("string"))
    rows = _t(spark, sf_dir, "part").select(
        F.col("p_name").alias("block"), F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("entry"), F.col("p_brand").alias("name"), F.col("p_type").alias("type"), (F.col("p_size") > 45).alias("test"), _items({"url": url, "kind": F.lit("generic")}).alias("repository")
    )
    stored = merge.as_stored(merge.merge_entries(rows), F.lit("now"))
    return stored.select("tool_id", F.size("source").alias("n_entries"), "data.name", F.array_join("data.type", "|").alias("type"), "data.test", F.size("data.repository").alias("n_repositories"))


# --- statistics ----------------------------------------------------------------

_J = "(SELECT o_orderkey AS id, 'J' || (o_custkey % 97) AS journal, CAST(floor(o_totalprice / 1000) AS BIGINT) AS n FROM orders)"


def _publications(spark, sf_dir):
    """Orders as publications of 97 journals."""
    count = F.create_map(F.lit("2022"), F.floor(F.col("o_totalprice") / 1000))
    return _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("J"), (F.col("o_custkey") % 97).cast("string")).alias("journal"), F.array(F.struct(F.lit(statistics.IMPACT_SOURCE).alias("source"), count.alias("count"))).alias("citations"))


def _citing(spark, sf_dir):
    """Lines as tools that name their order."""
    return _t(spark, sf_dir, "lineitem").select("l_returnflag", F.array("l_orderkey").alias("publication"))


@query(
    "journal_tools",
    f"""WITH t AS (SELECT journal, CAST(sum(n) AS BIGINT) AS impact, count(*) AS n_publications FROM {_J} GROUP BY journal ORDER BY 2 DESC, 1 LIMIT 10), u AS (SELECT journal, count(*) AS n_tools FROM {_J} JOIN lineitem ON l_orderkey = id GROUP BY journal)
    SELECT t.*, coalesce(n_tools, 0) AS n_tools FROM t LEFT JOIN u USING (journal)""",
)
def journal_tools(spark, sf_dir):
    return statistics.journal_tools(_publications(spark, sf_dir), "id", "journal", "citations", _citing(spark, sf_dir), "publication")


@query(
    "journals_by_collection",
    f"""WITH t AS (SELECT l_returnflag AS collection, journal, CAST(sum(n) AS BIGINT) AS impact, count(*) AS n_publications FROM {_J} JOIN lineitem ON l_orderkey = id GROUP BY ALL)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY collection ORDER BY impact DESC, journal) AS INTEGER) AS place FROM t) WHERE place <= 10""",
)
def journals_by_collection(spark, sf_dir):
    """A publication counts once for each tool that names it."""
    return statistics.journals_by_collection(_publications(spark, sf_dir), "id", "journal", "citations", _citing(spark, sf_dir), "l_returnflag", "publication")


@query(
    "indicator_summary",
    """WITH c AS (SELECT CASE l_returnflag WHEN 'A' THEN 'F1' WHEN 'N' THEN 'A1' ELSE 'R1' END AS indicator, l_discount AS score, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT indicator[1] AS principle, indicator, string_agg(CAST(CAST(round(score * 100) AS INTEGER) AS VARCHAR) || ':' || n, '|' ORDER BY score) AS scores FROM c GROUP BY indicator""",
)
def indicator_summary(spark, sf_dir):
    flag = F.when(F.col("l_returnflag") == "A", F.lit("F1")).when(F.col("l_returnflag") == "N", F.lit("A1")).otherwise(F.lit("R1"))
    s = statistics.indicator_summary(_t(spark, sf_dir, "lineitem").select(flag.alias("indicator"), F.col("l_discount").alias("score")))
    both = F.zip_with("scores", "counts", lambda a, n: F.concat_ws(":", F.round(a * 100).cast("int").cast("string"), n.cast("string")))
    return s.select("principle", "indicator", F.array_join(both, "|").alias("scores"))


def _meaningful(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("biotools/"), F.col("p_partkey").cast("string")).alias("id"), "p_name", F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.lit("")).alias("description"), F.col("p_type").alias("name"), F.when(F.col("p_size") % 2 == 0, F.array("p_type")).otherwise(F.array().cast("array<string>")).alias("type"))


_SCORE = "(1 + CASE WHEN p_size > 25 THEN 1 ELSE 0 END + CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END) / 4"


@query("source_completeness", f"SELECT p_name AS tool, round(avg({_SCORE}), 6) AS score FROM part GROUP BY p_name")
def source_completeness(spark, sf_dir):
    entries = _meaningful(spark, sf_dir)
    tools = entries.groupBy(F.col("p_name").alias("block")).agg(F.concat(F.collect_list("id"), F.array(F.lit("github/none"))).alias("ids"))
    return statistics.source_completeness(tools, "ids", entries, "id", "biotools", ["name", "description", "type", "absent"]).withColumn("score", F.round("score", 6))


@query("total_completeness", f"SELECT CAST(floor(10 * {_SCORE}) AS BIGINT) AS bin, count(*) AS n FROM part GROUP BY 1")
def total_completeness(spark, sf_dir):
    return statistics.score_bins(statistics.total_completeness(_meaningful(spark, sf_dir), "id", ["name", "description", "type", "absent"]))


@query("publication_completeness", "SELECT doc_id AS id, (1 + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END + doc_id % 3) / 11 AS score FROM documents")
def publication_completeness(spark, sf_dir):
    """Features of a publication and its known citation sources, out of eleven."""
    known = F.array(*(F.struct(F.lit(s).alias("source")) for s in ("Europe PMC", "Semantic Scholar", "elsewhere")))
    some = F.when(F.col("doc_id") % 3 == 0, F.slice(known, 3, 1)).when(F.col("doc_id") % 3 == 1, F.slice(known, 1, 1)).otherwise(known)
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("journal"), F.when(F.col("doc_id") % 2 == 0, F.lit("10.1000/x")).otherwise(F.lit("")).alias("doi"), some.alias("citations"))
    return statistics.publication_completeness(rows, "doc_id", "citations")


@query("enrichment_completeness", "SELECT source, score FROM (SELECT CASE WHEN doc_id % 2 = 0 THEN 'Europe PMC' ELSE 'Semantic Scholar' END AS source, CASE WHEN doc_id % 2 = 0 THEN 1 / 11 WHEN n_chars % 3 > 0 THEN 1 / 11 END AS score FROM documents WHERE doc_id % 5 <> 0) WHERE score IS NOT NULL")
def enrichment_completeness(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    rows = d.select(F.when(F.col("doc_id") % 2 == 0, F.lit("Europe PMC")).otherwise(F.lit("Semantic Scholar")).alias("source"), F.col("lang").alias("journal"), (F.col("n_chars") % 3).alias("total"), F.when(F.col("doc_id") % 5 == 0, F.lit("none")).alias("error"))
    return statistics.enrichment_completeness(rows)


@query("normalised_formats", "SELECT p_partkey AS id, CAST(CASE WHEN p_size % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n FROM part WHERE p_size % 3 < 2 AND p_size > 10")
def normalised_formats(spark, sf_dir):
    """Inputs and outputs with an address, of one source."""
    term = "struct<vocabulary: string, term: string, uri: string>"
    item = lambda uri, kind: _items({"vocabulary": F.lit("EDAM"), "term": F.lit(None).cast("string"), "uri": uri, "datatype": kind})
    none, n = F.lit(None).cast("string"), F.col("p_size") % 3
    typed = F.when(n < 2, F.struct(F.lit("EDAM").alias("vocabulary"), none.alias("term"), F.lit("data_1").alias("uri"))).cast(term)
    rows = _t(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.array(F.lit("biotools"))).otherwise(F.array(F.lit("github"))).alias("source"), item(F.when(n == 0, F.lit("format_1")).otherwise(F.lit("")), F.lit(None).cast(term)).alias("input"), item(none, typed).alias("output"))
    return statistics.normalised_formats(rows, "p_partkey")


@query("tools_with_ids", "SELECT p_name AS block FROM part GROUP BY p_name HAVING bool_or(p_partkey % 97 = 0)")
def tools_with_ids(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    tools = part.groupBy(F.col("p_name").alias("block")).agg(F.collect_list("p_partkey").alias("ids"))
    return statistics.tools_with_any(tools, "ids", part.where("p_partkey % 97 = 0").select(F.col("p_partkey").alias("id"))).select("block")


@query("types_by_name", "SELECT p_name AS name, array_to_string(list_sort(list(DISTINCT p_type)), '|') AS types FROM part WHERE p_size > 20 GROUP BY p_name")
def types_by_name(spark, sf_dir):
    """Only entries that come from the one source alone."""
    both = F.when(F.col("p_size") > 20, F.array(F.lit("bioconda"))).otherwise(F.array(F.lit("bioconda"), F.lit("github")))
    found = statistics.types_by_name(_t(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_type").alias("type"), both.alias("source")))
    return found.select("name", F.array_join("types", "|").alias("types"))


@query("coverage_matrix", "WITH x AS (SELECT o_custkey, list(DISTINCT CASE o_orderstatus WHEN 'F' THEN 'biotools' WHEN 'O' THEN 'github' ELSE 'sourceforge' END) AS l FROM orders GROUP BY 1) SELECT label, CAST(k AS INTEGER) AS bucket, count(*) AS n FROM (SELECT unnest(l) AS label, len(l) AS k FROM x) GROUP BY ALL")
def coverage_matrix(spark, sf_dir):
    s = F.when(F.col("o_orderstatus") == "F", F.lit("biotools")).when(F.col("o_orderstatus") == "O", F.lit("github")).otherwise(F.lit("sourceforge"))
    return statistics.coverage_matrix(_t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set(s).alias("s")), "s")


@query("source_features", "SELECT r.source, f.feature, CAST(CASE WHEN list_contains(r.has, f.feature) THEN f.place ELSE 0 END AS INTEGER) AS place FROM (VALUES ('one', ['a', 'c']), ('two', ['b'])) r(source, has), (VALUES ('a', 1), ('b', 2), ('c', 3)) f(feature, place)")
def source_features(spark, sf_dir):
    return statistics.source_features({"one": ["a", "c"], "two": ["b"]}, ["a", "b", "c"], spark)


@query("computation_rows", "SELECT 'types' AS variable, 'now' AS version, 'tools' AS collection, '{\"p_type\":\"' || p_type || '\",\"n\":' || count(*) || '}' AS data FROM part GROUP BY p_type")
def computation_rows(spark, sf_dir):
    counted = _t(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    return statistics.computation(counted, "types", "tools", F.lit("now"))
