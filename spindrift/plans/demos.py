"""Queries over the driver's tables: each applies a library operator to a binding of its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.catalogue import query
from spindrift.functions import licensing, text, urls
from spindrift.operators import merge, publications, resolve, statistics
from spindrift.operators.components import components
from spindrift.sources import documents


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- addresses -------------------------------------------------------------

_LINK_SQL = r"""
CASE WHEN url IS NULL OR url = '' THEN NULL ELSE
  lower(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*:', ''), '^//([^/]*)', 1)) ||
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*:', ''), '^//[^/]*', ''), ';[^/]*$', ''), '/+$', ''), '\.html$', '')
END"""

#: Addresses of parts on six hosts, for operators on repositories.
_HOSTS = ["https://github.com/", "http://www.gitlab.com/", "https://bitbucket.org/", "https://sourceforge.net/projects/", "https://git.bioconductor.org/packages/", "https://example.org/"]
_PART_URL_SQL = "CASE p_partkey % 6 " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(_HOSTS)) + " END || lower(replace(p_brand, '#', '-')) || '/tool' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_size > 25 THEN '/issues' ELSE '' END"


def _part_urls(spark, sf_dir):
    host = F.get(F.array(*map(F.lit, _HOSTS)), (F.col("p_partkey") % 6).cast("int"))
    tail = F.when(F.col("p_size") > 25, F.lit("/issues")).otherwise(F.lit(""))
    return _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", F.concat(host, F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))), F.lit("/tool"), F.col("p_partkey").cast("string"), tail).alias("url"))


@query("url_normalize", f"SELECT page_id, {_LINK_SQL} AS link FROM pages")
def url_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("link"))


@query("url_blocks", f"SELECT split_part(link, '/', 1) AS host, count(*) AS n_pages, min(page_id) AS first_page FROM (SELECT page_id, {_LINK_SQL} AS link FROM pages) GROUP BY 1")
def url_blocks(spark, sf_dir):
    """Pages grouped by the host of their normalized link."""
    pages = url_normalize(spark, sf_dir)
    return pages.groupBy(F.split_part("link", F.lit("/"), F.lit(1)).alias("host")).agg(F.count("*").alias("n_pages"), F.min("page_id").alias("first_page"))


@query("url_file_like", r"SELECT page_id, regexp_matches(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*', ''), '\.(rar|bz2|tar|gz|zip|bz|json|txt|js|py|md)$') AS is_file FROM pages")
def url_file_like(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", urls.is_file_like(F.col("url")).alias("is_file"))


@query(
    "repository_kind",
    f"""
    SELECT p_partkey, CASE WHEN contains(url, 'github.com') THEN 'github' WHEN contains(url, 'bitbucket.org') THEN 'bitbucket' WHEN contains(url, 'sourceforge.net') THEN 'sourceforge'
      WHEN contains(url, 'gitlab.com') THEN 'gitlab' WHEN contains(url, 'git.bioconductor.org') THEN 'bioconductor' END AS kind
    FROM (SELECT p_partkey, {_PART_URL_SQL} AS url FROM part)""",
)
def repository_kind(spark, sf_dir):
    return _part_urls(spark, sf_dir).select("p_partkey", urls.repository_kind(F.col("url")).alias("kind"))


@query(
    "repository_of",
    f"""
    SELECT p_partkey, regexp_extract(url, '(github|gitlab|bitbucket)\\.(com|org)/', 1) AS kind,
      'https://' || regexp_extract(url, '((github|gitlab|bitbucket)\\.(com|org)/[^/]*/[^/]*)', 1) AS url
    FROM (SELECT p_partkey, {_PART_URL_SQL} AS url FROM part) WHERE regexp_matches(url, '(github|gitlab|bitbucket)\\.(com|org)/[^/]*/[^/]*')""",
)
def repository_of(spark, sf_dir):
    found = _part_urls(spark, sf_dir).select("p_partkey", urls.repository_of(F.col("url")).alias("r"))
    return found.where("r IS NOT NULL").select("p_partkey", "r.kind", "r.url")


@query(
    "link_handler",
    f"""
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'github' WHEN 1 THEN 'gitlab' WHEN 2 THEN 'bitbucket' WHEN 3 THEN 'sourceforge' WHEN 4 THEN 'bioconductor' ELSE 'generic' END AS handler,
      CASE WHEN p_partkey % 6 IN (0, 2) THEN split_part(url, '/', 4) END AS owner
    FROM (SELECT p_partkey, {_PART_URL_SQL} AS url FROM part)""",
)
def link_handler(spark, sf_dir):
    return _part_urls(spark, sf_dir).select("p_partkey", urls.link_handler(F.col("url")).alias("h")).select("p_partkey", "h.handler", "h.owner")


@query(
    "host_distribution",
    f"""
    WITH l AS (SELECT p_brand, regexp_extract(url, '(github|gitlab|bitbucket|sourceforge)\\.', 1) AS kind FROM (SELECT DISTINCT p_brand, {_PART_URL_SQL} AS url FROM part))
    SELECT kind, count(*) AS n_links, count(DISTINCT p_brand) AS n_tools FROM l WHERE kind <> '' GROUP BY kind""",
)
def host_distribution(spark, sf_dir):
    tools = _part_urls(spark, sf_dir).groupBy("p_brand").agg(F.collect_list("url").alias("links"))
    return statistics.host_counts(tools, "p_brand", "links")


# --- blocks and components -------------------------------------------------


@query(
    "link_inverted_index",
    f"""
    SELECT link, array_to_string(list_sort(list(page_id)), '|') AS page_ids
    FROM (SELECT DISTINCT split_part({_LINK_SQL}, '/', 1) AS link, page_id FROM pages) GROUP BY link HAVING count(*) > 1""",
)
def link_inverted_index(spark, sf_dir):
    rows = url_normalize(spark, sf_dir).select("page_id", F.split_part("link", F.lit("/"), F.lit(1)).alias("link"))
    return resolve.link_index(rows, "page_id", "link").select("link", F.array_join(F.transform("blocks", lambda b: b.cast("string")), "|").alias("page_ids"))


_GRAPH_SQL = """
WITH RECURSIVE e AS (SELECT DISTINCT 'o' || CAST(l_orderkey AS VARCHAR) AS a, 'p' || CAST(l_partkey AS VARCHAR) AS b FROM lineitem WHERE l_quantity >= 49 AND l_discount >= 0.08),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS v, a AS w FROM s UNION SELECT r.v, s.b FROM r JOIN s ON r.w = s.a)
SELECT v AS vertex, min(w) AS component FROM r GROUP BY v"""


def _graph(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").where("l_quantity >= 49 AND l_discount >= 0.08")
    return rows.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("a"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("b"))


@query("block_components", _GRAPH_SQL)
def block_components(spark, sf_dir):
    return components(_graph(spark, sf_dir), "a", "b")


#: Entries: parts with few large, discounted sales; a block is a part's name, links are suppliers.
_F = "l_quantity >= 20 AND l_discount >= 0.08 AND p_size <= 5"
_ENTRY_SQL = f"""
l AS (SELECT DISTINCT p_name AS block, p_partkey AS entry, CAST(l_suppkey AS VARCHAR) AS link FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_F}),
e AS (SELECT DISTINCT p_name AS block, p_partkey AS entry, p_brand AS brand, p_type AS type FROM part WHERE p_partkey IN (SELECT entry FROM l))"""


def _entries(spark, sf_dir):
    sold = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).where(_F)
    links = sold.select(F.col("p_name").alias("block"), F.col("p_partkey").alias("entry"), F.col("l_suppkey").cast("string").alias("link")).distinct()
    rows = sold.select(F.col("p_name").alias("block"), F.col("p_partkey").alias("entry"), "p_brand", "p_type").distinct()
    return rows.select("block", "entry", F.col("entry").alias("ord"), F.col("p_type").alias("name"), F.array("p_brand").alias("source"), F.col("p_type").alias("kind")), links


_CONFLICT_SQL = f"""
WITH {_ENTRY_SQL},
b AS (SELECT block FROM e GROUP BY block HAVING count(*) > 1),
s AS (SELECT block, entry, max(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS shares FROM (SELECT *, count(*) OVER (PARTITION BY block, link) AS c FROM l) GROUP BY block, entry),
r AS (SELECT e.block, e.entry, e.brand, e.type, CASE WHEN s.shares = 1 THEN 'remaining' ELSE 'disconnected' END AS role FROM e JOIN b USING (block) JOIN s USING (block, entry)),
c AS (SELECT r.* FROM r WHERE block IN (SELECT block FROM r WHERE role = 'disconnected'))"""


@query("disconnected_entries", _CONFLICT_SQL + " SELECT block, entry, role FROM c")
def disconnected_entries(spark, sf_dir):
    entries, links = _entries(spark, sf_dir)
    return resolve.detect_conflicts(entries, links).select("block", "entry", "role")


_MERGED_SQL = _CONFLICT_SQL + """,
m AS (SELECT block, entry, brand, type, CASE WHEN role = 'disconnected' AND EXISTS (SELECT 1 FROM c AS k WHERE k.role = 'remaining' AND k.block = c.block AND lower(k.type) = lower(c.type) AND k.brand = c.brand) THEN 'remaining' ELSE role END AS role FROM c)"""


def _conflicts(spark, sf_dir):
    entries, links = _entries(spark, sf_dir)
    found = resolve.detect_conflicts(entries, links).join(entries.select("block", "entry", "source"), ["block", "entry"])
    return resolve.merge_by_source_name(found)


@query("source_name_merge", _MERGED_SQL + " SELECT block, entry, role FROM m")
def source_name_merge(spark, sf_dir):
    return _conflicts(spark, sf_dir).select("block", "entry", "role")


_PAIR_SQL = _MERGED_SQL + """,
g AS (SELECT block, list_sort(list(entry) FILTER (role = 'disconnected')) AS d, list_sort(list(entry) FILTER (role = 'remaining')) AS r FROM m GROUP BY block),
h AS (SELECT block, CASE WHEN len(coalesce(r, [])) > 0 THEN r WHEN len(d) > 1 THEN d[1:1] END AS anchors, CASE WHEN len(coalesce(r, [])) > 0 THEN d WHEN len(d) > 1 THEN d[2:] END AS others FROM g),
p AS (SELECT block, anchors, unnest(others) AS entry, unnest(range(1, len(others) + 1)) AS pair_no FROM h WHERE others IS NOT NULL)"""


@query("pairs_from_conflicts", _PAIR_SQL + " SELECT block, CAST(pair_no AS INTEGER) AS pair_no, entry, array_to_string(anchors, '|') AS anchors FROM p")
def pairs_from_conflicts(spark, sf_dir):
    pairs = resolve.build_pairs(_conflicts(spark, sf_dir))
    return pairs.select("block", "pair_no", "entry", F.array_join(F.transform("anchors", lambda x: x.cast("string")), "|").alias("anchors"))


def _provider(pairs):
    """Verdicts by rule: the remainder of the entry's number."""
    verdict = F.when(F.col("entry").cast("long") % 5 == 0, F.lit("disagreement")).when(F.col("entry").cast("long") % 2 == 0, F.lit("Same")).otherwise(F.lit("Different"))
    return pairs.withColumns({"verdict": verdict, "confidence": F.lit("high")})


def _text_ids(rows):
    return rows.withColumn("entry", F.col("entry").cast("string"))


@query(
    "resolution_records",
    _PAIR_SQL
    + """,
    v AS (SELECT block, max(CASE WHEN entry % 5 = 0 THEN 1 ELSE 0 END) AS open, count(*) FILTER (entry % 2 = 0) AS same, count(*) AS n, any_value(len(anchors)) AS anchors FROM p GROUP BY block),
    x AS (SELECT g.block, len(coalesce(g.r, [])) AS r, len(coalesce(g.d, [])) AS d, v.* EXCLUDE (block) FROM g LEFT JOIN v USING (block))
    SELECT block, CASE WHEN open = 1 THEN 'manual_review_pending' WHEN open IS NULL THEN CASE WHEN r > 0 THEN 'merged' ELSE 'partial' END WHEN n > same THEN 'partial' ELSE 'merged' END AS resolution,
      CAST(CASE WHEN open = 1 THEN 0 WHEN open IS NULL THEN r ELSE anchors + same END AS INTEGER) AS n_merged,
      CAST(CASE WHEN open = 1 THEN r + d WHEN open IS NULL THEN CASE WHEN r > 0 THEN 0 ELSE d END ELSE n - same END AS INTEGER) AS n_unmerged
    FROM x""",
)
def resolution_records(spark, sf_dir):
    conflicts = _text_ids(_conflicts(spark, sf_dir))
    records = resolve.resolution_records(conflicts, _provider(resolve.build_pairs(conflicts)))
    return records.select("block", "resolution", F.size("merged").alias("n_merged"), F.size("unmerged").alias("n_unmerged"))


@query("resolution_rounds")
def resolution_rounds(spark, sf_dir):
    """All rounds: secondary blocks arise from records with several unmerged entries."""
    entries, _ = _entries(spark, sf_dir)
    records = resolve.resolve(_text_ids(entries.select("block", "entry", "ord")), _text_ids(_conflicts(spark, sf_dir)), _provider)
    return records.select("block", "resolution", F.array_join("merged", "|").alias("merged"), F.array_join("unmerged", "|").alias("unmerged"), "source")


@query(
    "recover_blocks",
    f"""
    WITH RECURSIVE {_ENTRY_SQL}, k AS (SELECT e.entry, e.block AS name, e.block || '/' || e.type AS b, l.link FROM e JOIN l USING (entry)),
    s AS (SELECT DISTINCT x.b AS a, y.b AS b FROM k AS x JOIN k AS y ON x.name = y.name AND x.link = y.link),
    r AS (SELECT a AS v, b AS w FROM s UNION SELECT r.v, s.b FROM r JOIN s ON r.w = s.a),
    c AS (SELECT v, count(*) AS n, count(DISTINCT split_part(w, '/', 2)) AS kinds FROM r GROUP BY v)
    SELECT DISTINCT CASE WHEN c.n = 1 OR c.kinds = 1 THEN e.block || '/' || e.type ELSE e.block || '/*' END AS block, e.entry FROM e JOIN c ON c.v = e.block || '/' || e.type""",
)
def recover_blocks(spark, sf_dir):
    """Blocks name/type of parts, united where they share a name and a supplier."""
    entries, links = _entries(spark, sf_dir)
    key = F.concat("block", F.lit("/"), "kind")
    members = entries.select(key.alias("block"), "entry")
    by = links.join(entries.select("entry", key.alias("b")), "entry").select(F.col("b").alias("block"), "link")
    return resolve.recover_blocks(members, by)


@query(
    "group_entities",
    f"""
    WITH RECURSIVE {_ENTRY_SQL}, k AS (SELECT DISTINCT entry, 'k' || lower(brand) || '/' || type AS k FROM e UNION SELECT DISTINCT entry, 'l' || link FROM l),
    s AS (SELECT DISTINCT x.entry AS a, y.entry AS b FROM k AS x JOIN k AS y USING (k)),
    r AS (SELECT a AS v, b AS w FROM s UNION SELECT r.v, s.b FROM r JOIN s ON r.w = s.a),
    c AS (SELECT v, min(w) AS first FROM r GROUP BY v)
    SELECT lower(f.brand) || '/' || f.type AS block, c.v AS entry FROM c JOIN (SELECT DISTINCT entry, brand, type FROM e) f ON f.entry = c.first""",
)
def group_entities(spark, sf_dir):
    """Parts grouped by brand and type, and by shared suppliers of filtered sales."""
    entries, links = _entries(spark, sf_dir)
    return resolve.group_entities(entries, "entry", "ord", resolve.block_key(F.get("source", F.lit(0)), F.col("kind")), links, "entry", "link").select("block", "entry")


@query(
    "shared_link_same_name",
    f"""
    WITH {_ENTRY_SQL}, k AS (SELECT DISTINCT l.link || '#' || substring(e.block, 1, 2) AS link, e.block || '/' || e.type AS b FROM l JOIN e USING (entry))
    SELECT link, array_to_string(list_sort(list(b)), '|') AS blocks FROM k GROUP BY link HAVING count(*) > 1 AND count(DISTINCT split_part(b, '/', 1)) = 1""",
)
def shared_link_same_name(spark, sf_dir):
    entries, links = _entries(spark, sf_dir)
    rows = links.join(entries.select("entry", F.concat("block", F.lit("/"), "kind").alias("b")), "entry")
    rows = rows.withColumn("link", F.concat("link", F.lit("#"), F.substring("b", 1, 2)))
    return resolve.same_name_links(resolve.link_index(rows, "b", "link")).select("link", F.array_join("blocks", "|").alias("blocks"))


@query(
    "verdict_agreement",
    """
    SELECT doc_id, CASE WHEN quality = toxic THEN CAST(quality AS VARCHAR) ELSE 'disagreement' END AS verdict FROM documents LEFT JOIN labels USING (doc_id)""",
)
def verdict_agreement(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", resolve.agree(F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("verdict"))


@query("unresolved_keys", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unresolved_keys(spark, sf_dir):
    return resolve.unresolved(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), "doc_id")


@query("human_override", "SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def human_override(spark, sf_dir):
    return resolve.last_decisions(_t(spark, sf_dir, "conversations"), "conv_id", "turn", ["role", "text"])


@query("pair_estimates", "SELECT CAST(sum(n) AS BIGINT) AS n_first, CAST(sum(CASE WHEN n > 1 THEN n * (n - 1) / 2 END) AS BIGINT) AS n_pairs FROM (SELECT p_name, count(*) AS n FROM part GROUP BY p_name)")
def pair_estimates(spark, sf_dir):
    return resolve.pair_estimates(_t(spark, sf_dir, "part").groupBy("p_name").agg(F.count("*").alias("n")), "n")


@query("blocks_with_several", "SELECT p_name AS block, count(DISTINCT p_type) AS n FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1")
def blocks_with_several(spark, sf_dir):
    return resolve.blocks_with_several(_t(spark, sf_dir, "part"), "p_name", F.col("p_type"))


@query("repeated_keys", "SELECT text AS key, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return resolve.repeated_keys(_t(spark, sf_dir, "documents"), F.col("text"))


# --- merging ---------------------------------------------------------------


@query(
    "merge_first_and_union",
    """
    SELECT source, any_value(first_lang) AS name, array_to_string(list_sort(list(DISTINCT lang) FILTER (lang <> first_lang)), '|') AS other_names, count(*) AS n
    FROM (SELECT *, arg_min(lang, doc_id) OVER (PARTITION BY source) AS first_lang FROM documents) GROUP BY source""",
)
def merge_first_and_union(spark, sf_dir):
    name, others = merge.names(F.col("lang"), F.col("doc_id"))
    g = _t(spark, sf_dir, "documents").groupBy("source").agg(name, others, F.count("*").alias("n"))
    return g.select("source", "name", F.when(F.size("other_names") > 0, F.array_join("other_names", "|")).alias("other_names"), "n")


@query("merge_union", "SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities, bool_or(o_orderstatus = 'F') AS any_final FROM orders GROUP BY o_custkey")
def merge_union(spark, sf_dir):
    g = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(merge.set_union(F.array("o_orderpriority")).alias("p"), F.bool_or(F.col("o_orderstatus") == "F").alias("any_final"))
    return g.select("o_custkey", F.array_join("p", "|").alias("priorities"), "any_final")


@query(
    "merge_one_per_key",
    """
    WITH x AS (SELECT l_orderkey, l_returnflag, l_linestatus, arg_min(l_partkey, l_linenumber * 100000000 + l_partkey) AS part, min(l_linenumber * 100000000 + l_partkey) AS place FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, string_agg(l_returnflag || l_linestatus || CAST(part AS VARCHAR), '|' ORDER BY place, l_returnflag, l_linestatus) AS items FROM x GROUP BY l_orderkey""",
)
def merge_one_per_key(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 100000000 + F.col("l_partkey")).alias("ord"), F.array(F.struct("l_returnflag", "l_linestatus", F.col("l_partkey").cast("string").alias("part"))).alias("items"))
    kept = merge.one_per_key(rows, "l_orderkey", "ord", "items", ["l_returnflag", "l_linestatus"], {"part": "first"}, "items")
    return kept.select("l_orderkey", F.array_join(F.transform("items", lambda x: F.concat(x["l_returnflag"], x["l_linestatus"], x["part"])), "|").alias("items"))


@query("merge_longest_text", "SELECT source, lang, arg_min(doc_id, (-length(text), doc_id)) AS doc_id FROM documents GROUP BY source, lang")
def merge_longest_text(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    rows = d.select("source", "doc_id", F.array(F.struct("lang", F.col("text"))).alias("items"))
    kept = merge.one_per_key(rows, "source", "doc_id", "items", ["lang"], {"text": "longest"}, "items").select("source", F.explode("items").alias("x")).select("source", "x.lang", "x.text")
    return kept.join(d.groupBy("source", "lang", "text").agg(F.min("doc_id").alias("doc_id")), ["source", "lang", "text"]).select("source", "lang", "doc_id")


@query("keyed_upsert", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT c_custkey + 1000000, c_acctbal FROM customer WHERE c_nationkey = 1")
def keyed_upsert(spark, sf_dir):
    old = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    raised = old.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    added = _t(spark, sf_dir, "customer").where("c_nationkey = 1").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_acctbal")
    return documents.upsert(old, raised.union(added), "c_custkey")


@query("keyed_lines", "SELECT CAST(user_id AS VARCHAR) AS key, arg_max(event_type, event_id) AS value FROM events GROUP BY user_id")
def keyed_lines(spark, sf_dir):
    """Events as JSON lines {user: type}; the last line of a user counts."""
    events = _t(spark, sf_dir, "events").withColumn("user", F.col("user_id").cast("string"))
    lines = events.select(documents.keyed_line("user", "event_type").alias("value"), F.col("event_id").alias("line_no"))
    return documents.keyed_lines(lines, "string")


# --- publications ----------------------------------------------------------

_PUBS = "SELECT doc_id, text AS title, CASE WHEN n_chars % 7 = 0 THEN '10.1000/' || CAST(n_chars AS VARCHAR) END AS doi FROM documents"


def _pubs(spark, sf_dir):
    none = F.lit(None).cast("string")
    doi = F.when(F.col("n_chars") % 7 == 0, F.concat(F.lit("10.1000/"), F.col("n_chars").cast("string")))
    return _t(spark, sf_dir, "documents").select("doc_id", doi.alias("doi"), F.col("text").alias("title"), none.alias("url"), none.alias("pmid"), none.alias("pmcid"))


@query(
    "publication_lookup",
    f"""
    WITH p AS ({_PUBS}), d AS (SELECT doi, min(doc_id) AS i FROM p WHERE doi IS NOT NULL GROUP BY doi), t AS (SELECT title, min(doc_id) AS i FROM p GROUP BY title)
    SELECT doc_id, coalesce(d.i, t.i) AS known_id FROM p LEFT JOIN d USING (doi) LEFT JOIN t USING (title)""",
)
def publication_lookup(spark, sf_dir):
    p = _pubs(spark, sf_dir)
    return publications.look_up(p, p, "doc_id", "doc_id").select("doc_id", "known_id")


@query(
    "publication_dedup",
    f"""
    WITH RECURSIVE p AS ({_PUBS}), k AS (SELECT doc_id, 'd' || doi AS k FROM p WHERE doi IS NOT NULL UNION ALL SELECT doc_id, 't' || title FROM p),
    s AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM k AS a JOIN k AS b USING (k)),
    r AS (SELECT a AS v, b AS w FROM s UNION SELECT r.v, s.b FROM r JOIN s ON r.w = s.a)
    SELECT v AS id, min(w) AS publication FROM r GROUP BY v""",
)
def publication_dedup(spark, sf_dir):
    return publications.deduplicate(_pubs(spark, sf_dir), "doc_id")


# --- statistics ------------------------------------------------------------


@query(
    "counts_zero_filled",
    "SELECT l.label, count(e.event_type) AS n FROM (SELECT DISTINCT event_type AS label FROM events UNION SELECT 'nothing') l LEFT JOIN events e ON e.event_type = l.label GROUP BY 1",
)
def counts_zero_filled(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    labels = events.select(F.col("event_type").alias("label")).union(spark.range(1).select(F.lit("nothing"))).distinct()
    counts = events.groupBy(F.col("event_type").alias("label")).agg(F.count("event_type").alias("n"))
    return labels.join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "coverage_histogram",
    """
    WITH u AS (SELECT user_id, CAST(ts AS DATE) AS d, count(DISTINCT event_type) AS c FROM events GROUP BY ALL),
    b AS (SELECT CAST(g AS INTEGER) AS bucket, count(u.c) AS n FROM range(1, 10) t(g) LEFT JOIN u ON u.c = g GROUP BY g)
    SELECT bucket, n, CAST(sum(n) OVER (ORDER BY bucket) AS BIGINT) AS running FROM b""",
)
def coverage_histogram(spark, sf_dir):
    per = _t(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts")).agg(F.countDistinct("event_type").alias("c"))
    return statistics.coverage(per, "c")


def _labelled(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", "lang", "text").join(_t(spark, sf_dir, "labels"), "doc_id", "left")


@query(
    "feature_presence",
    """
    SELECT lang, f.feature, avg(CASE f.feature WHEN 'quality' THEN CASE WHEN coalesce(quality, 0) <> 0 THEN 1 ELSE 0 END WHEN 'toxic' THEN CASE WHEN coalesce(toxic, 0) <> 0 THEN 1 ELSE 0 END ELSE CASE WHEN text IN ('', 'None', 'unknown') THEN 0 ELSE 1 END END) AS share
    FROM documents LEFT JOIN labels USING (doc_id), (VALUES ('quality'), ('toxic'), ('text')) f(feature) GROUP BY ALL""",
)
def feature_presence(spark, sf_dir):
    return statistics.feature_presence(_labelled(spark, sf_dir), ["quality", "toxic", "text"], ["lang"])


@query(
    "feature_counts",
    """
    WITH c AS (SELECT 1 + CASE WHEN quality IS NULL THEN 0 ELSE 1 END + CASE WHEN toxic IS NULL THEN 0 ELSE 1 END AS n_features, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
    SELECT n_features, n, n / sum(n) OVER () AS share, sum(n) OVER (ORDER BY n_features) / sum(n) OVER () AS running_share FROM c""",
)
def feature_counts(spark, sf_dir):
    return statistics.feature_counts(_labelled(spark, sf_dir), ["text", "quality", "toxic"])


@query("type_share", "SELECT p_type AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM part GROUP BY p_type")
def type_share(spark, sf_dir):
    return statistics.value_share(_t(spark, sf_dir, "part"), F.col("p_type"))


_CLASS_SQL = """CASE WHEN contains(l, 'unlicensed') OR contains(l, 'unknown') OR contains(l, 'unlicense') THEN 'unlicensed' WHEN contains(l, 'agpl') OR contains(l, 'affero') THEN 'AGPL' WHEN contains(l, 'lgpl') THEN 'LGPL'
 WHEN contains(l, 'gpl') OR contains(l, 'gnu') THEN 'GPL' WHEN contains(l, 'artistic') THEN 'Artistic' WHEN contains(l, 'mit') THEN 'MIT' WHEN contains(l, 'apache') THEN 'Apache' WHEN contains(l, 'bsd') THEN 'BSD' WHEN contains(l, 'afl') THEN 'AFL'
 WHEN contains(n, 'CC') OR contains(l, 'creative commons') THEN 'CC' WHEN contains(l, 'creativecommons.org') THEN 'not-software' WHEN contains(l, 'cecill') THEN 'CeCILL' ELSE 'other' END"""
_LICENCE_SQL = r"""
n AS (SELECT * FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS n FROM documents) WHERE regexp_matches(n, '[Ll]icense')),
k AS (SELECT doc_id, source, n, lower(n) AS l FROM n)"""


def _licence_lines(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", "source", F.filter(F.split("text", "\n"), lambda x: x.rlike("[Ll]icense")).alias("names"))


@query("licence_class", f"WITH {_LICENCE_SQL} SELECT {_CLASS_SQL} AS class, count(*) AS n FROM k GROUP BY 1")
def licence_class(spark, sf_dir):
    rows = _licence_lines(spark, sf_dir).select(F.explode("names").alias("n"))
    return rows.groupBy(licensing.licence_class(F.col("n")).alias("class")).agg(F.count("*").alias("n"))


_VERDICT_SQL = f"""WITH {_LICENCE_SQL}, c AS (SELECT doc_id, list(DISTINCT class) FILTER (class <> 'unlicensed') AS r FROM (SELECT doc_id, {_CLASS_SQL} AS class FROM k) GROUP BY doc_id),
v AS (SELECT d.doc_id, CASE WHEN coalesce(len(r), 0) = 0 THEN 'None' WHEN len(r) = 1 THEN 'Unambiguous' ELSE 'Ambiguous' END AS verdict, CASE WHEN len(r) = 1 THEN r[1] END AS class FROM documents d LEFT JOIN c USING (doc_id))"""


@query("licence_verdicts", _VERDICT_SQL + " SELECT * FROM v")
def licence_verdicts(spark, sf_dir):
    return statistics.licence_verdicts(_licence_lines(spark, sf_dir), "doc_id", "names")


@query(
    "licence_summary",
    _VERDICT_SQL
    + """ SELECT id, parent, CASE id WHEN 'Total' THEN (SELECT count(*) FROM v) WHEN 'Open Source' THEN (SELECT count(*) FROM v WHERE verdict = 'Unambiguous' AND class <> 'other') WHEN 'other' THEN (SELECT count(*) FROM v WHERE class = 'other')
      ELSE (SELECT count(*) FROM v WHERE verdict = id) END AS n FROM (VALUES ('Total', ''), ('None', 'Total'), ('Unambiguous', 'Total'), ('Open Source', 'Unambiguous'), ('other', 'Unambiguous'), ('Ambiguous', 'Total')) h(id, parent)""",
)
def licence_summary(spark, sf_dir):
    return statistics.licence_summary(licence_verdicts(spark, sf_dir))


@query("open_source_licences", _VERDICT_SQL + " SELECT CASE WHEN class IN ('Artistic', 'MIT', 'Apache', 'BSD') THEN 'permissive' WHEN class = 'CC' THEN 'data' ELSE 'copyleft' END AS licence_group, class, count(*) AS n FROM v WHERE class IN ('Artistic', 'MIT', 'Apache', 'BSD', 'GPL', 'LGPL', 'AGPL', 'CeCILL', 'CC') GROUP BY ALL")
def open_source_licences(spark, sf_dir):
    return statistics.open_source_licences(licence_verdicts(spark, sf_dir))


@query(
    "version_scheme",
    """
    WITH v AS (SELECT p_partkey, unnest([CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN '1.' || CAST(p_size AS VARCHAR) ELSE p_brand END, CASE WHEN p_size > 40 THEN 'v1' ELSE 'unknown' END, p_type]) AS v FROM part),
    c AS (SELECT p_partkey, count(*) FILTER (v IS NULL OR trim(v) = '' OR lower(v) = 'unknown') AS n, count(*) FILTER (lower(v) <> 'unknown' AND trim(v) <> '' AND (lower(v) = 'v1' OR contains(v, '.'))) AS s, count(*) AS t FROM v GROUP BY p_partkey)
    SELECT p_partkey, CASE WHEN s >= t - n - s AND s >= n THEN 'Semantic' WHEN t - n - s >= n THEN 'Other' ELSE 'None' END AS scheme FROM c""",
)
def version_scheme(spark, sf_dir):
    size = F.col("p_size")
    first = F.when(size % 3 == 1, F.concat(F.lit("1."), size.cast("string"))).when(size % 3 == 2, F.col("p_brand"))
    versions = F.array(first, F.when(size > 40, F.lit("v1")).otherwise(F.lit("unknown")), F.col("p_type"))
    return _t(spark, sf_dir, "part").select("p_partkey", statistics.version_scheme(versions).alias("scheme"))


@query(
    "journal_impact_topk",
    """
    SELECT s_name AS journal, CAST(sum(CASE WHEN year(l_shipdate) IN (1995, 1996, 1997) THEN CAST(floor(l_quantity) AS BIGINT) ELSE 0 END) AS BIGINT) AS impact, count(*) AS n_publications
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name ORDER BY impact DESC, journal LIMIT 10""",
)
def journal_impact_topk(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    count = F.create_map(F.year("l_shipdate").cast("string"), F.floor("l_quantity"))
    rows = rows.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("s_name").alias("journal"), F.array(F.struct(F.lit(statistics.IMPACT_SOURCE).alias("source"), count.alias("count"))).alias("citations"))
    impact = statistics.journal_impact(rows, "id", "journal", "citations", ["1995", "1996", "1997"])
    return statistics.top_journals(impact)


def _scores(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", F.lit("_d")).alias("d"), F.concat("l_returnflag", F.lit("_t")).alias("t"), "l_discount", "l_tax")
    both = F.array(F.struct(F.col("d").alias("indicator"), F.col("l_discount").alias("score")), F.struct(F.col("t").alias("indicator"), F.col("l_tax").alias("score")))
    return rows.select(F.explode(both).alias("x")).select("x.*")


_SCORE_SQL = "(SELECT l_returnflag || '_d' AS indicator, l_discount AS score FROM lineitem UNION ALL SELECT l_returnflag || '_t', l_tax FROM lineitem)"


@query("indicator_frequency", f"SELECT indicator, score, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY indicator) AS share FROM {_SCORE_SQL} GROUP BY indicator, score")
def indicator_frequency(spark, sf_dir):
    return statistics.indicator_frequency(_scores(spark, sf_dir))


@query("indicator_mean", f"SELECT indicator, round(avg(score), 4) AS mean FROM {_SCORE_SQL} GROUP BY indicator")
def indicator_mean(spark, sf_dir):
    return statistics.indicator_mean(_scores(spark, sf_dir))


@query(
    "fixed_size_bins",
    "SELECT CAST(floor((r - 1) / 700) AS BIGINT) AS bin, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r FROM orders) GROUP BY 1",
)
def fixed_size_bins(spark, sf_dir):
    return statistics.fixed_size_bins(_t(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey").withColumn("mean", F.round("mean", 4))


@query("normalised_share", "SELECT count(*) AS n, count(*) FILTER (starts_with(url, 'https://')) AS n_normalised, count(*) FILTER (starts_with(url, 'https://')) / count(*) AS share FROM pages")
def normalised_share(spark, sf_dir):
    return statistics.normalised_share(_t(spark, sf_dir, "pages"), licensing.is_normalised_licence(F.col("url"), "https://"))


@query("collection_counts", "SELECT 'tools' AS collection, count(*) AS n_tools FROM part UNION ALL SELECT p_type, count(*) FROM part WHERE p_type IN (SELECT min(p_type) FROM part UNION SELECT max(p_type) FROM part) GROUP BY p_type")
def collection_counts(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    ends = part.agg(F.min("p_type"), F.max("p_type")).first()
    return statistics.count_rows(statistics.collections(part.withColumn("tags", F.array("p_type")), "tags", [*ends]), ["collection"])


# --- text ------------------------------------------------------------------


@query(
    "description_normalize",
    "SELECT doc_id, CASE WHEN t = '' THEN NULL ELSE upper(substring(t, 1, 1)) || substring(t, 2) || CASE WHEN ends_with(t, '.') THEN '' ELSE '.' END END AS description FROM (SELECT doc_id, trim(split_part(text, chr(10), 1), ' ') AS t FROM documents)",
)
def description_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.normalize_description(F.split_part("text", F.lit("\n"), F.lit(1))).alias("description"))


@query(
    "linebreaks",
    r"SELECT page_id, regexp_replace(regexp_replace(replace(replace(html, '\n', chr(10)), chr(13) || chr(10), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^[ \t\n\v\f\r]+|[ \t\n\v\f\r]+$', '', 'g') AS html FROM pages",
)
def linebreaks(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", text.normalize_linebreaks(F.col("html")).alias("html"))


@query("html_main_text")
def html_main_text(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", text.html_main_text(F.col("html")).alias("main_text"))


@query(
    "token_chunks",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, i, len(x) AS n FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM (SELECT doc_id, regexp_extract_all(text, '[^ \t\n\v\f\r]+') AS w FROM documents))),
    c AS (SELECT doc_id, i, CAST(0 AS INTEGER) AS chunk, CAST(n AS BIGINT) AS size FROM w WHERE i = 1
      UNION ALL SELECT w.doc_id, w.i, CASE WHEN c.size + 1 + w.n <= 800 THEN c.chunk ELSE c.chunk + 1 END, CASE WHEN c.size + 1 + w.n <= 800 THEN c.size + 1 + w.n ELSE w.n END FROM c JOIN w ON w.doc_id = c.doc_id AND w.i = c.i + 1)
    SELECT doc_id, chunk, CAST(max(size) AS INTEGER) AS n_chars FROM c GROUP BY doc_id, chunk""",
)
def token_chunks(spark, sf_dir):
    """Chunks of up to 200 tokens of every document."""
    chunks = _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.chunk_words(F.col("text"), 200)).alias("chunk", "words"))
    return chunks.select("doc_id", "chunk", F.length("words").alias("n_chars"))


@query("token_counts", "SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE CAST(ceil(length(text) / 4) AS BIGINT) END AS n_tokens FROM documents")
def token_counts(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("n_tokens"))


@query("entry_ids", "SELECT p_partkey, 'biotools/' || p_name || '/' || CASE WHEN p_size > 25 THEN p_type ELSE 'None' END || '/None' AS id FROM part")
def entry_ids(spark, sf_dir):
    kind = F.when(F.col("p_size") > 25, F.col("p_type"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.entry_id(F.lit("biotools"), F.col("p_name"), kind, F.lit(None)).alias("id"))


# --- names, vocabularies, validity -----------------------------------------


@query(
    "vocabulary_lookup",
    """
    WITH d AS (SELECT lower(n_name) AS low, arg_min(n_nationkey, n_nationkey) AS uri FROM nation GROUP BY 1), q AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '  ' || n_name WHEN c_custkey % 3 = 1 THEN lower(n_name) ELSE 'nowhere' END AS term FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_custkey, CAST(d.uri AS VARCHAR) AS uri FROM q LEFT JOIN d ON lower(ltrim(q.term)) = d.low""",
)
def vocabulary_lookup(spark, sf_dir):
    """Terms of customers looked up in the dimension of nations, cases and leading blanks apart."""
    from spindrift.sources.standardize import FORMAT, with_vocabulary

    nation = _t(spark, sf_dir, "nation")
    words = nation.select(F.col("n_nationkey").cast("string").alias("uri"), F.col("n_name").alias("label"), F.col("n_nationkey").alias("ord"))
    term = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("  "), "n_name")).when(F.col("c_custkey") % 3 == 1, F.lower("n_name")).otherwise(F.lit("nowhere"))
    none = F.lit(None).cast("string")
    rows = _t(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.array(F.struct(none.alias("vocabulary"), term.alias("term"), none.alias("uri"), F.lit(None).alias("datatype"))).cast(FORMAT).alias("x"))
    found = with_vocabulary(rows, "x", words, "c_custkey")
    return found.select("c_custkey", F.get("x", F.lit(0))["uri"].alias("uri"))


@query("format_synonyms", "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'Textual format' WHEN 1 THEN 'TSV' WHEN 2 THEN 'YAML' WHEN 3 THEN p_type ELSE '' END AS format FROM part")
def format_synonyms(spark, sf_dir):
    size = F.col("p_size") % 5
    term = F.when(size == 0, F.lit(" txt")).when(size == 1, F.lit("Tabular")).when(size == 2, F.lit("yml")).when(size == 3, F.col("p_type"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.normalize_format(term).alias("format"))


@query(
    "monitor_ids",
    "SELECT p_partkey, p_name AS name, CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS version, p_type AS type FROM part WHERE p_size % 2 = 0",
)
def monitor_ids(spark, sf_dir):
    plus = F.when(F.col("p_size") > 25, F.concat("p_name", F.lit(":"), F.col("p_size").cast("string"))).otherwise(F.col("p_name"))
    address = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://host/monitor/tool/biotools:"), plus, F.lit("/"), "p_type", F.lit("/end"))).otherwise(F.lit("https://host/short"))
    rows = _t(spark, sf_dir, "part").select("p_partkey", text.monitor_id(address).alias("m"))
    return rows.where("m IS NOT NULL").select("p_partkey", "m.name", "m.version", "m.type")


def _raw_parts(spark, sf_dir):
    """Raw documents made of parts: half from one source, half from another."""
    p = _t(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") % 2 == 0, F.lit("biotools")).otherwise(F.lit("galaxy_metadata"))
    a = F.to_json(F.struct(F.concat("p_name", F.col("p_partkey").cast("string")).alias("@label"), F.lit("web").alias("@type"), F.col("p_size").cast("string").alias("@version"), F.col("p_name").alias("name"), F.col("p_brand").alias("description"), F.array(F.lit("Linux"), F.when(F.col("p_size") > 40, F.lit("OS/2"))).alias("os")))
    b = F.to_json(F.struct(F.when(F.col("p_size") > 3, F.concat("p_name", F.col("p_partkey").cast("string"))).alias("id"), F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("version")))
    return p.select(F.col("p_partkey").cast("string").alias("_id"), kind.alias("data_source"), F.lit(None).cast("string").alias("source_url"), F.when(F.col("p_size") % 2 == 0, a).otherwise(b).alias("data"))


@query(
    "standardized_entries",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, CASE WHEN p_size % 2 = 0 THEN 'biotools/' ELSE 'galaxy_metadata/' END || p_name || CAST(p_partkey AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN '/web/' ELSE '/cmd/' END || CAST(p_size AS VARCHAR) AS id,
      CASE WHEN p_size % 2 = 0 AND p_size <= 40 THEN 1 ELSE 0 END AS n_systems, CASE WHEN p_size % 2 = 0 THEN p_brand || '.' ELSE '' END AS description
    FROM part WHERE p_size % 2 = 0 OR p_size > 3""",
)
def standardized_entries(spark, sf_dir):
    from spindrift.sources.standardize import standardize

    rows = standardize(_raw_parts(spark, sf_dir), ["biotools", "galaxy_metadata"])
    return rows.select("_id", "id", F.size("operating_system").alias("n_systems"), F.array_join("description", "").alias("description"))


@query("rejected_documents", "SELECT CAST(p_partkey AS VARCHAR) AS _id, 'galaxy_metadata' AS data_source FROM part WHERE p_size % 2 = 1 AND p_size <= 3")
def rejected_documents(spark, sf_dir):
    from spindrift.sources.standardize import quarantine

    return quarantine(_raw_parts(spark, sf_dir), ["biotools", "galaxy_metadata"])


@query(
    "provenance_upsert",
    "SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 10 = 0 THEN 't1' ELSE 't0' END AS last_updated_at, CASE WHEN c_custkey >= 1000000 THEN 't1' ELSE 't0' END AS created_at FROM (SELECT c_custkey, c_mktsegment FROM customer UNION ALL SELECT c_custkey + 1000000 - c_custkey % 10, c_mktsegment FROM customer WHERE c_custkey % 50 = 7)",
)
def provenance_upsert(spark, sf_dir):
    stamp = lambda t: {c: F.lit(t) for c in ("created_at", "created_by", "created_logs", "last_updated_at", "updated_by", "updated_logs")}
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    added = c.where("c_custkey % 50 = 7").select((F.col("c_custkey") + 1000000 - F.col("c_custkey") % 10).alias("c_custkey"), "c_mktsegment")
    new = c.where("c_custkey % 10 = 0").union(added)
    done = documents.upsert_provenance(c.withColumns(stamp("t0")), new, "c_custkey", F.lit("t1"), F.lit("t1"), F.lit("t1"))
    return done.select("c_custkey", "c_mktsegment", "last_updated_at", "created_at")


@query(
    "source_coverage",
    """
    WITH l AS (SELECT o_custkey, list(DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'bioconda' WHEN '2-HIGH' THEN 'bioconda' WHEN '3-MEDIUM' THEN 'github' WHEN '4-NOT SPECIFIED' THEN 'toolshed' END) FILTER (o_orderpriority <> '5-LOW') AS s FROM orders GROUP BY o_custkey)
    SELECT s.label, count(l.o_custkey) AS n FROM (VALUES ('bioconda'), ('github'), ('toolshed'), ('galaxy')) s(label) LEFT JOIN l ON list_contains(l.s, s.label) GROUP BY 1""",
)
def source_coverage(spark, sf_dir):
    """Customers by the labels of their order priorities, taken as sources; several sources share a label, one has none."""
    names = {"1-URGENT": "bioconda", "2-HIGH": "bioconda", "3-MEDIUM": "github", "4-NOT SPECIFIED": "toolshed", "never": "galaxy"}
    g = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("s"))
    return statistics.tools_per_source(g, "s", names)


@query("secondary_blocks")
def secondary_blocks(spark, sf_dir):
    """New blocks for records that leave several entries unmerged."""
    conflicts = _text_ids(_conflicts(spark, sf_dir))
    apart = lambda pairs: pairs.withColumns({"verdict": F.lit("different"), "confidence": F.lit("low")})
    return resolve.secondary_conflicts(resolve.resolution_records(conflicts, apart(resolve.build_pairs(conflicts)))).select("block", "entry", "ord", "role")


@query("resolution_funnel")
def resolution_funnel(spark, sf_dir):
    entries, _ = _entries(spark, sf_dir)
    return resolve.funnel(resolve.resolve(_text_ids(entries.select("block", "entry", "ord")), _text_ids(_conflicts(spark, sf_dir)), _provider))


@query("replies_parsed", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'Same' END AS verdict FROM conversations")
def replies_parsed(spark, sf_dir):
    """Verdicts in fenced blocks of replies; a reply without one gives null."""
    reply = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("So:\n```json\n{\"verdict\": \"Same\", \"confidence\": \"high\"}\n```\n"), F.replace(F.replace("text", F.lit("{"), F.lit("(")), F.lit("}"), F.lit(")")))).otherwise(F.lit("no verdict"))
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", text.fenced_json(reply, "verdict string, confidence string")["verdict"].alias("verdict"))


@query(
    "completeness_share",
    "SELECT doc_id, (CASE WHEN text IN ('', 'None', 'unknown') THEN 0 ELSE 1 END + CASE WHEN lang IN ('', 'None', 'unknown') THEN 0 ELSE 1 END + CASE WHEN coalesce(quality, 0) <> 0 THEN 1 ELSE 0 END) / 4 AS score FROM documents LEFT JOIN labels USING (doc_id)",
)
def completeness_share(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return rows.select("doc_id", statistics.share_complete(rows, ["text", "lang", "quality", "absent"]).alias("score"))


@query("issue_texts")
def issue_texts(spark, sf_dir):
    """What a reviewer sees of the blocks in conflict, parts taken as entries."""
    from spindrift.operators import reviews
    from spindrift.sources.standardize import AUTHOR, LICENCE, REPOSITORY

    entries, _ = _entries(spark, sf_dir)
    blank = lambda t: F.array().cast(t)
    shown = _text_ids(entries).select(F.col("entry").alias("id"), "name", F.array("block").alias("description"), F.array(F.concat(F.lit("https://example.org/"), "entry")).alias("webpage"), blank(REPOSITORY).alias("repository"), blank(LICENCE).alias("license"), blank(AUTHOR).alias("authors"))
    return reviews.issue_texts(_text_ids(_conflicts(spark, sf_dir)), shown)
