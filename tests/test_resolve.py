import random

import pytest
from pyspark.sql import functions as F

from spindrift.operators import resolve as R
from spindrift.operators.components import components


@pytest.mark.parametrize("small", [0, 100_000])
def test_components_against_union_find(spark, monkeypatch, small):
    monkeypatch.setattr("spindrift.operators.components.SMALL", small)
    r = random.Random(1)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7), (999, 999), (None, 3), (5, None)]
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = [(x.vertex, x.component) for x in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()]
    assert len(found) == len(parent) and dict(found) == {a: root(a) for a in parent}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
    named = [(None if a is None else f"v{a:04}é", None if b is None else f"v{b:04}é") for a, b in edges]
    found = dict((x.vertex, x.component) for x in components(spark.createDataFrame(named, "a string, b string"), "a", "b").collect())
    assert found == {f"v{a:04}é": f"v{root(a):04}é" for a in parent}


def test_hubs_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr("spindrift.operators.components.SMALL", 0)
    monkeypatch.setattr("spindrift.operators.components.HUB", 7)
    edges = [(0, k) for k in range(1, 60)] + [(100 + k, 101 + k) for k in range(30)]
    found = dict((x.vertex, x.component) for x in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert found == {k: 0 for k in range(60)} | {k: 100 for k in range(100, 131)}


def group(spark, entries, links):
    rows = spark.createDataFrame(entries, "id string, ord int, name string, type string")
    at = spark.createDataFrame(links, "e string, l string")
    out = {}
    for r in R.group_entities(rows, "id", "ord", R.block_key(F.col("name"), F.col("type")), at, "e", "l").collect():
        out.setdefault(r.block, set()).add(r.entry)
    return out


def test_a_bridge_joins_blocks_also_through_absorbed_ones(spark):
    entries = [("e1", 1, "A", "cmd"), ("e2", 2, "B", "cmd"), ("e3", 3, "C", "cmd"), ("e4", 4, "D", "cmd"), ("e5", 5, "E", None), ("e6", 6, "F", "undefined")]
    links = [("e1", "L1"), ("e2", "L2"), ("e2", "L4"), ("e3", "L1"), ("e3", "L2"), ("e4", "L3"), ("e5", "L3"), ("e5", "L4")]
    assert group(spark, entries, links) == {"a/cmd": {"e1", "e2", "e3", "e4", "e5"}, "f/*": {"e6"}}


def test_recovery(spark):
    members = spark.createDataFrame([("a/cmd", "1"), ("a/web", "2"), ("a/lib", "3"), ("b/cmd", "4"), ("a/*", "5"), ("c/cmd", "6"), ("c/*", "7")], "block string, entry string")
    links = spark.createDataFrame([("a/cmd", "x"), ("a/web", "x"), ("b/cmd", "x"), ("c/cmd", "y"), ("c/*", "y"), ("a/lib", "z")], "block string, link string")
    assert {(r.block, r.entry) for r in R.recover_blocks(members, links).collect()} == {("a/*", "1"), ("a/*", "2"), ("a/*", "5"), ("a/lib", "3"), ("b/cmd", "4"), ("c/*", "6"), ("c/*", "7")}
    assert R.recover_blocks(members.limit(0), links.limit(0)).count() == 0


def entries_of(spark, rows):
    return spark.createDataFrame(rows, "block string, entry string, ord int, name string, source array<string>")


def test_conflicts(spark):
    e = entries_of(spark, [
        ("x", "1", 1, "t", ["biotools"]), ("x", "2", 2, "t", ["github"]), ("x", "3", 3, "t", ["sourceforge"]), ("x", "4", 4, "t", ["opeb_metrics"]), ("x", "5", 5, "t", ["github"]),
        ("g", "6", 1, "n", ["galaxy"]), ("g", "7", 2, "N ", ["toolshed"]), ("one", "8", 1, "n", ["github"]),
        ("h", "9", 1, "n", ["galaxy"]), ("h", "10", 2, "other", ["galaxy"]), ("h", "11", 3, "q", ["github"]),
    ])
    links = spark.createDataFrame([("x", "1", "a"), ("x", "2", "a"), ("x", "3", "b"), ("h", "9", "p"), ("h", "10", "q"), ("h", "11", "r")], "block string, entry string, link string")
    found = {r.entry: r.role for r in R.detect_conflicts(e, links).collect()}
    assert found == {"1": "remaining", "2": "remaining", "3": "disconnected", "5": "disconnected", "9": "remaining", "10": "disconnected", "11": "disconnected"}
    kept = {r.entry: r.role for r in R.detect_conflicts(e, links, keep_linkless=True).collect()}
    assert kept["5"] == "remaining"
    merged = R.merge_by_source_name(R.detect_conflicts(e, links).join(e.select("block", "entry", "source"), ["block", "entry"]))
    assert {r.entry: r.role for r in merged.collect()} == {**found, "5": "remaining"}


CASES = {
    "1x2": (["d"], ["r1", "r2"], ["r1", "r2"], ["d"], "partial"), "1x3": (["d"], ["r1", "r2", "r3"], ["r1", "r2", "r3"], ["d"], "partial"), "2x1": (["d", "r1"], ["r2"], ["r2"], ["d", "r1"], "partial"),
    "2x0": (["d", "r1"], [], ["d"], ["r1"], "partial"), "0x2": ([], ["r1", "r2"], ["r1", "r2"], [], "merged"), "1x0": (["d"], [], [], ["d"], "partial"),
}


def conflict_table(spark, cases):
    rows = [(k, f"s/{x}/cmd", n, role) for k, (d, r, *_) in cases.items() for role, ids in (("disconnected", d), ("remaining", r)) for n, x in enumerate(ids)]
    return spark.createDataFrame(rows, "block string, entry string, ord int, role string")


def verdict(word):
    return lambda pairs: pairs.withColumns({"verdict": F.lit(word), "confidence": F.lit("high")})


def test_golden_cases(spark):
    conflicts = conflict_table(spark, CASES)
    records = {r.block: r for r in R.resolution_records(conflicts, verdict("Different")(R.build_pairs(conflicts))).collect()}
    short = lambda ids: [x.split("/")[1] for x in ids]
    assert {k: (short(r.merged), short(r.unmerged), r.resolution) for k, r in records.items()} == {k: (m, u, x) for k, (_, _, m, u, x) in CASES.items()}
    assert records["1x2"].notes and records["2x1"].notes is None


@pytest.mark.parametrize("word,resolution", [("same", "merged"), ("SAME", "merged"), ("unclear", "partial"), ("disagreement", "manual_review_pending")])
def test_verdicts(spark, word, resolution):
    conflicts = conflict_table(spark, {"b": (["d"], ["r"])})
    r = R.resolution_records(conflicts, verdict(word)(R.build_pairs(conflicts))).first()
    assert r.resolution == resolution and sorted(r.merged + r.unmerged) == ["s/d/cmd", "s/r/cmd"]


@pytest.mark.parametrize("a,b,want", [("same", "same", "same"), ("different", "same", "disagreement"), ("same", None, "disagreement"), (None, None, "disagreement"), ("Same", "same", "disagreement")])
def test_agreement(spark, a, b, want):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(R.agree(F.col("a"), F.col("b")).alias("x")).first().x == want


def test_rounds_end(spark):
    conflicts = conflict_table(spark, {"b": (["d1", "d2", "d3"], ["r"])})
    blocks = conflicts.select("block", "entry", "ord").union(spark.createDataFrame([("c", "s/c/cmd", 0)], "block string, entry string, ord int"))
    records = {r.block: r for r in R.resolve(blocks, conflicts, verdict("different")).collect()}
    assert {k: len(r.unmerged) for k, r in records.items()} == {"c": 0, "b": 3, "b_secondary_1": 2, "b_secondary_1_secondary_1": 1}
    assert records["c"].resolution == "no_conflict"
    pending = R.resolve(blocks, conflicts, verdict("disagreement"))
    assert {r.block: r.resolution for r in pending.collect()} == {"c": "no_conflict", "b": "manual_review_pending"}
    again = R.resolve(blocks, conflicts, verdict("same"), solved=spark.createDataFrame([("b",)], "block string"))
    assert {r.block for r in again.collect()} == {"c"}


def test_human(spark):
    conflicts = conflict_table(spark, {k: (["d"], ["r"]) for k in ("same", "different", "unclear", "odd")} | {"two": (["d1", "d2"], [])})
    decisions = spark.createDataFrame([(k, k, "high") for k in ("same", "different", "unclear", "odd")] + [("two", "different", "low")], "block string, decision string, confidence string")
    got = {r.block: (r.resolution, len(r.merged), len(r.unmerged)) for r in R.human_records(decisions, conflicts).collect()}
    assert got == {"same": ("merged", 2, 0), "different": ("partial", 1, 1), "unclear": ("unclear", 0, 2), "odd": ("manual_review_pending", 0, 2), "two": ("partial", 1, 1)}


def test_analyses(spark):
    m = spark.createDataFrame([("a", "x", ["opeb_metrics"]), ("a", "bioconductor-x", ["github"]), ("b", "y", ["opeb_metrics"])], "block string, name string, source array<string>")
    assert [(r.block, r.name) for r in R.alias_blocks(m).collect()] == [("a", "x")]
    left, counts = R.drop_sources(m, ["opeb_metrics"])
    assert left.count() == 1 and tuple(counts.first()) == (2, 1)
    records = spark.createDataFrame([("a", "merged", "auto"), ("b", "partial", "manual"), ("c", "no_conflict", "auto"), ("d_secondary_1", "merged", "auto"), ("e", "unclear", "manual"), ("f", "manual_review_pending", "manual")], "block string, resolution string, source string")
    assert tuple(R.funnel(records).first()) == (1, 1, 1, 1, 1)
    assert tuple(R.pair_estimates(spark.createDataFrame([(1,), (4,)], "n int"), "n").first()) == (5, 6)


def test_rounds_that_do_not_end_fail(spark):
    """No record is lost without an error: a block of five needs four rounds."""
    rows = [("b", str(i), i, "x", ["s"], "disconnected") for i in range(5)]
    conflicts = spark.createDataFrame(rows, "block string, entry string, ord int, name string, source array<string>, role string")
    apart = lambda pairs: pairs.withColumns({"verdict": F.lit("different"), "confidence": F.lit("low")})
    blocks = conflicts.select("block", "entry", "ord")
    with pytest.raises(RuntimeError):
        R.resolve(blocks, conflicts, apart, rounds=2)
    assert R.resolve(blocks, conflicts, apart).count() == 4
