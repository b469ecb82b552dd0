from pyspark.sql import functions as F

from spindrift.operators import merge as M
from spindrift.operators import statistics as S


def test_three_entries(spark):
    rows = spark.createDataFrame(
        [("b", 1, "e1", "tool", "web", ["3.0"], ["A"]), ("b", 2, "e2", "tool", "cmd", ["1.0"], ["B"]), ("b", 3, "e3", "Tool2", "web", ["1.0"], ["C", "B"])],
        "block string, ord int, entry string, name string, type string, version array<string>, publication array<string>",
    )
    r = M.merge_entries(rows).first()
    assert (r.type, r.version, r.publication, r.name, r.other_names, r.entries) == (["cmd", "web"], ["1.0", "3.0"], ["A", "B", "C"], "tool", ["Tool2"], ["e1", "e2", "e3"])


def items(spark, kind, rows):
    return spark.createDataFrame(rows, f"block string, ord int, x array<struct<{kind}>>")


def test_field_rules(spark):
    repo = items(spark, "url: string, kind: string", [("b", 2, [("u2", "git"), ("u1", "late")]), ("b", 1, [("u1", None), ("u1", "github")])])
    assert [tuple(i) for i in M.repositories(repo, "block", "ord", "x").first().x] == [("u1", "github"), ("u2", "git")]
    docs = items(spark, "type: string, url: string, content: string", [("b", 1, [("help", None, "abc")]), ("b", 2, [("help", None, "longer"), ("general", "u", None)]), ("b", 3, [("help", None, "longes")])])
    assert [tuple(i) for i in M.documentation(docs, "block", "ord", "x").first().x] == [("help", None, "longer"), ("general", "u", None)]
    lic = items(spark, "name: string, url: string", [("b", 1, [("MIT", None)]), ("b", 2, [("MIT", "u"), ("GPL", None)])])
    assert [tuple(i) for i in M.licences(lic, "block", "ord", "x").first().x] == [("MIT", "u"), ("GPL", None)]
    who = items(spark, "type: string, name: string, email: string, maintainer: boolean, url: string, orcid: string", [("b", 1, [(None, "A", "", False, None, None)]), ("b", 2, [("Person", "A", "a@b", True, None, None)])])
    a = M.authors(who, "block", "ord", "x").first().x[0]
    assert (a.name, a.type, a.email, a.maintainer) == ("A", "Person", "a@b", True)
    term = "vocabulary: string, term: string, uri: string"
    form = items(spark, f"{term}, datatype: struct<{term}>", [("b", 1, [("E", "t", None, None)]), ("b", 2, [("E", "t", "u", ("E", "d", "v"))])])
    assert M.formats(form, "block", "ord", "x").first().x[0].uri == "u"


def test_citations_inside_others_go(spark):
    rows = spark.createDataFrame([("b", 1, [{"title": "T", "year": "1"}, {"title": "T", "year": "1", "DOI": "d", "url": "u"}]), ("b", 2, [{"title": "S", "note": ""}, {"title": "S", "note": "n"}])], "block string, ord int, citation array<map<string,string>>")
    found = [sorted(m.items()) for m in M.citations(rows, "block", "ord").first().citation]
    assert found == [[("DOI", "d"), ("title", "T"), ("url", "u"), ("year", "1")], [("note", "n"), ("title", "S")]]


def test_tools_of_records(spark):
    r = spark.createDataFrame([("a", "merged", ["1", "2"], []), ("b", "partial", ["3"], ["4"]), ("c", "partial", ["5"], ["6", "7"]), ("d", "unclear", [], ["8", "9"]), ("e", "partial", [], ["10"])], "block string, resolution string, merged array<string>, unmerged array<string>")
    assert {(x.tool, x.entry) for x in M.tools_of(r).collect()} == {("a", "1"), ("a", "2"), ("b", "3"), ("b#unmerged", "4"), ("c", "5"), ("e#unmerged", "10")}


def test_meaningful(spark):
    rows = spark.createDataFrame([("", 0, False, [], None), ("x", 3, True, ["", "y"], "unknown"), ("None", None, None, ["", "None"], "z")], "a string, b int, c boolean, d array<string>, e string")
    share = {r.feature: r.share for r in S.feature_presence(rows, list("abcde")).collect()}
    assert share == {"a": 1 / 3, "b": 1 / 3, "c": 1 / 3, "d": 1 / 3, "e": 1 / 3}
    counted = {r.n_features: (r.n, round(r.running_share, 3)) for r in S.feature_counts(rows, list("abcde")).collect()}
    assert counted == {1: (1, 0.333), 2: (1, 0.667), 4: (1, 1.0)} or counted == {2: (1, 0.333), 1: (1, 0.333), 4: (1, 1.0)}


def test_sources(spark):
    t = spark.createDataFrame([(["bioconda", "bioconda_recipes", "github"],), (["galaxy_metadata", "other"],), (None,)], "source array<string>")
    counts = {r.label: r.n for r in S.tools_per_source(t, "source").collect()}
    assert len(counts) == 9 and counts["bioconda"] == counts["github"] == counts["toolshed"] == 1 and counts["galaxy"] == 0
    assert {(r.label, r.bucket): r.n for r in S.coverage_matrix(t, "source").collect()} == {("bioconda", 2): 1, ("github", 2): 1, ("toolshed", 1): 1}


def test_licence_verdicts(spark):
    t = spark.createDataFrame([(1, ["MIT", "unknown"], False), (2, ["MIT", "GPL"], False), (3, [], False), (4, ["unlicensed"], False), (5, ["strange"], False), (6, ["creativecommons.org", "MIT"], True), (7, None, False), (8, ["", None, "BSD"], False)], "id int, n array<string>, m boolean")
    v = S.licence_verdicts(t, "id", "n", F.col("m"))
    assert {r.id: (r.verdict, r["class"]) for r in v.collect()} == {
        1: ("Unambiguous", "MIT"), 2: ("Ambiguous", None), 3: ("None", None), 4: ("None", None), 5: ("Unambiguous", "other"), 6: ("Unambiguous", "MIT"), 7: ("None", None), 8: ("Ambiguous", None),
    }
    assert {r.id: r.n for r in S.licence_summary(v).collect()} == {"Total": 8, "None": 3, "Unambiguous": 3, "Open Source": 2, "other": 1, "Ambiguous": 2}


def test_versions(spark):
    t = spark.createDataFrame([(["1.0"],), (["v1"],), (["None"],), ([],), (None,), (["unknown", " "],), (["1", "2.0"],), (["abc"],)], "v array<string>")
    assert [r.x for r in t.select(S.version_scheme(F.col("v")).alias("x")).collect()] == ["Semantic", "Semantic", "Other", "None", "None", "None", "Semantic", "Other"]
    assert t.select(S.version_scheme(F.col("v"), null_text_is_none=True).alias("x")).collect()[2].x == "None"


def test_journals(spark):
    c = "array<struct<source: string, count: map<string, bigint>>>"
    pubs = spark.createDataFrame([("p1", "J", [("Semantic Scholar", {"2022": 3, "total": 9}), ("europepmc", {"2022": 50})]), ("p2", "J", [("Semantic Scholar", {"2024": 1})]), ("p3", "K", [("Semantic Scholar", {"2020": 7})]), ("p4", None, [("Semantic Scholar", {"2022": 7})]), ("p5", "L", [("Semantic Scholar", {})])], f"id string, j string, c {c}")
    tools = spark.createDataFrame([(["p1", "p2"],), (["p1"],), (["p3"],)], "p array<string>")
    assert [tuple(r) for r in S.journal_tools(pubs, "id", "j", "c", tools, "p").orderBy("journal").collect()] == [("J", 4, 2, 3), ("K", 0, 1, 1)]


def test_indicators_and_bins(spark):
    s = spark.createDataFrame([("t1", "F1", 1.0), ("t2", "F1", 0.5), ("t3", "F1", 1.0), ("t1", "X9", 1.0), ("t2", "A1", None)], "tool_id string, indicator string, score double")
    row = S.indicator_summary(s).collect()
    assert [(r.principle, r.indicator, r.scores, r.counts) for r in row] == [("F", "F1", [0.5, 1.0], [1, 2])]
    assert {r.indicator: r.mean for r in S.indicator_mean(s).collect()} == {"F1": 0.8333, "X9": 1.0}
    values = spark.createDataFrame([(float(i % 10), i) for i in range(25)], "v double, k int")
    order = sorted((float(i % 10), i) for i in range(25))
    want = {b: sum(v for v, _ in order[b * 7 : b * 7 + 7]) / len(order[b * 7 : b * 7 + 7]) for b in range(4)}
    assert {r.bin: round(r["mean"], 9) for r in S.fixed_size_bins(values, "v", "k", 7).collect()} == {b: round(m, 9) for b, m in want.items()}


def test_sink_row(spark):
    rows = S.computation(spark.createDataFrame([(2, "b"), (1, "a")], "n int, x string"), "things", "tools", F.lit("now")).collect()
    assert sorted(map(tuple, rows)) == [("things", "now", "tools", '{"n":1,"x":"a"}'), ("things", "now", "tools", '{"n":2,"x":"b"}')]
    f = {(r.source, r.feature): r.place for r in S.source_features({"s": ["b"]}, ["a", "b"], spark).collect()}
    assert f == {("s", "a"): 0, ("s", "b"): 2}
