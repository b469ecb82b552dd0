import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from spindrift import cli
from spindrift.operators import merge
from spindrift.plans import integration
from spindrift.sources import documents as D
from spindrift.streaming import ingest

from .raw import raw


def test_keyed_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": {"d": "same"}}\nbroken\n{"k": {"d": "different"}, "m": {"d": "x"}}\n')
    got = {r.key: r.value.d for r in D.read_keyed_lines(spark, str(tmp_path / "a.jsonl"), "struct<d: string>").collect()}
    assert got == {"k": "different", "m": "x"}
    objects = spark.createDataFrame([('{"a": {"x": 1}, "b": [2]}',), ("[1]",)], "j string")
    assert sorted(json.dumps(json.loads(r.value)) for r in D.object_to_lines(objects, "j").collect()) == ['{"a": {"x": 1}}', '{"b": [2]}']
    both = spark.createDataFrame([('{"a":1}{"b":2} {"c":3}',)], "j string")
    assert [json.loads(r.value) for r in D.split_concatenated(both, "j").collect()] == [{"a": 1}, {"b": 2}, {"c": 3}]


def test_changes(spark):
    old = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, x string, y string")
    new = spark.createDataFrame([(2, "B", "Q", 1), (2, "C", "R", 2), (3, "d", "s", 1)], "k int, x string, y string, o int")
    assert {tuple(r) for r in D.upsert(old, new, "k", "o").collect()} == {(1, "a", "p"), (2, "C", "R"), (3, "d", "s")}
    assert {tuple(r) for r in D.update_columns(old, new.where("o = 2"), "k", ["x"]).collect()} == {(1, "a", "p"), (2, "C", "q")}
    assert {tuple(r) for r in D.delete(old, new, "k").collect()} == {(1, "a", "p")}
    assert D.existing(new, old, "k").count() == 2 and D.first_by(new, "k", "o").where("k = 2").first().x == "B" and D.without_payload(old, "y").columns == ["k", "x"]


def test_scan_pushes_down(spark, tmp_path):
    spark.range(10).withColumn("x", F.lit("y")).write.parquet(str(tmp_path / "t"))
    df = D.scan(spark, str(tmp_path / "t"), "id > 7", ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 2 and "GreaterThan(id,7)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_enrichment(spark):
    status = spark.createDataFrame([("https://a.org", 500), ("http://a.org", 200), ("https://b.org", 404)], "url string, status int")
    rows = spark.createDataFrame([("https://a.org",), ("https://b.org",)], "page string")
    assert {r.page: (r.works, r.works_at) for r in D.alive(rows, "page", status).collect()} == {"https://a.org": (True, "http://a.org"), "https://b.org": (False, None)}
    c = spark.createDataFrame([(1, 1, '```json\n{"decision": "same"}\n```'), (1, 2, "no block"), (1, 3, '```json\n{"decision": "different", "confidence": "high"}\n```'), (2, 1, "```json\nbroken\n```")], "issue int, n int, body string")
    assert [tuple(r) for r in D.decisions_from_comments(c, "issue", "n", "body").collect()] == [(1, "different", None, "high")]


def test_provenance(spark):
    s = "id string, x string, created_at string, created_by string, created_logs string, last_updated_at string, updated_by string, updated_logs string"
    old = spark.createDataFrame([("a", "1", "t0", "me", "l0", "t0", "me", "l0")], s)
    new = spark.createDataFrame([("a", "2"), ("b", "3")], "id string, x string")
    got = {r.id: tuple(r)[1:] for r in integration.save(old, new, F.lit("you"), F.lit("l1"), F.lit("t1")).collect()}
    assert got == {"a": ("2", "t0", "me", "l0", "t1", "you", "l1"), "b": ("3", "t1", "you", "l1", "t1", "you", "l1")}


def provider(pairs):
    return pairs.withColumns({"verdict": F.lit("same"), "confidence": F.lit("high")})


def test_jobs(spark, tmp_path):
    raw(spark).write.parquet(str(tmp_path / "raw"))
    cli.main(["transform", "--raw", str(tmp_path / "raw"), "--out", str(tmp_path / "out")], spark)
    entries = spark.read.parquet(str(tmp_path / "out/entries"))
    pubs = {(r.doi, r.title) for r in spark.read.parquet(str(tmp_path / "out/publications")).collect()}
    assert ("10.1234/abc", None) in pubs and len(pubs) == 5
    by = {r._id: r.publication for r in entries.collect()}
    assert by["bioconda_recipes/z"] == by["opeb/o"] != [] and by["github/H"] == []
    records, tools = integration.integrate(entries, provider)
    assert sum(len(r.merged) + len(r.unmerged) for r in records.collect()) >= entries.count()
    tools.write.parquet(str(tmp_path / "tools"))
    cli.main(["statistics", "--tools", str(tmp_path / "tools"), "--out", str(tmp_path / "stats")], spark)
    counts = {r.collection: r.n_tools for r in spark.read.parquet(str(tmp_path / "stats/tools_count")).collect()}
    assert counts == {"tools": tools.count(), "Proteomics": 1}
    cited = spark.read.parquet(str(tmp_path / "out/publications")).withColumn("citations", F.lit(1))
    assert integration.scorer_input(tools, cited).count() == tools.count()


def test_integrate_command(spark, tmp_path):
    rows = raw(spark)
    entries, _, _ = integration.transform(rows, ["github", "bioconda", "biotools"])
    entries.write.parquet(str(tmp_path / "entries"))
    spark.createDataFrame([], "block string, entry string, verdict string, confidence string").write.parquet(str(tmp_path / "verdicts"))
    cli.main(["integrate", "--entries", str(tmp_path / "entries"), "--verdicts", str(tmp_path / "verdicts"), "--out", str(tmp_path / "o")], spark)
    assert spark.read.parquet(str(tmp_path / "o/tools")).count() == 4
    # a second run judges nothing again: its verdicts would say otherwise, and the stored records stay
    spark.read.parquet(str(tmp_path / "verdicts")).withColumn("verdict", F.lit("disagreement")).write.parquet(str(tmp_path / "other"))
    cli.main(["integrate", "--entries", str(tmp_path / "entries"), "--verdicts", str(tmp_path / "other"), "--records", str(tmp_path / "o/records"), "--out", str(tmp_path / "again")], spark)
    said = lambda at: sorted((r.block, r.resolution, r.merged, r.unmerged) for r in spark.read.parquet(str(tmp_path / at / "records")).collect())
    assert said("again") == said("o") != []
    cli.main(["merge", "--entries", str(tmp_path / "entries"), "--records", str(tmp_path / "o/records"), "--out", str(tmp_path / "m")], spark)
    tools = lambda at: sorted((r.block, r.entries) for r in spark.read.parquet(str(tmp_path / at / "tools")).collect())
    assert tools("m") == tools("o") != []


def test_streams(spark, tmp_path):
    rows = [("a", "x", dt.datetime(2024, 1, 1, 0, 0, 5)), ("a", "x", dt.datetime(2024, 1, 1, 0, 0, 9)), ("b", "x", dt.datetime(2024, 1, 1, 0, 3))]
    spark.createDataFrame(rows, "id string, k string, ts timestamp").write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema("id string, k string, ts timestamp").parquet(str(tmp_path / "s"))
    q = ingest.windowed_counts(stream, "ts", F.col("k"), "1 minute").writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.window_start.minute, r.n) for r in spark.table("counts").collect()} == {(0, 2), (3, 1)}
    seen = []
    q = ingest.upsert_batches(ingest.deduplicated(stream, "id", "ts"), lambda batch, n: seen.extend(r.id for r in batch.collect()), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert sorted(seen) == ["a", "b"]


def test_intermediate_tables_go(spark):
    from spindrift import storage

    df = storage.materialise(spark.range(5))
    path = df._spindrift_path
    assert df.count() == 5 and path.startswith(storage.shared_dir(spark))
    assert storage.clean(spark) >= 1 and spark.sparkContext.applicationId not in storage._written


def test_look_ups(spark, tmp_path):
    rows, table = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", 1)], "id string, v int")
    assert {(r.k, r.v) for r in D.looked_up(rows, "k", table, "id", required=False).collect()} == {("a", 1), ("b", None)}
    assert D.looked_up(rows.where("k = 'a'"), "k", table, "id").first().v == 1
    with pytest.raises(Exception, match="no row for key b"):
        D.looked_up(rows, "k", table, "id").collect()
    for _ in range(2):
        D.append(table, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    assert D.ci_links({"CI_PROJECT_URL": "https://h/p", "CI_COMMIT_SHA": "c", "CI_JOB_URL": "j"}) == ("https://h/p/-/commit/c", "j") and D.ci_links({}) == (None, None)


def test_stored_tools(spark):
    tools = spark.createDataFrame([("b", ["e1"], "n", ["cmd"])], "block string, entries array<string>, name string, type array<string>")
    r = merge.as_stored(tools, F.lit("t")).first()
    assert (r.tool_id, r.source, r.timestamp, r.data.name, r.data.type) == ("b", ["e1"], "t", "n", ["cmd"])


def test_counts_of_more_than_a_hundred_labels(spark, tmp_path):
    from spindrift.plans import demos

    spark.createDataFrame([(f"kind{i % 150}",) for i in range(300)], "event_type string").write.parquet(f"{tmp_path}/events.parquet")
    found = {r.label: r.n for r in demos.counts_zero_filled(spark, str(tmp_path)).collect()}
    assert found == {f"kind{i}": 2 for i in range(150)} | {"nothing": 0}


def test_repeated_and_null_keys_of_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (1, "x"), (1, "w"), (3, "c"), (3, "c"), (None, "m"), (None, "m")], "k int, v string")
    assert sorted(map(str, map(tuple, D.upsert(old, new, "k").collect()))) == sorted(map(str, [(1, "x"), (2, "b"), (3, "c"), (None, "m")]))
    assert sorted(map(str, map(tuple, D.update_columns(old, new, "k", ["v"]).collect()))) == sorted(map(str, [(1, "x"), (2, "b"), (None, "m")]))
    rows = spark.createDataFrame([(1,), (3,), (3,)], "k int")
    assert sorted(map(tuple, D.looked_up(rows, "k", new.withColumnRenamed("k", "id"), "id").select("k", "v").collect())) == [(1, "x"), (3, "c"), (3, "c")]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from spindrift import storage

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        storage.shared_dir(Session())


def test_tables_are_discarded_and_cleaned(spark):
    from spindrift import storage

    storage.clean(spark)
    one, two, kept = storage.materialise(spark.range(3)), storage.materialise(spark.range(4)), storage.materialise(spark.range(5), keep=True)
    storage.discard(one)
    assert storage.clean(spark) == 1 and kept.count() == 5
    del two
