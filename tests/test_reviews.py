from pyspark.sql import functions as F

from spindrift.operators import resolve, reviews, statistics
from spindrift.sources.standardize import standardize

from .raw import raw


def _conflict(spark):
    ids = [("biotools/bb/web/None", 0, "disconnected"), ("github/HybP/None/None", 1, "remaining"), ("bioconda/trim/cmd/1.0", 2, "remaining")]
    return spark.createDataFrame([("b", *r) for r in ids], "block string, entry string, ord int, role string")


def test_conversations(spark):
    entries = standardize(raw(spark))
    entries = entries.withColumn("publication", F.array(F.lit("p1")))
    cited = spark.createDataFrame([("p1", "T", "long", 1)], "pub_id string, title string, abstract string, citations int")
    shown = reviews.with_publications(entries, "id", "publication", cited, "pub_id")
    details = reviews.pair_details(resolve.build_pairs(_conflict(spark)), shown)
    row = details.first()
    assert row.disconnected.id == "biotools/bb/web/None" and [r.id for r in row.remaining] == ["github/HybP/None/None", "bioconda/trim/cmd/1.0"] and row.remaining[0].publication[0].title == "T"
    content = spark.createDataFrame([("https://bb.org/", "html", "text")], "url string, label string, body string")
    c = reviews.conversations(details, "compare", "done", content).first()
    assert c.fits and c.messages[0].content == "compare" and c.messages[-1].content == "done" and "HybP" in c.messages[1].content and "part 1" in c.messages[2].content


def test_parts(spark):
    df = spark.createDataFrame([(["a" * 12, "b" * 8, "c" * 60, "d"],), ([],)], "x array<string>")
    assert [r.p for r in df.select(reviews.parts(F.col("x"), 5).alias("p")).collect()] == [[["a" * 12, "b" * 8], ["c" * 60], ["d"]], []]


def test_issue(spark):
    body = reviews.issue_texts(_conflict(spark), standardize(raw(spark))).first().body
    assert body.startswith("## Disconnected\n\n### biotools/bb") and "- [https://h.org/](https://h.org/)" in body and "[MIT](https://l.org)" in body and "n (maintainer)" in body and "No website available." in body


def test_publication_lines(spark):
    p = spark.createDataFrame([([("T", 2020, None, "10.1/x", "5", None)],), ([],)], "p array<struct<title: string, year: int, url: string, doi: string, pmid: string, pmcid: string>>")
    assert [r.x for r in p.select(reviews.publication_lines(F.col("p")).alias("x")).collect()] == ["\n\t- **T** (2020) – [Link](https://doi.org/10.1/x) – DOI: 10.1/x, PMID: 5", "No publications listed."]


def test_completeness(spark):
    entries = standardize(raw(spark))
    tools = spark.createDataFrame([("t1", ["biotools/bb/web/None", "github/HybP/None/None"]), ("t2", ["bioconda/trim/cmd/1.0"])], "block string, entries array<string>")
    found = {r.tool: r.score for r in statistics.source_completeness(tools, "entries", entries, "id", "biotools").collect()}
    assert set(found) == {"t1"} and 0.4 < found["t1"] < 1
    formats = statistics.normalised_formats(entries, "id")
    assert [(r.id, r.n) for r in formats.collect()] == [("biotools/bb/web/None", 2)]
    assert [r.block for r in statistics.tools_with_any(tools, "entries", formats).collect()] == ["t1"]
    assert {r.name: r.types for r in statistics.types_by_name(entries).collect()} == {"trim": ["cmd"], "void": ["cmd"]}
    pubs = spark.createDataFrame([("p", "10.1/x", "", [("Europe PMC",), ("other",)]), ("q", None, "T", None)], "id string, doi string, title string, citations array<struct<source: string>>")
    assert {r.id: round(r.score * 11) for r in statistics.publication_completeness(pubs, "id", "citations").collect()} == {"p": 2, "q": 1}
