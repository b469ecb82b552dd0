import pytest
from pyspark.sql import functions as F

from spindrift.operators import publications
from spindrift.sources import standardize as S

from .raw import raw


@pytest.fixture(scope="module")
def entries(spark):
    return {r._id: r for r in S.standardize(raw(spark)).collect()}


def test_ids(entries):
    assert {r.id for r in entries.values()} == {
        "bioconda/trim/cmd/1.0", "bioconda/void/cmd/None", "bioconda_recipes/zed/cmd/2.1", "bioconda_recipes/code/cmd/None", "bioconductor/ppp/lib/1.2", "bioconductor/t/lib/None", "bioconductor/n/lib/None", "biotools/bb/web/None",
        "toolshed/tt/cmd/1", "galaxy_metadata/gm/cmd/1", "galaxy/gg/cmd/1", "opeb_metrics/oo/web/1.0", "sourceforge/bio-bwa/None/None", "github/HybP/None/None",
    }


def test_quarantine(spark):
    assert {r._id for r in S.quarantine(raw(spark)).collect()} == {"bioconda/short", "toolshed/noid"}


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        S.standardize(raw(spark), ["nowhere"])
    with pytest.raises(ValueError):
        publications.extract(raw(spark), "github")


def test_bioconda(entries):
    e = entries["bioconda/trim/cmd/1.0"]
    assert e.description == ["Trims reads."] and e.webpage == ["http://trim.org/"] and e.source_code == ["https://a.org/s.zip"]
    assert e.download == ["https://a.org/x.tar.gz", "https://a.org/s.zip"] and [(r.url, r.kind) for r in e.repository] == [("https://github.com/a/trim", "github")]
    assert [d.type for d in e.documentation] == ["installation_instructions", "general"] and e.operating_system == ["Linux", "macOS", "Windows"]
    v = entries["bioconda/empty"]
    assert v.version == ["None"] and v.description == [] and v.documentation == [] and v.download == []


def test_recipes(entries):
    e = entries["bioconda_recipes/z"]
    assert [(r.url, r.kind) for r in e.repository] == [("https://github.com/o/zed", "github")] and e.dependencies == ["python"]
    assert [(a.name, a.url, a.maintainer) for a in e.authors] == [(None, "https://github.com/bob", True), ("Jane Roe", None, True), ("Carl May", None, False)]
    assert e.documentation[-1].url == "https://github.com/o/zed/issues" and e.source_code == []
    assert entries["bioconda_recipes/code"].source_code == entries["bioconda_recipes/code"].download == ["https://z.org/c.tar.gz"]


def test_bioconductor(entries):
    e = entries["bioconductor/p"]
    assert e.webpage == ["http://p.org/", "https://www.q.org/"] and e.dependencies == ["R", "x"]
    assert [(x.name, x.url) for x in e.license] == [("GPL-3", None), (None, "https://l.org/x")]
    assert [(a.name, a.email, a.type, a.maintainer) for a in e.authors] == [("M", "m@m.org", None, True), ("A", None, "Person", False)]
    assert [r.url for r in e.repository] == ["https://git.bioconductor.org/packages/p", "https://github.com/o/p"]
    assert entries["bioconductor/tba"].webpage == [] and entries["bioconductor/none"].webpage == ["https://bioconductor.org/packages/n"]


def test_biotools(entries):
    e = entries["biotools/b"]
    assert e.label == ["BB"] and e.operating_system == ["macOS", "Linux"] and e.webpage == []
    assert [(d.type, d.url) for d in e.documentation] == [("general", "https://d.org/a"), ("manual", "https://d.org/m")]
    assert [(i.uri, i.datatype.uri) for i in e.input] == [("http://e.org/format_1", "http://e.org/data_1"), (None, "http://e.org/data_2")]
    assert e.authors[0].type == "Organization" and e.topics[0].uri == "http://e.org/topic_0001"


def test_others(entries):
    assert entries["toolshed/t"].repository[0].url == "https://github.com/u/r" and entries["toolshed/t"].description == []
    assert entries["galaxy/g"].operating_system == [] and "operating_systems" in entries["galaxy/g"].extra
    s = entries["sourceforge/bwa"]
    assert s.webpage == ["http://bwa.org/"] and s.operating_system == [] and s.repository[0].url == "https://sourceforge.net/projects/Bio-BWA"
    g = entries["github/H"]
    assert g.links == ["https://h.org/a.zip"] and g.download == [] and g.documentation[0].type == "general" and g.authors[0].type == "Person"


def test_wrong_elements_alone_can_go(spark):
    rows = S._projected(raw(spark), ["github", "sourceforge"])
    kept = {r._id: r for r in S.valid_fields(rows, keep_valid_elements=True).collect()}
    assert kept["github/H"].download == ["https://h.org/x"] and kept["sourceforge/bwa"].operating_system == ["Linux"]


def test_vocabulary(spark):
    rows = S.standardize(raw(spark), ["toolshed", "biotools"])
    words = spark.createDataFrame([("http://e.org/format_1", "First", 1), ("u:txt2", "TXT", 3), ("u:txt", "txt", 2)], "uri string, label string, ord int")
    got = {r.id: r for r in S.with_vocabulary(S.with_vocabulary(rows, "input", words), "output", words).collect()}
    assert got["biotools/bb/web/None"].input[0].term == "First"
    t = got["toolshed/tt/cmd/1"]
    assert t.input == [] and [(o.uri, o.vocabulary) for o in t.output] == [("u:txt", "EDAM")]
    kept = {r.id: r for r in S.with_vocabulary(rows, "input", words, keep_matched=True).collect()}
    assert [i.term for i in kept["toolshed/tt/cmd/1"].input] == ["txt"]


def test_publications(spark):
    found = {s: sorted((r.doi or "", r.title or "", r.year) for r in publications.extract(raw(spark), s).collect()) for s in publications.EXTRACTORS}
    assert found == {
        "bioconda_recipes": [("10.1234/abc", "", None)], "bioconductor": [], "biotools": [("", "T", None), ("10.1000/xyz", "", None)], "opeb_metrics": [("10.1234/abc", "", None)],
        "toolshed": [("10.5555/q", "Nice", 2020), ("10.7777/w", "", None)],
    }


def test_publication_keys(spark):
    none = F.lit(None).cast("string")
    rows = spark.createDataFrame([(1, "d1", "t1"), (2, None, "t1"), (3, "d1", "t2"), (4, "d4", None), (5, None, "t2"), (6, None, None)], "id long, doi string, title string")
    rows = rows.withColumns({"url": none, "pmid": none, "pmcid": none})
    assert {r.id: r.publication for r in publications.deduplicate(rows, "id").collect()} == {1: 1, 2: 1, 3: 1, 5: 1, 4: 4, 6: 6}
    known = rows.where("id IN (1, 4)")
    assert {r.id: r.known_id for r in publications.look_up(rows, known, "id", "id").collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: None, 6: None}
