from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from spindrift.functions import bibtex, licensing, text, urls


def each(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def plain_normal(url):
    if not url:
        return None
    p = urlparse(url)
    path = p.path.rstrip("/")
    path = path[:-5] if path.endswith(".html") else path
    if "bioconductor.org" in p.netloc.lower():
        parts = [x for x in path.split("/") if x and x not in ("release", "bioc", "html", "packages")]
        if parts:
            return "bioconductor.org/packages/" + parts[-1]
    return p.netloc.lower() + path


def test_normalize_url(spark):
    values = [None, "", "http://X.org", "https://x.org/a/b/", "http://x.org/A.html?q=1#f", "http://x.org/a;p=1", "x.org/Path/", "https://bioconductor.org/packages/release/bioc/html/DESeq2.html", "https://www.bioconductor.org/", "ftp://h/p//", "http://a_b.org/x y", "http://x.org/.html", "http://x.org#a/b"]
    assert each(spark, urls.normalize_url, values) == [plain_normal(v) for v in values]


def test_repository(spark):
    values = ["https://github.com/o/r/issues", "http://gitlab.com/o/r", "https://bitbucket.org/o", "https://bitbucket.org/o/r?x", None, "https://x.org"]
    found = each(spark, urls.repository_of, values)
    assert [(f.kind, f.url) if f else None for f in found] == [("github", "https://github.com/o/r"), ("gitlab", "https://gitlab.com/o/r"), None, ("bitbucket", "https://bitbucket.org/o/r?x"), None, None]
    assert each(spark, urls.repository_kind, ["http://anaconda.org/bioconda/x", "https://git.bioconductor.org/p", "https://x.org"]) == ["bioconda", "bioconductor", None]


def test_canonical_and_files(spark):
    assert each(spark, urls.canonical_url, ["HTTP://X.org", "https://x.org/a?b", "https://x.org?b", "nope", None]) == ["http://x.org/", "https://x.org/a?b", "https://x.org/?b", None, None]
    assert each(spark, urls.is_file_like, ["https://x.org/a.tar.gz", "https://x.org/a.zip?x", "https://x.py", "https://x.org/a"]) == [True, True, False, False]
    assert each(spark, urls.clean_webpage, ['"x.org"', "<http//x.org>", "https//x.org", " ", "www.x.org"]) == ["https://x.org", "http://x.org", "https://x.org", None, "https://www.x.org"]


def test_source_pages(spark):
    links = F.array(F.lit("https://github.com/a/b/c"), F.lit("http://x.org/bioconductor-t"))
    page = each(spark, lambda n: urls.source_pages(F.array(*map(F.lit, ("biotools", "bioconda", "bitbucket"))), n, links), ["t"])[0]
    assert page == {"biotools": "https://bio.tools/t", "bioconda": "https://anaconda.org/bioconda/bioconductor-t", "github": "https://github.com/a/b", "bitbucket": ""}


def test_handlers(spark):
    values = ["https://gitlab.com/g/sub/p", "https://pypi.org/project/numpy/", "https://sourceforge.net/projects/bwa", "https://x.org"]
    assert [(h.handler, h.repository or h.package) for h in each(spark, urls.link_handler, values)] == [("gitlab", "g%2Fsub%2Fp"), ("pypi", "numpy"), ("sourceforge", "bwa"), ("generic", None)]


def test_descriptions(spark):
    assert each(spark, text.normalize_description, [" trims READS ", "Done.", "  ", None, "é x"]) == ["Trims READS.", "Done.", None, None, "É x."]


def test_capitals_are_one_letter(spark):
    assert each(spark, text.normalize_description, ["ßa", "ﬁx", "\u1fb3", "\u1f88x.", "\u0149", "ɤ", "ǆ", "z", ".", ""]) == ["ẞa.", "ﬁx.", "\u1fbc.", "\u1f88x.", "\u0149.", "ɤ.", "Ǆ.", "Z.", ".", None]
    assert each(spark, lambda x: text.normalize_descriptions(F.array(x, F.lit(" "))), ["ßa"]) == [["ẞa."]]


def test_formats_and_contributors(spark):
    assert each(spark, text.normalize_format, ["txt", " tabular", "FASTQsanger", "bam", None]) == ["Textual format", "TSV", "FASTQ-sanger", "bam", ""]
    assert each(spark, text.is_organisation, ["University of X", "Jane"]) == [True, False]
    assert each(spark, text.clean_email, ["a@b.org>", "DECEASED", "-", None]) == ["a@b.org", None, None, None]


def test_monitor_id(spark):
    found = each(spark, text.monitor_id, ["https://h/monitor/tool/biotools:x:1.0/web/host", "https://h/monitor/tool/x:y/cmd", "a/b", None])
    assert [(f.name, f.version, f.type) if f else None for f in found] == [("x", "1.0", "web"), ("y", None, "cmd"), None, None]


def test_linebreaks_and_chunks(spark):
    assert each(spark, text.normalize_linebreaks, ["a\\n\\n\\n\\nb\r\nc \n"]) == ["a\n\nb\nc"]
    long = " ".join("w" * (k % 9 + 1) for k in range(200))

    def greedy(t, most):
        out, now = [], ""
        for w in t.split():
            new = f"{now} {w}" if now else w
            if now and -(-len(new) // 4) > most:
                out.append(now)
                now = w
            else:
                now = new
        return out + ([now] if now else [])

    assert each(spark, lambda c: text.chunk_words(c, 20), [long, "", "x" * 200]) == [greedy(long, 20), [], ["x" * 200]]


def test_html(spark):
    page = "<html><head><title>t</title></head><body><nav>menu</nav><h2>Head</h2><p>A <b>bold</b> <a href='u'>link</a> &amp; more</p><ul><li>one<li>two</ul><script>x</script><footer>f</footer></body></html>"
    assert each(spark, text.html_main_text, [page]) == ["## Head\nA **bold** [link](u) & more\n- one\n- two"]


def test_replies(spark):
    reply = 'Well.\n```json\n{"verdict": "Same", "confidence": "high"}\n```\nbye {"verdict": "x"}'
    found = each(spark, lambda c: text.fenced_json(c, "verdict string, confidence string"), [reply, 'x {"verdict": "Different"} y', "none"])
    assert [f.verdict if f else None for f in found] == ["Same", "Different", None]


@pytest.mark.parametrize("name,want", [("GPL-3.0", "GPL"), ("LGPL", "LGPL"), ("GNU Affero", "AGPL"), ("limited", "MIT"), ("CC-BY", "CC"), ("cc-by", "other"), ("https://creativecommons.org/x", "not-software"), ("Unlicense", "unlicensed"), ("CeCILL", "CeCILL"), (None, None)])
def test_licence_class(spark, name, want):
    assert each(spark, licensing.licence_class, [name]) == [want]


def test_licence_names(spark):
    assert each(spark, licensing.clean_licence, ["GPL-3 + file LICENSE.", "MIT..", None]) == ["GPL-3", "MIT", None]
    spdx = spark.createDataFrame([("MIT", "MIT License", ["Expat"], "u")], "license_id string, name string, synonyms array<string>, url string")
    rows = spark.createDataFrame([("expat",), ("mit",), ("x",)], "n string")
    assert {r.n: r.spdx_id for r in licensing.spdx_names(rows, "n", spdx).collect()} == {"expat": "MIT", "mit": "MIT", "x": None}


def test_bibtex():
    found = bibtex.parse('@article{k1, title = {A {Nested} one}, year=2020, doi = "10.1/x" }\n@misc{k2,\n url={https://x.org/{a}}\n} junk')
    assert [(e["type"], e["key"], e["fields"]) for e in found] == [("article", "k1", {"title": "A Nested one", "year": "2020", "doi": "10.1/x"}), ("misc", "k2", {"url": "https://x.org/a"})]
    assert bibtex.parse(None) == [] and bibtex.parse("@broken") == []
