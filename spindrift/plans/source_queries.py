"""Queries on raw documents made of the driver's tables: one for each source's projection and publications, and on tables, links and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.catalogue import query
from spindrift.functions import licensing, text, urls
from spindrift.operators import publications
from spindrift.sources import documents
from spindrift.sources.standardize import standardize, with_vocabulary


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key() -> Column:
    return F.col("p_partkey").cast("string")


def _size() -> Column:
    return F.col("p_size").cast("string")


def _cat(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _raw(spark, sf_dir, source: str, fields: dict[str, Column], source_url: Column | None = None) -> DataFrame:
    """Raw documents of one source, a part each."""
    data = F.to_json(F.struct(*(c.alias(k) for k, c in fields.items())))
    url = source_url if source_url is not None else F.lit(None).cast("string")
    return _t(spark, sf_dir, "part").select(_key().alias("_id"), F.lit(source).alias("data_source"), url.alias("source_url"), data.alias("data"))


def _joined(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


# --- projections -------------------------------------------------------------


@query(
    "source_bioconda",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, 'bioconda/Tool' || p_partkey || '/cmd/' || p_size AS id, 'Tool' || p_partkey AS label, p_brand || '.' AS description, 'https://example.org/Tool' || p_partkey AS webpage,
      'https://a.org/x' || p_partkey AS source_code, CAST(2 AS INTEGER) AS n_download, p_type AS license, 'https://github.com/o/t' || p_partkey AS repository, 'https://bioconda.github.io/recipes/Tool' || p_partkey || '/README.html' AS page, 'Linux|macOS|Windows' AS operating_system
    FROM part WHERE p_size % 7 <> 0""",
)
def source_bioconda(spark, sf_dir):
    """Entries of one source; an identifier without all its parts is rejected."""
    at = F.when(F.col("p_size") % 7 == 0, F.lit("https://host/short")).otherwise(_cat("https://host/monitor/tool/bioconda:Tool", _key(), ":", _size(), "/cmd/end"))
    distributions = F.struct(F.array(_cat("https://a.org/x", _key())).alias("source/tar"), F.array(F.lit("https://b.org/y")).alias("docker"))
    fields = {
        "@id": at, "name": _cat("Tool", _key()), "description": F.col("p_brand"), "web": F.struct(_cat("https://Example.org/Tool", _key()).alias("homepage")), "distributions": distributions,
        "license": _cat(F.col("p_type"), " LICENSE."), "repositories": F.array(_cat("https://github.com/o/t", _key()), F.lit("junk")),
    }
    rows = standardize(_raw(spark, sf_dir, "bioconda", fields), ["bioconda"])
    first = lambda c: F.get(c, F.lit(0))
    return rows.select(
        "_id", "id", first("label").alias("label"), _joined("description"), _joined("webpage"), _joined("source_code"), F.size("download").alias("n_download"),
        first("license")["name"].alias("license"), F.array_join("repository.url", "|").alias("repository"), F.array_join(F.array_distinct("documentation.url"), "|").alias("page"), _joined("operating_system"),
    )


@query(
    "source_bioconda_recipes",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, 'bioconda_recipes/tool' || p_partkey || '/' || CASE WHEN p_size > 25 THEN 'lib' ELSE 'cmd' END || '/' || CASE WHEN p_size % 5 = 0 THEN 'None' ELSE CAST(p_size AS VARCHAR) END AS id,
      upper(p_name[1]) || p_name[2:] || '.' AS description, CASE WHEN p_size % 2 = 0 THEN 'https://bitbucket.org/own/r' || p_partkey END AS repository, 'https://src.org/' || p_partkey AS source_code,
      'a|b' AS dependencies, 'Ann Lee|Bo Ek|Cy Day' AS people, CAST(2 AS INTEGER) AS n_maintainers, p_brand AS license
    FROM part""",
)
def source_bioconda_recipes(spark, sf_dir):
    dev = F.when(F.col("p_size") % 2 == 0, _cat("https://bitbucket.org/own/r", _key(), "/src/master"))
    about = F.struct(
        F.lit("https://home.org/x").alias("home"), dev.alias("dev_url"), F.lit(None).cast("string").alias("description"), F.col("p_name").alias("summary"), _cat(F.col("p_brand"), "+").alias("license"),
        F.lit("Ann Lee and Bo Ek").alias("maintainers"), F.array(F.lit("Bo Ek"), F.lit("Cy Day")).alias("authors"),
    )
    fields = {
        "name": _cat("Tool", _key()), "@type": F.when(F.col("p_size") > 25, F.lit("lib")), "package": F.struct(F.when(F.col("p_size") % 5 != 0, _size()).alias("version")), "about": about,
        "source": F.struct(_cat("https://src.org/", _key()).alias("url")), "requirements": F.struct(F.array(F.lit("a"), F.lit(""), F.lit("b")).alias("run")),
    }
    rows = standardize(_raw(spark, sf_dir, "bioconda_recipes", fields), ["bioconda_recipes"])
    return rows.select(
        "_id", "id", _joined("description"), F.get("repository.url", F.lit(0)).alias("repository"), _joined("source_code"), _joined("dependencies"), F.array_join("authors.name", "|").alias("people"),
        F.size(F.filter("authors", lambda a: a["maintainer"])).alias("n_maintainers"), F.array_join("license.name", "|").alias("license"),
    )


@query(
    "source_bioconductor",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, 'bioconductor/tool' || p_partkey || '/lib/1.' || p_size AS id, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 'https://one.org/a|https://two.org/b' ELSE 'https://bioconductor.org/packages/Tool' || p_partkey END AS webpage,
      'https://git.bioconductor.org/packages/Tool' || p_partkey || CASE WHEN p_size > 25 THEN '|https://github.com/own/repo-' || p_partkey ELSE '' END AS repository, 'R|methods|stats' AS dependencies, 'Ann Lee:Person:ann@x.org:true|Bo Ek::none:false' AS people
    FROM part""",
)
def source_bioconductor(spark, sf_dir):
    page = F.when(F.col("p_size") % 3 == 0, F.lit("TBA")).when(F.col("p_size") % 3 == 1, F.lit("<https://one.org/a>, two.org/b"))
    person = lambda name, email, orcid: F.struct(F.lit(name).alias("name"), F.array().cast("array<string>").alias("roles"), F.lit(email).alias("email"), F.lit(orcid).cast("string").alias("orcid"))
    fields = {
        "Package": _cat("Tool", _key()), "Version": _cat("1.", _size()), "Description": F.col("p_name"), "URL": page, "Depends": F.array(F.lit(" R ")), "Imports": F.array(F.lit("methods"), F.lit("stats")),
        "Maintainer": F.array(person("Ann Lee", "ann@x.org>", "0000-1")), "Authors@R (parsed)": F.array(person("Ann Lee", "ann@x.org", None), person("Bo Ek", "no address", None)),
        "BugReports": F.when(F.col("p_size") > 25, _cat("https://github.com/own/repo-", _key(), "/issues")),
    }
    rows = standardize(_raw(spark, sf_dir, "bioconductor", fields, _cat("https://git.bioconductor.org/packages/Tool", _key())), ["bioconductor"])
    none = lambda c, other: F.coalesce(c, F.lit(other))
    people = F.transform("authors", lambda a: F.concat_ws(":", a["name"], none(a["type"], ""), none(a["email"], "none"), a["maintainer"].cast("string")))
    return rows.select("_id", "id", _joined("webpage"), F.array_join("repository.url", "|").alias("repository"), _joined("dependencies"), F.array_join(people, "|").alias("people"))


@query(
    "source_toolshed",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, 'toolshed/tool' || p_partkey || '/cmd/' || p_size AS id, CASE WHEN p_size % 4 = 0 THEN '' ELSE p_name[1:0] || upper(p_name[1]) || p_name[2:] || '.' END AS description,
      CASE WHEN p_size % 2 = 0 THEN 'https://github.com/own/r' || p_partkey END AS repository, p_size > 10 AS test, 'fasta|tab' AS inputs, 'help ' || p_brand AS help
    FROM part WHERE p_size <> 3""",
)
def source_toolshed(spark, sf_dir):
    bib = F.when(F.col("p_size") % 2 == 0, _cat("@misc{k", _key(), ", title={T}, url = {https://github.com/own/r", _key(), "/wiki}}")).otherwise(F.lit("@article{x, title={Y}}"))
    item = lambda t, v: F.struct(F.lit(t).alias("type"), v.alias("value"))
    fields = {
        "id": F.when(F.col("p_size") != 3, _cat("Tool", _key())), "version": _size(), "name": F.col("p_name"), "description": F.when(F.col("p_size") % 4 == 0, F.lit("  ")).otherwise(_cat(" ", F.col("p_name"), " ")),
        "citation": F.array(item("doi", F.lit("10.1/x")), item("bibtex", bib)), "dataFormats": F.struct(F.array(F.lit("fasta"), F.lit("tab")).alias("inputs")), "help": _cat("help ", F.col("p_brand")), "tests": F.col("p_size") > 10,
    }
    rows = standardize(_raw(spark, sf_dir, "toolshed", fields), ["toolshed"])
    return rows.select("_id", "id", _joined("description"), F.get("repository.url", F.lit(0)).alias("repository"), "test", F.array_join("input.term", "|").alias("inputs"), F.array_join("documentation.content", "|").alias("help"))


@query(
    "source_galaxy",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, 'galaxy/tool' || p_partkey || '/cmd/' || CASE WHEN p_size > 40 THEN 'None' ELSE CAST(p_size AS VARCHAR) END AS id, p_name AS label, CASE WHEN p_size % 2 = 0 THEN 'https://home.org/' ELSE '' END AS webpage, '["macOS","Linux"]' AS systems FROM part""",
)
def source_galaxy(spark, sf_dir):
    fields = {"@label": _cat("Tool", _key()), "@version": F.when(F.col("p_size") <= 40, _size()), "name": F.col("p_name"), "web": F.struct(F.when(F.col("p_size") % 2 == 0, F.lit("HTTPS://Home.org")).otherwise(F.lit("not a page")).alias("homepage"))}
    rows = standardize(_raw(spark, sf_dir, "galaxy", fields), ["galaxy"])
    return rows.select("_id", "id", _joined("label"), _joined("webpage"), F.try_element_at("extra", F.lit("operating_systems")).alias("systems"))


@query("source_opeb_metrics", "SELECT CAST(p_partkey AS VARCHAR) AS _id, 'opeb_metrics/Tool' || p_partkey || '/' || CASE WHEN p_size > 25 THEN 'web' ELSE 'None' END || '/' || CASE WHEN p_size % 2 = 0 THEN 'None' ELSE CAST(p_size AS VARCHAR) END AS id FROM part")
def source_opeb_metrics(spark, sf_dir):
    """A type that is none of the permitted ones is left out."""
    version = F.when(F.col("p_size") % 2 == 1, _cat(":", _size())).otherwise(F.lit(""))
    kind = F.when(F.col("p_size") > 25, F.lit("web")).otherwise(F.lit("gadget"))
    return standardize(_raw(spark, sf_dir, "opeb_metrics", {"@id": _cat("https://host/monitor/metrics/biotools:Tool", _key(), version, "/", kind, "/host")}), ["opeb_metrics"]).select("_id", "id")


@query(
    "source_sourceforge",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, 'sourceforge/tool' || p_partkey || '/None/None' AS id, 'http://home.org/' || p_partkey || '|https://two.org/' AS webpage, 'https://sourceforge.net/projects/Tool' || p_partkey AS repository,
      CASE WHEN p_size > 30 THEN '' ELSE 'Linux|Windows' END AS operating_system, p_type || ' v2' AS license FROM part""",
)
def source_sourceforge(spark, sf_dir):
    """Pages without a scheme get one; one unknown system empties the field."""
    systems = F.array(F.lit(" Linux"), F.when(F.col("p_size") > 30, F.lit("Amiga")).otherwise(F.lit("Windows ")))
    fields = {"description": F.col("p_name"), "homepage": F.array(_cat("home.org/", _key()), F.lit("https://two.org")), "operating_systems": systems, "license": F.array(_cat(F.col("p_type"), "+ v2 file"))}
    rows = standardize(_raw(spark, sf_dir, "sourceforge", fields, _cat("https://sourceforge.net/projects/Tool", _key())), ["sourceforge"])
    return rows.select("_id", "id", _joined("webpage"), F.array_join("repository.url", "|").alias("repository"), _joined("operating_system"), F.array_join("license.name", "|").alias("license"))


@query(
    "source_github",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS _id, 'github/Tool' || p_partkey || '/None/' || p_size AS id, 'https://github.com/own/t' || p_partkey || ':github' AS repository, CASE WHEN p_size > 45 THEN '' ELSE 'Ann:Person|Group:Organization' END AS people,
      CASE WHEN p_size % 2 = 0 THEN 'Linux|macOS' ELSE '' END AS operating_system, 'http://edam/topic_' || lpad(CAST(p_size AS VARCHAR), 4, '0') AS topics, CASE WHEN p_size % 3 = 0 THEN '["p1"]' END AS publications FROM part""",
)
def source_github(spark, sf_dir):
    """A person is a Person, an institute an Organization, and a contributor of another kind empties the field."""
    who = lambda t, n: F.struct(t.alias("type"), F.lit(n).alias("name"))
    kind = F.when(F.col("p_size") > 45, F.lit("robot")).otherwise(F.lit("institute"))
    fields = {
        "name": _cat("Tool", _key()), "version": F.array(_size()), "repository": F.array(_cat("https://github.com/own/t", _key()), F.lit("https://github.com/other/x")), "authors": F.array(who(F.lit("person"), "Ann"), who(kind, "Group")),
        "os": F.array(F.lit("Linux"), F.when(F.col("p_size") % 2 == 0, F.lit("Mac")).otherwise(F.lit("Plan 9"))), "topics": F.array(_cat("http://edam/topic_", F.lpad(_size(), 4, "0"))), "publication": F.when(F.col("p_size") % 3 == 0, F.array(F.lit("p1"))),
    }
    rows = standardize(_raw(spark, sf_dir, "github", fields), ["github"])
    return rows.select(
        "_id", "id", F.array_join(F.transform("repository", lambda r: F.concat_ws(":", r["url"], r["kind"])), "|").alias("repository"), F.array_join(F.transform("authors", lambda a: F.concat_ws(":", a["name"], a["type"])), "|").alias("people"),
        _joined("operating_system"), F.array_join("topics.term", "|").alias("topics"), F.try_element_at("extra", F.lit("publications")).alias("publications"),
    )


# --- publications ------------------------------------------------------------

_PUB = ["_id", "doi", "pmid", "pmcid", "title", "year"]


def _item(**fields: Column) -> Column:
    return F.struct(*(c.alias(k) for k, c in fields.items()))


@query(
    "publications_biotools",
    "SELECT CAST(p_partkey AS VARCHAR) AS _id, CASE WHEN p_size % 2 = 0 THEN '10.1000/x' || p_partkey END AS doi, CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS pmid, CASE WHEN p_size > 9 THEN 'PMC' || p_size END AS pmcid, p_name AS title, CAST(1980 + p_size AS INTEGER) AS year FROM part",
)
def publications_biotools(spark, sf_dir):
    """Identifiers that break their pattern become null; the resolver's address goes."""
    doi = F.when(F.col("p_size") % 2 == 0, _cat("https://doi.org/10.1000/x", _key())).otherwise(_cat("doi ", _key()))
    pmid = F.when(F.col("p_size") % 3 == 0, _cat("PM", _size())).otherwise(_size())
    pmcid = F.when(F.col("p_size") > 9, _cat("PMC", _size())).otherwise(_size())
    item = _item(doi=doi, pmid=pmid, pmcid=pmcid, title=F.col("p_name"), year=(F.col("p_size") + 1980).cast("string"))
    return publications.extract(_raw(spark, sf_dir, "biotools", {"publications": F.array(item)}), "biotools").select(*_PUB)


@query("publications_bioconductor", "SELECT CAST(p_partkey AS VARCHAR) AS _id, '10.1000/b' || p_partkey AS doi, CAST(NULL AS VARCHAR) AS pmid, CAST(NULL AS VARCHAR) AS pmcid, p_name AS title, CASE WHEN p_size % 2 = 0 THEN CAST(1970 + p_size AS INTEGER) END AS year FROM part WHERE p_size > 2")
def publications_bioconductor(spark, sf_dir):
    year = F.when(F.col("p_size") % 2 == 0, (F.col("p_size") + 1970).cast("string"))
    item = _item(doi=_cat("10.1000/b", _key()), title=F.col("p_name"), published_year=year)
    found = F.when(F.col("p_size") > 2, F.array(item))
    return publications.extract(_raw(spark, sf_dir, "bioconductor", {"publication": found}), "bioconductor").select(*_PUB)


@query("publications_metrics", "SELECT CAST(p_partkey AS VARCHAR) AS _id, '10.1000/m' || p_partkey || '.' || k AS doi, CAST(k AS VARCHAR) AS pmid, CAST(NULL AS VARCHAR) AS pmcid, p_brand AS title, CAST(2000 + k AS INTEGER) AS year FROM part, range(1, 4) t(k) WHERE k < 3 OR p_size > 20")
def publications_metrics(spark, sf_dir):
    """Publications lie in lists of lists."""
    item = lambda k: _item(doi=_cat("10.1000/m", _key(), f".{k}"), pmid=F.lit(str(k)), title=F.col("p_brand"), year=F.lit(str(2000 + k)))
    entries = lambda *ks: F.struct(F.array(*(item(k) for k in ks)).alias("entries"))
    project = F.struct(F.when(F.col("p_size") > 20, F.array(entries(1, 2), entries(3))).otherwise(F.array(entries(1, 2))).alias("publications"))
    return publications.extract(_raw(spark, sf_dir, "opeb_metrics", {"project": project}), "opeb_metrics").select(*_PUB)


@query("publications_recipes", "SELECT _id, doi FROM (SELECT CAST(p_partkey AS VARCHAR) AS _id, unnest(CASE WHEN p_size % 2 = 0 THEN ['10.1000/r' || p_partkey] ELSE ['10.1000/r' || p_partkey, '10.2000/s'] END) AS doi FROM part)")
def publications_recipes(spark, sf_dir):
    """DOIs of identifiers and of their own field, each once; NA is none."""
    ids = F.array(_cat("doi:10.1000/r", _key()), F.lit("biotools:x"))
    dois = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("NA"), _cat("https://doi.org/10.1000/r", _key()))).otherwise(F.array(F.lit("10.2000/s")))
    return publications.extract(_raw(spark, sf_dir, "bioconda_recipes", {"extra": F.struct(ids.alias("identifiers"), dois.alias("doi"))}), "bioconda_recipes").select("_id", "doi")


@query("publications_toolshed", "SELECT CAST(p_partkey AS VARCHAR) AS _id, unnest(['10.1000/d' || p_partkey, '10.1000/a' || p_partkey]) AS doi, unnest([NULL, p_name]) AS title, CAST(unnest([NULL, 1999]) AS INTEGER) AS year FROM part")
def publications_toolshed(spark, sf_dir):
    """DOIs as they are, records of BibTeX besides misc."""
    bib = _cat("@article{a, title = {", F.col("p_name"), "}, year = 1999, doi = \"10.1000/a", _key(), "\"}\n@misc{m, title={No}}")
    item = lambda t, v: F.struct(F.lit(t).alias("type"), v.alias("value"))
    raw = _raw(spark, sf_dir, "toolshed", {"citation": F.array(item("doi", _cat("10.1000/d", _key())), item("bibtex", bib))})
    return publications.extract(raw, "toolshed").select("_id", "doi", "title", "year")


@query("clean_dois", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '10.1000/' || p_type ELSE p_brand END AS doi FROM part")
def clean_dois(spark, sf_dir):
    doi = F.when(F.col("p_size") % 2 == 0, _cat("https://doi.org/10.1000/", F.col("p_type"))).otherwise(F.col("p_brand"))
    return _t(spark, sf_dir, "part").select("p_partkey", publications.clean_doi(doi).alias("doi"))


# --- links, names, pages -----------------------------------------------------


@query(
    "link_finders",
    """
    SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'https://github.com/own-er/t' || p_partkey END AS github, CASE p_size % 5 WHEN 1 THEN 'http://www.bitbucket.org/o/t' || p_partkey END AS bitbucket,
      CASE p_size % 5 WHEN 2 THEN 'bioconductor.org/packages/release/bioc/html/t' || p_partkey || '.html' END AS bioconductor, CASE p_size % 5 WHEN 3 THEN 'https://usegalaxy.eu' END AS galaxy, CASE p_size % 5 WHEN 4 THEN 'toolshed.galaxyproject.org' END AS toolshed FROM part""",
)
def link_finders(spark, sf_dir):
    n = F.col("p_size") % 5
    link = F.when(n == 0, _cat("see https://github.com/own-er/t", _key(), "/wiki")).when(n == 1, _cat("http://www.bitbucket.org/o/t", _key(), "?x")).when(n == 2, _cat("bioconductor.org/packages/release/bioc/html/t", _key(), ".html#a"))
    link = link.when(n == 3, F.lit("https://usegalaxy.eu/root?tool=1")).otherwise(F.lit("toolshed.galaxyproject.org/view"))
    return _t(spark, sf_dir, "part").select(
        "p_partkey", urls.github_link(link).alias("github"), urls.bitbucket_link(link).alias("bitbucket"), urls.bioconductor_link(link).alias("bioconductor"), urls.galaxy_link(link).alias("galaxy"), urls.toolshed_link(link).alias("toolshed")
    )


@query(
    "source_pages",
    """
    WITH r AS (SELECT p_partkey, unnest(CASE p_size % 4 WHEN 0 THEN ['biotools=https://bio.tools/t' || p_partkey, 'galaxy=https://usegalaxy.eu/'] WHEN 1 THEN ['bioconda=https://anaconda.org/bioconda/t' || p_partkey, 'github=https://github.com/o/t' || p_partkey]
      WHEN 2 THEN ['github='] ELSE ['toolshed=https://toolshed.g2.bx.psu.edu/repository', 'sourceforge=https://sourceforge.net/projects/t' || p_partkey] END) AS page FROM part)
    SELECT p_partkey, string_agg(page, '|' ORDER BY page) AS pages FROM r GROUP BY p_partkey""",
)
def source_pages(spark, sf_dir):
    """Landing pages by source and name; one that a link shows goes before, and a source without either has an empty one."""
    n = F.col("p_size") % 4
    lit = lambda *x: F.array(*map(F.lit, x))
    sources = F.when(n == 0, lit("biotools", "galaxy")).when(n == 1, lit("bioconda_recipes", "github")).when(n == 2, lit("github")).otherwise(lit("galaxy_metadata", "sourceforge"))
    links = F.when(n == 1, F.array(_cat("https://github.com/o/t", _key()))).otherwise(F.array().cast("array<string>"))
    pages = urls.source_pages(sources, _cat("t", _key()), links)
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_sort(F.transform(F.map_entries(pages), lambda e: F.concat_ws("=", e["key"], e["value"]))), "|").alias("pages"))


@query("licence_names", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN 'GPL-' || p_size ELSE 'see' END AS name FROM part")
def licence_names(spark, sf_dir):
    name = F.when(F.col("p_size") % 3 == 0, _cat(F.col("p_type"), "...")).when(F.col("p_size") % 3 == 1, _cat("GPL-", _size(), "+ LICENSE")).otherwise(F.lit("see file LICENSE"))
    return _t(spark, sf_dir, "part").select("p_partkey", licensing.clean_licence(name).alias("name"))


@query("standard_licences", "SELECT p_partkey, CASE WHEN p_size % 3 < 2 THEN 'N-' || (p_size % 25) END AS spdx_id, CASE WHEN p_size % 3 < 2 THEN 'https://spdx.org/licenses/N-' || (p_size % 25) END AS spdx_url FROM part")
def standard_licences(spark, sf_dir):
    """Names or synonyms of the standard list, cases apart; nations stand for it."""
    n, number = _t(spark, sf_dir, "nation"), F.col("n_nationkey").cast("string")
    spdx = n.select(_cat("N-", number).alias("license_id"), F.col("n_name").alias("name"), F.array(_cat("Other Name ", number)).alias("synonyms"), _cat("https://spdx.org/licenses/N-", number).alias("url"))
    of = (F.col("p_size") % 25).cast("string")
    name = F.when(F.col("p_size") % 3 == 0, _cat("nation_", of)).when(F.col("p_size") % 3 == 1, _cat("OTHER name ", of)).otherwise(F.lit("none such"))
    return licensing.spdx_names(_t(spark, sf_dir, "part").select("p_partkey", name.alias("name")), "name", spdx).select("p_partkey", "spdx_id", "spdx_url")


@query(
    "vocabulary_fields",
    "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'NATION_' || (p_size % 25) || '=' || (p_size % 25) WHEN 1 THEN 'nation_3=3' ELSE '' END AS items FROM part",
)
def vocabulary_fields(spark, sf_dir):
    """An address gets its label, a term its address; a term that the vocabulary lacks empties the whole field."""
    nation, none = _t(spark, sf_dir, "nation"), F.lit(None).cast("string")
    words = nation.select(F.col("n_nationkey").cast("string").alias("uri"), F.col("n_name").alias("label"), F.col("n_nationkey").alias("ord"))
    item = lambda term, uri: F.struct(none.alias("vocabulary"), term.alias("term"), uri.alias("uri"), F.lit(None).cast("struct<vocabulary: string, term: string, uri: string>").alias("datatype"))
    of = (F.col("p_size") % 25).cast("string")
    items = F.when(F.col("p_size") % 3 == 0, F.array(item(none, of))).when(F.col("p_size") % 3 == 1, F.array(item(F.lit("nation_3"), none))).otherwise(F.array(item(F.lit("nation_3"), none), item(F.lit("nowhere"), none)))
    found = with_vocabulary(_t(spark, sf_dir, "part").select("p_partkey", items.alias("x")), "x", words, "p_partkey")
    return found.select("p_partkey", F.array_join(F.transform("x", lambda i: F.concat_ws("=", i["term"], i["uri"])), "|").alias("items"))


@query("clean_pages", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'https://a.org/' || p_partkey WHEN 1 THEN 'http://b.org' WHEN 2 THEN 'https://c.org' END AS page FROM part")
def clean_pages(spark, sf_dir):
    page = F.when(F.col("p_size") % 4 == 0, _cat("<https://a.org/", _key(), ">")).when(F.col("p_size") % 4 == 1, F.lit(" http//b.org")).when(F.col("p_size") % 4 == 2, F.lit('"c.org"')).otherwise(F.lit("  "))
    return _t(spark, sf_dir, "part").select("p_partkey", urls.clean_webpage(page).alias("page"))


@query("clean_emails", "SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN 'c' || c_custkey || '@x-y.org' END AS email FROM customer")
def clean_emails(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    email = F.when(F.col("c_custkey") % 3 == 0, _cat("c", k, "@x-y.org;")).when(F.col("c_custkey") % 3 == 1, _cat("c", k, "@x-y.org")).otherwise(_cat("c", k, " at x"))
    return _t(spark, sf_dir, "customer").select("c_custkey", text.clean_email(email).alias("email"))


@query("organisations", "SELECT c_custkey, c_custkey % 3 = 0 AS is_organisation, CASE c_custkey % 4 WHEN 0 THEN 'Person' WHEN 1 THEN 'Organization' ELSE c_mktsegment END AS kind FROM customer")
def organisations(spark, sf_dir):
    """Contributors whose names hold a word for an organisation, and kinds of contributors."""
    name = F.when(F.col("c_custkey") % 3 == 0, _cat(F.col("c_mktsegment"), " University of X")).otherwise(F.col("c_name"))
    kind = F.when(F.col("c_custkey") % 4 == 1, F.lit("Institute")).otherwise(F.col("c_mktsegment"))
    orcid = F.when(F.col("c_custkey") % 4 == 0, F.lit("0000"))
    return _t(spark, sf_dir, "customer").select("c_custkey", text.is_organisation(name).alias("is_organisation"), text.contributor_type(kind, orcid).alias("kind"))


@query("project_sections", "SELECT p_partkey, p_name || ' of ' || p_brand AS description, 'One ' || p_type || '|Two' AS sections, 'a' || p_partkey || '|b' AS links FROM part")
def project_sections(spark, sf_dir):
    html = _cat("<html><p class='x description'>", F.col("p_name"), " <b>of</b>\n ", F.col("p_brand"), "</p><section>One <a href='a", _key(), "'>", F.col("p_type"), "</a></section><section id='2'><a href=\"b\">Two</a></section></html>")
    found = _t(spark, sf_dir, "part").select("p_partkey", text.project_sections(html).alias("s")).select("p_partkey", "s.*")
    return found.select("p_partkey", "description", F.array_join("sections.text", "|").alias("sections"), F.array_join(F.flatten("sections.links"), "|").alias("links"))


@query(
    "live_pages",
    "SELECT page_id, page_id % 3 < 2 AS works, CASE page_id % 3 WHEN 0 THEN 'https://' WHEN 1 THEN 'http://' END || regexp_replace(url, '^https?://', '') || '#' || page_id AS works_at FROM pages",
)
def live_pages(spark, sf_dir):
    """Whether an address answers, https before http; answers are a table."""
    pages = _t(spark, sf_dir, "pages").select("page_id", _cat(F.col("url"), "#", F.col("page_id").cast("string")).alias("url"))
    bare = F.regexp_replace("url", "^https?://", "")
    answer = lambda scheme, ok: pages.select(F.concat(F.lit(scheme), bare).alias("url"), F.when(ok, 200).otherwise(404).alias("status"))
    status = answer("https://", F.col("page_id") % 3 == 0).union(answer("http://", F.col("page_id") % 3 < 2))
    return documents.alive(pages, "url", status).select("page_id", "works", "works_at")


@query("fetched_content", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'html' END AS kind, CASE WHEN page_id % 2 = 0 THEN CAST(length(html) AS INTEGER) END AS n FROM pages")
def fetched_content(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").withColumn("at", _cat(F.col("url"), "#", F.col("page_id").cast("string")))
    none = F.lit(None).cast("string")
    content = p.where("page_id % 2 = 0").select(F.col("at").alias("url"), F.lit("html").alias("kind"), none.alias("metadata"), none.alias("readme"), "html")
    return documents.with_content(p.select("page_id", "at"), "at", content).select("page_id", "kind", F.length("html").alias("n"))


# --- tables ------------------------------------------------------------------


@query("filtered_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def filtered_scan(spark, sf_dir):
    return documents.scan(spark, f"{sf_dir}/orders.parquet", "o_orderstatus = 'F' AND o_totalprice > 100000", ["o_orderkey", "o_totalprice"])


@query("first_of_key", "SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey")
def first_of_key(spark, sf_dir):
    return documents.first_by(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderkey")


@query("existing_rows", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def existing_rows(spark, sf_dir):
    keys = _t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return documents.existing(_t(spark, sf_dir, "customer").select("c_custkey"), keys, "c_custkey")


@query("metadata_alone", "SELECT doc_id, lang, source FROM documents")
def metadata_alone(spark, sf_dir):
    return documents.without_payload(_t(spark, sf_dir, "documents"), "text", "n_chars")


@query("updated_columns", "SELECT c_custkey, c_name, CASE WHEN c_nationkey = 3 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def updated_columns(spark, sf_dir):
    """Rows of a nation get another segment, twice the same; keys that don't exist add no row."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    new = c.where("c_nationkey = 3").select("c_custkey", F.lit("MOVED").alias("c_mktsegment"))
    new = new.union(new).union(c.select(-F.col("c_custkey") - 1, F.lit("NEVER")))
    return documents.update_columns(c.drop("c_nationkey"), new, "c_custkey", ["c_mktsegment"])


@query("deleted_rows", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def deleted_rows(spark, sf_dir):
    urgent = _t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return documents.delete(_t(spark, sf_dir, "customer").select("c_custkey"), urgent, "c_custkey")


@query("required_lookup", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def required_lookup(spark, sf_dir):
    return documents.looked_up(_t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", _t(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey").select("c_custkey", "n_name")


@query("object_lines", "SELECT '{\"e' || event_id || '\":{\"u\":' || user_id || '}}' AS value FROM events")
def object_lines(spark, sf_dir):
    """Objects with a key for each event, one for each user, as one line for each event."""
    item = F.format_string('"e%d": {"u": %d}', "event_id", "user_id")
    whole = _t(spark, sf_dir, "events").groupBy("user_id").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(item), ", "), F.lit("}")).alias("json"))
    return documents.object_to_lines(whole, "json")


@query("concatenated_objects", "SELECT user_id, event_id FROM events")
def concatenated_objects(spark, sf_dir):
    """All objects of a user written one after another, and split again."""
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", F.to_json(F.struct("user_id", "event_id")).alias("j"))
    runs = e.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list("j")), " ").alias("text"))
    return documents.split_concatenated(runs, "text").select(F.from_json("value", "user_id long, event_id long").alias("x")).select("x.*")


@query("comment_decisions", "SELECT conv_id AS issue, 'd' || max(turn) FILTER (turn % 2 = 1) AS decision, 'high' AS confidence FROM conversations GROUP BY conv_id HAVING max(turn) FILTER (turn % 2 = 1) IS NOT NULL")
def comment_decisions(spark, sf_dir):
    """The newest comment of an issue with a block that can be read."""
    body = F.when(F.col("turn") % 2 == 1, _cat("So\n```json\n{\"decision\": \"d", F.col("turn").cast("string"), "\", \"confidence\": \"high\"}\n```\nbye")).otherwise(F.lit("```json\nno decision\n```"))
    return documents.decisions_from_comments(_t(spark, sf_dir, "conversations").withColumn("body", body), "conv_id", "turn", "body").select("issue", "decision", "confidence")
