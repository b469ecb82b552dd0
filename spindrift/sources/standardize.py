"""Per-source projections of raw documents into one schema.

A raw document is (_id, data_source, source_url, data), data being JSON. Each
source is one select; all of them are united by name. The projection reads JSON
paths with built-in functions, so it stays in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.functions.bibtex import bibtex_entries
from spindrift.functions.licensing import clean_licence
from spindrift.functions.text import clean_email, contributor_type, entry_id, monitor_id, normalize_descriptions
from spindrift.functions.urls import canonical_url, clean_webpage, is_file_like, is_web_url, repository_kind, repository_of

REPOSITORY = "array<struct<url: string, kind: string>>"
DOCUMENT = "array<struct<type: string, url: string, content: string>>"
LICENCE = "array<struct<name: string, url: string>>"
AUTHOR = "array<struct<type: string, name: string, email: string, maintainer: boolean, url: string, orcid: string>>"
TERM = "struct<vocabulary: string, term: string, uri: string>"
FORMAT = f"array<struct<vocabulary: string, term: string, uri: string, datatype: {TERM}>>"
WORDS = "array<string>"

#: Columns of a standardized entry and their types.
FIELDS = {
    "name": "string", "type": "string", "version": WORDS, "label": WORDS, "source": WORDS, "description": WORDS, "links": WORDS, "webpage": WORDS, "download": WORDS,
    "repository": REPOSITORY, "operating_system": WORDS, "source_code": WORDS, "test": "boolean", "dependencies": WORDS, "tags": WORDS, "input": FORMAT, "output": FORMAT,
    "documentation": DOCUMENT, "license": LICENCE, "authors": AUTHOR, "topics": f"array<{TERM}>", "operations": f"array<{TERM}>", "extra": "map<string, string>",
}

#: Values that the fields permit. Fixed values.
TYPES = ["cmd", "web", "db", "app", "lib", "ontology", "workflow", "plugin", "sparql", "soap", "script", "rest", "workbench", "suite", "undefined"]
SYSTEMS = ["Linux", "Windows", "macOS", "BSD", "Solaris", "Android", "iOS", "ChromeOS", "other"]
CONTRIBUTORS = ["Person", "Organization"]


def text(path: str) -> Column:
    """A JSON string, or null for a missing or empty one."""
    return F.nullif(F.get_json_object("data", path), F.lit(""))


def words(path: str) -> Column:
    """A JSON string or array of strings as an array, empty ones left out; empty if missing."""
    raw = text(path)
    many = F.from_json(F.when(raw.startswith("["), raw).otherwise(F.to_json(F.array(raw))), WORDS)
    return F.when(raw.isNull(), F.array().cast(WORDS)).otherwise(F.filter(many, lambda x: x.isNotNull() & (x != "")))


def parsed(path: str, kind: str) -> Column:
    return F.coalesce(F.from_json(text(path), kind), F.from_json(F.lit("[]"), kind))


def several(value: Column) -> Column:
    """An array of one value, or an empty one for null."""
    return F.filter(F.array(value), lambda x: x.isNotNull())


def _repositories(urls: Column) -> Column:
    return F.transform(urls, lambda u: F.struct(u.alias("url"), repository_kind(u).alias("kind")))


def _documents(*pairs: tuple[str, Column]) -> Column:
    rows = [F.struct(F.lit(t).alias("type"), u.alias("url"), F.lit(None).cast("string").alias("content")) for t, u in pairs]
    return F.filter(F.array(*rows), lambda x: x["url"].isNotNull())


def _licences(names: Column) -> Column:
    """Addresses and names told apart."""
    return F.transform(names, lambda x: F.struct(F.when(~is_web_url(x), clean_licence(x)).alias("name"), F.when(is_web_url(x), x).alias("url")))


def _people(names: Column, maintainer: bool) -> Column:
    none = F.lit(None).cast("string")
    one = lambda x: ~x.contains(" ")  # a user's name on the forge
    return F.transform(
        names,
        lambda x: F.struct(F.lit("Person").alias("type"), F.when(~one(x), x).alias("name"), none.alias("email"), F.lit(maintainer).alias("maintainer"), F.when(one(x), F.concat(F.lit("https://github.com/"), x)).alias("url"), none.alias("orcid")),
    )


def _names(path: str) -> Column:
    """Names given as an array, or as one string with commas and 'and'."""
    raw = text(path)
    return F.when(raw.startswith("["), words(path)).when(raw.isNotNull(), F.split(F.replace(raw, F.lit(" and "), F.lit(", ")), ", ")).otherwise(F.array().cast(WORDS))


def _readme(name: Column) -> Column:
    page = F.concat(F.lit("https://bioconda.github.io/recipes/"), name, F.lit("/README.html"))
    return _documents(("installation_instructions", page), ("general", page))


def bioconda(rows: DataFrame) -> dict[str, Column]:
    at = monitor_id(text("$['@id']"))
    dist = F.from_json(text("$.distributions"), "map<string, array<string>>")
    urls = lambda m: F.coalesce(F.flatten(F.map_values(F.map_filter(m, lambda k, v: v.isNotNull()))), F.array().cast(WORDS))
    return {
        "name": at["name"], "type": at["type"], "version": F.array(at["version"]), "label": several(text("$.name")), "source": F.array(F.lit("bioconda")),
        "description": several(text("$.description")), "webpage": several(text("$.web.homepage")), "operating_system": F.array(*map(F.lit, ("Linux", "macOS", "Windows"))),
        "source_code": urls(F.map_filter(dist, lambda k, v: k.contains("source"))), "download": urls(dist), "documentation": _readme(text("$.name")),
        "license": _licences(several(text("$.license"))), "repository": _repositories(F.filter(words("$.repositories"), is_web_url)), "test": F.lit(False),
    }


def bioconda_recipes(rows: DataFrame) -> dict[str, Column]:
    source_urls = F.when(text("$.source").startswith("["), F.filter(F.transform(F.from_json(text("$.source"), "array<struct<url: string>>"), lambda s: s["url"]), lambda u: u.isNotNull())).otherwise(words("$.source.url"))
    code = F.when(text("$.source").startswith("{"), words("$.source.url")).otherwise(F.array().cast(WORDS))
    places = F.concat(several(text("$.about.home")), several(text("$.about.dev_url")), source_urls)
    repository = F.slice(F.filter(F.transform(places, repository_of), lambda r: r.isNotNull()), 1, 1)
    docs, doc_url = text("$.about.docs"), text("$.about.doc_url")
    more = F.when(docs.isNotNull(), F.when(is_web_url(docs), docs)).when(is_web_url(doc_url), text("$.about.home"))
    maintainers, people = _names("$.about.maintainers"), _names("$.about.authors")
    return {
        "name": F.lower(text("$.name")), "type": F.coalesce(text("$['@type']"), F.lit("cmd")), "version": several(text("$.package.version")), "label": several(text("$.name")),
        "source": F.array(F.lit("bioconda_recipes")), "description": several(F.coalesce(text("$.about.description"), text("$.about.summary"))), "webpage": several(text("$.about.home")),
        "source_code": code, "download": code, "documentation": F.concat(_readme(text("$.name")), _documents(("general", more))),
        "repository": F.transform(repository, lambda r: F.struct(r["url"].alias("url"), r["kind"].alias("kind"))), "operating_system": F.array(*map(F.lit, ("Linux", "macOS", "Windows"))),
        "license": _licences(several(text("$.about.license"))), "dependencies": words("$.requirements.run"), "test": F.lit(False),
        "authors": F.concat(_people(maintainers, True), _people(F.filter(people, lambda p: ~F.array_contains(maintainers, p)), False)),
    }


def bioconductor(rows: DataFrame) -> dict[str, Column]:
    page = text("$.URL")
    package = F.replace(F.col("source_url"), F.lit("https://git.bioconductor.org/packages/"), F.lit("https://bioconductor.org/packages/"))
    pages = F.filter(F.transform(F.split(page, ", "), clean_webpage), lambda x: x.isNotNull())
    webpage = F.when(page == "TBA", F.array().cast(WORDS)).when(page.isNotNull() & (F.size(pages) > 0), pages).otherwise(several(package))
    person = "array<struct<name: string, roles: array<string>, email: string, orcid: string>>"
    maintainers = F.filter(parsed("$.Maintainer", person), lambda x: x["name"].isNotNull() & (x["name"] != ""))
    authors = F.filter(parsed("$['Authors@R (parsed)']", person), lambda x: x["name"].isNotNull() & (x["name"] != ""))
    others = F.filter(authors, lambda x: ~F.array_contains(F.transform(maintainers, lambda m: m["name"]), x["name"]))
    none = F.lit(None).cast("string")
    as_author = lambda xs, m: F.transform(xs, lambda x: F.struct(F.when(x["orcid"].isNotNull(), F.lit("Person")).alias("type"), x["name"].alias("name"), clean_email(x["email"]).alias("email"), F.lit(m).alias("maintainer"), none.alias("url"), x["orcid"].alias("orcid")))
    bugs = F.nullif(F.regexp_extract(text("$.BugReports"), r"https://github\.com/[A-Za-z0-9][A-Za-z0-9_-]*/[A-Za-z0-9_.-]+", 0), F.lit(""))
    return {
        "name": F.lower(text("$.Package")), "type": F.lit("lib"), "version": several(text("$.Version")), "label": several(text("$.Package")), "source": F.array(F.lit("bioconductor")),
        "description": several(text("$.Description")), "webpage": webpage, "repository": _repositories(F.concat(several(F.col("source_url")), several(bugs))),
        "operating_system": F.array(*map(F.lit, ("Linux", "macOS", "Windows"))), "license": _licences(words("$.License")),
        "dependencies": F.transform(F.concat(words("$.Depends"), words("$.Imports")), lambda x: F.trim(x)), "authors": F.concat(as_author(maintainers, True), as_author(others, False)), "test": F.lit(False),
    }


def biotools(rows: DataFrame) -> dict[str, Column]:
    docs = F.from_json(text("$.documentation"), "map<string, string>")
    links = F.coalesce(F.from_json(F.try_element_at(docs, F.lit("doc_links")), WORDS), F.array().cast(WORDS))
    none = F.lit(None).cast("string")
    general = F.transform(F.filter(links, lambda x: x != ""), lambda u: F.struct(F.lit("general").alias("type"), u.alias("url"), none.alias("content")))
    named = F.transform(F.map_entries(F.map_filter(docs, lambda k, v: (k != "doc_links") & v.isNotNull() & (v != ""))), lambda e: F.struct(e["key"].alias("type"), e["value"].alias("url"), none.alias("content")))
    blank = F.array().cast(DOCUMENT)
    edam = F.lit("EDAM")
    term = lambda uri: F.struct(edam.alias("vocabulary"), none.alias("term"), uri.alias("uri"))

    def formats(path):
        items = parsed(path, "array<struct<datatype: string, formats: array<string>>>")
        kind = lambda i: F.when(i["datatype"].isNotNull(), term(i["datatype"]))
        some = lambda i: F.transform(i["formats"], lambda f: F.struct(edam.alias("vocabulary"), none.alias("term"), f.alias("uri"), kind(i).alias("datatype")))
        bare = lambda i: F.filter(F.array(F.struct(none.alias("vocabulary"), none.alias("term"), none.alias("uri"), kind(i).alias("datatype"))), lambda x: x["datatype"].isNotNull())
        return F.flatten(F.transform(items, lambda i: F.when(F.size(i["formats"]) > 0, some(i)).otherwise(bare(i))))

    label = text("$['@label']")
    return {
        "name": F.lower(label), "type": text("$['@type']"), "version": F.array(text("$['@version']")), "label": several(F.coalesce(text("$.name"), label)), "source": F.array(F.lit("biotools")),
        "description": several(text("$.description")), "webpage": several(text("$.web.homepage")), "license": _licences(words("$.license")),
        "documentation": F.concat(general, F.coalesce(named, blank)), "operating_system": words("$.os"), "repository": _repositories(words("$.repositories")),
        "input": formats("$.semantics.inputs"), "output": formats("$.semantics.outputs"), "topics": F.transform(words("$.semantics.topics"), term), "operations": F.transform(words("$.semantics.operations"), term),
        "authors": parsed("$.credits", AUTHOR), "tags": words("$.tags"), "links": words("$.links"), "test": F.lit(False),
    }


def _typed_terms(path: str) -> Column:
    none = F.lit(None).cast("string")
    return F.transform(words(path), lambda t: F.struct(none.alias("vocabulary"), t.alias("term"), none.alias("uri"), F.lit(None).cast(TERM).alias("datatype")))


def toolshed(rows: DataFrame) -> dict[str, Column]:
    """The repository column comes from BibTeX and is filled in by _with_bibtex."""
    none = F.lit(None).cast("string")
    help_ = F.filter(F.array(F.struct(F.lit("help").alias("type"), none.alias("url"), text("$.help").alias("content"))), lambda x: x["content"].isNotNull())
    return {
        "name": F.when(text("$.id").isNotNull(), F.lower(text("$.id"))), "type": F.lit("cmd"), "version": several(text("$.version")), "label": several(text("$.name")), "source": F.array(F.lit("toolshed")),
        "description": several(F.nullif(F.trim(text("$.description")), F.lit(""))), "operating_system": F.array(*map(F.lit, ("Linux", "macOS"))), "documentation": help_,
        "input": _typed_terms("$.dataFormats.inputs"), "output": _typed_terms("$.dataFormats.outputs"), "repository": F.col("_bibtex"), "test": F.coalesce(text("$.tests").isNotNull() & (text("$.tests") != "false"), F.lit(False)),
    }


def galaxy_metadata(rows: DataFrame) -> dict[str, Column]:
    return {"name": F.when(text("$.id").isNotNull(), F.lower(text("$.id"))), "type": F.lit("cmd"), "version": several(text("$.version")), "label": several(text("$.name")), "source": F.array(F.lit("galaxy_metadata")), "dependencies": words("$.dependencies")}


def galaxy(rows: DataFrame) -> dict[str, Column]:
    """operating_systems is no field of an entry; it stays among the extras."""
    return {
        "name": F.lower(text("$['@label']")), "type": F.lit("cmd"), "version": F.array(text("$['@version']")), "label": several(text("$.name")), "source": F.array(F.lit("galaxy")),
        "description": several(text("$.description")), "webpage": several(text("$.web.homepage")), "extra": F.create_map(F.lit("operating_systems"), F.lit('["macOS","Linux"]')),
    }


def opeb_metrics(rows: DataFrame) -> dict[str, Column]:
    at = monitor_id(text("$['@id']"))
    return {"name": at["name"], "type": at["type"], "version": F.array(at["version"]), "source": F.array(F.lit("opeb_metrics"))}


def sourceforge(rows: DataFrame) -> dict[str, Column]:
    name = F.lower(F.substring_index("source_url", "/", -1))
    page = lambda u: F.when(u.rlike("^https?://"), u).otherwise(F.concat(F.lit("http://"), u))
    none = F.lit(None).cast("string")
    return {
        "name": name, "label": several(name), "source": F.array(F.lit("sourceforge")), "description": several(text("$.description")), "webpage": F.transform(words("$.homepage"), page),
        "repository": _repositories(several(F.coalesce(text("$.repository"), text("$['@source_url']"), F.col("source_url")))), "operating_system": F.transform(words("$.operating_systems"), lambda x: F.trim(x)),
        "download": several(F.col("source_url")), "license": F.transform(words("$.license"), lambda x: F.struct(clean_licence(x).alias("name"), none.alias("url"))),
    }


def github(rows: DataFrame) -> dict[str, Column]:
    """publications is no field of an entry; it stays among the extras."""
    authors = F.transform(parsed("$.authors", AUTHOR), lambda a: a.withField("type", F.when(a["type"] == "person", F.lit("Person")).otherwise(a["type"])))
    none = F.lit(None).cast("string")
    return {
        "name": text("$.name"), "version": words("$.version"), "label": words("$.label"), "source": F.array(F.lit("github")), "description": words("$.description"), "links": words("$.links"), "webpage": words("$.webpage"),
        "download": words("$.download"), "repository": F.transform(F.slice(words("$.repository"), 1, 1), lambda u: F.struct(u.alias("url"), F.lit("github").alias("kind"))), "operating_system": words("$.os"),
        "documentation": parsed("$.documentation", DOCUMENT), "authors": authors, "license": parsed("$.license", LICENCE),
        "topics": F.transform(words("$.topics"), lambda t: F.struct(none.alias("vocabulary"), t.alias("term"), none.alias("uri"))),
        "extra": F.when(text("$.publication").isNotNull(), F.create_map(F.lit("publications"), text("$.publication"))),
    }


#: Projections by source.
STANDARDIZERS = {
    "bioconda": bioconda, "bioconda_recipes": bioconda_recipes, "bioconductor": bioconductor, "biotools": biotools, "toolshed": toolshed, "galaxy_metadata": galaxy_metadata,
    "galaxy": galaxy, "opeb_metrics": opeb_metrics, "sourceforge": sourceforge, "github": github,
}


def _with_bibtex(rows: DataFrame) -> DataFrame:
    """_bibtex: the first repository that the misc records of a document's citations name."""
    cited = F.from_json(text("$.citation"), "array<struct<type: string, value: string>>")
    bib = F.array_join(F.transform(F.filter(cited, lambda c: c["type"] == "bibtex"), lambda c: c["value"]), "\n")
    found = F.filter(bibtex_entries(bib), lambda e: e["type"] == "misc")
    places = F.flatten(F.transform(found, lambda e: F.array(F.try_element_at(e["fields"], F.lit("url")), F.try_element_at(e["fields"], F.lit("crossref")))))
    hits = F.slice(F.filter(F.transform(places, repository_of), lambda r: r.isNotNull()), 1, 1)
    return rows.withColumn("_bibtex", F.coalesce(F.transform(hits, lambda r: F.struct(r["url"].alias("url"), r["kind"].alias("kind"))), F.array().cast(REPOSITORY)))


def standardize(raw: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Entries of the sources (all by default), checked by valid_fields(); documents without a name are left out here and found by quarantine()."""
    return valid_fields(_projected(raw, sources)).where("name IS NOT NULL")


def quarantine(raw: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Documents (_id, data_source) that make no entry, for want of a name or of an id that can be read."""
    return _projected(raw, sources).where("name IS NULL").select("_id", "data_source")


def _projected(raw: DataFrame, sources: list[str] | None) -> DataFrame:
    out = []
    for s in sources or list(STANDARDIZERS):
        if s not in STANDARDIZERS:
            raise ValueError(f"no standardizer is known for source {s!r}")
        rows = raw.where(F.col("data_source") == s)
        rows = _with_bibtex(rows) if s == "toolshed" else rows
        columns = STANDARDIZERS[s](rows)
        blank = {c: F.array().cast(t) if t.startswith("array") else F.lit(None).cast(t) for c, t in FIELDS.items()}
        out.append(rows.select("_id", "data_source", *(F.coalesce(columns[c].cast(t), blank[c]).alias(c) if c in columns else blank[c].alias(c) for c, t in FIELDS.items())))
    out = reduce(DataFrame.unionByName, out)
    return out.withColumn("name", F.nullif(F.trim("name"), F.lit("")))


def _all(column: str, ok) -> Column:
    """The array if all elements are fine, else an empty one."""
    return F.when(F.forall(column, ok), F.col(column)).otherwise(F.slice(F.col(column), 1, 0))


def valid_fields(rows: DataFrame, keep_valid_elements: bool = False) -> DataFrame:
    """Cleans every field and drops those that hold a wrong element (with keep_valid_elements only the wrong elements)."""
    pick = (lambda c, ok: F.filter(c, ok)) if keep_valid_elements else _all
    urls = lambda c: F.transform(c, canonical_url)
    rows = rows.withColumns(
        {
            "type": F.when(F.col("type").isin(TYPES), F.col("type")),
            "version": F.transform("version", lambda v: F.coalesce(v, F.lit("None"))),
            "description": normalize_descriptions(F.col("description")),
            "links": F.filter("links", is_file_like),
            "webpage": F.transform("webpage", lambda u: F.regexp_replace(u, r"^ftp://ftp\.", "")),
            "operating_system": F.transform("operating_system", lambda o: F.when(o == "Mac", F.lit("macOS")).otherwise(o)),
            "source_code": F.array_distinct("source_code"),
            "authors": F.transform("authors", lambda a: a.withField("type", contributor_type(a["type"], a["orcid"]))),
            "test": F.coalesce("test", F.lit(False)),
        }
    )
    rows = rows.withColumns(
        {
            "links": urls(pick("links", is_web_url)),
            "webpage": urls(F.filter(pick("webpage", is_web_url), lambda u: ~is_file_like(u))),
            "source_code": urls(pick("source_code", is_web_url)),
            "download": urls(pick("download", is_web_url)),
            "repository": F.transform(pick("repository", lambda r: is_web_url(r["url"])), lambda r: r.withField("url", canonical_url(r["url"]))),
            "operating_system": pick("operating_system", lambda o: o.isin(SYSTEMS)),
            "authors": pick("authors", lambda a: a["type"].isNull() | a["type"].isin(CONTRIBUTORS)),
            **{c: pick(c, lambda t: t["uri"].isNull() | t["uri"].rlike(r"_\d{4}")) for c in ("topics", "operations")},
            "documentation": F.transform(pick("documentation", lambda d: d["url"].isNull() | is_web_url(d["url"])), lambda d: d.withField("type", F.when(d["type"] == "documentation", F.lit("general")).otherwise(d["type"]))),
        }
    )
    return rows.withColumn("id", entry_id(F.get("source", F.lit(0)), F.col("name"), F.col("type"), F.get("version", F.lit(0))))


def with_vocabulary(rows: DataFrame, column: str, vocabulary: DataFrame, id_col: str = "id", keep_matched: bool = False) -> DataFrame:
    """rows with terms and addresses of an array of formats filled in from a vocabulary (uri, label, ord).

    An item with an address gets its label. One with a term alone needs a label
    that equals it, cases and leading blanks apart, the first by ord; if one has
    none, the whole field is emptied (with keep_matched only that item goes).
    """
    by_uri = vocabulary.groupBy("uri").agg(F.min_by("label", "ord").alias("_label"))
    by_label = vocabulary.groupBy(F.lower("label").alias("_low")).agg(F.min_by(F.struct("uri", "label"), "ord").alias("_hit"))
    x = rows.select(F.col(id_col).alias("__voc_id"), F.posexplode(column).alias("_p", "x"))
    x = x.join(by_uri, F.col("x.uri") == by_uri["uri"], "left").drop("uri").join(by_label, F.lower(F.ltrim("x.term")) == F.col("_low"), "left")
    filled = F.col("x").withField("term", F.coalesce("x.term", "_label", "_hit.label")).withField("uri", F.coalesce("x.uri", "_hit.uri"))
    filled = filled.withField("vocabulary", F.when(filled["uri"].isNotNull(), F.coalesce("x.vocabulary", F.lit("EDAM"))).otherwise(F.col("x.vocabulary")))
    ok = F.col("x.term").isNull() | F.col("x.uri").isNotNull() | F.col("_hit").isNotNull()
    g = x.groupBy("__voc_id").agg(F.transform(F.array_sort(F.collect_list(F.when(ok, F.struct("_p", filled.alias("v"))))), lambda s: s["v"]).alias("__voc_new"), F.min(ok).alias("__voc_ok"))
    joined = rows.join(g, F.col(id_col) == F.col("__voc_id"), "left")
    value = F.coalesce(F.col("__voc_new") if keep_matched else F.when(F.col("__voc_ok"), F.col("__voc_new")), F.slice(F.col(column), 1, 0))
    return joined.withColumn(column, value).select(*rows.columns)
