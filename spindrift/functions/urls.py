"""URL columns: normalisation."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _host_and_path(url: Column) -> tuple[Column, Column]:
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    has_host = bare.startswith("//")
    host = F.when(has_host, F.lower(F.regexp_extract(bare, r"^//([^/]*)", 1))).otherwise(F.lit(""))
    path = F.when(has_host, F.regexp_replace(bare, r"^//[^/]*", "")).otherwise(bare)
    return host, path


def normalize_url(url: Column) -> Column:
    """Lower-cased host and path without scheme, query, fragment, last parameters, trailing slashes and one .html; null for an empty one.

    Addresses at bioconductor.org become bioconductor.org/packages/<package>.
    """
    host, path = _host_and_path(url)
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r";[^/]*$", ""), r"/+$", ""), r"\.html$", "")
    parts = F.filter(F.split(path, "/"), lambda x: ~x.isin("", "release", "bioc", "html", "packages"))
    package = F.get(parts, F.size(parts) - 1)
    return F.when(
        url.isNotNull() & (url != ""),
        F.when(host.contains("bioconductor.org") & package.isNotNull(), F.concat(F.lit("bioconductor.org/packages/"), package)).otherwise(F.concat(host, path)),
    )


#: Substrings that tell a repository's kind, the first match counts. Fixed values.
REPOSITORY_KINDS = [
    ("github.com", "github"),
    ("bitbucket.org", "bitbucket"),
    ("sourceforge.net", "sourceforge"),
    ("gitlab.com", "gitlab"),
    ("anaconda.org/bioconda", "bioconda"),
    ("git.bioconductor.org", "bioconductor"),
]

#: Hosts whose links identify software. Fixed values.
CODE_HOSTS = ["github", "sourceforge", "gitlab", "bitbucket", "bioconductor.org/packages", "pypi.org/project/", "metacpan.org/pod/", "cran.r-project.org/package"]

#: Extensions of files. Fixed values.
FILE_EXTENSIONS = ["rar", "bz2", "tar", "gz", "zip", "bz", "json", "txt", "js", "py", "md"]


def repository_kind(url: Column) -> Column:
    """Kind of a repository by the first known substring of its address, or null."""
    kind = F.lit(None).cast("string")
    for part, name in reversed(REPOSITORY_KINDS):
        kind = F.when(url.contains(part), F.lit(name)).otherwise(kind)
    return kind


def repository_of(url: Column) -> Column:
    """struct(kind, url) of the repository that an address lies in: https://host/owner/name, hosts tried in order; null if none."""
    found = []
    for host, kind in (("github.com", "github"), ("gitlab.com", "gitlab"), ("bitbucket.org", "bitbucket")):
        pattern = "(?s)^.*?" + host.replace(".", r"\.") + r"/([^/]*)/([^/]*).*$"
        at = F.concat(F.lit(f"https://{host}/"), F.regexp_extract(url, pattern, 1), F.lit("/"), F.regexp_extract(url, pattern, 2))
        found.append(F.when(url.rlike(pattern), F.struct(F.lit(kind).alias("kind"), at.alias("url"))))
    return F.coalesce(*found)


def is_code_host(link: Column) -> Column:
    """Whether a normalised link lies on a host whose links identify software."""
    return F.rlike(link, F.lit("|".join(h.replace(".", r"\.") for h in CODE_HOSTS)))


def is_file_like(url: Column) -> Column:
    """Whether the path of an address ends in a file's extension."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")
    return path.rlike(rf"\.({'|'.join(FILE_EXTENSIONS)})$")


def is_web_url(url: Column) -> Column:
    """Whether a string is an http or https address with a host."""
    return F.coalesce(url.rlike(r"^(?i:https?)://[^\s/?#]+([/?#]\S*)?$"), F.lit(False))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, and a slash behind a bare host; null for what is no address."""
    pattern = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)(.*)$"
    rest = F.regexp_extract(url, pattern, 3)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(is_web_url(url), F.concat(F.lower(F.regexp_extract(url, pattern, 1)), F.lit("://"), F.lower(F.regexp_extract(url, pattern, 2)), rest))


def _found(link: Column, tail: str) -> Column:
    return F.nullif(F.regexp_extract(link, rf"(?:https?://)?(?:www\.)?{tail}", 0), F.lit(""))


def github_link(link: Column) -> Column:
    return _found(link, r"github\.com/[A-Za-z0-9_-]+/[A-Za-z0-9_-]+")


def bitbucket_link(link: Column) -> Column:
    return _found(link, r"bitbucket\.org/[A-Za-z0-9_-]+/[A-Za-z0-9_-]+")


def bioconductor_link(link: Column) -> Column:
    return F.concat(_found(link, r"bioconductor\.org/packages/[A-Za-z0-9_-]+/bioc/html/[A-Za-z0-9_-]+"), F.lit(".html"))


def galaxy_link(link: Column) -> Column:
    return _found(link, r"usegalaxy\.eu")


def toolshed_link(link: Column) -> Column:
    return _found(link, r"toolshed\.galaxyproject\.org")


def source_pages(sources: Column, name: Column, links: Column) -> Column:
    """map<source, page>: landing pages by rule, then those that links show; an empty page for a source without one."""
    has = lambda *s: F.arrays_overlap(sources, F.array(*(F.lit(x) for x in s)))
    empty = F.create_map().cast("map<string,string>")
    rules = [
        (has("biotools"), "biotools", F.concat(F.lit("https://bio.tools/"), name)),
        (has("bioconda", "bioconda_recipes"), "bioconda", F.concat(F.lit("https://anaconda.org/bioconda/"), name)),
        (has("bioconductor"), "bioconductor", F.concat(F.lit("https://bioconductor.org/packages/release/bioc/html/"), name, F.lit(".html"))),
        (has("sourceforge"), "sourceforge", F.concat(F.lit("https://sourceforge.net/projects/"), name)),
        (has("toolshed", "galaxy_metadata"), "toolshed", F.lit("https://toolshed.g2.bx.psu.edu/repository")),
        (has("galaxy"), "galaxy", F.lit("https://usegalaxy.eu/")),
    ]
    last = lambda f: F.element_at(F.filter(F.transform(links, lambda x: f(x)), lambda x: x.isNotNull()), -1)
    found = lambda f: F.when(F.exists(links, lambda x: f(x).isNotNull()), last(f))
    alias = F.concat(F.lit("https://anaconda.org/bioconda/bioconductor-"), name)
    by_link = {
        "bioconda": F.when(F.exists(links, lambda x: x.contains(F.concat(F.lit("bioconductor-"), name))), alias),
        "github": found(github_link),
        "bioconductor": found(bioconductor_link),
        "bitbucket": found(bitbucket_link),
        "galaxy": found(galaxy_link),
        "toolshed": found(toolshed_link),
    }
    keys = ["biotools", "bioconda", "bioconductor", "sourceforge", "toolshed", "galaxy", "github", "bitbucket"]
    by_rule = {k: F.when(c, v) for c, k, v in rules}
    pages = F.array(
        *(
            F.struct(F.lit(k).alias("key"), F.coalesce(by_link.get(k, F.lit(None)), by_rule.get(k, F.lit(None)), F.when(F.array_contains(sources, k), F.lit(""))).cast("string").alias("value"))
            for k in keys
        )
    )
    return F.coalesce(F.map_from_entries(F.filter(pages, lambda x: x["value"].isNotNull())), empty)


def link_handler(url: Column) -> Column:
    """struct(handler, owner, repository, package): where the content of a link would come from."""
    part = lambda pattern, n=1: F.nullif(F.regexp_extract(url, pattern, n), F.lit(""))
    none = F.lit(None).cast("string")

    def handled(name, owner=none, repository=none, package=none):
        return F.struct(F.lit(name).alias("handler"), owner.alias("owner"), repository.alias("repository"), package.alias("package"))

    two = lambda host: (part(rf"{host}/([^/?#]+)/([^/?#]+)", 1), part(rf"{host}/([^/?#]+)/([^/?#]+)", 2))
    space = F.regexp_replace(F.regexp_extract(url, r"gitlab\.com/([^?#]+?)/?(?:[?#].*)?$", 1), r"\.git$", "")
    return (
        F.when(url.contains("github.com"), handled("github", *two(r"github\.com")))
        .when(url.contains("gitlab.com"), handled("gitlab", none, F.url_encode(space)))
        .when(url.contains("pypi.org"), handled("pypi", package=part(r"pypi\.org/project/([^/?#]+)")))
        .when(url.contains("sourceforge.net"), handled("sourceforge", package=part(r"sourceforge\.net/projects/([^/?#]+)")))
        .when(url.contains("bitbucket.org"), handled("bitbucket", *two(r"bitbucket\.org")))
        .when(url.contains("git.bioconductor.org"), handled("bioconductor", package=part(r"/packages/([^/?#]+)")))
        .otherwise(handled("generic"))
    )


def clean_webpage(page: Column) -> Column:
    """A page without a quote or bracket at either end, with a mended or added scheme; null if nothing is left."""
    page = F.regexp_replace(F.regexp_replace(F.trim(page), r"^[\"'<]", ""), r"[\"'>]$", "")
    page = F.regexp_replace(page, r"^(https?)//", "$1://")
    return F.when(page != "", F.when(page.rlike("^https?://"), page).otherwise(F.concat(F.lit("https://"), page)))
