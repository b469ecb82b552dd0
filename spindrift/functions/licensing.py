"""Licence names: cleaning, classes, normalised addresses."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Substrings of a lower-case name and the class they mean, the first match counts. Fixed values.
LICENCE_RULES = [
    (["unlicensed", "unknown", "unlicense"], "unlicensed"),
    (["agpl", "affero"], "AGPL"),
    (["lgpl"], "LGPL"),
    (["gpl", "gnu"], "GPL"),
    (["artistic"], "Artistic"),
    (["mit"], "MIT"),
    (["apache"], "Apache"),
    (["bsd"], "BSD"),
    (["afl"], "AFL"),
]
LICENCE_RULES_AFTER_CC = [(["creativecommons.org"], "not-software"), (["cecill"], "CeCILL")]

#: Groups of open-source licences. Fixed values.
LICENCE_GROUPS = {
    "permissive": ["Artistic", "MIT", "Apache", "BSD"],
    "copyleft": ["GPL", "LGPL", "AGPL", "CeCILL"],
    "data": ["CC"],
}

#: Node and parent in the licence summary. Fixed values.
LICENCE_HIERARCHY = [("Total", ""), ("None", "Total"), ("Unambiguous", "Total"), ("Open Source", "Unambiguous"), ("other", "Unambiguous"), ("Ambiguous", "Total")]


def clean_licence(name: Column) -> Column:
    """A licence name without trailing stops, plus signs and the words LICENSE and file."""
    x = F.trim(F.regexp_replace(name, r"\.+$", ""))
    for gone in ("+", "LICENSE", "file", "File", "FILE"):
        x = F.replace(x, F.lit(gone), F.lit(""))
    return F.trim(x)


def licence_class(name: Column) -> Column:
    """Class of a licence by the first rule that its name meets."""
    low = F.lower(name)
    has = lambda parts: _any(low, parts)
    out = F.when(name.isNull(), F.lit(None).cast("string"))
    for parts, label in LICENCE_RULES:
        out = out.when(has(parts), F.lit(label))
    out = out.when(name.contains("CC") | low.contains("creative commons"), F.lit("CC"))
    for parts, label in LICENCE_RULES_AFTER_CC:
        out = out.when(has(parts), F.lit(label))
    return out.otherwise(F.lit("other"))


def _any(low: Column, parts: list[str]) -> Column:
    out = low.contains(parts[0])
    for p in parts[1:]:
        out = out | low.contains(p)
    return out


def is_normalised_licence(url: Column, prefix: str = "https://spdx.org/licenses/") -> Column:
    """Whether a licence's address is one of the standard list."""
    return F.coalesce(url.startswith(prefix), F.lit(False))


def spdx_names(licences: DataFrame, name_col: str, spdx: DataFrame) -> DataFrame:
    """licences with the standard id and address (spdx_id, spdx_url) whose id, name or synonym equals the name, cases apart; spdx has license_id, name, synonyms, url."""
    names = spdx.select("license_id", "url", F.explode(F.concat(F.array("license_id", "name"), F.coalesce("synonyms", F.array().cast("array<string>")))).alias("n"))
    names = names.groupBy(F.lower("n").alias("_n")).agg(F.min_by(F.struct("license_id", "url"), "license_id").alias("_s"))
    return licences.join(names, F.lower(F.col(name_col)) == F.col("_n"), "left").withColumns({"spdx_id": F.col("_s.license_id"), "spdx_url": F.col("_s.url")}).drop("_n", "_s")
