"""BibTeX records: no built-in function parses them, so this is an Arrow-batched UDF."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ENTRIES = "array<struct<type: string, key: string, fields: map<string, string>>>"
_HEAD = re.compile(r"@\s*([A-Za-z]+)\s*\{\s*([^,\s{}]*)\s*,")
_NAME = re.compile(r"\s*,?\s*([A-Za-z][\w\-]*)\s*=\s*")


def _value(text: str, at: int) -> tuple[str, int]:
    """The value that begins at `at` and where it ends: braces, quotes, or a bare word."""
    if at < len(text) and text[at] in '{"':
        quoted, depth, begin = text[at] == '"', 0, at + 1
        for i in range(at, len(text)):
            c = text[i]
            if quoted and c == '"' and i > at and depth == 0:
                return text[begin:i], i + 1
            if c == "{":
                depth += 1
            elif c == "}":
                depth -= 1
                if depth == 0 and not quoted:
                    return text[begin:i], i + 1
        return text[begin:], len(text)
    m = re.compile(r"[^,}\s]*").match(text, at)
    return m.group(0), m.end()


def parse(text: str | None) -> list[dict]:
    """Entries of a BibTeX text; what can't be read is left out."""
    out, at = [], 0
    while text and (m := _HEAD.search(text, at)):
        at, fields = m.end(), {}
        while n := _NAME.match(text, at):
            value, at = _value(text, n.end())
            fields[n.group(1).lower()] = " ".join(value.replace("{", "").replace("}", "").split())
        out.append({"type": m.group(1).lower(), "key": m.group(2), "fields": fields})
    return out


def _parse_all(texts: pd.Series) -> pd.Series:
    return texts.map(parse)


def bibtex_entries(text: Column | str) -> Column:
    """Entries of a text column. The function is made where it is used, as workers have no session to make it in."""
    return F.pandas_udf(_parse_all, ENTRIES)(text)
