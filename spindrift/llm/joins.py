"""Joins with tables that know how many rows each of their keys has, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows from which a key is crowded, and the most crowded keys that are broadcast (about 100 bytes each).
CROWDED, MOST_CROWDED = 1_000, 50_000


def joined(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """rows with the entries of table, which has each key once and the key's number of rows in `count`; no task gets all rows of a crowded key.

    The entries of crowded keys are broadcast: those of CROWDED rows or more, or of
    so many more that there are at most MOST_CROWDED of them. Any other key has at
    most a MOST_CROWDED-th of all rows, or fewer than CROWDED, and is joined by shuffle.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    limit = max(CROWDED, -(-total // MOST_CROWDED))
    crowded = table.where(F.col(count) >= limit)
    if crowded.isEmpty():
        return rows.join(table, keys)
    crowded = F.broadcast(crowded)
    rest = rows.join(crowded.select(keys), keys, "left_anti").join(table.where(F.col(count) < limit), keys)
    return rows.join(crowded, keys).unionByName(rest)
