"""All pairs inside groups without a large group in one task.

A group of c rows is dealt into ceil(c / size) blocks; a task gets a block, or two
blocks and only the pairs across them. A row is sent to as many tasks as its
group has blocks; groups of up to `size` rows stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.operators.components import forest

__all__ = ["dealt", "forest", "groups", "pairs", "starts"]


def dealt(rows: DataFrame, key: str, member: str, count: str, size: int, by: str | None = None) -> DataFrame:
    """rows with (lo, hi, side): the two blocks of the task, and the row's own one; gathered and sorted by (key, lo, hi), inside by `by` and member."""
    blocks = F.ceil(F.col(count) / size).cast("int")
    rows = rows.withColumn("side", F.pmod(F.xxhash64(member, F.lit("block")), F.greatest(blocks, F.lit(1))).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1)))
    rows = rows.withColumns({"lo": F.least("side", "_other"), "hi": F.greatest("side", "_other")}).drop("_other", count)
    return rows.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi", *([by] if by else []), member)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], least_rows: int = 4_000, least_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of whole groups of rows sorted by keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < least_rows and sum(b.nbytes for b in held) < least_bytes:
            continue
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        cut = starts(table, keys)[-1]
        if cut:
            yield table.slice(0, cut)
        held = [table.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """First row of each group."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in keys:
        x = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def pairs(first: np.ndarray, total: int, at_once: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j), i < j, inside the groups that begin at `first`, in slices of about at_once."""
    ends = np.r_[first[1:], total]
    row_end = np.repeat(ends, ends - first)
    partners = row_end - np.arange(total) - 1
    upto = np.cumsum(partners)
    lo = 0
    while lo < total:
        base = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, base + at_once, side="right")))
        n = partners[lo:hi]
        if n.sum():
            i = np.repeat(np.arange(lo, hi), n)
            j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield i, j
        lo = hi
