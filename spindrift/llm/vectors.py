"""Near-duplicate vectors by collision counting over sorted one-dimensional projections.

Every vector has a coordinate on each of many random directions. Two vectors
collide on a direction if one lies in the window around the other, HALF_WINDOW
deviations of a pair at the threshold to each side.

Candidates: each of `tables` directions is sorted, and every vector is the query
of a window centred on its coordinate. A window on one direction alone holds a
fixed share of all vectors, whatever the threshold, so that scanning it would be
quadratic; so the sorted order of a table is cut into cells by the signs of
`bits` further projections, bits growing with the logarithm of the number of
vectors, and a window is scanned inside its cell. The number of tables follows
from bits, the window, the threshold and MISSED.

Counting: of each pair so found, the collisions on DIRECTIONS further directions
are counted, and pairs that reach the needed count are verified by their cosine
in double precision. The count is set so that a pair at the threshold is lost
with LOST at most; with MISSED that calibrates the whole recall. A pair that
meets in several tables counts in the first. Equal vectors are one class, and a
crowded cell is dealt out in blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths don't link; a null id
counts as the smallest one and comes back as null; rows that share an id are
vectors each for itself, and copies link; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.operators.components import components

from . import blocks
from .joins import joined
from .runtime import discard, materialise, prepare
from .words import mix

THRESHOLD = 0.9
#: Share of pairs at the threshold that no table brings together; that the count loses.
MISSED, LOST = 0.01, 0.001
#: Directions whose collisions are counted, and half a window there in deviations of a pair at the threshold.
DIRECTIONS, HALF_WINDOW = 64, 1.5
#: Half of the window that is scanned in a table, in the same deviations.
SCANNED = 2.0
BLOCK = 512
_LEAST_ID = -(1 << 63)


def plan(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bits of a cell, tables) for n vectors."""
    bits = min(60, max(8, math.ceil(math.log2(max(n, 2))) + 2))
    together = (1 - math.acos(threshold) / math.pi) ** bits * math.erf(SCANNED / math.sqrt(2))
    return bits, math.ceil(math.log(MISSED) / math.log(1 - together))


@lru_cache(4)
def needed_collisions(threshold: float = THRESHOLD) -> tuple[float, int]:
    """(half a window, collisions that a pair must reach): all but LOST of the pairs at the threshold reach them."""
    p = math.erf(HALF_WINDOW / math.sqrt(2))
    below, c = 0.0, 0
    while True:
        below += math.comb(DIRECTIONS, c) * p**c * (1 - p) ** (DIRECTIONS - c)
        if below > LOST:
            return HALF_WINDOW * math.sqrt(2 - 2 * threshold), c
        c += 1


@lru_cache(4)
def directions(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    out = []
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        v = flat[first[rows][:, None] + np.arange(d)]
        v /= np.abs(v).max(1, keepdims=True)  # tiny and huge vectors too
        out.append((rows, v / np.linalg.norm(v, axis=1, keepdims=True)))
    return out


def _codes(v: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Cell of each vector in each table."""
    side = (v @ directions(v.shape[1], bits * tables, 1) >= 0).reshape(len(v), tables, bits)
    return (side * (np.uint64(1) << np.arange(bits, dtype=np.uint64))).sum(2, dtype=np.uint64)


def _signed(bits: int, tables: int):
    """Map step over (key, v): the cell and the sorted coordinate of each vector in each table."""

    def signed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, at = np.zeros((batch.num_rows, tables), np.uint64), np.zeros((batch.num_rows, tables), np.float32)
            for rows, v in _matrix(batch.column("v")):
                for lo in range(0, len(rows), 2000):
                    part, some = v[lo : lo + 2000], rows[lo : lo + 2000]
                    keys[some] = mix(_codes(part, bits, tables) + mix(np.arange(tables, dtype=np.uint64) + np.uint64(v.shape[1] << 20)))
                    at[some] = part @ directions(v.shape[1], tables, 3)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(at.reshape(-1)))], ["key", "cells", "places"]
            )

    return signed


def windows(first: np.ndarray, place: np.ndarray, half: float, at_once: int = 100_000):
    """(i, j), i before j, of the entries of each sorted run that lie in one another's window, about at_once at a time."""
    total = len(place)
    run = np.zeros(total, np.int64)
    run[first[1:]] = 1
    run = np.cumsum(run)
    # one order for all runs: each lies beyond the one before it
    span = (place.max() - place.min()) + 4 * half + 1
    line = run * span + (place - place.min())
    n = np.searchsorted(line, line + half, side="right") - np.arange(total) - 1
    upto, lo = np.cumsum(n), 0
    while lo < total:
        base = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, base + at_once, side="right")))
        m = n[lo:hi]
        if m.sum():
            i = np.repeat(np.arange(lo, hi), m)
            yield i, i + 1 + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        lo = hi


def _linked(bits: int, tables: int, threshold: float):
    """(a, b) forest edges of each run of cells, and (a, null, n) numbers of linked vectors."""
    half, needed = needed_collisions(threshold)
    scanned = SCANNED * math.sqrt(2 - 2 * threshold) + 1e-4  # coordinates travel in single precision
    keys = ["cell", "lo", "hi"]

    def linked(batches):
        for batch in blocks.groups(batches, keys):
            ids, side = batch.column("key").to_numpy(), batch.column("side").to_numpy()
            table, copies = batch.column("table").to_numpy(), batch.column("copies").to_numpy()
            across = batch.column("lo").to_numpy() != batch.column("hi").to_numpy()
            dims = np.diff(batch.column("v").offsets.to_numpy())
            v, places = np.zeros((len(ids), int(dims.max()))), np.zeros((len(ids), DIRECTIONS))
            for rows, part in _matrix(batch.column("v")):
                v[rows, : part.shape[1]], places[rows] = part, part @ directions(part.shape[1], DIRECTIONS, 2)
            met = []
            for i, j in windows(blocks.starts(batch, keys), batch.column("place").to_numpy().astype(np.float64), scanned):
                ok = (~across[i] | (side[i] != side[j])) & (dims[i] == dims[j])
                i, j = i[ok], j[ok]
                ok = (np.abs(places[i] - places[j]) <= half).sum(1) >= needed
                i, j = i[ok], j[ok]
                ok = np.einsum("ij,ij->i", v[i], v[j]) >= threshold
                i, j = i[ok], j[ok]
                ok = ~_met_before(v, dims, table, i, j, bits, tables, scanned)
                i, j = i[ok], j[ok]
                if len(i):
                    x, y = blocks.forest(ids[i], ids[j])
                    linked_rows, back = np.unique(np.r_[i, j], return_inverse=True)
                    met.append((x, y, linked_rows, np.bincount(back, np.r_[copies[j], copies[i]])))
            if not met:
                continue
            x, y = blocks.forest(*(np.concatenate([m[k] for m in met]) for k in (0, 1)))
            a, back = np.unique(ids[np.concatenate([m[2] for m in met])], return_inverse=True)
            n = np.bincount(back, np.concatenate([m[3] for m in met]), len(a)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[x, a]), pa.array(np.r_[y, a], mask=np.r_[np.zeros(len(x), bool), np.ones(len(a), bool)]), pa.array(np.r_[np.zeros(len(x), np.int64), n])], ["a", "b", "n"]
            )

    return linked


def _met_before(v, dims, table, i, j, bits: int, tables: int, scanned: float) -> np.ndarray:
    """Which pairs (i, j) share a cell and a window of an earlier table too; by the cells and coordinates that _signed gave them."""
    out = np.zeros(len(i), bool)
    for d in np.unique(dims[i]):
        of = np.flatnonzero(dims[i] == d)
        rows, back = np.unique(np.r_[i[of], j[of]], return_inverse=True)
        x, y = back[: len(of)], back[len(of) :]
        for lo in range(0, len(of), 20_000):
            s = slice(lo, lo + 20_000)
            named, at = np.unique(np.r_[x[s], y[s]], return_inverse=True)
            part = v[rows[named], :d]
            codes, places = _codes(part, bits, tables), (part @ directions(int(d), tables, 3)).astype(np.float32).astype(np.float64)
            a, b = at[: len(at) // 2], at[len(at) // 2 :]
            same = (codes[a] == codes[b]) & (np.abs(places[a] - places[b]) <= scanned)
            out[of[s]] = (same & (np.arange(tables)[None, :] < table[i[of[s]]][:, None])).any(1)
    return out


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    prepare(rows.sparkSession)
    kind = rows.schema[vector_col].dataType.simpleString()
    v = F.col(vector_col) if kind == "array<float>" else F.col(vector_col).cast("array<double>")  # as narrow as it comes; sums are in double precision
    rows = rows.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST_ID)).alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.select("vec_id", "v", F.coalesce(finite, F.lit(False)).alias("some"), F.xxhash64("v").alias("h1"), F.xxhash64("v", F.lit(1)).alias("h2"))
    member = rows.where("some").select("vec_id", "h1", "h2")
    # ids may be shared by other vectors, so classes go by a key of their own
    classes = rows.where("some").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.any_value("v").alias("v"), F.count("*").alias("copies"))
    classes = materialise(classes.withColumn("key", F.monotonically_increasing_id()))
    reps = classes.select("key", "copies", "v")
    bits, tables = plan(reps.count(), threshold)
    signed = materialise(reps.select("key", "v").mapInArrow(_signed(bits, tables), "key long, cells array<long>, places array<float>"))
    cells = signed.select("key", F.posexplode(F.arrays_zip("cells", "places")).alias("table", "x")).select("key", "table", F.col("x.cells").alias("cell"), F.col("x.places").alias("place"))
    full = materialise(cells.groupBy("cell").agg(F.count("*").alias("c")).where("c > 1"))
    met = joined(cells, full, ["cell"], "c").join(reps, "key")
    met_rows = materialise(blocks.dealt(met, "cell", "key", "c", BLOCK, by="place").mapInArrow(_linked(bits, tables, threshold), "a long, b long, n long"))
    linked = components(met_rows.where("b IS NOT NULL"), "a", "b").select(F.col("vertex").alias("key"), "component")
    least = linked.join(classes.select("key", "rep"), "key").groupBy("component").agg(F.min("rep").alias("least"))
    linked = linked.join(least, "component").drop("component")
    links = met_rows.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    whole = classes.select("key", "h1", "h2", "rep", "copies").join(linked, "key", "left").join(links, "key", "left")
    whole = materialise(whole.select("h1", "h2", "copies", F.coalesce("least", "rep").alias("component_id"), F.coalesce("others", F.lit(0)).alias("others")))
    discard(classes, signed, full, met_rows)  # `whole` has what is left to read
    found = joined(member, whole, ["h1", "h2"], "copies").select("vec_id", (F.col("others") + F.col("copies") - 1).alias("n_links"), "component_id")
    found = found.union(rows.where("NOT some").select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    null = lambda c: F.nullif(F.col(c), F.lit(_LEAST_ID)).alias(c)
    return found.select(null("vec_id"), "n_links", null("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))
