"""Near-duplicate join on word shingles: MinHash candidates, Bayesian pruning, exact verification.

1. Texts with the same words are one class; its least id represents it.
2. Bands of MinHash values bring representatives together. Inside a bucket the
   values of a pair are compared STEP by STEP; the pair is dropped as soon as the
   posterior probability (uniform prior) of a similarity of THRESHOLD or more
   falls below TOLERANCE. What survives is kept as a forest, not as pairs.
3. The connected groups of survivors are verified exactly: shared shingles are
   counted for all pairs of a group, block by block, by products of 0/1 matrices.
4. Links of a document: the other documents of its class, and the members of
   linked classes. Components over the links are the near-duplicate groups.

A true pair at the threshold misses all bands with probability
(1 - THRESHOLD ** ROWS) ** BANDS, 2e-5, and is pruned with about 1e-4; more
similar pairs are missed by orders less.

Defined results: words are runs of [^ \\t\\n\\v\\f\\r]; a text of 1 to SHINGLE - 1
words is one shingle; null and empty texts link with nothing, not with each
other; a null id counts as the smallest one and comes back as null; rows that
share an id are documents each for itself, and copies link; an empty table gives
no rows. Texts have any length; a text is never cut. Other columns are ignored by
near_duplicates and passed on by keep_one, whatever their names.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.operators.components import components

from . import blocks
from . import words as W
from .joins import joined
from .runtime import discard, materialise, prepare

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 28, 5
HASHES, STEP = 256, 32
TOLERANCE = 1e-5
#: Rows of a block: in a bucket, and in a group that is verified.
BUCKET, GROUP = 512, 256
LEAST_ID = -(1 << 63)

_rng = np.random.default_rng(5)
_A = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingles(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, first shingle of each document + 1); repeated ones included."""
    total, n = len(w.hash), w.counts()
    at = np.flatnonzero(W.whole(w.first, SHINGLE, total))
    h = W.grams(w.hash, SHINGLE)[at]
    doc = w.doc()[at] if total else at
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        one = W.mix(np.array([W.grams(w.hash[w.first[d] : w.first[d + 1]], int(n[d]))[0] for d in short], np.uint64) + np.uint64(1))
        order = np.argsort(np.r_[doc, short], kind="stable")
        h, doc = np.r_[h, one][order], np.r_[doc, short][order]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


def text_class(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each document's sequence of words."""
    out = []
    for seed in (0xA5A5A5A5A5A5A5A5, 0x3C6EF372FE94F82B):
        place = np.arange(len(w.hash)) - np.repeat(w.first[:-1], w.counts())
        x = W.mix(w.hash + W.mix(place.astype(np.uint64) + np.uint64(seed)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        out.append(W.mix(sums[w.first[1:]] - sums[w.first[:-1]] + np.uint64(seed)).view(np.int64))
    return out[0], out[1]


def _signed(batches):
    for rows, data, offsets in W.chunks(batches):
        w = W.split(data, offsets)
        hi, lo = text_class(w)
        h, first = shingles(w)
        docs = rows.num_rows
        some = np.flatnonzero(np.diff(first))
        x = (h >> np.uint64(32)).astype(np.uint32)
        values = np.zeros((HASHES, len(some)), np.uint32)
        for k in range(HASHES if len(some) else 0):
            values[k] = np.minimum.reduceat(x * _A[k] + _B[k], first[:-1][some])
        keys = np.zeros((len(some), BANDS), np.uint64)
        for b in range(BANDS):
            g = np.full(len(some), b, np.uint64)
            for r in range(ROWS):
                g = W.mix(g + values[b * ROWS + r])
            keys[:, b] = g
        ends = np.zeros(docs + 1, np.int32)
        ends[1:][some] = 1
        ends = np.cumsum(ends)
        low = np.ascontiguousarray((W.mix(values.T.astype(np.uint64)) & np.uint64(255)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(hi), pa.array(lo), pa.array(np.diff(first) > 0),
             pa.ListArray.from_arrays(pa.array((ends * BANDS).astype(np.int32)), pa.array(keys.reshape(-1).view(np.int64))), W.binary_column(low.reshape(-1), ends.astype(np.int64) * HASHES)],
            ["doc_id", "hi", "lo", "some", "bands", "low"],
        )


_SIGNED = "doc_id long, hi long, lo long, some boolean, bands array<long>, low binary"


@lru_cache(8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For n = STEP, 2 STEP, ...: the fewest equal values with which P(similarity >= threshold) is still tolerance or more."""
    t, out = threshold + (1 - threshold) / 256, []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _survivors(low: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no step drops. The last values come first: those at the front have brought the pair together."""
    same = np.zeros(len(i), np.int64)
    for k, least in enumerate(least_matches()):
        s = slice(HASHES - (k + 1) * STEP, HASHES - k * STEP)
        same = same + (low[i, s] == low[j, s]).sum(1)
        ok = same >= least
        i, j, same = i[ok], j[ok], same[ok]
        if not len(i):
            break
    return i, j


def _bucket_pairs(batches):
    """Forests of the survivors of each bucket."""
    keys = ["band", "lo", "hi"]
    for batch in blocks.groups(batches, keys):
        ids = batch.column("doc_id").to_numpy()
        low = np.frombuffer(b"".join(batch.column("low").to_pylist()), np.uint8).reshape(-1, HASHES)
        first = blocks.starts(batch, keys)
        side = batch.column("side").to_numpy()
        across = batch.column("lo").to_numpy() != batch.column("hi").to_numpy()
        a, b = [], []
        for i, j in blocks.pairs(first, len(ids)):
            ok = ~across[i] | (side[i] != side[j])
            i, j = _survivors(low, i[ok], j[ok])
            x, y = blocks.forest(ids[i], ids[j])
            a.append(x)
            b.append(y)
        if a:
            a, b = blocks.forest(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _packed(batches):
    squeeze = zstandard.ZstdCompressor(level=1)
    for rows, data, offsets in W.chunks(batches):
        hi, lo = text_class(W.split(data, offsets))
        view = memoryview(np.ascontiguousarray(data))
        packed = [squeeze.compress(view[offsets[i] : offsets[i + 1]]) for i in range(rows.num_rows)]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(hi), pa.array(lo), pa.array(packed, pa.binary())], ["doc_id", "hi", "lo", "packed"])


def _sets(packed: list[bytes]) -> list[np.ndarray]:
    squeeze = zstandard.ZstdDecompressor()
    out = []
    for raw in packed:
        data = np.frombuffer(squeeze.decompress(raw), np.uint8)
        out.append(np.unique(shingles(W.split(data, np.array([0, len(data)])))[0]))
    return out


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common entries of each two sets."""
    n = len(sets)
    which = np.repeat(np.arange(n), [len(s) for s in sets])
    names, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    renamed = np.cumsum(times > 1) - 1
    which, column = which[keep], renamed[column[keep]]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    which, column = which[order], column[order]
    width = 1 << 14
    for lo in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        m = np.zeros((n, min(width, int(column[b - 1]) - lo + 1)), np.float32)
        m[which[a:b], column[a:b] - lo] = 1
        out += m @ m.T
    return out


def _verified(batches):
    """Links of each group: (a, b) forest edges, and (a, null, n) numbers of linked documents."""
    keys = ["component", "lo", "hi"]
    for batch in blocks.groups(batches, keys, least_rows=256, least_bytes=2_000_000):
        first = blocks.starts(batch, keys)
        for lo, hi in zip(first, np.r_[first[1:], batch.num_rows], strict=True):
            part = batch.slice(lo, hi - lo)
            ids, at = np.unique(part.column("doc_id").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            sets = _sets([part.column("packed")[int(k)].as_py() for k in at])
            size = np.array([len(s) for s in sets], np.float64)
            copies, side = part.column("copies").to_numpy()[at], part.column("side").to_numpy()[at]
            both = shared_counts(sets).astype(np.float64)
            # j = both / (a + b - both) >= threshold, in whole numbers where the threshold is a fraction of 10
            link = both * 10 >= round(THRESHOLD * 10) * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(link, False)
            if part.column("lo")[0].as_py() != part.column("hi")[0].as_py():
                link &= side[:, None] != side[None, :]
            n = (link * copies[None, :]).sum(1)
            i, j = np.nonzero(np.triu(link))
            a, b = blocks.forest(ids[i], ids[j])
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[a, ids[some]]), pa.array(np.r_[b, ids[some]], mask=np.r_[np.zeros(len(a), bool), np.ones(len(some), bool)]), pa.array(np.r_[np.zeros(len(a), np.int64), n[some]])],
                ["a", "b", "n"],
            )


#: Ids of documents to verify that are broadcast (8 bytes each); more of them are joined by shuffle.
BROADCAST_IDS = 500_000


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_class (least id with the same words), class_id (least id of the near-duplicate group), n_links of each row."""
    prepare(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialise(docs.mapInArrow(_signed, _SIGNED))
    member = signed.where("some").select("doc_id", "hi", "lo")
    # ids may repeat with other texts, so classes go by a key of their own; signatures of one class are equal
    first = F.min_by(F.struct("doc_id", "bands", "low"), "doc_id").alias("first")
    signatures = materialise(signed.where("some").groupBy("hi", "lo").agg(first, F.count("*").alias("copies")).withColumn("key", F.monotonically_increasing_id()))
    reps = signatures.select(F.col("key").alias("doc_id"), "first.bands", "first.low")
    classes = signatures.select("hi", "lo", F.col("first.doc_id").alias("rep"), "copies", "key")
    band = reps.select("doc_id", F.explode("bands").alias("band"))
    full = materialise(band.groupBy("band").agg(F.count("*").alias("c")).where("c > 1"))
    met = joined(band, full, ["band"], "c").join(reps.select("doc_id", "low"), "doc_id")
    edges = blocks.dealt(met, "band", "doc_id", "c", BUCKET).mapInArrow(_bucket_pairs, "a long, b long")
    groups = materialise(components(edges, "a", "b"))
    sizes = groups.groupBy("component").agg(F.count("*").alias("c"))
    wanted = groups.join(sizes, "component").join(classes, groups.vertex == classes.key).select("component", "c", "copies", "hi", "lo", F.col("rep").alias("doc_id"), "key")
    wanted = materialise(wanted)
    texts = docs
    if wanted.count() <= BROADCAST_IDS:  # only texts that may be wanted are compressed and shuffled
        texts = docs.join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    packed = texts.mapInArrow(_packed, "doc_id long, hi long, lo long, packed binary")
    texts = packed.join(wanted, ["doc_id", "hi", "lo"]).drop("hi", "lo", "doc_id").withColumnRenamed("key", "doc_id")
    found = materialise(blocks.dealt(texts, "component", "doc_id", "c", GROUP).mapInArrow(_verified, "a long, b long, n long"))
    linked = materialise(components(found.where("b IS NOT NULL"), "a", "b").select(F.col("vertex").alias("key"), "component"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    least = linked.join(classes.select("key", "rep"), "key").groupBy("component").agg(F.min("rep").alias("least"))
    named = linked.join(least, "component").drop("component")
    whole = materialise(classes.join(named, "key", "left").join(links, "key", "left").select("hi", "lo", "rep", "copies", F.coalesce("least", "rep").alias("class_id"), F.coalesce("others", F.lit(0)).alias("others")))
    discard(signatures, full, groups, wanted, found, linked)  # `whole` has what is left to read
    rows = joined(member, whole, ["hi", "lo"], "copies").select("doc_id", F.col("rep").alias("text_class"), "class_id", (F.col("others") + F.col("copies") - 1).alias("n_links"))
    alone = signed.where("NOT some").select("doc_id", F.col("doc_id").alias("text_class"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    null = lambda c: F.nullif(F.col(c), F.lit(LEAST_ID)).alias(c)
    return rows.union(alone).select(null("doc_id"), null("text_class"), null("class_id"), "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group: the one with the least id (null before all), of those the one with the least hash of its text, of those the first. Rows are told apart by a key of their own, so every row without a near duplicate stays, whatever its id."""
    order = F.struct(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("id"), F.xxhash64(text_col).alias("text"))
    rows = materialise(docs.select(F.struct(*docs.columns).alias("doc"), order.alias("rank"), F.monotonically_increasing_id().alias("row")))
    found = near_duplicates(rows.select("row", F.col("doc").getField(text_col).alias("text")), "row").select(F.col("doc_id").alias("row"), "class_id")
    first = rows.select("row", "rank").join(found, "row").groupBy("class_id").agg(F.min(F.struct("rank", "row")).alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select("doc.*")
