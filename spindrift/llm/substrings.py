"""Exact removal of repeated passages: relative Lempel-Ziv parsing against indexed blocks of the corpus.

A passage repeats if WINDOW consecutive words of it start earlier in the corpus
(smaller id, or same document and earlier start). The reference is cut into
blocks (chunks of documents in id order). A block indexes the windows that occur
in it first and parses its own documents against that index; what it found is
written with the compressed texts, so that all later steps go by one cut into
blocks. What is left, a block's first occurrences, is indexed across blocks: each window goes to the
partition of its anchor, the smallest GRAM-word hash inside it, so that equal
windows meet and a run of windows with one anchor travels as one row with
6 bytes a window. There each window gets the place of its first occurrence.

A document's factors are then read off greedily: consecutive windows whose
references advance together are one factor of (windows + WINDOW - 1) words.
A factor ends where the reference jumps; windows across such a boundary are
looked up on their own, so that no repeated window is lost between factors.

Anchors that a sample shows to be frequent (text that a large share of documents
has) are dealt out by whole windows instead; that decides where rows meet, never
what is found. The MOST_FREQUENT most frequent ones are, so any other anchor has
at most a MOST_FREQUENT-th of the rows, far less than a task's share.

Defined results: null text has no words, and stays null in dedup_substrings; an
empty table gives no rows; null ids count as the smallest id and come back as
null. Every row is a document of its own: rows that share an id (or have none)
come in the order of their texts' hashes, equal texts in the order of the input's
rows, and the later ones repeat the earlier ones. Texts have any length; a text is
never cut, so a task holds a few times the longest one. Other columns, whatever
their names, are kept by dedup_substrings and never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import materialise, prepare

WINDOW = 20
GRAM = 6
#: One document of so many tells which anchors are frequent; so many of its rows make one; so many are shared at most.
SAMPLE, FREQUENT, MOST_FREQUENT = 32, 24, 16_384
#: Windows that a task of the second step holds at once.
HELD = 800_000
_LEAST_ID = -(1 << 63)


def _windows(rows, data, offsets):
    """(id, start, window hash, anchor) of the windows of a block, in the order of ids and starts, and the words."""
    ids = rows.column("doc_id").to_numpy(zero_copy_only=False)
    w = W.split(data, offsets)
    h = W.grams(w.hash, WINDOW)
    at = np.flatnonzero(W.whole(w.first, WINDOW, len(w.hash)))
    if not len(at):
        none = np.zeros(0, np.int64)
        return ids, none, none, none.view(np.uint64), none.view(np.uint64)
    anchors = W.sliding_min(W.grams(w.hash, GRAM), WINDOW - GRAM + 1)[at]
    doc = np.repeat(np.arange(len(ids)), w.counts())[at]
    start = at - w.first[doc]
    if np.any(ids[1:] < ids[:-1]):
        rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
        order = np.argsort(rank[doc], kind="stable")
        return ids, doc[order], start[order], h[at][order], anchors[order]
    return ids, doc, start, h[at], anchors


def _first_of(h: np.ndarray) -> np.ndarray:
    """For each entry, the index of the first equal one."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.r_[True, s[1:] != s[:-1]]
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(h), np.int64)
    out[order] = first
    return out


def _runs(*follows: np.ndarray) -> np.ndarray:
    """Starts of runs: positions where any of the conditions 'as the previous one goes on' fails."""
    n = len(follows[0]) + 1
    cut = np.ones(n, bool)
    cut[1:] = ~np.logical_and.reduce(follows)
    return np.flatnonzero(cut)


def _unpacked(batches):
    """(rows, bytes, offsets) of at most CHUNK_BYTES of text, or of one document, from compressed texts."""
    squeeze = zstandard.ZstdDecompressor()

    def part(batch, at, upto, texts):
        return batch.slice(at, upto - at), np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)

    for batch in batches:
        at, size, texts = 0, 0, []
        for i, raw in enumerate(batch.column("packed")):
            text = squeeze.decompress(raw.as_py())
            if texts and size + len(text) > W.CHUNK_BYTES:
                yield part(batch, at, i, texts)
                at, size, texts = i, 0, []
            size += len(text)
            texts.append(text)
        if texts:
            yield part(batch, at, batch.num_rows, texts)
    W.free()


def _own(rows, doc, start):
    """Which windows are repeats inside their block, as _packed found them."""
    n = np.bincount(doc, minlength=rows.num_rows)
    base = np.cumsum(n) - n
    times = pc.list_value_length(rows.column("own_start")).to_numpy(zero_copy_only=False)
    at = np.repeat(base, times) + rows.column("own_start").flatten().to_numpy()
    change = np.zeros(len(doc) + 1, np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + rows.column("own_n").flatten().to_numpy(), -1)
    return np.cumsum(change[:-1])[base[doc] + start] > 0


def _anchor_rows(shared):
    """Map step over _packed's rows: (anchor, doc_id, start, windows) of the windows that _packed did not find earlier in their block."""

    def rows_of(batches):
        frequent = shared.value if shared is not None else np.zeros(0, np.uint64)
        for rows, data, offsets in _unpacked(batches):
            ids, doc, start, h, anchors = _windows(rows, data, offsets)
            if not len(h):
                continue
            keep = ~_own(rows, doc, start)
            doc, start, h, anchors = doc[keep], start[keep], h[keep], anchors[keep]
            if not len(h):
                continue
            hot = np.zeros(len(h), bool)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, anchors), len(frequent) - 1)
                hot = frequent[at] == anchors
                anchors = np.where(hot, W.mix(anchors ^ h), anchors)
            runs = _runs(doc[1:] == doc[:-1], start[1:] == start[:-1] + 1, anchors[1:] == anchors[:-1])
            ends = np.r_[runs, len(h)] * 6
            blob = np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)
            for lo in range(0, len(runs), 50_000):
                r, e = runs[lo : lo + 50_000], ends[lo : lo + 50_001]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[r].view(np.int64)), pa.array(ids[doc[r]]), pa.array(start[r].astype(np.int32)), W.binary_column(blob[e[0] : e[-1]], e - e[0])],
                    ["anchor", "doc_id", "start", "windows"],
                )

    return rows_of


_ANCHOR_ROWS = "anchor long, doc_id long, start int, windows binary"
_FACTORS = "doc_id long, start int, n int, ref_doc long, ref_start int"


class _Seen:
    """The windows of the anchor at the end of the rows so far, with their first places."""

    def __init__(self):
        self.anchor, self.key, self.doc, self.start = None, *(np.zeros(0, k) for k in (np.uint64, np.int64, np.int64))


def _expanded(batch: pa.RecordBatch):
    col = batch.column("windows")
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int32, len(col) + 1, col.offset * 4)
    raw = np.frombuffer(data, np.uint8)[o[0] : o[-1]].reshape(-1, 6)
    key = np.zeros((len(raw), 8), np.uint8)
    key[:, :6] = raw
    n = np.diff(o) // 6
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return n, key.reshape(-1).view(np.uint64), step


def _repeats(batches):
    """Second step, over rows sorted by (anchor, doc_id, start): the windows that aren't the first of their kind, as runs whose references advance."""
    seen = _Seen()
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > HELD * 8:
            yield from _repeats_of(held, seen)
            held, size = [], 0
    if held:
        yield from _repeats_of(held, seen)
    W.free()


def _repeats_of(held, seen: _Seen):
    table = pa.Table.from_batches(held).combine_chunks()
    held.clear()
    batch = table.to_batches()[0]
    anchors = batch.column("anchor").to_numpy()
    new = np.r_[True, anchors[1:] != anchors[:-1]]
    group = np.cumsum(new) - 1
    alone = np.bincount(group)[group] == 1
    if seen.anchor is not None:
        alone &= anchors != seen.anchor
    last = anchors[-1]
    alone &= anchors != last  # it may go on in the rows to come
    if not alone.all():
        batch = batch.filter(pa.array(~alone))
        anchors = anchors[~alone]
        n, key, step = _expanded(batch)
        doc = np.repeat(batch.column("doc_id").to_numpy(), n)
        start = np.repeat(batch.column("start").to_numpy().astype(np.int64), n) + step
        anchor = np.repeat(anchors, n)
        old = 0
        if seen.anchor is not None and seen.anchor == anchors[0]:
            old = len(seen.key)
            key, doc, start = np.r_[seen.key, key], np.r_[seen.doc, doc], np.r_[seen.start, start]
            anchor = np.r_[np.full(old, seen.anchor), anchor]
        first = _first_of_two(anchor, key)
        repeat = (doc != doc[first]) | (start != start[first])
        repeat[:old] = False
        at = np.flatnonzero(repeat)
        if len(at):
            d, s, rd, rs = doc[at], start[at], doc[first[at]], start[first[at]]
            order = np.lexsort((s, d))
            d, s, rd, rs = d[order], s[order], rd[order], rs[order]
            r = _runs(d[1:] == d[:-1], s[1:] == s[:-1] + 1, rd[1:] == rd[:-1], rs[1:] == rs[:-1] + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[r]), pa.array(s[r].astype(np.int32)), pa.array(np.diff(np.r_[r, len(d)]).astype(np.int32)), pa.array(rd[r]), pa.array(rs[r].astype(np.int32))],
                ["doc_id", "start", "n", "ref_doc", "ref_start"],
            )
        mine = np.flatnonzero((anchor == last) & (first == np.arange(len(key))))
        seen.anchor, seen.key, seen.doc, seen.start = last, key[mine], doc[mine], start[mine]


def _first_of_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each entry, the index of the first with an equal pair; a is sorted in groups."""
    order = np.lexsort((np.arange(len(a)), b, a))
    x, y = a[order], b[order]
    new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
    out = np.empty(len(a), np.int64)
    out[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


_PACKED = "doc_id long, packed binary, own array<struct<start: int, n: int, ref_doc: long, ref_start: int>>, extra {extra}"
_FACTOR = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())])


def _packed(batches):
    """Compressed texts, with the repeats inside their block."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for rows, data, offsets in W.chunks(batches):
        ids, doc, start, h, _ = _windows(rows, data, offsets)
        docs = len(ids)
        first = _first_of(h) if len(h) else np.zeros(0, np.int64)
        at = np.flatnonzero((ids[doc] != ids[doc[first]]) | (start != start[first])) if len(h) else first
        order = np.lexsort((start[at], doc[at]))
        at = at[order]
        d, s, rd, rs = doc[at], start[at], ids[doc[first[at]]], start[first[at]]
        r = _runs(d[1:] == d[:-1], s[1:] == s[:-1] + 1, rd[1:] == rd[:-1], rs[1:] == rs[:-1] + 1) if len(at) else at
        n = np.diff(np.r_[r, len(d)])
        ends = np.concatenate([[0], np.cumsum(np.bincount(d[r], minlength=docs))]).astype(np.int32)
        own = pa.StructArray.from_arrays([pa.array(s[r].astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(rd[r].astype(np.int64)), pa.array(rs[r].astype(np.int32))], fields=list(_FACTOR))
        view = memoryview(np.ascontiguousarray(data))
        packed = [squeeze.compress(view[offsets[i] : offsets[i + 1]]) for i in range(docs)]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(packed, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), own), rows.column("extra")], ["doc_id", "packed", "own", "extra"])


def factors_of(runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, words, reference document, reference start): runs of windows joined while the reference advances; the longer factor goes first where two begin at one word."""
    out: list[list[int]] = []
    for start, n, ref_doc, ref_start in sorted(runs, key=lambda r: (r[0], -r[1])):
        if out and out[-1][2] == ref_doc and out[-1][0] + out[-1][1] == start and out[-1][3] + out[-1][1] == ref_start:
            out[-1][1] += n
        else:
            out.append([start, n, ref_doc, ref_start])
    return [(s, n + WINDOW - 1, d, r) for s, n, d, r in out]


_CUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, factors array<struct<start: int, n: int, ref_doc: long, ref_start: int>>, extra {extra}"


def _cut(with_text: bool):
    def cut(batches):
        for batch in batches:
            out = []
            squeeze = zstandard.ZstdDecompressor()
            for doc_id, packed, own, others in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "own", "others")), strict=True):
                raw = squeeze.decompress(packed) if packed else b""
                data = np.frombuffer(raw, np.uint8)
                w = W.split(data, np.array([0, len(data)]))
                runs = [(r["start"], r["n"], r["ref_doc"], r["ref_start"]) for r in [*(own or ()), *(others or ())]]
                factors = factors_of(runs)
                change = np.zeros(len(w.start) + 1, np.int32)
                for start, n, _, _ in factors:
                    change[start] += 1
                    change[start + n] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = b" ".join([raw[a:b] for a, b in zip(w.start[~gone].tolist(), w.end[~gone].tolist(), strict=True)])
                text = None
                if with_text:
                    text = _without(raw, w, gone) if factors else raw
                out.append((doc_id, len(w.start), int(gone.sum()), hashlib.sha256(kept).hexdigest(), text, factors))
            ids, n, removed, sha, texts, factors = zip(*out, strict=True) if out else ([],) * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array([x and x.decode() if x is not None else None for x in texts], pa.string()),
                 pa.array([[dict(zip(("start", "n", "ref_doc", "ref_start"), f, strict=True)) for f in fs] for fs in factors], pa.list_(_FACTOR)), batch.column("extra")],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "factors", "extra"],
            )

    return cut


def _without(raw: bytes, w: W.Words, gone: np.ndarray) -> bytes:
    """The text without the words that go, each with the white space behind it."""
    out, upto = [], 0
    after = np.r_[w.start[1:], len(raw)]
    change = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    for a, b in zip(change[::2], change[1::2], strict=True):
        out.append(raw[upto : w.start[a]])
        upto = int(after[b - 1])
    out.append(raw[upto:])
    return b"".join(out)


def frequent_anchors(packed: DataFrame):
    """Broadcast of the anchors that a sample of the documents shows often; MOST_FREQUENT at most."""
    sample = packed.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    rows = (
        sample.mapInArrow(_anchor_rows(None), _ANCHOR_ROWS).groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "anchor").limit(MOST_FREQUENT).select("anchor").toPandas()
    )
    return packed.sparkSession.sparkContext.broadcast(np.sort(rows["anchor"].to_numpy(np.int64).view(np.uint64)))


def _found(docs: DataFrame, with_text: bool) -> DataFrame:
    """Results for docs (doc_id, text, extra), each id once."""
    extra = docs.schema["extra"].dataType.simpleString()
    # blocks are cut once, and what they found is written: a second cut could end them at other documents
    packed = materialise(docs.mapInArrow(_packed, _PACKED.format(extra=extra)))
    rows = packed.select("doc_id", "packed", F.col("own.start").alias("own_start"), F.col("own.n").alias("own_n"))
    shared = frequent_anchors(rows)
    met = rows.mapInArrow(_anchor_rows(shared), _ANCHOR_ROWS).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start")
    # written, so that the windows, by far the largest shuffle, are gone before the texts are shuffled
    repeats = materialise(met.mapInArrow(_repeats, _FACTORS))
    others = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "ref_doc", "ref_start")).alias("others"))
    found = packed.join(others, "doc_id", "left")
    return found.mapInArrow(_cut(with_text), _CUT.format(extra=extra))


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (key, doc_id, text, ...) with a key for each, in the order of ids: the id itself where no two rows share one."""
    if rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        return rows.withColumn("key", F.col("doc_id"))
    # an id that very many rows share is cut up by text and row, so no range is large
    rows = rows.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange("doc_id", "_text", "_row").sortWithinPartitions("doc_id", "_text", "_row").drop("_text", "_row")
    return materialise(rows.withColumn("key", F.monotonically_increasing_id()))


def _documents(docs: DataFrame, id_col: str, text_col: str, extra) -> DataFrame:
    """(doc_id, text, extra (id, none, others)) of docs: doc_id is the row's key, extra.id its id, extra.none whether its text is null."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text"), extra.alias("extra"))
    return _keyed(rows).select(F.col("key").alias("doc_id"), "text", F.struct(F.nullif("doc_id", F.lit(_LEAST_ID)).alias("id"), F.col("text").isNull().alias("none"), F.col("extra").alias("others")).alias("extra"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (null unless with_text) and factors of each row; ref_doc is an id, or the row's number in the order of ids where ids are shared."""
    found = _found(_documents(docs, id_col, text_col, F.lit(0)), with_text)
    return found.withColumn("doc_id", F.col("extra.id")).drop("extra")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs without their repeated passages; chars_col, if given, has the text's new length."""
    others = [c for c in docs.columns if c != text_col]
    found = _found(_documents(docs, id_col, text_col, F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others)))), True)
    back = {c: F.col(f"extra.others.c{i}") for i, c in enumerate(others)}
    back[text_col] = F.when(~F.col("extra.none"), F.col("kept_text"))
    if chars_col:
        back[chars_col] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(back[chars_col]).cast(docs.schema[chars_col].dataType)
    return found.select(*(back[c].alias(c) for c in docs.columns))
