"""Token ids on disk as one wavelet matrix for each shard.

A shard file holds whole documents in the order of their ids: header, document
ids and lengths, and 16 bit-planes from the highest bit down. In a plane the
tokens are in the order that the planes above sort them into, by a stable
partition of zeros before ones. Planes are compressed one by one; rank samples
every BLOCK bits are kept beside them, so that access, rank (occurrences before
a place) and select (place of an occurrence) read one file.

Spark's own writer stores a shard as the `content` of a row, with its place in
the order, so that any store that Spark can write to holds it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .runtime import prepare, shared_dir

BITS = 16
BLOCK = 512
MAGIC = b"WVM1"
#: Tokens after which a shard is closed, at the end of a document.
SHARD_TOKENS = 1 << 21
#: Pieces that the library gets in one call.
LINES = 2000
#: Shards whose places are broadcast; more of them are joined.
BROADCAST_SHARDS = 200_000
_LEAST_ID = -(1 << 63)


def build(tokens: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard file of tokens below 2 ** BITS; document k has lengths[k] of them."""
    squeeze = zstandard.ZstdCompressor(level=1)
    a = tokens.astype(np.uint16)
    parts, zeros = [], []
    for level in range(BITS):
        bit = (a & np.uint16(1 << (BITS - 1 - level))) != 0
        low = a[~bit]
        zeros.append(len(low))
        plane = np.packbits(bit, bitorder="little").tobytes()
        counts = np.add.reduceat(bit, np.arange(0, len(bit), BLOCK), dtype=np.uint32) if len(bit) else np.zeros(0, np.uint32)
        ranks = (np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4").tobytes()
        parts.append((squeeze.compress(plane), squeeze.compress(ranks)))
        a = np.concatenate([low, a[bit]])
    docs = squeeze.compress(ids.astype("<i8").tobytes() + lengths.astype("<u4").tobytes())
    head = MAGIC + struct.pack("<QII", len(tokens), len(ids), len(docs))
    sizes = b"".join(struct.pack("<QII", z, len(p), len(r)) for z, (p, r) in zip(zeros, parts, strict=True))
    return head + sizes + docs + b"".join(p + r for p, r in parts)


class Shard:
    """Reads a shard file. Planes are opened when they are first needed."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC:
            raise ValueError("not a shard file")
        self.content = content
        self.n, docs, packed = struct.unpack_from("<QII", content, 4)
        at = 20
        sizes = [struct.unpack_from("<QII", content, at + 16 * k) for k in range(BITS)]
        at += 16 * BITS
        table = self._open(at, packed)
        self.ids = np.frombuffer(table, "<i8", docs)
        self.lengths = np.frombuffer(table, "<u4", docs, 8 * docs)
        at += packed
        self.zeros, self.places = [], []
        for z, p, r in sizes:
            self.zeros.append(z)
            self.places.append((at, p, at + p, r))
            at += p + r
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _open(self, at: int, size: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(memoryview(self.content)[at : at + size])

    def plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(packed bits, ones before each block)."""
        if level not in self._planes:
            a, p, b, r = self.places[level]
            self._planes[level] = np.frombuffer(self._open(a, p), np.uint8), np.frombuffer(self._open(b, r), "<u4")
        return self._planes[level]

    def _ones(self, level: int, at: int) -> int:
        """Ones among the first `at` bits of a plane."""
        bits, ranks = self.plane(level)
        block = at // BLOCK
        if block >= len(ranks):
            block = len(ranks) - 1
            if block < 0:
                return 0
        lo = block * BLOCK
        return int(ranks[block]) + int(np.unpackbits(bits[lo // 8 : (at + 7) // 8], bitorder="little")[: at - lo].sum())

    def access(self, at: int) -> int:
        """The token at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(BITS):
            bits, _ = self.plane(level)
            one = bits[at >> 3] >> (at & 7) & 1
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if one else at - ones
            value = value << 1 | int(one)
        return value

    def _span(self, token: int, upto: int) -> tuple[int, int]:
        lo, hi = 0, upto
        for level in range(BITS):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (BITS - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, at: int) -> int:
        """Occurrences of a token among the first `at` places."""
        lo, hi = self._span(token, at)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence of a token, from 0."""
        lo, hi = self._span(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in reversed(range(BITS)):
            one = token >> (BITS - 1 - level) & 1
            at = self._select_bit(level, one, at - self.zeros[level] if one else at)
        return at

    def _select_bit(self, level: int, one: int, k: int) -> int:
        """Place of the k-th such bit of a plane."""
        bits, ranks = self.plane(level)
        before = ranks.astype(np.int64) if one else np.arange(len(ranks), dtype=np.int64) * BLOCK - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        lo = block * BLOCK
        part = np.unpackbits(bits[lo // 8 : (lo + BLOCK) // 8], bitorder="little")[: self.n - lo]
        return lo + int(np.flatnonzero(part == one)[k - int(before[block])])

    def tokens(self) -> np.ndarray:
        """All tokens: from the last plane up, each partition is undone."""
        a = np.zeros(self.n, np.uint16)
        for level in reversed(range(BITS)):
            bit = np.unpackbits(self.plane(level)[0], count=self.n, bitorder="little").view(bool)
            a[self.zeros[level] :] |= np.uint16(1 << (BITS - 1 - level))
            out = np.empty_like(a)
            out[~bit] = a[: self.zeros[level]]
            out[bit] = a[self.zeros[level] :]
            a = out
        return a


#: Classes of bytes: letters (all of a multi-byte letter), digits, others, space, other white space.
_LETTER, _DIGIT, _OTHER, _SPACE, _WHITE = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x20] = _SPACE
_CLASS[0x09:0x0E] = _WHITE


class PieceTable:
    """Open addressing from a piece's hash to its ids in a pool, in arrays; it takes no more pieces than ENTRIES."""

    SLOTS, ENTRIES = 1 << 21, 1_200_000

    def __init__(self):
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.entry = np.full(self.SLOTS, -1, np.int32)
        self.first = np.zeros(self.ENTRIES + 1, np.int32)
        self.odd = np.zeros(self.ENTRIES, bool)
        self.pool = np.zeros(1 << 16, np.uint16)
        self.n = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        out = np.full(len(h), -1, np.int32)
        slot = (h >> np.uint64(43)).astype(np.int64)
        at = np.arange(len(h))
        while len(at):
            entry = self.entry[slot]
            hit = (entry >= 0) & (self.keys[slot] == h[at])
            out[at[hit]] = entry[hit]
            on = (entry >= 0) & ~hit
            at, slot = at[on], (slot[on] + 1) & (self.SLOTS - 1)
        return out

    def add(self, h: np.ndarray, ids: list[bytes], odd: list[bool]) -> int:
        """Adds distinct new hashes while there is room; how many."""
        room = min(len(h), self.ENTRIES - self.n)
        if room <= 0:
            return 0
        blob = np.frombuffer(b"".join(ids[:room]), "<u2")
        begin = int(self.first[self.n])
        while len(self.pool) < begin + len(blob):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[begin : begin + len(blob)] = blob
        self.first[self.n + 1 : self.n + room + 1] = begin + np.cumsum([len(x) // 2 for x in ids[:room]])
        self.odd[self.n : self.n + room] = odd[:room]
        entry = np.arange(self.n, self.n + room, dtype=np.int32)
        key, slot = h[:room], (h[:room] >> np.uint64(43)).astype(np.int64)
        while len(key):
            free = self.entry[slot] < 0
            _, one = np.unique(slot, return_index=True)
            take = np.zeros(len(key), bool)
            take[one] = True
            take &= free
            self.keys[slot[take]], self.entry[slot[take]] = key[take], entry[take]
            key, entry = key[~take], entry[~take]
            slot = (slot[~take] + ~free[~take]) & (self.SLOTS - 1)
        self.n += room
        return room


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each piece, end, documents to hand over whole).

    A piece is what the byte-level pattern cuts: a run of letters, of digits or of
    others with a space before it, or white space, whose last character goes with
    what follows if it is a space and stands alone if not. Documents with a
    contraction or a possible special token go whole.
    """
    n = len(data)
    kind = _CLASS[data]
    white = kind >= _SPACE
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = cut[:n].copy()
    if n > 1:
        prev, here = kind[:-1], kind[1:]
        pw, hw = white[:-1], white[1:]
        last = np.ones(n - 1, bool)  # of its run of white space, with something behind it
        last[:-1] = ~hw[1:] & ~cut[2:n]
        last[-1] = False
        start[1:] |= np.where(hw, ~pw | last, np.where(pw, prev == _WHITE, prev != here))
    begin = np.flatnonzero(start)
    end = np.r_[begin[1:], n]
    nxt = np.zeros(n, np.uint8)
    nxt[:-1] = data[1:]
    whole = np.flatnonzero((start & (data == 0x27) & (kind[np.minimum(np.arange(n) + 1, n - 1)] == _LETTER)) | ((data == 0x3C) & (nxt == 0x7C)))
    return begin, end, np.unique(np.searchsorted(offsets, whole, side="right") - 1)


class Tokens:
    """Ids of texts by the tokenizers library. Texts are cut as its pattern cuts them; each distinct piece goes to the library once while a bounded table has room. Texts with characters that the cut doesn't cover go to it whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.table = PieceTable()
        self.line = self.library.encode("\n", add_special_tokens=False).ids

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_pieces(self, texts: list[str], strange: list[bool]) -> list[bytes]:
        """Ids of each piece. Plain words go in lines, many to a call: a line break is always a piece and a token of its own between them."""
        plain = [i for i, t in enumerate(texts) if not strange[i] and t.lstrip(" ") and (not t.isascii() or t.isprintable())]
        out: dict[int, bytes] = {}
        for lo in range(0, len(plain) if len(self.line) == 1 else 0, LINES):
            some = plain[lo : lo + LINES]
            ids = np.array(self.library.encode_batch_fast(["\n".join([texts[i] for i in some])], add_special_tokens=False)[0].ids, np.uint16)
            ends = np.append(np.flatnonzero(ids == self.line[0]), len(ids)).tolist()
            if len(ends) == len(some):
                raw, begin = ids.tobytes(), 0
                for i, end in zip(some, ends, strict=True):
                    out[i] = raw[2 * begin : 2 * end]
                    begin = end + 1
        rest = [i for i in range(len(texts)) if i not in out]
        out.update(zip(rest, self._library([texts[i] for i in rest]), strict=True))
        return [out[i] for i in range(len(texts))]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, ids of each)."""
        docs, table = len(offsets) - 1, self.table
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(docs, np.int64)
        begin, end, whole = pieces(data, offsets)
        h = W.span_hashes(data, begin, end)
        entry = table.find(h)
        raw = data.tobytes()
        missing = np.flatnonzero(entry < 0)
        pool, first, odd = table.pool, table.first, table.odd
        if len(missing):
            new, at, back = np.unique(h[missing], return_index=True, return_inverse=True)
            at = missing[at]
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            strange = [not (t.isascii() or t.strip(" ").isalpha()) for t in texts]
            ids = self._of_pieces(texts, strange)
            known = table.add(new, ids, strange)
            pool, first, odd = table.pool, table.first, table.odd
            places = np.arange(table.n - known, table.n - known + len(new), dtype=np.int64)
            if known < len(new):  # no room: the rest for this call only
                rest = np.frombuffer(b"".join(ids[known:]), "<u2")
                used = int(first[table.n])
                pool = np.concatenate([pool[:used], rest])
                first = np.concatenate([first[: table.n + 1], used + np.cumsum([len(x) // 2 for x in ids[known:]])])
                odd = np.concatenate([odd[: table.n], strange[known:]])
            entry[missing] = places[back]
        sizes = (first[1:] - first[:-1])[entry] if len(first) < len(entry) else first[entry + 1] - first[entry]
        doc_of = np.searchsorted(begin, offsets)
        total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        out = pool[np.repeat(first[entry] - total[:-1], sizes) + np.arange(total[-1])]
        counts = total[doc_of[1:]] - total[doc_of[:-1]]
        strange = np.flatnonzero(odd[entry])
        if len(strange) or len(whole):
            redo = np.union1d(whole, np.searchsorted(doc_of, strange, side="right") - 1)
            ids = dict(zip(redo.tolist(), self._library([raw[offsets[d] : offsets[d + 1]].decode("utf-8", "replace") for d in redo]), strict=True))
            ends = np.cumsum(counts)
            parts, upto = [], 0
            for d in redo.tolist():
                parts += [out[upto : ends[d] - counts[d]], np.frombuffer(ids[d], "<u2")]
                upto = ends[d]
                counts[d] = len(ids[d]) // 2
            out = np.concatenate([*parts, out[upto:]])
        return out, counts


def tokens_by(path: str) -> Tokens:
    return W.keep(f"tokens {path}", lambda: Tokens(path))


_STORED = "part int, seq int, n_tokens long, content binary"


def _stored(path: str, end_id: int, shard_tokens: int):
    def stored(batches):
        by, part, seq = tokens_by(path), TaskContext.get().partitionId(), 0
        ids, lengths, blobs, held = [], [], [], 0

        def shard():
            a = np.concatenate(blobs)
            content = build(a, np.concatenate(ids), np.concatenate(lengths))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(a)]), pa.array([content], pa.binary())], ["part", "seq", "n_tokens", "content"])

        for rows, data, offsets in W.chunks(batches, keeps=True):
            a, counts = by.encode(data, offsets)
            ends = np.cumsum(counts + 1)
            full = np.empty(len(a) + len(counts), np.uint16)
            is_end = np.zeros(len(full), bool)
            is_end[ends - 1] = True
            full[is_end], full[~is_end] = end_id, a
            doc_ids, at = rows.column("doc_id").to_numpy(zero_copy_only=False), 0
            while at < len(counts):  # as many documents as the shard still takes
                upto = min(len(counts), max(at, int(np.searchsorted(ends, ends[at] - counts[at] - 1 + shard_tokens - held))) + 1)
                blobs.append(full[ends[at] - counts[at] - 1 : ends[upto - 1]])
                ids.append(doc_ids[at:upto])
                lengths.append(counts[at:upto] + 1)
                held += len(blobs[-1])
                at = upto
                if held >= shard_tokens:
                    yield shard()
                    ids, lengths, blobs, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield shard()

    return stored


def write_shards(docs: DataFrame, target: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes all texts and writes shards in ascending order of ids (part, then seq).

    Null text is empty: its document is the end id alone. Null ids come first, as
    the smallest id. Rows with one id follow each other by their texts. A document
    longer than a shard is a shard. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST_ID)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_stored(tokenizer, end_id, shard_tokens), _STORED).write.option("compression", "none").parquet(target)


def _read(batches):
    for batch in batches:
        for content, start in zip(batch.column("content"), batch.column("start").to_pylist(), strict=True):
            shard = Shard(content.as_py())
            a = shard.tokens().astype("<u4")
            ends = np.cumsum(shard.lengths.astype(np.int64))
            begins = ends - shard.lengths
            view = memoryview(a.view(np.uint8))
            crc = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.ids), pa.array(begins + start), pa.array(shard.lengths.astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )


def read_digests(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the shards."""
    prepare(spark)
    shards = spark.read.schema(_STORED).parquet(target)
    meta = shards.select("part", "seq", "n_tokens")
    parts = meta.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    places = meta.select("part", "seq", within.alias("within")).join(parts, "part").select("part", "seq", (F.col("within") + F.col("part_start")).alias("start"))
    if meta.count() <= BROADCAST_SHARDS:
        places = F.broadcast(places)
    rows = shards.join(places, ["part", "seq"]).select("content", "start")
    return rows.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long").withColumn("doc_id", F.nullif("doc_id", F.lit(_LEAST_ID)))


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes shards to the shared folder and returns what is read back from them."""
    spark = docs.sparkSession
    target = f"{shared_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    write_shards(docs, target, tokenizer, end_id)
    return read_digests(spark, target)
