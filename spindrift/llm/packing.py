"""Variable-capacity best-fit packing of documents into training sequences.

Documents are cut into pieces of at most the largest capacity. The pieces are
dealt evenly to packing tasks, by a hash of id, text and piece that no layout of
the input changes; a task takes its pieces longest first. A piece goes
into the open bin that it leaves the least room in. If none has room, a bin is
opened: for each permitted capacity the bin is filled in trial with what is left,
the longest fitting piece first, and the capacity with the least cost for a token
is taken. A bin costs its capacity, BIN_COST, and its capacity squared over SQUARED,
as attention does, so that neither many short bins nor a few long ones are always
best. In the end every bin is cut down to the least capacity that holds its contents.

pack_documents tells where every piece goes; pack_sequences returns the bins
themselves, with their token ids and the borders of the documents in them.

Defined results: an empty or null text has only its end token; null ids are kept;
every row is packed for itself, also where ids are shared or rows repeat; ties go
by id, text and piece, and pieces that are equal in all of these are equal; an
empty table gives no bins. A text has any length; its pieces spread over the tasks. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import materialise, prepare
from .wavelet import tokens_by

CAPACITIES = (512, 1024, 2048, 4096)
#: What a bin costs besides its capacity, in tokens: a fixed part, and capacity squared over SQUARED.
BIN_COST, SQUARED = 32, 16_384
#: Tokens that a packing task gets, about.
TASK_TOKENS = 1 << 23
#: Bytes of text that are encoded at once: half of what other operators take, as ids are made of them besides.
ENCODED_BYTES = W.CHUNK_BYTES // 2


class _Longest:
    """Multiset of lengths with the longest one up to a limit: one bit for each length that is left."""

    def __init__(self, lengths: np.ndarray):
        self.left = np.bincount(lengths, minlength=1).tolist()
        self.bits = 0
        for n, c in enumerate(self.left):
            if c:
                self.bits |= 1 << n

    def take(self, n: int) -> None:
        self.left[n] -= 1
        if not self.left[n]:
            self.bits &= ~(1 << n)

    def filled(self, room: int) -> int:
        """Tokens that a trial puts into so much room."""
        used, taken = 0, {}
        while room > 0:
            bits = self.bits & ((1 << (room + 1)) - 1)
            while bits:
                n = bits.bit_length() - 1
                if self.left[n] > taken.get(n, 0):
                    break
                bits &= ~(1 << n)
            else:
                return used
            k = min(room // n, self.left[n] - taken.get(n, 0)) if n else 0
            if not k:
                return used
            taken[n] = taken.get(n, 0) + k
            used += k * n
            room -= k * n
        return used


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, bin_cost: int = BIN_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each piece, its place there, final capacity of each bin); lengths in falling order, none above the largest capacity."""
    capacities = tuple(sorted(capacities))
    left = _Longest(lengths)
    rooms: list[tuple[int, int]] = []  # (room, bin) of the open bins, in order
    used: list[int] = []
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        left.take(n)
        at = _first_with(rooms, n)
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room = min((c for c in capacities if c >= n), key=lambda c: ((c + bin_cost + c * c / SQUARED) / (n + left.filled(c - n)), c))
            b = len(used)
            used.append(0)
        bins[i], places[i] = b, used[b]
        used[b] += n
        if room > n:
            insort(rooms, (room - n, b))
    held = np.array(used, np.int64)
    return bins, places, np.array(capacities)[np.searchsorted(capacities, held)] if len(held) else held


def _first_with(rooms: list[tuple[int, int]], n: int) -> int:
    lo, hi = 0, len(rooms)
    while lo < hi:
        mid = (lo + hi) // 2
        if rooms[mid][0] < n:
            lo = mid + 1
        else:
            hi = mid
    return lo


#: Id of the end token.
END_ID = 2
#: An id as it travels to its packing task, as wavelet.Tokens gives it.
_ID = np.dtype("<u2")
_PLACED = "doc_id long, piece int, start long, n_tokens long, bin_id string, place long, bin_tokens long, capacity long"


def _pieces(path: str, largest: int, with_ids: bool):
    """Map step over (doc_id, text): the pieces of each row; `key` tells rows of other content apart, whatever their order."""

    def pieces(batches):
        by = tokens_by(path)
        for rows, data, offsets in W.chunks(batches, limit=ENCODED_BYTES, keeps=True):
            ids, n = by.encode(data, offsets)
            parts = -(-(n + 1) // largest)
            piece = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            size = np.minimum(largest, np.repeat(n + 1, parts) - piece * largest)
            of = np.repeat(np.arange(len(n)), parts)
            out = [rows.column(c).take(pa.array(of)) for c in ("doc_id", "key")]
            out += [pa.array(piece.astype(np.int32)), pa.array(piece * largest), pa.array(size)]
            names = ["doc_id", "key", "piece", "start", "n_tokens"]
            if with_ids:
                whole = np.full(int((n + 1).sum()), END_ID, _ID)
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
                out.append(W.binary_column(whole, np.concatenate([[0], np.cumsum(size)]) * _ID.itemsize))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return pieces


#: Bins that a packing task gives out at once.
BINS = 256
_BORDERS = ["doc_id", "piece", "start", "place", "n_tokens"]
_BINS = "bin_id string, capacity long, n_tokens long, ids array<int>, pieces array<struct<doc_id: long, piece: int, start: long, place: long, n_tokens: long>>"


def _order(bins: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces in the order of bins and places, first piece of each bin + 1)."""
    order = np.lexsort((places, bins))
    return order, np.searchsorted(bins[order], np.arange(bins.max(initial=-1) + 2))


def _task(capacities: tuple[int, ...], bin_cost: int, whole: bool):
    """Packs one task's pieces: a row for each piece, or with `whole` for each bin. Only the small columns are sorted; token ids are copied once, as their bins are given out."""

    def task(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.forget()
        table = pa.Table.from_batches(list(batches))
        small = table.select(["doc_id", "key", "piece", "start", "n_tokens"])
        by = pc.sort_indices(small, [("n_tokens", "descending"), ("doc_id", "ascending"), ("key", "ascending"), ("piece", "ascending")])
        small = small.take(by).combine_chunks()
        sizes = small.column("n_tokens").to_numpy()
        bins, places, capacity = pack(sizes, capacities, bin_cost)
        held = np.bincount(bins, sizes, len(capacity)).astype(np.int64)
        name = lambda b: f"{key[0].as_py()}-{b}"
        order, first = _order(bins, places)
        small = small.append_column("place", pa.array(places)).append_column("from", by).take(pa.array(order)).combine_chunks()
        column = lambda c, rows: small.column(c).chunk(0)[rows]
        for lo in range(0, len(held), BINS):
            of = np.arange(lo, min(lo + BINS, len(held)))
            rows = slice(int(first[lo]), int(first[of[-1] + 1]))
            if whole:
                borders = pa.StructArray.from_arrays([column(c, rows) for c in _BORDERS], _BORDERS)
                ids = np.frombuffer(b"".join(table.column("ids").take(column("from", rows)).to_pylist()), _ID).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(held[of])]).astype(np.int32)
                out = [pa.array([name(b) for b in of.tolist()]), pa.array(capacity[of]), pa.array(held[of]), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
                yield pa.RecordBatch.from_arrays([*out, pa.ListArray.from_arrays(pa.array((first[lo : of[-1] + 2] - first[lo]).astype(np.int32)), borders)], ["bin_id", "capacity", "n_tokens", "ids", "pieces"])
            else:
                b = bins[order[rows]]
                out = [*(column(c, rows) for c in ("doc_id", "piece", "start", "n_tokens")), pa.array([name(x) for x in b.tolist()]), column("place", rows), pa.array(held[b]), pa.array(capacity[b])]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "n_tokens", "bin_id", "place", "bin_tokens", "capacity"])
        del table, small
        W.free()

    return task


def pack_pieces(pieces: DataFrame, capacities: tuple[int, ...] = CAPACITIES, bin_cost: int = BIN_COST, whole: bool = False) -> DataFrame:
    """Bins of pieces (doc_id, key, piece, start, n_tokens and, with `whole`, ids as little-endian 16-bit integers), packed by tasks of about TASK_TOKENS tokens."""
    pieces = materialise(pieces)
    total = pieces.agg(F.sum("n_tokens")).first()[0] or 0
    tasks = max(1, -(-total // TASK_TOKENS))
    dealt = pieces.withColumn("task", F.pmod(F.xxhash64("doc_id", "key", "piece"), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(_task(tuple(capacities), bin_cost, whole), _BINS if whole else _PLACED)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))


def pack_documents(docs: DataFrame, tokenizer: str, capacities: tuple[int, ...] = CAPACITIES, bin_cost: int = BIN_COST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start (token of the document), n_tokens, bin_id, place (token of the bin), bin_tokens, capacity of every piece."""
    pieces = _rows(docs, id_col, text_col).mapInArrow(_pieces(tokenizer, max(capacities), False), "doc_id long, key long, piece int, start long, n_tokens long")
    return pack_pieces(pieces, capacities, bin_cost)


def pack_sequences(docs: DataFrame, tokenizer: str, capacities: tuple[int, ...] = CAPACITIES, bin_cost: int = BIN_COST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bin_id, capacity, n_tokens, ids (the sequence) and pieces (doc_id, piece, start, place, n_tokens) of every bin, in the order of places; a bin's row holds the largest capacity at most."""
    pieces = _rows(docs, id_col, text_col).mapInArrow(_pieces(tokenizer, max(capacities), True), "doc_id long, key long, piece int, start long, n_tokens long, ids binary")
    return pack_pieces(pieces, capacities, bin_cost, whole=True)
