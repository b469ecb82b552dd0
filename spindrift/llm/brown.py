"""Class-based n-gram scoring: exchange clustering of words, class transitions, word emissions.

(1) Word counts, pre-aggregated in each task, summed by hash. (2) The CLUSTERED
most frequent words are clustered by their bigrams, in one task that holds a
CLUSTERED by CLUSTERED table whatever the corpus. (3) Every other word seen
LEAST times or more joins the class that its neighbours' classes make likeliest:
its counts with these classes are summed by hash and each word is judged for
itself. (4) Words, counts and classes are a table. Documents become sequences of
classes; the most frequent words are looked up in memory, which changes nothing
but time, and the others come by a join on the word's hash. (5) Class transitions
are counted on the training documents' sequences, then all are scored.

What reaches the driver is bounded by parameters: at most SHARED words with
counts, and (classes x classes) bigram counts.

Defined results: a null or empty text is one end token; a row without an id has no
checksum, so it is not held out and is learnt from; rows count as often as they
occur, each for itself, also where ids are shared; an empty training set gives
N = V = 0; an empty table gives no rows. Texts have any length and are never cut.
Columns other than the id and text, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import materialise, prepare

#: Most words whose counts and classes every task holds (24 bytes each); the others are joined.
SHARED = 262_144
#: Most frequent words that are clustered by exchange, and their classes.
CLUSTERED = 2048
CLASSES = 48
ROUNDS = 6
#: Times from which a word has one of the classes; rarer ones share the class of unseen words.
LEAST = 2
#: Weight of the class unigram in a transition.
KAPPA = 50.0
#: The end token; no word has this hash but by chance.
END = np.uint64(0xE0D0_0F7E_57C0_FFEE)


def remainder_of(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def _counted(batches):
    """(h, n) of the words and ends; merged while the table of a task stays small."""
    held_h, held_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows(h, n):
        for at in range(0, len(h), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(h[at : at + 100_000].view(np.int64)), pa.array(n[at : at + 100_000])], ["h", "n"])

    for _, data, offsets in W.chunks(batches):
        w = W.split(data, offsets, lower=True)
        h, n = np.unique(w.hash, return_counts=True)
        h, n = np.concatenate([held_h, h, [END]]), np.concatenate([held_n, n, [len(offsets) - 1]])
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        held_h, held_n = h[first], np.add.reduceat(n, first)
        if len(held_h) > 500_000:
            yield from rows(held_h, held_n)
            held_h, held_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    yield from rows(held_h, held_n)


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n): the training tokens by hash, the end included."""
    return docs.select("text").mapInArrow(_counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Words that a task looks up, and what they stand for: symbols (clustered words, the rest, the end) or classes."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    symbols: np.ndarray
    n_symbols: int

    @property
    def rest(self) -> int:
        return self.n_symbols - 2

    @property
    def end(self) -> int:
        return self.n_symbols - 1

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash in the shared table, or -1."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)

    def tokens(self, data, offsets):
        """(words, index of each token's word or -1, symbol of each token, last token of each document); the end follows its document's words."""
        w = W.split(data, offsets, lower=True)
        docs = len(offsets) - 1
        last = w.first[1:] + np.arange(docs)
        is_end = np.zeros(len(w.hash) + docs, bool)
        is_end[last] = True
        h = np.empty(len(is_end), np.uint64)
        h[is_end], h[~is_end] = END, w.hash
        at = self.look_up(h)
        symbol = np.where(at >= 0, self.symbols[at], self.rest) if len(self.symbols) else np.full(len(h), self.rest)
        symbol[is_end] = self.end
        return h, at, symbol, last


_END = int(END.astype(np.int64))


def head(counts: DataFrame) -> Model:
    """The words that are clustered, each a symbol."""
    rows = counts.where(F.col("h") != _END).orderBy(F.desc("n"), "h").limit(CLUSTERED).toPandas()
    h = rows["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return Model(h[order], rows["n"].to_numpy(np.int64)[order], np.arange(len(h)), len(h) + 2)


def bigrams(docs: DataFrame, shared) -> DataFrame:
    """(a, b, n): neighbouring symbols, each pair once; a document's first word follows an end."""

    def count(batches):
        model = shared.value
        size = model.n_symbols
        table = np.zeros(size * size, np.int64)
        for _, data, offsets in W.chunks(batches):
            _, _, symbol, last = model.tokens(data, offsets)
            before = np.empty_like(symbol)
            before[0], before[1:] = model.end, symbol[:-1]
            table += np.bincount(before * size + symbol, minlength=size * size)
        seen = np.flatnonzero(table)
        for at in range(0, len(seen), 100_000):
            s = seen[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(s // size), pa.array(s % size), pa.array(table[s])], ["a", "b", "n"])

    return docs.select("text").mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def exchange(table: np.ndarray, movable: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each symbol: the first `movable` ones move between `classes` classes, while the likelihood of the class bigrams grows; the others keep a class each."""
    size = len(table)
    classes = max(1, min(classes, movable))
    klass = np.concatenate([np.arange(movable) % classes, classes + np.arange(size - movable)])
    k = classes + size - movable
    onto = np.zeros((size, k))
    onto[np.arange(size), klass] = 1
    g = onto.T @ table @ onto
    out, into = table.sum(1), table.sum(0)
    for _ in range(rounds):
        moved = 0
        for w in range(movable):
            own, own_count = klass[w], table[w, w]
            r = np.bincount(klass, table[w], k)
            c = np.bincount(klass, table[:, w], k)
            r[own] -= own_count
            c[own] -= own_count
            g[own, :] -= r
            g[:, own] -= c
            g[own, own] -= own_count
            rows, cols = g.sum(1)[:classes], g.sum(0)[:classes]
            top, left = g[:classes, :], g[:, :classes].T
            diagonal = np.arange(classes)
            gain = (_xlogx(top + r) - _xlogx(top)).sum(1) + (_xlogx(left + c) - _xlogx(left)).sum(1)
            d = g[diagonal, diagonal]
            dr, dc = r[:classes], c[:classes]
            gain += _xlogx(d + dr + dc + own_count) - _xlogx(d + dr) - _xlogx(d + dc) + _xlogx(d)
            gain -= _xlogx(rows + out[w]) - _xlogx(rows) + _xlogx(cols + into[w]) - _xlogx(cols)
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = own
            moved += best != own
            klass[w] = best
            g[best, :] += r
            g[:, best] += c
            g[best, best] += own_count
        if not moved:
            break
    return klass


def _clustered(size: int):
    """The one task that clusters: rows (a, next) of bigrams in, the class of each symbol and the class bigrams out."""

    def cluster(batches):
        table = np.zeros((size, size))
        for batch in batches:
            at, pairs = _flat(batch.column("next"), batch.num_rows)
            b, n = (pairs.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            table[batch.column("a").to_numpy()[at], b] = n
        klass, g = classes_of(table)
        yield pa.RecordBatch.from_arrays([pa.array([klass.astype(np.int64).tobytes()], pa.binary()), pa.array([g.tobytes()], pa.binary())], ["klass", "g"])

    return cluster


def classes_of(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol, the last two of which have one each, and the bigrams of classes."""
    klass = exchange(table, len(table) - 2)
    onto = np.zeros((len(table), int(klass.max()) + 1))
    onto[np.arange(len(table)), klass] = 1
    return klass, onto.T @ table @ onto


def contexts(docs: DataFrame, shared, klass: np.ndarray) -> DataFrame:
    """(h, code, n): how often a word that is not clustered follows class `code`, or is followed by class `code` - classes."""
    k = int(klass.max()) + 1

    def summed(held):
        h, code, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((code, h))
        h, code, n = h[order], code[order], n[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (code[1:] != code[:-1])]) if len(h) else np.zeros(0, np.int64)
        return h[first], code[first], np.add.reduceat(n, first) if len(h) else n

    def rows(held):
        h, code, n = summed(held)
        for at in range(0, len(h), 100_000):
            s = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(h[s].view(np.int64)), pa.array(code[s].astype(np.int32)), pa.array(n[s])], ["h", "code", "n"])

    def count(batches):
        model, held, size = shared.value, [], 0
        for _, data, offsets in W.chunks(batches):
            h, _, symbol, _ = model.tokens(data, offsets)
            of = klass[symbol]
            at = np.flatnonzero(symbol == model.rest)
            left = np.where(at > 0, of[at - 1], klass[model.end])
            held.append(summed([(np.r_[h[at], h[at]], np.r_[left, k + of[at + 1]], np.ones(2 * len(at), np.int64))]))
            size += len(held[-1][0])
            if size > 1_000_000:
                yield from rows(held)
                held, size = [], 0
        if held:
            yield from rows(held)

    return docs.select("text").mapInArrow(count, "h long, code int, n long")


def _joined_class(g: np.ndarray, classes: int):
    """Map step over (h, n, seen): the class of each word that raises the likelihood of the class bigrams g most."""
    k = len(g)
    onto, cols = _xlogx(g), g[:, :classes].sum(0)
    rows = g[:classes].sum(1)

    def assign(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                seen, n = part.column("seen"), part.column("n").to_numpy().astype(float)
                word = np.repeat(np.arange(part.num_rows), pc.list_value_length(seen).to_numpy(zero_copy_only=False))
                flat = seen.flatten()
                code, m = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                order = np.lexsort((code, word))
                word, code, m = word[order], code[order], m[order].astype(float)
                before, c = (code < k)[:, None], code % k
                g_of = np.where(before, g[c, :classes], g[:classes, c].T)
                gain = _xlogx(g_of + m[:, None]) - np.where(before, onto[c, :classes], onto[:classes, c].T)
                gain = np.add.reduceat(gain, np.flatnonzero(np.r_[True, word[1:] != word[:-1]]), axis=0)
                gain -= _xlogx(rows + n[:, None]) - _xlogx(rows) + _xlogx(cols + n[:, None]) - _xlogx(cols)
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("n"), pa.array(np.argmax(gain, 1).astype(np.int32))], ["h", "n", "klass"])

    return assign


def word_classes(docs: DataFrame, counts: DataFrame) -> tuple[DataFrame, int]:
    """(h, n, klass) of all words of the training documents and the end, and the number of classes; the last two are the rest and the end."""
    spark = docs.sparkSession
    model = head(counts)
    shared = spark.sparkContext.broadcast(model)
    size = model.n_symbols
    # a row for each symbol, however large the corpus
    pairs = bigrams(docs, shared).groupBy("a").agg(F.collect_list(F.struct("b", "n")).alias("next"))
    found = pairs.repartition(1).mapInArrow(_clustered(size), "klass binary, g binary").collect()
    if found:
        klass, g = np.frombuffer(found[0]["klass"], np.int64), np.frombuffer(found[0]["g"])
    else:  # no bigrams, no task
        klass, g = classes_of(np.zeros((size, size)))
    k = int(klass.max()) + 1
    g = g.reshape(k, k)
    seen = contexts(docs, shared, klass).repartition("h").groupBy("h", "code").agg(F.sum("n").alias("n")).groupBy("h").agg(F.collect_list(F.struct("code", "n")).alias("seen"))
    known = counts.where((F.col("n") >= LEAST) & (F.col("h") != _END))
    tail = seen.join(known, "h").select("h", "n", "seen").mapInArrow(_joined_class(g, k - 2), "h long, n long, klass int")
    clustered = spark.createDataFrame([(int(h), int(n), int(c)) for h, n, c in zip(model.hashes.view(np.int64), model.counts, klass[:-2], strict=True)], "h long, n long, klass int")
    # clustered words that are rare, in a small corpus, are of the rest like others
    clustered = clustered.where(F.col("n") >= LEAST)
    others = counts.where((F.col("h") == _END) | (F.col("n") < LEAST)).select("h", "n", F.when(F.col("h") == _END, k - 1).otherwise(k - 2).cast("int").alias("klass"))
    return materialise(clustered.union(tail).union(others)), k


def shared_table(words: DataFrame, k: int) -> tuple[Model, int]:
    """The most frequent words, cut at a count so that they are SHARED at most, and that count; the end is always one."""
    band = F.floor(F.log2(F.col("n").cast("double")) * 8)
    bands = words.groupBy(band.alias("band")).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy("band").collect()
    least, room = 1 << 62, SHARED
    for r in reversed(bands):
        if (room := room - r["words"]) < 0:
            break
        least = r["least"]
    rows = words.where((F.col("n") >= least) | (F.col("h") == _END)).toPandas()
    h = rows["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return Model(h[order], rows["n"].to_numpy(np.int64)[order], rows["klass"].to_numpy(np.int64)[order], k), least


#: In a document's classes, a word that is looked up later.
OPEN = 255

_READ = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, classes binary, rest array<long>"
_FILLED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, classes binary"


def _read(shared, scale: float, emitted: np.ndarray):
    """Map step: documents as classes, with the sums of the words that the task knows; the others' hashes in `rest`."""

    def read(batches):
        model = shared.value
        row = TaskContext.get().partitionId() << 40
        for rows, data, offsets in W.chunks(batches):
            docs = rows.num_rows
            h, at, klass, last = model.tokens(data, offsets)
            lengths = np.diff(last, prepend=-1)
            doc = np.repeat(np.arange(docs), lengths)
            known, is_end = at >= 0, klass == model.end
            c = np.where(known, model.counts[at], 0) if len(model.counts) else np.zeros(len(h), np.int64)
            rest = ~known & ~is_end
            gain = np.log10(c + 1.0)
            emission = np.where(is_end | rest, 0.0, gain + emitted[klass])
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[rest], minlength=docs))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(docs)), rows.column("doc_id"), rows.column("held_out"), pa.array(lengths), pa.array(np.bincount(doc[known], minlength=docs)),
                    pa.array(np.bincount(doc, gain - scale, docs)), pa.array(np.bincount(doc, emission, docs)),
                    W.binary_column(np.where(rest, OPEN, klass).astype(np.uint8), np.r_[0, last + 1]), pa.ListArray.from_arrays(pa.array(ends), pa.array(h[rest].view(np.int64))),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "classes", "rest"],
            )
            row += docs

    return read


def _flat(column, docs: int):
    """(row of each entry, entries) of a list column; null is empty."""
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(docs), n), column.flatten()


def _fill(emitted: np.ndarray):
    """Map step over _read's rows with the words found for them: nothing is left open."""
    rest_class = len(emitted) - 2

    def fill(batches):
        for batch in batches:
            docs = batch.num_rows
            doc, h = _flat(batch.column("rest"), docs)
            h = h.to_numpy()
            of, entries = _flat(batch.column("found"), docs)
            fh, fk, fn = (entries.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            names = np.unique(np.r_[h, fh])
            key, have = doc * len(names) + np.searchsorted(names, h), of * len(names) + np.searchsorted(names, fh)
            order = np.argsort(have)
            have, fk, fn = have[order], fk[order], fn[order]
            n, klass = np.zeros(len(h), np.int64), np.full(len(h), rest_class)
            if len(have):
                at = np.minimum(np.searchsorted(have, key), len(have) - 1)
                hit = have[at] == key
                n, klass = np.where(hit, fn[at], 0), np.where(hit, fk[at], rest_class)
            gain = np.log10(n + 1.0)
            column = batch.column("classes")
            raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).copy()
            raw[raw == OPEN] = klass
            ends = np.concatenate([[0], np.cumsum(batch.column("n_tokens").to_numpy())])
            add = lambda name, x: pa.array(batch.column(name).to_numpy() + np.bincount(doc, x, docs).astype(batch.column(name).to_numpy().dtype))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), batch.column("n_tokens"), add("n_known", n > 0), add("base_score", gain), add("score", gain + emitted[klass]), W.binary_column(raw, ends)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "classes"],
            )

    return fill


def _sequences(batch, end: int):
    """(document, class before, class) of the tokens of a batch."""
    klass = np.frombuffer(b"".join(batch.column("classes").to_pylist()), np.uint8).astype(np.int64)
    doc = np.repeat(np.arange(batch.num_rows), batch.column("n_tokens").to_numpy())
    return doc, np.r_[end, klass[:-1]], klass


def transitions(filled: DataFrame, k: int) -> np.ndarray:
    """log10 P(class | class) of the training documents."""

    def count(batches):
        table = np.zeros(k * k, np.int64)
        for batch in batches:
            if batch.num_rows:
                _, before, klass = _sequences(batch, k - 1)
                table += np.bincount(before * k + klass, minlength=k * k)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], ["at", "n"])

    rows = filled.where(~F.col("held_out")).select("n_tokens", "classes").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    g = np.zeros(k * k)
    g[rows["at"].to_numpy(int)] = rows["n"].to_numpy(float)
    g = g.reshape(k, k)
    unigram = (g.sum(0) + 1) / (g.sum() + k)
    return np.log10((g + KAPPA * unigram) / (g.sum(1, keepdims=True) + KAPPA))


def _score(transition: np.ndarray):
    def score(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, before, klass = _sequences(batch, len(transition) - 1)
            full = batch.column("score").to_numpy() + np.bincount(doc, transition[before, klass], batch.num_rows)
            names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(full)], [*names, "score"])

    return score


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, remainder: int = 2) -> DataFrame:
    """Scores all documents by a model of those whose id's checksum modulo `modulus` is not `remainder`.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigrams) and score (class-based bigrams), both log10 probabilities.
    """
    spark = prepare(docs.sparkSession)
    held = F.coalesce(remainder_of(F.col(id_col), modulus) == remainder, F.lit(False))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held.alias("held_out"))
    train = docs.where(~F.col("held_out"))
    words, k = word_classes(train, materialise(word_counts(train)))
    model, least = shared_table(words, k)
    # of each class: its tokens and words; an emission is log10(c + 1) plus this
    sums = words.groupBy("klass").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    total, distinct = sum(r["n"] for r in sums), sum(r["words"] for r in sums)
    emitted = np.zeros(k)
    for r in sums:
        emitted[r["klass"]] = -math.log10(r["n"] + r["words"] + 1)
    scale = math.log10(total + distinct + 1) if total + distinct else 0.0
    shared = spark.sparkContext.broadcast(model)
    read = materialise(docs.mapInArrow(_read(shared, scale, emitted), _READ))
    tail = words.where((F.col("n") < least) & (F.col("h") != _END))
    # a word's copies inside a document go as one row
    wanted = read.where(F.size("rest") > 0).select("row", F.explode(F.array_distinct("rest")).alias("h"))
    found = wanted.join(tail, "h").groupBy("row").agg(F.collect_list(F.struct("h", "klass", "n")).alias("found"))
    filled = materialise(read.join(found, "row", "left").mapInArrow(_fill(emitted), _FILLED))
    scored = filled.mapInArrow(_score(transitions(filled, k)), _FILLED.removesuffix(", classes binary"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
