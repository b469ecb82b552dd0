"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows.

A word's input is its embedding (or that of all unknown words) and the mean of the
embeddings of its character n-grams, so unseen words are read by their letters.
Each window of WINDOW words, STRIDE apart, is read in both directions; attention
pools its states to one value, and the document's score is that of its highest
window. All windows of all documents are scored.

Training is one task, in numpy, by gradients written out below, on a bounded
sample: at most SAMPLE labelled documents of each class, the first ones by a hash
of their ids, whole, whatever their length. The task gets them one Arrow batch at
a time and keeps 4 bytes a word, so the driver only ever holds the weights; a
lost executor repeats the task with the same rows in the same order. In every
step all windows of the step's documents are read; a document's gradient goes
through its highest window and a random one that is negative.

Defined results: null and empty texts are one empty window, when scored and when
learnt from; without labels of both classes (an empty table of labels, too) every
score is 0 and remove_toxic keeps every row; a null id is never held out nor
learnt from; repeated rows score alike; of rows that share a labelled id the one
with the least hash of its text is learnt from; of several labels for an id the
highest counts; an empty table gives no rows. Other columns are ignored by
score_documents and passed on by remove_toxic, whatever their names.
"""

from __future__ import annotations

import io
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .brown import remainder_of
from .runtime import prepare

WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 12, 12, 8, 8
GRAMS = 1 << 14
VOCABULARY = 20_000
SAMPLE = 2_000
STEPS, BATCH, RATE, DROPPED = 300, 64, 0.01, 0.3
#: Windows that are read at once.
AT_ONCE = 2048
CUT = 0.3
_F = np.float32


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values of each row."""
    out = np.zeros((size, values.shape[1]), values.dtype)
    if len(rows):
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[rows[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def grams_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each 3- and 4-gram of the marked lower-case words, first gram of each word + 1)."""
    n = end - start + 2
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], n)
    inner = (at > 0) & (at < np.repeat(n, n) - 1)
    c = np.full(first[-1], 1, np.uint64)
    raw = data[(np.repeat(start, n) + at - 1)[inner]]
    c[inner] = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    c[first[1:] - 1] = 2
    left = np.repeat(n, n) - at  # letters from here to the word's end
    out, word = [], []
    owner = np.repeat(np.arange(len(n)), n)
    for k in (3, 4):
        ok = np.flatnonzero(left >= k)
        g = np.full(len(ok), k, np.uint64)
        for j in range(k):
            g = g * np.uint64(257) + c[ok + j]
        out.append((W.mix(g) % np.uint64(GRAMS)).astype(np.int64))
        word.append(owner[ok])
    out, word = np.concatenate(out), np.concatenate(word)
    order = np.argsort(word, kind="stable")
    return out[order], np.searchsorted(word[order], np.arange(len(n) + 1))


def windows_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word in it) of every window; a document has one at least, and they reach its end."""
    n = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(counts)), n)
    return doc, (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE


@dataclass
class Net:
    """Weights; hashes is the sorted vocabulary, whose embeddings follow that of unknown words."""

    hashes: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, hashes: np.ndarray, seed: int = 7) -> Net:
        r = np.random.default_rng(seed)
        x = WORD_DIM + CHAR_DIM
        p = {"word": r.normal(0, 0.1, (len(hashes) + 1, WORD_DIM)), "char": r.normal(0, 0.3, (GRAMS, CHAR_DIM))}
        for d in "fb":
            p[f"w{d}"] = r.normal(0, x**-0.5, (x, 3 * HIDDEN))
            p[f"u{d}"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
            p[f"c{d}"] = np.zeros(3 * HIDDEN)
        p |= {"a": r.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, ATTENTION)), "ac": np.zeros(ATTENTION), "v": r.normal(0, 1, ATTENTION), "o": r.normal(0, 0.3, 2 * HIDDEN), "oc": np.zeros(1)}
        return cls(hashes, {k: v.astype(_F) for k, v in p.items()})

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Row of each word's embedding."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at + 1, 0)

    def inputs(self, row: np.ndarray, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Inputs of words that have grams[first[i]:first[i + 1]]; every word has one at least."""
        char = np.add.reduceat(self.p["char"][grams], first[:-1], axis=0) / np.diff(first)[:, None] if len(row) else np.zeros((0, CHAR_DIM))
        return np.concatenate([self.p["word"][row], char.astype(_F)], axis=1)

    def _read(self, d: str, gates: np.ndarray, at: np.ndarray, inside: np.ndarray, keep: bool):
        """States of one direction; gates are inputs times weights, at[b, t] the word there."""
        u, size = self.p[f"u{d}"], HIDDEN
        h = np.zeros((len(at), size), _F)
        states, saved = np.zeros((WINDOW, len(at), size), _F), []
        full = bool(inside.all())
        for t in range(WINDOW) if d == "f" else reversed(range(WINDOW)):
            x = gates[at[:, t]]
            zr = _sigmoid(x[:, : 2 * size] + h @ u[:, : 2 * size])
            z, r = zr[:, :size], zr[:, size:]
            rh = r * h
            n = np.tanh(x[:, 2 * size :] + rh @ u[:, 2 * size :])
            new = n + z * (h - n)
            if not full:
                new = np.where(inside[:, t, None], new, h)
            if keep:
                saved.append((t, h, z, r, n))
            h = states[t] = new
        return states, saved

    def forward(self, x: np.ndarray, at: np.ndarray, inside: np.ndarray, keep: bool = False):
        """Logit of each window; x has a row for each word, at[b, t] its word."""
        p, saved, states = self.p, {}, []
        if not len(x):
            x = np.zeros((1, WORD_DIM + CHAR_DIM), _F)
        for d in "fb":
            s, saved[d] = self._read(d, x @ p[f"w{d}"] + p[f"c{d}"], at, inside, keep)
            states.append(s)
        h = np.concatenate(states, axis=2)
        k = np.tanh(h @ p["a"] + p["ac"])
        e = np.where(inside.T, k @ p["v"], _F(-1e9))
        e = np.exp(e - e.max(0))
        e *= inside.T
        alpha = e / np.maximum(e.sum(0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", alpha, h)
        logit = pooled @ p["o"] + p["oc"][0]
        return (logit, (x, at, inside, saved, h, k, alpha, pooled)) if keep else logit

    def gradients(self, slope: np.ndarray, kept, row: np.ndarray, grams: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """Of the sum of slope * logit."""
        x, at, inside, saved, h, k, alpha, pooled = kept
        p, size = self.p, HIDDEN
        g = {"o": pooled.T @ slope, "oc": np.array([slope.sum()], _F)}
        d_pooled = slope[:, None] * p["o"]
        d_alpha = np.einsum("bh,tbh->tb", d_pooled, h)
        dh = alpha[:, :, None] * d_pooled
        de = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        g["v"] = np.einsum("tb,tba->a", de, k)
        dk = de[:, :, None] * p["v"] * (1 - k * k)
        g["a"], g["ac"] = np.einsum("tbh,tba->ha", h, dk), dk.sum((0, 1))
        dh = dh + dk @ p["a"].T
        dx = np.zeros_like(x)
        for i, d in enumerate("fb"):
            u = p[f"u{d}"]
            gu, passed = np.zeros_like(u), np.zeros((WINDOW, len(at), 3 * size), _F)
            carry = np.zeros((len(at), size), _F)
            for t, before, z, r, n in reversed(saved[d]):
                new = carry + dh[t, :, i * size : (i + 1) * size]
                live = inside[:, t, None].astype(_F)
                d_new = new * live
                dz, dn = d_new * (before - n) * z * (1 - z), d_new * (1 - z) * (1 - n * n)
                d_rh = dn @ u[:, 2 * size :].T
                dr = d_rh * before * r * (1 - r)
                gu[:, 2 * size :] += (r * before).T @ dn
                zr = np.concatenate([dz, dr], axis=1)
                gu[:, : 2 * size] += before.T @ zr
                passed[t, :, : 2 * size], passed[t, :, 2 * size :] = zr, dn
                carry = new * (1 - live) + d_new * z + d_rh * r + zr @ u[:, : 2 * size].T
            gates = _scatter(at.T.reshape(-1), passed.reshape(-1, 3 * size), len(x))
            g[f"u{d}"], g[f"c{d}"] = gu, gates.sum(0)
            g[f"w{d}"] = x.T @ gates
            dx += gates @ p[f"w{d}"].T
        times = np.diff(first)
        g["word"] = _scatter(row, dx[:, :WORD_DIM], len(p["word"]))
        g["char"] = _scatter(grams, np.repeat(dx[:, WORD_DIM:] / times[:, None].astype(x.dtype), times, axis=0), GRAMS)
        return g

    def score(self, data: np.ndarray, offsets: np.ndarray, at_once: int = AT_ONCE) -> np.ndarray:
        """Probability for each document."""
        w = W.split(data, offsets, W.ALNUM, lower=True)
        _, one, back = np.unique(w.hash, return_index=True, return_inverse=True)
        grams, first = grams_of(data, w.start[one], w.end[one])
        x = self.inputs(self.look_up(w.hash[one]), grams, first)
        doc, begin = windows_of(w.counts())
        best = np.full(len(offsets) - 1, -np.inf)
        for lo in range(0, len(doc), at_once):
            d, b = doc[lo : lo + at_once], begin[lo : lo + at_once]
            place = b[:, None] + np.arange(WINDOW)
            inside = place < w.counts()[d][:, None]
            word = back[np.where(inside, w.first[d][:, None] + place, 0)] if len(back) else np.zeros(place.shape, np.int64)
            np.maximum.at(best, d, self.forward(x, word, inside))
        return _sigmoid(best)


class Sample:
    """Training documents as numbers of distinct words, gathered chunk by chunk; no text is kept."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.names, self.grams, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        w = W.split(data, offsets, W.ALNUM, lower=True)
        self.hashes.append(w.hash)
        self.lengths.append(w.counts())
        names, one = np.unique(w.hash, return_index=True)
        new = ~np.isin(names, self.names)
        names, one = names[new], one[new]
        grams, first = grams_of(data, w.start[one], w.end[one])
        # in the order in which they came; `settled` sorts them
        self.names, self.grams = np.r_[self.names, names], np.r_[self.grams, grams]
        self.first = np.r_[self.first, self.first[-1] + first[1:]]

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sorted names, grams, first gram of each name + 1, name of each word, first word of each document + 1)."""
        order = np.argsort(self.names)
        n = np.diff(self.first)[order]
        first = np.concatenate([[0], np.cumsum(n)])
        grams = self.grams[np.repeat(self.first[:-1][order], n) + np.arange(first[-1]) - np.repeat(first[:-1], n)]
        names = self.names[order]
        words = [np.searchsorted(names, h).astype(np.int32) for h in self.hashes]
        lengths = np.concatenate([np.zeros(0, np.int64), *self.lengths])
        return names, grams, first, np.concatenate([np.zeros(0, np.int32), *words]), np.concatenate([[0], np.cumsum(lengths)])


def train(sample: Sample, labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Net:
    names, grams, first, words, starts = sample.settled()
    counts, step = np.diff(starts), 0
    times = np.bincount(words, minlength=len(names))
    often = np.lexsort((names, -times))[:VOCABULARY]
    net = Net.new(np.sort(names[often[times[often] >= 3]]))
    row = net.look_up(names)
    r = np.random.default_rng(seed)
    m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}

    def placed(doc, begin):
        """(word of each place, whether it is one) of windows; any word stands where there is none."""
        place = begin[:, None] + np.arange(WINDOW)
        inside = place < counts[doc][:, None]
        at = np.where(inside, starts[doc][:, None] + place, 0)
        return words[at] if len(words) else np.zeros(at.shape, np.int64), inside

    def read(x_of, doc, begin):
        """Logits of windows, AT_ONCE at a time."""
        out = np.zeros(len(doc), _F)
        for lo in range(0, len(doc), AT_ONCE):
            word, inside = placed(doc[lo : lo + AT_ONCE], begin[lo : lo + AT_ONCE])
            used, word = np.unique(word, return_inverse=True)
            out[lo : lo + AT_ONCE] = net.forward(x_of(used)[0], word.reshape(inside.shape), inside)
        return out

    def inputs(dropped):
        def x_of(used):
            if not len(names):
                return np.zeros((0, WORD_DIM + CHAR_DIM), _F), used[:0], used[:0], np.zeros(1, np.int64)
            n = np.diff(first)[used]
            g_first = np.concatenate([[0], np.cumsum(n)])
            g = grams[np.repeat(first[used], n) + np.arange(n.sum()) - np.repeat(g_first[:-1], n)]
            g_row = np.where(dropped[used], 0, row[used])
            return net.inputs(g_row, g, g_first), g_row, g, g_first

        return x_of

    while step < steps:
        order = r.permutation(len(counts))
        for lo in range(0, min(len(order), (steps - step) * BATCH), BATCH):
            some = order[lo : lo + BATCH]
            nth, begin = windows_of(counts[some])
            doc = some[nth]
            x_of = inputs(r.random(len(names)) < DROPPED)
            logit = read(x_of, doc, begin)
            ranked = np.lexsort((-logit, nth))
            top = ranked[np.searchsorted(nth[ranked], np.arange(len(some)))]
            negative = np.flatnonzero(labels[doc] == 0)
            extra = r.choice(negative, min(len(some), len(negative)), replace=False) if len(negative) else negative
            chosen = np.concatenate([top, extra])
            y = labels[doc[chosen]].astype(_F)
            word, inside = placed(doc[chosen], begin[chosen])
            used, word = np.unique(word, return_inverse=True)
            x, g_row, g, g_first = x_of(used)
            logit, kept = net.forward(x, word.reshape(inside.shape), inside, keep=True)
            slope = ((_sigmoid(logit) - y) / len(chosen)).astype(_F)
            step += 1
            rate = RATE * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, d in net.gradients(slope, kept, g_row, g, g_first).items():
                a, b = m[k]
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                net.p[k] -= (rate * a / (np.sqrt(b) + 1e-8)).astype(_F)
    return net


def _fit(batches: Iterable[pa.RecordBatch]):
    """The one task that trains: rows (text, y) in, the weights out; none if a class has no documents."""
    sample, labels = Sample(), []
    for rows, data, offsets in W.chunks(batches):
        sample.add(data, offsets)
        labels.append(rows.column("y").to_numpy())
    y = np.concatenate([np.zeros(0, np.int64), *labels])
    if len(np.unique(y)) < 2:
        return
    net, out = train(sample, y), io.BytesIO()
    np.savez(out, hashes=net.hashes, **net.p)
    W.free()
    yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["weights"])


def fit(docs: DataFrame, labels: DataFrame, held_out, label_col: str = "toxic") -> Net | None:
    """The network of the sample; docs has doc_id and text. None if a class has no documents."""
    known = labels.select("doc_id", F.col(label_col).alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.max("y").cast("long").alias("y")).where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # twice as many ids as are wanted, as not all need have a document; never more rows than that
    ids = [known.where(F.col("y") == y).orderBy(*order).limit(2 * SAMPLE) for y in (0, 1)]
    found = docs.join(F.broadcast(ids[0].union(ids[1])), "doc_id")
    found = found.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = [found.where(F.col("y") == y).orderBy(*order).limit(SAMPLE) for y in (0, 1)]
    rows = rows[0].union(rows[1]).repartition(1).sortWithinPartitions(*order).select("text", "y")
    weights = rows.mapInArrow(_fit, "weights binary").collect()
    if not weights:
        return None
    with np.load(io.BytesIO(weights[0]["weights"])) as found:
        p = {k: found[k] for k in found.files}
    return Net(p.pop("hashes"), p)


def _held(modulus: int, remainder: int):
    return lambda doc_id: F.coalesce(remainder_of(doc_id, modulus) == remainder, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of each row; learnt from labels (doc_id, toxic) of ids whose checksum modulo `modulus` is not `remainder`."""
    spark = prepare(docs.sparkSession)
    held = _held(modulus, remainder)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    net = spark.sparkContext.broadcast(fit(docs, labels, held))

    def score(batches):
        for rows, data, offsets in W.chunks(batches, limit=1_000_000):
            p = net.value.score(data, offsets).astype(np.float64) if net.value else np.zeros(rows.num_rows)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    scored = docs.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT, modulus: int = 4, remainder: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that score below `cut`, each with all its columns; the defined results are those of the module."""
    spark = prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    net = spark.sparkContext.broadcast(fit(plain, labels, _held(modulus, remainder)))

    def clean(batches):
        for rows, data, offsets in W.chunks(batches, text_col, limit=1_000_000):
            yield rows.filter(pa.array(net.value.score(data, offsets) < cut)) if net.value else rows

    return docs.mapInArrow(clean, docs.schema)
