import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from spindrift.llm import brown, licenses, toxicity

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_base_score_against_plain_counts(docs, texts):
    tok = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None]) for i, t in texts]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in tok if not held(i) for w in t)
    total, distinct = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(t), sum(c[w] > 0 for w in t), total, round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in t), 6)) for i, t in tok)
    rows = brown.score_documents(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(r.score < 0 for r in rows)


def test_tail_words_are_joined(docs, texts, monkeypatch):
    whole = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in brown.score_documents(docs).collect()}
    monkeypatch.setattr(brown, "SHARED", 20)
    monkeypatch.setattr(brown, "CLUSTERED", 5)
    assert {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in brown.score_documents(docs).collect()} == whole


def test_size_of_the_shared_table_changes_nothing(docs, monkeypatch):
    scores = lambda: sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in brown.score_documents(docs).collect())
    monkeypatch.setattr(brown, "CLUSTERED", 5)
    whole = scores()
    monkeypatch.setattr(brown, "SHARED", 3)
    assert scores() == whole


def test_words_outside_the_clustering_have_classes(spark, monkeypatch):
    """Two kinds of rare words, alike in frequency, told apart by their neighbours; a word seen once is of the rest."""
    monkeypatch.setattr(brown, "CLUSTERED", 4)
    monkeypatch.setattr(brown, "CLASSES", 2)
    texts = [f"a b c d a x{i // 2 % 40} c b" if i % 2 else f"b a d c b y{i // 2 % 40} d a" for i in range(800)] + ["a once b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words, k = brown.word_classes(docs, brown.word_counts(docs))
    klass = {r.h: r.klass for r in words.collect()}
    of = lambda w: klass[int(brown.W.split(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)])).hash.view(np.int64)[0])]
    seen = {w for t in texts for w in t.split()}
    x, y = ({of(w) for w in seen if w[0] == c} for c in "xy")
    assert len(x) == len(y) == 1 and x != y and max(x | y) < k - 2 and of("once") == k - 2


def test_exchange_finds_the_classes():
    r = np.random.default_rng(0)
    kind = np.arange(40) % 4
    follow = np.array([[0, 9, 0, 1], [0, 0, 9, 1], [9, 0, 0, 1], [3, 3, 3, 1]])
    table = r.poisson(follow[kind][:, kind] * 5).astype(float)
    klass = brown.exchange(table, 40, classes=4, rounds=20)
    assert len({(a, b) for a, b in zip(kind, klass, strict=True)}) == 4


def test_score_against_plain_class_bigrams(docs, texts):
    """The score from the words' classes and counts alone, a token at a time."""
    tok = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None]) for i, t in texts]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = docs.where("doc_id IS NULL OR crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 <> 2")
    words, k = brown.word_classes(train, brown.word_counts(train))
    table = {r.h: (r.klass, r.n) for r in words.collect()}
    key = lambda w: int(brown.END.astype(np.int64)) if w is None else int(np.uint64(brown.W.hash_of(w)).astype(np.int64))
    klass = lambda w: table.get(key(w), (k - 2, 0))[0]
    g = Counter((a, b) for i, t in tok if not held(i) for a, b in zip([k - 1, *map(klass, t)], map(klass, t), strict=False))
    of, into = Counter(), Counter()
    for (a, b), n in g.items():
        of[a] += n
        into[b] += n
    total = sum(of.values())
    size = {c: (sum(n for x, n in table.values() if x == c), sum(x == c for x, _ in table.values())) for c in range(k)}

    def log_p(t):
        score, before = 0.0, k - 1
        for w in t:
            c, n = table.get(key(w), (k - 2, 0))
            score += math.log10((g[before, c] + brown.KAPPA * (into[c] + 1) / (total + k)) / (of[before] + brown.KAPPA))
            if w is not None:
                score += math.log10((n + 1) / (size[c][0] + size[c][1] + 1))
            before = c
        return score

    found = sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in brown.score_documents(docs).collect())
    assert found == sorted((str(i), len(t), round(log_p(t), 6)) for i, t in tok)


def test_no_training_documents(spark):
    docs = spark.createDataFrame([(17, "a b")], "doc_id long, text string").where("doc_id < 0")
    assert brown.score_documents(docs).count() == 0


def matching(words, templates):
    """Longest template substring that ends at each word, by trying all of them."""
    out = []
    for i in range(len(words)):
        n = 0
        while n <= i and any(tuple(words[i - n : i + 1]) == tuple(t[k : k + n + 1]) for t in templates for k in range(len(t) - n)):
            n += 1
        out.append(n)
    return out


def test_matching_statistics():
    templates = [[1, 2, 3, 4, 1, 2], [2, 3, 5], [1, 1, 2, 3], [1, 2, 3, 4, 1, 2]]
    sam = licenses.SuffixAutomaton(templates)
    r = np.random.default_rng(2)
    for _ in range(300):
        words = r.integers(0, 7, 12).tolist()
        state, n, got = 0, 0, []
        for w in words:
            state, n = sam.step(state, n, w)
            got.append(n)
            for k, e in sam.ends[state] if n else ():
                assert templates[k][e - n + 1 : e + 1] == words[len(got) - n : len(got)]
        assert got == matching(words, templates)


def test_licence_places(docs, texts):
    rows = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(docs).collect())
    want = Counter()
    for i, t in texts:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))
        at = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want[i, len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))] += 1
    assert rows == want


def test_licence_spans(spark):
    bsd = next(t for label, t in licenses.TEMPLATES if label == "bsd")
    text = "some words before " + bsd.replace("permitted", "allowed") + " and after"
    row = licenses.scan_licenses(spark.createDataFrame([(1, text), (2, "redistribution and use")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert row[0].labels == "bsd" and 0.6 <= row[0].score < 1 and row[0].spans[0].first_word == 3
    assert row[1].labels == "" and row[1].score == 0 and row[1].first_word is None


def plain_chains(words, template, gap, share):
    """(first word, last word, covered share) of the best chain of maximal matches, by trying every chain; small inputs only."""
    n, best = licenses.MIN_MATCH, None
    found = []
    for i in range(len(words)):
        for p in range(len(template)):
            k = 0
            while i + k < len(words) and p + k < len(template) and words[i + k] == template[p + k]:
                k += 1
            if k >= n and not (i and p and words[i - 1] == template[p - 1]):
                found.append((i, p, k))

    def go(chain):
        nonlocal best
        covered = sum(k for _, _, k in chain)
        if chain and (best is None or covered > best[2]):
            best = (chain[0][0], chain[-1][0] + chain[-1][2] - 1, covered)
        for i, p, k in found:
            if not chain or (chain[-1][0] + chain[-1][2] <= i <= chain[-1][0] + chain[-1][2] + gap and chain[-1][1] + chain[-1][2] <= p):
                go([*chain, (i, p, k)])

    go([])
    return best and best[2] >= share * len(template) and (best[0], best[1], best[2] / len(template)) or None


def test_chains_against_all_chains(spark):
    """A text with words of its template changed, left out or put in between has the span of its best chain."""
    r = np.random.default_rng(4)
    template = [f"t{k}" for k in range(30)]
    texts = []
    for _ in range(60):
        w = [f"a{k}" for k in r.integers(0, 9, 5)] + list(template) + [f"b{k}" for k in r.integers(0, 9, 5)]
        for _ in range(r.integers(0, 4)):
            at = int(r.integers(5, len(w) - 5))
            w[at : at + int(r.integers(0, 3))] = [f"x{k}" for k in range(r.integers(0, 14))]
        texts.append(" ".join(w))
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates=[("own", " ".join(template))]).collect()
    for row in rows:
        want = plain_chains(texts[row.doc_id].split(), template, licenses.MAX_GAP, licenses.COVERED)
        assert (row.labels == "own") == (want is not None), texts[row.doc_id]
        if want:
            assert (row.spans[0].first_word, row.spans[0].last_word) == want[:2] and row.score == pytest.approx(want[2])


def test_templates_are_a_parameter(spark):
    df = spark.createDataFrame([(1, "released under the mit license"), (2, "one two three four five"), (None, None)], "doc_id long, text string")
    found = {r.doc_id: (r.base_labels, r.labels) for r in licenses.scan_licenses(df, templates=[("count", "one two three four five")]).collect()}
    assert found == {1: ("mit", "mit"), 2: ("", "count"), None: ("", "")}
    assert {r.labels for r in licenses.scan_licenses(df, templates=[]).collect()} == {"mit", ""}


def test_whole_texts_are_recognised(spark):
    long = [(label, t) for label, t in licenses.TEMPLATES if len(t) > 500]
    rows = [(i, "Copyright (c) 2021 Someone\n\n" + t.replace(" ", "\n   * ", 40)) for i, (_, t) in enumerate(long)]
    found = {r.doc_id: r.labels.split(",") for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(long) >= 6 and all(label in found[i] for i, (label, _) in enumerate(long))


def test_short_notices(spark):
    texts = ["some words.\nAll rights reserved.", "Copyright 2020 X. All rights reserved.", "a Copyright x. All rights reserved\n", "all rights of man are reserved", "copyright reserved for all", "released under the terms"]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.labels, r.score) for r in rows] == [("all-rights-reserved", 1.0)] * 3 + [("", 0.0)] * 3
    assert (0, 5) in [(s.first_word, s.last_word) for s in rows[1].spans]


def test_gradients(monkeypatch):
    monkeypatch.setattr(toxicity, "_F", np.float64)
    r = np.random.default_rng(0)
    net = toxicity.Net.new(np.sort(r.integers(0, 1 << 60, 5, dtype=np.uint64)))
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    row, grams, first = np.array([0, 1, 2, 3]), r.integers(0, toxicity.GRAMS, 9), np.array([0, 2, 5, 6, 9])
    at, inside, slope = r.integers(0, 4, (3, toxicity.WINDOW)), np.ones((3, toxicity.WINDOW), bool), r.normal(size=3)
    inside[1, 10:] = False
    g = net.gradients(slope, net.forward(net.inputs(row, grams, first), at, inside, True)[1], row, grams, first)
    value = lambda: (net.forward(net.inputs(row, grams, first), at, inside) * slope).sum()
    for name, p in net.p.items():
        for _ in range(3):
            i = tuple(r.integers(0, n) for n in p.shape)
            i = (grams[r.integers(9)], i[1]) if name == "char" else (r.integers(0, 4), i[1]) if name == "word" else i
            old = p[i]
            p[i] = old + 1e-5
            up = value()
            p[i] = old - 1e-5
            slope_here = (up - value()) / 2e-5
            p[i] = old
            assert slope_here == pytest.approx(g[name][i], abs=1e-5)


def test_windows_reach_the_end():
    doc, begin = toxicity.windows_of(np.array([0, 5, 32, 33, 100]))
    for d, n in enumerate([0, 5, 32, 33, 100]):
        b = begin[doc == d]
        assert len(b) >= 1 and set(range(n)) <= {x for s in b for x in range(s, s + toxicity.WINDOW)}


def test_toxic_words_are_learnt(spark):
    r = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(400):
        w = [f"w{k}" for k in r.integers(0, 300, r.integers(5, 120))]
        y = int(i % 3 == 0)
        if y:
            w[r.integers(len(w))] = "grumf" + "abcd"[i % 4]
        rows.append((i, " ".join(w), "extra"))
        labels.append((i, y))
    rows += [(1000, None, ""), (1001, "", ""), (None, "w1", "")]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.score_documents(docs, known).collect()
    assert len(found) == len(rows) and all(0 <= x.score <= 1 for x in found)
    held = [(x.predicted, dict(labels)[x.doc_id]) for x in found if x.held_out and x.doc_id < 400]
    assert sum(p == y for p, y in held) / len(held) > 0.9
    assert toxicity.remove_toxic(docs, known).columns == docs.columns
    assert {x.score for x in toxicity.score_documents(docs, known.where("toxic = 0")).collect()} == {0.0}


def _plain_score(net, text):
    """Probability of one text, a word and a gate at a time, from the weights alone."""
    sig = lambda x: 1 / (1 + math.exp(-max(-30, min(30, x))))
    p = {k: v.astype(float) for k, v in net.p.items()}
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))
    size, x = toxicity.HIDDEN, []
    for w in words:
        raw = w.encode()
        h = int(brown.W.hash_of(w))
        row = net.hashes.tolist().index(h) + 1 if h in net.hashes.tolist() else 0
        letters = [1, *raw, 2]
        buckets = []
        for k in (3, 4):
            for a in range(len(letters) - k + 1):
                g = k
                for c in letters[a : a + k]:
                    g = (g * 257 + c) % (1 << 64)
                buckets.append(int(brown.W.mix(np.array([g], np.uint64))[0]) % toxicity.GRAMS)
        x.append([*p["word"][row], *np.mean([p["char"][b] for b in buckets], axis=0)])
    best, begin = -math.inf, 0
    while True:
        part = x[begin : begin + toxicity.WINDOW]
        states = {}
        for d, order in (("f", range(len(part))), ("b", reversed(range(len(part))))):
            h = [0.0] * size
            for t in order:
                gate = [sum(part[t][i] * p[f"w{d}"][i, j] for i in range(len(part[t]))) + p[f"c{d}"][j] for j in range(3 * size)]
                z, r = ([sig(gate[o + j] + sum(h[i] * p[f"u{d}"][i, o + j] for i in range(size))) for j in range(size)] for o in (0, size))
                n = [math.tanh(gate[2 * size + j] + sum(r[i] * h[i] * p[f"u{d}"][i, 2 * size + j] for i in range(size))) for j in range(size)]
                h = [n[j] + z[j] * (h[j] - n[j]) for j in range(size)]
                states[d, t] = h
        e = [math.exp(sum(math.tanh(sum(v * p["a"][i, j] for i, v in enumerate(states["f", t] + states["b", t])) + p["ac"][j]) * p["v"][j] for j in range(toxicity.ATTENTION))) for t in range(len(part))]
        pooled = [sum(e[t] * (states["f", t] + states["b", t])[i] for t in range(len(part))) / sum(e) for i in range(2 * size)] if part else [0.0] * (2 * size)
        best = max(best, sum(v * o for v, o in zip(pooled, p["o"], strict=True)) + p["oc"][0])
        if begin + toxicity.WINDOW >= len(x):
            return sig(best)
        begin += toxicity.STRIDE


def _sample(texts):
    sample = toxicity.Sample()
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        sample.add(raw, np.array([0, len(raw)]))
    return sample


def test_scores_against_a_plain_recomputation():
    r = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in r.integers(0, 60, n)) for n in (3, 31, 32, 33, 70, 150, 40, 9)] + ["Ünï CODE x 漢字", "", None]
    net = toxicity.train(_sample(texts), np.arange(len(texts)) % 2, steps=6)
    assert len(net.hashes) > 5
    raw = [(t or "").encode() for t in [*texts, "never seen words", "w1 w2 never"]]
    got = net.score(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in raw])]))
    assert got == pytest.approx([_plain_score(net, b.decode()) for b in raw], abs=1e-5)


def test_long_texts_are_learnt_from_whole(spark):
    """Every toxic text is long, with its one bad word anywhere in it; empty and null ones are learnt from too."""
    r = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(120):
        y = i % 2
        w = [f"w{k}" for k in r.integers(0, 200, 4500 if y else 60)]
        if y:
            w[r.integers(len(w))] = "grumfle"
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    rows += [(1000, ""), (1001, None), (3, "another row of an id")]
    labels += [(1000, 0), (1001, 0), (None, 1), (2000, 1)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    found = [x for x in toxicity.score_documents(docs, known).collect() if x.held_out and x.doc_id < 120]
    assert sum(x.predicted == x.doc_id % 2 for x in found) / len(found) > 0.9


def test_no_documents_or_labels(spark, none):
    known = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(none, known).count() == 0
    assert toxicity.remove_toxic(none, known).count() == 0
    assert licenses.scan_licenses(none).count() == 0
