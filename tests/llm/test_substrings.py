import hashlib
import random
import re
from collections import Counter

from spindrift.llm import substrings
from spindrift.llm.substrings import dedup_substrings, factors_of, remove_repeats


def brute(texts):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts]
    key = lambda i: -1 if i is None else i
    for i, w in split:
        for a in range(len(w) - 19):
            k = tuple(w[a : a + 20])
            first[k] = min(first.get(k, (1 << 60, 0)), (key(i), a))
    out = Counter()
    for i, w in split:
        gone = [False] * len(w)
        for a in range(len(w) - 19):
            if first[tuple(w[a : a + 20])] < (key(i), a):
                gone[a : a + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_against_all_windows(docs, texts):
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(docs).collect())
    assert found == brute(texts)


def test_frequent_anchors_change_nothing(docs, texts, monkeypatch):
    monkeypatch.setattr(substrings, "FREQUENT", 1)
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(docs).collect())
    assert found == brute(texts)


def test_small_batches_change_nothing(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(substrings, "HELD", 10)
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(docs.repartition(7)).collect())
    assert found == brute(texts)


def test_blocks_of_large_partitions_lose_nothing(spark):
    """Each text ends with the passage that the next one begins with; two partitions of 9 MB, with a wide column."""
    r = random.Random(3)
    words = lambda n: " ".join(f"{r.getrandbits(36):09x}" for _ in range(n))
    passages = [words(30) for _ in range(8001)]
    rows = [(i, f"{passages[i]} {words(170)} {passages[i + 1]}", "x" * (i % 40), 0) for i in range(8000)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string, source string, n_chars long")
    left = {r.doc_id: len(r.text.split()) for r in dedup_substrings(docs).select("doc_id", "text").collect()}
    assert left == {i: 230 if i == 0 else 200 for i in range(8000)}


def test_rows_of_one_id_are_cut_each_for_itself(spark):
    words = lambda n, k: " ".join(f"{n}w{i}" for i in range(k))
    rows = [(1, words("a", 40), 0), (2, words("b", 50), 0), (2, words("c", 60) + " " + words("a", 40), 0), (None, words("d", 30), 0), (None, words("e", 30), 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(5)
    left = Counter((r.doc_id, len(r.text.split())) for r in dedup_substrings(docs).collect())
    assert left == Counter([(1, 40), (2, 50), (2, 60), (None, 30), (None, 30)])


def test_texts_are_cut(docs):
    rows = {r.doc_id: r for r in dedup_substrings(docs).collect() if r.doc_id}
    assert dedup_substrings(docs).columns == docs.columns
    assert rows[7].text and rows[8].text == "" and rows[8].n_chars == 0 and rows[8].source == "src2"
    assert rows[1].text is None and rows[2].text == ""


def test_factors_join_while_the_reference_advances():
    assert factors_of([(0, 2, 5, 7), (2, 3, 5, 9), (5, 1, 6, 0)]) == [(0, 24, 5, 7), (5, 20, 6, 0)]


def test_empty(none):
    assert remove_repeats(none).count() == 0 and dedup_substrings(none).count() == 0


def _order(rows):
    """Rows in the order that shared ids are given: by id, then by a hash of the text."""
    return sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[2]))


def test_rows_that_share_ids_against_all_windows(spark):
    """A third of the rows without an id, a third with one id; short and long ones, passages between them, in tasks of their own."""
    r = random.Random(9)
    words = lambda n: " ".join(f"{r.getrandbits(36):09x}" for _ in range(n))
    passages = [words(30) for _ in range(5)]
    rows = []
    for i in range(60):
        text = words(r.choice([3, 15, 40])) + " " + r.choice(passages) + " " + words(r.choice([2, 50]))
        rows.append((None if i % 3 == 0 else 1 if i % 3 == 1 else i, text if i % 7 else words(3)))
    rows += rows[:4] + [(None, None), (1, ""), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    hashed = [tuple(x) for x in df.selectExpr("doc_id", "text", "xxhash64(text)").collect()]
    ordered = _order(hashed)
    expected = Counter((ordered[k][0], *rest) for k, *rest in brute([(k, t) for k, (_, t, _) in enumerate(ordered)]))
    found = Counter((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in remove_repeats(df).collect())
    assert found == expected


def test_a_very_long_text(spark):
    """50 MB in one row; its first 40 words are another row's."""
    long = " ".join(f"{i:07x}" for i in range(6_250_000))
    head = " ".join(long.split(" ", 41)[:40])
    docs = spark.createDataFrame([(1, head), (2, "other " + head)], "doc_id long, text string").union(spark.range(1).selectExpr("CAST(3 AS LONG)", "array_join(transform(sequence(0, 6249999), i -> lpad(lower(hex(i)), 7, '0')), ' ')"))
    found = {x.doc_id: (x.n_words, x.n_removed) for x in remove_repeats(docs).collect()}
    assert found == {1: (40, 0), 2: (41, 40), 3: (6_250_000, 40)}


def test_helper_names_may_be_taken(spark):
    rows = [(1, "a", 5, 6, 7, 8, 9), (1, None, 1, 2, 3, 4, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, extra int, others int, _row int, n_chars int")
    assert Counter(map(tuple, dedup_substrings(df).collect())) == Counter(rows)
