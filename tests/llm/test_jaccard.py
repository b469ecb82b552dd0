import re
from collections import Counter

from spindrift.llm.jaccard import keep_one, least_matches, near_duplicates


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(texts):
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    n = [0] * len(texts)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if both and both * 10 >= 8 * (len(a) + len(b) - both):
                n[i] += 1
                n[j] += 1
                parent[root(i)] = root(j)
    first = {}
    key = lambda i: -1 if texts[i][0] is None else texts[i][0]
    for i in range(len(texts)):
        first[root(i)] = min(first.get(root(i), 1 << 60), key(i))
    return Counter((texts[i][0], n[i], None if first[root(i)] == -1 else first[root(i)]) for i in range(len(texts)))


def test_against_all_pairs(docs, texts):
    found = Counter((r.doc_id, r.n_links, r.class_id) for r in near_duplicates(docs).collect())
    assert found == brute(texts)


def test_large_group_in_blocks(spark, monkeypatch):
    from spindrift.llm import jaccard

    monkeypatch.setattr(jaccard, "BUCKET", 8)
    monkeypatch.setattr(jaccard, "GROUP", 8)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(60):
        w = list(base)
        w[(i * 3) % 200] = f"x{i}"
        texts.append((i, " ".join(w)))
    found = Counter((r.doc_id, r.n_links, r.class_id) for r in near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    assert found == brute(texts)


def test_one_of_each_group(docs):
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 2, 3, 4, 6, 7}.issubset(ids) and not {5, 8, 9, 10, 60} & set(ids) and ids.count(None) == 1


def _repeated_ids():
    """Unrelated texts of which a third has no id and a third the id 7; near copies of one text under both, and under an id twice."""
    words = lambda i: [f"u{i}x{k}" for k in range(60)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 100 + i, " ".join(words(i))) for i in range(60)]
    for i, doc_id in ((1, 7), (2, 7), (3, 500), (4, None), (5, 500)):
        rows.append((doc_id, " ".join(["near"] + [f"n{k}" for k in range(200)] + [f"end{i}"])))
    return rows


def test_repeated_ids_against_all_pairs(spark):
    rows = _repeated_ids()
    found = Counter((r.doc_id, r.n_links, r.class_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == brute(rows)


def test_unrelated_texts_of_one_id_stay(spark):
    rows = _repeated_ids()
    kept = Counter((r.doc_id, r.text) for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == Counter(rows[:60] + [r for r in rows[60:] if r[0] is None])


def test_empty(none):
    assert near_duplicates(none).count() == 0


def test_pruning_bounds_rise():
    least = least_matches()
    assert least == sorted(least) and least[-1] > 0.6 * 256


def test_crowded_keys_and_many_ids_change_nothing(spark, docs, texts, monkeypatch):
    from spindrift.llm import jaccard, joins

    monkeypatch.setattr(joins, "CROWDED", 2)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    found = Counter((r.doc_id, r.n_links, r.class_id) for r in near_duplicates(docs).collect())
    assert found == brute(texts)


def test_helper_names_may_be_taken(spark):
    rows = [(1, "a b c d e f", 5, 6, "x", 8), (2, "a b c d e f", 1, 2, "y", 4), (None, None, 1, 2, "y", 4), (None, None, 1, 2, "y", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, rank int, doc string, class_id int")
    assert Counter(map(tuple, keep_one(df).collect())) == Counter([rows[0], *rows[2:]])


def test_nothing_to_keep(none):
    assert keep_one(none).count() == 0
