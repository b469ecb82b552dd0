from collections import Counter

import numpy as np
import pytest

from spindrift.llm import packing, vectors


def brute(rows, threshold=0.9):
    """(links, component, kept) by place in rows; a null id is the smallest."""
    good = [(k, np.array(v, float)) for k, (_, v) in enumerate(rows) if v is not None and None not in v and len(v) and np.isfinite(v).all() and np.any(v)]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    n = Counter()
    for a, (i, u) in enumerate(good):
        for j, v in good[:a]:
            if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                n[i] += 1
                n[j] += 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    least = {}
    key = lambda i: -1 if i is None else i
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), 1 << 60), key(i))
    of = [least[root(k)] for k in range(len(rows))]
    return Counter((i, n[k], None if of[k] == -1 else of[k], key(i) == of[k]) for k, (i, _) in enumerate(rows))


def found_in(df):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect())


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(4)
    out = []
    for c in range(12):
        center = r.normal(size=16)
        out += [(len(out) + k, (center + r.normal(size=16) * 0.12).tolist()) for k in range(c)]
    out += [(100 + k, r.normal(size=16).tolist()) for k in range(150)]
    out += [(300 + k, [1.0] * 16) for k in range(40)]
    out += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] + [1.0] * 15), (404, [None] + [1.0] * 15), (405, [1.0, 2.0]), (406, [2.0, 4.0])]
    return out


@pytest.fixture
def all_found(monkeypatch):
    """Small shares of lost pairs, so that small tables come out exact."""
    monkeypatch.setattr(vectors, "MISSED", 1e-9)
    monkeypatch.setattr(vectors, "LOST", 1e-9)
    vectors.needed_collisions.cache_clear()
    yield
    vectors.needed_collisions.cache_clear()


def single(rows):
    return [(i, v if v is None or None in v else np.array(v, np.float32).astype(float).tolist()) for i, v in rows]


def test_against_all_pairs(spark, rows, monkeypatch, all_found):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<float>, cell string, key string, place int")
    assert found_in(df) == brute(single(rows))


def test_shared_and_null_ids(spark, rows, all_found):
    """A third of the rows without an id, a third with one id."""
    rows = [(None if k % 3 == 0 else 5 if k % 3 == 1 else i, v) for k, (i, v) in enumerate(rows)]
    assert found_in(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)) == brute(single(rows))


def test_windows_hold_what_is_near():
    r = np.random.default_rng(3)
    first, place = np.array([0, 40, 41, 90]), r.normal(size=120).astype(np.float32).astype(float)
    ends = [*first[1:], 120]
    for a, b in zip(first, ends, strict=True):
        place[a:b].sort()
    want = {(i, j) for a, b in zip(first, ends, strict=True) for i in range(a, b) for j in range(i + 1, b) if place[j] - place[i] <= 0.3}
    got = [(int(x), int(y)) for i, j in vectors.windows(first, place, 0.3, 50) for x, y in zip(i, j, strict=True)]
    assert len(got) == len(set(got)) and set(got) == want


def test_recall_at_the_threshold(spark):
    """Pairs of cosine 0.9 to 0.905, the least similar ones that count, with production parameters."""
    r = np.random.default_rng(12)
    rows = []
    for k in range(600):
        u, w = r.normal(size=(2, 64))
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        c = r.uniform(0.9001, 0.905)
        rows += [(2 * k, u.tolist()), (2 * k + 1, (c * u + np.sqrt(1 - c * c) * w / np.linalg.norm(w)).tolist())]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("n_links = 1 AND component_id = vec_id - vec_id % 2").count()
    assert got / len(rows) >= 0.97


def test_recall_grows_with_tables():
    bits, tables = vectors.plan(10_000)
    assert vectors.plan(1_000_000)[0] > bits and tables > 1
    half, needed = vectors.needed_collisions()
    assert 0 < needed < vectors.DIRECTIONS and half > 0


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_bins_hold_all_pieces():
    r = np.random.default_rng(1)
    lengths = np.sort(np.minimum(r.lognormal(6, 1.2, 3000).astype(int) + 1, 4096))[::-1]
    bins, places, capacity = packing.pack(lengths)
    held = np.bincount(bins, lengths)
    assert (held <= capacity).all() and lengths.sum() / capacity.sum() > 0.95
    for c in sorted(packing.CAPACITIES):
        assert not ((capacity > c) & (held <= c)).any()  # cut down to the contents
    for b in range(0, len(held), 97):
        at = np.flatnonzero(bins == b)
        order = at[np.argsort(places[at])]
        assert (places[order] == np.r_[0, np.cumsum(lengths[order])[:-1]]).all()


def test_best_fit():
    bins, _, capacity = packing.pack(np.array([6, 5, 4, 3, 2]), (10,), 0)
    assert bins.tolist() == [0, 1, 0, 1, 1] and capacity.tolist() == [10, 10]


def plain_pack(lengths, capacities, bin_cost):
    """Every rule by a full search: (bin, place) of each piece and the capacity of each bin."""
    left, bins, out = list(lengths), [], []
    for n in lengths:
        left.remove(n)
        fitting = [(room - n, b) for b, (room, _) in enumerate(bins) if room >= n]
        if fitting:
            b = min(fitting)[1]
        else:
            cost = {}
            for c in capacities:
                if c >= n:
                    used = n
                    for x in sorted(left, reverse=True):
                        if used + x <= c:
                            used += x
                    cost[c] = (c + bin_cost + c * c / packing.SQUARED) / used
            b = len(bins)
            bins.append((min(cost, key=lambda c: (cost[c], c)), 0))
        room, used = bins[b]
        out.append((b, used))
        bins[b] = (room - n, used + n)
    return out, [min(c for c in capacities if c >= used) for _, used in bins]


def test_packing_against_a_full_search():
    r = np.random.default_rng(2)
    for k in range(150):
        capacities = tuple(sorted(r.choice(np.arange(4, 60), r.integers(1, 5), replace=False).tolist()))
        lengths = np.sort(r.integers(1, capacities[-1] + 1, r.integers(1, 40)))[::-1]
        cost = int(r.integers(0, 10))
        bins, places, capacity = packing.pack(lengths, capacities, cost)
        assert (list(zip(bins.tolist(), places.tolist(), strict=True)), capacity.tolist()) == plain_pack(lengths.tolist(), capacities, cost), k


def _least_cost(lengths, capacities, cost):
    """Of all ways to share the pieces out to bins."""
    best = [float("inf")]

    def go(k, bins):
        if k == len(lengths):
            best[0] = min(best[0], sum(min(c for c in capacities if c >= b) + cost for b in bins))
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacities[-1]:
                go(k + 1, bins[:i] + [bins[i] + lengths[k]] + bins[i + 1 :])
        go(k + 1, [*bins, lengths[k]])

    go(0, [])
    return best[0]


def test_packing_is_near_the_least_cost():
    r, got, least = np.random.default_rng(3), 0, 0
    for _ in range(60):
        lengths = np.sort(r.integers(1, 33, 7))[::-1]
        got += int(packing.pack(lengths, (8, 16, 32), 1)[2].sum() + len(packing.pack(lengths, (8, 16, 32), 1)[2]))
        least += _least_cost(lengths.tolist(), (8, 16, 32), 1)
    assert least <= got <= 1.06 * least


def test_bins_do_not_depend_on_the_layout(docs, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(packing, "TASK_TOKENS", 900)
    found = lambda df: Counter(map(tuple, packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json"), (64, 256)).drop("bin_id").collect()))
    assert found(docs.repartition(2)) == found(docs.repartition(5))


def test_sequences_hold_the_documents(docs, texts, monkeypatch):
    monkeypatch.setattr(packing, "TASK_TOKENS", 5000)
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    rows = packing.pack_sequences(docs, path, (128, 512)).collect()
    found = {}
    for r in rows:
        assert r.n_tokens == len(r.ids) <= r.capacity
        assert [p.place for p in r.pieces] == [sum(p.n_tokens for p in r.pieces[:k]) for k in range(len(r.pieces))]
        for p in r.pieces:
            found.setdefault((p.doc_id, p.start), Counter())[tuple(r.ids[p.place : p.place + p.n_tokens])] += 1
    want = {}
    for i, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        for k in range(0, len(ids), 512):
            want.setdefault((i, k), Counter())[tuple(ids[k : k + 512])] += 1
    assert found == want


def test_documents_are_whole(docs, texts):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    rows = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in texts}
    long = sorted((r.piece, r.start, r.n_tokens) for r in rows if r.doc_id == 14)
    assert [s for _, s, _ in long] == [4096 * k for k in range(len(long))] and all(n == 4096 for _, _, n in long[:-1])
    assert [r.n_tokens for r in rows if r.doc_id == 1] == [1]


def test_nothing_to_pack(none):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    assert packing.pack_documents(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert packing.pack_sequences(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
