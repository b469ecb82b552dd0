import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from spindrift.llm import bpe, wavelet

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

ODD = ["a", "A", "Σ", "İ", "é", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "漢", "1", "²", "'", "'s", "'LL", "<|endoftext|>", "<|", "!", "...", "😀", "́", "aaa", "the", "ing", " the", "\x00", "가", "_", " \n", "\r\n"]


def library(name):
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def odd_texts(texts):
    r = random.Random(3)
    more = ["".join(r.choice(ODD) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    return [t or "" for _, t in texts] + more + ["".join(r.choice("abcdeinorst"[: r.randint(1, 11)]) for _ in range(r.randint(1, 20))) for _ in range(3000)]


def test_automaton_encodes_as_the_library(odd_texts):
    t, e = library("word_bpe_49k.json"), bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for text, want in zip(odd_texts, t.encode_batch(odd_texts, add_special_tokens=False), strict=True):
        ids, decoded = e.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want.ids, text
        assert decoded == t.decode(want.ids, skip_special_tokens=False) == e.decode(want.ids)


def test_automaton_of_repeated_merges():
    vocab = {"a": 0, "aa": 1, "aaa": 2, "b": 3, "ab": 4, "aab": 5}
    automaton = bpe.Automaton(vocab, [("a", "a"), ("a", "b"), ("aa", "b")], "")

    def merged(word):
        out = list(word)
        for pair in [("a", "a"), ("a", "b"), ("aa", "b")]:
            i = 0
            while i < len(out) - 1:
                if (out[i], out[i + 1]) == pair:
                    out[i : i + 2] = ["".join(pair)]
                i += 1
        return [vocab[x] for x in out]

    for n in range(1, 1 << 9):
        word = bin(n)[2:].replace("0", "a").replace("1", "b")
        assert automaton.encode(word) == merged(word), word


def test_automaton_refuses_merges_out_of_order():
    with pytest.raises(ValueError):
        bpe.Automaton({"a": 0, "b": 1, "c": 2, "ab": 3, "abc": 4}, [("ab", "c"), ("a", "b")], "")


def test_digests(docs, texts):
    t = library("word_bpe_49k.json")
    rows = bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    want = []
    for i, x in texts:
        e = t.encode(x or "", add_special_tokens=False)
        want.append((i, len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_ids_column(docs):
    rows = {r.doc_id: r.ids for r in bpe.encode_ids(docs, public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert rows[6] == library("word_bpe_49k.json").encode("two words", add_special_tokens=False).ids


def test_pieces_encode_as_the_library(odd_texts, monkeypatch):
    monkeypatch.setattr(wavelet.PieceTable, "ENTRIES", 500)  # a full table as well
    t, by = library("byte_bpe_50k.json"), wavelet.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    raw = [x.encode() for x in odd_texts]
    for lo in range(0, len(raw), 2000):
        part = raw[lo : lo + 2000]
        ids, counts = by.encode(np.frombuffer(b"".join(part), np.uint8), np.cumsum([0] + [len(x) for x in part]))
        for got, want in zip(np.split(ids, np.cumsum(counts)[:-1]), t.encode_batch(odd_texts[lo : lo + 2000], add_special_tokens=False), strict=True):
            assert got.tolist() == want.ids


def test_wavelet_matrix():
    r = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 3000):
        a = np.minimum(r.zipf(1.3, n), 50_000).astype(np.uint16)
        s = wavelet.Shard(wavelet.build(a, np.array([5, 9]), np.array([n // 2, n - n // 2])))
        assert (s.tokens() == a).all() and s.ids.tolist() == [5, 9]
        for at in r.integers(0, n, 40) if n else []:
            token = int(a[at])
            before = int((a[:at] == token).sum())
            assert (s.access(int(at)), s.rank(token, int(at)), s.count(token), s.select(token, before)) == (token, before, int((a == token).sum()), at)
        assert s.count(60_000) == 0
    with pytest.raises(IndexError):
        s.access(n)


def test_files_read_back(docs, texts, spark, tmp_path):
    t = library("byte_bpe_50k.json")
    target = str(tmp_path / "shards")
    wavelet.write_shards(docs, target, public_tokenizers.path("byte_bpe_50k.json"), shard_tokens=2000)
    rows = [tuple(r) for r in wavelet.read_digests(spark, target).collect()]
    start, want = 0, []
    for i, x in sorted(texts, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(rows, key=lambda r: r[1]) == want


def test_empty(none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert wavelet.token_files(none, path).count() == 0 and bpe.encode_digests(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_states_beyond_the_table_change_nothing(monkeypatch):
    """No room for another state: transitions are followed, none is kept."""
    automaton = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json")).automaton
    r = random.Random(4)
    words = ["".join(r.choice("abcdeinorst") for _ in range(r.randint(1, 30))) for _ in range(500)]
    states = len(automaton.states)
    monkeypatch.setattr(bpe, "STATES", states)
    got = [automaton.encode(w) for w in words]
    assert len(automaton.states) == states
    monkeypatch.undo()
    assert got == [automaton.encode(w) for w in words] and len(automaton.states) > states


def test_every_prefix_of_a_label_is_compiled():
    a = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json")).automaton
    states = len(a.states)
    for i in list(a.labels)[::50]:
        if i in a.born and a.labels[i].endswith(a.suffix):
            assert a.encode(a.labels[i].removesuffix(a.suffix))
    assert len(a.states) == states


def test_no_rows_and_clashing_names(spark, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.encode_digests(none, path).count() == 0 and bpe.encode_ids(none, path).count() == 0
    df = spark.createDataFrame([(1, "a b", 3, "x"), (None, None, 3, "x")], "doc_id long, text string, n_tokens int, ids_sha256 string")
    assert [r.n_tokens for r in bpe.encode_digests(df, path).collect()] == [2, 0]
