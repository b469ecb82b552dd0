"""Byte-pair encoding and decoding by a tokenization automaton.

The token automaton has arcs labelled with tokens, and its paths are exactly the
proper tokenizations. It starts as one state that every symbol leads back to;
then each merge (a, b) -> c, in order, applies a gadget wherever an arc a leads
to a state with an arc b: the state behind a loses its arc b, and an arc c enters
a copy of the state behind b. The state behind a token so depends on that token
alone, and has_arc() tells its arcs from what the gadgets did: `copied` says of
which state a state is a copy and since which merge, `entered` from which arc an
arc stems, and `removed` which arcs a merge took away.

It is then compiled into a deterministic automaton over the letters of words. A
state of that stands for a read prefix: the last token of the prefix's own
tokenization, and the arcs of the token automaton that are partly read, each as
the token it leaves from and a node of the tree of all labels. One letter moves
every partly read arc one node on; the one that ends there and exists is the last
token of the longer prefix. The table of transitions (state, letter) -> state is
built when the file is loaded, for all prefixes of all labels; a transition that
no label needs is compiled when a word first needs it, up to STATES states, and
beyond that only followed.

A word is encoded letter by letter through the table. The last state names the
last token and its length, the state that many letters before names the token
before, and so on. Decoding emits the labels of the arcs.

Only words absent from a bounded table are run through the automaton. The table
has no effect on results.

Defined results: null and empty texts have no tokens; texts have any length and
are never cut; ids may be null or repeat, each row is encoded for itself; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import prepare

#: Entries of the tables of chunks and of words that a worker keeps, and states of the compiled automaton.
CHUNKS, WORDS, STATES = 120_000, 300_000, 400_000
_END = "\x00"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 letters for themselves, the others in order from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = [""] * 256, 0x100
    for b in range(256):
        if b in own:
            letters[b] = chr(b)
        else:
            letters[b] = chr(extra)
            extra += 1
    return letters


class Automaton:
    """Compiled from a vocabulary, its merges in order, and the suffix that marks a word's end."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        self.labels = {i: t for t, i in vocab.items()}
        self.removed: dict[int, int] = {}  # (a, b) -> merge that takes arc b from the state behind a
        self.copied: dict[int, tuple[int, int]] = {}  # c -> (b, merge)
        self.entered: dict[int, tuple[int, int]] = {}  # c -> (a, merge)
        born: dict[int, int] = {}
        used: set[int] = set()
        for at, (left, right) in enumerate(merges):
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            used |= {a, b}
            if c in born or c in used:
                raise ValueError(f"merge {at} doesn't follow the merges it needs")
            self.removed[a << 32 | b] = at
            self.copied[c], self.entered[c] = (b, at), (a, at)
            born[c] = at
        self.born = born
        words = {}
        for token, i in vocab.items():
            word = token[: -len(suffix)] + _END if suffix and token.endswith(suffix) and token != suffix else token
            if i in born or len(word) == 1 or (len(word) == 2 and word[1] == _END):
                words[word] = i
        self._compile(words)

    def has_arc(self, a: int, b: int) -> bool:
        """Whether the state behind token a has an arc b when all gadgets are applied."""
        upto = len(self.born)  # merges before this one count
        while True:
            if self.removed.get(a << 32 | b, upto) < upto:
                return False
            born_a, born_b = self.born.get(a, -1), self.born.get(b, -1)
            if born_a < 0 and born_b < 0:
                return True
            if born_a > born_b:  # the state is a copy made by merge born_a
                a, upto = self.copied[a]
            else:  # the arc was made from another by merge born_b; where that merge applies twice in a row, the left one goes first
                b, at = self.entered[b]
                upto = at + 1

    def _compile(self, words: dict[str, int]) -> None:
        """The tree of all labels, and the transitions for all of their prefixes."""
        self.tree: dict[tuple[int, str], int] = {}
        self.named = [-1]  # of each node: the token that ends there
        for word, i in words.items():
            node = 0
            for letter in word:
                step = self.tree.get((node, letter))
                if step is None:
                    step = self.tree[node, letter] = len(self.named)
                    self.named.append(-1)
                node = step
            self.named[node] = i
        # a state: its last token, that token's letters, and the partly read arcs, the earliest first, as (token that it leaves from, its letters, node)
        self.states: list[tuple] = [(-1, 0, ((-1, 0, 0),))]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.moves: list[dict[str, int]] = [{}]
        seen = {0: 0}  # node of the tree -> state
        for (node, letter), step in self.tree.items():
            seen[step] = self._compiled(seen[node], letter)

    def _moved(self, state: tuple, letter: str) -> tuple:
        """The state that a letter leads to."""
        token, size, going = -1, 0, []
        for before, read, node in state[2]:
            step = self.tree.get((node, letter))
            if step is None:
                continue
            going.append((before, read + 1, step))
            arc = self.named[step]
            if token < 0 <= arc and (before < 0 or self.has_arc(before, arc)):
                token, size = arc, read + 1
        if token >= 0:
            going.append((token, 0, 0))
        return token, size, tuple(going)

    def _compiled(self, number: int, letter: str) -> int:
        """The number of the state that a letter leads to from a numbered one; -1 if there is no room for it."""
        found = self._moved(self.states[number], letter)
        to = self.numbers.get(found)
        if to is None:
            if len(self.states) >= STATES:
                return -1
            to = self.numbers[found] = len(self.states)
            self.states.append(found)
            self.moves.append({})
        self.moves[number][letter] = to
        return to

    def _path(self, letters: str) -> list[tuple]:
        """The states behind each prefix."""
        at, path, moves, states = 0, [], self.moves, self.states
        for k, letter in enumerate(letters):
            to = moves[at].get(letter)
            if to is None:
                to = self._compiled(at, letter)
                if to < 0:
                    state = states[at]
                    for rest in letters[k:]:
                        state = self._moved(state, rest)
                        path.append(state)
                    return path
            path.append(states[to])
            at = to
        return path

    def encode(self, letters: str) -> list[int]:
        """Tokens of a word in byte letters."""
        path = self._path(letters + _END if self.suffix else letters)
        out, n = [], len(path)
        while n:
            token, size, _ = path[n - 1]
            if token < 0:
                raise ValueError("a symbol is not in the vocabulary")
            out.append(token)
            n -= size
        return out[::-1]


class Encoder:
    """Normalises, pre-splits, and encodes as the tokenizer file says; texts of the kind that word_bpe_49k.json describes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = self.automaton.labels | {i: t for t, i in self.special.items()}
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.letters = byte_letters()
        self.words: dict[str, tuple[bytes, str]] = {}
        encoder = self

        class Chunks(dict):
            def __missing__(self, chunk):
                parts = encoder._parts(chunk)
                found = parts[0] if len(parts) == 1 else (b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts]))
                if len(self) < CHUNKS and len(chunk) < 64:
                    self[chunk] = found
                return found

        self.chunks = Chunks()

    def _emitted(self, ids: list[int]) -> tuple[bytes, str]:
        return b"".join([i.to_bytes(4, "little") for i in ids]), " ".join([self.labels[i] for i in ids])

    def _parts(self, chunk: str) -> list[tuple[bytes, str]]:
        """Ids and labels of each word of a chunk."""
        out = []
        for part in self.marks.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(self._emitted([self.special[part]]))
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                part = "".join([c.lower() for c in part])  # letter by letter: a final sigma is none
            else:
                part = part.lower()
            for piece in self.pieces.findall(part):
                found = self.words.get(piece)
                if found is None:
                    letters = piece if piece.isascii() and piece.isprintable() else "".join([self.letters[b] for b in piece.encode()])
                    found = self._emitted(self.automaton.encode(letters))
                    if len(self.words) < WORDS and len(piece) < 64:
                        self.words[piece] = found
                out.append(found)
        return out

    def encode(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text)."""
        # str.split also cuts at U+001C to U+001F, which are no white space here
        chunks = text.split() if not regex.search("[\x1c-\x1f]", text) else [c for c in regex.split(r"\p{White_Space}+", text) if c]
        found = [self.chunks[c] for c in chunks]
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]])

    def decode(self, ids: Iterable[int]) -> str:
        """Labels of the arcs, special ones included, as the file has no decoder: with a space between."""
        return " ".join([self.labels[i] for i in ids])


def encoder(path: str) -> Encoder:
    return W.keep(f"encoder {path}", lambda: Encoder(path))


def _encode(path: str):
    def encode(batches):
        e = encoder(path)
        for rows, data, offsets in W.chunks(batches, keeps=True):
            raw = data.tobytes()
            out = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                ids, text = e.encode(raw[a:b].decode("utf-8", "replace"))
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
            n, i, t = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(i), pa.array(t)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encode


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text of each row. The file at `path` must be on every executor."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encode(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(path: str):
    def ids(batches):
        e = encoder(path)
        for rows, data, offsets in W.chunks(batches, keeps=True):
            raw = data.tobytes()
            found = [e.encode(raw[a:b].decode("utf-8", "replace"))[0] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([[int.from_bytes(x[k : k + 4], "little") for k in range(0, len(x), 4)] for x in found], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return ids


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of each row."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_ids(path), "doc_id long, ids array<int>")
