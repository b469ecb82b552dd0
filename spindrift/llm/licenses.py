"""Licence scan: a generalised suffix automaton of licence tokens, matching statistics, chained spans.

The automaton is built once from the token sequences of all templates. Each text
streams its tokens through it; the matching statistic at a token is the length
of the longest template substring that ends there. Maximal matches of at least
MIN_MATCH tokens are chained for each template (in order, gaps of at most
MAX_GAP words), and a chain that covers enough of its template gives a span and
the template's label. Tokens that no MIN_MATCH-gram of a template touches can't
be part of such a match, so the automaton skips them.

Templates of at most MIN_MATCH words have an automaton of their own: there
pieces of any length chain, across a name and a year, and a chain counts if one
of its pieces has SHORT_MATCH words.

Templates are a parameter; TEMPLATES has notices and whole texts of public licences.

Defined results: a null or empty text has no words; ties between chains go to
the earliest; rows are scanned each for itself, whatever their ids; an empty table
gives no rows; texts have any length and are never cut; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import prepare

MIN_MATCH = 4
SHORT_MATCH = 3
MAX_GAP = 12
#: Share of a template that a chain covers.
COVERED = 0.6

#: Phrases of the base labels. Fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices and texts of public licences, (label, text). Fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("all-rights-reserved", "all rights reserved"),
    ("all-rights-reserved", "copyright all rights reserved"),
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "released under the bsd 3 clause license"),
    ("cc-by", "licensed under cc by 4.0"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


class SuffixAutomaton:
    """Of several sequences of integers; each state knows where its strings end: (sequence, end) pairs."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c)
                self.ends[last].add((k, i))
        for v in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            self.ends[self.link[v]] |= self.ends[v]
        self.ends[0] = set()

    def _state(self, length: int, arcs: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(arcs)
        self.link.append(link)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier sequence has this string already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        """Matching statistic after one more token."""
        while state and c not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if c in self.next[state]:
            return self.next[state][c], matched + 1
        return 0, 0


def tokens_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return W.split(data, np.array([0, len(data)]), W.ALNUM, lower=True).hash


@lru_cache(4)
def automaton(short: bool, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> tuple[SuffixAutomaton, list[str], list[int], np.ndarray, np.ndarray]:
    """(automaton, labels, template lengths, sorted vocabulary, sorted grams that a text must touch) of the templates of at most MIN_MATCH words, or of the others."""
    both = [(label, tokens_of(t)) for label, t in templates]
    chosen = [(label, s) for label, s in both if (len(s) <= MIN_MATCH) == short]
    seqs = [s for _, s in chosen]
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *seqs]))
    sam = SuffixAutomaton([[int(x) for x in np.searchsorted(vocabulary, s)] for s in seqs])
    return sam, [label for label, _ in chosen], [len(s) for s in seqs], vocabulary, np.unique(np.concatenate([np.zeros(0, np.uint64), *(W.grams(s, SHORT_MATCH if short else MIN_MATCH) for s in seqs)]))


def maximal_matches(sam: SuffixAutomaton, tokens: list[int], base: int = 0, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """(state, length, end) of the matches of `least` or more tokens that can't be extended to the right."""
    out, state, matched = [], 0, 0
    for i, c in enumerate(tokens):
        before = (state, matched, base + i - 1)
        state, matched = sam.step(state, matched, c)
        if before[1] >= least and matched != before[1] + 1:
            out.append(before)
    if matched >= least:
        out.append((state, matched, base + len(tokens) - 1))
    return out


def chained(sam: SuffixAutomaton, lengths: list[int], matches: list[tuple[int, int, int]], least: int = 0) -> list[tuple[int, int, int, float]]:
    """(template, first word, last word, covered share) of the chains that cover enough and have a piece of `least` words."""
    by: dict[int, list[tuple[int, int, int]]] = {}
    for state, n, end in matches:
        for k, e in sam.ends[state]:
            by.setdefault(k, []).append((end - n + 1, e - n + 1, n))
    spans = []
    for k, found in sorted(by.items()):
        found.sort()
        open_: list[list[int]] = []  # chains: first word, next word, next template position, covered, longest piece
        done = []
        for at, pos, n in found:
            while open_ and at - open_[0][1] > MAX_GAP:
                done.append(open_.pop(0))
            best = max((c for c in open_ if c[1] <= at and c[2] <= pos), key=lambda c: c[3], default=None)
            if best:
                best[1:] = [at + n, pos + n, best[3] + n, max(best[4], n)]
                open_.sort(key=lambda c: c[1])
            else:
                open_.append([at, at + n, pos + n, n, n])
        for first, after, _, covered, longest in sorted(done + open_, key=lambda c: (-c[3], c[0])):
            if covered >= COVERED * lengths[k] and longest >= least:
                spans.append((k, first, after - 1, min(1.0, covered / lengths[k])))
    return spans


_RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, first_word: long, last_word: long, covered: double>>"
)


def _spans(w: W.Words, doc: np.ndarray, short: bool, templates: tuple[tuple[str, str], ...]) -> dict[int, list[tuple[str, int, int, float]]]:
    """(label, first word, last word, covered share) by document."""
    sam, names, lengths, vocabulary, known = automaton(short, templates)
    if not len(known):
        return {}
    # a short template's pieces lie up to MAX_GAP words beside the one that is looked for
    k, least, beside = (SHORT_MATCH, 1, MAX_GAP + 1) if short else (MIN_MATCH, MIN_MATCH, 0)
    g = W.grams(w.hash, k)
    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
    hits = np.flatnonzero(known[at] == g)
    hits = hits[doc[hits] == doc[hits + k - 1]] if len(hits) else hits
    found: dict[int, list] = {}
    if len(hits):
        cuts = np.flatnonzero((np.diff(hits) > k + 2 * beside) | (np.diff(doc[hits]) != 0)) + 1
        for run in np.split(hits, cuts):
            d = int(doc[run[0]])
            lo, hi = max(int(run[0]) - beside, int(w.first[d])), min(int(run[-1]) + k + beside, int(w.first[d + 1]))
            h = w.hash[lo:hi]
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            tokens = np.where(vocabulary[at] == h, at, -1).tolist()
            found.setdefault(d, []).extend(maximal_matches(sam, tokens, lo - int(w.first[d]), least))
    return {d: [(names[t], a, b, c) for t, a, b, c in chained(sam, lengths, m, k if short else 0)] for d, m in found.items()}


def _scan(templates: tuple[tuple[str, str], ...]):
    def scan(batches):
        phrases = [(tokens_of(p), label) for p, label in PHRASES.items()]
        for rows, data, offsets in W.chunks(batches):
            w = W.split(data, offsets, W.ALNUM, lower=True)
            docs, total = rows.num_rows, len(w.hash)
            doc = w.doc()
            n_base = np.zeros(docs, np.int64)
            first, last = np.full(docs, -1), np.full(docs, -1)
            base: dict[int, set[str]] = {}
            for p, label in phrases:
                n = max(0, total - len(p) + 1)
                hit = np.ones(n, bool)
                for j, x in enumerate(p):
                    hit &= w.hash[j : j + n] == x
                at = np.flatnonzero(hit)
                at = at[doc[at] == doc[at + len(p) - 1]] if len(at) else at
                for i in at:
                    d, x = int(doc[i]), int(i - w.first[doc[i]])
                    n_base[d] += 1
                    first[d] = x if first[d] < 0 else min(first[d], x)
                    last[d] = max(last[d], x)
                    base.setdefault(d, set()).add(label)
            spans = _spans(w, doc, False, templates)
            for d, more in _spans(w, doc, True, templates).items():
                spans.setdefault(d, []).extend(more)
            labels = [",".join(sorted(base.get(d, set()) | {s[0] for s in spans.get(d, [])})) for d in range(docs)]
            score = [max([1.0 if d in base else 0.0, *(s[3] for s in spans.get(d, []))]) for d in range(docs)]
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), pa.array(w.counts()), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                    pa.array([",".join(sorted(base.get(d, ()))) for d in range(docs)]), pa.array(labels), pa.array(score),
                    pa.array([[dict(zip(("label", "first_word", "last_word", "covered"), s, strict=True)) for s in spans.get(d, [])] for d in range(docs)],
                             pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]))),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    return scan


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of each row; templates are (label, text)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan(tuple(map(tuple, templates))), _RESULT)
