"""Licence scan: matching statistics from a generalised suffix automaton.

The words of all licence templates go into one suffix automaton.  A text's
words are streamed through it, which gives for each place the longest run of
words ending there that occurs in any template, and the template places where
it occurs.  Maximal runs of at least ``MIN_RUN`` words are chained, template by
template, into spans whose matches advance in both the text and the template;
each span that covers enough of its template gives the template's label, as often
as the notice stands in the text (of overlapping ones, the best).  The
short base phrases are templates too: a phrase ends at a place if its state is
the current one, or a suffix link above it, and the run is long enough.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A word
that no template has can't extend a run, so only runs of known words are walked.

Edge cases: null and empty texts give 0 words and null places; there is no limit
on a text's length, and memory grows with one text at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ids_and_texts

#: The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Licence notices, as label -> notice; written down here in short form as they are commonly published.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files, to deal in the software without restriction",
    "apache": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
              "with the license",
    "gpl": "licensed under the GNU General Public License, version 3",
    "lgpl": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "agpl": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
           "hereby granted",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nd": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nc-nd": "Licensed under CC BY-NC-ND 4.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more details.")
_PUBLISHED = (
    "{1} is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free "
    "Software Foundation, either version {2} of the License, or (at your option) any later version.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GPL, _LGPL, _AGPL = ("GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License")
#: Whole notices, as (label, notice), as they are commonly published; a licence may have several.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
            "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
            "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
            "DEALINGS IN THE SOFTWARE."),
    ("bsd", f"{_BSD} {_AS_IS}"),
    ("bsd", f"{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            f"promote products derived from this software without specific prior written permission. {_AS_IS}"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
            "WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
               "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
               "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
               'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
               "the specific language governing permissions and limitations under the License."),
    *((label, f"{_PUBLISHED.format(name, 'This program', version)} {_WARRANTY.format(name)}")
      for label, name, versions in (("gpl", _GPL, "23"), ("lgpl", _LGPL, "23"), ("agpl", _AGPL, "3")) for version in versions),
    *((label, f"under the terms of the {name} as published by the Free Software Foundation")
      for label, name in (("gpl", _GPL), ("lgpl", _LGPL), ("agpl", _AGPL))),
    *((label, f"licensed under the {name}, version {version}")
      for label, name in (("gpl", _GPL), ("lgpl", _LGPL), ("agpl", _AGPL)) for version in "23"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *((label, "Licensed under " + label.upper()) for label in (
        "cc-by", "cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd")),
    *((label, name) for label, name in (
        ("cc-by-nc", "CC BY NC"), ("cc-by-sa", "CC BY SA"), ("cc-by-nd", "CC BY ND"), ("cc-by-nc-sa", "CC BY NC SA"),
        ("cc-by-nc-nd", "CC BY NC ND"), ("cc-by", "Creative Commons Attribution"),
        ("cc-by-nc", "Creative Commons Attribution NonCommercial"), ("cc-by-sa", "Creative Commons Attribution ShareAlike"),
        ("cc-by-nd", "Creative Commons Attribution NoDerivatives"),
        ("cc-by-nc-sa", "Creative Commons Attribution NonCommercial ShareAlike"),
        ("cc-by-nc-nd", "Creative Commons Attribution NonCommercial NoDerivatives"))),
]
#: Words that tell licences with like notices apart: a label's span must hold all of its own, and, of those of a group,
#: no others.
DECIDING = [
    {"gpl": set(), "lgpl": {"lesser"}, "agpl": {"affero"}},
    {"cc-by": set(), "cc-by-nc": {"nc"}, "cc-by-sa": {"sa"}, "cc-by-nd": {"nd"}, "cc-by-nc-sa": {"nc", "sa"},
     "cc-by-nc-nd": {"nc", "nd"}},
]
#: The same words as they are written out.
_SHORT = {"noncommercial": "nc", "sharealike": "sa", "noderivatives": "nd", "noderivs": "nd"}
#: Words after a span in which a deciding word still belongs to it.
_AFTER = 2
#: Words of a run that counts as a long match, words between two chained matches at most, and the share of a template
#: that a chain must cover.
MIN_RUN, MAX_GAP, MIN_COVER = 3, 12, 0.75

_UPPER = {i: i + 32 for i in range(65, 91)}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_UPPER) if not text.isascii() else text.lower())


class Automaton:
    """Suffix automaton of several word sequences, with the places where each state's words end."""

    def __init__(self, sequences: list[list[str]]):
        self.ids: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        self.whole: list[int] = []
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, self.ids.setdefault(word, len(self.ids)), ends)
                ends[last].add((number, place))
            self.whole.append(last)
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            ends[self.link[state]] |= ends[state]  # a state's words end wherever those of a longer one do
        self.ends = [sorted(x) for x in ends]
        chain = {}
        for number, words in enumerate(sequences):  # states may have been split since
            state = 0
            for word in words:
                state = self.next[state][self.ids[word]]
            chain.setdefault(state, []).append((number, len(words)))
        self.ending: list[list[tuple[int, int]]] = []
        for state in range(len(self.next)):
            found, up = [], state
            while up > 0:
                found += chain.get(up, [])
                up = self.link[up]
            self.ending.append(found)

    def _new(self, length: int, ends) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int, ends) -> int:
        clone = self._new(self.length[p] + 1, ends)
        self.next[clone], self.link[clone] = dict(self.next[q]), self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int, ends) -> int:
        q = self.next[last].get(word)
        if q is not None:  # seen in an earlier sequence
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word, ends)
        state = self._new(self.length[last] + 1, ends)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word, ends)
        return state

    def runs(self, state: int, length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """A run's places by sequence, and those of its shorter ends that stand elsewhere too, down to MIN_RUN words."""
        seen: set[tuple[int, int]] = set()
        while state > 0 and length >= MIN_RUN:
            new = [x for x in self.ends[state] if x not in seen]
            if new:
                yield length, new
                seen.update(new)
            state = self.link[state]
            length = self.length[state]

    def statistics(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """For each word, the state and length of the longest known run that ends with it."""
        state = length = 0
        for word in ids:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                state = length = 0
            yield state, length


def decided(label: str, words: list[str], after: list[str]) -> bool:
    """Whether the deciding words of a span, and right after it, are those of its label."""
    for group in DECIDING:
        if label in group:
            every = set().union(*group.values())
            held = [_SHORT.get(w, w) for w in words] + list(takewhile(every.__contains__, (_SHORT.get(w, w) for w in after)))
            return every & set(held) == group[label]
    return True


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, notices=NOTICES):
        self.phrases = list(phrases.items())
        self.templates = [(label, words_of(text)) for label, text in [*templates.items(), *notices]]
        self.automaton = Automaton([words_of(p) for p, _ in self.phrases] + [w for _, w in self.templates])

    def _chains(self, matches: list[tuple[int, int, list[tuple[int, int]]]], text: list[str]) -> list[tuple[str, int, int, float]]:
        """(label, first word, end, share covered) of all chains that cover enough and hold their label's deciding words;
        of overlapping ones, the one that covers most words."""
        base, enough = len(self.phrases), {}
        open_: dict[int, list[tuple[int, int, int, int]]] = {}  # template: (text end, template end, covered, start)
        for start, length, ends in matches:
            for number, place in ends:
                if number < base:
                    continue
                t0, covered, first = place - length + 1, length, start
                near = [x for x in open_.get(number, []) if start - x[0] <= MAX_GAP]
                for end, t_end, had, begun in near:
                    new = length - max(0, end - start, t_end - t0)
                    if end <= start + length and t_end < place + 1 and new > 0 and had + new > covered:
                        covered, first = had + new, begun
                open_[number] = [*near, (start + length, place + 1, covered, first)]
                if covered >= MIN_COVER * len(self.templates[number - base][1]):
                    enough.setdefault(number, []).append((covered, first, start + length))
        found = [(-covered, len(self.templates[number - base][1]), first, end, number)
                 for number, chains in enough.items() for covered, first, end in chains]
        out = []
        taken: list[tuple[int, int]] = []  # in order, apart from each other
        for covered, size, first, end, number in sorted(found):
            i = bisect_left(taken, (first, end))
            if (i == 0 or taken[i - 1][1] <= first) and (i == len(taken) or end <= taken[i][0]):
                label = self.templates[number - base][0]
                if decided(label, text[first:end], text[end:end + _AFTER]):
                    taken.insert(i, (first, end))
                    out.append((label, first, end, min(1.0, -covered / size)))
        return out

    def scan(self, text: str) -> dict:
        """n_words, base places [(start, phrase label)], spans [(label, start, end, share)], score."""
        words, a = words_of(text), self.automaton
        known = a.ids.get
        ids = [known(w, -1) for w in words]
        base, matches = [], []
        i, n = 0, len(ids)
        while i < n:
            if ids[i] < 0:
                i += 1
                continue
            j = i + 1
            while j < n and ids[j] >= 0:
                j += 1
            if j - i > 1:
                before = (0, 0)
                for k, (state, length) in enumerate(a.statistics(ids[i:j]), i):
                    for number, size in a.ending[state]:
                        if size <= length and number < len(self.phrases):
                            base.append((k - size + 1, self.phrases[number][1]))
                    if length <= before[1] and before[1] >= MIN_RUN:  # the run before could not grow
                        matches += [(k - size, size, ends) for size, ends in a.runs(*before)]
                    before = (state, length)
                if before[1] >= MIN_RUN:
                    matches += [(j - size, size, ends) for size, ends in a.runs(*before)]
            i = j
        spans = self._chains(matches, words) if matches else []
        score = max([s[3] for s in spans], default=0.0)
        return {"n_words": n, "base": base, "spans": spans, "score": max(score, 0.5 if base else 0.0)}


SCHEMA = ("id {}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans array<struct<label:string,start:long,end:long,share:double>>")
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                             ("share", pa.float64())]))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        out = []
        for text in batch.column(1):
            x = scanner.scan(text.as_py() or "")
            places, base = [s for s, _ in x["base"]], {label for _, label in x["base"]}
            labels = base | {s[0] for s in x["spans"]}
            out.append((x["n_words"], len(places), min(places, default=None), max(places, default=None),
                        ",".join(sorted(base)), ",".join(sorted(labels)), x["score"],
                        [dict(zip(("label", "start", "end", "share"), s)) for s in sorted(x["spans"])]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))],
            names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, the counts and labels of the base phrases, all labels, and the spans."""
    rows = ids_and_texts(df, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scanned, SCHEMA.format(kind)).withColumnRenamed("id", id_col)
