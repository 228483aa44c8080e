"""Licence scans with a generalised suffix automaton over the words of licence templates.

A text's words stream through the automaton, which gives the matching statistics: at each word, the longest run of
words ending there that occurs in a template.  Runs that end there as a whole base phrase are base places.  Maximal
runs of at least SEED words are chained template by template (both in text and template order, at most GAP words of
the text between them), and a chain that covers the share COVER of a template is a covered span and gives its label.
Names (of licences, in long and short forms, and of their SPDX identifiers) count only whole; one that lies within a longer name gives way to
it.

Only words of some template can take part in a run, so the automaton is walked on those alone; every word is looked at.

Defined cases: null and empty text have no words, no labels and score 0; ties between templates are all reported;
repeated documents are scanned each for itself.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

#: Base phrases: every place counts.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# How licences are named, beside the label of each.
NAMES = (
    ("mit license", "mit"), ("isc license", "isc"), ("zlib license", "zlib"), ("boost software license", "boost"), ("artistic license", "artistic"),
    ("apache license", "apache"), ("apache software license", "apache"), ("bsd license", "bsd"), ("mozilla public license", "mpl"), ("eclipse public license", "epl"),
    ("european union public licence", "eupl"), ("common development and distribution license", "cddl"), ("gnu general public license", "gpl"), ("gnu lesser general public license", "lgpl"),
    ("gnu library general public license", "lgpl"), ("gnu affero general public license", "agpl"), ("gnu free documentation license", "gfdl"), ("server side public license", "sspl"),
    ("creative commons zero", "cc0"), ("creative commons attribution", "cc-by"), ("creative commons attribution sharealike", "cc-by-sa"), ("creative commons attribution noncommercial", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"), ("cc by nc", "cc-by-nc"), ("cc by nd", "cc-by-nd"), ("cc by nc sa", "cc-by-nc-sa"), ("cc by nc nd", "cc-by-nc-nd"), ("open data commons open database license", "odbl"),
    ("mit licensed", "mit"), ("licensed under mit", "mit"), ("license mit", "mit"), ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd"), ("bsd 4 clause", "bsd"), ("2 clause bsd", "bsd"), ("3 clause bsd", "bsd"),
    ("simplified bsd license", "bsd"), ("new bsd license", "bsd"), ("apache 2 0", "apache"), ("apache 2 license", "apache"), ("license apache", "apache"), ("asl 2 0", "apache"), ("mpl 2 0", "mpl"), ("epl 2 0", "epl"),
    ("gplv2", "gpl"), ("gplv3", "gpl"), ("gpl v2", "gpl"), ("gpl v3", "gpl"), ("gpl 2 0", "gpl"), ("gpl 3 0", "gpl"), ("gnu gpl", "gpl"), ("lgplv2", "lgpl"), ("lgplv3", "lgpl"), ("lgpl v2 1", "lgpl"), ("lgpl v3", "lgpl"), ("lgpl 2 1", "lgpl"), ("lgpl 3 0", "lgpl"),
    ("gnu lgpl", "lgpl"), ("agplv3", "agpl"), ("agpl v3", "agpl"), ("agpl 3 0", "agpl"), ("gnu agpl", "agpl"), ("cc0 1 0", "cc0"), ("the unlicense", "unlicense"), ("sil open font license", "ofl"),
)
# SPDX identifiers; in a text they stand behind "SPDX-License-Identifier:".
SPDX = (
    "MIT", "MIT-0", "ISC", "Zlib", "BSL-1.0", "Unlicense", "0BSD", "WTFPL", "Artistic-2.0", "Apache-1.1", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
    "MPL-1.1", "MPL-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "CDDL-1.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.0-only", "LGPL-2.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "SSPL-1.0", "BUSL-1.1", "GFDL-1.3-only", "GFDL-1.3-or-later",
    "CC0-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-NC-ND-4.0", "ODbL-1.0", "OFL-1.1", "PostgreSQL", "Python-2.0",
)
# The notices themselves, found also with small changes.
NOTICES = (
    ("""permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software
    without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons
    to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or
    substantial portions of the software""", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("""permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this
    permission notice appear in all copies""", "isc"),
    ("licensed under the apache license version 2 0", "apache"),
    ("""licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http
    www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
    without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license""", "apache"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("""redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce
    the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution""", "bsd"),
    ("""neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior
    written permission""", "bsd"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("""this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
    either version 3 of the license or at your option any later version""", "gpl"),
    ("""this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software
    foundation either version 2 1 of the license or at your option any later version""", "lgpl"),
    ("""this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software
    foundation either version 3 of the license or at your option any later version""", "agpl"),
    ("""the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular
    purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or
    otherwise arising from out of or in connection with the software or the use or other dealings in the software""", "mit"),
    ("""this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of
    merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental
    special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption
    however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this
    software even if advised of the possibility of such damage""", "bsd"),
    ("""the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no
    event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an
    action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software""", "isc"),
    ("""permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the
    software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software""", "boost"),
    ("""this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
    either version 2 of the license or at your option any later version""", "gpl"),
    ("""this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular
    purpose see the gnu general public license for more details""", "gpl"),
    ("you should have received a copy of the gnu general public license along with this program if not see https www gnu org licenses", "gpl"),
    ("""this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular
    purpose see the gnu lesser general public license for more details""", "lgpl"),
    ("if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", "mpl"),
    ("to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights", "cc0"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "epl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("""this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source
    code form or as a compiled binary for any purpose commercial or non commercial and by any means""", "unlicense"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("to the extent possible under law the author has waived all copyright", "cc0"),
    ("""this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
    permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely""", "zlib"),
)
SEED, GAP, COVER = 3, 4, 0.8
words_of = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def words(text: str | None) -> list[bytes]:
    """The words, A-Z in lower case: runs of ASCII letters and digits and of all that isn't ASCII."""
    return words_of((text or "").encode("utf-8", "replace").lower())


class Automaton:
    """The suffix automaton of several word sequences, with the templates' places in its states."""

    def __init__(self, templates: list[tuple[list[bytes], str]]):
        self.templates = templates
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        for sequence, _ in templates:
            last = 0
            for word in sequence:
                last = self._extended(last, word)
        self.vocabulary = frozenset(w for sequence, _ in templates for w in sequence)
        #: (template, words up to the run's end) of every place where the state's runs end; and the whole templates
        #: that end wherever a run of the state ends, if the run is as long.
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for t, (sequence, _) in enumerate(templates):
            state = 0
            for n, word in enumerate(sequence, 1):
                state = up = self.next[state][word]
                while up > 0:
                    self.places[up].append((t, n))
                    up = self.link[up]
        ends: dict[int, list[int]] = {}
        for t, (sequence, _) in enumerate(templates):
            state = 0
            for word in sequence:
                state = self.next[state][word]
            ends.setdefault(state, []).append(t)
        self.whole: list[list[int]] = []
        for state in range(len(self.next)):
            found, up = [], state
            while up > 0:
                found += ends.get(up, [])
                up = self.link[up]
            self.whole.append(found)

    def _new(self, following: dict[bytes, int], link: int, size: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state of the longest run of ``state`` followed by ``word``, taken apart from longer runs if need be."""
        target = self.next[state][word]
        if self.size[target] == self.size[state] + 1:
            return target
        copy = self._new(dict(self.next[target]), self.link[target], self.size[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extended(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        fresh, at = self._new({}, 0, self.size[last] + 1), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = fresh
            at = self.link[at]
        if at >= 0:
            self.link[fresh] = self._split(at, word)
        return fresh

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """The longest run after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.size[state]
        return (self.next[state][word], length + 1) if word in self.next[state] else (0, 0)


def _templates(base, names, spdx, notices) -> list[tuple[list[bytes], str]]:
    identifiers = [(f"spdx license identifier {name}", name.lower()) for name in spdx]
    return [(words(phrase), label) for phrase, label in (*base, *names, *identifiers, *notices)]


class Scanner:
    """Base phrases, names and SPDX identifiers count whole, notices from the share COVER on."""

    def __init__(self, base=BASE, notices=NOTICES, names=NAMES, spdx=SPDX):
        self.base, self.exact = len(base), len(base) + len(names) + len(spdx)
        self.automaton = Automaton(_templates(base, names, spdx, notices))

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, list[str], list[str], float, list[dict]]:
        """Words, base places, first and last start, base labels, labels, score and covered spans."""
        every, automaton = words(text), self.automaton
        vocabulary, step, sizes = automaton.vocabulary, automaton.step, [len(t) for t, _ in automaton.templates]
        starts, base_labels, named = [], set(), {}
        runs: list[tuple[int, int, int]] = []  # (end, length, state) of maximal runs
        state = length = 0
        previous = -2
        for i in [i for i, w in enumerate(every) if w in vocabulary]:
            if i != previous + 1 and length:
                if length >= SEED:
                    runs.append((previous + 1, length, state))
                state = length = 0
            before = (previous + 1, length, state)
            state, length = step(state, length, every[i])
            if before[1] >= SEED and length <= before[1]:
                runs.append(before)
            previous = i
            for t in automaton.whole[state]:
                if length >= sizes[t] and t < self.exact:
                    start, label = i + 1 - sizes[t], automaton.templates[t][1]
                    if t < self.base:
                        starts.append(start)
                        base_labels.add(label)
                    else:  # ends rise, so the last name that begins here is the longest
                        named[start] = {"label": label, "start": start, "end": i + 1, "cover": 1.0}
        if length >= SEED:
            runs.append((previous + 1, length, state))
        chained = self._chained(runs)
        outer, reach = [], 0
        for _, span in sorted(named.items()):
            if span["end"] > reach:
                outer.append(span)
                reach = span["end"]
        spans = [s for s in chained if s["cover"] >= COVER] + outer
        labels = base_labels | {s["label"] for s in spans}
        score = max([1.0 if starts else 0.0, *(s["cover"] for s in (*chained, *spans))])
        return len(every), len(starts), min(starts, default=None), max(starts, default=None), sorted(base_labels), sorted(labels), score, spans

    def _chained(self, runs: list[tuple[int, int, int]]) -> list[dict]:
        """Chains of runs, the longest cover for each place and template: label, start, end (words of the text), cover."""
        open_chains: dict[int, list[dict]] = {}
        done = []
        for end, length, state in runs:
            for t, n in self.automaton.places[state]:
                if t < self.exact:
                    continue
                size = len(self.automaton.templates[t][0])
                best = None
                for chain in open_chains.get(t, []):
                    shift = max(0, chain["end"] - (end - length), chain["at"] - (n - length))  # words that both runs hold
                    if end - length - chain["end"] <= GAP and shift < min(length, chain["words"]) and (best is None or chain["words"] - shift > best[0]["words"] - best[1]):
                        best = (chain, shift)
                if best:
                    chain = {**best[0], "end": end, "at": n, "words": best[0]["words"] + length - best[1]}
                else:
                    chain = {"label": self.automaton.templates[t][1], "start": end - length, "end": end, "at": n, "words": length, "size": size}
                open_chains[t] = [c for c in open_chains.get(t, []) if end - c["end"] <= GAP + c["size"]] + [chain]
                done.append(chain)
        out: dict[tuple[str, int], dict] = {}
        for chain in done:
            span = {"label": chain["label"], "start": chain["start"], "end": chain["end"], "cover": min(1.0, chain["words"] / chain["size"])}
            key = (span["label"], span["start"])
            if key not in out or span["cover"] > out[key]["cover"]:
                out[key] = span
        return list(out.values())


def scan_documents(docs: DataFrame, base=BASE, notices=NOTICES, names=NAMES, spdx=SPDX) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the covered spans.

    Templates are (text, label) pairs, ``spdx`` bare identifiers; they are a fixed set that every worker holds.
    """
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span))

    def make():
        scanner = Scanner(base, notices, names, spdx)

        def work(batch: pa.RecordBatch) -> list:
            out = [scanner.scan(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            out = [(*x[:4], ",".join(x[4]), ",".join(x[5]), *x[6:]) for x in out]
            return [pa.array([x[i] for x in out], t) for i, t in enumerate(types)]

        return work

    added = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,cover:double>>"
    return map_texts(docs.select("doc_id", "text"), make, ["doc_id"], added)
