"""License texts in documents, by winnowed fingerprints and banded alignment.

Templates and texts are sequences of words (letters and digits, lower case). The hashes of all
runs of `GRAM` words of a template are winnowed: of every `WINDOW` neighbouring ones the
smallest is kept, and all of a template of at most `SHORT` words. The kept ones are an inverted index from hash to places in templates; it is
as large as the list of templates, not as the data. Every run of a document is looked up, so a
passage that shares `GRAM + WINDOW - 1` words in a row with a template is a candidate for it.
Candidates that follow each other in text and template are chained, with the score that an alignment
through them would have; each chain is a place where the template may lie. Along it the best local
alignment (matches +2, others -1) is sought in a band: in each row only the columns within `BAND`
words of the diagonals of the chain's neighbouring candidates. That gives the matched words, their
share of the template and the span in the text; it is a match if the share is `coverage` at least
and the template's names are there. Names are the words by which a template differs from its
variants (license, version): they must stand in the match without insertions, so that a license
without a template is not reported under the name of its nearest variant. A notice that is repeated
has a chain, and so a report, for each time it stands there. A chain around which there are too few
of the template's words for `coverage`, in whatever order, is not aligned. Of reports that overlap,
a longer match hides a shorter one, and of equal ones the better covered hides the other; so
variants that are in the table are told apart. The work grows with the words of the text times the
width of the band.

The table has short notices, in `TEMPLATES`, and the whole texts in the folder `licenses`; another
can be given. Only the driver reads the folder.

Rows: one per match, with the id of its document; repeated rows report repeatedly. NULL and
empty texts match nothing. Spans are in code points of the whole text, end exclusive. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tokens import by_bytes
from orderlake.llm.words import Words

GRAM, WINDOW = 3, 2
SHORT = 20  # words of templates of which every run is kept
BAND = 12  # words to both sides of the candidates' diagonals
COVERAGE = 0.8  # least share of a template's words, if no other is asked for
LINKED = 128  # candidates before one that are tried as its predecessor in a chain
BITS = 20  # of a length in words: templates of up to 100,000 words
_WORD = re.compile(r"[^\W_]+")

# Short notices by which texts state their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "BSD-clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
}

TEMPLATES |= {
    "MIT-licensed": "Licensed under the MIT License",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "CC0-1.0": "Licensed under CC0 1.0 Universal",
}
_NOTICE = TEMPLATES["GPL-notice"]
TEMPLATES |= {
    "GPL-2.0-notice": _NOTICE.replace("version 3", "version 2"),
    "LGPL-2.1-notice": _NOTICE.replace("General", "Lesser General").replace("version 3", "version 2.1"),
    "LGPL-3.0-notice": _NOTICE.replace("General", "Lesser General"),
    "AGPL-3.0-notice": _NOTICE.replace("General", "Affero General"),
}
# Words that must stand in a match without insertions.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0",),
    "Apache-2.0-notice": ("Apache License, Version 2.0",),
    "MIT": ("MIT License",),
    "MIT-licensed": ("MIT License",),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "CC0-1.0": ("CC0 1.0",),
    "MPL-2.0": ("Mozilla Public License, v. 2.0",),
    "GPL-3-text": ("refers to version 3 of the GNU General Public License",),
}
for _name, _title, _version in (
    ("GPL-2.0", "GNU General Public", "2"),
    ("GPL-3.0", "GNU General Public", "3"),
    ("LGPL-2.1", "GNU Lesser General Public", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public", "3"),
    ("AGPL-3.0", "GNU Affero General Public", "3"),
):
    NAMES[_name] = (f"{_title} License, version {_version}",)
    NAMES["GPL-notice" if _name == "GPL-3.0" else f"{_name}-notice"] = (" ".join(_title.split()[:2]), f"{_version} of the License")
for _kind, _title in {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _version in ("3.0", "4.0"):
        _name = f"CC-{_kind}-{_version}"
        TEMPLATES[_name] = f"Licensed under CC {_kind} {_version}"
        NAMES[_name] = (f"CC {_kind} {_version}",)
        TEMPLATES[f"{_name}-title"] = f"Creative Commons {_title} {_version}"
        NAMES[f"{_name}-title"] = (f"Commons {_title} {_version}",)


def all_templates() -> dict[str, str]:
    """`TEMPLATES`, and the whole texts as `<file>-text`."""
    files = sorted((Path(__file__).parent / "licenses").iterdir())
    return TEMPLATES | {f"{f.name}-text" if f.name != "MIT" else "MIT-whole-text": f.read_text("utf-8") for f in files}


RESULT = (
    "doc_id long, template string, matched_words int, template_words int, coverage double, "
    "span_start int, span_stop int"
)


@dataclass(frozen=True)
class Match:
    template: str
    words: int
    of: int
    start: int
    stop: int


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class TemplateIndex:
    """Winnowed fingerprints of templates; words are numbered, others are 0."""

    def __init__(
        self, templates: dict[str, str], required: dict[str, tuple[str, ...]] = NAMES, coverage: float = COVERAGE
    ):
        self.coverage = coverage
        templates = {n: t for n, t in templates.items() if words_of(t)}
        self.names = list(templates)
        self.hasher = Words(underscore=False)
        hashes = [self.hasher.of(t)[2] for t in templates.values()]
        self.vocabulary = np.unique(np.concatenate(hashes))
        self.words = [self.numbers(h).tolist() for h in hashes]
        # Names that a template itself lacks belong to another one of its title.
        phrases = [[self.numbers(self.hasher.of(p)[2]).tolist() for p in required.get(n, ())] for n in self.names]
        self.required = [[p for p in ps if within(p, words)] for ps, words in zip(phrases, self.words)]
        self.lengths = [len(w) for w in self.words]
        self.counts = [np.unique(np.array(w, np.int64), return_counts=True) for w in self.words]
        self.all_words = np.concatenate([words for words, _ in self.counts])
        self.all_counts = np.concatenate([counts for _, counts in self.counts])
        self.begins = np.cumsum([0, *(len(words) for words, _ in self.counts)])[:-1]
        self.places: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for t, words in enumerate(self.words):
            runs = self.runs(np.array(words, np.int64))
            hashes = (runs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(7)
            kept = set(range(len(runs))) if len(words) <= SHORT else set()
            for i in range(max(1, len(runs) - WINDOW + 1)) if len(runs) else ():
                kept.add(i + int(np.argmin(hashes[i : i + WINDOW])))
            for i in sorted(kept):
                self.places[int(runs[i])][t].append(i)
        self.known = np.array(sorted(self.places), np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers from 1 of words that are in a template, 0 for others."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int64)

    def runs(self, numbers: np.ndarray) -> np.ndarray:
        """One number for every run of `GRAM` words; 0 where a word is in no template."""
        n = len(numbers) - GRAM + 1
        if n < 1:
            return np.zeros(0, np.int64)
        base, out, none = len(self.vocabulary) + 1, np.zeros(n, np.int64), np.zeros(n, bool)
        for i in range(GRAM):
            out = out * base + numbers[i : i + n]
            none |= numbers[i : i + n] == 0
        out[none] = 0
        return out

    def scan(self, text: str) -> list[Match]:
        starts, ends, hashes, _ = self.hasher.of(text)
        numbers = self.numbers(hashes)
        runs = self.runs(numbers)
        if not len(self.known):
            return []
        at = np.minimum(np.searchsorted(self.known, runs), len(self.known) - 1)
        hits = np.flatnonzero(self.known[at] == runs)
        if not len(hits):
            return []
        possible = self.possible(numbers)
        found = runs[hits].tolist()
        aligned = []
        for template in sorted({t for run in set(found) for t in self.places[run]}):
            if possible[template]:
                at = [(p, q) for p, run in zip(hits.tolist(), found) for q in self.places[run].get(template, ())]
                aligned += self._matches(template, numbers, np.array(at, np.int64))
        spans = list(zip(starts.tolist(), ends.tolist()))
        if len(text.lower()) != len(text):  # a letter whose lower case has another length moves the rest
            spans = word_spans(text)
        matches = [
            Match(self.names[t], n, len(self.words[t]), spans[a][0], spans[b][1]) for t, n, a, b in aligned
        ]
        return longest_apart(matches)

    def possible(self, numbers: np.ndarray) -> np.ndarray:
        """For each template whether enough of its words are there, in any order."""
        there = np.bincount(numbers, minlength=len(self.vocabulary) + 1)[self.all_words]
        return np.add.reduceat(np.minimum(there, self.all_counts), self.begins) >= self.coverage * np.array(self.lengths)

    def _possible(self, template: int, numbers: np.ndarray) -> bool:
        least = self.coverage * self.lengths[template]
        if len(numbers) < least:
            return False
        words, counts = self.counts[template]
        there = np.bincount(numbers, minlength=len(self.vocabulary) + 1)[words]
        return np.minimum(there, counts).sum() >= least

    def _matches(self, template: int, numbers: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """All matches of a template, from its candidates (places in text and template)."""
        words, length = np.array(self.words[template], np.int64), self.lengths[template]
        taken = np.zeros(len(numbers), np.int8)  # 1: in a match, 2: aligned in vain
        out = []
        for chain in chains(at[:, 0], at[:, 1]):
            chain = chain[taken[at[chain, 0]] == 0]
            if not len(chain):
                continue
            p, q = at[chain, 0], at[chain, 1]
            first, last = int(p[0] - q[0]), int(p[-1] + length - q[-1])
            start, stop = max(0, first - BAND), min(len(numbers), last + BAND)
            # Not into what is matched already.
            before, after = np.flatnonzero(taken[start : p[0]] == 1), np.flatnonzero(taken[p[-1] : stop] == 1)
            start = start + int(before[-1]) + 1 if len(before) else start
            stop = int(p[-1]) + int(after[0]) if len(after) else stop
            n = 0
            if self._possible(template, numbers[start:stop]):
                n, a, b = align(numbers[start:stop], words, *band(p - start, q, stop - start, length))
            if n < self.coverage * length:
                core = taken[max(0, first, start) : min(last, stop)]
                core[core == 0] = 2
                continue
            taken[start + a : start + b + 1] = 1
            span = numbers[start + a : start + b + 1].tolist()
            if all(within(phrase, span) for phrase in self.required[template]):
                out.append((template, n, start + a, start + b))
        return out


def chains(p: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Candidates (places `p` in a text, `q` in a template; sorted) as chains, the best first; in a
    chain both places grow. A link adds the words that its second candidate matches anew, less
    what lies between the two in the one or the other."""
    n = len(p)
    score, back = np.full(n, 2 * GRAM, np.int64), np.full(n, -1, np.int64)
    for i in range(1, n):
        j = max(0, i - LINKED)
        dp, dq = p[i] - p[j:i], q[i] - q[j:i]
        new = np.minimum(np.minimum(dp, dq), GRAM)
        linked = np.where(new > 0, score[j:i] + 3 * new - np.maximum(dp, dq), 0)
        best = int(linked.argmax())
        if linked[best] > score[i]:
            score[i], back[i] = linked[best], j + best
    used, out = np.zeros(n, bool), []
    for i in np.argsort(-score, kind="stable").tolist():
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = int(back[i])
        if chain:
            out.append(np.array(chain[::-1]))
    return out


def band(p: np.ndarray, q: np.ndarray, rows: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the columns within `BAND` of the diagonals of the candidates around it."""
    diagonal, row = p - q, np.arange(rows)
    here = np.searchsorted(p, row, side="right") - 1
    one, other = diagonal[np.maximum(here, 0)], diagonal[np.minimum(here + 1, len(p) - 1)]
    low = np.clip(row - np.maximum(one, other) - BAND, 0, length - 1)
    return low, np.clip(row - np.minimum(one, other) + BAND + 1, low + 1, length)


def within(phrase: list[int], words: list[int]) -> bool:
    n = len(phrase)
    return any(words[i : i + n] == phrase for i in range(len(words) - n + 1))


def align(part: np.ndarray, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment in a band: matched words, and the first and last word of `part` in it.
    In row i the columns from `low[i]` to before `high[i]` are looked at.

    A cell is one number: score, matches and first word, `BITS` bits each. So the larger number
    is the better cell, and a row needs no loop: gaps in `part` are a running maximum."""
    one, start_bits = 1 << 2 * BITS, (1 << BITS) - 1
    slope = np.arange(int((high - low).max(initial=0)), dtype=np.int64) * one
    before, first, best, end = np.zeros(1, np.int64), 0, 0, 0
    for i, (word, lo, hi) in enumerate(zip(part.tolist(), low.tolist(), high.tolist())):
        above = np.zeros(hi - lo + 1, np.int64)
        a, b = max(lo, first), min(hi, first + len(before) - 1)
        if a <= b:
            above[a - lo : b - lo + 1] = before[a - first : b - first + 1]
        corner = above[:-1]
        row = np.where(corner >= one, corner, i) + np.where(words[lo:hi] == word, 2 * one + (1 << BITS), -one)
        np.maximum(row, above[1:] - one, out=row)
        row = np.maximum.accumulate(row + slope[: hi - lo]) - slope[: hi - lo]
        row[row < one] = 0
        before, first = np.concatenate([above[:1] * 0, row]), lo
        top = int(row.max())
        if top // one > best // one:
            best, end = top, i
    return best >> BITS & start_bits, best & start_bits, end


def word_spans(text: str) -> list[tuple[int, int]]:
    """Spans in `text` of the words of its lower case."""
    owner = [i for i, c in enumerate(text) for _ in c.lower()]
    lowered = "".join(c.lower() for c in text)
    return [(owner[m.start()], owner[m.end() - 1] + 1) for m in _WORD.finditer(lowered)]


def longest_apart(matches: list[Match]) -> list[Match]:
    """Matches from the longest on, without those that overlap a longer one; in order of place."""
    kept: list[Match] = []
    for m in sorted(set(matches), key=lambda m: (-m.words, m.of, m.template, m.start)):
        if all(m.stop <= k.start or k.stop <= m.start for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: m.start)


def license_matches(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    required: dict[str, tuple[str, ...]] = NAMES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """`doc_id, template, matched_words, template_words, coverage, span_start, span_stop`."""
    texts = templates or all_templates()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(texts, required, coverage)
        names = ["doc_id", "template", "matched_words", "template_words", "coverage", "span_start", "span_stop"]
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32())
        for batch in batches:
            for part in by_bytes(batch, "text"):
                rows = [
                    (doc_id, m.template, m.words, m.of, m.words / m.of, m.start, m.stop)
                    for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                    for m in (index.scan(text) if text else ())
                ]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, RESULT)
