"""License scan: an inverted index of winnowed template fingerprints picks candidates, and
banded local alignment of words reports how much of a template is there and where.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: License notices and short license texts, as published.
TEMPLATES: Mapping[str, str] = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "mit-notice": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

GRAM = 3
WIDTH = 2
MIN_COVERAGE = 0.7
_MATCH, _GAP = 2, 1
#: A-Z to lower case, other ASCII that is no letter or digit to a space; other bytes stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


class Match(NamedTuple):
    template: str
    matched: int
    template_words: int
    first: int
    end: int


class LicenseIndex:
    """Fingerprints of all templates. Its size is that of the templates, never of the corpus."""

    def __init__(self, templates: Mapping[str, str], gram: int = GRAM, width: int = WIDTH):
        self.gram = gram
        words = {name: words_of(text) for name, text in templates.items()}
        short = [name for name, row in words.items() if len(row) < gram + width - 1]
        if short:
            raise ValueError(f"templates of fewer than {gram + width - 1} words: {short}")
        vocabulary = sorted({w for row in words.values() for w in row})
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        if (len(vocabulary) + 2) ** gram >= 1 << 62:
            raise ValueError("too many template words for this gram length")
        self.rows = {name: np.array([self.ids[w] for w in row]) for name, row in words.items()}
        found: dict[int, list[tuple[str, int]]] = {}
        for name, row in self.rows.items():
            codes = self._codes(row)
            order = self._mix(codes)
            picked = {int(i + order[i : i + width].argmin()) for i in range(len(codes) - width + 1)}
            for place in sorted(picked):
                found.setdefault(int(codes[place]), []).append((name, place))
        self.found = found
        self.codes = np.array(sorted(found), "int64")

    def _codes(self, row: np.ndarray) -> np.ndarray:
        """One number per run of ``gram`` words; 0 if a word is in no template."""
        size = len(row) - self.gram + 1
        code, known = np.zeros(max(size, 0), "int64"), np.ones(max(size, 0), bool)
        for step in range(self.gram if size > 0 else 0):
            part = row[step : step + size]
            code = code * (len(self.ids) + 1) + part
            known &= part > 0
        return code * known

    @staticmethod
    def _mix(codes: np.ndarray) -> np.ndarray:
        return (codes.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)

    def scan(self, text: str | None, least: float = MIN_COVERAGE) -> list[Match]:
        """Matches with at least that share of the template, in place order; per template they
        do not overlap, and the fuller one is kept, the earlier one at a tie."""
        get = self.ids.get
        row = np.array([get(w, 0) for w in words_of(text)], "int64")
        codes = self._codes(row)
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        hits: dict[str, list[int]] = {}
        for place in np.flatnonzero(self.codes[at] == codes):
            for name, inside in self.found[int(codes[place])]:
                hits.setdefault(name, []).append(int(place) - inside)
        matches = []
        for name, diagonals in sorted(hits.items()):
            template = self.rows[name]
            band = max(3, len(template) // 8)
            mine = []
            for low, high in _bands(sorted(diagonals), band, 2 * len(template) + 8 * band):
                rest = row[max(0, low) : max(0, high + len(template))].copy()
                while True:  # a band can hold several copies: each one's span is taken out
                    matched, first, end = align(rest, template, low - max(0, low), high - max(0, low))
                    if not matched or matched < least * len(template):
                        break
                    mine.append(Match(name, matched, len(template), first + max(0, low), end + max(0, low)))
                    rest[first:end] = -1
            matches += self._apart(mine)
        return sorted(matches, key=lambda m: (m.first, m.end, m.template))

    @staticmethod
    def _apart(matches: list[Match]) -> list[Match]:
        kept: list[Match] = []
        for match in sorted(matches, key=lambda m: (m.first, m.end)):
            if kept and match.first < kept[-1].end:
                if match.matched > kept[-1].matched:
                    kept[-1] = match
            else:
                kept.append(match)
        return kept


def _bands(diagonals: list[int], band: int, widest: int) -> Iterator[tuple[int, int]]:
    """Lowest and highest diagonal of each chain of diagonals at most ``band`` apart; a chain of
    more than ``widest`` is cut into bands of that width that overlap by half."""
    start = last = diagonals[0]
    for diagonal in [*diagonals[1:], None]:
        if diagonal is not None and diagonal - last <= band:
            last = diagonal
            continue
        low, high = start - band, last + band
        while high - low > widest:
            yield low, low + widest
            low += widest // 2
        yield low, high
        start = last = diagonal


def align(row: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment whose diagonals (place in the row less place in the template) lie
    from ``low`` to ``high``: matched words, and first and end place in the row.

    Equal words score 2; unequal words, left-out and added words cost 1 each.
    """
    width = high - low + 1
    scores = np.zeros((len(template) + 1, width + 1), "int32")  # the last column stays 0: outside
    shift = np.arange(width) * _GAP
    padded = np.concatenate((np.full(max(0, -low), -1), row, np.full(max(0, len(template) + high - len(row)), -1)))
    start = max(0, low)
    for i, word in enumerate(template):
        same = padded[start + i : start + i + width] == word
        above = scores[i, 1:] - _GAP  # the template's word is left out: one diagonal lower
        best = np.maximum(np.maximum(scores[i, :width] + np.where(same, _MATCH, -1), above), 0)
        scores[i + 1, :width] = np.maximum.accumulate(best + shift) - shift
    i, j = (int(x) for x in np.unravel_index(scores.argmax(), scores.shape))
    end, matched, first = None, 0, 0
    while i > 0 and scores[i, j] > 0:
        place = low + j + i - 1
        same = 0 <= place < len(row) and row[place] == template[i - 1]
        if scores[i, j] == scores[i - 1, j] + (_MATCH if same else -1):
            if same:
                matched, first = matched + 1, place
                end = place + 1 if end is None else end
            i -= 1
        elif scores[i, j] == scores[i - 1, j + 1] - _GAP:
            i, j = i - 1, j + 1
        else:
            j -= 1
    return matched, first, end or 0


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = MIN_COVERAGE
) -> DataFrame:
    """One row per match: doc_id, template, matched and template_words, coverage, and the span
    as words (first_word, end_word) and code points (first_char, end_char).

    Only doc_id and text are read. Null and empty texts have no match, rows without doc_id and
    repeated rows are scanned like any other. Each text is scanned whole in its own task.
    """
    index = LicenseIndex(templates)
    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, template string, matched int, template_words int, coverage double, "
        "first_word int, end_word int, first_char int, end_char int"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not (found := index.scan(text, least)):
                    continue
                spans = [m.span() for m in _WORD.finditer(text)]
                rows += [
                    (doc, m.template, m.matched, m.template_words, m.matched / m.template_words, m.first, m.end)
                    + (spans[m.first][0], spans[m.end - 1][1])
                    for m in found
                ]
            kinds = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.float64()] + 4 * [pa.int32()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            names = [part.split()[0] for part in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(scan, schema)
