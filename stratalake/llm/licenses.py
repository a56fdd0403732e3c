"""License scan: winnowed fingerprints find candidate templates, banded alignment measures them.

Words are runs of ASCII letters and digits, lower-cased. Of every ``GRAM`` consecutive words a hash is
taken, and of every ``SPAN`` consecutive hashes the smallest is kept: whatever a text shares with a
template over ``GRAM + SPAN - 1`` words leaves at least one common fingerprint. The templates'
fingerprints are an inverted index; the templates have a fixed number and size, so the index goes to
every task and no document is shuffled.

A common fingerprint at word ``i`` of the document and ``j`` of the template votes for the diagonal
``i - j``. Votes that lie within a band of diagonals, and no further apart than the template is long,
form one candidate; each candidate is aligned (edits of words, within the band), which gives the template's
matched words and the span of the document that they lie in. Several occurrences of one template in
one document are several rows. Fingerprints that many templates share vote for each of them.

Some licenses differ from others by a word or two. Such words (``TELLING``, and the version where it is part of the
license's name) are not subject to the coverage: a span that has one the template doesn't have, or lacks one that it
has, is no occurrence.

Null, empty and wordless texts have no rows. Repeated rows are scanned as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words
from .store import column, text_slices

GRAM = 3
SPAN = 2
BAND = 6
COVERAGE = 0.8

#: Notices by which works are commonly put under a license. Digits match any digits.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "GPL": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "LGPL": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "AGPL": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-short": "Licensed under CC BY 4.0.",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: By names of templates: words that tell these licenses from others with nearly the same words.
TELLING = (
    (("CC-",), "nc nd sa noncommercial commercial noderivatives noderivs derivatives derivs sharealike alike"),
    (("GPL", "LGPL", "AGPL"), "lesser library affero"),
)
#: Templates whose name has the version that their digits are; others take any digits.
VERSIONED = ("Apache-2.0-header", "MPL-2.0")

_KEEP = np.full(256, 0x20, dtype=np.uint8)
for _b in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _KEEP[_b] = _b
for _b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _KEEP[_b] = _b + 32


def tokens(texts: pa.Array, versions: bool = False) -> words.Words:
    """Words of letters and digits of all texts, with their byte places; each digit reads as 0, except with ``versions``."""
    data, starts = words.text_bytes(texts)
    plain = _KEEP[data]
    digit = (plain >= 0x30) & (plain <= 0x39)
    if not versions:
        plain[digit] = 0x30
    column_ = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(np.ascontiguousarray(starts)), pa.py_buffer(plain)])
    return words.words_of(column_)


def fingerprints(hashes: np.ndarray, first: np.ndarray, gram: int = GRAM, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Places (of their first word) and values of the winnowed hashes; ties take the last.

    ``first`` has the borders of the texts, over which no hash reaches.
    """
    grams = words.gram_hashes(hashes, gram)
    if len(grams) == 0:
        return np.zeros(0, dtype=np.int64), grams
    place = np.arange(len(grams))
    inside = place + gram <= first[np.searchsorted(first, place, side="right")]
    grams[~inside] = np.iinfo(np.uint64).max
    width = min(span, len(grams))
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    places = np.arange(len(views)) + width - 1 - np.argmin(views[:, ::-1], axis=1)
    places = np.unique(places)
    places = places[inside[places]]
    return places, grams[places]


@dataclass
class Template:
    name: str
    hashes: np.ndarray
    telling: np.ndarray  # ascending hashes of the words that its spans must share with it
    own: np.ndarray  # those of them that it has
    digits: np.ndarray | None  # hashes of its words, digits as they are, where the version counts

    def is_it(self, folded: np.ndarray, plain: np.ndarray, number: np.ndarray) -> bool:
        """Whether a span's telling words (and numbers, ``plain`` where ``number``) are those of the template."""
        if len(self.telling) and not np.array_equal(np.unique(folded[np.isin(folded, self.telling)]), self.own):
            return False
        return self.digits is None or bool(np.isin(plain[number], self.digits).all())


class Index:
    """The inverted index of the templates: ascending fingerprints with the template and the place of each."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, span: int = SPAN):
        names = sorted(templates)
        found = tokens(pa.array([templates[n] for n in names], pa.string()))
        self.gram, self.span = gram, span
        plain = tokens(pa.array([templates[n] for n in names], pa.string()), versions=True)
        self.templates = []
        for i, n in enumerate(names):
            lo, hi = found.first[i], found.first[i + 1]
            told = " ".join(w for names_, w in TELLING if n.startswith(names_))
            telling = np.unique(tokens(pa.array([told], pa.string())).hash)
            own = np.intersect1d(telling, found.hash[lo:hi])
            self.templates.append(Template(n, found.hash[lo:hi], telling, own, plain.hash[lo:hi] if n in VERSIONED else None))
        prints = [fingerprints(t.hashes, np.array([0, len(t.hashes)]), gram, span) for t in self.templates]
        values = np.concatenate([v for _, v in prints])
        owner = np.repeat(np.arange(len(names)), [len(v) for _, v in prints])
        place = np.concatenate([p for p, _ in prints])
        order = np.argsort(values, kind="stable")
        self.values, self.owner, self.place = values[order], owner[order], place[order]

    def votes(self, places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template, place in the document and place in the template of every common fingerprint."""
        lo, hi = np.searchsorted(self.values, values, "left"), np.searchsorted(self.values, values, "right")
        from_ = np.flatnonzero(hi > lo)
        counts = (hi - lo)[from_]
        at = np.arange(int(counts.sum())) + np.repeat(lo[from_] - (np.cumsum(counts) - counts), counts)
        return self.owner[at], np.repeat(places[from_], counts), self.place[at]


def align(document: np.ndarray, template: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Matched template words, and the span of document words they lie in (begin, end).

    The longest common subsequence along the diagonal: template word ``j`` may meet document words
    ``diagonal + j - band`` to ``diagonal + j + band``.
    """
    width = 2 * band + 1
    best = np.zeros(width, dtype=np.int64)  # matches that end at or before offset w of this row
    begin, end = np.full(width, -1), np.full(width, -1)
    for j in range(len(template)):
        row, row_begin, row_end = best.copy(), begin.copy(), end.copy()
        # moving one template word on, the same document place is one offset lower
        row[:-1], row_begin[:-1], row_end[:-1] = best[1:], begin[1:], end[1:]
        row[-1], row_begin[-1], row_end[-1] = best[-1], begin[-1], end[-1]
        for w in range(width):
            i = diagonal + j - band + w
            if 0 <= i < len(document) and document[i] == template[j] and best[w] + 1 > row[w]:
                row[w] = best[w] + 1
                row_begin[w], row_end[w] = (i if begin[w] < 0 else begin[w]), i + 1
            if w and row[w - 1] > row[w]:
                row[w], row_begin[w], row_end[w] = row[w - 1], row_begin[w - 1], row_end[w - 1]
        best, begin, end = row, row_begin, row_end
    w = int(np.argmax(best))
    return int(best[w]), int(begin[w]), int(end[w])


def candidates(template: np.ndarray, place: np.ndarray, other: np.ndarray, lengths: list[int], band: int) -> list[tuple[int, int]]:
    """(template, diagonal): votes of a template on near diagonals, as long as the next one still lies in its length."""
    order = np.lexsort((place, place - other, template))
    found: list[tuple[int, int]] = []
    held: list[int] = []
    for k in order.tolist():
        own, diagonal = int(template[k]), int(place[k] - other[k])
        if held and found[-1][0] == own and diagonal - held[0] <= band // 2:
            held.append(diagonal)
            found[-1] = own, held[len(held) // 2]
        else:
            found.append((own, diagonal))
            held = [diagonal]
    return found


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    band: int = BAND,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per occurrence: the id, ``license``, ``coverage`` (share of the template's words that match),
    ``begin`` and ``end`` (bytes of the text) and ``matched_words``.

    Occurrences of one template that overlap count once (the better, then the earlier). Where a
    template's words lie within a longer match of another template, both are reported.
    """
    chosen = TEMPLATES if templates is None else templates
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), *T._parse_datatype_string("license string, coverage double, begin long, end long, matched_words int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(chosen)
        for batch in text_slices(batches, text_column):
            found = tokens(column(batch, text_column))
            plain = tokens(column(batch, text_column), versions=True).hash
            raw, starts = words.text_bytes(column(batch, text_column))
            places, values = fingerprints(found.hash, found.first, index.gram, index.span)
            owner, place, other = index.votes(places, values)
            text = np.searchsorted(found.first, place, side="right") - 1
            rows: dict[str, list] = {n: [] for n in schema.names}

            def told(t: int, b: int, e: int) -> bool:
                lead = raw[found.begin[b:e]]
                return index.templates[t].is_it(found.hash[b:e], plain[b:e], (lead >= 0x30) & (lead <= 0x39))

            for i in np.unique(text).tolist():
                own = text == i
                lo, hi = int(found.first[i]), int(found.first[i + 1])
                document = found.hash[lo:hi]
                kept: dict[int, list] = {}
                for t, diagonal in candidates(owner[own], place[own] - lo, other[own], [len(x.hashes) for x in index.templates], band):
                    template = index.templates[t].hashes
                    matched, b, e = align(document, template, diagonal, band)
                    if matched and matched >= coverage * len(template) and told(t, lo + b, lo + e):
                        kept.setdefault(t, []).append((-matched, b, e))
                for t, spans in sorted(kept.items()):
                    taken: list[tuple[int, int]] = []
                    for matched, b, e in sorted(spans):
                        if all(e <= x or b >= y for x, y in taken):
                            taken.append((b, e))
                            size = len(index.templates[t].hashes)
                            values_ = (i, index.templates[t].name, -matched / size, int(found.begin[lo + b] - starts[i]), int(found.end[lo + e - 1] - starts[i]), -matched)
                            for name, value in zip(schema.names, values_, strict=True):
                                rows[name].append(value)
            ids = column(batch, id_column).take(pa.array(rows[id_column], pa.int64()))
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(rows[n], k) for n, k in zip(schema.names[1:], kinds, strict=True))], names=schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)
