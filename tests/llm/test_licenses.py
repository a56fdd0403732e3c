"""License scan: planted notices, edited and cut, among other text."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from stratalake.llm import licenses
from stratalake.llm.queries import QUERIES

from .conftest import SMALL

NOTICE = re.compile(r"Licensed under the Apache License, Version \d+\.\d+|Released under the MIT License|Licensed under CC BY-NC|licensed under the GNU General Public License")
NAMES = {"Licensed under the A": "Apache-2.0", "Released": "MIT", "Licensed under CC": "CC-BY-NC", "licensed": "GPL"}


def scan(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted((r["doc_id"], r["license"], r["begin"], r["end"], round(r["coverage"], 3), r["matched_words"]) for r in licenses.scan(docs, **options).collect())


def test_spans_are_bytes(spark):
    texts = ["é é Released under the MIT License. é", "RELEASED   under\nthe mit license", None, "", "...", "Released under"]
    assert scan(spark, texts) == [(0, "MIT", 6, 36, 1.0, 5), (1, "MIT", 0, 32, 1.0, 5)]


def test_numbers_match(spark):
    assert [x[1] for x in scan(spark, ["Licensed under the Apache License, Version 1.1."])] == ["Apache-2.0"]


@pytest.mark.parametrize(
    "text, names",
    [
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC"]),
        ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA"]),
        ("Licensed under CC BY 4.0.", ["CC-BY-short"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL"]),
        ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["MPL-2.0"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", []),
        (licenses.TEMPLATES["LGPL-header"], ["LGPL-header"]),
        (licenses.TEMPLATES["GPL-header"], ["GPL-header"]),
    ],
)
def test_exact_labels(spark, text, names):
    assert [x[1] for x in scan(spark, [f"before it {text} after it"])] == names


def test_query_labels_exactly(spark, documents):
    """A text whose only word of licenses is one known notice has that label and no other."""
    found = {}
    for r in QUERIES["op6_license_scan"](spark, SMALL).collect():
        found.setdefault(r["doc_id"], set()).add(r["license"])
    n = 0
    for doc_id, text in zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True):
        planted = NOTICE.findall(text or "")
        if planted and len(re.findall("licen|software", text, re.I)) == len(re.findall("licen", " ".join(planted), re.I)):
            n += 1
            assert found[doc_id] == {next(v for k, v in NAMES.items() if m.startswith(k)) for m in planted}
    assert n > 0


def test_several_occurrences(spark):
    rng = random.Random(1)
    filler = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    long = licenses.TEMPLATES["Apache-2.0-header"]
    text = f"{filler(50)} {long} {filler(30)} {long} {filler(20)}"
    found = [x for x in scan(spark, [text]) if x[1] == "Apache-2.0-header"]
    assert len(found) == 2 and all(x[4] == 1.0 for x in found)
    for x in found:
        assert text[x[2] : x[3]].startswith("Licensed under") and text[x[2] : x[3]].endswith("under the License")


@pytest.mark.parametrize("edits, there", [(0, True), (4, True), (60, False)])
def test_edits(spark, edits, there):
    rng = random.Random(edits)
    words = licenses.TEMPLATES["MIT-text"].split()
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], ["changed"], ["two", "words"]])
    found = [x for x in scan(spark, ["before " * 20 + " ".join(words) + " after" * 20]) if x[1] == "MIT-text"]
    assert bool(found) == there
    assert all(x[4] >= 0.8 for x in found)


def test_query(spark, documents):
    """Every notice that a plain search finds is found, and nothing where there is none."""
    found = {}
    for r in QUERIES["op6_license_scan"](spark, SMALL).collect():
        found.setdefault(r["doc_id"], set()).add(r["license"])
    n = 0
    for doc_id, text in zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True):
        planted = {next(v for k, v in NAMES.items() if m.startswith(k)) for m in NOTICE.findall(text or "")}
        n += bool(planted)
        assert planted <= found.get(doc_id, set())
        if not re.search("licen|software", text or "", re.I):
            assert doc_id not in found
    assert n > 0


def test_odd_rows(spark, odd):
    assert licenses.scan(odd).count() == 0 and licenses.scan(odd.limit(0)).count() == 0


def test_whatever_is_shared_leaves_a_fingerprint():
    rng = np.random.default_rng(1)
    for _ in range(200):
        shared = rng.integers(0, 2**63, licenses.GRAM + licenses.SPAN - 1, dtype=np.uint64)
        texts = [np.concatenate([rng.integers(0, 2**63, rng.integers(0, 5), dtype=np.uint64), shared, rng.integers(0, 2**63, rng.integers(0, 5), dtype=np.uint64)]) for _ in range(2)]
        a, b = (set(licenses.fingerprints(t, np.array([0, len(t)]))[1].tolist()) for t in texts)
        assert a & b


def test_alignment_is_the_longest_common_subsequence_in_the_band():
    rng = np.random.default_rng(2)
    for _ in range(100):
        document, template = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 9))
        best = np.zeros((len(template) + 1, len(document) + 1), dtype=int)
        for j in range(len(template)):
            for i in range(len(document)):
                best[j + 1, i + 1] = best[j, i] + 1 if document[i] == template[j] else max(best[j, i + 1], best[j + 1, i])
        matched, begin, end = licenses.align(document, template, 0, 30)
        assert matched == best[-1, -1]
        assert matched == 0 or (0 <= begin < end <= len(document) and end - begin >= matched)
