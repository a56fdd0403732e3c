"""The pipeline stage by stage against brute force, each on its own input."""

from __future__ import annotations

import public_tokenizers
from collections import defaultdict
from tokenizers import Tokenizer

import corpus_pipeline
from stratalake.llm import language
from stratalake.llm.store import stored

from .brute import jaccard_components, removed_words
from .conftest import SMALL
from .test_tokens import check_pieces


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SMALL), f"test-{name}"))
    assert [f.columns for f in frames[1:-1]] == [columns] * 3
    raw, told, single, cut, packed = (f.collect() for f in frames)

    judged = {r["doc_id"]: r for r in language.classify(frames[0], language.fit(frames[0])).collect()}
    assert {(r["doc_id"], r["text"], r["lang"]) for r in told} == {(i, r["text"], r["lang_pred"]) for i, r in judged.items() if not r["rejected"]}
    assert len(told) >= 0.98 * len(raw)

    rows = [(r["doc_id"], r["text"]) for r in told]
    expected = {i for (i, _), (_, c) in zip(rows, jaccard_components(rows), strict=True) if i == c}
    assert {r["doc_id"] for r in single} == expected and len(single) < len(told)

    rows = [(r["doc_id"], r["text"]) for r in single]
    expected = {}
    for (i, text), (words, gone) in zip(rows, removed_words(rows), strict=True):
        if not any(gone):
            expected[i] = text
        elif not all(gone):
            expected[i] = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
    assert {r["doc_id"]: r["text"] for r in cut} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in cut)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(list, {r["doc_id"]: [tokenizer.encode(r["text"], add_special_tokens=False).ids] for r in cut})
    check_pieces(packed, ids, 2048, 1)


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_odd_rows(spark, odd):
    """Documents without letters go, those without an id stay to the end; extra columns pass."""
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stored(stage(spark, docs, SMALL), "test-odd")
        assert docs.columns == odd.columns
    rows = docs.collect()
    assert None in {r["doc_id"] for r in rows} and not {0, 1, 2} & {r["doc_id"] for r in rows}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SMALL).count() == 0
