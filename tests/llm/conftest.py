from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SMALL = "/root/testdata/sf0.001"

#: Null, empty and odd texts, ties and repeated rows, ids in no order.
ODD_TEXTS = [
    None,
    "",
    " ",
    "a  b",
    "x 　 y",
    "  lead",
    "trail  ",
    "a\n\n  b\tc  d",
    "don't 's 't it's we'll o'",
    "<|endoftext|> a <|endoftext|>b<s>",
    "é à  ü  z ×3 a÷b",
    "\u0085 a a b  c ▁x",
    "日本 語 x",
    "a\x1c b\x1f c ​ b",
    "word,next.\nNew l\n\nx\n y",
    "x\n\nY\nZ\r\nA a1b2 c_d 5x x5",
    "one two three four five six seven",
    "one two three four five six seven",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts and a column named as an output of several operators."""
    rows = [(i, t, "en" if i % 2 else None, "s", None, 7, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", "en", None, 3, None, None), (3, "a  b", "en", "s", 4, 1, "x"), (99, "long text " * 3000, "en", "s", 1, 2, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, length long, shard string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents():
    return pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text", "lang"]).sort_by("doc_id")


def frame(spark, **columns):
    return spark.createDataFrame(pa.table(columns))
