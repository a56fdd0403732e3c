"""The inverted index finds what the scan finds."""

from __future__ import annotations

import pytest

from stratalake.operators.article_index import ArticleIndex
from stratalake.operators.reports import article_search

from .conftest import plan_of, rows

_SCHEMA = "article_url string, title string, description string, language string, source_id string, published_at timestamp"
_TEXTS = [
    ("Copper on the rise", "Prices of copper rose"),
    ("On  the road", "two spaces on the title"),
    ("theory", "button the end"),
    (None, "ONION THE"),
    ("", None),
    (" the", "the "),
    ("on the on the on the", "on the"),
    ("on the", "x " * 20000 + "needle in it"),
    ("ΣΟΦΟΣ ΟΔΟΣ", "İstanbul strasse STRAẞE"),
    ("a\tb c\nd", "on\tthe"),
]


@pytest.fixture(scope="module")
def articles(spark):
    import datetime

    day = datetime.datetime(2024, 1, 1)
    own = [(f"https://h{i % 3}.example.com/{i}", t, d, "en", "s", day + datetime.timedelta(days=i % 4)) for i, (t, d) in enumerate(_TEXTS)]
    own += [own[0], (own[0][0], own[0][1], "another text on the same address", "en", "s", None)]
    return spark.createDataFrame(own, _SCHEMA)


PHRASES = [
    ["the"], ["on the"], ["n the "], [" the"], ["the", "copper"], ["  the"], ["le in i"], ["needle"], [" "], [""], ["ΟΔΟΣ"], ["σοφος"],
    ["straße"], ["b c\nd"], ["on the on"], ["absent words"],
]


def test_equal_to_the_scan(spark, articles, tmp_path):
    index = ArticleIndex(spark, str(tmp_path))
    index.add(articles, "one")
    for phrases in PHRASES:
        for fields in (["title", "description"], ["title"]) if "the" in phrases[0] else (["title", "description"],):
            found, scanned = index.search(phrases, fields), article_search(articles, phrases, fields)
            assert rows(found.select(*articles.columns)) == rows(scanned), (phrases, fields)


def test_batches_add_up_and_replace_themselves(spark, articles, tmp_path):
    index = ArticleIndex(spark, str(tmp_path))
    early = articles.where("published_at < '2024-01-03'")
    index.add(early, "one")
    index.add(articles.where("published_at >= '2024-01-03' or published_at is null"), "two")
    index.add(early, "one")
    found = index.search(["on the"], page_size=3, page=2)
    wanted = article_search(articles, ["on the"], page_size=3, page=2)
    assert [r[:6] for r in found.select(*articles.columns).collect()] == [tuple(r) for r in wanted.collect()]


def test_a_batch_that_failed_is_not_seen(spark, articles, tmp_path, monkeypatch):
    index, whole = ArticleIndex(spark, str(tmp_path)), ArticleIndex._write

    def until_words(self, df, name, batch, *by):
        if name == "words":
            raise RuntimeError("lost")
        whole(self, df, name, batch, *by)

    index.add(articles.where("title = 'theory'"), "one")
    with monkeypatch.context() as patch:
        patch.setattr(ArticleIndex, "_write", until_words)
        for batch in ("one", "two"):  # also where an earlier try succeeded
            with pytest.raises(RuntimeError):
                index.add(articles, batch)
            assert index.search(["on the"]).count() == 0
    index.add(articles, "two")
    assert index.search(["the"]).count() == article_search(articles, ["the"]).count()


def test_search_reads_buckets_and_no_texts(spark, articles, tmp_path):
    index = ArticleIndex(spark, str(tmp_path))
    index.add(articles, "one")
    plan = plan_of(index.search(["end on the way"], page_size=5).select("article_url"))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert not any("description:" in s or "title:" in s for s in scans)
    # inner tokens are looked up in their own bucket
    assert sum("bucket" in s and "PartitionFilters" in s and "(bucket#" in s.split("PartitionFilters")[1] for s in scans) >= 2


def test_refuses_what_it_cannot_answer(spark, articles, tmp_path):
    index = ArticleIndex(spark, str(tmp_path))
    with pytest.raises(ValueError):
        index.search([])
    with pytest.raises(ValueError):
        index.search(["a"], ["author"])
