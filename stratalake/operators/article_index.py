"""Inverted index of articles: which token stands where, so that a phrase search reads postings and no texts.

A token is what lies between two spaces, in lower case. A phrase is found anywhere in a text exactly where
its inner tokens are whole tokens, its first one ends a token, its last one begins one and the places follow each other: the
same articles as by a scan.

Four tables below one folder, each with a partition per batch, so that a batch written again replaces itself: ``articles``
with a number each; ``postings``, in segments: each task sorts those of its own articles by token and deals them into buckets by the token's hash, so
nothing is shuffled and no token is hot; ``words``, the different tokens with their buckets; and ``batches``, the commit mark. It is taken away first and written last: a batch without it isn't seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .reports import article_page

NUMBER = "article_number"
BUCKETS = 16
FIELDS = ("title", "description")


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def postings_of(articles: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """(``bucket``, ``token``, ``field``, article number, ``place``) of every token of every text of numbered articles.

    A NULL text has no token, an empty one the empty token.
    """
    texts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lower(f).alias("text")) for f in fields])).alias("told")
    placed = articles.select(NUMBER, texts).select(
        NUMBER, "told.field", F.posexplode(F.split("told.text", " ", -1)).alias("place", "token")
    )
    return placed.select(_bucket(F.col("token")).alias("bucket"), "token", "field", NUMBER, "place")


@dataclass(frozen=True)
class ArticleIndex:
    """The tables of an index below ``path``."""

    spark: SparkSession
    path: str
    fields: tuple[str, ...] = FIELDS

    def _write(self, df: DataFrame, name: str, batch: str, *by: str) -> None:
        writer = df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch", *by).parquet(f"{self.path}/{name}")

    def _read(self, name: str) -> DataFrame:
        """A table, with batches as text."""
        found = self.spark.read.parquet(f"{self.path}/{name}")
        return found.withColumn("batch", F.col("batch").cast("string"))

    def _forget(self, batch: str) -> None:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batches/batch={batch}")
        mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(mark, True)

    def add(self, articles: DataFrame, batch: str) -> None:
        """Index a batch; its name is a word."""
        if not batch.isidentifier():
            raise ValueError(f"a batch is named by a word, not {batch!r}")
        self._forget(batch)
        self._write(articles.withColumn(NUMBER, F.monotonically_increasing_id()), "articles", batch)
        stored = self._read("articles").where(F.col("batch") == batch)
        segments = postings_of(stored, self.fields).sortWithinPartitions("bucket", "token", "field", NUMBER, "place")
        self._write(segments, "postings", batch, "bucket")
        own = self._read("postings").where(F.col("batch") == batch)
        self._write(own.groupBy("bucket", "token", "field").agg(F.count(F.lit(1)).alias("n")), "words", batch)
        self._write(self.spark.range(1).select(F.current_timestamp().alias("indexed_at")), "batches", batch)

    def articles(self) -> DataFrame:
        """All articles of finished batches, with batch and number."""
        # there may be no mark left, so the schema is told
        marks = self.spark.read.schema("indexed_at timestamp, batch string").parquet(f"{self.path}/batches")
        return self._read("articles").join(marks.select("batch"), "batch", "left_semi")

    def _starts(self, part: str, place: int, last: int, search_in: Sequence[str]) -> DataFrame:
        """Where the phrase would begin, by the token at one of its places."""
        token, own = F.col("token"), self._read("postings").where(F.col("field").isin(list(search_in)))
        if 0 < place < last:
            found = own.where((token == part) & (F.col("bucket") == _bucket(F.lit(part))))
        else:
            like = token.contains(part) if last == 0 else token.endswith(part) if place == 0 else token.startswith(part)
            words = self._read("words").where(F.col("field").isin(list(search_in)) & like).select("bucket", "token").distinct()
            found = own.join(words, ["bucket", "token"], "left_semi")
        return found.select("batch", NUMBER, "field", (F.col("place") - place).alias("start"))

    def with_phrase(self, phrase: str, search_in: Sequence[str] = FIELDS) -> DataFrame:
        """The different (batch, number) of articles that contain a phrase, by intersecting the places of its tokens."""
        parts = phrase.lower().split(" ")
        starts = [self._starts(part, i, len(parts) - 1, search_in) for i, part in enumerate(parts)]
        both = reduce(lambda a, b: a.join(b, ["batch", NUMBER, "field", "start"]), starts)
        return both.select("batch", NUMBER).distinct()

    def search(self, phrases: Sequence[str], search_in: Sequence[str] = FIELDS, **selection) -> DataFrame:
        """``article_search`` by the index: the same page, with batch and number beside the articles' columns."""
        if not phrases:
            raise ValueError("at least one phrase is required")
        if unknown := set(search_in) - set(self.fields):
            raise ValueError(f"fields {sorted(unknown)} are not indexed")
        found = self.articles()
        for phrase in phrases:
            found = found.join(self.with_phrase(phrase, search_in), ["batch", NUMBER], "left_semi")
        return article_page(found, F.lit(True), **selection)
