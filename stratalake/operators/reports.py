"""Report queries over gold tables, and article selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def price_trend(df: DataFrame, symbol: str, entity: str = "symbol", time: str = "market_time",
                measures: Sequence[str] = ("close", "high", "low")) -> DataFrame:
    """Sums of the measures by time for one symbol, in time order."""
    return (
        df.where(F.col(entity) == symbol)
        .groupBy(time)
        .agg(*[F.sum(m).alias(f"sum_{m}") for m in measures])
        .orderBy(time)
    )


def series_trend(df: DataFrame, by: Sequence[str] = ("trade_date", "symbol"),
                 value: str = "value", unit: str = "unit") -> DataFrame:
    """Sum of the value and first unit (alphabetically) per date and symbol."""
    return (
        df.groupBy(*by)
        .agg(F.sum(value).alias(f"sum_{value}"), F.min(unit).alias(f"min_{unit}"))
        .orderBy(*by)
    )


def index_trend(df: DataFrame, countries: Sequence[str], value: str) -> DataFrame:
    """Sum of the index by year and country for chosen countries, largest first."""
    return (
        df.where(F.col("country").isin(list(countries)))
        .groupBy("year", "country")
        .agg(F.sum(value).alias(f"sum_{value}"))
        .orderBy(F.desc(f"sum_{value}"), "year", "country")
    )


def news_list(df: DataFrame) -> DataFrame:
    """Distinct (source, title, author) with one link each, by source."""
    return (
        df.groupBy("source_news", "title", "author")
        .agg(F.min("article_url").alias("article_url"))
        .orderBy("source_news", "title", "author")
    )


def average_by(df: DataFrame, entity: str, value: str, only: Sequence) -> DataFrame:
    """Average per entity, restricted to some entities (Spark filters before aggregating)."""
    return df.groupBy(entity).agg(F.avg(value).alias(f"avg_{value}")).where(
        F.col(entity).isin(list(only))
    )


def default_rollup(df: DataFrame, summarize: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """Aggregate by the table's metadata: columns marked ``sum`` are summed, ``none`` are not."""
    unknown = set(summarize.values()) - {"sum", "none"}
    if unknown:
        raise ValueError(f"unknown summarisation {sorted(unknown)}")
    sums = [F.sum(c).alias(f"sum_{c}") for c, how in summarize.items() if how == "sum" and c not in by]
    return df.groupBy(*by).agg(*sums)


def most_recent(df: DataFrame, symbol: str, columns: Sequence[str], limit: int = 10,
                entity: str = "symbol", time: str = "trade_date") -> DataFrame:
    """The latest rows of one symbol, ties by the remaining columns; a top-k, not a full sort."""
    ties = [c for c, kind in df.dtypes if c not in (entity, time) and not kind.startswith(("map", "variant"))]
    return df.where(F.col(entity) == symbol).orderBy(F.desc(time), *ties).limit(limit).select(*columns)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def host_of(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))


def _in_domains(host: Column, domains: Sequence[str]) -> Column:
    match = F.lit(False)
    for d in domains:
        match = match | (host == d.lower()) | host.endswith("." + d.lower())
    return match


SORTS = ("publishedAt", "title")


def article_search(
    articles: DataFrame, phrases: Sequence[str], search_in: Sequence[str] = ("title", "description"), **selection
) -> DataFrame:
    """One page (``article_page``) of the articles that contain every phrase (case-insensitive, whole text)."""
    if not phrases:
        raise ValueError("at least one phrase is required")
    keep = F.lit(True)
    for phrase in phrases:
        anywhere = F.lit(False)
        for field in search_in:
            anywhere = anywhere | F.coalesce(F.lower(field).contains(phrase.lower()), F.lit(False))
        keep = keep & anywhere
    return article_page(articles, keep, **selection)


def article_page(
    articles: DataFrame,
    keep: Column,
    sources: Sequence[str] = (),
    domains: Sequence[str] = (),
    exclude_domains: Sequence[str] = (),
    from_time: str | None = None,
    to_time: str | None = None,
    language: str | None = None,
    sort_by: str = "publishedAt",
    page_size: int = 100,
    page: int = 1,
    after: tuple[object, str] | None = None,
) -> DataFrame:
    """One page of the articles that satisfy ``keep`` and the other conditions.

    Sorted newest first (or by title); ties by URL, so pages do not overlap. Unknown times and titles come last (or first, by title).
    With ``after``, the sort value and the URL of the last article seen, the page begins behind it: a top-k of what is left,
    however far the reader has come, where ``page`` makes every task sort all pages before. The two exclude each other.
    """
    if after is not None and page != 1:
        raise ValueError("page and after exclude each other")
    if sort_by not in SORTS:
        raise ValueError(f"sort_by must be one of {SORTS}")
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    if sources:
        keep = keep & F.col("source_id").isin(list(sources))
    if language:
        keep = keep & (F.col("language") == language)
    if domains:
        keep = keep & _in_domains(host_of("article_url"), domains)
    if exclude_domains:
        keep = keep & ~_in_domains(host_of("article_url"), exclude_domains)
    if from_time:
        keep = keep & (F.col("published_at") >= F.lit(from_time).cast("timestamp"))
    if to_time:
        keep = keep & (F.col("published_at") <= F.lit(to_time).cast("timestamp"))
    order = [F.desc("published_at")] if sort_by == "publishedAt" else [F.asc("title")]
    if after is not None:
        value, url = after
        name, newest = ("published_at", True) if sort_by == "publishedAt" else ("title", False)
        own, seen = F.col(name), F.lit(value).cast(articles.schema[name].dataType)
        tie = own.eqNullSafe(seen) & (F.col("article_url") > url)
        # NULL sorts last newest first, and first by title
        behind = (own.isNull() | (own < seen)) if newest else own > seen
        if value is None:
            behind = F.lit(False) if newest else own.isNotNull()
        keep = keep & (F.coalesce(behind, F.lit(False)) | F.coalesce(tie, F.lit(False)))
        return articles.where(keep).orderBy(*order, "article_url").limit(page_size)
    return articles.where(keep).orderBy(*order, "article_url").offset((page - 1) * page_size).limit(page_size)
