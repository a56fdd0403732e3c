"""Report queries over prices, series and articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.article_index import ArticleIndex
from stratalake.operators.reports import (
    article_search,
    default_rollup,
    news_list,
    price_trend,
    series_trend,
)
from stratalake.session import scratch_path

from .derived import ARTICLES, HOURLY, PRICES, hourly, page_articles, prices
from .registry import moment, query, rounded, table, text

_HOUR = "strftime(market_time, '%Y-%m-%d %H:%M:%S') AS market_time"


@query(
    "report_fx_trend",
    f"""WITH {HOURLY} SELECT {_HOUR}, round(sum(close), 4) AS sum_close, round(sum(high), 4) AS sum_high,
  round(sum(low), 4) AS sum_low FROM hourly WHERE symbol = 'purchase' GROUP BY hourly.market_time ORDER BY hourly.market_time""",
)
def fx_trend(spark: SparkSession, sf: str) -> DataFrame:
    return price_trend(hourly(spark, sf), "purchase").select(
        moment("market_time"), rounded("sum_close", 4), rounded("sum_high", 4), rounded("sum_low", 4)
    )


@query(
    "report_metal_trend",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS market_time, round(sum(value), 4) AS sum_rate
  FROM events WHERE event_type = 'view' GROUP BY 1 ORDER BY 1""",
)
def metal_trend(spark: SparkSession, sf: str) -> DataFrame:
    rates = table(spark, sf, "events").select(
        F.col("event_type").alias("metal"), F.date_trunc("day", "ts").alias("market_time"), F.col("value").alias("rate")
    )
    return price_trend(rates, "view", "metal", "market_time", ["rate"]).select(
        moment("market_time"), rounded("sum_rate", 4)
    )


@query(
    "report_energy_trend",
    f"""WITH {PRICES} SELECT strftime(trade_date, '%Y-%m-%d') AS trade_date, symbol, round(sum(value), 4) AS sum_value,
  min(unit) AS min_unit FROM prices GROUP BY prices.trade_date, symbol ORDER BY prices.trade_date, symbol""",
)
def energy_trend(spark: SparkSession, sf: str) -> DataFrame:
    return series_trend(prices(spark, sf)).select(
        text("trade_date"), "symbol", rounded("sum_value", 4), "min_unit"
    )


@query(
    "default_rollup",
    f"""WITH {HOURLY} SELECT symbol, round(sum(open), 4) AS sum_open, round(sum(high), 4) AS sum_high,
  round(sum(low), 4) AS sum_low, round(sum(close), 4) AS sum_close FROM hourly GROUP BY symbol""",
)
def rollup_by_metadata(spark: SparkSession, sf: str) -> DataFrame:
    summarize = {"symbol": "none", "market_time": "none", "open": "sum", "high": "sum", "low": "sum", "close": "sum"}
    out = default_rollup(hourly(spark, sf), summarize, ["symbol"])
    return out.select("symbol", *[rounded(c, 4) for c in out.columns if c != "symbol"])


@query(
    "report_news_list",
    f"""WITH {ARTICLES} SELECT source_news, title, language AS author, min(article_url) AS article_url FROM articles
  GROUP BY source_news, title, language ORDER BY source_news, title, author""",
)
def news(spark: SparkSession, sf: str) -> DataFrame:
    return news_list(page_articles(spark, sf).withColumnRenamed("language", "author"))


#: The second page of a search.
_SECOND_PAGE = f"""WITH {ARTICLES} SELECT article_url, source_news, language,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM articles
  WHERE (contains(lower(title), 'the') OR contains(lower(description), 'the'))
    AND (contains(lower(title), 'on the') OR contains(lower(description), 'on the'))
    AND language = 'en' AND published_at >= TIMESTAMP '2024-03-01 00:00:00'
    AND published_at <= TIMESTAMP '2026-06-30 00:00:00'
    AND source_news <> 'spam-farm.example.org' AND source_news NOT LIKE '%.spam-farm.example.org'
    AND source_news <> 'example.com' AND source_news NOT LIKE '%.example.com'
  ORDER BY articles.published_at DESC, article_url LIMIT 10 OFFSET 10"""


_PHRASES = ["the", "on the"]

#: English articles in a time range, without some domains.
_ENGLISH = {
    "language": "en",
    "exclude_domains": ["spam-farm.example.org", "example.com"],
    "from_time": "2024-03-01 00:00:00",
    "to_time": "2026-06-30 00:00:00",
    "page_size": 10,
}


def _english(spark: SparkSession, sf: str, **page) -> DataFrame:
    return article_search(page_articles(spark, sf), _PHRASES, **_ENGLISH, **page)


@query("article_search", _SECOND_PAGE)
def search(spark: SparkSession, sf: str) -> DataFrame:
    """The second page of a search, by its number."""
    return _english(spark, sf, page=2).select("article_url", "source_news", "language", moment("published_at"))


@query("article_page_after", _SECOND_PAGE)
def search_after(spark: SparkSession, sf: str) -> DataFrame:
    """The same page, asked for by the last article of the first."""
    first = _english(spark, sf).select("published_at", "article_url").collect()  # one page
    found = _english(spark, sf, after=tuple(first[-1])) if first else _english(spark, sf, page=2)
    return found.select("article_url", "source_news", "language", moment("published_at"))


@query("article_search_indexed", _SECOND_PAGE)
def search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same page, by the postings of an inverted index over all pages."""
    index = ArticleIndex(spark, scratch_path(spark, "article-index"))
    index.add(page_articles(spark, sf), "pages")
    found = index.search(_PHRASES, **_ENGLISH, page=2)
    return found.select("article_url", "source_news", "language", moment("published_at"))
