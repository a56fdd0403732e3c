"""Normalised indicators, scores and indices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.composite import coverage_ratio, minmax_norm, pivot_norms, weighted_channels
from stratalake.operators.quality import outside_range, range_checks, row_report
from stratalake.operators.reports import average_by, index_trend
from stratalake.plans.jobs import index_scores
from stratalake.plans.registry import FULL_CHANNELS, MACRO_INDEX

from .derived import INDICATORS, NATION_INDICATORS, NORMS, SCORES, WIDE, indicators
from .registry import query, rounded, table, whole

_ALL = f"WITH {INDICATORS}, {NORMS}, {WIDE}, {SCORES}"
_YEAR = "CAST(year AS BIGINT) AS year"


@query(
    "minmax_norm",
    f"WITH {INDICATORS}, {NORMS} SELECT indicator, country, {_YEAR}, value, round(norm, 6) AS norm FROM norms",
)
def norms(spark: SparkSession, sf: str) -> DataFrame:
    return minmax_norm(indicators(spark, sf)).select(
        "indicator", "country", whole("year"), "value", rounded("norm")
    )


@query(
    "outer_join_chain",
    f"""WITH {INDICATORS}, {NORMS}, {WIDE}
  SELECT country, {_YEAR}, round(bca, 6) AS bca, round(pcpi, 6) AS pcpi, round(gdp, 6) AS gdp, round(lur, 6) AS lur
  FROM wide""",
)
def wide_norms(spark: SparkSession, sf: str) -> DataFrame:
    wide = pivot_norms(minmax_norm(indicators(spark, sf)), MACRO_INDEX.indicators)
    return wide.select(
        "country",
        whole("year"),
        rounded("BCA_NGDPD_norm", name="bca"),
        rounded("PCPIPCH_norm", name="pcpi"),
        rounded("NGDP_RPCH_norm", name="gdp"),
        rounded("LUR_norm", name="lur"),
    )


@query(
    "channel_scores",
    f"""{_ALL} SELECT country, {_YEAR}, round(trade_exposure_score, 6) AS trade_exposure_score,
  round(competitiveness_score, 6) AS competitiveness_score, round(macro_resilience_score, 6) AS macro_resilience_score,
  CAST(financial_sensitivity_score AS DOUBLE) AS financial_sensitivity_score FROM idx""",
)
def scores(spark: SparkSession, sf: str) -> DataFrame:
    out = index_scores(indicators(spark, sf), MACRO_INDEX)
    return out.select("country", whole("year"), *[rounded(c) for c in MACRO_INDEX.channels])


@query(
    "coverage_ratio",
    f"{_ALL} SELECT country, {_YEAR}, CAST(coverage_ratio AS DOUBLE) AS coverage_ratio FROM idx",
)
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    wide = pivot_norms(minmax_norm(indicators(spark, sf)), MACRO_INDEX.indicators)
    return wide.select(
        "country", whole("year"), coverage_ratio(MACRO_INDEX.indicators).alias("coverage_ratio")
    )


@query(
    "composite_index",
    f"{_ALL} SELECT country, {_YEAR}, round(tvi_score, 6) AS tvi_score FROM idx",
)
def composite_index(spark: SparkSession, sf: str) -> DataFrame:
    return index_scores(indicators(spark, sf), MACRO_INDEX).select(
        "country", whole("year"), rounded("tvi_score")
    )


# --- the fourteen-indicator variant -------------------------------------------------------

# one measure of a supplier's year per indicator; some are NULL where the condition never holds
_MEASURES = {
    "BX_GDP": ("max", "l_quantity", None),
    "BT_GDP": ("min", "l_quantity", None),
    "BCA_NGDPD": ("max", "l_extendedprice", None),
    "TTT": ("min", "l_extendedprice", None),
    "EREER": ("max", "l_discount", None),
    "PCPIPCH": ("min", "l_discount", "A"),
    "NGDP_RPCH": ("max", "l_tax", None),
    "NGDPRPC_PCH": ("min", "l_tax", None),
    "LUR": ("max", "l_quantity", "R"),
    "Reserves_M": ("min", "l_quantity", "R"),
    "DirectIn": ("max", "l_extendedprice", "N"),
    "Portfl": ("min", "l_extendedprice", "N"),
    "PrivInexDIGDP": ("max", "l_discount", "R"),
    "rltir": ("max", "l_tax", "A"),
}


def _measure_sql(code: str) -> str:
    how, column, flag = _MEASURES[code]
    inner = f"CASE WHEN l_returnflag = '{flag}' THEN {column} END" if flag else column
    return f"{how}({inner}) AS {code}"


def _norm_sql(code: str) -> str:
    low, high = f"min({code}) OVER y", f"max({code}) OVER y"
    return f"CASE WHEN {high} = {low} THEN 50.0 ELSE ({code} - {low}) / ({high} - {low}) * 100 END AS {code}"


def _channel_sql(name: str) -> str:
    terms = " + ".join(f"{w} * {code}" for code, w in FULL_CHANNELS[name].items())
    return f"round({terms}, 6) AS {name}"


@query(
    "weighted_channels",
    f"""WITH m AS (
  SELECT l_suppkey, year(l_shipdate) AS year, {", ".join(_measure_sql(c) for c in _MEASURES)}
  FROM lineitem GROUP BY 1, 2),
n AS (SELECT l_suppkey, year, {", ".join(_norm_sql(c) for c in _MEASURES)} FROM m WINDOW y AS (PARTITION BY year))
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS country, {_YEAR}, {", ".join(_channel_sql(c) for c in FULL_CHANNELS)}
  FROM n""",
)
def full_channels(spark: SparkSession, sf: str) -> DataFrame:
    """A gap in any indicator makes its channel NULL."""

    def measure(code: str):
        how, column, flag = _MEASURES[code]
        value = F.when(F.col("l_returnflag") == flag, F.col(column)) if flag else F.col(column)
        return getattr(F, how)(value).alias(code)

    lines = table(spark, sf, "lineitem")
    yearly = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        *[measure(c) for c in _MEASURES]
    )
    long = yearly.unpivot(["l_suppkey", "year"], list(_MEASURES), "indicator", "value").withColumnRenamed(
        "l_suppkey", "country"
    )
    wide = pivot_norms(minmax_norm(long), list(_MEASURES))
    return weighted_channels(wide, FULL_CHANNELS).select(
        F.concat(F.lit("S"), F.col("country").cast("string")).alias("country"),
        whole("year"),
        *[rounded(c) for c in FULL_CHANNELS],
    )


# --- gates and reports on the index ---------------------------------------------------------


@query(
    "quality_range",
    f"""{_ALL}, c AS (SELECT count(*) AS n, {", ".join(f"sum(CASE WHEN NOT ({c} BETWEEN 0 AND 100) THEN 1 ELSE 0 END) AS {c}" for c in [*MACRO_INDEX.channels, "tvi_score"])} FROM idx),
a AS (SELECT sum(CASE WHEN NOT (c_acctbal BETWEEN 0 AND 9000) THEN 1 ELSE 0 END) AS n FROM customer)
  {" UNION ALL ".join(f"SELECT '{c}' AS " + '"check"' + f", CAST({c} AS BIGINT) AS violations FROM c" for c in [*MACRO_INDEX.channels, "tvi_score"])}
  UNION ALL SELECT 'c_acctbal', CAST(n AS BIGINT) FROM a""",
)
def quality_range(spark: SparkSession, sf: str) -> DataFrame:
    out = index_scores(indicators(spark, sf), MACRO_INDEX)
    report = row_report(out, range_checks(out), non_empty=False)
    accounts = row_report(
        table(spark, sf, "customer"), {"c_acctbal": outside_range("c_acctbal", 0, 9000)}, non_empty=False
    )
    return reduce(DataFrame.unionByName, [report, accounts])


_NATIONS = ("NATION_3", "NATION_17")
_NATION_ALL = f"WITH {NATION_INDICATORS}, {NORMS}, {WIDE}, {SCORES}"


@query(
    "avg_by_entity",
    f"""{_NATION_ALL} SELECT country, round(avg(tvi_score), 6) AS avg_tvi_score FROM idx
  GROUP BY country HAVING country IN {_NATIONS}""",
)
def average_index(spark: SparkSession, sf: str) -> DataFrame:
    out = index_scores(indicators(spark, sf, "nation"), MACRO_INDEX)
    return average_by(out, "country", "tvi_score", _NATIONS).select("country", rounded("avg_tvi_score"))


@query(
    "report_index_trend",
    f"""{_NATION_ALL} SELECT {_YEAR}, country, round(sum(tvi_score), 6) AS sum_tvi_score FROM idx
  WHERE country IN {_NATIONS} GROUP BY idx.year, country ORDER BY sum(tvi_score) DESC""",
)
def report_index(spark: SparkSession, sf: str) -> DataFrame:
    out = index_scores(indicators(spark, sf, "nation"), MACRO_INDEX)
    return index_trend(out, _NATIONS, "tvi_score").select(
        whole("year"), "country", rounded("sum_tvi_score")
    )
