"""Raw API payloads to flat rows, element by element.

Every function takes one row per response: ``payload`` (JSON text),
``request_url``, ``received_at`` and the request parameters named in its
docstring. A payload is read once, for the few members of its head that each row repeats and for the text of its data
part. That text is taken apart level by level by generators, which hand out one element after the other: an element carries its own text and the
typed head, never the payload, so memory and work are those of the payload, however many elements it has.
An element of an unexpected kind costs that element and nothing else.

Whatever gives no row is in ``rejected``: responses that are no JSON, report an
error, did not succeed or lack their data part, and elements that are not what
the format has there, each with its place and its text. An empty list is a
valid response without rows.

Of a member that an object names twice the last counts (of the data maps, each is a row); a text that holds a JSON object itself
counts as that object.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import cast_or_null, double_or_default, text_to_double, utc_iso
from ..functions.payload import ERROR_MEMBERS, classify, soft_error

_OBJECT, _LIST = "map<string,string>", "array<string>"
_KIND = {_OBJECT: "not an object", _LIST: "not a list"}
_UNREAD = "_unread"


def _envelope(source: str, dataset: str | Column) -> list[Column]:
    dataset = F.lit(dataset) if isinstance(dataset, str) else dataset
    return [
        F.lit(source).alias("source"),
        dataset.alias("dataset"),
        F.col("request_url"),
        F.col("received_at"),
    ]


def _text(name: str) -> Column:
    """A member of the element as text."""
    return F.col("_fields")[name]


def _number(name: str) -> Column:
    return text_to_double(_text(name)).alias(name)


def _with_fields(elements: DataFrame, *names: str) -> DataFrame:
    """The named members of each element, read in one go."""
    return elements.withColumn("_fields", F.from_json("item", ", ".join(f"`{n}` string" for n in names)))


def _not_json(text: Column | str) -> Column:
    return F.try_parse_json(text).isNull()


def _whole(raw: DataFrame, members: Sequence[str] = ()) -> tuple[DataFrame, Column, Column]:
    """Responses with the members of their head (``_s``), whether the body is a list, and what error it reports."""
    fields = [f"`{m}` string" for m in members] + [f"`{m}` variant" for m in ERROR_MEMBERS] + [f"`{_UNREAD}` string"]
    listed = F.startswith(F.ltrim("payload"), F.lit("["))
    body = F.from_json(F.when(~listed, F.col("payload")), ", ".join(fields), {"columnNameOfCorruptRecord": _UNREAD})
    read = raw.withColumn("_s", body)
    read = read.withColumn("_error", classify(lambda name: F.col(f"_s.{name}")))
    error = F.when(F.col("_error.has_error"), F.concat(F.lit("error: "), F.coalesce("_error.message", F.lit(""))))
    return read, listed, error


def _part(
    raw: DataFrame, kind: str, parameters: Sequence[str] = (), name: str | None = None, item: Column | None = None,
    members: Sequence[str] = (), heads: Sequence[Column] = (), failed: Column | None = None,
) -> DataFrame:
    """One row per response: its head, and the text of its data part (``item``) or what is wrong with it (``problem``).

    The part is the member ``name``, or ``item``, or the body itself.
    """
    read, listed, error = _whole(raw, [*members, *([name] if name else [])])
    unread = F.col(f"_s.{_UNREAD}").isNotNull()
    problem = F.when(F.col("payload").isNull(), "not json")
    if name is None and item is None:
        item = F.col("payload")
        problem = problem.when(~listed & unread & _not_json("payload"), "not json").when(error.isNotNull(), error).when(~listed, _KIND[kind])
    else:
        item = F.col(f"_s.{name}") if item is None else item
        problem = problem.when(listed | unread, F.when(_not_json("payload"), "not json").otherwise("no data")).when(error.isNotNull(), error)
        if failed is not None:
            problem = problem.when(failed.isNotNull(), failed)
        # a JSON null is there, but is not what it should be
        there = F.array_contains(F.json_object_keys("payload"), name) if name else F.lit(False)
        problem = problem.when(item.isNull(), F.when(there, _KIND[kind]).otherwise("no data"))
    found = read.select(*parameters, "request_url", "received_at", *heads, "payload", item.alias("item"), problem.alias("problem"))
    broken = F.when(F.col("problem").isNotNull(), F.col("payload"))
    return found.withColumns({"path": F.when(broken.isNotNull(), F.lit("$")), "broken": broken, "item": F.when(broken.isNull(), F.col("item"))}).drop("payload")


def _level(nodes: DataFrame, kind: str, place: str, prefix: str = "") -> DataFrame:
    """What is in each node, one after the other; ``place`` becomes the column of the member name or position.

    A node that is no ``kind`` stays, with its problem; an empty one has nothing in it.
    """
    inside = nodes.withColumn("_inside", F.from_json("item", kind))
    bad = F.col("problem").isNull() & F.col("_inside").isNull()
    # a list that holds the whole body may also be no JSON at all
    wrong = F.when(_not_json("item"), "not json").otherwise(_KIND[kind]) if prefix == "$" else F.lit(_KIND[kind])
    kept = [c for c in nodes.columns if c not in ("item", "problem", "path", "broken")]
    made = F.posexplode_outer("_inside") if kind == _LIST else F.explode_outer("_inside")
    # all that is told about the node comes first: above the generator it would make every element carry the node's content
    told = inside.select(
        *kept,
        F.when(bad, wrong).otherwise(F.col("problem")).alias("problem"),
        F.when(bad, F.coalesce("item", F.lit("null"))).otherwise(F.col("broken")).alias("broken"),
        F.when(bad, _path(nodes, prefix)).otherwise(F.col("path")).alias("path"),
        F.coalesce(F.size("_inside") == 0, F.lit(False)).alias("_nothing"),
        "_inside",
    )
    out = told.select(*kept, "problem", "broken", "path", "_nothing", made.alias(place, "item"))
    # with the place in it, the condition stays above the generator and the text isn't read once more for it
    return out.where(~(F.col("_nothing") & F.col(place).isNull())).drop("_nothing")


def _path(nodes: DataFrame, prefix: str) -> Column:
    """Where a node is: the names and positions on the way."""
    steps = [F.concat(F.lit("["), F.col(c).cast("string"), F.lit("]")) if c == "at" else F.concat(F.lit("."), F.col(c)) for c in nodes.columns if c in _PLACES]
    return F.concat(F.lit(prefix), *[F.coalesce(s, F.lit("")) for s in steps])


#: Columns that tell the way to an element.
_PLACES = ("k1", "k2", "k3", "at")


def _not_object(item: Column) -> Column:
    return F.when(~F.startswith(F.coalesce(item, F.lit("")), F.lit("{")), "not an object")


def _not_number(item: Column) -> Column:
    """JSON null counts as a number that is not known."""
    return F.when(item.isNotNull() & text_to_double(item).isNull(), "not a number")


def _checked(elements: DataFrame, prefix: str, check: Callable[[Column], Column] = _not_object) -> DataFrame:
    """Elements that are not what the format has get a problem, too."""
    found = elements.withColumn("problem", F.coalesce("problem", check(F.col("item"))))
    new = F.col("problem").isNotNull() & F.col("broken").isNull()
    return found.withColumns({
        "path": F.when(new, _path(elements, prefix)).otherwise(F.col("path")),
        "broken": F.when(new, F.coalesce("item", F.lit("null"))).otherwise(F.col("broken")),
    })


def _list_of(raw: DataFrame, parameters: Sequence[str] = (), name: str | None = None, **options) -> DataFrame:
    """The objects of a list: the member ``name``, or the body itself."""
    prefix = f"$.{name}" if name else "$"
    return _checked(_level(_part(raw, _LIST, parameters, name, **options), _LIST, "at", prefix), prefix)


@dataclass(frozen=True)
class Flattener:
    """``opened`` finds the elements of responses, ``convert`` makes rows of the sound ones."""

    opened: Callable[[DataFrame], DataFrame]
    convert: Callable[[DataFrame], DataFrame]

    def rows(self, raw: DataFrame) -> DataFrame:
        return self.convert(self.opened(raw).where("problem IS NULL"))

    def rejected(self, raw: DataFrame) -> DataFrame:
        """(``request_url``, ``received_at``, ``path``, ``problem``, ``raw``) of all that gives no row."""
        return self.rejected_of(self.opened(raw))

    @staticmethod
    def rejected_of(opened: DataFrame) -> DataFrame:
        """``rejected`` of what ``opened`` has found."""
        bad = opened.where("problem IS NOT NULL")
        return bad.select("request_url", "received_at", "path", "problem", F.col("broken").alias("raw"))


def rejected(flattener: str, raw: DataFrame, **options) -> DataFrame:
    """What the named flattener makes no rows of; see ``Flattener.rejected``."""
    return FLATTENERS[flattener](**options).rejected(raw)


def _date_map(source: str = "alphavantage", dataset: str = "time_series_daily", missing: str = "zero") -> Flattener:
    def opened(raw: DataFrame) -> DataFrame:
        # of the members with such a name the first counts, whatever it holds
        named = F.filter(F.map_entries(F.from_json("payload", _OBJECT)), lambda e: e["key"].contains("Time Series"))
        days = _level(_part(raw, _OBJECT, ["symbol"], item=F.get(F.transform(named, lambda e: F.coalesce(e["value"], F.lit("null"))), F.lit(0))), _OBJECT, "k1", "$.series")
        return _checked(days, "$.series")

    def convert(days: DataFrame) -> DataFrame:
        days = _with_fields(days, "1. open", "2. high", "3. low", "4. close", "5. volume")
        return days.select(
            "symbol",
            F.col("k1").alias("trade_date"),
            double_or_default(_text("1. open"), missing).alias("open"),
            double_or_default(_text("2. high"), missing).alias("high"),
            double_or_default(_text("3. low"), missing).alias("low"),
            double_or_default(_text("4. close"), missing).alias("close"),
            cast_or_null(_text("5. volume"), "bigint").alias("volume"),
            *_envelope(source, dataset),
        )

    return Flattener(opened, convert)


def date_map(raw: DataFrame, source: str = "alphavantage", dataset: str = "time_series_daily",
             missing: str = "zero") -> DataFrame:
    """Bars keyed by date under the first member whose name contains "Time Series". Parameter: symbol."""
    return _date_map(source, dataset, missing).rows(raw)


def _series(source: str = "alphavantage", dataset: str = "commodity_prices", missing: str = "zero") -> Flattener:
    def convert(points: DataFrame) -> DataFrame:
        return _with_fields(points, "date", "value").select(
            F.col("name").alias("commodity"),
            "symbol",
            "interval",
            _text("date").alias("date"),
            double_or_default(_text("value"), missing).alias("value"),
            "unit",
            *_envelope(source, dataset),
        )

    head = ("name", "interval", "unit")
    return Flattener(lambda raw: _list_of(raw, ["symbol"], "data", members=head, heads=[F.col("_s")[h].alias(h) for h in head]), convert)


def series(raw: DataFrame, source: str = "alphavantage", dataset: str = "commodity_prices",
           missing: str = "zero") -> DataFrame:
    """A ``data`` list of (date, value) under a head of name, interval and unit. Parameter: symbol."""
    return _series(source, dataset, missing).rows(raw)


def _nested_map(source: str = "imf", dataset: str = "indicators") -> Flattener:
    def convert(cells: DataFrame) -> DataFrame:
        return cells.select(
            F.col("k1").alias("indicator"),
            F.col("k2").alias("country"),
            cast_or_null("k3", "int").alias("year"),
            text_to_double("item").alias("value"),
            *_envelope(source, dataset),
        )

    def opened(raw: DataFrame) -> DataFrame:
        cells = _part(raw, _OBJECT, name="values")
        for place in ("k1", "k2", "k3"):
            cells = _level(cells, _OBJECT, place, "$.values")
        return _checked(cells, "$.values", _not_number)

    return Flattener(opened, convert)


def nested_map(raw: DataFrame, source: str = "imf", dataset: str = "indicators") -> DataFrame:
    """``values``: indicator -> country -> year -> value; a JSON null is a row without value."""
    return _nested_map(source, dataset).rows(raw)


def _rate_map(source: str = "metals_dev", dataset: str = "spot_prices") -> Flattener:
    def convert(rates: DataFrame) -> DataFrame:
        return rates.select(
            F.col("k1").alias("metal"),
            text_to_double("item").alias("rate"),
            "currency",
            "unit",
            "market_time",
            *_envelope(source, dataset),
        )

    def opened(raw: DataFrame) -> DataFrame:
        status = F.try_variant_get("_s.status", "$", "string")
        failed = F.when(~status.eqNullSafe("success"), F.concat(F.lit("status: "), F.coalesce(status, F.lit("none"))))
        heads = [F.col("_s.currency").alias("currency"), F.col("_s.unit").alias("unit"), F.get_json_object("_s.timestamps", "$.metal").alias("market_time")]
        metals = _part(raw, _OBJECT, name="metals", members=("currency", "unit", "timestamps"), heads=heads, failed=failed)
        return _checked(_level(metals, _OBJECT, "k1", "$.metals"), "$.metals", _not_number)

    return Flattener(opened, convert)


def rate_map(raw: DataFrame, source: str = "metals_dev", dataset: str = "spot_prices") -> DataFrame:
    """``metals``: name -> rate, with currency, unit and time in the head.

    Only responses whose status is "success" give rows; the others are rejected.
    """
    return _rate_map(source, dataset).rows(raw)


def rate_map_failures(raw: DataFrame) -> DataFrame:
    """Responses without success, with their status."""
    status = F.try_variant_get(F.try_parse_json("payload"), "$.status", "string")
    return raw.withColumn("status", status).where(~F.col("status").eqNullSafe("success"))


def _values(source: str = "twelvedata", dataset: str = "exchange_rates") -> Flattener:
    head, prices = ("symbol", "interval", "currency_base", "currency_quote", "type"), ("open", "high", "low", "close")

    def convert(bars: DataFrame) -> DataFrame:
        return _with_fields(bars, "datetime", *prices).select(
            *head,
            utc_iso(_text("datetime")).alias("market_time"),
            *[_number(n) for n in prices],
            *_envelope(source, dataset),
        )

    heads = [F.get_json_object("_s.meta", f"$.{n}").alias(n) for n in head]
    return Flattener(lambda raw: _list_of(raw, name="values", members=("meta",), heads=heads), convert)


def values(raw: DataFrame, source: str = "twelvedata", dataset: str = "exchange_rates") -> DataFrame:
    """A ``values`` list of bars under ``meta``; times become ISO UTC text."""
    return _values(source, dataset).rows(raw)


def _articles(source: str = "newsapi", dataset: str = "everything", language: bool = False) -> Flattener:
    def convert(found: DataFrame) -> DataFrame:
        return _with_fields(found, "url", "title", "author", "source", "description", "publishedAt").select(
            _text("url").alias("article_url"),
            _text("title").alias("title"),
            _text("author").alias("author"),
            F.get_json_object(_text("source"), "$.name").alias("source_news"),
            F.get_json_object(_text("source"), "$.id").alias("source_id"),
            _text("description").alias("description"),
            _text("publishedAt").alias("published_at"),
            *(["language"] if language else []),
            F.lit(source).alias("source_api"),
            F.lit(dataset).alias("dataset"),
            "request_url",
            "received_at",
        )

    asked = ["language"] if language else []
    return Flattener(lambda raw: _list_of(raw, asked, "articles"), convert)


def articles(raw: DataFrame, source: str = "newsapi", dataset: str = "everything", language: bool = False) -> DataFrame:
    """An ``articles`` list, each with a nested news source.

    With ``language`` the request parameter of that name is kept on each article.
    """
    return _articles(source, dataset, language).rows(raw)


def _swings(source: str = "indian_stock_api", dataset: str = "52_week_high_low_data") -> Flattener:
    def convert(points: DataFrame) -> DataFrame:
        points = _with_fields(points, "ticker", "company", "price", "52_week_high", "52_week_low")
        swing = F.col("k1")
        price = F.when(swing == "high52Week", _text("52_week_high")).otherwise(_text("52_week_low"))
        return points.select(
            _text("ticker").alias("ticker"),
            _text("company").alias("company"),
            _number("price"),
            swing.alias("swing_type"),
            text_to_double(price).alias("swing_price"),
            *_envelope(source, dataset),
        )

    def opened(raw: DataFrame) -> DataFrame:
        prefix = "$.NSE_52WeekHighLow"
        swings = _level(_part(raw, _OBJECT, name="NSE_52WeekHighLow"), _OBJECT, "k1", prefix)
        return _checked(_level(swings, _LIST, "at", prefix), prefix)

    return Flattener(opened, convert)


def swings(raw: DataFrame, source: str = "indian_stock_api", dataset: str = "52_week_high_low_data") -> DataFrame:
    """52-week swings of one exchange: swing name -> list of points.

    ``high52Week`` points carry the 52-week high, all others the low.
    """
    return _swings(source, dataset).rows(raw)


def _allowed(rows: DataFrame, value: Column, names: Sequence[str] | DataFrame) -> DataFrame:
    """The rows whose value is in a list, given as names or as a table with the names in its first column: a semi join, however long it is."""
    if not isinstance(names, DataFrame):
        names = rows.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "name string")
    listed = names.select(names[names.columns[0]].alias("_allowed"))
    return rows.withColumn("_value", value).join(listed, F.col("_value") == F.col("_allowed"), "left_semi").drop("_value")


def _risk_premium(countries: Sequence[str] | DataFrame = (), source: str = "financial_modeling_prep",
                  dataset: str = "market_risk_premium") -> Flattener:
    def convert(found: DataFrame) -> DataFrame:
        found = _with_fields(found, "country", "continent", "countryRiskPremium", "totalEquityRiskPremium")
        if isinstance(countries, DataFrame) or countries:
            found = _allowed(found, _text("country"), countries)
        return found.select(
            _text("country").alias("country"),
            _text("continent").alias("continent"),
            double_or_default(_text("countryRiskPremium")).alias("country_risk_premium"),
            double_or_default(_text("totalEquityRiskPremium")).alias("total_equity_risk_premium"),
            *_envelope(source, dataset),
        )

    return Flattener(_list_of, convert)


def risk_premium(raw: DataFrame, countries: Sequence[str] | DataFrame = (), source: str = "financial_modeling_prep",
                 dataset: str = "market_risk_premium") -> DataFrame:
    """A list of country premiums, optionally for chosen countries; a missing premium is 0."""
    return _risk_premium(countries, source, dataset).rows(raw)


LEVELS = ("sector", "industry")
MODES = ("snapshot", "historical")


def _performance(level: str, mode: str, entities: Sequence[str] | DataFrame = (), source: str = "financial_modeling_prep") -> Flattener:
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")

    def convert(found: DataFrame) -> DataFrame:
        found = _with_fields(found, "date", level, "exchange", "averageChange")
        if mode == "snapshot":
            found = _allowed(found, _text(level), entities)
        return found.select(
            _text("date").alias("date"),
            _text(level).alias(level),
            _text("exchange").alias("exchange"),
            double_or_default(_text("averageChange")).alias("average_change"),
            *_envelope(source, f"{level}_{mode}"),
        )

    return Flattener(_list_of, convert)


def performance(raw: DataFrame, level: str, mode: str, entities: Sequence[str] | DataFrame,
                source: str = "financial_modeling_prep") -> DataFrame:
    """Sector or industry performance; snapshots are cut to the requested entities."""
    return _performance(level, mode, entities, source).rows(raw)


def _locations(source: str = "indian_api") -> Flattener:
    def convert(found: DataFrame) -> DataFrame:
        found = _with_fields(found, "city", "state", "name", "price", "change", "date")
        part = F.split("request_dataset", "_")
        historical = part[2] == "historical"
        dataset = F.when(historical, F.concat_ws("_", "request_dataset", F.lower("location"))).otherwise(
            F.col("request_dataset")
        )
        place = F.coalesce(F.nullif(_text("city"), F.lit("")), F.nullif(_text("state"), F.lit("")), _text("name"))
        return found.select(
            part[0].alias("fuel_type"),
            part[1].alias("location_type"),
            _number("price"),
            _number("change"),
            place.alias("location"),
            F.when(historical, _text("date")).alias("date"),
            *_envelope(source, dataset),
        )

    asked = ["request_dataset", "location"]
    return Flattener(lambda raw: _list_of(raw, asked), convert)


def locations(raw: DataFrame, source: str = "indian_api") -> DataFrame:
    """Fuel prices by place. Parameters: request_dataset (fuel_place_mode), location (historical only).

    The place is the first non-empty of city, state and name. Historical rows
    carry a date, and their dataset ends in the requested place.
    """
    return _locations(source).rows(raw)


def _whole_payload(dataset: str, parameters: Sequence[str] = (), source: str = "indian_stock_api") -> Flattener:
    def convert(found: DataFrame) -> DataFrame:
        return found.select(*parameters, F.col("payload").alias("data"), *_envelope(source, dataset))

    def opened(raw: DataFrame) -> DataFrame:
        read, listed, error = _whole(raw)
        unsure = listed | F.col(f"_s.{_UNREAD}").isNotNull()
        problem = F.when(F.col("payload").isNull() | (unsure & _not_json("payload")), "not json").when(error.isNotNull(), error)
        found = read.select(*parameters, "request_url", "received_at", "payload", problem.alias("problem"))
        bad = F.col("problem").isNotNull()
        return found.withColumns({"path": F.when(bad, F.lit("$")), "broken": F.when(bad, F.coalesce("payload", F.lit("")))})

    return Flattener(opened, convert)


def whole_payload(raw: DataFrame, dataset: str, parameters: Sequence[str] = (),
                  source: str = "indian_stock_api") -> DataFrame:
    """One row per response, payload kept whole as ``data``, next to its request parameters."""
    return raw.select(*parameters, F.col("payload").alias("data"), *_envelope(source, dataset))


#: By name, what makes a ``Flattener`` from the options of the function of that name.
FLATTENERS: dict[str, Callable[..., Flattener]] = {
    "date_map": _date_map,
    "series": _series,
    "nested_map": _nested_map,
    "rate_map": _rate_map,
    "values": _values,
    "articles": _articles,
    "swings": _swings,
    "risk_premium": _risk_premium,
    "performance": _performance,
    "locations": _locations,
    "whole_payload": _whole_payload,
}


def with_soft_errors(raw: DataFrame) -> DataFrame:
    """Add ``has_error`` and ``error_message`` of 2xx bodies that report a failure."""
    return raw.withColumn("_e", soft_error("payload")).select(
        *raw.columns,
        F.col("_e.has_error").alias("has_error"),
        F.col("_e.message").alias("error_message"),
    )
