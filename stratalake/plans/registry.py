"""Every dataset the library knows, as data: one generic job serves them all."""

from __future__ import annotations

import inspect
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from ..operators import flatten
from ..operators.rolling import RollingSpec


class RegistryError(ValueError):
    """An entry that could not be run."""


@dataclass(frozen=True)
class IndexSpec:
    """Channels (indicator weights each) and the weight of each channel in the index."""

    channels: Mapping[str, Mapping[str, float]]
    weights: Mapping[str, float]
    name: str = "tvi_score"
    missing: float | None = 50.0
    directions: Mapping[str, int] = field(default_factory=dict)

    @property
    def indicators(self) -> list[str]:
        return list(dict.fromkeys(i for w in self.channels.values() for i in w))


@dataclass(frozen=True)
class DatasetSpec:
    """``style`` is scd2, append, or raw (bronze only, no silver table).

    ``fact_style`` says how the fact follows silver: ``upsert`` merges the current
    rows by key, ``partitions`` replaces the touched partitions by them.
    """

    name: str
    domain: str
    source: str
    dataset: str
    flattener: str
    style: str = "raw"
    columns: Mapping[str, str] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    hash_columns: tuple[str, ...] = ()
    partition: str | None = None
    month_of: str | None = None
    required: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    scan_mode: str = "FAILFAST"
    fact: tuple[str, ...] = ()
    fact_style: str = "upsert"
    fact_update: tuple[str, ...] = ()
    rolling: RollingSpec | None = None
    index: IndexSpec | None = None
    schedule: str = "@daily"
    # how the flattener is called, and which values a request parameter may have
    options: Mapping[str, object] = field(default_factory=dict)
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def table(self, layer: str, suffix: str) -> str:
        return f"{layer}.{self.domain}_{self.source}_{self.dataset}_{suffix}"

    @property
    def bronze_columns(self) -> list[str]:
        """Columns of a bronze line, under their names in the file."""
        original = {new: old for old, new in self.renames.items()}
        return [original.get(c, c) for c in self.columns] + list(METADATA)

    @property
    def silver_columns(self) -> dict[str, str]:
        out: dict[str, str] = {}
        for name, dtype in self.columns.items():
            out[name] = dtype
            if name == self.month_of:
                out["year_month"] = "string"
        out |= METADATA
        if self.style == "scd2":
            out |= HISTORY
        return out | LINEAGE

    @property
    def fact_columns(self) -> dict[str, str]:
        types = self.silver_columns
        return {c: types[c] for c in self.fact} | {"processed_at": "timestamp"}


METADATA = {
    "source": "string",
    "dataset": "string",
    "request_url": "string",
    "received_at": "timestamp",
    "ingested_at": "timestamp",
}
HISTORY = {
    "record_hash": "string",
    "effective_from": "timestamp",
    "effective_to": "timestamp",
    "is_current": "boolean",
}
LINEAGE = {"dag_id": "string", "run_id": "string", "processed_at": "timestamp"}

# Indicator codes and weights of the published index.
MACRO_INDEX = IndexSpec(
    channels={
        "trade_exposure_score": {"BCA_NGDPD": 1.0},
        "competitiveness_score": {"PCPIPCH": 1.0},
        "macro_resilience_score": {"NGDP_RPCH": 0.6, "LUR": 0.4},
        "financial_sensitivity_score": {},
    },
    weights={
        "trade_exposure_score": 0.35,
        "competitiveness_score": 0.20,
        "macro_resilience_score": 0.25,
        "financial_sensitivity_score": 0.20,
    },
)

# The channel weights when all fourteen indicators exist (a gap makes a channel NULL).
FULL_CHANNELS = {
    "trade_exposure_score": {"BX_GDP": 0.5, "BT_GDP": 0.3, "BCA_NGDPD": 0.2},
    "competitiveness_score": {"TTT": 0.4, "EREER": 0.3, "PCPIPCH": 0.3},
    "macro_resilience_score": {
        "NGDP_RPCH": 0.35,
        "NGDPRPC_PCH": 0.25,
        "LUR": 0.20,
        "Reserves_M": 0.20,
    },
    "financial_sensitivity_score": {
        "DirectIn": 0.4,
        "Portfl": 0.2,
        "PrivInexDIGDP": 0.2,
        "rltir": 0.2,
    },
}

# What a request may ask for.
INTERVALS = ("daily", "weekly", "monthly")
PERIODS = ("1m", "6m", "1yr", "3yr", "5yr", "10yr", "max")
FILTERS = ("default", "price", "pe", "sm", "evebitda", "ptb", "mcs")
STATS = (
    "quarter_results", "yoy_results", "balancesheet", "cashflow", "ratios",
    "shareholding_pattern_quarterly", "shareholding_pattern_yearly",
)

# Dataset identities, columns with their types, keys, fingerprint columns and
# partitions of the stored tables.
_MARKET = DatasetSpec(
    name="market_daily",
    domain="american_markets",
    source="alphavantage",
    dataset="time_series_daily",
    flattener="date_map",
    style="scd2",
    columns={
        "symbol": "string",
        "trade_date": "date",
        "open": "double",
        "high": "double",
        "low": "double",
        "close": "double",
        "volume": "bigint",
    },
    keys=("symbol", "trade_date"),
    hash_columns=("symbol", "trade_date", "open", "high", "low", "close", "volume"),
    partition="trade_date",
    required=("symbol", "trade_date", "open", "high", "low", "close", "volume", "ingested_at"),
    fact=("symbol", "trade_date", "open", "high", "low", "close", "volume"),
    fact_update=("open", "high", "low", "close", "volume"),
    rolling=RollingSpec(),
)

_COMMODITY = DatasetSpec(
    name="commodity_prices",
    domain="commodities",
    source="alphavantage",
    dataset="commodity_prices",
    flattener="series",
    style="scd2",
    columns={
        "commodity": "string",
        "symbol": "string",
        "interval": "string",
        "trade_date": "date",
        "value": "double",
        "unit": "string",
    },
    keys=("symbol", "trade_date"),
    hash_columns=("commodity", "symbol", "trade_date", "value", "unit"),
    partition="trade_date",
    required=(
        "commodity", "symbol", "interval", "trade_date", "value", "unit",
        "source", "dataset", "ingested_at",
    ),
    renames={"date": "trade_date"},
    fact=("commodity", "symbol", "interval", "trade_date", "value", "unit"),
    fact_update=("value", "unit"),
    schedule="@weekly",
    allowed={"interval": INTERVALS},
)

_MACRO = DatasetSpec(
    name="macro_indicators",
    domain="macroeconomics",
    source="imf",
    dataset="indicators",
    flattener="nested_map",
    style="scd2",
    columns={"indicator": "string", "country": "string", "year": "int", "value": "double"},
    keys=("indicator", "country", "year"),
    hash_columns=("indicator", "country", "year", "value"),
    partition="indicator",
    required=("indicator", "country", "year", "value", "ingested_at"),
    scan_mode="PERMISSIVE",
    fact=("indicator", "country", "year", "value"),
    fact_style="partitions",
    index=MACRO_INDEX,
    schedule="@monthly",
)

_METALS = DatasetSpec(
    name="spot_prices",
    domain="commodities",
    source="metals_dev",
    dataset="spot_prices",
    flattener="rate_map",
    style="append",
    columns={
        "metal": "string",
        "market_time": "timestamp",
        "rate": "double",
        "currency": "string",
        "unit": "string",
    },
    keys=("metal", "market_time"),
    partition="year_month",
    month_of="market_time",
    required=("metal", "rate", "currency", "unit", "market_time", "source", "dataset", "ingested_at"),
    fact=("metal", "market_time", "year_month", "rate", "currency", "unit"),
    fact_style="partitions",
)

_FX = DatasetSpec(
    name="exchange_rates",
    domain="commodities",
    source="twelvedata",
    dataset="exchange_rates",
    flattener="values",
    style="append",
    columns={
        "symbol": "string",
        "interval": "string",
        "currency_base": "string",
        "currency_quote": "string",
        "type": "string",
        "market_time": "timestamp",
        "open": "double",
        "high": "double",
        "low": "double",
        "close": "double",
    },
    keys=("symbol", "market_time"),
    partition="year_month",
    month_of="market_time",
    required=(
        "symbol", "interval", "currency_base", "currency_quote", "market_time",
        "open", "high", "low", "close", "source", "dataset", "ingested_at",
    ),
    fact=(
        "symbol", "interval", "currency_base", "currency_quote", "market_time", "year_month",
        "open", "high", "low", "close",
    ),
    fact_style="partitions",
)


def _raw(name: str, domain: str, source: str, dataset: str, flattener: str, schedule: str, **more) -> DatasetSpec:
    return DatasetSpec(
        name=name, domain=domain, source=source, dataset=dataset, flattener=flattener, schedule=schedule, **more
    )


def _whole(name: str, dataset: str, schedule: str, parameters: Sequence[str] = (), **allowed) -> DatasetSpec:
    """A dataset whose payloads stay whole."""
    options = {"dataset": dataset, "parameters": tuple(parameters)}
    return _raw(name, "indian_markets", "indian_stock_api", dataset, "whole_payload", schedule, options=options, allowed=allowed)


def _performance(level: str, mode: str) -> DatasetSpec:
    return _raw(
        f"{level}_{mode}", "financial_markets", "financial_modeling_prep", f"{level}_{mode}", "performance", "@daily",
        options={"level": level, "mode": mode},
    )


# Identities and schedules of the datasets that end in the raw zone.
_RAW = [
    _raw("risk_premium", "financial_markets", "financial_modeling_prep", "market_risk_premium", "risk_premium", "@weekly"),
    _raw("petrol_state", "energy", "indian_api", "petrol_state_live", "locations", "@daily"),
    _raw("diesel_state", "energy", "indian_api", "diesel_state_live", "locations", "@daily"),
    _whole("stock_metadata", "stock", "@weekly", ["stock_name"]),
    _whole("historical_data", "historical_data", "@daily", ["stock_name", "period", "filter"], period=PERIODS, filter=FILTERS),
    _whole("historical_stats", "historical_stats", "@monthly", ["stock_name", "stats_type"], stats_type=STATS),
    _whole("trending", "trending", "@daily"),
    _whole("most_active", "nse_most_active", "@daily"),
    _whole("price_shockers", "price_shockers", "@daily"),
    _raw("swings", "indian_markets", "indian_stock_api", "52_week_high_low_data", "swings", "@daily"),
    _raw("news_headlines", "news", "newsapi", "top_headlines", "articles", "@daily", options={"dataset": "top_headlines"}),
    _raw("news_everything", "news", "newsapi", "everything", "articles", "@daily", options={"dataset": "everything"}),
]

# Datasets that can be requested beside the scheduled ones.
_MORE = [
    *[_performance(level, mode) for level in ("sector", "industry") for mode in ("snapshot", "historical")],
    *[
        _raw(f"{fuel}_{place}_{mode}", "energy", "indian_api", f"{fuel}_{place}_{mode}", "locations", "@daily")
        for fuel in ("petrol", "diesel")
        for place in ("state", "city")
        for mode in ("live", "historical")
        if (place, mode) != ("state", "live")
    ],
]

# The raw-zone article table.
ARTICLE_COLUMNS = {
    "article_url": "string",
    "title": "string",
    "author": "string",
    "source_news": "string",
    "source_id": "string",
    "description": "string",
    "published_at": "timestamp",
    "source_api": "string",
    "request_url": "string",
    "received_at": "timestamp",
    "ingested_at": "timestamp",
}



def checked_parameters(spec: DatasetSpec, parameters: Mapping[str, object]) -> dict[str, object]:
    """The options of the dataset's flattener, with those of a request, which must be allowed values."""
    for name, value in parameters.items():
        if name in spec.allowed and value not in spec.allowed[name]:
            raise RegistryError(f"{spec.name}: {name} must be one of {list(spec.allowed[name])}, not {value!r}")
    ours = {k: v for k, v in parameters.items() if k in ("countries", "entities", "missing", "language")}
    return dict(spec.options) | ours


def problems(spec: DatasetSpec) -> list[str]:
    """Why an entry could not run; empty when it can."""
    found = []
    for part in ("name", "domain", "source", "dataset"):
        if not getattr(spec, part):
            found.append(f"{part} is empty")
    if spec.flattener not in flatten.FLATTENERS:
        found.append(f"no flattener {spec.flattener}")
    else:
        try:
            inspect.signature(flatten.FLATTENERS[spec.flattener]).bind(**spec.options)
        except TypeError as wrong:
            found.append(f"flattener {spec.flattener}: {wrong}")
    if spec.style not in ("raw", "scd2", "append"):
        found.append(f"unknown style {spec.style}")
    if spec.style == "raw":
        return found
    known = spec.silver_columns
    for what in ("keys", "fact", "hash_columns", "required", "fact_update"):
        unknown = [c for c in getattr(spec, what) if c not in known]
        if unknown:
            found.append(f"{what} names unknown columns {unknown}")
    if not spec.keys:
        found.append("no keys")
    if spec.partition not in known:
        found.append(f"unknown partition column {spec.partition}")
    if spec.style == "scd2" and not spec.hash_columns:
        found.append("versioned dataset without hash columns")
    if spec.style == "scd2" and spec.partition not in spec.keys:
        # a key must stay in one partition, or a merge could miss its current row
        found.append("partition column of a versioned dataset must be a key column")
    if spec.style == "append" and spec.month_of not in spec.keys:
        found.append("month partition must come from a key column")
    if spec.fact_style not in ("upsert", "partitions"):
        found.append(f"unknown fact style {spec.fact_style}")
    if spec.index:
        total = sum(spec.index.weights.values())
        if set(spec.index.weights) != set(spec.index.channels):
            found.append("index weights and channels differ")
        if abs(total - 1) > 1e-9:
            found.append(f"index weights add up to {total}")
    return found


def load(specs: Iterable[DatasetSpec]) -> dict[str, DatasetSpec]:
    """The registry by name; any entry that could not run is an error here."""
    out: dict[str, DatasetSpec] = {}
    for spec in specs:
        found = problems(spec)
        if spec.name in out:
            found.append("name used twice")
        if found:
            raise RegistryError(f"{spec.name}: {'; '.join(found)}")
        out[spec.name] = spec
    return out


DATASETS = load([_MARKET, _COMMODITY, _MACRO, _METALS, _FX, *_RAW])
#: Those and the datasets that are requested on demand.
ALL_DATASETS = load([*DATASETS.values(), *_MORE])


def find(domain: str, source: str, dataset: str) -> DatasetSpec:
    """The entry a run request names."""
    for spec in ALL_DATASETS.values():
        if (spec.domain, spec.source, spec.dataset) == (domain, source, dataset):
            return spec
    raise RegistryError(f"no dataset {domain}/{source}/{dataset}")
