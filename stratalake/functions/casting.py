"""Type conversion and time formatting that never fail on a bad value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Text that cannot be a number is told apart first: a failed conversion costs
# far more than a match. Whatever converts matches (names and hexadecimals by how they begin).
_MAY_BE_NUMBER = (
    r"(?i)\A[\x00-\x20]*[+-]?(?:nan|inf|0x|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[fd]?[\x00-\x20]*\z)"
)
_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def text_to_double(value: Column | str) -> Column:
    """A double, or NULL for text that is no number."""
    col = _column(value)
    return F.when(col.rlike(_MAY_BE_NUMBER), col.try_cast("double"))


def cast_or_null(value: Column | str, dtype: str, text: bool = True) -> Column:
    """Cast, giving NULL for what does not convert (also in ANSI mode).

    ``text`` says that the value is a string. A whole number may then be
    written "12.0"; its fraction is cut off.
    """
    col = _column(value)
    if not text:
        return col.try_cast(dtype)
    if dtype == "string":
        return col
    if dtype == "double":
        return text_to_double(col)
    if dtype in ("int", "bigint"):
        return F.when(col.rlike(_WHOLE_NUMBER), col.try_cast(dtype)).otherwise(
            text_to_double(col).try_cast(dtype)
        )
    return col.try_cast(dtype)


def double_or_default(value: Column | str, missing: str = "zero") -> Column:
    """A double from text; what does not parse becomes 0.0, or NULL with ``missing="null"``."""
    number = text_to_double(value)
    if missing == "null":
        return number
    if missing != "zero":
        raise ValueError(f"missing must be 'zero' or 'null', not {missing!r}")
    return F.coalesce(number, F.lit(0.0))


def year_month(value: Column | str) -> Column:
    """``yyyy-MM``, the partition value of tables keyed by a time."""
    return F.date_format(_column(value), "yyyy-MM")


def utc_iso(value: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` as ISO-8601 UTC text; any other text is kept as it is."""
    col = _column(value)
    parsed = F.try_to_timestamp(col, F.lit("yyyy-M-d H:m:s"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), col)
