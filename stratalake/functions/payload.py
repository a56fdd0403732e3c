"""Inspection of raw JSON payloads and request URLs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters whose values must not be stored (compared in lower case).
SECRET_PARAMETERS = ("apikey", "api_key", "api-key", "token", "key", "access_token", "password")
REDACTED = "REDACTED"


def redact_url(url: Column | str) -> Column:
    """Replace the value of every secret query parameter."""
    names = "|".join(SECRET_PARAMETERS)
    return F.regexp_replace(url, f"(?i)([?&](?:{names})=)[^&#]*", f"$1{REDACTED}")


def payload_value(payload: Column, path: str, dtype: str) -> Column:
    """One typed value from a JSON text; NULL where absent or of another type."""
    return F.try_variant_get(F.try_parse_json(payload), path, dtype)


#: Members of a body that tell an error.
ERROR_MEMBERS = ("status", "error", "code", "message")


def classify(member: Callable[[str], Column]) -> Column:
    """``soft_error`` of a body whose ``ERROR_MEMBERS`` are given as variants."""

    def kind(name: str) -> Column:
        return F.schema_of_variant(member(name))

    def value(name: str) -> Column:
        return F.try_variant_get(member(name), "$", "string")

    by_status = F.coalesce((kind("status") == "STRING") & (value("status") == "error"), F.lit(False))
    error = kind("error")
    by_error = F.coalesce((error == "STRING") | error.startswith("OBJECT"), F.lit(False))
    code = F.try_variant_get(member("code"), "$", "bigint")
    by_code = F.coalesce((kind("code") == "BIGINT") & (code >= 400), F.lit(False))

    def message_or(default: Column) -> Column:
        # a message that is present but null stays null
        return F.when(kind("message").isNotNull(), value("message")).otherwise(default)

    message = (
        F.when(by_status, message_or(F.lit("API returned error status")))
        .when(by_error, value("error"))
        .when(by_code, message_or(F.concat(F.lit("API error code "), code.cast("string"))))
    )
    return F.struct((by_status | by_error | by_code).alias("has_error"), message.alias("message"))


def soft_error(payload: Column | str) -> Column:
    """Classify a 2xx body: struct(has_error BOOLEAN, message STRING).

    An error is a status of "error", an "error" member holding text or an
    object, or a whole-number "code" of 400 and above. Bodies that are not
    objects are never errors.
    """
    text = F.col(payload) if isinstance(payload, str) else payload
    # paths below the root exist in objects only, so other bodies are never errors;
    # the one-element array binds the parsed body once
    parsed = F.transform(F.array(F.try_parse_json(text)), lambda b: classify(lambda name: F.try_variant_get(b, f"$.{name}", "variant")))
    return F.get(parsed, F.lit(0))
