"""Record fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator and digest every stored fingerprint uses.
SEPARATOR = "||"
DIGEST_BITS = 256
# stands for a NULL so that (a, NULL, b) and (a, b, NULL) differ
NULL_TOKEN = "<null>"


def record_hash(columns: list[str] | tuple[str, ...]) -> Column:
    """SHA-256 over the columns in the given order."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), DIGEST_BITS)
