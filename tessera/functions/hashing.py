"""Change hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.cleaning import ColumnOrName, _col


def change_hash(attributes: dict[str, ColumnOrName]) -> Column:
    """md5 of the ordered attribute record as JSON, NULLs included.

    Values are rendered as text first so that the digest does not depend on
    an engine's number or timestamp formatting.  Keys and modification
    timestamps must not be passed in.
    """
    fields = [_col(v).cast("string").alias(k) for k, v in attributes.items()]
    return F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def surrogate_key(*cols: ColumnOrName) -> Column:
    """Stable 64-bit key from business columns; no global numbering."""
    return F.xxhash64(*[_col(c) for c in cols])
