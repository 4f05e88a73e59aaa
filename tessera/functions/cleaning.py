"""Row-local cleaning expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: ColumnOrName) -> Column:
    """Collapse every whitespace run to one space and trim; blank text is NULL."""
    return F.nullif(F.trim(F.regexp_replace(_col(c), r"\s+", " ")), F.lit(""))


def blank_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(TRIM(x), '')`` (P10). Literals such as 'N/A' stay data."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def safe_cast(c: ColumnOrName, data_type: str) -> Column:
    """Blank-safe ``try_cast``: blanks and uncastable text become NULL."""
    return blank_to_null(_col(c).cast("string")).try_cast(data_type)


def decode_flag(c: ColumnOrName) -> Column:
    """'1'/'true' -> TRUE, '0'/'false' -> FALSE, anything else NULL."""
    v = F.lower(F.trim(_col(c).cast("string")))
    return (F.when(v.isin("1", "true"), F.lit(True))
            .when(v.isin("0", "false"), F.lit(False)))


def display_name(*parts: ColumnOrName, fallback: ColumnOrName | None = None) -> Column:
    """Space-joined non-blank parts (NULLs skipped); ``fallback`` wins if set."""
    joined = F.nullif(F.concat_ws(" ", *[blank_to_null(p) for p in parts]), F.lit(""))
    return F.coalesce(blank_to_null(fallback), joined) if fallback is not None else joined


def sign_label(c: ColumnOrName, positive: str = "Over-predicted",
               negative: str = "Under-predicted", zero: str = "Exact") -> Column:
    """Label a signed value by its sign."""
    v = _col(c)
    return F.when(v > 0, F.lit(positive)).when(v < 0, F.lit(negative)).otherwise(F.lit(zero))


def snake_name(name: str) -> str:
    """Lower case with words (camel case too) joined by '_' (P17)."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"\W+", "_", s.lower())
    return re.sub(r"_+", "_", s).strip("_")


def table_name(file_name: str) -> str:
    """Table name of a file: what comes before its first dot, non-word runs as '_' (S09)."""
    return "_".join(w for w in re.split(r"[\W_]+", file_name.lower().partition(".")[0]) if w)


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case."""
    return df.toDF(*[snake_name(c) for c in df.columns])


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop listed columns, ignoring names that are absent."""
    return df.drop(*[n for n in names if n in df.columns])


def is_finite(c: ColumnOrName) -> Column:
    v = _col(c)
    return ~(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))


def money_sum(c: ColumnOrName) -> Column:
    """Sum of an amount in cents-exact decimals, handed out as DOUBLE: no order of rows changes it."""
    return F.sum(_col(c).cast("decimal(18,2)")).cast("double")


def round_to(c: ColumnOrName, digits: int) -> Column:
    """Round half away from zero on the binary value ``x * 10^digits``.

    Equal doubles in, equal doubles out, regardless of how the engine would
    print the value; this is how results are compared across engines.
    """
    scale = float(10 ** digits)
    return F.round(_col(c) * scale, 0) / scale
