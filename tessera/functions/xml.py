"""Extraction from XML held in a text column.

Two forms are offered: a regex form for simple, prefix-free tags (fast,
never fails on malformed documents) and ``from_xml`` with an explicit schema
for full parsing with repeating elements as arrays.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.cleaning import ColumnOrName, _col


def _tag_pattern(tag: str) -> str:
    return f"<{re.escape(tag)}>([^<]*)</{re.escape(tag)}>"


def xml_value(doc: ColumnOrName, tag: str) -> Column:
    """Text of the first ``<tag>``; missing or empty node -> NULL."""
    return F.nullif(F.regexp_extract(_col(doc), _tag_pattern(tag), 1), F.lit(""))


def xml_values(doc: ColumnOrName, tag: str) -> Column:
    """Texts of every ``<tag>`` in document order (array, possibly empty)."""
    return F.regexp_extract_all(_col(doc), F.lit(_tag_pattern(tag)), F.lit(1))


def xml_join(doc: ColumnOrName, tag: str, sep: str = " | ",
             keep=None) -> Column:
    """Ordered, filtered string aggregation over repeated nodes.

    Empty nodes are skipped; ``keep`` is an optional predicate on each value.
    NULL when nothing passes.
    """
    vals = F.filter(xml_values(doc, tag), lambda x: x != F.lit(""))
    if keep is not None:
        vals = F.filter(vals, keep)
    return F.nullif(F.array_join(vals, sep), F.lit(""))


def parse_xml(doc: ColumnOrName, schema: str, ignore_namespace: bool = True) -> Column:
    """Full parse with ``from_xml`` (PERMISSIVE: malformed -> NULL fields)."""
    return F.from_xml(_col(doc), schema, {"ignoreNamespace": str(ignore_namespace).lower(),
                                            "ignoreSurroundingSpaces": "false"})
