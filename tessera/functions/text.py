"""Per-row text expressions (tokenising, HTML stripping)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.cleaning import ColumnOrName, _col, clean_text

# Fixed pattern: a token is a maximal run of Unicode letters, lower-cased.
TOKEN_PATTERN = r"\p{L}+"


def tokens(c: ColumnOrName) -> Column:
    """Lower-cased letter runs in text order (punctuation and digits dropped)."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN_PATTERN), F.lit(0))


def strip_html(c: ColumnOrName) -> Column:
    """Visible text of an HTML page: script/style bodies and tags removed."""
    no_script = F.regexp_replace(_col(c), r"(?is)<script[^>]*>.*?</script>", " ")
    no_code = F.regexp_replace(no_script, r"(?is)<style[^>]*>.*?</style>", " ")
    no_tags = F.regexp_replace(no_code, r"<[^>]*>", " ")
    return clean_text(no_tags)


def html_title(c: ColumnOrName) -> Column:
    return F.nullif(F.regexp_extract(_col(c), r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))
