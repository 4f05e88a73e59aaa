"""Column-expression helpers shared by the operators."""

from tessera.functions.cleaning import (  # noqa: F401
    blank_to_null, clean_names, clean_text, decode_flag, display_name, round_to,
    drop_if_present, is_finite, safe_cast, sign_label, snake_name)
from tessera.functions.dates import (  # noqa: F401
    OPEN_END, UNKNOWN_MEMBER_KEY, date_key, fiscal_parts, iso_weekday,
    minutes_between, open_end, weekday_sunday0, whole_days, whole_minutes)
from tessera.functions.hashing import change_hash, surrogate_key  # noqa: F401
from tessera.functions.text import html_title, strip_html, tokens  # noqa: F401
from tessera.functions.xml import parse_xml, xml_join, xml_value, xml_values  # noqa: F401
