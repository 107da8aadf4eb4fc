"""Column -> Column helpers.  All are built-in Spark expressions (no Python UDF)."""

from ledgerline.functions.dates import active_at, as_date, month_end_of, quarter_end_of
from ledgerline.functions.json import json_array, json_text, json_value, parse_json_text
from ledgerline.functions.keys import link, surrogate_key
from ledgerline.functions.text import tag_status

__all__ = [
    "active_at",
    "as_date",
    "json_array",
    "json_text",
    "json_value",
    "link",
    "month_end_of",
    "parse_json_text",
    "quarter_end_of",
    "surrogate_key",
    "tag_status",
]
