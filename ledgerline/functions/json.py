"""Fields of JSON held in text columns (H-json1..H-json5, A4).

The text is parsed into a VARIANT with ``try_parse_json`` (malformed text gives NULL
instead of failing the job) and fields are read from it with ``try_variant_get``, which
walks the binary VARIANT without re-reading the text.

Parse once: a query that *filters* on JSON fields must not repeat the parse.  Catalyst
pushes a filter below the projection that defines the fields, substituting each field's
expression into the predicate, and a filter evaluates every copy (it has no
common-subexpression elimination).  ``with_parsed_json`` therefore adds the parsed VARIANT
as the output of a one-row generator: predicates on fields read from a generator's output
stay above it, and each row is parsed exactly once.  The ``variant_*`` helpers then read
fields from that column; the ``json_*`` helpers are the same readers applied to text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions._util import to_col


def parse_json_text(col) -> Column:
    """The VARIANT of a JSON text, NULL for malformed text.  An object that repeats a member
    keeps the last one (without the setting it would be malformed as a whole)."""
    SparkSession.active().conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return F.try_parse_json(to_col(col))


def with_parsed_json(df: DataFrame, col: str, alias: str) -> DataFrame:
    """``df`` plus column ``alias``: the VARIANT parsed from text column ``col``,
    evaluated once per row (see the module note)."""
    parsed = F.struct(parse_json_text(col).alias(alias))
    return df.select("*", F.inline(F.array(parsed)))


def variant_value(v, path: str) -> Column:
    """Scalar at ``path`` as text; objects, arrays and JSON null give NULL.

    Strings come back unquoted, numbers and booleans as their text (a number is
    rendered from its parsed value, so ``1.50`` reads ``1.5``)."""
    v = to_col(v)
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(~nested | kind.isNull(), F.try_variant_get(v, path, "string"))


def variant_text(v, key: str) -> Column:
    """Value of top-level ``key`` as text, objects and arrays as JSON text (the
    ``->>`` operator).  ``key`` is a literal member name, not a path."""
    escaped = key.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(to_col(v), f"$['{escaped}']", "string")


def variant_array(v, path: str) -> Column:
    """Array at ``path`` as ``array<string>`` of JSON texts; NULL when absent or not an
    array, so an inner unnest of it gives no rows."""
    items = F.try_variant_get(to_col(v), path, "array<variant>")
    return F.transform(items, lambda x: F.to_json(x))


def json_value(col, path: str) -> Column:
    """``variant_value`` read from JSON text (``JSON_VALUE``)."""
    return variant_value(parse_json_text(col), path)


def json_text(col, key: str) -> Column:
    """``variant_text`` read from JSON text (``text::JSON ->> key``)."""
    return variant_text(parse_json_text(col), key)


def json_array(col, path: str) -> Column:
    """``variant_array`` read from JSON text (``JSON_QUERY_ARRAY``)."""
    return variant_array(parse_json_text(col), path)


# ---------------------------------------------------------------- numbers as they are written
# A VARIANT holds a number's value, so ``1.50`` and ``1.5`` come out alike, ``1e2`` as 100.0
# and over 38 digits rounded.  The readers below give a number's own text instead: before
# the parse every number outside a string is turned into a string that starts with a mark,
# and the mark is taken off what is read.  It is one regular expression over the text and
# still one parse of a row.  A number that JSON does not allow (``01``, ``+1``, ``.5``) is left
# as it is, so the text stays malformed.
#
# U+0001 to U+0005 serve as marks: JSON allows no control character as such, so a text that
# has one is malformed anyway.  (A string that itself begins with an escaped U+0001 is the
# one value that loses a character.)
_NUMBER = r"(?<![0-9A-Za-z.+-])-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?(?![0-9A-Za-z.+-])"
_MARK, _OPEN, _CLOSE, _QUOTE, _BACKSLASH = "\x01", "\x02", "\x03", "\x04", "\x05"


def quote_numbers(text) -> Column:
    """A JSON text whose numbers are strings: a mark and the number as it is written."""
    text = to_col(text)

    def swap(col: Column, old: str, new: str) -> Column:
        return F.replace(col, F.lit(old), F.lit(new))

    # without escapes a string ends at the next quote, so strings are passed over whole
    plain = swap(swap(text, "\\\\", _BACKSLASH), '\\"', _QUOTE)
    marked = F.regexp_replace(plain, rf'("[^"]*+")|({_NUMBER})', f"$1{_OPEN}$2{_CLOSE}")
    quoted = swap(swap(swap(marked, _OPEN + _CLOSE, ""), _OPEN, '"\\u0001'), _CLOSE, '"')
    escaped = swap(swap(quoted, _QUOTE, '\\"'), _BACKSLASH, "\\\\")
    return F.when(~text.rlike("[\x01-\x05]"), escaped)


def with_exact_json(df: DataFrame, col: str, alias: str) -> DataFrame:
    """``with_parsed_json`` for the ``exact_*`` readers."""
    parsed = F.struct(parse_json_text(quote_numbers(col)).alias(alias))
    return df.select("*", F.inline(F.array(parsed)))


def _unmarked(nested: Column) -> Column:
    """The JSON text of an object or array with its numbers as they were written."""
    return F.regexp_replace(nested, r'"\\u0001([^"]*)"', "$1")


def exact_value(v, path: str) -> Column:
    """``variant_value`` with a number's own text (``1.50`` stays ``1.50``)."""
    return F.regexp_replace(variant_value(v, path), f"^{_MARK}", "")


def exact_text(v, key: str) -> Column:
    """``variant_text`` with numbers' own text, also within objects and arrays."""
    text = variant_text(v, key)
    nested = text.startswith("{") | text.startswith("[")
    return F.when(nested, _unmarked(text)).otherwise(F.regexp_replace(text, f"^{_MARK}", ""))


def exact_array(v, path: str) -> Column:
    """``variant_array`` with numbers' own text."""
    return F.transform(variant_array(v, path), _unmarked)
