"""Column helpers: JSON fields, surrogate keys, tag status."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.json import json_array, json_text, json_value
from ledgerline.functions.keys import link, surrogate_key
from ledgerline.functions.text import tag_status

JSON_CASES = [
    ('{"a":"x"}', "x", "x"),
    ('{"a":""}', "", ""),
    ('{"a":null}', None, None),
    ("{}", None, None),
    ('{"a":{"b":1}}', None, '{"b":1}'),
    ('{"a":[1,2]}', None, "[1,2]"),
    ('{"a":true}', "true", "true"),
    ('{"a":1.50}', "1.5", "1.5"),
    ("{bad", None, None),
]


@pytest.mark.parametrize("text,value,as_text", JSON_CASES)
def test_json_value_and_text(spark, text, value, as_text):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(json_value("t", "$.a").alias("v"), json_text("t", "a").alias("x")).first()
    assert (r.v, r.x) == (value, as_text)


def test_json_nested_path_and_array(spark):
    df = spark.createDataFrame([('{"x":{"source":"s"},"l":[{"n":1},{"n":2}]}',)], "t string")
    r = df.select(
        json_value("t", "$.x.source").alias("s"), json_array("t", "$.l").alias("l"),
        json_array("t", "$.missing").alias("m"),
    ).first()
    assert r.s == "s"
    assert r.l == ['{"n":1}', '{"n":2}']
    assert r.m is None


def test_surrogate_key_digests(spark):
    df = spark.createDataFrame([(1, 7, "ac-gst-report-internal")], "a long, b long, c string")
    assert df.select(surrogate_key("a", "b", "c")).first()[0] == "96e2833bf16fc38a9176a81432886a8f"
    df = spark.createDataFrame([(1,)], "a long").select(
        "a", F.lit(None).cast("long").alias("b"), F.lit("2024-01-01").cast("date").alias("c")
    )
    assert df.select(surrogate_key("a", "b", "c")).first()[0] == "7a9587791c119641e8dcd99e56c1895c"


def test_link_null_gives_null(spark):
    df = spark.createDataFrame([(5,), (None,)], "id long")
    assert [r[0] for r in df.select(link("p/", "id")).collect()] == ["p/5", None]


def test_tag_status_first_match_wins(spark):
    df = spark.createDataFrame(
        [("x,mia",), ("paidStrikeOff",), ("ndStrikeOff",), ("mia,ndStrikeOff",), ("none",), (None,)],
        "t string",
    )
    got = [r[0] for r in df.select(tag_status("t")).collect()]
    assert got == ["mia", "paidStrikeOff", "ndStrikeOff", "mia", None, None]


EXACT_CASES = [
    ('{"a":1.50}', "1.50", "1.50"),
    ('{"a" : 1.5 }', "1.5", "1.5"),
    ('{"a":1e2}', "1e2", "1e2"),
    ('{"a":-0.0}', "-0.0", "-0.0"),
    ('{"a":1234567890123456789012345678901234567890.10}',) + ("1234567890123456789012345678901234567890.10",) * 2,
    ('{"a":"1.50"}', "1.50", "1.50"),
    ('{"a":"x 1, 2: 3 \\\\ \\" 4"}', 'x 1, 2: 3 \\ " 4', 'x 1, 2: 3 \\ " 4'),
    ('{"a":"\\\\","b":1}', "\\", "\\"),
    ('{"b":"\\"","a":7.0}', "7.0", "7.0"),
    ('{"a":"\\u00e9\\n1"}', "é\n1", "é\n1"),
    ('{"a":"[1.0]"}', "[1.0]", "[1.0]"),
    ('{"a":{"b":[1.50,"2.0",3E+1]}}', None, '{"b":[1.50,"2.0",3E+1]}'),
    ('{"a":[1.0,{"c":-2.00}]}', None, '[1.0,{"c":-2.00}]'),
    ('{"a":1.0,"a":2.00}', "2.00", "2.00"),
    ('{"a":true,"b":1}', "true", "true"),
    ('{"a":null}', None, None),
    ("{}", None, None),
    ('{"a":01}', None, None),
    ('{"a":+1}', None, None),
    ('{"a":.5}', None, None),
    ('{"a":1.}', None, None),
    ('{"a":1e}', None, None),
    ('{"a":1-2}', None, None),
    ('{"a":"\x02"}', None, None),
    ("{bad 1", None, None),
    ("", None, None),
    (None, None, None),
    ('{"a":"' + '\\"' * 50_000 + '","b":[' + ",".join(['"x"', "1.0"] * 20_000) + "]}", '"' * 50_000, '"' * 50_000),
]


def test_exact_json_keeps_a_numbers_own_text(spark):
    from ledgerline.functions.json import exact_text, exact_value, with_exact_json

    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(EXACT_CASES)], "i int, t string")
    rows = with_exact_json(df, "t", "p").select("i", exact_value("p", "$.a").alias("v"), exact_text("p", "a").alias("x")).collect()
    for r in rows:
        assert (r.v, r.x) == EXACT_CASES[r.i][1:], EXACT_CASES[r.i][0]
    assert len(rows) == len(EXACT_CASES)


def test_exact_json_nested_path_and_array(spark):
    from ledgerline.functions.json import exact_array, exact_value, with_exact_json

    df = spark.createDataFrame([('{"x":{"n":0.10},"l":[{"n":1.0},2.50,"s",[1e1]]}',)], "t string")
    r = with_exact_json(df, "t", "p").select(
        exact_value("p", "$.x.n").alias("n"), exact_array("p", "$.l").alias("l"), exact_array("p", "$.m").alias("m")
    ).first()
    assert (r.n, r.m) == ("0.10", None) and r.l == ['{"n":1.0}', "2.50", '"s"', "[1e1]"]


def test_exact_json_agrees_with_the_parsed_values(spark):
    """Away from numbers both readers give the same."""
    from ledgerline.functions.json import exact_text, exact_value, with_exact_json

    cases = [c for c, *_ in JSON_CASES if "1" not in (c or "")]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    for r in with_exact_json(df, "t", "p").select(
        json_value("t", "$.a").alias("v"), exact_value("p", "$.a").alias("ev"), json_text("t", "a").alias("x"), exact_text("p", "a").alias("ex")
    ).collect():
        assert (r.v, r.x) == (r.ev, r.ex)
