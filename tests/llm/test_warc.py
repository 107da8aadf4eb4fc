import base64
import gzip
import hashlib
import io

import pytest

from ledgerline.llm.common import open_folder, work_dir
from ledgerline.llm.warc import classify, gzip_member, page_record, record, records, register


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, n long")


def round_trip(spark, rows, **kw):
    register(spark)
    path = work_dir(spark, "test-warc")
    classify(pages(spark, rows), **kw).write.format("warc").mode("append").save(path)
    return path, spark.read.format("warc").load(path)


ROWS = [
    (1, "http://a/ü b", "same"), (2, None, "same"), (3, "http://c/\r\nX: y", "same"), (4, "u", "own\r\n\r\nbody"), (5, "u", None),
    (6, "u", ""), (7, "u", "é" * 400_000), (None, "u", "without id"), (8, "u", "twice"), (8, "u", "twice"),
]


def test_round_trip(spark):
    _, read = round_trip(spark, ROWS)
    got = {r.page_id: r for r in read.filter("record_type IN ('response', 'revisit')").collect() if r.page_id}
    for i, _, html in ROWS:
        if i is None:
            continue
        last = max(j for j, _, h in ROWS if j and (h or "") == (html or ""))
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), digest(html))
        assert (r.record_type, r.refers_to) == (("response", None) if i == last else ("revisit", last))
        assert r.payload == ((html or "").encode() if i == last else None)
    assert read.filter("record_type = 'response' AND page_id = 8").count() == 2
    assert read.filter("record_type = 'response' AND page_id IS NULL").count() == 1


def test_small_payloads_are_all_responses(spark):
    _, read = round_trip(spark, ROWS, min_bytes=5)
    kinds = {r.page_id: r.record_type for r in read.filter("page_id < 4").collect()}
    assert kinds == {1: "response", 2: "response", 3: "response"}


def test_filters_and_the_payload_option_reach_the_reader(spark):
    path, read = round_trip(spark, ROWS)
    assert read.filter("record_type = 'revisit' AND refers_to = 3").count() == 2
    plan = read.filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert " Filter (" not in plan
    heads = spark.read.format("warc").option("payload", "false").load(path)
    assert heads.filter("payload IS NOT NULL").count() == 0 and heads.filter("page_id = 7").first().payload_bytes == 800_000


def test_unwanted_members_are_not_inflated():
    made = page_record(1, "u", "response", None, b"x" * 500_000, "d")
    data = gzip_member(made) + gzip_member(page_record(2, "u", "response", None, b"tail", "d"))
    damaged = bytearray(data)
    damaged[len(gzip_member(made)) - 100] ^= 0xFF  # in the payload of the first member
    found = list(records(io.BytesIO(bytes(damaged)), len(data), lambda h: "all" if h["warc-record-id"] == "<urn:page:2>" else "skip"))
    assert len(found) == 1 and found[0][1].endswith(b"tail")


def test_plain_archives_and_gzip_of_other_writers(spark):
    register(spark)
    path = work_dir(spark, "foreign-warc")
    store, base = open_folder(path)
    store.create_dir(base)
    one, two = (page_record(i, "u", "response", None, b"p%d" % i, "d") for i in (1, 2))
    for name, data in (("a.warc", one + two), ("b.warc.gz", gzip.compress(one) + gzip.compress(two))):
        with store.open_output_stream(f"{base}/{name}", compression=None) as f:
            f.write(data)
    got = sorted((r.page_id, bytes(r.payload)) for r in spark.read.format("warc").load(path).collect())
    assert got == [(1, b"p1"), (1, b"p1"), (2, b"p2"), (2, b"p2")]


def test_a_wrong_payload_is_an_error(spark):
    register(spark)
    path = work_dir(spark, "bad-warc")
    store, base = open_folder(path)
    store.create_dir(base)
    with store.open_output_stream(f"{base}/a.warc") as f:
        f.write(page_record(1, "u", "response", None, b"right", "d").replace(b"right", b"wrong"))
    with pytest.raises(Exception, match="digest"):
        spark.read.format("warc").load(path).collect()


def test_empty_table_and_overwrite(spark):
    path, read = round_trip(spark, [])
    assert read.collect() == []
    classify(pages(spark, ROWS[:3])).write.format("warc").mode("append").save(path)
    classify(pages(spark, ROWS[3:4])).write.format("warc").mode("overwrite").save(path)
    assert [r.page_id for r in spark.read.format("warc").load(path).filter("record_type = 'response'").collect()] == [4]


def test_record_layout():
    assert record({"A": "b", "C": None}, b"xy") == b"WARC/1.1\r\nA: b\r\nContent-Length: 2\r\n\r\nxy\r\n\r\n"
