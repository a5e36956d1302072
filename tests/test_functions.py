"""Column expressions on hand-made events (one case per row of the fixture list)."""

import re

import pytest
from pyspark.sql import functions as F

from fanwrite.functions import (
    blob_text,
    decode,
    digest_key,
    drop_empty,
    encode,
    fields_to_map,
    header_code,
    put_constants,
    restamp_time,
    route,
)
from fanwrite.options import FanoutOptions

MAP = "map<string,string>"


def test_drop_empty_keeps_single_space(spark):
    df = spark.createDataFrame([({"a": "", "b": None, "c": "x", "sun": " "},)], f"e {MAP}")
    out = df.select(drop_empty("e").alias("m")).first()["m"]
    assert out == {"c": "x", "sun": " "}


def test_fields_to_map_leaves_out_null_and_empty(spark):
    df = spark.createDataFrame([("1", None, ""), ("2", "t", " ")], "id string, rv39 string, sun string")
    got = [r["m"] for r in df.select(fields_to_map({"id": "id", "rv39": "rv39", "sun": "sun"}).alias("m")).orderBy("id").collect()]
    assert got == [{"id": "1"}, {"id": "2", "rv39": "t", "sun": " "}]


def test_enrich_overwrites_existing_value(spark):
    df = spark.createDataFrame([({"obscountry": "XX", "a": "1"},), ({"a": "2"},)], f"e {MAP}")
    got = [r["m"] for r in df.select(put_constants("e", {"obscountry": "US"}).alias("m")).collect()]
    assert got == [{"a": "1", "obscountry": "US"}, {"a": "2", "obscountry": "US"}]


def test_enrich_keeps_null_event_null(spark):
    df = spark.createDataFrame([(None,)], f"e {MAP}")
    assert df.select(put_constants("e", {"obscountry": "US"}).alias("m")).first()["m"] is None


def test_restamp_only_when_dt_present(spark):
    df = spark.createDataFrame(
        [({"dt": "old", "a": "1"}, "2024-01-01 10:00:00"), ({"a": "2"}, "2024-01-01 10:00:00")],
        f"e {MAP}, clock string",
    ).withColumn("clock", F.to_timestamp("clock"))
    got = [r["m"] for r in df.select(restamp_time("e", clock="clock").alias("m")).collect()]
    assert got[0] == {"a": "1", "dt": "2024-01-01 04:30:00"}
    assert got[1] == {"a": "2"}


def test_restamp_default_clock_is_now(spark):
    df = spark.createDataFrame([({"dt": "x"},)], f"e {MAP}")
    dt = df.select(restamp_time("e").alias("m")).first()["m"]["dt"]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", dt)


def test_blob_text_sorted_with_null_and_empty(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1", "c": None, "d": ""},)], f"e {MAP}")
    assert df.select(blob_text("e").alias("t")).first()["t"] == "{a=1, b=2, c=null, d=}"


def test_blob_text_empty_and_null_map(spark):
    df = spark.createDataFrame([({},), (None,)], f"e {MAP}")
    assert [r["t"] for r in df.select(blob_text("e").alias("t")).collect()] == ["{}", None]


def test_digest_key_is_uuid_shaped_and_stable(spark):
    df = spark.createDataFrame([("42",), ("42",), (None,)], "id string")
    keys = [r["k"] for r in df.select(digest_key("id").alias("k")).collect()]
    assert keys[0] == keys[1]
    assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", keys[0])
    assert keys[2] is None


def test_route_tenant_single_and_missing(spark):
    df = spark.createDataFrame([("acme",), (None,), ("a/b=c d",)], "t string")
    multi = [r["r"] for r in df.select(route("t", "events", False).alias("r")).collect()]
    single = {r["r"] for r in df.select(route("t", "events", True).alias("r")).collect()}
    assert multi == ["events-acme", "unrouted", "events-a/b=c d"]
    assert single == {"events"}


def test_decode_bad_payloads_are_null(spark):
    data = [("not json",), ('{"a":',), ("[]",), (None,), ("{a=1}",), ('{"a":"1","b":null}',), ('{"n":1.50,"o":{"x":1}}',)]
    got = [r["m"] for r in spark.createDataFrame(data, "v string").select(decode("v").alias("m")).collect()]
    assert got[:5] == [None] * 5
    assert got[5] == {"a": "1", "b": None}
    assert got[6] == {"n": "1.5", "o": '{"x":1}'}


def test_decode_strict_raises(spark):
    from fanwrite.operators.decode import decode_messages

    df = spark.createDataFrame([("not json",)], "value string")
    with pytest.raises(Exception, match="bad row"):
        decode_messages(df, strict=True).collect()


def test_encode_decode_round_trip(spark):
    ev = {"id": "1", "msg": '{"k": "v, w"}', "u": "ü\n"}
    df = spark.createDataFrame([(ev,)], f"e {MAP}")
    assert df.select(decode(encode("e")).alias("m")).first()["m"] == ev


def test_header_code():
    assert header_code("EventID(id)") == "id"
    assert header_code("TenantName(rv39)") == "rv39"
    assert header_code("plain") == "plai"


def test_options_from_flags():
    o = FanoutOptions.from_flags(["-sendToHbase", "-sendToES", "-parallel", "-singleTable", "-duration=5"])
    assert (o.send_to_table, o.send_to_index, o.parallel, o.single_table, o.duration_seconds) == (True, True, True, True, 5)
    assert o.trigger_interval == "5 seconds"
    d = FanoutOptions.from_flags(None)
    assert (d.send_to_table, d.send_to_index, d.duration_seconds, d.layout) == (False, False, 10, "blob")
    with pytest.raises(ValueError):
        FanoutOptions.from_flags(["-bogus"])
    with pytest.raises(ValueError):
        FanoutOptions(layout="tall")


def test_event_time_from_both_text_forms(spark):
    from datetime import datetime

    from fanwrite.functions import event_time

    df = spark.createDataFrame(
        [("Mon Jan 04 12:00:00 IST 2016",), ("2024-01-01 04:30:00",), ("Tue Feb 09 23:59:01 UTC 2016",), ("garbage",), (None,)],
        "t string",
    )
    got = [r["ts"] for r in df.select(event_time("t").alias("ts")).collect()]
    assert got[:3] == [datetime(2016, 1, 4, 6, 30), datetime(2024, 1, 1, 4, 30), datetime(2016, 2, 9, 23, 59, 1)]
    assert got[3:] == [None, None]
