"""Property tests: the map expressions against a plain Python model, on
generated events (one Spark job per property, all examples in one frame)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fanwrite.functions import blob_text, decode, drop_empty, encode, put_constants

keys = st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=0x2FF, blacklist_characters="\x7f"), min_size=1, max_size=6)
values = st.one_of(st.none(), st.text(max_size=8))
events = st.lists(st.dictionaries(keys, values, max_size=6), min_size=1, max_size=40)

MAP = "map<string,string>"


def model_blob(ev):
    return "{" + ", ".join(f"{k}={'null' if v is None else v}" for k, v in sorted(ev.items(), key=lambda kv: kv[0].encode())) + "}"


@settings(max_examples=8, deadline=None)
@given(events)
def test_map_expressions_match_model(spark, evs):
    df = spark.createDataFrame([(i, e) for i, e in enumerate(evs)], f"i int, e {MAP}")
    out = df.select(
        "i",
        drop_empty("e").alias("clean"),
        blob_text("e").alias("blob"),
        put_constants("e", {"obscountry": "US"}).alias("enriched"),
        decode(encode(drop_empty("e"))).alias("round_trip"),
    ).orderBy("i").collect()
    for ev, r in zip(evs, out):
        clean = {k: v for k, v in ev.items() if v is not None and v != ""}
        assert r["clean"] == clean
        assert r["blob"] == model_blob(ev)
        assert r["enriched"] == {**ev, "obscountry": "US"}
        assert r["round_trip"] == clean


csv_values = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x17F, blacklist_characters=",\x7f"), max_size=6)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(csv_values, min_size=3, max_size=3), min_size=1, max_size=30))
def test_csv_rows_match_a_comma_split(spark, tmp_path_factory, rows):
    from fanwrite.sources.csv_events import read_csv_events

    path = str(tmp_path_factory.mktemp("csv") / "e.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("EventID(id),Message(msg),TenantName(rv39)\n")
        for i, (a, b, c) in enumerate(rows):
            f.write(f"k{i}{a},{b},{c}\n")
    got = sorted(
        (r["event"]["id"], r["event"]) for r in read_csv_events(spark, path).filter("reason is null").collect()
    )
    want = []
    for i, (a, b, c) in enumerate(rows):
        ev = {k: v for k, v in (("id", f"k{i}{a}"), ("msg", b), ("rv39", c)) if v != ""}
        want.append((ev["id"], ev))
    assert got == sorted(want)
