"""Stream-line parsing, the exact JSON check and the text formats."""


import datetime as dt

from pyspark.sql import functions as F

from cartwheel.functions.parsing import _inspect_one
from cartwheel.functions.text import iso_instant_text, kv_payload, python_text, trending_line
from cartwheel.operators.trending import stream_records


def test_stream_records_keeps_only_clean_lines(spark):
    lines = [
        '{"event_type":"click","product_id":"P1","event_time":"2026-07-01T10:00:00Z"}xx',
        '{"event_type":"click","product_id":"P1"',
        '["x"]',
        "7",
        '{"event_type":"click","product_id":7,"event_time":"2026-07-01T10:00:00.123Z"}',
        '{"event_type":"purchase","product_id":"P1","event_time":"2026-07-01T10:00:00Z"}',
        '{"event_type":"click","product_id":"P1","event_time":"2026-07-01"}',
        '{"event_type":"click","product_id":"P1","event_time":"2026-07-01T10:00:00"}',
        '{"event_type":"add_to_cart","product_id":"P2","event_time":"2026-07-01T10:00:00+02:00"}',
        "   ",
        '{"event_type":"click","event_time":"2026-07-01T10:00:00Z"}',
        '{"event_type":"click","product_id":"P3","event_time":"not a time"}',
        '{"event_type":"click","product_id":"P4","event_time":"2026-07-01T10:00:01Z"}\r',
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = sorted((r.event_type, r.product_id, r.event_time) for r in stream_records(df).collect())
    assert got == [
        ("add_to_cart", "P2", dt.datetime(2026, 7, 1, 8, 0, 0)),
        ("click", "7", dt.datetime(2026, 7, 1, 10, 0, 0, 123000)),
        ("click", "P1", dt.datetime(2026, 7, 1, 10, 0, 0)),
        ("click", "P4", dt.datetime(2026, 7, 1, 10, 0, 1)),
    ]


def test_inspect_json_rules():
    assert _inspect_one('{"event_id":"a","event_type":"click"}') == (True, '"a"', True, "click")
    assert _inspect_one('{"event_id":"a","event_type":"click"}xx') == (False, None, False, None)
    assert _inspect_one('[{"event_id":"a"}]') == (False, None, False, None)
    assert _inspect_one("null") == (False, None, False, None)
    assert _inspect_one('{"event_id":"a"}') == (True, '"a"', False, None)
    assert _inspect_one('{"event_id":7,"event_type":"x"}') == (True, "7", True, "x")
    assert _inspect_one('{"event_id":"7","event_type":"x"}')[1] == '"7"'
    assert _inspect_one('{"event_id":7.0,"event_type":"x"}')[1] == "7"
    assert _inspect_one('{"event_id":"null","event_type":"x"}')[1] == '"null"'
    assert _inspect_one('{"event_id":"a","event_type":"x","event_type":"y"}')[3] == "y"


def test_python_text_matches_python_str(spark):
    vals = [205052.0, 1234567890.12, 1e16, 1.5e-5, 0.0001, 12.31, 1e7, -1.5e7, 0.001, 1e22, 2.5e15, 0.0, -0.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", python_text("x").alias("t")).collect():
        assert r.t == str(r.x)


def test_instant_text_and_trending_line(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 7, 1, 10, 0, 30), dt.datetime(2026, 7, 1, 10, 1, 30, 250000), "P1", 7)],
        "s timestamp, e timestamp, p string, n bigint",
    )
    r = df.select(
        iso_instant_text("s").alias("a"), iso_instant_text("e").alias("b"), trending_line("s", "e", "p", "n").alias("l")
    ).first()
    assert r.a == "2026-07-01T10:00:30Z"
    assert r.b == "2026-07-01T10:01:30.250Z"
    assert r.l == "janela=[2026-07-01T10:00:30Z -> 2026-07-01T10:01:30.250Z] produto=P1 eventos=7"


def test_kv_payload_format(spark):
    import base64
    import json

    df = spark.createDataFrame([("P1-1000", "P1", "6")], "k string, p string, n string")
    cells = F.array(
        F.struct(F.lit("produto").alias("column"), F.col("p").alias("value")),
        F.struct(F.lit("eventos").alias("column"), F.col("n").alias("value")),
    )
    text = df.select(kv_payload("k", cells).alias("j")).first().j

    def b64(s):
        return base64.b64encode(s.encode()).decode()

    expected = {"Row": [{"key": b64("P1-1000"), "Cell": [
        {"column": b64("cf:produto"), "$": b64("P1")},
        {"column": b64("cf:eventos"), "$": b64("6")},
    ]}]}
    assert json.loads(text) == expected
    assert text == json.dumps(expected, separators=(",", ":"))


ADVERSARIAL = {
    '{"event_id":"a","event_type":"x"},0]xx': (False, None, False, None),
    '{"event_id":"a","event_type":"x"}]': (False, None, False, None),
    '{"event_id":"a","event_type":"x"}, {"b":1}': (False, None, False, None),
    '{"event_id":"a","event_type":"x"}{"event_id":"b"}': (False, None, False, None),
    "{'event_id':'a','event_type':'x'}": (False, None, False, None),
    '{"event_id":"a","event_type":"x","v":NaN}': (True, '"a"', True, "x"),
    '{"event_id":"a\tb","event_type":"x"}': (True, '"a\\tb"', True, "x"),
    '{"event_id":"a	b","event_type":"x"}': (False, None, False, None),
    '{"k":{"event_id":"n"},"event_id":"a","event_type":"x"}': (True, '"a"', True, "x"),
    '{"event_id":{"z":1},"event_type":"x"}': (False, None, False, None),
    '{"event_id":null,"event_type":"x"}': (True, "null", True, "x"),
    '{"event_id":"a","event_type":[1]}': (True, '"a"', False, None),
    "[" * 3000 + "]" * 3000: (False, None, False, None),
}


def test_inspect_json_edge_lines():
    for line, want in ADVERSARIAL.items():
        assert _inspect_one(line) == want, line


def test_inspect_lines_matches_the_python_rules(spark):
    from cartwheel.operators.reconcile import inspect_lines

    lines = list(ADVERSARIAL)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "pos bigint, line string")
    got = {r.pos: (r.id_ok, r.event_id, r.line_ok, r.event_type) for r in inspect_lines(df).collect()}
    assert [got[i] for i in range(len(lines))] == list(ADVERSARIAL.values())
