"""Message packing and parsing (msg_edge fixture)."""

from pyspark.sql import functions as F

from sigflow.operators.shape import flatten_messages, pack_messages, parse_messages, shape_readings
from sigflow.schemas import GENERIC_MESSAGE_SCHEMA, RAW_CSV_SCHEMA, RAW_TIME, SIGNAL_KEYS


def test_pack_omits_null_fields(spark):
    raw = spark.createDataFrame(
        [("01 01 2018 00:10", 380.0477905, None, 416.3289078, 259.9949036)], RAW_CSV_SCHEMA
    )
    value = pack_messages(raw).first()["value"]
    assert "Wind Speed" not in value
    assert value.startswith('{"Date/Time":"01 01 2018 00:10","LV ActivePower (kW)":380.0477905')


def test_parse_edge_messages(spark):
    msgs = spark.createDataFrame(
        [(None,), ("",), ("not json",), ("{}",),
         ('{"Date/Time": null, "LV ActivePower (kW)": 1.0E10}',),
         ('{"Date/Time": "01 01 2018 00:10", "extra": 1, "Wind Speed (m/s)": 5.5}',)],
        "value string",
    )
    parsed = parse_messages(msgs)
    rows = parsed.select(F.col(f"data.`{RAW_TIME}`").alias("t"),
                         F.col("data.`LV ActivePower (kW)`").alias("p"),
                         F.col("data.`Wind Speed (m/s)`").alias("w")).collect()
    # null and empty messages are dropped; junk and {} stay as all-null structs
    assert len(rows) == 4
    texts = sorted((r.t or "", r.p or "", r.w or "") for r in rows)
    assert ("", "1.0E10", "") in texts  # number text kept as written
    assert ("01 01 2018 00:10", "", "5.5") in texts
    assert texts.count(("", "", "")) == 2
    assert parse_messages(msgs, strict=True).count() == 1


def test_shape_map_never_null(spark):
    msgs = spark.createDataFrame([("not json",), ('{"Date/Time": "01 01 2018 00:10"}',)], "value string")
    shaped = shape_readings(parse_messages(msgs)).collect()
    assert all(r.signals is not None for r in shaped)
    assert all(sorted(r.signals.keys()) == sorted(SIGNAL_KEYS) for r in shaped)
    assert all(v is None for r in shaped for v in r.signals.values())


def test_create_ts_constant_in_batch(spark):
    msgs = spark.createDataFrame([('{"Date/Time": "01 01 2018 00:%02d"}' % i,) for i in range(50)],
                                 "value string").repartition(4)
    out = shape_readings(parse_messages(msgs))
    assert out.select("create_ts").distinct().count() == 1


def test_flatten_generic(spark):
    msgs = spark.createDataFrame([('{"id": "a", "value": 2.5}',), ('{"id": "b"}',)], "value string")
    rows = sorted(flatten_messages(msgs, GENERIC_MESSAGE_SCHEMA).collect())
    assert [tuple(r) for r in rows] == [("a", 2.5), ("b", None)]


def test_blank_message_test_agrees_with_parser(spark):
    from sigflow.schemas import MESSAGE_SCHEMA

    cases = [None, "", " ", "\n", "\t \r\n", "\x0b", "\x00", "\x1f", " ", "　", " \x0b ", "null",
             "[]", "{}", "x", " {} ", "\r", " \u0085", "\u2028", "\r\u2029", "\n\u0085"]
    df = spark.createDataFrame([(c,) for c in cases], "value string")
    want = df.filter(F.from_json("value", MESSAGE_SCHEMA).isNotNull()).count()
    assert parse_messages(df).count() == want
    plan = parse_messages(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1  # parsed once per message
