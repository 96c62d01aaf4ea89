"""Lenient date/time parsing of the feed text (dates_edge fixture)."""

import datetime as dt

from sigflow.functions.timeparse import parse_signal_date, parse_signal_ts

# (text, expected date, expected timestamp)
DATES_EDGE = [
    ("01 01 2018 00:10", dt.date(2018, 1, 1), dt.datetime(2018, 1, 1, 0, 10)),
    ("1 1 2018 0:5", dt.date(2018, 1, 1), dt.datetime(2018, 1, 1, 0, 5)),
    (" 01 01 2018 00:10", dt.date(2018, 1, 1), dt.datetime(2018, 1, 1, 0, 10)),
    ("01 01 2018 00:10 trailing", dt.date(2018, 1, 1), dt.datetime(2018, 1, 1, 0, 10)),
    ("31 12 2018 23:50", dt.date(2018, 12, 31), dt.datetime(2018, 12, 31, 23, 50)),
    ("01 01 2018", dt.date(2018, 1, 1), None),
    ("32 01 2018 00:10", None, None),
    ("01 13 2018 00:10", None, None),
    ("01 01 2018 24:00", dt.date(2018, 1, 1), None),
    ("29 02 2018 00:10", None, None),
    ("29 02 2020 00:10", dt.date(2020, 2, 29), dt.datetime(2020, 2, 29, 0, 10)),
    ("01/01/2018 00:10", None, None),
    ("", None, None),
    (None, None, None),
]


def test_dates_edge(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in DATES_EDGE], "raw string")
    out = df.select(
        "raw", parse_signal_date("raw").alias("d"), parse_signal_ts("raw").alias("ts")
    ).collect()
    got = {r["raw"]: (r["d"], r["ts"]) for r in out}
    for text, d, ts in DATES_EDGE:
        assert got[text] == (d, ts), text


def test_parse_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", None)
    df = spark.createDataFrame([("99 99 9999 99:99",), ("garbage",)], "raw string")
    rows = df.select(parse_signal_ts("raw").alias("ts")).collect()
    assert [r.ts for r in rows] == [None, None]


def test_shaping_gives_the_same_dates(spark):
    import json

    from sigflow.operators.shape import messages_to_readings

    msgs = spark.createDataFrame([(json.dumps({"Date/Time": t}),) for t, _, _ in DATES_EDGE], "value string")
    got = sorted(((r.signal_date, r.signal_ts) for r in messages_to_readings(msgs).collect()), key=str)
    want = sorted(((d, ts) for _, d, ts in DATES_EDGE), key=str)
    assert got == want


LEGACY_CASES = [
    "01 01 2018 00:10", "01  01 2018 00:10", "01 01  2018 00:10", "01 01 2018  00:10", "01\t01 2018 00:10",
    "01 \t01 2018 00:10", "01 01 18 00:10", "01 01 20180 00:10", "01 01 218 00:10", "001 01 2018 00:10",
    "01 001 2018 00:10", "01 01 2018 000:10", "01 01 2018 00:010", "1 1 2018 0:5", "01 01 2018 00:10:59",
    "01 01 2018 0010", "01 01 2018 00", "01 01 2018 00:", "01 01 2018 24:00", "01 01 2018 23:60",
    "01 01 2018 -1:10", "+1 01 2018 00:10", "01 01 2018 00:10x", "01 01 2018x", "  01 01 2018 00:10",
    "01 01 02018 00:10", "31 04 2018 00:10", "29 02 2020 12:00", "29 02 2019 12:00", "01 13 2018 00:10",
    "00 01 2018 00:10", "01 01 0000 00:10", "01/01/2018 00:10", "", None,
]


def test_matches_spark_legacy_parser(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(c,) for c in LEGACY_CASES], "s string")
    # compare values (days and microseconds since the epoch): date-to-text
    # formatting itself depends on the parser policy
    ours = df.select("s", F.unix_date(parse_signal_date("s")).alias("d"),
                     F.unix_micros(parse_signal_ts("s")).alias("ts")).collect()
    saved = {k: spark.conf.get(k) for k in ("spark.sql.legacy.timeParserPolicy", "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", "LEGACY")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = df.select("s", F.unix_date(F.to_date("s", "dd MM yyyy")).alias("d"),
                           F.unix_micros(F.to_timestamp("s", "dd MM yyyy HH:mm")).alias("ts")).collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert [tuple(r) for r in ours] == [tuple(r) for r in legacy]
