"""Generation bands (band_edge fixture) and band properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

from sigflow.functions.banding import generation_band

BAND_EDGE = [(-5.0, "Low"), (199.9, "Low"), (200.0, "Medium"), (599.9, "Medium"),
             (600.0, "High"), (999.9, "High"), (1000.0, "Exceptional"), (None, "Exceptional"),
             (float("nan"), "Exceptional")]

ORDER = {"Low": 0, "Medium": 1, "High": 2, "Exceptional": 3}


def test_band_edge(spark):
    df = spark.createDataFrame([(v,) for v, _ in BAND_EDGE], "p double")
    got = [r.b for r in df.select(generation_band("p").alias("b")).collect()]
    assert got == [b for _, b in BAND_EDGE]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=20, max_size=60))
def test_band_total_and_monotone(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "p double")
    rows = df.select("p", generation_band("p").alias("b")).collect()
    assert all(r.b in ORDER for r in rows)
    ordered = sorted(rows, key=lambda r: r.p)
    ranks = [ORDER[r.b] for r in ordered]
    assert ranks == sorted(ranks)
