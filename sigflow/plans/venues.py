"""Venue search as a batch job over conversations.

Each conversation is one search request; its assistant turns are the
retrieved articles, and the venue records are the JSON arrays written in
them. The given conversations hold none, so there every request ends with the
fallback record; texts with records are covered by the tests.

requests:  conversation -> query (last user turn), guest count, location
articles:  first 6 assistant turns per conversation, blank ones skipped
records:   JSON arrays in the articles -> normalised fields
results:   records per request, or the fallback record when there are none
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.functions.text import is_blank
from sigflow.operators.text import (
    cap_items,
    extract_json_array,
    normalise_records,
    search_key,
    with_fallback,
)

KEY = ["conv_id"]


def venue_requests(turns: DataFrame) -> DataFrame:
    """``(conv_id, query, guest_count, budget_range, location)`` per conversation.

    query: newest non-blank user text; guest_count: number of user turns;
    budget_range and location: not asked for (null).
    """
    user_ok = (F.col("role") == "user") & ~is_blank("text")
    return turns.groupBy("conv_id").agg(
        F.max_by(F.when(user_ok, F.col("text")), F.when(user_ok, F.col("turn"))).alias("query"),
        F.count_if(F.col("role") == "user").cast("string").alias("guest_count"),
        F.lit(None).cast("string").alias("budget_range"),
        F.lit(None).cast("string").alias("location"),
    )


def request_keys(turns: DataFrame) -> DataFrame:
    req = venue_requests(turns)
    return req.select(
        "conv_id", search_key(F.col("query"), F.col("guest_count"), F.col("budget_range")).alias("search_key")
    )


def articles(turns: DataFrame) -> DataFrame:
    return cap_items(turns.filter(F.col("role") == "assistant"), KEY, ["turn"])


def venue_records(turns: DataFrame) -> DataFrame:
    """Normalised records found in the kept articles, by (turn, pos)."""
    return normalise_records(extract_json_array(articles(turns)), ["conv_id", "turn"])


def venue_results(turns: DataFrame) -> DataFrame:
    """Normalised records per request, ordered by (turn, pos), with the
    fallback for empty searches. Records and requests come from the same
    turns, so no record is foreign."""
    return with_fallback(
        venue_requests(turns), venue_records(turns), KEY, order_cols=("turn", "pos"), foreign=False
    )
