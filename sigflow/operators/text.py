"""Text-record jobs over conversation turns and free-text responses.

Conversations are rows ``(conv_id, turn, role, text)``. Per-conversation
picks (last message, last user message) are grouped aggregates
(``max_by``), which combine partially before the shuffle, so a conversation
with a huge number of turns never has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigflow.functions.text import WS_CLASS, is_blank, strip_text
from sigflow.schemas import (
    CONTACT_DEFAULT,
    DEFAULT_LOCATION,
    FALLBACK_VENUE,
    MAX_RESULTS_PER_SOURCE,
    ROUTE_GENERAL,
    ROUTE_SEARCH,
    ROUTER_KEYWORDS,
    VENUE_SCHEMA,
    VENUE_TEXT_ARRAY_SCHEMA,
)

# First '[', blanks, '{' ... last '}', blanks, ']' (dot matches newlines).
JSON_ARRAY_SPAN = rf"(?s)\[{WS_CLASS}*\{{.*\}}{WS_CLASS}*\]"

VENUE_FIELDS = [f.name for f in VENUE_SCHEMA.fields]


def drop_blank_turns(turns: DataFrame, text_col: str = "text") -> DataFrame:
    """Turns whose text has something besides whitespace."""
    return turns.filter(~is_blank(text_col))


def last_user_turn(
    turns: DataFrame, key: str = "conv_id", user_role: str = "user"
) -> DataFrame:
    """Newest non-blank user message per conversation: ``(key, turn, text)``.
    Conversations without one are absent."""
    users = turns.filter((F.col("role") == user_role) & ~is_blank("text"))
    return users.groupBy(key).agg(
        F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text")
    )


def keyword_hit(text: Column, keywords: list[str]) -> Column:
    """True when the lower-cased text contains any keyword as a substring
    (so "hall" also fires inside "shall")."""
    lowered = F.lower(text)
    hit = F.lit(False)
    for k in keywords:
        hit = hit | lowered.contains(k.lower())
    return F.coalesce(hit, F.lit(False))


def route_intent(
    turns: DataFrame, keywords: list[str] | None = None, key: str = "conv_id"
) -> DataFrame:
    """Route each conversation by its last message (any role):
    ``search_venues_node`` on a keyword hit, else ``general_chat_node``."""
    keywords = ROUTER_KEYWORDS if keywords is None else keywords
    # Only the last message's keyword flag matters, so the flag is computed per
    # row and the text never enters the aggregate: its buffers are fixed-width
    # and the aggregate is hash-based, not a sort of every message.
    flagged = turns.select(key, "turn", keyword_hit(F.col("text"), keywords).alias("hit"))
    last = flagged.groupBy(key).agg(F.max_by("hit", "turn").alias("hit"))
    route = F.when(F.col("hit"), ROUTE_SEARCH).otherwise(ROUTE_GENERAL)
    return last.select(key, route.alias("route"))


# Standard JSON only (the parser otherwise also takes single-quoted strings).
STRICT_JSON = {"allowSingleQuotes": "false"}


def extract_json_array(df: DataFrame, text_col: str = "text", out_col: str = "venues") -> DataFrame:
    """Records from the JSON array embedded in free text.

    The span runs from the first ``[{`` to the last ``}]``. It counts only if
    the whole span is one JSON value: parsed as ``[span,0]`` it must give
    exactly two elements, the second the sentinel ``0``, so text after the
    first array (a second array, stray brackets) makes the span invalid. No
    span, or an invalid one, gives an empty array. The span is cut once per
    row.
    """
    span = F.regexp_extract(F.col(text_col), JSON_ARRAY_SPAN, 0)
    # The check keeps the elements as text in a projection of its own, so the
    # whole span is parsed once; the records are read from its first element.
    wrapped = F.from_json(F.concat(F.lit("["), span, F.lit(",0]")), "array<string>", STRICT_JSON)
    w = F.col("_wrapped")
    single = (F.size(w) == 2) & (F.element_at(w, 2) == "0")
    parsed = F.when(single, F.from_json(F.element_at(w, 1), VENUE_TEXT_ARRAY_SCHEMA, STRICT_JSON))
    empty = F.array().cast(VENUE_TEXT_ARRAY_SCHEMA)
    return (
        df.withColumn("_wrapped", wrapped)
        .withColumn(out_col, F.coalesce(parsed, empty))
        .drop("_wrapped")
    )


# What a scan over brackets may pass over: plain text, escaped characters, and two quotes with
# neither a bracket nor a line end between them, which leave quoted or unquoted as it was.
_PLAIN = r'[^"\\\[\]\n]++|\\.'
# A piece of a text in which brackets are counted: what may be passed over, up to and with the next
# bracket, line end or quote. Each piece starts where the last one ended (no second try further on).
_PIECES = rf'(?s)\G(?:{_PLAIN}|"(?:{_PLAIN})*+")*+["\[\]\n]'
_ARRAY_OF_OBJECTS = rf"(?s)^\[{WS_CLASS}*\{{.*\}}{WS_CLASS}*\]$"


def json_array_spans(text: Column) -> Column:
    """All balanced ``[{...}]`` spans of a text, in order, as strings.

    A scan over brackets: each closing bracket belongs to the last one that is
    still open, so nested arrays stay inside their span and a bracket that is
    never closed hides nothing after it. Within brackets, quoted text is skipped
    up to its closing quote or the end of the line (JSON strings hold no line
    ends), so brackets in strings don't count; an apostrophe or a quote in prose
    outside of brackets means nothing. Spans inside another span are part of it.
    Texts without ``[{`` are not scanned, others once: what follows the scan
    works on its result alone, as an expression named twice in higher-order
    functions is computed twice.
    """
    opens = F.array().cast("array<int>")
    spans = F.array().cast("array<struct<a:int,b:int>>")
    start = F.struct(
        F.lit(1).alias("at"), opens.alias("open"), F.lit(False).alias("quoted"), spans.alias("spans"),
    )

    def step(state: Column, piece: Column) -> Column:
        after = (state.at + F.length(piece)).cast("int")
        inside = F.size(state.open) > 0
        span = F.struct(F.element_at(state.open, -1).alias("a"), (after - 1).alias("b"))

        def moved(opened: Column = state.open, quoted: Column = state.quoted, found: Column = state.spans) -> Column:
            return F.struct(after.alias("at"), opened.alias("open"), quoted.alias("quoted"), found.alias("spans"))

        return (
            F.when(~state.quoted & piece.endswith("["), moved(opened=F.array_append(state.open, after - 1)))
            .when(
                ~state.quoted & piece.endswith("]") & inside,
                moved(opened=F.slice(state.open, 1, F.size(state.open) - 1), found=F.array_append(state.spans, span)),
            )
            .when(piece.endswith('"') & inside, moved(quoted=~state.quoted))
            .when(piece.endswith("\n"), moved(quoted=F.lit(False)))
            .otherwise(moved())
        )

    def outermost(found: Column) -> Column:
        """Texts of the spans of objects that lie in no other one, in order."""
        texts = F.transform(found, lambda s: F.struct(s.a.alias("a"), F.substring(text, s.a, s.b - s.a + 1).alias("t")))
        arrays = F.filter(texts, lambda s: s.t.rlike(_ARRAY_OF_OBJECTS))
        # a span closes before those around it: from the last one back, one that starts after a kept one lies in it
        none = F.struct(F.lit(None).cast("int").alias("a"), F.array().cast("array<string>").alias("kept"))
        return F.aggregate(
            F.reverse(arrays), none,
            lambda state, s: F.when(
                state.a.isNull() | (s.a < state.a), F.struct(s.a.alias("a"), F.array_append(state.kept, s.t).alias("kept"))
            ).otherwise(state),
            lambda state: F.reverse(state.kept),
        )

    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    found = F.aggregate(pieces, start, step, lambda s: outermost(s.spans))
    none = F.array().cast("array<string>")
    return F.when(text.rlike(rf"\[{WS_CLASS}*\{{"), found).otherwise(none)


def extract_json_arrays(df: DataFrame, text_col: str = "text", out_col: str = "venue_lists") -> DataFrame:
    """Every JSON array of records embedded in free text, in order: an array of arrays.

    The greedy rule of :func:`extract_json_array` takes one span and gives nothing
    for a text with two arrays; here each balanced span (:func:`json_array_spans`)
    is parsed by itself, under the same strict parser, and those that are no JSON
    array are left out. A text whose single array the greedy rule finds gives
    that array alone.
    """
    # The check keeps the elements as text in a step of its own, so each span is parsed once
    # (see extract_json_array).
    wrapped = F.transform(
        json_array_spans(F.col(text_col)),
        lambda span: F.from_json(F.concat(F.lit("["), span, F.lit(",0]")), "array<string>", STRICT_JSON),
    )
    parsed = F.transform("_wrapped", _strict_array)
    return (
        df.withColumn("_wrapped", wrapped)
        .withColumn(out_col, F.filter(parsed, lambda x: x.isNotNull()))
        .drop("_wrapped")
    )


def _strict_array(wrapped: Column) -> Column:
    """Records of a span that is one JSON array, else null; ``wrapped`` has the elements of ``[span,0]``."""
    single = (F.size(wrapped) == 2) & (F.get(wrapped, F.lit(1)) == "0")
    return F.when(single, F.from_json(F.get(wrapped, F.lit(0)), VENUE_TEXT_ARRAY_SCHEMA, STRICT_JSON))


def normalise_records(
    df: DataFrame, id_cols: list[str], venues_col: str = "venues"
) -> DataFrame:
    """One row per record with defaults for the optional fields: image "",
    phone and email "Contact for details", amenities and features a
    one-element list of that text. Required fields stay as given; the rating,
    written as a number or as quoted text, becomes a double."""
    # The outer form keeps Catalyst from inferring a "non-empty" filter and
    # pushing it below the projection that builds the array, which would
    # evaluate the extraction twice per row.
    exploded = df.select(*id_cols, F.posexplode_outer(venues_col).alias("pos", "v")).filter(
        F.col("pos").isNotNull()
    )
    contact = F.lit(CONTACT_DEFAULT)
    contact_list = F.array(contact)
    return exploded.select(
        *id_cols,
        "pos",
        F.col("v.name").alias("name"),
        F.col("v.location").alias("location"),
        F.col("v.capacity").alias("capacity"),
        F.col("v.priceRange").alias("priceRange"),
        F.col("v.rating").try_cast("double").alias("rating"),
        F.col("v.description").alias("description"),
        F.coalesce(F.col("v.image"), F.lit("")).alias("image"),
        F.coalesce(F.col("v.phone"), contact).alias("phone"),
        F.coalesce(F.col("v.email"), contact).alias("email"),
        F.coalesce(F.col("v.amenities"), contact_list).alias("amenities"),
        F.coalesce(F.col("v.features"), contact_list).alias("features"),
    )


def search_key(query: Column, guest_count: Column, budget_range: Column) -> Column:
    """``"{query} {guests} {budget}"`` stripped at the ends; a missing part is
    empty text."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (query, guest_count, budget_range)]
    return strip_text(F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2]))


def cap_items(
    items: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    n: int = MAX_RESULTS_PER_SOURCE,
    text_col: str = "text",
) -> DataFrame:
    """First ``n`` items per group in order, then blank items skipped (in
    that order, so a blank item still uses up a place).

    ``row_number() <= n`` lets Spark insert a partial group limit before
    the shuffle: each task forwards at most ``n`` rows per group.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    ranked = items.withColumn("_rank", F.row_number().over(w))
    return ranked.filter(F.col("_rank") <= n).filter(~is_blank(text_col)).drop("_rank")


def fallback_venue(location: Column) -> Column:
    """The default record, at the caller's location when one is given."""
    loc = F.when(location.isNull() | (location == ""), F.lit(DEFAULT_LOCATION)).otherwise(location)
    fields = []
    for name in VENUE_FIELDS:
        if name == "location":
            fields.append(loc.alias(name))
        elif isinstance(FALLBACK_VENUE[name], list):
            fields.append(F.array(*[F.lit(x) for x in FALLBACK_VENUE[name]]).alias(name))
        else:
            fields.append(F.lit(FALLBACK_VENUE[name]).alias(name))
    return F.struct(*fields)


def with_fallback(
    requests: DataFrame,
    records: DataFrame,
    key_cols: list[str],
    location_col: str = "location",
    order_cols: tuple[str, ...] = ("pos",),
    foreign: bool = True,
) -> DataFrame:
    """Records for each request, or the fallback record when it has none.

    Written as (records of known requests) UNION (fallback for requests
    without records) rather than an outer join: the anti join only needs the
    distinct record keys, so a request with a huge number of records costs
    one key on that side, never a skewed join partition. With ``foreign``
    false the caller vouches that every record belongs to a request, and the
    records are not joined at all. ``order_cols`` place the records of a
    request; the fallback record has 0 in each.
    """
    found = records
    if foreign:
        found = records.join(requests.select(*key_cols).distinct(), key_cols, "left_semi")
    record_keys = records.select(*key_cols).distinct()
    missing = requests.join(record_keys, key_cols, "left_anti")
    places = [F.lit(0).cast(records.schema[c].dataType).alias(c) for c in order_cols]
    fallback = missing.select(
        *key_cols, *places, fallback_venue(F.col(location_col)).alias("v")
    ).select(*key_cols, *order_cols, *[F.col(f"v.{f}").alias(f) for f in VENUE_FIELDS])
    return found.select(*key_cols, *order_cols, *VENUE_FIELDS).unionByName(fallback)
