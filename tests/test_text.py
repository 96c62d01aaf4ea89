"""Text jobs: blank_turns, json_text and requests fixtures."""

from pyspark.sql import functions as F

from sigflow.operators import text
from sigflow.schemas import CONTACT_DEFAULT, DEFAULT_LOCATION, FALLBACK_VENUE

TURNS = "conv_id long, turn long, role string, text string"


def test_blank_turns(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "find a hall"), (1, 1, "assistant", "ok"), (1, 2, "user", "  \t　"),
         (2, 0, "system", "be nice"), (2, 1, "assistant", "hello"), (3, 0, "user", None),
         (3, 1, "user", " x ")],
        TURNS,
    )
    kept = {(r.conv_id, r.turn) for r in text.drop_blank_turns(df).collect()}
    assert kept == {(1, 0), (1, 1), (2, 0), (2, 1), (3, 1)}
    last = {r.conv_id: (r.turn, r.text) for r in text.last_user_turn(df).collect()}
    assert last == {1: (0, "find a hall"), 3: (1, " x ")}  # conv 2 has no user turn
    routes = {r.conv_id: r.route for r in text.route_intent(df).collect()}
    # last message of conv 1 is blank -> general; conv 2 "hello" -> general; conv 3 none
    assert routes == {1: "general_chat_node", 2: "general_chat_node", 3: "general_chat_node"}
    routes = {r.conv_id: r.route for r in text.route_intent(df, ["hell"]).collect()}
    assert routes[2] == "search_venues_node"


def test_router_substring_semantics(spark):
    df = spark.createDataFrame([(1, 0, "user", "You SHALL pass")], TURNS)
    assert text.route_intent(df).first().route == "search_venues_node"  # "hall" in "shall"


JSON_TEXT = [
    (1, 'Here: [{"name": "A", "rating": 4.5, "amenities": ["x"]}] done'),
    (2, "no array here"),
    (3, "broken [ {\"name\": \"A\", } ]"),
    (4, '[{"name": "A"}] and [{"name": "B"}]'),
    (5, '[\n {"name": "C", "phone": null}\n]'),
    (6, None),
    (7, "[{'name': 'single quotes'}]"),
    (8, 'x [{"name": "D"}], [{"name": "E"}] y'),
    (9, '[{"name": "F", "note": "a ] b"}]'),
    (10, '[{"name": "G", "rating": "4.5", "capacity": 300}]'),
]


def test_extract_json_array(spark):
    df = spark.createDataFrame(JSON_TEXT, "id long, text string")
    out = {r.id: [v.name for v in r.venues] for r in text.extract_json_array(df).collect()}
    assert out[1] == ["A"] and out[2] == [] and out[3] == [] and out[5] == ["C"] and out[6] == []
    assert out[7] == [] and out[8] == [] and out[9] == ["F"]
    assert out[4] == []  # two arrays: the span is not one JSON value


def brute_spans(t):
    """Bracket by bracket: spans of balanced brackets that hold objects, the outermost ones."""
    import re

    found, open_at, quoted, k = [], [], False, 0
    while k < len(t):
        c = t[k]
        if c == "\\" and k + 1 < len(t):
            k += 2
            continue
        if c == '"' and open_at:
            quoted = not quoted
        elif c == "\n":
            quoted = False
        elif c == "[" and not quoted:
            open_at.append(k)
        elif c == "]" and not quoted and open_at:
            found.append((open_at.pop(), k))
        k += 1
    arrays = [(a, b) for a, b in found if re.fullmatch(r"\[\s*\{.*\}\s*\]", t[a : b + 1], re.S)]
    outer = [(a, b) for a, b in arrays if not any(x < a and y > b for x, y in arrays)]
    return [t[a : b + 1] for a, b in sorted(outer)]


def test_json_array_spans_match_a_plain_scan(spark):
    import random

    rng = random.Random(8)
    parts = ["[", "]", "{", "}", '"', "\\", "\n", " ", "a", "é", '[{"name":"A"}]', '{"x":[1]}', "[{", "}]", '\\"', ","]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.s for r in df.select("id", text.json_array_spans(F.col("text")).alias("s")).collect()}
    assert got == {k: brute_spans(t) for k, t in enumerate(texts)}


def test_extract_json_arrays(spark):
    more = JSON_TEXT + [
        (11, 'it\'s [1] "odd [ {"name": "never closed" and [{"name": "H"}]'),
        (12, '[{"name": "I", "amenities": ["x", "y]"]}, {"name": "J"}] [{"name": "K"}]'),
        (13, '[{bad}] [{"name": "L"}]'), (14, ""), (15, '[[{"name": "M"}]]'), (16, "[]"),
        (17, '[{"name": "a \\"quoted [\\" name"}]'), (18, "x" * 100_000 + '[{"name": "N"}]' + "[" * 1_000),
    ]
    df = spark.createDataFrame(more, "id long, text string")
    out = {r.id: [[v.name for v in a] for a in r.venue_lists] for r in text.extract_json_arrays(df).collect()}
    assert out[4] == [["A"], ["B"]] and out[8] == [["D"], ["E"]]
    assert out[11] == [["H"]] and out[12] == [["I", "J"], ["K"]] and out[13] == [["L"]] and out[15] == [["M"]]
    assert out[17] == [['a "quoted [" name']] and out[18] == [["N"]]
    assert [out[k] for k in (2, 3, 6, 7, 14, 16)] == [[]] * 6
    # where the greedy rule finds an array, it is the only one
    greedy = {r.id: [v.name for v in r.venues] for r in text.extract_json_array(df).collect()}
    assert all(out[k] == [v] for k, v in greedy.items() if v and k != 15)
    assert text.extract_json_arrays(df.limit(0)).collect() == []


def test_json_arrays_scan_and_parse_once(spark):
    """A text is scanned once, in few pieces, and each of its spans is parsed once."""
    record = '{"name":"part [1]","capacity":"12","rating":1,"phone":"supplier 3"}'
    note = f'Returned [see 1], the 12" ones:\n[{",".join([record] * 8)}]\nnot returned: [{record}] [end'
    df = spark.createDataFrame([(1, note)], "id long, text string")
    out = text.extract_json_arrays(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("from_json(") == 2
    assert [len(a) for a in out.first().venue_lists] == [8, 1]
    pieces = df.select(F.regexp_extract_all("text", F.lit(text._PIECES), F.lit(0)).alias("p")).first().p
    assert len(pieces) <= 4 * 9 + 8 and note.startswith("".join(pieces))


def test_json_array_spans_of_long_texts(spark):
    inner = ",".join(['"a\\n[\\"b"'] * 20_000)
    texts = ["x" * 200_000, "[{" + "\\a" * 100_000, f'"" [{{"v":[{inner}]}}] ' + '"b"' * 50_000, "[{}]" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.s for r in df.select("id", text.json_array_spans(F.col("text")).alias("s")).collect()}
    assert got == {0: [], 1: [], 2: [texts[2][3 : texts[2].rindex("]") + 1]], 3: ["[{}]"] * 500}


def test_normalise_defaults(spark):
    df = text.extract_json_array(spark.createDataFrame(JSON_TEXT, "id long, text string"))
    rows = {r.id: r for r in text.normalise_records(df, ["id"]).collect()}
    r = rows[1]
    assert (r.image, r.phone, r.email) == ("", CONTACT_DEFAULT, CONTACT_DEFAULT)
    assert r.amenities == ["x"] and r.features == [CONTACT_DEFAULT] and r.rating == 4.5
    assert rows[5].phone == CONTACT_DEFAULT  # explicit null is defaulted too
    assert rows[10].rating == 4.5 and rows[10].capacity == "300"  # quoted number, number as text
    assert 2 not in rows


def test_search_key(spark):
    df = spark.createDataFrame([("garden", "200", None), (None, None, None), (" x ", "", "cheap\n")],
                               "q string, g string, b string")
    got = [r.k for r in df.select(text.search_key(F.col("q"), F.col("g"), F.col("b")).alias("k")).collect()]
    assert got == ["garden 200", "", "x   cheap"]


def test_cap_items_then_skip_blank(spark):
    rows = [(1, t, "assistant", "" if t == 2 else f"a{t}") for t in range(9)]
    out = text.cap_items(spark.createDataFrame(rows, TURNS), ["conv_id"], ["turn"], n=6)
    assert sorted(r.turn for r in out.collect()) == [0, 1, 3, 4, 5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fallback(spark):
    requests = spark.createDataFrame([(1, "Delhi"), (2, None), (3, ""), (4, "Pune")], "conv_id long, location string")
    recs = text.normalise_records(
        text.extract_json_array(spark.createDataFrame([(1, '[{"name": "V1"}, {"name": "V2"}]'), (9, '[{"name": "Z"}]')],
                                                      "conv_id long, text string")),
        ["conv_id"],
    )
    out = text.with_fallback(requests, recs, ["conv_id"]).collect()
    by = {}
    for r in out:
        by.setdefault(r.conv_id, []).append(r)
    assert sorted(r.name for r in by[1]) == ["V1", "V2"]
    assert 9 not in by  # records of unknown requests are dropped
    assert by[2][0].location == DEFAULT_LOCATION and by[3][0].location == DEFAULT_LOCATION
    assert by[4][0].location == "Pune" and by[4][0].name == FALLBACK_VENUE["name"]


def test_fallback_over_texts_with_records(spark):
    """The venue job on conversations whose articles hold records."""
    from sigflow.plans.venues import venue_results

    rows = [(1, 0, "user", "a hall"), (1, 1, "assistant", 'x [{"name": "V1", "rating": "4.5"}, {"name": "V2"}] y'),
            (1, 2, "assistant", '[{"name": "V3", "amenities": ["a", "b"]}]'), (2, 0, "user", "q"), (2, 1, "assistant", "none")]
    out = venue_results(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((r.conv_id, r.turn, r.pos, r.name) for r in out) == [
        (1, 1, 0, "V1"), (1, 1, 1, "V2"), (1, 2, 0, "V3"), (2, 0, 0, FALLBACK_VENUE["name"])]
    assert {r.name: r.rating for r in out}["V1"] == 4.5


def test_router_lowercasing_matches_python(spark):
    from sigflow.schemas import ROUTER_KEYWORDS

    texts = ["FİND a place", "ΑΣ hall", "KELVIN SHOW", "straße", "ﬁnd", "GARDEN", "Fİnd"]
    df = spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], TURNS)
    got = {r.conv_id: r.route for r in text.route_intent(df).collect()}
    for i, t in enumerate(texts):
        hit = any(k in t.lower() for k in ROUTER_KEYWORDS)
        assert got[i] == ("search_venues_node" if hit else "general_chat_node"), t
