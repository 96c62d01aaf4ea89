"""Quality rules against counts straight from their definitions."""

from __future__ import annotations

import re
from collections import Counter

from sigflow.llm.quality import BULLETS, ELLIPSES, RULES, STOP_WORDS, keep_good, quality_report, with_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    strip = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    n, ln = max(1, len(w)), max(1, len(lines))
    ratios = {
        "n_words": len(w), "repeat_ratio": len(covered) / n, "mean_word_chars": counts[1] / n, "symbol_ratio": counts[2] / n,
        "stop_ratio": sum(x.lower() in STOP_WORDS for x in w) / n, "dup_line_ratio": counts[3] / ln,
        "bullet_ratio": sum(x.startswith(BULLETS) for x in strip) / ln,
        "ellipsis_ratio": sum(x.endswith(ELLIPSES) for x in strip) / ln,
    }
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    ok = all((r.low is None or ratios[r.measure] >= r.low) and (r.high is None or ratios[r.measure] <= r.high) for r in RULES)
    return (*counts, failed, not failed and ok)


def odd_texts():
    clean = "the quick brown fox and the lazy dog walked over to a house that was not on the map "
    return [
        None, "", " \n ", "a a a", "a a a a", "a b c a b c", "x y x y x y x", clean * 5, "- the item of it\n" * 30,
        "\n".join(f"the line {i} of that list is here ..." for i in range(20)),
        "\n".join(f"line {i} of the text and that is it…\n\n" for i in range(20)), "and # of the * word $ " * 30,
        "\u00a0nbsp is a word\u2003em\x1funit " * 20, "né à l'été \U0001f600 " * 40, "\x0bvt\x0cff\rcr\ttab " * 20,
        "same line of the text\n\n same line of the text\nsame line of the text", clean.replace(" ", "\n") * 3,
    ]


def test_counts_and_verdicts(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(odd_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d: measures(t) for d, t in rows}
    got = {r[0]: tuple(r)[1:] for r in quality_report(df).collect()}
    assert got == want


def test_hash_prefix_collisions_only_cost_time(spark):
    """Many windows in one text: some share 33 hash bits; the counts stay exact."""
    text = " ".join(f"t{i}" for i in range(200_000)) + " t1 t2 t3"
    row = quality_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_words == 200_003 and row.n_repeat_words == 6


def test_clashing_columns_and_no_user_function(spark):
    df = spark.createDataFrame([(1, "word " * 60, "a", 2)], "doc_id long, text string, quality string, quality_words int")
    judged, name = with_quality(df)
    assert name == "quality_" and judged.columns == [*df.columns, name]
    assert judged.first()[name].n_words == 60
    assert not re.search("Python|Arrow|Pandas|Exchange", judged._jdf.queryExecution().executedPlan().toString())
    assert keep_good(df).columns == df.columns


def test_empty_and_repeated(spark, empty):
    assert quality_report(empty).count() == 0 and keep_good(empty).count() == 0
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(str(r.n_words) for r in quality_report(df).collect()) == ["0", "2", "2"]


def test_given_documents_keep_prose(spark):
    """Prose stays; symbol, table and repetition junk goes."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {r.doc_id: r for r in quality_report(df).collect()}
    for r in df.collect():
        junk = out[r.doc_id].n_symbols > 0.1 * out[r.doc_id].n_words
        if not out[r.doc_id].base_failed:
            assert out[r.doc_id].kept == (not junk)


def test_a_very_long_clean_text_is_kept(spark):
    text = " ".join(f"the w{i}" for i in range(500_100))
    df = spark.createDataFrame([(1, text), (2, "* # " * 100)], "doc_id long, text string")
    assert [r.doc_id for r in keep_good(df).select("doc_id").collect()] == [1]
