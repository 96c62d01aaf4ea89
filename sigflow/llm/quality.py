"""Quality rules: a threshold table compiled into Spark projections.

Every measure is a built-in expression over one row, so the rules need no
shuffle, no user function and no second read. Repeated three-word windows
are found by sorting packed ``(window hash, position)`` longs inside the row;
windows whose hash prefix repeats are then compared as text, so a hash
collision can only cost time.

Defined results: null or blank text has zero for every count and fails the
length rule; repeated rows are judged one by one alike; an empty table gives
an empty result; further columns, also ones named like a measure, pass
through untouched because all results sit in one struct column with a free
name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import SPACE_CHARS, SPACE_CLASS, column, free_name, words_of

SYMBOLS = "#*$%&|<>"
POSITION = (1 << 31) - 1
ELLIPSES = ("...", "…")
BULLETS = ("-", "*", "•")

# Frequent function words of the corpus languages (English, French, Spanish, German).
STOP_WORDS = (
    "the be to of and that have with this for is was it in on at by are not from as "
    "le la les de des du et que qui un une est dans pour par sur pas avec en "
    "el los las del y se con por para su al una lo como "
    "der die das und ist von zu den mit nicht auf ein eine sich auch dem im"
).split()


class Rule(NamedTuple):
    """``measure`` must lie in ``[low, high]``; None leaves a side open."""

    name: str
    measure: str
    low: float | None
    high: float | None


BASE_RULES = (
    Rule("enough words", "n_words", 50, None),
    Rule("few repeated windows", "repeat_ratio", None, 0.5),
)
RULES = (
    *BASE_RULES,
    Rule("word length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop words", "stop_ratio", 0.02, None),
    Rule("duplicate lines", "dup_line_ratio", None, 0.5),
    Rule("bullet lines", "bullet_ratio", None, 0.9),
    Rule("ellipsis lines", "ellipsis_ratio", None, 0.5),
)


def compile_rules(rules: tuple[Rule, ...], measure) -> Column:
    """One boolean column: every rule of the table holds. ``measure`` maps a name to its column."""
    ok = F.lit(True)
    for r in rules:
        value = measure(r.measure)
        if r.low is not None:
            ok = ok & (value >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (value <= F.lit(r.high))
    return ok


def _starts_with_any(line: Column, marks) -> Column:
    hit = F.lit(False)
    for m in marks:
        hit = hit | line.startswith(m)
    return hit


def _ends_with_any(line: Column, marks) -> Column:
    hit = F.lit(False)
    for m in marks:
        hit = hit | line.endswith(m)
    return hit


def with_quality(
    docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "quality"
) -> tuple[DataFrame, str]:
    """``docs`` with one struct column of measures and verdicts; also returns that column's name.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept (boolean).
    """
    out = free_name(docs, out)
    names = docs.columns
    # Each step is its own projection: later ones read the finished arrays.
    t, w, p, c, r = (free_name(docs, f"{out}_{x}") for x in ("text", "words", "packed", "cand", "pos"))

    df = docs.withColumn(t, F.coalesce(column(docs, text_col), F.lit("")))
    text = F.col(t)
    df = df.withColumn(w, words_of(text))
    words = F.col(w)
    n = F.size(words)

    # 33 bits of window hash above 31 bits of position: one primitive sort.
    window_hash = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    df = df.withColumn(
        p,
        F.when(
            n >= 3,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
                    lambda i: window_hash(i).bitwiseAND(F.lit(~POSITION)).bitwiseOR(i.cast("long")),
                )
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    packed = F.col(p)
    top = lambda x: F.shiftright(x, 31)
    df = df.withColumn(
        c,
        F.transform(
            F.filter(
                packed,
                lambda x, k: F.coalesce(top(x) == top(F.get(packed, k - 1)), F.lit(False))
                | F.coalesce(top(x) == top(F.get(packed, k + 1)), F.lit(False)),
            ),
            lambda x: x.bitwiseAND(F.lit(POSITION)).cast("int"),
        ),
    )
    # The candidates as text: equal neighbours in sorted order are true repeats.
    window_text = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    df = df.withColumn(
        r, F.sort_array(F.transform(F.col(c), lambda i: F.struct(window_text(i).alias("s"), i.alias("i"))))
    )
    cand = F.col(r)
    df = df.withColumn(
        c,
        F.sort_array(
            F.transform(
                F.filter(
                    cand,
                    lambda x, k: F.coalesce(x["s"] == F.get(cand, k - 1)["s"], F.lit(False))
                    | F.coalesce(x["s"] == F.get(cand, k + 1)["s"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    # Words covered by the repeated windows: each adds what the one before left open.
    covered = F.aggregate(
        F.col(c),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )

    blank_lines = rf"^{SPACE_CLASS}*$"
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(blank_lines))
    chars = F.length(text)
    l_ = free_name(docs, f"{out}_lines")
    df = df.withColumn(l_, lines)
    line_arr = F.col(l_)
    n_lines = F.size(line_arr)
    trimmed = lambda x: F.btrim(x, F.lit(SPACE_CHARS))
    df = df.withColumn(
        out,
        F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
            (chars - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (n_lines - F.size(F.array_distinct(line_arr))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words"),
            F.size(F.filter(words, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop"),
            n_lines.alias("n_lines"),
            F.size(F.filter(line_arr, lambda x: _starts_with_any(trimmed(x), BULLETS))).alias("n_bullets"),
            F.size(F.filter(line_arr, lambda x: _ends_with_any(trimmed(x), ELLIPSES))).alias("n_ellipses"),
        ),
    )

    q = F.col(out)
    per = lambda a, b: F.when(q[b] > 0, q[a] / q[b]).otherwise(F.lit(0.0))
    measures = {
        "n_words": q["n_words"],
        "repeat_ratio": per("n_repeat_words", "n_words"),
        "mean_word_chars": per("word_chars", "n_words"),
        "symbol_ratio": per("n_symbols", "n_words"),
        "stop_ratio": per("n_stop", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "bullet_ratio": per("n_bullets", "n_lines"),
        "ellipsis_ratio": per("n_ellipses", "n_lines"),
    }
    base_failed = (q["n_words"] < 50) | (F.lit(100) * q["n_repeat_words"] > F.lit(50) * q["n_words"])
    df = df.withColumn(
        out,
        F.struct(
            *(q[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
            base_failed.alias("base_failed"),
            (~base_failed & compile_rules(rules, measures.__getitem__)).alias("kept"),
        ),
    )
    return df.select(*(column(df, x) for x in names), F.col(out)), out


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, the five counts, ``base_failed`` and ``kept``."""
    slim = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    judged, q = with_quality(slim)
    return judged.select("doc_id", f"{q}.*")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass every rule, with their own columns."""
    judged, q = with_quality(docs, text_col, RULES)
    # A filter moves below deterministic projections and would repeat the whole
    # computation for every field it needs; a row number keeps it above them.
    number = free_name(judged, "number")
    judged = judged.withColumn(number, F.monotonically_increasing_id())
    return judged.filter(F.col(q)["kept"] & (F.col(number) >= 0)).select(*(column(docs, c) for c in docs.columns))
