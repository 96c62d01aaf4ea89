"""Substring dedup by seed and extend.

Documents are joined on winnowed anchors (``repeats``): every window of 20
words holds one, so no repeat of 20 words or more is missed. The spans that
share an anchor (the same words, not just the same hash) are extended from it
word by word, to both sides, as classes of equal extensions; a span leaves a side as soon as no other extends the
same way, so no pair is ever formed. A window is repeated when its left and
its right extension are; overlapping windows join into maximal repeats, and
every word of a repeat that also starts earlier is removed.

Defined results: null, blank or short texts have no window and keep their
words; repeated ids, ids that are null and repeated rows: see
``repeats.remove_repeats``; an empty table gives an empty result; further
columns pass through ``drop_repeats`` whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm import kernels as K
from sigflow.llm.common import column, quoted
from sigflow.llm.repeats import Scheme, Spans, remove_repeats

WORDS = 20
GRAM = 6


def scheme(words: int = WORDS, gram: int = GRAM) -> Scheme:
    return Scheme("words", words, min(gram, words), cross_document=False)


def _classes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Class of each row after one more word; -1 for rows that no other row follows."""
    order = np.lexsort((word, before))
    b, w = before[order], word[order]
    new = np.concatenate(([True], (b[1:] != b[:-1]) | (w[1:] != w[:-1])))
    number = np.cumsum(new) - 1
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.where(np.bincount(number)[number] > 1, number, -1)
    return out


def _extend(seed: np.ndarray, at: np.ndarray, room: np.ndarray, step: int, words: np.ndarray, most: int) -> np.ndarray:
    """Classes after 0..most words from ``at`` in direction ``step``; -1 where a row is alone or at its end."""
    out = np.full((most + 1, len(seed)), -1, dtype=np.int64)
    out[0] = seed
    for t in range(1, most + 1):
        live = np.flatnonzero((out[t - 1] >= 0) & (room >= t))
        if len(live) < 2:
            break
        out[t, live] = _classes(out[t - 1, live], words[at[live] + step * (t - 1)])
    return out


def extend_seeds(s: Scheme, x: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the spans whose word sequence also starts earlier."""
    row_starts = x.offs[:-1]
    starts, ends, row = K.word_bounds(x.buf, row_starts)
    # words by number, so equal classes are equal words and not just equal hashes
    words = K.binary_column(x.buf, starts, ends).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first = np.searchsorted(row, np.arange(len(row_starts)))
    count = np.bincount(row, minlength=len(row_starts))
    most = s.length - s.gram
    anchor = first + x.off
    seed = _extend(x.group, anchor, np.full(len(anchor), s.gram), 1, words, s.gram)[-1]
    right = _extend(seed, anchor + s.gram, count - x.off - s.gram, 1, words, most)
    left = _extend(seed, anchor - 1, x.off, -1, words, most)
    rows, windows = [], []
    for back in range(most + 1):
        a, b = left[back], right[most - back]
        live = np.flatnonzero((a >= 0) & (b >= 0))
        if len(live) < 2:
            continue
        place = x.first[live] + x.off[live] - back
        order = np.lexsort((place, x.d[live], b[live], a[live]))
        live, place = live[order], place[order]
        a, b, d = a[live], b[live], x.d[live]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        lead = np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))
        later = (d > d[lead]) | (place > place[lead])
        rows.append(live[later])
        windows.append(x.off[live[later]] - back)
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(windows)


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, n_spans (long) and the kept words joined by one space."""
    out = remove_repeats(docs, scheme(words), extend_seeds, id_col, text_col)
    return out.select(
        F.col("row.c0").alias("doc_id"), F.col("n_units").alias("n_words"), "n_removed", "n_spans",
        F.decode("kept", "UTF-8").alias("kept"),
    )


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` with the repeated words removed from the text; texts without repeats stay as they are."""
    other = [c for c in docs.columns if c not in (id_col, text_col)]
    out = remove_repeats(docs, scheme(words), extend_seeds, id_col, text_col, other, as_is=True)
    # a null text stays null
    place = {id_col: "row.c0", **{c: f"row.c{k + 1}" for k, c in enumerate(other)}}
    text = F.decode("kept", "UTF-8")
    return out.select(*(text.alias(c) if c == text_col else F.col(place[c]).alias(c) for c in docs.columns))
