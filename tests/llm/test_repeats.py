"""Substring dedup (words) and suffix dedup (bytes) against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from sigflow.llm import kernels as K
from sigflow.llm import repeats, substring, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, length=20):
    """{doc_id: (n_words, n_removed, n_spans, kept)} straight from the definition."""
    texts = {d: WORD.findall(t or "") for d, t in rows}
    first: dict = {}
    for d in sorted(texts):
        w = texts[d]
        for i in range(len(w) - length + 1):
            first.setdefault(tuple(w[i : i + length]), (d, i))
    out = {}
    for d, w in texts.items():
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < (d, i):
                gone[i : i + length] = [True] * length
        out[d] = (len(w), sum(gone), spans(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def brute_bytes(rows, length=50):
    texts = {d: (t or "").encode() for d, t in rows}
    first: dict = {}
    for d in sorted(texts):
        b = texts[d]
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], d)
    out = {}
    for d, b in texts.items():
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        out[d] = (len(b), sum(gone), spans(gone), bytes(x for x, g in zip(b, gone) if not g))
    return out


def spans(gone):
    return sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def got(df):
    return {r[0]: tuple(bytes(x) if isinstance(x, bytearray) else x for x in r[1:]) for r in df.collect()}


def test_words_match_brute_force(docs):
    assert got(substring.repeated_words(docs)) == brute_words(rows_of(docs))


def test_bytes_match_brute_force(docs):
    assert got(suffixes.repeated_bytes(docs)) == brute_bytes(rows_of(docs))


@pytest.mark.parametrize("hot", [1, 3])
def test_frequent_anchors_window_by_window(docs, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_LEAST", hot)
    # workers import the module afresh: the floor has to reach them through the closure
    match = repeats._match

    def patched(s, doc_bins):
        run = match(s, doc_bins)

        def with_floor(batches):
            repeats.HOT_LEAST = hot
            yield from run(batches)

        return with_floor

    monkeypatch.setattr(repeats, "_match", patched)
    assert got(substring.repeated_words(docs)) == brute_words(rows_of(docs))
    assert got(suffixes.repeated_bytes(docs)) == brute_bytes(rows_of(docs))


def thue_morse(bits):
    """Two words of 2 ** bits letters that a polynomial modulo 2 ** 64 can't tell apart."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << bits))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_words_that_a_polynomial_confuses(spark):
    a, b = thue_morse(11)
    buf = np.frombuffer(f"{a} {b}".encode(), dtype=np.uint8)
    starts, ends = np.array([0, len(a) + 1]), np.array([len(a), 2 * len(a) + 1])
    assert len(set(K.range_hash(K.prefix_hash(buf), starts, ends).tolist())) == 1
    assert len(set(K.word_hash(buf, starts, ends).tolist())) == 2
    words = [f"w{i}" for i in range(24)]
    for at in (12, 3, 20):  # in the middle of every window, and where an anchor may lie
        rows = [(k, " ".join(words[:at] + [x] + words[at:])) for k, x in enumerate((a, b))]
        rows += [(2, rows[1][1])]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert got(substring.repeated_words(df)) == brute_words(rows)


def test_word_hashes_follow_the_bytes():
    rng = random.Random(4)
    words = ["".join(rng.choices("ab\0é", k=rng.randint(1, 20))).encode() for _ in range(4000)]
    words += [b"x" * n for n in range(1, 200)] * 2
    buf = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words])
    h = K.word_hash(buf, ends - np.array([len(w) for w in words]), ends).tolist()
    of = {}
    assert all(of.setdefault(w, x) == x for w, x in zip(words, h)) and len(set(of.values())) == len(of)
    assert len(K.word_hash(buf[:0], ends[:0], ends[:0])) == 0


def test_empty_table(empty):
    assert substring.repeated_words(empty).count() == 0
    assert suffixes.repeated_bytes(empty).count() == 0
    assert substring.drop_repeats(empty).count() == 0


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame(
        [(1, text), (1, text), (2, text), (None, text), (None, text), (3, None)], "doc_id long, text string"
    )
    words = sorted(((r.doc_id, r.n_removed) for r in substring.repeated_words(df).collect()), key=str)
    assert words == sorted([(1, 0), (1, 0), (2, 40), (None, 40), (None, 40), (3, 0)], key=str)
    sizes = {(r.doc_id, r.n_removed) for r in suffixes.repeated_bytes(df).collect()}
    n = len(text)
    assert sizes == {(1, 0), (2, n), (None, n), (3, 0)}


def test_drop_repeats_keeps_columns_and_clean_texts(docs):
    out = substring.drop_repeats(docs)
    assert out.columns == docs.columns
    want = brute_words(rows_of(docs))
    before = {r.doc_id: r for r in docs.collect()}
    for r in out.collect():
        b = before[r.doc_id]
        assert (r.lang, r.source, r.kept, r.row) == (b.lang, b.source, b.kept, b.row)
        assert r.text == ((b.text or "") if want[r.doc_id][1] == 0 else want[r.doc_id][3])


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    a = "".join(rng.choices("abcdefgh ", k=700_000))
    b = "".join(rng.choices("abcdefgh ", k=100)) + a[200_000:560_000] + "zz" + a[262_100:262_200]
    out = got(suffixes.repeated_bytes(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")))
    n = 360_000 + 100
    assert out[1][1] == 0 and out[2][:3] == (len(b), n, 2)
    words = got(substring.repeated_words(spark.createDataFrame([(1, a), (2, a)], "doc_id long, text string")))
    assert words[2][1] == words[2][0]


def test_suffix_sort_and_common_extension():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 100, 3000).astype(np.uint8)
    buf[1000:1200] = buf[100:300]
    s = suffixes.Suffixes(buf, 50)
    pos = rng.permutation(2900)[:1000]
    group = np.sort(rng.integers(0, 7, 1000))
    order = s.sort(pos, group)
    text = lambda p: buf[p : p + 50].tobytes()
    for g in range(7):
        mine = [text(p) for p in pos[order][group == g]]
        assert mine == sorted(mine) and sorted(mine) == sorted(text(p) for p in pos[group == g])
    a, b = rng.integers(0, 2900, 500), rng.integers(0, 2900, 500)
    want = [next((k for k in range(50) if buf[x + k] != buf[y + k]), 50) for x, y in zip(a, b)]
    assert s.common(a, b).tolist() == want


def test_lying_hash_is_caught():
    """With a prefix hash that says everything agrees, the bytes decide."""
    rng = np.random.default_rng(1)
    buf = rng.integers(97, 99, 400).astype(np.uint8)
    buf[200:260] = buf[20:80]
    liar = suffixes.Suffixes(buf, 50, prefix=np.zeros(len(buf) + 1, dtype=K.U))
    pos = np.arange(340)
    order, same = liar.equal_neighbours(pos, np.zeros(340, dtype=np.int64))
    text = [buf[p : p + 50].tobytes() for p in pos[order]]
    assert text == sorted(text)
    assert same.tolist() == [False] + [x == y for x, y in zip(text, text[1:])]


def test_query_digests(spark, tmp_path):
    from sigflow.llm import catalog

    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (2, "head " + text)], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    r = {x.doc_id: x for x in catalog.QUERIES["op3_substring_dedup"](spark, str(tmp_path)).collect()}
    assert (r[2].n_words, r[2].n_removed, r[2].kept_sha256) == (31, 30, hashlib.sha256(b"head").hexdigest())
    r = {x.doc_id: x for x in catalog.QUERIES["op9_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert r[2].kept_sha256 == hashlib.sha256(b"head ").hexdigest() and r[2].n_spans == 1


def test_only_suffixes_with_an_equal_are_sorted(monkeypatch):
    """Spans that share an anchor among unlike bytes: none of their other suffixes is compared."""
    rng = np.random.default_rng(5)
    anchor, twin = rng.integers(97, 123, 16), rng.integers(97, 123, 20)
    rows = [np.concatenate((rng.integers(97, 123, 34), anchor, rng.integers(97, 123, 34))) for _ in range(300)]
    rows[7][50:70] = rows[200][50:70] = twin
    rows[7][20:34] = rows[200][20:34] = twin[:14]
    buf, n = np.concatenate(rows).astype(np.uint8), len(rows)
    spans = repeats.Spans(
        np.zeros(n, dtype=np.int64), np.arange(n), np.full(n, 34), np.zeros(n, dtype=np.int64), buf, np.arange(n + 1) * 84
    )
    sorted_ = []
    whole = suffixes.Suffixes.sort
    monkeypatch.setattr(suffixes.Suffixes, "sort", lambda self, pos, group: sorted_.append(len(pos)) or whole(self, pos, group))
    row, window = suffixes.sort_suffixes(suffixes.scheme(), spans)
    assert sorted(zip(row.tolist(), window.tolist())) == [(200, 20)]
    assert sorted_ == [2]


def test_frequent_anchors_are_told_by_top_and_bin():
    rng = np.random.default_rng(6)
    h = rng.integers(0, 1 << 30, 500).astype(K.U) << K.U(20)
    names = {(int(x) >> repeats.SHIFT, int(x) % 53) for x in h[:40]} | {(int(h[50]) >> repeats.SHIFT, b) for b in range(53)}
    names -= {(int(h[3]) >> repeats.SHIFT, int(h[3]) % 53)}
    table = np.array(sorted(names), dtype=[("top", "<u8"), ("bin", "<u8")])
    want = [(int(x) >> repeats.SHIFT, int(x) % 53) in names for x in h]
    assert repeats._frequent(h, table, 53).tolist() == want
    assert not repeats._frequent(h, table[:0], 53).any()
