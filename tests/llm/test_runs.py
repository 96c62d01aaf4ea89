import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sigflow.llm.catalog import op13_periodic_runs
from sigflow.llm.runs import find_runs, periodic_runs


def brute_runs(w, least=6, fold=4):
    """(start, length, period) of every run: each period by itself, the smallest one of a stretch kept."""
    n, found = len(w), {}
    for q in range(1, n // fold + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, fold * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9)), max_size=6), max_size=5))
def test_runs_of_many_sequences_match_brute_force(blocks):
    seqs = [[w for unit, times in b for w in unit * times] for b in blocks]
    words = np.array([w for s in seqs for w in s], dtype=np.int64)
    got = find_runs(words, np.array([len(s) for s in seqs], dtype=np.int64))
    assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, s in enumerate(seqs) for r in brute_runs(s)]


def test_other_limits():
    rng = random.Random(5)
    for least, fold in ((2, 2), (4, 3), (10, 5)):
        for _ in range(60):
            w = [x for _ in range(8) for x in [rng.randrange(3) for _ in range(rng.randint(1, 4))] * rng.choice([1, 2, 5])]
            got = find_runs(np.array(w), np.array([len(w)]), least, fold)
            assert [tuple(r[1:]) for r in got.tolist()] == brute_runs(w, least, fold)


def test_long_repetitive_sequences():
    for unit, times in ((1, 30_000), (12, 2_000), (3_000, 8)):
        w = np.tile(np.arange(unit), times)
        assert find_runs(w, np.array([len(w)])).tolist() == [[0, 0, unit * times, unit]]


def test_documents(docs):
    rows = {r.doc_id: r for r in docs.select("doc_id", "text").collect()}
    for plant in (False, True):
        got = {r.doc_id: r for r in periodic_runs(docs, planted=plant).collect()}
        assert got.keys() == rows.keys()
        for i, r in got.items():
            words = plain(rows[i].text)
            words = planted(words, i) if plant else words
            runs = brute_runs(words)
            assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(words), runs, collapsed(words, runs))


def test_query(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", " \n", "a", "a a a a a", "a a a a a a", "x " + "y z " * 9 + "y", "k " * 3000, ("é ü\t" * 5 + "\n") * 4]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a a a a a a a"), (3, "again"), (3, "again")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_periodic_runs(spark, str(tmp_path)).drop("n_words").collect()
    want = []
    for i, t in rows:
        words = planted(plain(t), i)
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = best[1] * 1000 // best[2] if runs else None
        want.append((i, len(runs), *best, milli, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(collapsed(words, runs))))
    order = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert order(got) == order(want)


def test_empty_and_clashing_columns(docs, empty):
    assert periodic_runs(empty).collect() == []
    more = docs.withColumnRenamed("lang", "runs").withColumnRenamed("row", "collapsed").withColumnRenamed("kept", "n_words")
    assert sorted(periodic_runs(more).collect(), key=str) == sorted(periodic_runs(docs).collect(), key=str)
