"""N-gram Jaccard join against brute force, with groups small enough to be split."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sigflow.llm import jaccard
from sigflow.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, num, den):
    """{doc_id: (set size, smallest id reachable)} from all pairs."""
    sets = {d: shingles(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near_copies(seed, families=4, size=60, words=90, most=9):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=words)
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, most)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w))
    rows += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 80, 100)])
def test_matches_brute_force(docs, k, num, den):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(jaccard.near_duplicates(docs, shingle=k, num=num, den=den)) == brute(rows, k, num, den)


@pytest.mark.parametrize("group, local", [(512, 0), (12, 0), (5, 0), (12, 3000), (5, jaccard.LOCAL), (48, jaccard.LOCAL)])
def test_large_families_are_split(spark, group, local):
    """Dealt over tasks in parts of ``group``, or searched in one task by groups of similar ones."""
    rows = near_copies(group)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard.near_duplicates(df, shingle=4, num=85, den=100, group=group, local=local)
    assert got(out) == brute(rows, 4, 85, 100)


def test_groups_that_cannot_qualify_hold_no_partner():
    """Every pair that links is in an opened group; of unlike families hardly any is opened."""
    rows = near_copies(3, families=8, size=24, most=4)[:150]
    sets = [shingles(t, 4) for _, t in rows]
    names = {x: i for i, x in enumerate(sorted({x for s in sets for x in s}))}
    blobs = [np.array(sorted(names[x] for x in s), dtype="<u8").tobytes() for s in sets]
    held = jaccard.TokenSets(pa.array(blobs, pa.binary()))
    groups = jaccard.similar_groups(held, 8)
    assert sorted(i for g in groups for i in g.tolist()) == list(range(len(sets)))
    may = jaccard.qualifying(held, groups, 85, 100)
    for i, a in enumerate(sets):
        for g, members in enumerate(groups):
            linked = [j for j in members.tolist() if j != i and 100 * len(a & sets[j]) >= 85 * len(a | sets[j])]
            assert may[i, g] or not linked
    assert may.sum() < 0.4 * may.size


def test_chain_across_groups(spark):
    """Links that only exist between groups: a chain of drifting versions."""
    rng = random.Random(8)
    w = [f"c{i}" for i in range(80)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(w)))
        w[rng.randrange(len(w))] = f"new{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for group, local in ((4, 0), (9, 0), (4, jaccard.LOCAL)):
        out = jaccard.near_duplicates(df, shingle=4, num=85, den=100, group=group, local=local)
        assert got(out) == brute(rows, 4, 85, 100)


def test_words_that_a_polynomial_confuses(spark):
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 11))
    rows = [(1, f"x y {a} z"), (2, f"x y {a.translate(str.maketrans('ab', 'ba'))} z"), (3, f"X y {a} z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.near_duplicates(df, shingle=4, num=85, den=100)) == {1: (1, 1), 2: (1, 2), 3: (1, 1)}


def test_empty_null_and_repeated(spark, empty):
    assert jaccard.near_duplicates(empty).count() == 0
    t = "a b c d e f g"
    df = spark.createDataFrame(
        [(5, t), (5, t), (7, t.upper()), (None, t), (None, None), (8, None), (9, " "), (10, "x"), (11, "X")],
        "doc_id long, text string",
    )
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()), key=str)
    want = [(5, 3, 5), (5, 3, 5), (7, 3, 5), (None, 3, 5), (None, 0, None), (8, 0, 8), (9, 0, 9), (10, 1, 10), (11, 1, 10)]
    assert rows == sorted(want, key=str)


def test_one_of_each(docs):
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(d for d, (_, c) in brute(rows, 5, 80, 100).items() if c == d)
    assert sorted(r.doc_id for r in out.collect()) == want


def test_one_of_each_with_repeated_and_null_ids(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b, c, d = ("z" + a.replace("a", x) for x in "bcd")
    near = lambda t: t + " more"
    rows = [(1, a), (2, near(a)), (2, b), (3, near(b)), (3, c), (3, c), (None, near(c)), (None, d), (None, near(d)), (None, d),
            (4, " "), (4, " "), (5, None), (2, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(df).collect()), key=str)
    of_d = [t for i, t in got if i is None]
    assert len(of_d) == 1 and of_d[0] in (d, near(d))
    assert got == sorted([(1, a), (2, b), (3, c), (None, of_d[0]), (4, " "), (5, None), (2, " ")], key=str)


def test_components_of_a_long_path_and_a_star(spark):
    n = 300
    order = list(range(1, n))
    random.Random(1).shuffle(order)
    edges = [(i, i - 1) for i in order] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000)]
    out = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(n)}, **{k: 1000 for k in range(1000, 1400)}}


def test_prefixes_hold_the_words_that_rarely_meet():
    """Unlike texts that share many shingles of common words share none of the tokens that travel."""
    rng = random.Random(11)
    common = ["the", "of", "and", "in", "to"]
    texts = []
    for i in range(200):
        rare = [f"r{i}x{k}" for k in range(60)]
        texts.append(" ".join(rare + rng.choices(common, k=120)))
    buf, offsets = jaccard.K.text_buffer(pa.array(texts))
    words = np.zeros(1 << jaccard.SKETCH_BITS, dtype=np.int64)
    h, at = jaccard.shingle_sets(buf, offsets, 4, load=words)
    order = jaccard.Order.of(np.bincount((h >> np.uint64(48)).astype(int), minlength=1 << 16), words)
    t, at, _ = jaccard._ordered_sets(buf, offsets, 4, order)
    n = np.diff(at)
    size = n - (85 * n + 99) // 100 + jaccard.shared_least(n)
    first = [t[a : a + m] for a, m in zip(at, size)]
    assert len(np.unique(t)) < 0.8 * len(t)
    assert len(np.unique(np.concatenate(first))) == size.sum()
    for a, b in zip(at, at[1:]):
        assert (np.diff(t[a:b].astype(object)) > 0).all()
