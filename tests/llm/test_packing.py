"""Token packing: exact round trips, no loss, padding and mixture."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from sigflow.llm import bestfit, mixture, tokens
from sigflow.llm.catalog import WORD_MODEL, tokenizer_path
from sigflow.session import conf_override


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(WORD_MODEL)


@pytest.fixture(scope="module")
def whole_ids(docs, path):
    """Ids of every document by the tokenizer itself, over whole texts."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return {r.doc_id: [*t.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.select("doc_id", "text").collect()}


def test_encoding_by_pieces_equals_whole_texts(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    rng = random.Random(2)
    chars = "abcXYZ 019'\n\t\r\x0b\xa0 éÉéßİΣσ中文😀.,;-_<|>"
    odd = ["", " ", "\n", "it's they'll", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "ΟΔΟΣ ΟΔΟΣ", " ́a"]
    odd += ["".join(rng.choices(chars, k=rng.randint(1, 60))) for _ in range(400)]
    enc = tokens.PieceEncoder(path)
    for text in odd:
        assert enc.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_cache_starts_over(path, monkeypatch):
    enc = tokens.PieceEncoder(path)
    first = enc.encode("some words here")
    monkeypatch.setattr(tokens, "CACHE_PIECES", 2)
    assert (enc.encode("some words here") == first).all() and len(enc) <= 3


@pytest.mark.parametrize("source, length", [("source", 2048), ("lang", 64)])
def test_mixture_pieces_are_the_documents(docs, path, whole_ids, source, length):
    packed = mixture.pack_mixture(docs, path, source_col=source, length=length)
    rows = packed.collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    seen = {}
    for r in rows:
        flat = np.frombuffer(r.ids, "<u4")
        assert r.length == len(flat) and (r.length == length or bin(r.length).count("1") == 1)
        at = 0
        for p in r.pieces:
            part = flat[p.offset : p.offset + p.length]
            assert p.offset == at and zlib.crc32(part.tobytes()) == p.ids_crc32
            at += p.length
            seen.setdefault(p.doc_id, []).append((p.start, part.tolist(), p.doc_tokens))
        assert at == r.length
    assert seen.keys() == whole_ids.keys()
    for d, parts in seen.items():
        flat, total = [], len(whole_ids[d])
        for start, part, n in sorted(parts, key=lambda x: x[0]):
            assert start == len(flat) and n == total
            flat += part
        assert flat == whole_ids[d]


def test_windows_keep_the_mixture(spark, path):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randint(50, 400))), "abcd"[min(3, i % 6)]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    with conf_override(spark, {"spark.sql.shuffle.partitions": "1"}):
        packed = mixture.pack_mixture(df, path).collect()
    source = {i: s for i, _, s in rows}
    total = {}
    for r in packed:
        for p in r.pieces:
            total[source[p.doc_id]] = total.get(source[p.doc_id], 0) + p.length
    share = {s: n / sum(total.values()) for s, n in total.items()}
    full = [r for r in packed if r.length == mixture.LENGTH]
    close = 0
    for r in full:
        mine = {}
        for p in r.pieces:
            mine[source[p.doc_id]] = mine.get(source[p.doc_id], 0) + p.length
        close += all(abs(mine.get(s, 0) / r.length - share[s]) < 0.15 for s in share)
    assert close >= 0.9 * len(full)  # the last windows take what is left


def test_given_mixture_leads_while_it_lasts():
    robin = mixture.RoundRobin(np.array([0.75, 0.25, 0.0]), np.zeros(3), 256, 16)
    for q, n in zip(robin.queues, (3000, 3000, 500)):
        q.add(0, np.zeros(n, dtype="<u2"))
    taken = np.zeros(3)
    for _ in range(10):
        before = [q.tokens for q in robin.queues]
        robin.window(256)
        taken += np.array(before) - [q.tokens for q in robin.queues]
    assert abs(taken - np.array([0.75, 0.25, 0]) * 2560).max() <= 64


def test_deficits_are_carried_on():
    """What earlier partitions left owing is served first."""
    robin = mixture.RoundRobin(np.array([0.5, 0.5]), np.array([-600.0, 600.0]), 256, 16)
    for q in robin.queues:
        q.add(0, np.zeros(5000, dtype="<u2"))
    taken = np.zeros(2)
    for _ in range(12):
        before = [q.tokens for q in robin.queues]
        robin.window(256)
        taken += np.array(before) - [q.tokens for q in robin.queues]
    assert abs((taken[1] - taken[0]) - 1200) <= 64


def test_best_fit_rows_are_the_documents(docs, path, whole_ids):
    length = 128
    rows = bestfit.pack_best_fit(docs, path, length=length).collect()
    seen = {}
    for r in rows:
        flat = np.frombuffer(r.ids, "<u2")
        assert len(flat) == length and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1] and (flat[r.n_tokens :] == 0).all()
        for d, start, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            seen.setdefault(d, []).append((start, flat[a:b].tolist()))
    for d, ids in whole_ids.items():
        parts = sorted(seen[d])
        assert [i for _, p in parts for i in p] == ids
        assert [s for s, _ in parts] == list(range(0, len(ids), length))
    assert seen.keys() == whole_ids.keys()


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(7)
    for _ in range(30):
        length = rng.choice([7, 64, 100])
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 200))]
        rows = bestfit.best_fit_decreasing(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= length for r in rows)
        room = []
        for n in sorted(sizes, reverse=True):
            fit = [c for c in room if c >= n]
            if fit:
                room.remove(min(fit))
                room.append(min(fit) - n)
            else:
                room.append(length - n)
        assert len(rows) == len(room) and sorted(length - sum(sizes[i] for i in r) for r in rows) == sorted(room)


@pytest.mark.parametrize("pack", ["best fit", "mixture"])
def test_two_runs_pack_alike(docs, path, pack):
    """Whatever order rows arrive in: a task that runs again gives the same sequences the same numbers."""
    def packed(df):
        if pack == "best fit":
            return sorted((r.sequence_id, bytes(r.ids), r.cu_seqlens) for r in bestfit.pack_best_fit(df, path).collect())
        return sorted((r.sequence_id, bytes(r.ids)) for r in mixture.pack_mixture(df, path).collect())

    assert packed(docs) == packed(docs.repartition(5).orderBy("text")) == packed(docs.repartition(2, "lang"))


def test_write_and_read_back(docs, path, scratch):
    import pyarrow.parquet as pq

    out = f"{scratch}/packed"
    bestfit.write_packed(bestfit.pack_best_fit(docs, path), out)
    table = pq.read_table(out)
    assert bestfit.id_matrix(table).shape == (table.num_rows, bestfit.LENGTH)


def test_empty_and_null(spark, empty, path):
    assert mixture.pack_mixture(empty, path).count() == 0
    assert bestfit.pack_best_fit(empty, path).count() == 0
    df = spark.createDataFrame(
        [(1, None, None), (1, None, None), (None, "", "a"), (None, "b", "a")], "doc_id long, text string, source string"
    )
    pieces = mixture.piece_rows(mixture.pack_mixture(df, path)).collect()
    assert sorted((str(p.doc_id), p.doc_tokens) for p in pieces) == [("1", 1), ("1", 1), ("None", 1), ("None", 2)]
    rows = bestfit.pack_best_fit(df, path).collect()
    assert sorted(str(d) for r in rows for d in r.doc_ids) == ["1", "1", "None", "None"]


def test_every_source_has_its_queue(spark, path):
    """300 sources: a given mixture that names a small one leads, and without one all are mixed in."""
    rng = random.Random(6)
    rows = [(0, "alpha beta " * 400, "big")]
    rows += [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=100)), f"s{i % 300:03}") for i in range(1, 3001)]
    rows += [(5000 + i, "delta " * 60, "tiny") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {i: s for i, _, s in rows}
    with conf_override(spark, {"spark.sql.shuffle.partitions": "1"}):
        given = mixture.pack_mixture(df, path, mixture={"tiny": 0.5, "big": 0.5, "absent": 9.0}, length=1024).collect()
        plain = mixture.pack_mixture(df, path, length=4096, piece=8).collect()
    # nothing but what the mixture names until one of the two is used up
    for r in sorted(given, key=lambda r: r.sequence_id)[:1]:
        mine = {}
        for p in r.pieces:
            mine[source[p.doc_id]] = mine.get(source[p.doc_id], 0) + p.length
        assert set(mine) == {"tiny", "big"} and abs(mine["tiny"] - mine["big"]) <= mixture.PIECE
    tokens = {}
    for r in plain:
        for p in r.pieces:
            tokens[source[p.doc_id]] = tokens.get(source[p.doc_id], 0) + p.length
    assert len(tokens) == 302
    # each source lies in its windows evenly: what it has had so far never strays far from its share
    total = sum(tokens.values())
    full = [r for r in sorted(plain, key=lambda r: r.sequence_id) if r.length == 4096]
    had, seen = dict.fromkeys(tokens, 0), 0
    for r in full[: len(full) * 3 // 4]:
        seen += r.length
        for p in r.pieces:
            had[source[p.doc_id]] += p.length
        assert max(abs(had[s] - seen * tokens[s] / total) for s in tokens) < 400


def test_deficits_of_a_partition(spark):
    rows = [(p, s, n) for p, s, n in [(0, "a", 30), (0, "b", 10), (1, "b", 20), (3, "a", 5), (3, None, 35), (3, "b", 0)]]
    spread = spark.createDataFrame(rows, "part int, source string, n long")
    got = {(r.part, r.source): (r.share, r.owed) for r in mixture.source_deficits(spread, 4, None).collect()}
    total, part = 100, {0: 0, 1: 40, 3: 60}
    of = {"a": 35, "b": 30, None: 35}
    for p, s, _ in rows:
        served = sum(n for q, x, n in rows if x == s and q < p)
        assert got[p, s] == pytest.approx((of[s] / total, part[p] * of[s] / total - served))
    got = {(r.part, r.source): r.share for r in mixture.source_deficits(spread, 4, {None: 3.0, "b": 1.0, "z": 7.0}).collect()}
    assert got[3, None] == 0.75 and got[0, "b"] == 0.25 and got[0, "a"] == 0
