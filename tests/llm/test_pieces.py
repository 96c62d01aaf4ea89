"""SentencePiece encoding: equal to the library without dropout, lossless with it."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sigflow.llm import pieces
from sigflow.llm.catalog import PIECE_MODEL, tokenizer_path


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(PIECE_MODEL)


def odd_texts():
    rng = random.Random(9)
    chars = "abcdeXYZ  019'\n\téü中文😀▁.-"
    out = ["", " ", "   ", "a", " a", "a  b   c", "▁", "▁▁a", "\x00", "https://example.org/x?y=1", "aaaaaaaaaaaaaaaa" * 9]
    return out + ["".join(rng.choices(chars, k=rng.randint(1, 90))) for _ in range(300)]


def encode_one(path, text, rate, seed=1, variant=0):
    m = pieces.model(path)
    words = pieces.stretches(m.sp.normalize(text)) if text else []
    return pieces.encode_words(m, words, np.full(len(words), variant), seed, rate)[0].tolist()


def test_without_dropout_equals_the_library(path):
    m = pieces.model(path)
    for text in odd_texts():
        assert encode_one(path, text, 0.0) == m.sp.encode(text), repr(text)


def agenda(m, word, variant, seed, rate):
    """One word by a plain agenda: best score first, leftmost on ties, skipped candidates stay out."""
    sym = [(m.id_of.get(c, -1), c, i) for i, c in enumerate(word)]
    while True:
        best = None
        for i in range(len(sym) - 1):
            made = m.id_of.get(sym[i][1] + sym[i + 1][1])
            if made is None or sym[i][0] < 0 or sym[i + 1][0] < 0:
                continue
            drop = pieces._dropped(m, np.array([sym[i][0]]), np.array([sym[i + 1][0]]), np.array([sym[i][2]]), np.array([variant]), seed, rate)
            if not drop[0] and (best is None or m.rank[made] < best[0]):
                best = (m.rank[made], i, made)
        if best is None:
            break
        _, i, made = best
        sym[i : i + 2] = [(made, sym[i][1] + sym[i + 1][1], sym[i][2])]
    out = []
    for i, text, _ in sym:
        out += [i] if i >= 0 else m.byte_id[list(text.encode())].tolist()
    return out


def test_dropout_equals_a_plain_agenda(path):
    m = pieces.model(path)
    for text in odd_texts()[:120]:
        for rate, variant in ((0.1, 0), (0.4, 3)):
            want = [i for w in pieces.stretches(m.sp.normalize(text)) for i in agenda(m, w, variant, 5, rate)] if text else []
            assert encode_one(path, text, rate, 5, variant) == want, repr(text)


def test_long_words_follow_the_same_agenda(path):
    m = pieces.model(path)
    rng = random.Random(3)
    for rate, variant in ((0.0, 0), (0.2, 2)):
        for n in (65, 200, 3000):
            word = "▁" + "".join(rng.choices("abcdeinrst中😀", k=n))
            want = pieces._encode_block(m, [word], np.array([variant]), len(word), 5, rate)[0]
            assert pieces._encode_long(m, word, variant, 5, rate).tolist() == want.tolist()
    text = "".join(rng.choices("abcdefghij", k=300_000))
    assert encode_one(path, text, 0.0) == m.sp.encode(text)


def test_dropout_varies_by_key_and_decodes(path):
    m = pieces.model(path)
    text = "segmentation of international organisations and their responsibilities"
    found = {tuple(encode_one(path, text, 0.3, seed, v)) for seed in range(4) for v in range(4)}
    assert len(found) > 8
    assert all(m.sp.decode(list(ids)) == text for ids in found)
    assert encode_one(path, text, 0.3, 2, 1) == encode_one(path, text, 0.3, 2, 1)
    longer = np.mean([len(encode_one(path, text, 0.5, s)) for s in range(8)])
    assert longer > len(m.sp.encode(text))
    chars = encode_one(path, text, 1.0)
    assert len(chars) == len(m.sp.normalize(text))


def test_round_trip_on_documents(docs, path):
    sent = pieces.encode(docs, path, rate=0.2)
    back = {r.doc_id: r.text for r in pieces.decode(sent, path).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}
    again = {r.doc_id: r.ids for r in pieces.encode(docs.repartition(3), path, rate=0.2).collect()}
    assert again == {r.doc_id: r.ids for r in sent.collect()}
    other = {r.doc_id: r.ids for r in pieces.encode(docs, path, rate=0.2, seed=99).collect()}
    assert sum(again[d] != other[d] for d in again) > len(again) / 2


def test_plain_encoding_on_documents(docs, path):
    m = pieces.model(path)
    for r in pieces.encode(docs, path, rate=0.0).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert r.ids == (None if r.text is None else m.sp.encode(r.text))


def test_cache_starts_over(path, monkeypatch, docs):
    m = pieces.model(path)
    cache = pieces.WordCache(m, 1, 0.0)
    cache[("▁the", 0)], cache[("▁of", 0)]
    cache.learn()
    cache.forget()
    n = cache[("▁of", 0)]
    cache.learn()
    assert cache.ids[cache.offsets[n] : cache.offsets[n + 1]].tolist() == m.sp.encode("of")


def test_empty_table_null_ids_and_repeats(spark, empty, path):
    assert pieces.encode(empty, path).count() == 0
    df = spark.createDataFrame([(None, "a b"), (3, "some text"), (3, "some text"), (4, None)], "doc_id long, text string")
    rows = pieces.encode(df, path, check=True).collect()
    assert sorted((str(r.doc_id), str(r.lossless)) for r in rows) == [("3", "True"), ("3", "True"), ("4", "None"), ("None", "True")]
    assert len({tuple(r.ids) for r in rows if r.doc_id == 3}) == 1


def test_every_occurrence_draws_its_merges_anew(path):
    """Over many occurrences each merge is skipped at the rate, and results are those of the plain encoding."""
    m = pieces.model(path)
    text, rate, n = "▁responsibilities", 0.1, 4000
    cache = pieces.WordCache(m, 0, 0.0)
    words = [text, "▁of", "▁" + "ab" * 50] * n
    variant = np.concatenate([pieces.occurrences(d, 30, 5) for d in range(len(words) // 30)])
    flat, lengths = pieces.encode_occurrences(cache, words, variant, 5, rate)
    some = slice(0, 600)
    want, counts = pieces.encode_words(m, words[some], variant[some], 5, rate)
    assert lengths[some].tolist() == counts.tolist() and flat[: len(want)].tolist() == want.tolist()
    ids = np.split(flat, np.cumsum(lengths)[:-1])
    assert len({tuple(x.tolist()) for x in ids[::3]}) > 20
    keys = cache.merges.take(np.array([cache[text, 0]]))[0]
    assert len(keys) > 3
    for key in keys:
        share = pieces._skipped(np.full(n, key), variant[::3], 5, rate).mean()
        assert abs(share - rate) < 0.03
    short = np.mean([len(x) > 1 for x in ids[1::3]])  # a skipped merge may be made up for by others
    merges = len(cache.merges.take(np.array([cache["▁of", 0]]))[0])
    assert 0 < short < 1 - (1 - rate) ** merges + 0.03


def test_documents_draw_apart(spark, path):
    df = spark.createDataFrame([(i, "international responsibilities of organisations") for i in range(300)], "doc_id long, text string")
    assert len({tuple(r.ids) for r in pieces.encode(df, path).collect()}) > 60
