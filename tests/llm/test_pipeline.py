"""The pipeline against brute force: what each stage keeps, and what is packed in the end."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from test_jaccard import brute as brute_components
from test_quality_rules import measures
from test_repeats import brute_words

import corpus_pipeline


@pytest.fixture(scope="module")
def sf_dir(spark, docs, tmp_path_factory):
    """Prose-like documents, so that some pass the quality rules."""
    rows = []
    for r in docs.select("doc_id", "text").collect():
        words = (r.text or "").split(" ")
        text = None if r.text is None else " ".join(w + (" the" if k % 9 == 0 else "") for k, w in enumerate(words))
        rows.append((r.doc_id, text, "en", f"src{r.doc_id % 3}", len(text or "")))
    rows += [(None, "the null id of a text " + " ".join(f"n{i}" for i in range(80)), "en", None, 5), rows[3]]
    path = str(tmp_path_factory.mktemp("corpus"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes)
        rows = out.collect()
        after = sorted(((r.doc_id, r.text) for r in rows), key=str)
        if k == 0:
            assert after == sorted(((d, t) for d, t in before if measures(t)[-1]), key=str) and len(after) > 20
        elif k == 1:
            ids = brute_components([x for x in before if x[0] is not None], 5, 80, 100)
            want = {(d, t) for d, t in before if d is None or ids[d][1] == d}
            assert after == sorted(want, key=str) and len(after) < len(before)
        else:
            last = (1 << 63) - 1
            cut = brute_words([(last if d is None else d, t) for d, t in before])
            want = []
            for d, t in before:
                _, removed, _, kept = cut[last if d is None else d]
                if kept:
                    want.append((d, t if not removed else kept))
            assert after == sorted(want, key=str)
            assert all(r.n_chars == len(r.text) for r in rows)
        out.write.parquet(f"{sf_dir}/stage{k}")
        docs = spark.read.parquet(f"{sf_dir}/stage{k}")


def test_run_packs_what_is_kept(spark, sf_dir):
    from tokenizers import Tokenizer

    from sigflow.llm.catalog import WORD_MODEL, tokenizer_path

    t = Tokenizer.from_file(tokenizer_path(WORD_MODEL))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    kept = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/stage2").collect()}
    parts = {}
    for r in rows:
        flat = np.frombuffer(r.ids, "<u4")
        assert len(flat) == r.length and r.doc_ids == [p.doc_id for p in r.pieces]
        for p in r.pieces:
            ids = flat[p.offset : p.offset + p.length]
            assert zlib.crc32(ids.tobytes()) == p.ids_crc32
            parts.setdefault(p.doc_id, []).append((p.start, ids.tolist()))
    assert parts.keys() == kept.keys()
    for d, text in kept.items():
        assert [i for _, x in sorted(parts[d]) for i in x] == [*t.encode(text, add_special_tokens=False).ids, 1]


def test_empty_table(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_further_columns_pass_through(spark, docs):
    """Columns named like the stages' own ones."""
    more = docs.selectExpr("doc_id", "concat(text, ' the and of')  as text", "lang", "string(source) as source",
                           "bigint(length(text)) as n_chars", "kept as quality", "row as keep", "1 as t")
    out = more
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, "")
    assert out.columns == more.columns
    known = {r.doc_id: (r.quality, r.keep, r.t) for r in more.collect()}
    assert all(known[r.doc_id] == (r.quality, r.keep, r.t) for r in out.collect())
