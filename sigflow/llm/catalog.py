"""Registered queries of the corpus operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.llm import oracle
from sigflow.llm.bestfit import pack_best_fit
from sigflow.llm.common import load
from sigflow.llm.html import extract_text
from sigflow.llm.jaccard import near_duplicates
from sigflow.llm.knn import exact_top_k
from sigflow.llm.mixture import pack_mixture, piece_rows
from sigflow.llm.pieces import decode, encode
from sigflow.llm.quality import quality_report
from sigflow.llm.runs import periodic_runs
from sigflow.llm.substring import repeated_words
from sigflow.llm.suffixes import repeated_bytes
from sigflow.llm.toxicity import fit_lexicon, score_toxicity
from sigflow.llm.trie import conversation_paths, prefix_trie, share_openings
from sigflow.llm.urls import judge_urls

Query = Callable[[SparkSession, str], DataFrame]



# Files of the public tokenizers; the folder is a parameter of every operator.
PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document with merge-dropout, and whether they decode to the text."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_path(PIECE_MODEL)
    return encode(docs, path, check=True).select("doc_id", F.size("ids").alias("n_ids"), "ids", "lossless")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: four-word shingles, similarity 0.85."""
    return near_duplicates(load(spark, sf_dir, "documents"), shingle=4, num=85, den=100)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document as repeats of 20 words or more, and a digest of the rest."""
    out = repeated_words(load(spark, sf_dir, "documents"))
    digest = F.sha2(F.encode("kept", "UTF-8"), 256)
    return out.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"), "n_spans")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fixed rule and verdict of every page's url."""
    labels = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull(), 0).alias("bad"),
    )
    return judge_urls(load(spark, sf_dir, "pages"), labels).drop("purity")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed id rows of all documents with segment lengths and position resets."""
    return pack_best_fit(load(spark, sf_dir, "documents"), tokenizer_path(WORD_MODEL))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    return quality_report(load(spark, sf_dir, "documents"))


def op7_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every vector whose id is divisible by 50, among all others."""
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(load(spark, sf_dir, "pages"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document as 50-byte strings of earlier documents, and a digest of the rest."""
    out = repeated_bytes(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, sources mixed in proportion."""
    docs = load(spark, sf_dir, "documents")
    return piece_rows(pack_mixture(docs, tokenizer_path(WORD_MODEL), with_ids=False))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a lexicon learned from the labels of four fifths of the ids."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    scored = score_toxicity(docs, fit_lexicon(docs, labels.filter(~held_out)))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted, "n_hits", "n_words")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, their openings shared within each hundred."""
    paths = conversation_paths(load(spark, sf_dir, "conversations"))
    return prefix_trie(share_openings(paths, every=100, most=6))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document: their number, the longest, digests of all of them and of the words left."""
    found = periodic_runs(load(spark, sf_dir, "documents"), planted=True)
    # the longest run, then the smallest start, then the smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    out = found.withColumns({"longest": longest, "lines": F.array_join(lines, "")})
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("longest.length") / -F.col("longest.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_voronoi_knn": op7_voronoi_knn,
    "op8_html_text": op8_html_text,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_mixture_packing": op10_mixture_packing,
    "op11_toxicity": op11_toxicity,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard": oracle.JACCARD,
    "op3_substring_dedup": oracle.SUBSTRING,
    "op4_url_filter": oracle.URLS,
    "op7_voronoi_knn": oracle.NEAREST,
    "op6_quality_rules": oracle.QUALITY,
    "op12_prefix_trie": oracle.TRIE,
}
