"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding undoes the usual disguises before anything is matched: compatibility
forms, letters of other scripts that look Latin, invisible characters, digits
and symbols in place of letters, letters set apart by dots, and letters held
down. What is no letter becomes one space, so a lexicon entry states its word
boundaries by spaces: `` idiot `` is a word, `` low`` a word's beginning.

The lexicon is learned from labelled documents. In how many different
surroundings (the words before and after) a piece of a word occurs in toxic and
in clean documents is compared; copies of a document add no surroundings. A
piece is an entry if a difference like its own would be chance in fewer than
``exp(-SURE)`` of pieces. Entries are chosen one after the other, the surest
first and of equal ones the longest, each judged by the words that none before
it covers. Its weight is the log of its odds against the corpus's. Words and
pairs of words around an entry that occur in clean documents nearly always are
exception phrases: matches inside of them count for nothing.

A document's weight is the sum over its words of the heaviest entry that
matches there. A logistic curve over it and over its share of the document's
length gives the score.

The fit reads a bounded sample of the labelled documents, ``TOXIC_ROWS`` and
``CLEAN_ROWS`` about, drawn by a hash of their ids; the score reads every
document whole.

Defined results: null, empty and blank texts weigh nothing and get the score
of a text without matches; of a document labelled more than once the highest
label holds; null labels and labels without a document count for nothing;
without toxic labels all scores are 0, without clean ones 1; every row is
scored by itself, repeated rows and null ids included; an empty table gives an
empty result; only the named columns are read, whatever further columns are
called.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import column
from sigflow.session import ensure_checkpoint_dir

# Labelled documents that the fit reads at most, about, of either kind.
TOXIC_ROWS, CLEAN_ROWS = 4_000, 8_000
# Pieces of words that are weighed: letters with the boundaries as spaces; whole words besides.
SHORTEST, LONGEST = 4, 12
# Longer words (codes, addresses run together) are weighed whole only.
LONGEST_WORD = 64
SURE = 16.0
LEAST_ODDS = 10.0  # times the corpus's odds
PIECES = 50_000  # pieces that the driver chooses entries from, the surest first
# A phrase around an entry is an exception if seen in so many clean surroundings, and so rarely in toxic ones.
EXCEPTION_LEAST, EXCEPTION_TOXIC = 3, 0.1

# Letters of other scripts by the Latin letter they look like.
HOMOGLYPHS = {
    "a": "аαɑ", "b": "вЬ", "c": "сϲ", "d": "ԁ", "e": "еεє", "g": "ɡ", "h": "һн", "i": "іιı", "j": "ј", "k": "кκ",
    "l": "ӏǀ", "m": "м", "n": "ոη", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν",
    "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
# Digits and symbols by the letter they stand for.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_LOOKS = str.maketrans({c: k for k, group in HOMOGLYPHS.items() for c in group} | {c: None for c in "\u00ad\u200b\u200c\u200d\u2060\ufeff"})
_STANDS = str.maketrans(SUBSTITUTES)
_MARKS = re.compile("[\u0300-\u036f]+")
_LETTER = r"[^\W\d_]"
_STANDING = re.compile(rf"(?<={_LETTER})[013457@$!|8]+(?={_LETTER})|(?<![\w@$!|])[013457@$8]+(?={_LETTER}(?:{_LETTER}|[013457@$!|8]))")
_SET_APART = re.compile(rf"(?<!\w){_LETTER}(?:[.\-*·]{_LETTER}){{2,}}(?!\w)")
_APART = re.compile(r"[.\-*·]")
_HELD = re.compile(rf"({_LETTER})\1{{2,}}")
_REST = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Words of a text in lower case, disguises undone, each between spaces."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii():
        # a second composition, as a mark may only now follow a Latin letter
        text = unicodedata.normalize("NFKC", text).lower().translate(_LOOKS)
        text = _MARKS.sub("", unicodedata.normalize("NFC", text))
    text = _STANDING.sub(lambda m: m[0].translate(_STANDS), text)
    text = _SET_APART.sub(lambda m: _APART.sub("", m[0]), text)
    text = _HELD.sub(r"\1", text)
    text = _REST.sub(" ", text).strip()
    return f" {text} " if text else " "


@dataclass
class Lexicon:
    """Weights of entries, exception phrases (both as folded text), and the curve of
    the score: bias, factor of the log weight, factor of the log share."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-math.inf, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        out = ahocorasick.Automaton()
        for phrase in self.exceptions:
            out.add_word(phrase, (len(phrase), None))
        for entry, weight in self.weights.items():
            if entry not in self.exceptions:
                out.add_word(entry, (len(entry), weight))
        out.make_automaton()
        return out


def matches(automaton: ahocorasick.Automaton | None, folded: str) -> dict[int, float]:
    """Heaviest entry of every matched word, by the place of the space before the word."""
    if automaton is None:
        return {}
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
            continue
        word = folded.rfind(" ", 0, start + 1)
        if weight > best.get(word, 0.0):
            best[word] = weight
    # an exception phrase begins and ends with the spaces around its words
    return {w: x for w, x in best.items() if not any(a <= w < b for a, b in spared)} if spared else best


def _features(automaton, folded: str) -> tuple[int, int, float]:
    """Words, matched words and their weight."""
    found = matches(automaton, folded)
    return max(folded.count(" ") - 1, 0), len(found), math.fsum(found.values())


def _curve_inputs(n_words: np.ndarray, weight: np.ndarray) -> np.ndarray:
    share = 1000 * weight / np.maximum(n_words, 1)
    return np.stack((np.ones(len(weight)), np.log1p(weight), np.log1p(share)), axis=1)


def _fit_curve(x: np.ndarray, y: np.ndarray, row_weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Logistic regression by Newton steps; factors are not negative."""
    use = list(range(x.shape[1]))
    total = row_weight.sum()
    while True:
        z, b = x[:, use], np.zeros(len(use))
        keep = np.diag([0.0] + [ridge * total / 100] * (len(use) - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            slope = z.T @ (row_weight * (y - p)) - keep @ b
            bend = (z * (row_weight * p * (1 - p))[:, None]).T @ z + keep + 1e-9 * np.eye(len(use))
            step = np.clip(np.linalg.solve(bend, slope), -2, 2)
            b = b + step
            if np.abs(step).max() < 1e-8:
                break
        low = [k for k, v in zip(use, b) if k and v < 0]
        if not low:
            out = np.zeros(x.shape[1])
            out[use] = b
            return out
        use.remove(low[-1])


def _folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([fold(t) for t in batch.column(1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["toxic", "folded"])


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many different surroundings a word stands in
    toxic and in clean documents. ``sample`` has folded and toxic."""
    words = F.split(F.trim("folded"), " ")
    around = F.arrays_zip(
        F.col("w").alias("word"), F.concat(F.array(F.lit("")), "w").alias("before"),
        F.concat(F.slice("w", F.lit(2), F.size("w")), F.array(F.lit(""))).alias("after"),
    )
    rows = sample.select("toxic", words.alias("w")).select("toxic", F.explode(around).alias("a")).filter("a.word != ''")
    seen = rows.select(F.col("a.word").alias("word"), F.xxhash64("a.before", "a.after").alias("around"), "toxic").distinct()
    return seen.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def piece_counts(words: DataFrame) -> DataFrame:
    """(piece, toxic, clean) of all pieces of the words, boundaries as spaces."""
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    whole = F.array(padded)
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length(padded)))
    parts = F.flatten(F.transform(lengths, lambda k: F.transform(
        F.sequence(F.lit(1), F.length(padded) - k + 1), lambda i: F.substr(padded, i, k))))
    fits = F.length(padded).between(SHORTEST, LONGEST_WORD + 2)
    pieces = F.array_distinct(F.when(fits, F.concat(parts, whole)).otherwise(whole))
    rows = words.select("toxic", "clean", F.explode(pieces).alias("piece"))
    return rows.groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def sureness(toxic: float, clean: float, rate: float) -> float:
    """Half the log likelihood ratio of the counts against the corpus's rate: -log
    of the chance of such a difference, about. 0 where the piece isn't the more toxic."""
    n = toxic + clean
    if toxic <= n * rate:
        return 0.0
    return toxic * math.log(toxic / (n * rate)) + (clean * math.log(clean / (n * (1 - rate))) if clean else 0.0)


def pieces_of(word: str) -> set[str]:
    padded = f" {word} "
    if not SHORTEST <= len(padded) <= LONGEST_WORD + 2:
        return {padded}
    return {padded} | {
        padded[i : i + k] for k in range(SHORTEST, min(LONGEST, len(padded)) + 1) for i in range(len(padded) - k + 1)
    }


def choose_entries(
    pieces: list[tuple[str, int, int]], words: list[tuple[str, int, int]], toxic: int, clean: int
) -> dict[str, float]:
    """Weights of the entries among (piece, toxic, clean), the surest first, of
    equal ones the longest. Words that hold an entry are covered: they leave the
    counts of all other pieces. ``words`` are those seen in toxic documents;
    ``toxic`` and ``clean`` the corpus's counts."""
    rate, odds = toxic / (toxic + clean), toxic / clean
    total = {p: (t, c) for p, t, c in pieces}
    left = {p: [t, c] for p, t, c in pieces}
    order = lambda p: (-sureness(*left[p], rate), -len(p), p)
    queue = [order(p) for p in left]
    heapq.heapify(queue)
    open_words = [(f" {w} ", t, c) for w, t, c in words]
    chosen: dict[str, float] = {}
    while queue:
        first = heapq.heappop(queue)
        piece = first[2]
        now = order(piece)
        t, c = left[piece]
        if -now[0] < SURE or (t + 0.5) / (c + 0.5) < LEAST_ODDS * odds:
            continue
        if now != first:
            heapq.heappush(queue, now)
            continue
        t, c = total[piece]
        chosen[piece] = math.log((t + 0.5) / (c + 0.5) / odds)
        rest = []
        for word in open_words:
            if piece not in word[0]:
                rest.append(word)
                continue
            for p in pieces_of(word[0][1:-1]):
                if p in left:
                    left[p][0] -= word[1]
                    left[p][1] -= word[2]
        open_words = rest
    return {p: w for p, w in chosen.items() if w > 0}


def _phrases(lexicon: Lexicon):
    """mapInArrow body over (toxic, folded): words and pairs around matched words, with their surroundings."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            out = []
            for toxic, folded in zip(*(c.to_pylist() for c in batch.columns)):
                found = matches(automaton, folded)
                if not found:
                    continue
                words = folded.split()
                place, at = {}, 0
                for k, w in enumerate(words):
                    place[at] = k
                    at += len(w) + 1
                for word in found:
                    k = place[word]
                    before, this, after = (words[j] if 0 <= j < len(words) else "" for j in (k - 1, k, k + 1))
                    out.append((f" {this} ", before, after, toxic))
                    if before:
                        out.append((f" {before} {this} ", words[k - 2] if k > 1 else "", after, toxic))
                    if after:
                        out.append((f" {this} {after} ", before, words[k + 2] if k + 2 < len(words) else "", toxic))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], pa.int32())],
                    names=["phrase", "before", "after", "toxic"],
                )

    return run


def fit_lexicon(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, exceptions: tuple[str, ...] = (),
) -> Lexicon:
    """Learn a lexicon from ``docs`` and the 0/1 labels of ``labels`` (same id
    column). ``exceptions`` are further phrases in which nothing counts."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    given = labels.select(
        column(labels, id_col).cast("long").alias("of"), column(labels, label_col).cast("int").alias("toxic")
    ).filter("of IS NOT NULL AND toxic IN (0, 1)").groupBy("of").agg(F.max("toxic").alias("toxic"))
    n = given.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    if not n.toxic or not n.clean:
        return Lexicon(curve=(math.inf if n.toxic else -math.inf, 0.0, 0.0))
    # by a hash of the id: the same documents whatever the partitions; ids of the sample are bounded by its size
    share = F.when(F.col("toxic") == 1, toxic_rows / n.toxic).otherwise(clean_rows / n.clean)
    drawn = given.filter(F.pmod(F.xxhash64("of"), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).cast("string").alias("text"))
    joined = texts.join(F.broadcast(drawn), F.col("id") == F.col("of")).select("toxic", "text")
    sample = joined.mapInArrow(_folded, "toxic int, folded string").checkpoint()

    words = word_counts(sample).checkpoint()
    total = words.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    if not total.t or not total.c:
        return Lexicon(curve=(math.log(n.toxic / n.clean), 0.0, 0.0))
    odds, rate = total.t / total.c, total.t / (total.t + total.c)
    t, c = F.col("toxic"), F.col("clean")
    # half the log likelihood ratio against the corpus's rate: -log of the chance of such a difference, about
    ratio = t * F.log(t / ((t + c) * rate)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - rate)))).otherwise(0.0)
    sure = piece_counts(words).filter("toxic > 0").withColumn("sure", ratio).filter(
        (F.col("sure") >= SURE) & ((t + 0.5) / (c + 0.5) >= LEAST_ODDS * odds))
    best = sure.orderBy(F.desc("sure"), "piece").limit(PIECES).select("piece", "toxic", "clean").collect()
    # the words of the sample's toxic documents: bounded as the sample is
    said = words.filter("toxic > 0").select("word", "toxic", "clean").collect()
    chosen = choose_entries([tuple(r) for r in best], [tuple(r) for r in said], total.t, total.c)
    lexicon = Lexicon(chosen, tuple(f" {fold(x).strip()} " for x in exceptions))

    around = sample.mapInArrow(_phrases(lexicon), "phrase string, before string, after string, toxic int").distinct()
    seen = around.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    clean = seen.filter((F.col("clean") >= EXCEPTION_LEAST) & (t <= EXCEPTION_TOXIC * (t + c)))
    found = clean.orderBy(F.desc("clean"), "phrase").limit(PIECES).collect()
    lexicon.exceptions = tuple(sorted({*lexicon.exceptions, *(r.phrase for r in found)}))

    rows = sample.mapInArrow(_weigh(lexicon), "toxic int, n_words long, n_hits long, weight double").toPandas()
    y = rows.toxic.to_numpy(dtype=float)
    drawn_of = {1: max(1, int(y.sum())), 0: max(1, int((1 - y).sum()))}
    row_weight = np.where(y == 1, n.toxic / drawn_of[1], n.clean / drawn_of[0])
    x = _curve_inputs(rows.n_words.to_numpy(dtype=float), rows.weight.to_numpy(dtype=float))
    lexicon.curve = tuple(_fit_curve(x, y, row_weight / row_weight.mean()).tolist())
    return lexicon


def _weigh(lexicon: Lexicon):
    """mapInArrow body over (first column, folded)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows = [_features(automaton, t) for t in batch.column(1).to_pylist()]
            n_words, hits, weight = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(hits, pa.int64()), pa.array(weight, pa.float64())],
                names=["toxic", "n_words", "n_hits", "weight"],
            )

    return run


def _score(lexicon: Lexicon):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, curve = lexicon.automaton(), np.array(lexicon.curve)
        for batch in batches:
            rows = np.array([_features(automaton, fold(t)) for t in batch.column(1).to_pylist()]).reshape(-1, 3)
            z = curve[0] + _curve_inputs(rows[:, 0], rows[:, 2])[:, 1:] @ curve[1:]
            score = 1 / (1 + np.exp(-np.clip(z, -700, 700))) if np.isfinite(curve[0]) else np.full(len(rows), float(curve[0] > 0))
            ints = [pa.array(rows[:, k].astype(np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), *ints, pa.array(rows[:, 2])],
                names=["doc_id", "score", "n_words", "n_hits", "weight"],
            )

    return run


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, score (0 to 1), n_words, n_hits (matched words) and weight (their sum)."""
    slim = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return slim.mapInArrow(_score(lexicon), "doc_id long, score double, n_words long, n_hits long, weight double")
