"""N-gram Jaccard join through a token-group matrix.

Every document is the set of its word shingles, as 64-bit hashes. Two sets
link at similarity ``num / den`` or more; the result is each document's
connected component.

1. ``describe``: size and a 128-bit fingerprint per document, and a sketch of
   token and word frequencies (fixed size). Equal sets are one entity from here
   on, so groups of copies cost one row per task.
2. ``prefix``: tokens are ordered by (frequency level, hash). The level is
   that of the token in the sketch or, for tokens that do not stand out there,
   follows from how often words like its own would meet by chance: that number
   grows with the corpus, and without it unlike documents of a large one share
   prefix tokens. Sets that link share at least l tokens within their first ``n - ceil(t n) + l`` tokens.
   Only these prefixes travel, packed by token bin, and only tokens held by
   several entities of fitting sizes remain: the entries of the matrix. An
   entity with fewer than l of them cannot link and leaves; l is a twentieth
   of the size, or ten, or half of a very small set, which chance sharing
   does not reach.
3. Entities that share l entries, directly or over others, form a family;
   entities of different families cannot link.
4. A family of at most ``LOCAL`` tokens is searched in one task. Its members are
   put in an order in which similar ones lie side by side (by the smallest of
   their scrambled shared tokens) and cut into groups. The matrix of groups and
   tokens holds the union of each group's tokens; a member's overlap with a
   union, against the sizes in the group, says whether the group can hold a
   partner. Only such groups are opened, and only for members not yet reached:
   one link to a component is enough.
5. A larger family is dealt over many tasks in parts of bounded size, each
   searched in the same way. A few hubs, the entities with the most shared
   entries, join every part, which ties the parts together. Across parts,
   entities of the smaller components query the parts of the larger ones: the
   matrix (token, part) names the parts that hold enough of their prefix tokens
   in fitting size, and a part is opened only if the query's overlap with the
   union of its tokens reaches the threshold.

No step forms the pairs of a group, and nothing but the sketch (fixed size)
reaches the driver. Overlaps are counted on 58-bit token hashes, sizes on 64.

Defined results: null or blank texts have the empty set and stay alone; texts
with fewer words than a shingle are the one sequence of their words; repeated
rows are copies of one entity; null ids are not chosen as component id unless
nothing else is there; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.llm import kernels as K
from sigflow.llm.common import column, free_name, shuffle_width
from sigflow.llm.graph import components
from sigflow.session import ensure_checkpoint_dir

SHINGLE = 5
NUM, DEN = 80, 100
SKETCH_BITS = 16
CHANCE = 11  # tokens expected less than 2 ** -CHANCE times by chance are of the lowest level
GROUP = 48  # entities in a group: small, so that groups spread evenly over tasks
LOCAL = 4_000_000  # tokens of a family that one task searches (32 MB)
HUBS = 4
LEAST = 10  # prefix tokens to share, beyond very small sets; see shared_least
FEW = 16  # holders up to which a token's holders are counted pair by pair
REMEMBERED = 500_000  # fingerprints a task keeps to skip copies
RELEASE = 200_000  # tokens of a family after which a task gives its memory back
SLICE_BYTES = 1 << 20
NO_ID = (1 << 63) - 1  # stands for a null id: after all others


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> K.U(64 - SKETCH_BITS)).astype(np.int64)


def _load(h: np.ndarray) -> np.ndarray:
    return np.bincount(_bucket(h), minlength=1 << SKETCH_BITS)


@dataclass(frozen=True)
class Order:
    """Order of tokens by frequency level, from the sketch: 0 to 31 by the chance of their words, above by their own load."""

    levels: np.ndarray  # by token bucket
    costs: np.ndarray  # by word bucket, 64ths of a bit
    base: int

    @classmethod
    def of(cls, tokens: np.ndarray, words: np.ndarray) -> Order:
        """From the loads of the token and the word buckets."""
        costs = np.round(64 * np.log2(max(1.0, words.sum()) / np.maximum(words, 1)))
        base = 64 * (np.log2(max(1.0, tokens.sum())) + CHANCE)
        return cls(frequency_levels(tokens).astype(np.uint8), costs.astype(np.uint16), int(base))

    def tokens(self, h: np.ndarray, words: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Numbers that sort by (level, hash) of tokens made of ``length`` words from ``first`` on."""
        cost = np.concatenate(([0], np.cumsum(self.costs[_bucket(words)], dtype=np.int64)))
        chance = np.clip((self.base - (cost[first + length] - cost[first])) >> 6, 0, 31)
        own = self.levels[_bucket(h)].astype(np.int64)
        return (np.where(own > 0, 32 + own, chance).astype(K.U) << K.U(58)) | (h >> K.U(6))


def _sort_rows(x: np.ndarray, at: np.ndarray) -> None:
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a > 1:
            x[a:b].sort()


def shingle_sets(
    buf: np.ndarray, offsets: np.ndarray, k: int, order: Order | None = None, load: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """Sorted distinct shingle hashes of all rows, and row offsets into them; with an
    ``order`` also their ordered tokens, sorted by row. ``load`` counts the words by bucket."""
    parts, sizes, tokens = [], [], []
    for i, j in K.slices(offsets, SLICE_BYTES):
        lo, hi = int(offsets[i]), int(offsets[j])
        seg = K.lower_ascii(buf[lo:hi])
        starts, ends, row = K.word_bounds(seg, offsets[i:j] - lo)
        words = K.word_hash(seg, starts, ends)
        count = np.bincount(row, minlength=j - i)
        first = np.concatenate(([0], np.cumsum(count)))[:-1]
        n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
        at = np.concatenate(([0], np.cumsum(n)))
        h = np.zeros(int(at[-1]), dtype=K.U)
        grams = K.sequence_hash(words, k)
        full = count >= k
        h[K.ranges(at[:-1][full], n[full])] = grams[K.ranges(first[full], n[full])]
        for m in range(1, k):  # short rows: all their words as one
            short = np.flatnonzero(count == m)
            if len(short):
                h[at[short]] = K.mix(K.sequence_hash(words, m)[first[short]] + K.U(m))
        if load is not None:
            load += _load(words)
        owner = np.repeat(np.arange(j - i), n)
        if order is not None:
            t = order.tokens(h, words, K.ranges(first, n), np.minimum(count, k)[owner])
            raw, unsorted = h.copy(), t.copy()
            _sort_rows(t, at)
        _sort_rows(h, at)
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        size = np.bincount(owner[new], minlength=j - i)
        if order is not None:
            own = np.ones(len(t), dtype=bool)
            own[1:] = (t[1:] != t[:-1]) | (owner[1:] != owner[:-1])
            for r in np.flatnonzero(np.bincount(owner[own], minlength=j - i) != size).tolist():
                # different hashes of one token: it stands for each of them
                a, b = int(at[r]), int(at[r + 1])
                once = np.unique(raw[a:b], return_index=True)[1]
                t[a : a + len(once)] = np.sort(unsorted[a:b][once])
                own[a:b] = np.arange(b - a) < len(once)
            tokens.append(t[own])
        parts.append(h[new])
        sizes.append(size)
    h = np.concatenate(parts) if parts else np.zeros(0, dtype=K.U)
    n = np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64)
    at = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
    return (h, at) if order is None else (h, at, np.concatenate(tokens) if tokens else h)


def _sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Wrapping sum of each row's values."""
    total = np.concatenate((np.zeros(1, dtype=K.U), np.cumsum(x, dtype=K.U)))
    return total[at[1:]] - total[at[:-1]]


def fingerprints(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    n = np.diff(at).astype(K.U)
    a = K.mix(_sums(K.mix(h + K.U(1)), at) + n)
    b = K.mix(_sums(K.mix(h ^ K.U(0x5851F42D4C957F2D)), at) ^ K.mix(n))
    return a.view(np.int64), b.view(np.int64)


DESCRIBED = "doc_id long, h long, n long, e long, f long, counts array<long>"


def _describe(k: int):
    names = ["doc_id", "h", "n", "e", "f", "counts"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 << SKETCH_BITS, dtype=np.int64)  # of tokens, then of words
        tokens, words = np.split(counts, 2)
        for batch in batches:
            h, at = shingle_sets(*K.text_buffer(batch.column(2)), k, load=words)
            tokens += _load(h)
            a, b = fingerprints(h, at)
            none = pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(np.diff(at)), pa.array(a), pa.array(b), none], names=names
            )
        if counts.any():
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, none, none, pa.array([counts], pa.list_(pa.int64()))], names=names
            )

    return run


def frequency_levels(counts: np.ndarray) -> np.ndarray:
    """0 for buckets of ordinary load, then one more for each doubling beyond four times the mean."""
    mean = max(1.0, counts.mean())
    return np.clip(np.floor(np.log2(np.maximum(counts, 1) / (2 * mean))), 0, 31).astype(K.U)


def _ordered_sets(buf, offsets, k: int, order: Order) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ordered tokens, row offsets and fingerprints of all rows."""
    h, at, t = shingle_sets(buf, offsets, k, order)
    return t, at, fingerprints(h, at)[0]


PREFIXES = "bin int, data binary"


def shared_least(n):
    """Prefix tokens that linked sets share, by the smaller size of the two."""
    return np.maximum(n // 8, np.minimum((n + 1) // 2, LEAST))


def _prefix(k: int, num: int, den: int, levels: Order, bins: int):
    """Prefixes by token bin: per entity its fingerprint, size and number of tokens there, then the tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            t, at, e = _ordered_sets(*K.text_buffer(batch.column(0)), k, levels)
            n = np.diff(at)
            fresh = np.zeros(len(n), dtype=bool)
            if len(seen) > REMEMBERED:
                seen.clear()
            for i, key in enumerate(zip(e.tolist(), n.tolist())):
                if key[1] and key not in seen:
                    seen.add(key)
                    fresh[i] = True
            size = np.where(fresh, np.minimum(n, n - (num * n + den - 1) // den + shared_least(n)), 0)
            token = K.mix(t[K.ranges(at[:-1], size)])
            row = np.repeat(np.arange(len(n)), size)
            of = (token % K.U(bins)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            of, token, row = of[order], token[order], row[order]
            edges = np.flatnonzero(np.diff(of, prepend=-1))
            data = []
            for a, b in zip(edges, [*edges[1:], len(of)]):
                first = np.flatnonzero(np.diff(row[a:b], prepend=-1))
                mine = row[a:b][first]
                top = token[a:b] >> K.U(16)  # 48 bits tell the tokens of a bin apart
                data.append(b"".join(x.tobytes() for x in (
                    np.array([len(mine), b - a], dtype="<i8"), e[mine], n[mine].astype("<i4"),
                    np.diff(np.append(first, b - a)).astype("<i4"), (top >> K.U(16)).astype("<u4"), top.astype("<u2"),
                )))
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[edges].astype(np.int32)), pa.array(data, pa.binary())], names=["bin", "data"]
            )

    return run


def _unpack_prefixes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m, total = np.frombuffer(data, "<i8", 2)
    at = 16
    out = []
    for kind, count in (("<i8", m), ("<i4", m), ("<i4", m), ("<u4", total), ("<u2", total)):
        out.append(np.frombuffer(data, kind, count, at))
        at += out[-1].nbytes
    e, n, held, high, low = out
    return (high.astype(np.int64) << 16) | low, np.repeat(e, held), np.repeat(n, held).astype(np.int64)


ENTRIES = "token long, e long, n int"


def _entries(num: int, den: int, bins: int):
    """Tokens of a bin held by several entities of fitting sizes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for b, data in zip(*(c.to_pylist() for c in batch.columns)):
                token, e, n = _unpack_prefixes(data)
                parts.append((np.full(len(token), b, dtype=np.int64), token, e, n))
        if not parts:
            return
        b, token, e, n = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((e, n, token, b))
        b, token, e, n = b[order], token[order], e[order], n[order]
        same = (token[1:] == token[:-1]) & (b[1:] == b[:-1])
        once = np.concatenate(([True], ~(same & (e[1:] == e[:-1]) & (n[1:] == n[:-1]))))
        b, token, e, n = b[once], token[once], e[once], n[once]
        # sizes are sorted within a token: a gap that no link can cross starts a new range
        same = (token[1:] == token[:-1]) & (b[1:] == b[:-1]) & (den * n[:-1] >= num * n[1:])
        edges = np.flatnonzero(np.concatenate(([True], ~same)))
        size = np.diff(np.append(edges, len(token)))
        keep = np.repeat(size > 1, size)
        name = K.mix(token.astype(K.U) * K.U(bins) + b.astype(K.U)).view(np.int64)  # one number for bin and token
        yield pa.RecordBatch.from_arrays(
            [pa.array(name[keep]), pa.array(e[keep]), pa.array(n[keep].astype(np.int32))], names=["token", "e", "n"]
        )
        del b, token, e, n, order, keep, name
        K.release()

    return run


def _least(n: Column) -> Column:
    """:func:`shared_least` as a column expression."""
    return F.greatest(F.floor(n / F.lit(8)), F.least(F.floor((n + F.lit(1)) / F.lit(2)), F.lit(LEAST)))


def _least_any(num: int, den: int) -> Column:
    """Tokens an entity of size ``n`` shares with any it links with."""
    return _least(F.ceil(F.lit(num) * F.col("n") / F.lit(den)))


def _able(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Entries of entities that hold enough of them to link, on tokens that several such entities hold."""
    able = entries.groupBy("e", "n").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") >= _least_any(num, den))
    left = entries.join(able.select("e", "n"), ["e", "n"])
    several = left.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return left.join(several, "token")


def _family_edges(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (u, v) over which every two entities that link are connected.

    On tokens of few holders (``FEW``) common tokens are counted pair by pair
    and a pair with enough of them is an edge. A linked pair with fewer must
    share the rest on tokens of many holders. There, entities that hold enough
    of those to make up for the most they share otherwise are tied to the
    token's smallest such entity.
    """
    few = entries.filter(F.col("c") <= FEW).groupBy("token").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("a"))
    a = F.col("a")
    fits = lambda x, y: F.lit(den) * x["n"] >= F.lit(num) * y["n"]
    later = lambda x, i: F.filter(F.slice(a, i + 2, F.lit(FEW)), lambda y: fits(x, y))
    pair = lambda x, y: F.struct(x["e"].alias("u"), y["e"].alias("v"), x["n"].alias("n"), y["n"].alias("m"))
    pairs = few.select(F.explode(F.flatten(F.transform(a, lambda x, i: F.transform(later(x, i), lambda y: pair(x, y))))).alias("p"))
    common = pairs.groupBy("p.u", "p.v", "p.n", "p.m").agg(F.count(F.lit(1)).alias("common")).checkpoint()
    enough = F.col("common") >= _least(F.col("n"))
    rest = common.filter(~enough)
    most = rest.select(F.col("u").alias("e"), "n", "common").unionByName(
        rest.select(F.col("v").alias("e"), F.col("m").alias("n"), "common")
    ).groupBy("e", "n").agg(F.max("common").alias("most"))
    many = entries.filter(F.col("c") > FEW)
    held = many.groupBy("e", "n").agg(F.count(F.lit(1)).alias("held")).join(most, ["e", "n"], "left")
    held = held.filter(F.col("held") >= _least_any(num, den) - F.coalesce("most", F.lit(0)))
    many = many.join(held.select("e", "n"), ["e", "n"])
    leaders = many.groupBy("token").agg(F.min("e").alias("v"))
    tied = many.join(leaders, "token").select(F.col("e").alias("u"), "v")
    return common.filter(enough).select("u", "v").unionByName(tied).distinct()


def _sets(k: int, levels: Order, columns: list[str]):
    """mapInArrow body: replaces the last column (text) by its ordered tokens.

    The first column names the entity; another text under the same document id is left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, at, e = _ordered_sets(*K.text_buffer(batch.column(batch.num_columns - 1)), k, levels)
            tokens = K.binary_column(t.view(np.uint8), at[:-1] * 8, at[1:] * 8)
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens], names=columns)
            yield out.filter(pa.array(e == batch.column(0).to_numpy()))

    return run


class TokenSets:
    """Sets of a group, given as Arrow columns of packed tokens, over a local numbering of tokens."""

    def __init__(self, *columns: pa.Array):
        parts = [K.text_buffer(c) for c in columns]
        t = np.concatenate([buf for buf, _ in parts]).view("<u8")
        self.size = np.concatenate([np.diff(offsets) // 8 for _, offsets in parts])
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        order = np.argsort(t)
        t = t[order]
        new = np.concatenate((np.zeros(min(1, len(t)), dtype=bool), t[1:] != t[:-1]))
        del t
        self.token = np.empty(len(order), dtype=np.int32)
        self.token[order] = np.cumsum(new, dtype=np.int32)
        self.n_tokens = int(new.sum()) + min(1, len(new))
        self.mark = np.zeros(self.n_tokens, dtype=np.int32)

    def tokens(self, i: int) -> np.ndarray:
        return self.token[self.at[i] : self.at[i + 1]]

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of several rows one after another, and where each row starts."""
        return self.token[K.ranges(self.at[rows], self.size[rows])], np.concatenate(([0], np.cumsum(self.size[rows])))[:-1]

    def union(self, tokens: np.ndarray) -> np.ndarray:
        u = np.zeros(self.n_tokens, dtype=bool)
        u[tokens] = True
        return u

    def linked(self, q: int, rows: np.ndarray, gathered, union: np.ndarray, num: int, den: int) -> np.ndarray:
        """Which of ``rows`` link with q; the union bounds the overlap with all of them first."""
        mine = self.tokens(q)
        if not len(rows) or (num + den) * int(union[mine].sum()) < num * (len(mine) + int(self.size[rows].min())):
            return rows[:0]
        self.mark[mine] = 1
        tokens, starts = gathered
        overlap = np.add.reduceat(self.mark[tokens], starts).astype(np.int64)
        self.mark[mine] = 0
        return rows[(num + den) * overlap >= num * (len(mine) + self.size[rows])]


EDGES = "u long, v long"
_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _edge_table(u: list, v: list) -> pa.Table:
    return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_EDGES)


def similar_groups(sets: TokenSets, size: int) -> list[np.ndarray]:
    """Members in groups of ``size``, similar ones together: in the order of the two
    smallest scrambled tokens that others hold too, then by size."""
    m = len(sets.size)
    if m <= size:
        return [np.arange(m)]
    held = np.bincount(sets.token, minlength=sets.n_tokens) > 1
    scrambled = (K.mix(np.arange(sets.n_tokens, dtype=K.U) + K.U(1)) >> K.U(33)).astype(np.uint32)
    none = np.uint32((1 << 32) - 1)
    keys = np.where(held, scrambled, none)[sets.token]
    filled = np.flatnonzero(sets.size)
    least = [np.full(m, none), np.full(m, none)]
    for key in least:
        key[filled] = np.minimum.reduceat(keys, sets.at[filled])
        keys = np.where(keys == np.repeat(key, sets.size), none, keys)
    order = np.lexsort((sets.size, *reversed(least)))
    return [order[k : k + size] for k in range(0, m, size)]


def qualifying(sets: TokenSets, groups: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Matrix (member, group): whether the member's overlap with the union of the group's
    tokens, those of other members, can reach the threshold with a size in the group."""
    m = len(sets.size)
    out = np.zeros((m, len(groups)), dtype=bool)
    filled = np.flatnonzero(sets.size)
    for g, rows in enumerate(groups):
        held = np.bincount(sets.gather(rows)[0], minlength=sets.n_tokens)
        overlap = np.zeros(m, dtype=np.int64)
        overlap[filled] = np.add.reduceat((held > 0)[sets.token], sets.at[filled])
        twice = held > 1
        for i in rows.tolist():  # a member's own tokens count only if another one holds them
            overlap[i] = int(twice[sets.tokens(i)].sum())
        n = sets.size
        least = np.maximum(sets.size[rows].min(), -(-num * n // den))  # smallest fitting size in the group
        fits = (least <= sets.size[rows].max()) & (den * n >= num * least)
        out[:, g] = fits & ((num + den) * overlap >= num * (n + least))
    return out


def _components_of_group(num: int, den: int, size: int):
    """Components within a family or a part of one, as edges to one member each; hubs are searched from first."""

    def run(group: pa.Table) -> pa.Table:
        e = group.column("e").to_pylist()
        sets = TokenSets(group.column("tokens"))
        frequency = np.bincount(sets.token, minlength=sets.n_tokens)
        weight = np.array([int(frequency[sets.tokens(i)].sum()) for i in range(len(e))])
        hub = np.array(group.column("hub").to_pylist(), dtype=bool)
        groups = similar_groups(sets, size)
        of = np.empty(len(e), dtype=np.int64)
        for g, rows in enumerate(groups):
            of[rows] = g
        may = qualifying(sets, groups, num, den) if len(groups) > 1 else np.ones((len(e), 1), dtype=bool)
        waiting = np.ones(len(e), dtype=bool)  # not yet reached
        opened: dict[int, tuple] = {}  # group: its waiting members, their tokens, the union of these
        u, v = [], []
        for seed in np.lexsort((-weight, ~hub)).tolist():
            if not waiting[seed]:
                continue
            waiting[seed] = False
            opened.pop(int(of[seed]), None)
            queue = [seed]
            while queue:
                q = queue.pop()
                for g in np.flatnonzero(may[q]).tolist():
                    if g not in opened:
                        rows = groups[g][waiting[groups[g]]]
                        tokens = sets.gather(rows)
                        opened[g] = rows, tokens, sets.union(tokens[0])
                    found = sets.linked(q, *opened[g], num, den)
                    if len(found):
                        u += [e[i] for i in found.tolist()]
                        v += [e[seed]] * len(found)
                        queue += found.tolist()
                        waiting[found] = False
                        del opened[g]
        if sets.at[-1] > RELEASE:
            del sets, may, opened
            K.release()
        return _edge_table(u, v)

    return run


def _open_group(num: int, den: int):
    """Links from queries to one group (members of one component): at most one per query."""

    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        u, v = [], []
        if members.num_rows and queries.num_rows:
            m, q = members.column("e").to_pylist(), queries.column("e").to_pylist()
            sets = TokenSets(members.column("tokens"), queries.column("tokens"))
            rows = np.arange(len(m))
            gathered = sets.gather(rows)
            union = sets.union(gathered[0])
            for i, e in enumerate(q):
                found = sets.linked(len(m) + i, rows, gathered, union, num, den)
                if len(found):
                    u.append(e)
                    v.append(m[int(found[0])])
        return _edge_table(u, v)

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, num: int = NUM,
    den: int = DEN, group: int = GROUP, local: int = LOCAL,
) -> DataFrame:
    """doc_id, n_shingles (long), component_id (smallest id reachable by links, itself included)."""
    rows, reps, found = _linked(docs, id_col, text_col, shingle, num, den, group, local)
    least = reps.join(found, reps["e"] == found["node"]).groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = found.join(least, "comp").select(F.col("node").alias("e"), "component_id")
    classes = reps.join(named, "e", "left").select(
        "n", "e", "f", F.coalesce("component_id", "rep").alias("component_id")
    )
    out = rows.join(classes, ["n", "e", "f"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
    )


def _linked(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, num: int = NUM, den: int = DEN,
    group: int = GROUP, local: int = LOCAL,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, a text hash h, n, e, f), entities (n, e, f and their smallest id rep)
    and the components (node, comp) of the entities ``e`` that link with any."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    if 2 * num < den:
        raise ValueError("the prefix rule takes a similarity of one half or more")
    width = shuffle_width(spark)
    slim = docs.select(
        F.coalesce(column(docs, id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(column(docs, text_col).cast("string")).alias("h"),
        column(docs, text_col).cast("string").alias("text"),
    )

    described = slim.mapInArrow(_describe(shingle), DESCRIBED).checkpoint()
    load = (
        described.filter("counts is not null").select(F.posexplode("counts").alias("b", "c"))
        .groupBy("b").agg(F.sum("c").alias("c")).collect()
    )  # 2 ** SKETCH_BITS rows of tokens, as many of words
    counts = np.zeros(2 << SKETCH_BITS)
    for r in load:
        counts[r.b] = r.c
    levels = Order.of(*np.split(counts, 2))
    rows = described.filter("counts is null").select("doc_id", "h", "n", "e", "f")
    reps = rows.filter("n > 0").groupBy("n", "e", "f").agg(F.min("doc_id").alias("rep"))

    bins = width + 1
    prefixes = slim.select("text").mapInArrow(_prefix(shingle, num, den, levels, bins), PREFIXES)
    entries = prefixes.repartition(width, "bin").mapInArrow(_entries(num, den, bins), ENTRIES).checkpoint()
    entries = _able(entries, num, den).checkpoint()

    families = components(_family_edges(entries, num, den))
    held = entries.groupBy("e").agg(F.count(F.lit(1)).alias("held"), F.max("n").alias("n"))
    members = families.join(held, F.col("node") == F.col("e"))
    parts = F.when(F.sum("n") <= local, 1).otherwise(F.ceil(F.count(F.lit(1)) / F.lit(group)))
    sizes = members.groupBy("comp").agg(parts.cast("int").alias("groups"))
    placed = (
        members.join(sizes, "comp")
        .select("e", F.col("comp").alias("family"), "groups", "held")
        .withColumn("part", F.pmod(F.xxhash64("e"), F.col("groups")).cast("int"))
    )
    placed = placed.checkpoint()
    hubs = (
        placed.filter("groups > 1").groupBy("family", F.pmod(F.hash("e"), F.lit(HUBS)).alias("h"))
        .agg(F.max_by("e", F.struct("held", -F.col("e"))).alias("e")).select("e", F.lit(True).alias("hub"))
    )
    wanted = placed.join(hubs, "e", "left").join(reps.select("e", F.col("rep").alias("doc_id")), "e").select(
        "doc_id", "e", "family", "part", "groups", F.coalesce("hub", F.lit(False)).alias("hub")
    )
    texts = wanted.join(slim.select("doc_id", "text"), "doc_id")
    names = ["e", "family", "part", "groups", "hub", "tokens"]
    sets = texts.select("e", "family", "part", "groups", "hub", "text").mapInArrow(
        _sets(shingle, levels, names), "e long, family long, part int, groups int, hub boolean, tokens binary"
    ).checkpoint()

    everywhere = F.when(F.col("hub"), F.sequence(F.lit(0), F.col("groups") - 1)).otherwise(F.array("part"))
    grouped = sets.select("e", "family", "hub", "tokens", F.explode(everywhere).alias("part"))
    links = grouped.groupBy("family", "part").applyInArrow(_components_of_group(num, den, group), EDGES).checkpoint()
    if placed.filter("groups > 1").limit(1).count():
        links = links.unionByName(_across(placed, entries, sets, links, num, den, group))

    return rows, reps, components(links)


def _across(placed, entries, sets, links, num: int, den: int, group: int) -> DataFrame:
    """Links between components that lie in different groups of one family."""
    found = components(links)
    large = placed.filter("groups > 1").join(found, F.col("e") == F.col("node"), "left").select(
        "e", "family", "part", F.coalesce("comp", "e").alias("c")
    )
    sizes = large.groupBy("c").agg(F.count(F.lit(1)).alias("size"))
    large = large.join(sizes, "c").checkpoint()
    held = entries.select("token", "e", "n").join(large, "e")
    matrix = held.groupBy("token", "family", "part", "c", "size").agg(F.min("n").alias("n0"), F.max("n").alias("n1"))
    g = matrix.select(
        "token", F.col("family").alias("gf"), F.col("part").alias("gp"), F.col("c").alias("gc"),
        F.col("size").alias("gs"), "n0", "n1",
    )
    smaller = F.struct("size", "c") < F.struct("gs", "gc")
    fits = (F.lit(den) * F.col("n1") >= F.lit(num) * F.col("n")) & (F.lit(den) * F.col("n") >= F.lit(num) * F.col("n0"))
    visits = (
        held.join(g, "token").filter((F.col("c") != F.col("gc")) & (F.col("part") != F.col("gp")) & smaller & fits)
        .groupBy("e", "n", "gf", "gp", "gc").agg(F.count(F.lit(1)).alias("common"))
        .filter(F.col("common") >= _least_any(num, den))
        .select("e", "gf", "gp", "gc").checkpoint()
    )
    # queries of a group in blocks; its members once per block
    blocks = visits.groupBy("gf", "gp", "gc").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).cast("int").alias("blocks"))
    where = ["gf", "gp", "gc", "block"]
    asked = visits.join(blocks, ["gf", "gp", "gc"]).join(sets.select("e", "tokens"), "e").select(
        *(F.col(c).alias(c) for c in ("e", "tokens", "gf", "gp", "gc")),  # columns apart from the members'
        F.pmod(F.xxhash64("e"), F.col("blocks")).cast("int").alias("block")
    )
    members = large.select("e", F.col("family").alias("gf"), F.col("part").alias("gp"), F.col("c").alias("gc"))
    members = members.join(blocks, ["gf", "gp", "gc"]).join(sets.select("e", "tokens"), "e").select(
        "e", "tokens", "gf", "gp", "gc", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    return members.groupBy(*where).cogroup(asked.groupBy(*where)).applyInArrow(_open_group(num, den), EDGES).checkpoint()


SALTS = 32  # parts that rows repeated with one id and text are first reduced in


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for every component, the one with its smallest id.

    Rows are judged by their own text, whatever id they share or lack; a row without an id stays only if its
    component has no id. Of rows repeated with one id and text one stays. Blank texts are alone, of equal ones
    with the same id one stays.
    """
    rows, _, found = _linked(docs, id_col, text_col, **options)
    judged = rows.join(found, F.col("e") == F.col("node"), "left").select(
        F.col("doc_id").alias("k"), "h", F.coalesce("comp", "e").alias("c"), (F.col("n") == 0).alias("blank")
    )
    # a null id sorts after all others; of one id's texts in a component the one of smaller hash stays
    first = judged.filter("not blank").groupBy("c").agg(F.min(F.struct("k", "h")).alias("w")).select("w.k", "w.h")
    blank = judged.filter("blank").select("k", "h").distinct()
    times = judged.groupBy("k", "h").agg(F.count(F.lit(1)).alias("times"))
    kept = first.unionByName(blank).distinct().join(times, ["k", "h"]).checkpoint()

    names = {x: free_name(docs, x) for x in ("k", "h", "salt")}
    keyed = docs.withColumns({
        names["k"]: F.coalesce(column(docs, id_col).cast("long"), F.lit(NO_ID)),
        names["h"]: F.xxhash64(column(docs, text_col).cast("string")),
    })
    once = kept.filter("times = 1").select(F.col("k").alias(names["k"]), F.col("h").alias(names["h"]))
    alone = keyed.join(once, [names["k"], names["h"]], "left_semi")
    # repeated rows in parts first: a third of all rows may be one of them
    again = kept.filter("times > 1").select(
        F.col("k").alias(names["k"]), F.col("h").alias(names["h"]),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(names["salt"]),
    )
    salted = keyed.withColumn(names["salt"], F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    parts = salted.join(again, [names["k"], names["h"], names["salt"]], "left_semi")
    reduced = parts.dropDuplicates([names["k"], names["h"], names["salt"]]).drop(names["salt"])
    out = alone.unionByName(reduced.dropDuplicates([names["k"], names["h"]]))
    return out.select(*(column(out, c) for c in docs.columns))
