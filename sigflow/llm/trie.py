"""Prefix trie over conversations: which turns many conversations share, and what sharing them saves.

A node is a distinct sequence of first turns (role and text); its members are
the conversations that start with it. Turns are named by a 128-bit digest, so
a conversation is a key of 16 bytes a turn; texts don't travel.

The keys are range-partitioned in lexicographic order, so conversations with
a common prefix lie side by side, and equal ones are dealt by their ids too:
a prefix that a third of all conversations share is spread like any other.
Sorted keys are cut into shards of a bounded number of turns. A shard holds
its part of the trie as balanced parentheses: a range min-max tree over blocks
of excess finds the closing parenthesis of every node, which delimits its
subtree; ranks of leaf pairs "()" count leaves, and differences of cumulative
arrays give members and savings.

Only the paths to a shard's first and last conversation can go on in the
shards beside it. Those spines come out with what hangs off them, and are
merged by the same construction: the shards of a partition, then ``FAN`` of
their results, and so on up to the root. All other nodes are complete at once.
The digest of a node's ends is a running hash over sorted pieces of ids; one
task reads the pieces of one node as a stream.

Defined results: turns are ordered by number, null first, equal numbers by
their digest; null roles and texts are empty; rows without a conversation id
belong to no conversation and are left out; repeated rows are repeated turns;
an empty table gives no nodes, not even a root; texts of any length count in
full; a conversation's key is held in one row. Only the four named columns
are read, whatever further columns are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import column, shuffle_width
from sigflow.llm.kernels import ranges
from sigflow.session import ensure_checkpoint_dir

UNIT = 16  # bytes of a turn's digest
SHARD = 500_000  # turns of a shard, a little more with its last conversations
FAN = 64  # shards' spines that are merged at a time
BLOCK = 256  # parentheses of a block of the range min-max tree
PIECE = 1_000  # ids of a piece of a node's ends

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
FAR = np.iinfo(np.int64).max

# Rows between the steps. kind 0: a complete node; 1: a node of a spine; 2: ids that end at a spine's node.
# place orders shards, scope names the shard or merge a row comes from.
_FIELDS = {
    "kind": "int", "scope": "long", "place": "long", "seq": "long", "node": "binary", "parent": "binary",
    "depth": "long", "chars": "long", "left": "boolean", "right": "boolean",
    "ends": "long", "end_min": "long", "members": "long", "conv_id": "long", "parent_conv_id": "long",
    "n_children": "long", "n_leaves": "long", "saved": "long", "ends_sha256": "string", "ids": "binary",
}
_SCHEMA = ", ".join(f"{k} {v}" for k, v in _FIELDS.items())
_ARROW = pa.schema([
    (k, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}[v])
    for k, v in _FIELDS.items()
])
SUMS = ("ends", "members", "n_children", "n_leaves", "saved")  # of a spine's node: what hangs off it besides the spine


class Parentheses:
    """Balanced parentheses of a trie given by the depths of its nodes in preorder."""

    def __init__(self, depth: np.ndarray):
        n = len(depth)
        self.opens = 2 * np.arange(n, dtype=np.int64) - depth
        self.bits = np.zeros(2 * n, dtype=bool)
        self.bits[self.opens] = True
        excess = np.cumsum(np.where(self.bits, 1, -1)).astype(np.int32)
        blocks = -(-2 * n // BLOCK)
        self.blocks = np.full((blocks, BLOCK), np.iinfo(np.int32).max, dtype=np.int32)
        self.blocks.reshape(-1)[: 2 * n] = excess
        self.minima = [self.blocks.min(axis=1)]  # level t: least excess of 2**t blocks
        while len(self.minima[-1]) > 1:
            low = self.minima[-1]
            low = np.concatenate((low, [np.iinfo(np.int32).max])) if len(low) % 2 else low
            self.minima.append(np.minimum(low[::2], low[1::2]))

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place beyond ``after`` in each block with an excess of ``target`` at most; -1 if none."""
        out = np.empty(len(block), dtype=np.int64)
        place = np.arange(BLOCK)
        for a in range(0, len(block), 4096):
            s = slice(a, a + 4096)
            low = (self.blocks[block[s]] <= target[s, None]) & (place > after[s, None])
            first = low.argmax(axis=1)
            out[s] = np.where(low[np.arange(len(first)), first], first, -1)
        return out

    def find_close(self) -> np.ndarray:
        """Closing parenthesis of every node, in preorder."""
        block, within = self.opens // BLOCK, self.opens % BLOCK
        target = self.blocks[block, within] - 1
        found = self._in_block(block, within, target)
        close = block * BLOCK + found
        rest = np.flatnonzero(found < 0)
        at, goal, level = block[rest], target[rest], 0
        todo = np.arange(len(rest))  # those that still climb
        top = np.zeros(len(rest), dtype=np.int64)
        while len(todo):
            low = self.minima[level]
            beside = np.minimum(at[todo] + 1, len(low) - 1)
            hit = (at[todo] % 2 == 0) & (at[todo] + 1 < len(low)) & (low[beside] <= goal[todo])
            at[todo[hit]] += 1
            top[todo[hit]] = level
            todo = todo[~hit]
            at[todo] //= 2
            level += 1
        for level in range(int(top.max(initial=0)), 0, -1):  # down to the first such block
            down = np.flatnonzero(top >= level)
            at[down] *= 2
            at[down] += self.minima[level - 1][at[down]] > goal[down]
        close[rest] = at * BLOCK + self._in_block(at, np.full(len(rest), -1), goal)
        return close

    def leaf_pairs(self) -> np.ndarray:
        """Whether a node's closing parenthesis follows at once."""
        return ~self.bits[self.opens + 1]


def _parents(depth: np.ndarray) -> np.ndarray:
    """Parent of every node in preorder: the last node before it that is one level higher; -1 for the root."""
    n = len(depth)
    keys = np.sort(depth * n + np.arange(n))
    at = np.searchsorted(keys, (depth - 1) * n + np.arange(n)) - 1
    return np.where(depth > 0, keys[np.maximum(at, 0)] % n, -1)


def _measure(own: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Totals of every node of a trie in preorder. ``own`` has depth, chars, ends,
    end_min and, per node, the totals of complete children that aren't listed."""
    depth = own["depth"]
    n = len(depth)
    tree = Parentheses(depth)
    last = np.arange(n) + (tree.find_close() - tree.opens + 1) // 2
    parent = _parents(depth)

    def below(x: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(x)))
        return total[last] - total[:-1]

    children = own["n_children"] + np.bincount(parent[1:], minlength=n)
    members = below(own["ends"] + own["members"])
    leaf = tree.leaf_pairs() & (own["n_children"] == 0)
    least = np.minimum(own["end_min"], own["conv_id"])
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[by_depth], np.arange(depth.max(initial=0) + 2))
    for d in range(len(cuts) - 2, 0, -1):
        at = by_depth[cuts[d] : cuts[d + 1]]
        np.minimum.at(least, parent[at], least[at])
    return {
        "parent": parent, "n_children": children, "members": members, "conv_id": least,
        "n_leaves": below(own["n_leaves"] + leaf), "saved": below(own["saved"] + (members - 1) * own["chars"]),
    }


def _rows(**columns) -> pa.RecordBatch:
    n = next(len(v) for v in columns.values())
    arrays = []
    for field in _ARROW:
        v = columns.get(field.name)
        arrays.append(pa.nulls(n, field.type) if v is None else pa.array(v, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _divide(own: dict, got: dict, spine: np.ndarray, name: list, scope: int, place: int, sha: list) -> Iterator[pa.RecordBatch]:
    """Rows of the complete nodes, and of the spine with what hangs off it. ``name``
    has the digest of every spine node and of every parent in the spine."""
    parent = got["parent"]
    done = np.flatnonzero(~spine)
    if len(done):
        up = parent[done]
        inner = (up >= 0) & ~spine[np.maximum(up, 0)]
        above = got["conv_id"][np.maximum(up, 0)]
        yield _rows(
            kind=np.zeros(len(done), dtype=np.int32), scope=np.full(len(done), scope),
            node=[name[k] for k in done], parent=[None if i or u < 0 else name[u] for u, i in zip(up, inner)],
            depth=own["depth"][done], members=got["members"][done], conv_id=got["conv_id"][done],
            parent_conv_id=pa.array(above, pa.int64(), mask=~inner), n_children=got["n_children"][done],
            n_leaves=got["n_leaves"][done], saved=got["saved"][done], ends_sha256=[sha[k] for k in done],
        )
    at = np.flatnonzero(spine)
    if len(at):
        n = len(spine)
        hangs = np.flatnonzero(~spine & (parent >= 0) & spine[np.maximum(parent, 0)])
        sums = {k: own[k].copy() for k in SUMS}
        least = own["conv_id"].copy()
        for k in ("members", "n_leaves", "saved"):
            np.add.at(sums[k], parent[hangs], got[k][hangs])
        sums["n_children"] += np.bincount(parent[hangs], minlength=n)
        np.minimum.at(least, parent[hangs], got["conv_id"][hangs])
        yield _rows(
            kind=np.ones(len(at), dtype=np.int32), scope=np.full(len(at), scope), place=np.full(len(at), place),
            seq=np.arange(len(at)), node=[name[k] for k in at],
            parent=[name[p] if p >= 0 else None for p in parent[at]], depth=own["depth"][at], chars=own["chars"][at],
            left=own["left"][at], right=own["right"][at], end_min=own["end_min"][at], conv_id=least[at],
            **{k: v[at] for k, v in sums.items()},
        )


def _path_names(key: bytes) -> list[bytes]:
    """Digests of all prefixes of a key, the empty one first."""
    h = hashlib.sha256()
    out = [h.digest()[:UNIT]]
    for a in range(0, len(key), UNIT):
        h.update(key[a : a + UNIT])
        out.append(h.copy().digest()[:UNIT])
    return out


def _shard(ids: np.ndarray, keys: list[bytes], chars: np.ndarray, place: int) -> Iterator[pa.RecordBatch]:
    """The part of the trie that sorted conversations make."""
    sizes = np.array([len(k) for k in keys], dtype=np.int64) // UNIT
    firsts = np.cumsum(sizes) - sizes
    units = np.frombuffer(b"".join(keys), dtype=np.uint64).reshape(-1, 2)
    # turns in common with the conversation before
    common = np.zeros(len(keys), dtype=np.int64)
    both = np.minimum(sizes[1:], sizes[:-1])
    some = np.flatnonzero(both)
    if len(some):
        a, b = ranges(firsts[some], both[some]), ranges(firsts[some + 1], both[some])
        starts = np.cumsum(both[some]) - both[some]
        step = np.arange(len(a)) - np.repeat(starts, both[some])
        differ = np.where((units[a] == units[b]).all(axis=1), FAR, step)
        common[some + 1] = np.minimum(np.minimum.reduceat(differ, starts), both[some])
    # nodes in preorder: the root, then what each conversation opens
    opened = sizes - common
    depth = np.concatenate(([0], ranges(common + 1, opened)))
    n = len(depth)
    own = {k: np.zeros(n, dtype=np.int64) for k in SUMS} | {"depth": depth, "conv_id": np.full(n, FAR)}
    own["chars"] = np.concatenate(([0], chars[ranges(firsts + common, opened)]))
    # where each conversation ends: at the last node it opens, or where the one before it ends, being equal
    # to it (a conversation that opens nothing can't be a mere prefix of the one before: it would sort first)
    end = np.maximum.accumulate(np.where(opened > 0, np.cumsum(opened), 0))
    own["ends"] = np.bincount(end, minlength=n)
    own["end_min"] = np.full(n, FAR)
    np.minimum.at(own["end_min"], end, ids)
    own["left"] = np.arange(n) <= sizes[0]
    own["right"] = np.zeros(n, dtype=bool)
    got = _measure(own)
    k = int(end[-1])
    while k >= 0:
        own["right"][k] = True
        k = int(got["parent"][k])
    spine = own["left"] | own["right"]
    name: list = [None] * n
    for side, key in ((own["left"], keys[0]), (own["right"], keys[-1])):
        for k, digest in zip(np.flatnonzero(side), _path_names(key)):
            name[k] = digest
    # ids that end at a node lie side by side, in order
    sha: list = [EMPTY_SHA] * n
    cuts = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1], [True])))
    pieces: list[tuple[bytes, int, bytes]] = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        k = int(end[a])
        if spine[k]:
            for c in range(a, b, PIECE):
                pieces.append((name[k], len(pieces), ",".join(map(str, ids[c : min(b, c + PIECE)].tolist())).encode()))
        else:
            sha[k] = hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest()
    yield from _divide(own, got, spine, name, place, place, sha)
    if pieces:
        node, seq, texts = zip(*pieces)
        full = [np.full(len(node), x) for x in (2, place, place)]
        yield _rows(kind=full[0].astype(np.int32), scope=full[1], place=full[2], node=node, seq=seq, ids=texts)


def _shards(limit: int):
    """mapInArrow body over sorted (conv_id, key, chars): a partition as shards one after another."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        held, turns = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, turns, place
            table = pa.Table.from_batches(held)
            chars = table.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield from _shard(table.column(0).to_numpy(), table.column(1).to_pylist(), chars, place)
            held, turns, place = [], 0, place + 1

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                turns += batch.num_rows + batch.column(1).nbytes // UNIT
                if turns >= limit:
                    yield from flush()
        if held:
            yield from flush()

    return run


def _merge(round_no: int, last: bool):
    """applyInArrow body: the spines of the shards of one group as one trie."""

    def run(key, table):
        table = table.sort_by([("place", "ascending"), ("seq", "ascending")])
        group = key[0].as_py()
        scope = -1 - ((round_no << 44) | group)
        # equal nodes of neighbouring shards are one; the first of each, in order, are in preorder
        names = table.column("node").to_pylist()
        index: dict[bytes, int] = {}
        at = np.array([index.setdefault(x, len(index)) for x in names], dtype=np.int64)
        n = len(index)
        first = np.full(n, len(at), dtype=np.int64)
        np.minimum.at(first, at, np.arange(len(at)))
        get = lambda c: table.column(c).to_numpy()
        own = {k: np.zeros(n, dtype=np.int64) for k in SUMS}
        for k in SUMS:
            np.add.at(own[k], at, get(k))
        for k in ("end_min", "conv_id"):
            own[k] = np.full(n, FAR)
            np.minimum.at(own[k], at, get(k))
        for k in ("depth", "chars"):
            own[k] = get(k)[first]
        place = get("place")
        for side, end in (("left", place[0]), ("right", place[-1])):
            own[side] = np.zeros(n, dtype=bool)
            own[side][at[get(side).astype(bool) & (place == end)]] = True
        spine = np.zeros(n, dtype=bool) if last else own["left"] | own["right"]
        # the ends of these nodes are hashed apart
        out = list(_divide(own, _measure(own), spine, list(index), scope, group, [None] * n))
        return pa.Table.from_batches(out, schema=_ARROW)

    return run


def _hash_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body over pieces sorted by node and place: SHA-256 of each node's pieces joined by commas."""
    node, running = None, None

    def rows(done: list) -> pa.RecordBatch:
        a, b = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.string())], names=["of", "sha"])

    for batch in batches:
        done = []
        for x, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if x == node:
                running.update(b",")
            else:
                if running:
                    done.append((node, running.hexdigest()))
                node, running = x, hashlib.sha256()
            running.update(text)
        if done:
            yield rows(done)
    if running:
        yield rows([(node, running.hexdigest())])


def conversation_paths(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id and ``steps``, its turns in order as structs (digest, chars)."""
    role, text = (F.coalesce(column(turns, c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = column(turns, turn_col).cast("long")
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    step = F.struct(
        turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"),
        F.substring(digest, 1, 2 * UNIT).alias("digest"), F.char_length(text).cast("long").alias("chars"),
    )
    rows = turns.select(column(turns, id_col).cast("long").alias("conv_id"), step.alias("step")).filter("conv_id IS NOT NULL")
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    return listed.select("conv_id", F.transform("steps", lambda s: F.struct(s.digest, s.chars)).alias("steps"))


def share_openings(paths: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt so that openings are shared: conversation c takes its
    first ``h = crc32(c) % most`` turns from conversation ``c - c % every`` (fewer
    if that has fewer, none if it is absent) and goes on with its own after the
    first h. At most ``every`` conversations meet at one."""
    heads = paths.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("steps", 1, most - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = paths.withColumns({"base_id": F.col("conv_id") - F.col("conv_id") % every, "h": h})
    joined = own.join(heads, F.col("base_id") == F.col("base"), "left")
    opening = F.when(F.col("head").isNull(), F.slice("steps", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("steps", F.col("h") + 1, F.greatest(F.size("steps"), F.lit(1)))
    return joined.select("conv_id", F.concat(opening, rest).alias("steps"))


def prefix_trie(paths: DataFrame, shard: int = SHARD, fan: int = FAN) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, steps): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (code points) and ends_sha256."""
    spark = paths.sparkSession
    ensure_checkpoint_dir(spark)
    width = shuffle_width(spark)
    keys = paths.select(
        "conv_id", F.unhex(F.array_join(F.transform("steps", lambda s: s.digest), "")).alias("key"),
        F.transform("steps", lambda s: s.chars).alias("chars"),
    ).checkpoint()  # read by the range partitioner, then dealt out
    in_order = keys.repartitionByRange(width, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = in_order.mapInArrow(_shards(shard), _SCHEMA).checkpoint()

    nodes = [parts.filter("kind = 0")]
    spines = [parts.filter("kind = 1")]
    group, groups, round_no = F.shiftright("place", 32), width, 0
    while True:
        grouped = spines[-1].withColumn("group", group).groupBy("group")
        merged = grouped.applyInArrow(_merge(round_no, groups == 1), _SCHEMA).checkpoint()
        nodes.append(merged.filter("kind = 0"))
        if groups == 1:
            break
        spines.append(merged.filter("kind = 1"))
        group, groups, round_no = F.floor(F.col("place") / fan), -(-groups // fan), round_no + 1

    pieces = parts.filter("kind = 2").select("node", "ids", "place", "seq")
    ordered = pieces.repartition(width, "node").sortWithinPartitions("node", "place", "seq").select("node", "ids")
    digests = ordered.mapInArrow(_hash_pieces, "of binary, sha string")
    # nodes of spines: their ends' digests, and their smallest members as parents, known in the end
    late = _union(nodes[1:])
    final = late.select(F.col("node").alias("known"), F.col("conv_id").alias("up"))
    late = late.join(digests, F.col("node") == F.col("of"), "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(EMPTY_SHA))).drop("of", "sha").checkpoint()
    nodes = _union([nodes[0], late])
    # a scope has one spine, so few rows of ``of_scope`` and no more than a shard's nodes meet at a key
    of_scope = _union(spines).select(F.col("scope").alias("in_scope"), "node").join(final, F.col("node") == F.col("known"))
    of_scope = of_scope.select("in_scope", "known", "up")
    waiting = nodes.filter("parent IS NOT NULL").join(
        of_scope, (F.col("scope") == F.col("in_scope")) & (F.col("parent") == F.col("known"))
    ).withColumn("parent_conv_id", F.col("up"))
    return _union([nodes.filter("parent IS NULL"), waiting.select(nodes.columns)]).select(
        "conv_id", "depth", "parent_conv_id", F.col("members").alias("n_convs"), "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256",
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
