import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sigflow.llm.catalog import op12_prefix_trie
from sigflow.llm.trie import Parentheses, conversation_paths, prefix_trie, share_openings

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute_paths(rows):
    """conv_id -> turns (role, text) in order."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    return {c: [x for _, x in sorted(v)] for c, v in own.items()}


def brute_shared(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        out[c] = paths.get(base, [])[:h] + own[h:]
    return out


def brute_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        chars = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * chars + sum(saved[x] for x in children[node])
    rows = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(paths[c]) == len(node))
        rows.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return rows


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def make_turns(seed, convs=260, texts=4, most=9):
    """Few different turns, so prefixes, copies and mere prefixes of others abound."""
    rng = random.Random(seed)
    said = [rng.choice(["a", "bé", "", None, "long text " * 20, "日本"]) for _ in range(texts)]
    rows = []
    for c in range(convs):
        if rng.random() < 0.03:
            continue
        for t in range(rng.randint(1, most)):
            rows.append((c - 20, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", None]) if rng.random() < 0.3 else "user", rng.choice(said)))
    rows += [(None, 0, "user", "nobody's")] * 5 + rows[:7]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed, shard, fan", [(1, 500_000, 64), (2, 40, 2), (3, 1, 2), (4, 200, 3)])
def test_trie_matches_brute_force(spark, seed, shard, fan):
    rows = make_turns(seed)
    paths = share_openings(conversation_paths(spark.createDataFrame(rows, SCHEMA)))
    got = prefix_trie(paths, shard=shard, fan=fan)
    assert got.columns == COLUMNS
    assert in_order(got.collect()) == in_order(brute_trie(brute_shared(brute_paths(rows))))


def test_paths_and_openings(spark):
    rows = make_turns(9)
    paths = conversation_paths(spark.createDataFrame(rows, SCHEMA))
    named = lambda x: {c: [(digest(*t), len(t[1])) for t in p] for c, p in x.items()}
    plain = brute_paths(rows)
    assert {r.conv_id: [tuple(s) for s in r.steps] for r in paths.collect()} == named(plain)
    shared = share_openings(paths)
    assert {r.conv_id: [tuple(s) for s in r.steps] for r in shared.collect()} == named(brute_shared(plain))


def test_copies_that_fill_many_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(900) for t in range(3)] + [(5000, 0, "user", "turn 0"), (5001, 0, "x", "y" * 10_000)]
    paths = conversation_paths(spark.createDataFrame(rows, SCHEMA))
    got = prefix_trie(paths, shard=50, fan=3)
    assert in_order(got.collect()) == in_order(brute_trie(brute_paths(rows)))


def test_deep_conversations(spark):
    rows = [(c, t, "user", f"{t % 7} {t > 600 + c}") for c in range(6) for t in range(700)]
    paths = conversation_paths(spark.createDataFrame(rows, SCHEMA))
    assert in_order(prefix_trie(paths, shard=900).collect()) == in_order(brute_trie(brute_paths(rows)))


def test_find_close():
    rng = random.Random(4)
    for n in (1, 2, 30, 3000):
        depth = [0]
        while len(depth) < n:
            depth.append(rng.randint(max(1, depth[-1] - rng.choice([0, 1, 40])), depth[-1] + 1))
        close, stack, want, at = Parentheses(np.array(depth)).find_close().tolist(), [], [0] * n, 0
        for k, d in enumerate(depth):
            while len(stack) > d:
                want[stack.pop()] = at
                at += 1
            stack.append(k)
            at += 1
        while stack:
            want[stack.pop()] = at
            at += 1
        assert close == want


def test_query_and_awkward_tables(spark, tmp_path):
    rows = [(c, t, r, x, "clash") for c, t, r, x in make_turns(11)]
    df = spark.createDataFrame(rows, SCHEMA + ", steps string")
    df.write.parquet(f"{tmp_path}/a/conversations.parquet")
    want = brute_trie(brute_shared(brute_paths([r[:4] for r in rows])))
    assert in_order(op12_prefix_trie(spark, f"{tmp_path}/a").collect()) == in_order(want)
    df.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert op12_prefix_trie(spark, f"{tmp_path}/b").collect() == []
    df.filter("conv_id is null").write.parquet(f"{tmp_path}/c/conversations.parquet")
    assert op12_prefix_trie(spark, f"{tmp_path}/c").collect() == []
