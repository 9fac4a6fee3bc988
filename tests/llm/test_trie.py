"""Prefixes of conversations: against a slow version."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        block = abs(c) % 20 * (1 if c >= 0 else -1)
        paths[c] = own.get(c - block, [])[:h] + turns[h:]
    return paths


def slow(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    found = []
    for prefix, convs in members.items():
        children = [p for p in members if len(p) == len(prefix) + 1 and p[:-1] == prefix]
        below = [p for p in members if p[: len(prefix)] == prefix]
        leaves = sum(not any(q[:-1] == p and len(q) == len(p) + 1 for q in below) for p in below)
        saved = sum(
            (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p
        )
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        found.append(
            (min(convs), len(prefix), parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=repr)


def answers(turns, shard_turns=prefix_trie.SHARD_TURNS):
    paths = prefix_trie.numbered_paths(turns)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    found = prefix_trie.prefix_nodes(prefix_trie.with_shared_heads(paths, 20, 4, head.cast("int")), shard_turns)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert found.columns == names
    return sorted(map(tuple, found.collect()), key=repr)


def random_rows(seed, convs, copies):
    pick = random.Random(seed)
    texts = ["hello there", "x", "", None, "one two  three", "é ü b", "same\tas\never"]
    rows = []
    for c in pick.sample(range(-60, 400), convs):
        for turn in range(pick.randrange(1, 7)):
            rows.append((c, turn, pick.choice(["user", "assistant", None]), pick.choice(texts)))
    for c in range(1000, 1000 + copies):
        rows += [(c, t, "user", f"copied {t}") for t in range(5)]
    return rows


@pytest.mark.parametrize("shard_turns", [3, 40, prefix_trie.SHARD_TURNS])
def test_random_conversations_and_copies_in_shards_of_any_size(spark, shard_turns):
    rows = random_rows(shard_turns, 90, 30)
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    assert answers(turns, shard_turns) == slow(rebuilt(rows))


def test_nulls_ties_repeated_rows_and_turnless_conversations(spark):
    rows = [
        (None, 0, "user", "nobody's"),
        (20, None, "user", "before the first"),
        (20, 0, "user", "b"),
        (20, 0, "user", "a"),
        (20, 0, "user", "a"),
        (20, 0, "assistant", "z"),
        (21, None, None, None),
        (22, None, None, None),
        (23, None, None, None),
        (45, 1, "user", "base is absent"),
        (46, 1, "user", "base is absent"),
        (47, 1, "user", "base is absent"),
        (-7, 3, "", "negative"),
        (-1, 3, "1:", "x"),
        (-2, 3, "1", ":x"),
    ]
    rows += [(c, t, "user", "t") for c in (60, 61, 62) for t in range(300)]
    assert answers(spark.createDataFrame(rows, TURNS).repartition(4), 50) == slow(rebuilt(rows))
    assert any(not path for path in rebuilt(rows).values())


def test_very_long_texts_and_other_columns(spark):
    rows = [(c, t, "user", "word " * 50_000 + str(c % 2)) for c in range(6) for t in range(4)]
    turns = spark.createDataFrame(rows, TURNS).selectExpr(
        "conv_id", "turn", "role", "text", "1 AS tie", "2 AS place", "3 AS digest", "'x' AS ids", "4 AS `a.b`"
    )
    assert answers(turns) == slow(rebuilt(rows))


def test_an_empty_table_has_no_node(spark):
    assert answers(spark.createDataFrame([], TURNS)) == []


def test_middles_go_in_first():
    assert sorted(prefix_trie.halving_order(10)) == list(range(10))
    assert list(prefix_trie.halving_order(7))[:3] == [3, 1, 5]
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.halving_order(1023):
        tree.insert([i], [1])

    def height(node):
        found, todo = 0, [(node, 1)]
        while todo:
            at, depth = todo.pop()
            if at >= 0:
                found = max(found, depth)
                todo += [(tree.low[at], depth + 1), (tree.high[at], depth + 1)]
        return found

    assert height(tree.down[0]) == 10 and len(tree.key) == 1024
