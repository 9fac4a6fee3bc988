"""A trie of the prefixes of conversations, built in ternary search trees by range shard.

Distinct turns get numbers from a dictionary, so a conversation is a row of numbers; equal
conversations become one row before anything else moves, so a group of copies of any size is
one record.  The rows are dealt by ranges of their order and sorted, and every task cuts its
range into shards of up to ``SHARD_TURNS`` numbers.  A shard is one ternary search tree:
the middle sequence goes in first, then the middles of both halves and so on, which keeps the
trees of siblings balanced.  One traversal, children before parents and without recursion,
adds up members, leaves and savings.

A prefix can occur in several shards only if it lies on the first or last sequence of each
of them, for the shards are intervals.  Such boundary nodes are not finished: what the rest
of the shard adds to them travels with those two sequences to the next level, where the
sequences of many shards form a shard again, until one shard remains.  Children of boundary
nodes that are finished themselves find the smallest member of their parent afterwards, in a
join by a digest of the prefix.

Null roles and texts are empty; null turns come first, equal turns are ordered by role and
text, and repeated rows are turns of their own.  Rows with a null conv_id belong to no
conversation and are left out.  Only conv_id, turn, role and text are read.  An empty table
has no node.  The digest of the members that end at a node is by its definition computed in
one stream: a task holds one batch of it, made of ids joined by range of conv_id.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import bounded
from quayside.llm.turns import turn_digest, turn_key, with_ties, word_count
from quayside.session import cut_lineage

SHARD_TURNS = 1 << 17
LEAST_ROWS = 8  # sequences in a shard, so that each level leaves fewer of them
RANGE_HEAD = 32  # leading numbers by which sequences are dealt; sampled keys stay short
ROWS_AT_ONCE = 10_000
EMPTY = hashlib.sha256(b"").hexdigest()

_OWN = "struct<depth:bigint,n:bigint,low:bigint,children:bigint,leaves:bigint,saved:bigint,ends:string>"
_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, mark binary, parent_mark binary"
)
LEVEL_DDL = f"{_NODE}, ids array<bigint>, words array<bigint>, own array<{_OWN}>"
_LEVEL = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("mark", pa.binary()), ("parent_mark", pa.binary())]
    + [("ids", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))]
    + [
        (
            "own",
            pa.list_(
                pa.struct(
                    [(c, pa.int64()) for c in ("depth", "n", "low", "children", "leaves", "saved")]
                    + [("ends", pa.string())]
                )
            ),
        )
    ]
)


def halving_order(n: int) -> Iterator[int]:
    """0 to n-1: the middle, then the middles of both halves, and so on."""
    spans = deque([(0, n)])
    while spans:
        low, high = spans.popleft()
        if low < high:
            middle = (low + high) // 2
            yield middle
            spans += [(low, middle), (middle + 1, high)]


class TernaryTree:
    """Sequences of numbers in a ternary search tree; node 0 is the empty prefix.

    ``low`` and ``high`` lead to siblings with smaller and larger keys, ``down`` to the
    tree of the children.  A node's parent has a smaller number than the node.
    """

    def __init__(self):
        self.key, self.low, self.high, self.down = [0], [-1], [-1], [-1]
        self.parent, self.depth, self.weight = [-1], [0], [0]

    def _add(self, key: int, parent: int, weight: int) -> int:
        node = len(self.key)
        for column, value in (
            (self.key, key),
            (self.low, -1),
            (self.high, -1),
            (self.down, -1),
            (self.parent, parent),
            (self.depth, self.depth[parent] + 1),
            (self.weight, weight),
        ):
            column.append(value)
        return node

    def insert(self, keys: list[int], weights: list[int]) -> list[int]:
        """The nodes of all prefixes of the keys, the empty one first."""
        path, node = [0], 0
        for key, weight in zip(keys, weights):
            side, at, below = self.down, node, self.down[node]
            while below >= 0 and self.key[below] != key:
                at = below
                side = self.low if key < self.key[at] else self.high
                below = side[at]
            if below < 0:
                below = side[at] = self._add(key, node, weight)
            node = below
            path.append(node)
        return path


def prefix_marks(keys: list[int]) -> list[bytes]:
    """A digest for each prefix, the empty one first."""
    state = hashlib.sha256()
    marks = [state.digest()[:16]]
    for key in keys:
        state.update(key.to_bytes(8, "little", signed=True))
        marks.append(state.digest()[:16])
    return marks


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def shard_rows(sequences: list[tuple], first_level: bool, last_level: bool) -> Iterator[dict]:
    """Finished nodes of a shard, then its boundary sequences unless this is the last level.

    A sequence is (ids, words, own); ``own`` lists what its prefixes have that is not in
    this shard: members, smallest member, finished children, their leaves and savings, and
    the digest of members that end there.
    """
    tree = TernaryTree()
    paths: list[list[int]] = [[]] * len(sequences)
    for i in halving_order(len(sequences)):
        paths[i] = tree.insert(sequences[i][0], sequences[i][1])
    size = len(tree.key)
    n, low = [0] * size, [None] * size
    children, leaves, saved, ends = [0] * size, [0] * size, [0] * size, [None] * size
    for (_, _, own), path in zip(sequences, paths):
        for part in own:
            node = path[part["depth"]]
            n[node] += part["n"]
            low[node] = _least(low[node], part["low"])
            children[node] += part["children"]
            leaves[node] += part["leaves"]
            saved[node] += part["saved"]
            ends[node] = ends[node] or part["ends"]

    boundary: dict[int, bytes] = {}
    outer = [] if last_level else sorted({0, len(sequences) - 1})
    for i in outer:
        boundary.update(zip(paths[i], prefix_marks(sequences[i][0])))
    for node in range(size - 1, -1, -1):
        if node in boundary:
            continue
        parent = tree.parent[node]
        if children[node] == 0:
            leaves[node] = 1
        saved[node] += (n[node] - 1) * tree.weight[node]
        if parent >= 0:
            n[parent] += n[node]
            low[parent] = _least(low[parent], low[node])
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]

    marks: dict[int, bytes] = {}
    if not first_level:  # every node was on a boundary one level below
        for i, path in enumerate(paths):
            marks.update(zip(path, prefix_marks(sequences[i][0])))
    for node in range(size):
        if node in boundary:
            continue
        parent = tree.parent[node]
        inner = parent >= 0 and parent not in boundary
        yield {
            "conv_id": low[node],
            "depth": tree.depth[node],
            "parent_conv_id": low[parent] if inner else None,
            "n_convs": n[node],
            "n_children": children[node],
            "n_leaves": leaves[node],
            "saved_tokens": saved[node],
            "ends_sha256": ends[node] or EMPTY,
            "mark": marks.get(node),
            "parent_mark": boundary.get(parent),
        }
    told: set[int] = set()
    for i in outer:
        parts = []
        for depth, node in enumerate(paths[i]):
            if node not in told:
                told.add(node)
                names = ("depth", "n", "low", "children", "leaves", "saved", "ends")
                values = (depth, n[node], low[node], children[node], leaves[node], saved[node], ends[node])
                parts.append(dict(zip(names, values)))
        yield {"ids": sequences[i][0], "words": sequences[i][1], "own": parts}


def _level(sequences: DataFrame, first_level: bool, last_level: bool, shard_turns: int) -> DataFrame:
    """One level of shards over (ids, words, own); nodes and sequences in one table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size = 0

        def flush():
            nonlocal shard, size
            rows: list[dict] = []
            for row in shard_rows(shard, first_level, last_level):
                rows.append(row)
                if len(rows) == ROWS_AT_ONCE:
                    yield pa.RecordBatch.from_pylist(rows, _LEVEL)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _LEVEL)
            shard, size = [], 0

        for batch in batches:
            for row in batch.to_pylist():
                shard.append((row["ids"], row["words"], row["own"]))
                size += len(row["ids"])
                if not last_level and size >= shard_turns and len(shard) >= LEAST_ROWS:
                    yield from flush()
        if shard:
            yield from flush()

    return bounded(sequences.select("ids", "words", "own")).mapInArrow(build, LEVEL_DDL)


def _dealt(sequences: DataFrame, parts: int | None = None) -> DataFrame:
    head = F.slice("ids", 1, RANGE_HEAD)
    dealt = sequences.repartitionByRange(parts, head) if parts else sequences.repartitionByRange(head)
    return dealt.sortWithinPartitions("ids")


def merged_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes over distinct sequences (ids, words, own), each with its parent's conv_id."""
    level = cut_lineage(_level(_dealt(sequences), True, False, shard_turns))
    nodes = level.where("ids IS NULL")
    while True:
        rest = level.where("ids IS NOT NULL").select("ids", "words", "own")
        rows, turns = rest.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
        if not rows:
            break
        # Its rows are two for each shard of the level below.
        last = turns <= shard_turns or rows <= 8 * LEAST_ROWS
        if last:
            dealt = rest.repartition(1).sortWithinPartitions("ids")
        else:
            dealt = _dealt(rest, max(1, min(turns // (4 * shard_turns), rows // (8 * LEAST_ROWS))))
        level = cut_lineage(_level(dealt, False, last, shard_turns))
        nodes = nodes.unionByName(level.where("ids IS NULL"))
        if last:
            break
    nodes = nodes.drop("ids", "words", "own")
    known = cut_lineage(nodes.where("mark IS NOT NULL").select(F.col("mark").alias("of"), F.col("conv_id").alias("found")))
    waiting = nodes.where("parent_mark IS NOT NULL").join(known, F.col("parent_mark") == F.col("of"))
    waiting = waiting.withColumn("parent_conv_id", F.col("found")).drop("of", "found")
    return nodes.where("parent_mark IS NULL").unionByName(waiting).drop("mark", "parent_mark")


def numbered_paths(turns: DataFrame) -> DataFrame:
    """conv_id and path: its turns in order, each as (number, words)."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    narrow = with_ties(rows).select(
        "conv_id", turn_key().alias("place"), turn_digest().alias("digest"), word_count(F.col("text")).alias("words")
    )
    narrow = cut_lineage(narrow)
    # The numbers count once they are written, so a lost task cannot change them afterwards.
    dictionary = narrow.groupBy("digest").agg(F.first("words").alias("n_words"))
    dictionary = cut_lineage(dictionary.withColumn("number", F.monotonically_increasing_id()))
    numbered = narrow.select("conv_id", "place", "digest").join(dictionary, "digest")
    item = F.struct("place", F.col("number").alias("id"), F.col("n_words").alias("words"))
    gathered = numbered.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return gathered.select("conv_id", F.transform("items", lambda x: F.struct(x["id"], x["words"])).alias("path"))


def with_shared_heads(paths: DataFrame, block: int, at_most: int, head: Column) -> DataFrame:
    """Conversation c gets the first ``head`` turns (below ``at_most``) of c - c % block for its own."""
    base = F.col("conv_id") - F.col("conv_id") % block
    heads = paths.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, at_most - 1).alias("shared")
    )
    joined = paths.withColumn("base", base).withColumn("head", head).join(heads, "base", "left")
    empty = F.slice("path", 1, 0)
    rebuilt = F.concat(
        F.slice(F.coalesce("shared", empty), F.lit(1), F.col("head")),
        F.slice("path", F.col("head") + 1, F.greatest(F.size("path"), F.lit(0))),
    )
    return joined.select("conv_id", rebuilt.alias("path"))


def member_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conv_ids, joined by commas, of each ``key``.

    Ids are joined by range first, so the stream of a large group is a few rows.
    """
    dealt = members.select("key", "conv_id").repartitionByRange("conv_id").withColumn("part", F.spark_partition_id())
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = dealt.groupBy("key", "part").agg(ids.alias("chunk"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for batch in batches:
            found = []
            for now, chunk in zip(batch.column("key").to_pylist(), batch.column("chunk").to_pylist()):
                if now == key:
                    state.update(b"," + chunk.encode())
                else:
                    if state:
                        found.append((key, state.hexdigest()))
                    key, state = now, hashlib.sha256(chunk.encode())
            if found:
                yield _digests(found)
        if state:
            yield _digests([(key, state.hexdigest())])

    dealt = chunks.repartition("key").sortWithinPartitions("key", "part").select("key", "chunk")
    return bounded(dealt).mapInArrow(digest, "key binary, ends string")


def _digests(found: list[tuple]) -> pa.RecordBatch:
    keys, ends = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], ["key", "ends"])


def prefix_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie over (conv_id, path), one row each:

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    ids, words = F.transform("path", lambda x: x["id"]), F.transform("path", lambda x: x["words"])
    key = F.unhex(F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256))
    keyed = cut_lineage(paths.select("conv_id", ids.alias("ids"), words.alias("words"), key.alias("key")))
    distinct = keyed.groupBy("key", "ids", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    zero = F.lit(0).cast("bigint")
    own = F.struct(
        F.size("ids").cast("bigint").alias("depth"),
        "n",
        "low",
        zero.alias("children"),
        zero.alias("leaves"),
        zero.alias("saved"),
        "ends",
    )
    sequences = distinct.join(member_digests(keyed), "key").select("ids", "words", F.array(own).alias("own"))
    return merged_nodes(cut_lineage(sequences), shard_turns)
