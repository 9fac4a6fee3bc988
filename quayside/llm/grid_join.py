"""Near-duplicate vectors by an epsilon grid order join.

Two vectors are linked if their cosine is at least ``MIN_COSINE``, so their unit vectors are
at most epsilon = sqrt(2 - 2 * MIN_COSINE) apart.  Equal vectors form one class first.  The
classes are sorted by the grid cells, of width epsilon, of their leading principal
coordinates, and the sorted sequence is cut into blocks: of at most ``BLOCK_BYTES``, so
that a task holds two whatever the length of vectors, and otherwise as few as keep all cores
busy, because a block is sent once for each block that it is close to.  Starting from the whole sequence
joined with itself, intervals are split and joined recursively; a pair of intervals is
skipped if their bounding boxes are more than epsilon apart, which no principal axes, good
or bad, can make wrong.  The pairs of blocks that are left are joined as tasks, each going
on with the recursion down to small leaves.  A leaf is compared in single precision first;
if that leaves any pair in doubt, by its error bound, the leaf is compared in double
precision.  Vectors are sent as they are stored, single ones as four bytes a number, and made
unit vectors in double precision where they are compared.

A task never emits pairs.  It returns, for each class, how many vectors it links with and
one class that it is connected to, so a cluster of any density costs no more than its rows.

The axes are fitted on a sample of at most ``AXES_NUMBERS`` numbers; all vectors are
indexed.  Vectors that are null, empty, zero, or hold nulls or numbers that are not finite,
and vectors without vec_id, link with nothing; vectors of unlike lengths are not compared.
Rows that repeat a vec_id count as different vectors.  Only vec_id and embedding are read.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.batches import bounded
from quayside.llm.components import components
from quayside.session import cut_lineage

MIN_COSINE = 0.9
LEADING = 8  # principal coordinates that are looked at
BLOCK_BYTES = 1 << 24  # of a block, in double precision
BLOCK_ROWS = 1024  # classes that a block has at least, if its bytes allow
TASKS_PER_CORE = 4  # pairs of blocks, if all blocks are close
FANOUT = 16  # intervals that an interval is split into
LEAF = 256  # classes compared at once within a task
AXES_NUMBERS = 1 << 22
SLACK = 1e-9

_ROW_BITS = 33  # of monotonically_increasing_id
BLOCK_SCHEMA = "block bigint, ids binary, counts binary, vectors binary, low array<double>, high array<double>"
JOINED = "id bigint, links bigint, root bigint"


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    rows = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal columns, at most LEADING, in which the sample varies most."""
    if not len(sample):
        return np.eye(sample.shape[1], 1)
    centred = sample - sample.mean(axis=0)
    if len(sample) >= sample.shape[1]:
        _, axes = np.linalg.eigh(centred.T @ centred)
        return np.ascontiguousarray(axes[:, ::-1][:, :LEADING])
    # Fewer rows than numbers: the same axes from the smaller product.
    _, weights = np.linalg.eigh(centred @ centred.T)
    axes, _ = np.linalg.qr(centred.T @ weights[:, ::-1][:, :LEADING])
    return np.ascontiguousarray(axes)


def rows_per_block(n_classes: int, dimension: int, cores: int) -> int:
    """Few blocks that keep all cores busy, none beyond BLOCK_BYTES."""
    most = max(1, BLOCK_BYTES // (8 * dimension))
    sides = isqrt(2 * TASKS_PER_CORE * cores) + 1
    return min(most, max(BLOCK_ROWS, -(-n_classes // sides)))


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """The vectors of a column, one a row, in double precision."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [c.flatten().to_numpy().reshape(-1, dimension).astype(np.float64) for c in chunks]
    return np.concatenate(parts) if parts else np.zeros((0, dimension))


def _classes(vectors: DataFrame) -> DataFrame:
    """key, id (a number of its own), first (smallest vec_id), count, embedding, of each different vector."""
    found = vectors.groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("count"), F.first("embedding").alias("embedding")
    )
    return found.withColumn("id", F.monotonically_increasing_id())


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding as floats or doubles, and a key of it (null if it links with nothing)."""
    numbers = F.col("embedding").cast("array<double>")
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    finite = F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(numbers, lambda x: x != 0)
    known = F.coalesce(F.col("vec_id").isNotNull() & finite, F.lit(False))
    stored = F.col("embedding") if single else numbers
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), stored.alias("embedding"), known.alias("known"))
    key = F.when(F.col("known"), F.sha2(F.col("embedding").cast("string"), 256))
    return rows.select("vec_id", "embedding", key.alias("key"))


def _sample(classes: DataFrame, n_classes: int, dimension: int) -> np.ndarray:
    wanted = max(1, AXES_NUMBERS // dimension)
    share = min(1.0, wanted / max(1, n_classes))
    rows = classes.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = _matrix(rows.select("embedding").limit(2 * wanted).toArrow().column(0), dimension)
    return unit_rows(found) if len(found) else found


def _in_grid_order(classes: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """id, count, embedding and rank in grid order."""
    dimension = len(axes)

    def cells(batches):
        for batch in batches:
            rows = _matrix(batch.column("embedding"), dimension)
            found = np.floor(unit_rows(rows) @ axes / epsilon).astype(np.int32) if len(rows) else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(found), pa.list_(pa.int32()))], [*batch.schema.names, "cell"]
            )

    stored = classes.schema["embedding"].dataType.simpleString()
    rows = bounded(classes.select("id", "count", "embedding")).mapInArrow(
        cells, f"id bigint, count bigint, embedding {stored}, cell array<int>"
    )
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut_lineage(
        rows.repartitionByRange(n, "cell", "id")
        .sortWithinPartitions("cell", "id")
        .withColumn("at", F.monotonically_increasing_id())
    )
    part = F.shiftright("at", _ROW_BITS).alias("part")
    sizes = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition of the sorted sequence.
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.withColumn("part", part)
        .join(before.drop("n"), "part")
        .select("id", "count", "embedding", rank.alias("rank"))
    )


def _number_type(rows: DataFrame) -> str:
    """In which type the vectors are stored and sent; no number is changed by it."""
    return "<f4" if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"


def _blocks(ordered: DataFrame, axes: np.ndarray, block: int) -> DataFrame:
    """One row for each block of the sequence, with its bounding box."""
    dimension, stored = len(axes), _number_type(ordered)

    def pack(table: pa.Table) -> pa.Table:
        # Positions are sorted instead of rows: vectors are not copied by a sort of lists.
        order = np.argsort(table.column("rank").to_numpy())
        rows = _matrix(table.column("embedding"), dimension)[order]
        places = unit_rows(rows) @ axes
        return pa.table(
            {
                "block": [table.column("block")[0].as_py()],
                "ids": [table.column("id").to_numpy()[order].tobytes()],
                "counts": [table.column("count").to_numpy()[order].tobytes()],
                "vectors": [rows.astype(stored).tobytes()],
                "low": [places.min(axis=0)],
                "high": [places.max(axis=0)],
            }
        )

    numbered = ordered.withColumn("block", F.expr(f"rank div {block}"))
    return numbered.groupBy("block").applyInArrow(pack, BLOCK_SCHEMA)


def _box_gap(a: str, b: str):
    """The squared distance of two bounding boxes."""
    gap = f"greatest(0D, element_at({a}_low, i) - element_at({b}_high, i), element_at({b}_low, i) - element_at({a}_high, i))"
    return F.expr(f"aggregate(sequence(1, size({a}_low)), 0D, (s, i) -> s + {gap} * {gap})")


def close_blocks(blocks: DataFrame, epsilon: float, n_blocks: int, n_axes: int) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks whose boxes are at most epsilon apart."""
    boxes = blocks.select("block", "low", "high")
    width = FANOUT
    while width < n_blocks:
        width *= FANOUT
    pairs = blocks.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))

    def corners(column, pick):
        return F.array(*[pick(F.element_at(column, i + 1)) for i in range(n_axes)])

    while width > 1:
        width //= FANOUT
        level = boxes.groupBy(F.expr(f"block div {width}").alias("interval")).agg(
            corners("low", F.min).alias("low"), corners("high", F.max).alias("high")
        )
        level = level.withColumn("parent", F.expr(f"interval div {FANOUT}"))

        def side(name, level=level):
            return level.toDF(f"{name}_new", f"{name}_low", f"{name}_high", name)

        pairs = cut_lineage(
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .where("a_new <= b_new")
            .where(_box_gap("a", "b") <= epsilon * epsilon + SLACK)
            .select(F.col("a_new").alias("a"), F.col("b_new").alias("b"))
        )
    return pairs


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after joining the sets of i[k] and j[k] for all k; a root is its set's smallest member."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (higher := root[root]).tobytes() != root.tobytes():
            root = higher


def join_intervals(vectors, places, counts, split: int, min_cosine: float, epsilon: float):
    """Link counts and roots of rows; rows before ``split`` are joined with those from it on.

    With ``split`` 0 all rows are joined with themselves.
    """
    n = len(vectors)
    singles = vectors.astype(np.float32)
    # Rounding both vectors and adding up their products, with room to spare.
    doubt = (vectors.shape[1] + 8) * 2.0**-23
    links, root = np.zeros(n, np.int64), np.arange(n)
    todo = [((0, split), (split, n))] if split else [((0, n), (0, n))]
    while todo:
        (a0, a1), (b0, b1) = todo.pop()
        low_a, high_a = places[a0:a1].min(axis=0), places[a0:a1].max(axis=0)
        low_b, high_b = places[b0:b1].min(axis=0), places[b0:b1].max(axis=0)
        gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
        if gap @ gap > epsilon * epsilon + SLACK:
            continue
        if max(a1 - a0, b1 - b0) > LEAF:
            halves_a = _halves(a0, a1)
            halves_b = _halves(b0, b1)
            same = (a0, a1) == (b0, b1)
            todo += [(x, y) for x in halves_a for y in halves_b if not same or x <= y]
            continue
        cosines = singles[a0:a1] @ singles[b0:b1].T
        if (cosines < min_cosine - doubt).all():
            continue
        if (np.abs(cosines - min_cosine) <= doubt).any():
            cosines = vectors[a0:a1] @ vectors[b0:b1].T
        hit = cosines >= min_cosine
        if a0 == b0:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        links[a0:a1] += hit @ counts[b0:b1]
        if a0 != b0:
            links[b0:b1] += counts[a0:a1] @ hit
        i, j = np.nonzero(hit)
        root = merge(root, i + a0, j + b0)
    return links, root


def _halves(start: int, end: int) -> list[tuple[int, int]]:
    if end - start <= LEAF:
        return [(start, end)]
    middle = (start + end) // 2
    return [(start, middle), (middle, end)]


def _join_blocks(
    pairs: DataFrame, blocks: DataFrame, axes: np.ndarray, stored: str, min_cosine: float, epsilon: float
) -> DataFrame:
    """id, links and root of the classes that have a link within one of the pairs of blocks."""
    dimension = len(axes)

    def join(table: pa.Table) -> pa.Table:
        rows = table.sort_by("block").to_pylist()
        ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
        counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
        split = len(rows[0]["ids"]) // 8 if len(rows) == 2 else 0
        vectors = np.concatenate([np.frombuffer(r.pop("vectors"), stored).reshape(-1, dimension) for r in rows])
        vectors = unit_rows(vectors.astype(np.float64))
        links, root = join_intervals(vectors, vectors @ axes, counts, split, min_cosine, epsilon)
        linked = links > 0
        return pa.table({"id": ids[linked], "links": links[linked], "root": ids[root[linked]]})

    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    return sides.join(blocks.drop("low", "high"), "block").groupBy("a", "b").applyInArrow(join, JOINED)


def class_links(classes: DataFrame, dimension: int, min_cosine: float, block: int | None) -> DataFrame:
    """id, links, root (one row per class and task that found links) of classes of one length."""
    epsilon = float(np.sqrt(2 - 2 * min_cosine))
    n_classes = classes.count()
    block = block or rows_per_block(n_classes, dimension, classes.sparkSession.sparkContext.defaultParallelism)
    axes = principal_axes(_sample(classes, n_classes, dimension))
    ordered = _in_grid_order(classes, axes, epsilon)
    blocks = cut_lineage(_blocks(ordered, axes, block))
    n_blocks = blocks.count()
    pairs = close_blocks(blocks, epsilon, n_blocks, axes.shape[1])
    return cut_lineage(_join_blocks(pairs, blocks, axes, _number_type(classes), min_cosine, epsilon))


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, block: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; ``block`` sets the classes in a block."""
    rows = cut_lineage(usable(vectors))
    classes = cut_lineage(_classes(rows.where("key IS NOT NULL")))
    lengths = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    found = None
    for n in sorted(lengths):
        part = class_links(classes.where(F.size("embedding") == n), n, min_cosine, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], JOINED)
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    # Components are named by numbers of classes until the end.
    groups = cut_lineage(components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    named = cut_lineage(
        classes.select("key", "id", "first", "count")
        .join(counts, "id", "left")
        .join(groups.withColumnsRenamed({"node": "id", "component_id": "group"}), "id", "left")
        .select(
            "key",
            "first",
            (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"),
            F.coalesce("group", "id").alias("group"),
        )
    )
    lowest = cut_lineage(named.groupBy("group").agg(F.min("first").alias("component_id")))
    named = named.join(lowest, "group").select("key", "n_links", "component_id")
    answered = rows.select("vec_id", "key").join(cut_lineage(named), "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return answered.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
