"""Mixing sources to target weights by proportionate-fair scheduling.

Each source's documents, in the order of a hash of their ids, are laid end to end and cut
into blocks of ``BLOCK_CHARS`` characters; a document belongs to the block it begins in.
Time is counted in blocks.  With weights k / FRAME, block i (from 1) of a source may not
run before its release floor((i - 1) * FRAME / k) and must have run by its deadline
ceil(i * FRAME / k).  Among the released blocks the one with the earliest deadline runs
next.  So after any number of blocks each source has had its share to less than one block.

All windows of one frame lie within it, since every source gets exactly k blocks in FRAME
slots, so one frame's schedule serves for all of them and every block's slot is arithmetic:
nothing runs one after the other over the data.  With more than FRAME sources the frame
grows, to SLOTS slots for each on average.  When a source has no blocks left its slots
stay empty and the rest keep their proportions; every document is in the mix once.

The order of documents within a source needs sums of lengths before each document.  They
are summed by hash range first, with as many ranges as the source's size asks for, so that
a source with most of the rows is spread over many tasks.

Null texts have no characters, and an empty document belongs to the block of the next one.
A null source is a source of its own.  Documents of equal hash are ordered by id; rows that
repeat an id stand side by side in any order.  Only doc_id, text and source are read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import cut_lineage

FRAME = 1000
SLOTS = 4  # of a frame for each source, on average, where there are more than FRAME sources
BLOCK_CHARS = 200_000
RANGE_ROWS = 1000  # documents, on average, whose lengths one task sums in order
HASH_DIGITS = 8  # hexadecimal digits that choose the range
SCHEDULE = "source_key string, k int, i int, release bigint, deadline bigint, slot int"


def frame_for(n_sources: int, frame: int = FRAME) -> int:
    """The frame itself, or the multiple of it that so many sources need."""
    return frame if n_sources <= frame else frame * -(-SLOTS * n_sources // frame)


def weights(sizes: DataFrame, frame: int = FRAME) -> DataFrame:
    """source_key and its share k of a frame: in proportion to the root of the source's size.

    Whole numbers only: each source gets at least one slot, the remaining slots go by
    proportion rounded down, and what rounding leaves goes to the largest remainders.
    """
    sizes = sizes.withColumn("root", F.floor(F.sqrt(F.col("chars").cast("double"))).cast("bigint") + 1)
    rest = f"({frame} - count(1) OVER ())"
    spread = sizes.selectExpr(
        "source_key",
        f"1 + {rest} * root DIV sum(root) OVER () AS floor_slots",
        f"{rest} * root % sum(root) OVER () AS remainder",
    )
    return spread.selectExpr(
        "source_key",
        f"""CAST(floor_slots + CASE WHEN row_number() OVER (ORDER BY remainder DESC, source_key)
            <= {frame} - sum(floor_slots) OVER () THEN 1 ELSE 0 END AS INT) AS k""",
    )


def frame_schedule(shares: DataFrame, frame: int = FRAME) -> DataFrame:
    """source_key, i (1 to k), release, deadline and slot of every block of one frame.

    One row holds all sources; the slots of the frame are filled by folding over them.  A
    frame that has grown is filled on the driver, by the same rule, with heaps.
    """
    if frame > FRAME:
        rows = _long_schedule([tuple(r) for r in shares.select("source_key", "k").collect()], frame)
        return shares.sparkSession.createDataFrame(rows, SCHEDULE)
    packed = shares.agg(F.sort_array(F.collect_list(F.struct("source_key", "k"))).alias("sources"))
    # What a source could run next: its deadline, its place in the list, its release.
    waiting = f"""transform(sources, (s, j) -> named_struct(
        'deadline', ((state.done[j] + 1) * {frame} + s.k - 1) DIV s.k,
        'j', j,
        'ready', state.done[j] < s.k AND state.done[j] * {frame} DIV s.k <= t))"""
    step = f"""named_struct(
        'done', transform(state.done, (n, j) -> n + CASE WHEN j = pick.j THEN 1 ELSE 0 END),
        'order', concat(state.order, array(pick.j)))"""
    pick = f"array_min(filter({waiting}, x -> x.ready))"
    folded = packed.selectExpr(
        "sources",
        f"""aggregate(sequence(0, {frame - 1}),
            named_struct('done', transform(sources, s -> 0L), 'order', CAST(array() AS ARRAY<INT>)),
            (state, t) -> element_at(transform(array({pick}), pick -> {step}), 1)).order AS order""",
    )
    slots = folded.selectExpr("sources", "posexplode(order) AS (slot, j)").where("j IS NOT NULL").selectExpr(
        "sources[j].source_key AS source_key", "sources[j].k AS k", "slot"
    )
    return slots.selectExpr(
        "source_key",
        "k",
        "slot",
        "row_number() OVER (PARTITION BY source_key ORDER BY slot) AS i",
    ).selectExpr(
        "source_key",
        "k",
        "i",
        f"(i - 1) * {frame} DIV k AS release",
        f"(i * {frame} + k - 1) DIV k AS deadline",
        "slot",
    )


def _long_schedule(shares: list[tuple[str, int]], frame: int) -> list[tuple]:
    shares = sorted(shares)
    done = [0] * len(shares)
    released = defaultdict(list, {0: list(range(len(shares)))})
    ready: list[tuple[int, int]] = []  # deadline, place in the list
    rows = []
    for slot in range(frame):
        for j in released.pop(slot, ()):
            heapq.heappush(ready, (-(-(done[j] + 1) * frame // shares[j][1]), j))
        if not ready:
            continue
        deadline, j = heapq.heappop(ready)
        name, k = shares[j]
        rows.append((name, k, done[j] + 1, done[j] * frame // k, deadline, slot))
        done[j] += 1
        if done[j] < k:
            released[max(slot + 1, done[j] * frame // k)].append(j)
    return rows


def source_key(source: Column) -> Column:
    """Sorts as the source does; a null source has a key that no other has."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _narrow(docs: DataFrame) -> DataFrame:
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        source_key(F.col("source")).alias("source_key"),
        F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("bigint").alias("chars"),
        digest.alias("digest"),
    )


def source_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_key").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n_docs"))


def starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """doc_id, source_key and start: the characters before the document in its source."""
    span = 16**HASH_DIGITS
    ranges = sizes.selectExpr("source_key", f"n_docs DIV {RANGE_ROWS} + 1 AS n_ranges")
    hashed = f"CAST(conv(substring(digest, 1, {HASH_DIGITS}), 16, 10) AS BIGINT)"
    rows = rows.join(ranges, "source_key").withColumn("hash_range", F.expr(f"{hashed} * n_ranges DIV {span}"))
    sums = rows.groupBy("source_key", "hash_range").agg(F.sum("chars").alias("range_chars"))
    before = cut_lineage(
        sums.selectExpr(
            "source_key",
            "hash_range",
            "sum(range_chars) OVER (PARTITION BY source_key ORDER BY hash_range) - range_chars AS before",
        )
    )
    inside = """sum(chars) OVER (PARTITION BY source_key, hash_range ORDER BY digest, doc_id
        ROWS UNBOUNDED PRECEDING) - chars AS inside"""
    return (
        rows.selectExpr("doc_id", "source_key", "hash_range", inside)
        .join(before, ["source_key", "hash_range"])
        .selectExpr("doc_id", "source_key", "before + inside AS start")
    )


def mix(docs: DataFrame, shares: DataFrame | None = None, frame: int = FRAME, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, source_key, k, block, start, release, deadline and position of every document.

    The mix is the documents by position, then start, then doc_id.  ``shares`` (source_key,
    k) are the target weights in slots of a frame; they must add up to ``frame`` and name
    every source, or an error names those without slots.  Without them weights follow from
    the sizes of the sources, in a frame that grows with their number.
    """
    rows = cut_lineage(_narrow(docs))
    sizes = cut_lineage(source_sizes(rows))
    if shares is None:
        frame = frame_for(sizes.count(), frame)
        shares = weights(sizes, frame)
    schedule = cut_lineage(frame_schedule(shares, frame))
    whole = schedule.groupBy("source_key", "k").agg(F.count(F.lit(1)).alias("n")).where("n = k")
    lacking = [r[0] for r in sizes.join(whole, "source_key", "left_anti").select("source_key").limit(5).collect()]
    if lacking:
        raise ValueError(f"sources without all of their slots in a frame of {frame}: {lacking}")
    placed = starts(rows, sizes).withColumn("block", F.expr(f"start DIV {block_chars} + 1"))
    shares = schedule.select("source_key", "k").distinct()
    turn = placed.join(shares, "source_key").selectExpr(
        "doc_id", "source_key", "start", "block", "k", "(block - 1) DIV k AS turn", "(block - 1) % k + 1 AS i"
    )
    return turn.join(schedule.drop("k"), ["source_key", "i"]).selectExpr(
        "doc_id",
        "source_key",
        "k",
        "block",
        "start",
        f"turn * {frame} + release AS release",
        f"turn * {frame} + deadline AS deadline",
        f"turn * {frame} + slot AS position",
    )


def in_mixed_order(docs: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """The documents with their columns, laid out in files in the order of the mix."""
    places = mix(docs, shares).groupBy(F.col("doc_id").alias("mixed_id")).agg(
        F.min(F.struct("position", "start")).alias("place")
    )
    # The row goes along as one column, so that no name of its columns matters.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    placed = rows.join(cut_lineage(places), F.col("id").eqNullSafe(F.col("mixed_id")))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(n, "place", "id").sortWithinPartitions("place", "id").select("row.*")


def file_order() -> list[Column]:
    """Sorts documents read from files as the files of ``in_mixed_order`` hold them."""
    name = F.col("_metadata.file_name")
    # A task's number in a name has five digits, or more for those from 100,000.
    return [F.length(name).alias("digits"), name.alias("file"), F.col("_metadata.row_index").alias("row")]
