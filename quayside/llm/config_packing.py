"""Packing documents into sequences by a linear program over configurations.

A document is its token ids and an end id.  Longer ones are cut into pieces of the capacity;
the last piece may be shorter.  What can be packed depends on the histogram of piece lengths
alone, which has no more entries than the capacity, so the plan is made from it:

1. A configuration is a multiset of lengths that fits into a sequence.  The linear program
   asks for amounts of configurations that cover every length as often as it occurs, with
   the least sum.  It is solved approximately by multiplicative weights: lengths that are
   covered less weigh more, a knapsack by dynamic programming finds the configuration
   worth most, and an amount of it is added, until every length is covered.
2. Amounts are rounded to whole sequences as they are added, down or to one, and never need
   more pieces than are left, so the rounds place every piece.  Only if a caller limits the
   rounds is there a rest, packed best-fit decreasing, whole groups of equal sequences at a time.

The plan's size depends on the capacity, not on the number of documents.  Spark then ranks
the pieces of each length and looks up where a rank goes.  Ranks come from counts per
partition, so a length that very many pieces share is ranked in as many tasks.

Documents that have an order, as those of a mix, are packed so that the sequences follow it.
They are cut into windows of ``WINDOW_TOKENS`` tokens; every window is planned and filled by
itself, in a task, and the sequences of a window are numbered after those of all windows
before it.  Within a window the copies of each configuration are spread evenly over the
order, and the pieces of a length go to the sequences in theirs.  What this costs is that
the last sequences of each window may not be full.

A null text is an empty one: its only id is the end id.  Rows with a repeated or null doc_id
are documents like any other.  Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import tokens
from quayside.llm.batches import bounded
from quayside.session import cut_lineage

CAPACITY = 2048
END_ID = 0
ROUNDS = None  # of the multiplicative weights; None: until every length is covered
STEP = 0.5  # share of the scarcest length that one round covers
LEARNING = 0.3  # how fast a covered length loses weight
NEXT = 0.999  # share of the last configuration's worth that the next one is first sought above
WINDOW_TOKENS = 512 * CAPACITY  # whose pieces are packed together where the order counts
PASSES = 2  # over a window's sequences to bring them into order
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# Times each length occurs in a sequence, and how many such sequences there are.
Configuration = tuple[tuple[int, int], ...]
Plan = list[tuple[Configuration, int]]


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    order: Sequence[Column] = (),
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces of the whole texts.

    With an ``order`` also ``place``, its columns as one.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = tokens.encoder(tokenizer).encode_all
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            texts = (text.as_py() or b"" for text in batch.column("text").cast(pa.binary()))
            for n, ids in enumerate(encode_all(texts)):
                encoded = memoryview(ids + end)
                for k, at in enumerate(range(0, len(encoded), 4 * capacity)):
                    piece = encoded[at : at + 4 * capacity]
                    row.append(n)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
            same = batch.drop_columns(["text"]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [same.column("doc_id"), pa.array(number, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)]
                + same.columns[1:],
                ["doc_id", "piece", "start", "length", "ids_crc32", *same.schema.names[1:]],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *([F.struct(*order).alias("place")] if order else []),
    )
    place = f", place {rows.schema['place'].dataType.simpleString()}" if order else ""
    return bounded(rows).mapInArrow(cut, PIECES + place)


def knapsack(
    lengths: np.ndarray, worth: np.ndarray, most: np.ndarray, capacity: int, at_least: float = 0.0
) -> Configuration:
    """The multiset of lengths that is worth most, each at most ``most`` times, by dynamic programming.

    If the best is worth less than ``at_least``, what is found may be worth less than the best.
    """
    # Against filling a sequence at the highest worth per id, each length loses something; so
    # many of it that they lose too much are in nothing worth ``at_least``.
    density = float((worth / lengths).max())
    loss = np.maximum(density * lengths - worth, 1e-12)
    most = np.minimum(most, (max(0.0, density * capacity - at_least) + 1e-9) / loss)
    best, with_it = np.zeros(capacity + 1), np.zeros(capacity + 1)
    taken = []
    for k in np.flatnonzero(most >= 1).tolist():
        length, value, times = int(lengths[k]), float(worth[k]), int(most[k])
        bundle = 1
        while times > 0:
            bundle = min(bundle, times)
            weight = bundle * length
            if weight > capacity:
                break
            own, above = with_it[: capacity + 1 - weight], best[weight:]
            np.add(best[: capacity + 1 - weight], bundle * value, out=own)
            taken.append((k, bundle, weight, own > above))
            np.maximum(above, own, out=above)
            times -= bundle
            bundle *= 2
    room = int(best.argmax())
    chosen: dict[int, int] = {}
    for k, bundle, weight, better in reversed(taken):
        if room >= weight and better[room - weight]:
            chosen[k] = chosen.get(k, 0) + bundle
            room -= weight
    return tuple(sorted(((int(lengths[k]), n) for k, n in chosen.items()), reverse=True))


def fractional_cover(counts: dict[int, int], capacity: int, rounds: int | None = ROUNDS) -> dict[Configuration, int]:
    """Numbers of sequences by multiplicative weights; lengths covered already are left out.

    Every round places half of the pieces of some length, or all that are left of one, or as
    many whole sequences of them as there can be; so rounds grow with the number of lengths.
    """
    lengths = np.array(sorted(counts, reverse=True))
    number = np.array([counts[n] for n in lengths.tolist()], np.int64)
    place = {n: i for i, n in enumerate(lengths.tolist())}
    left = number.copy()
    # The weight a length starts with: the space it takes, and a little more for long ones.
    space = (lengths / capacity) ** 1.1
    amounts: dict[Configuration, int] = {}
    last, done = 0.0, 0
    while left.any() and (rounds is None or done < rounds):
        lacking = left > 0
        worth = space * np.exp(-LEARNING * (1 - left / number))
        most = np.minimum(left, capacity // lengths)
        at_least = NEXT * last
        while True:
            chosen = knapsack(lengths[lacking], worth[lacking], most[lacking], capacity, at_least)
            where = np.array([place[n] for n, _ in chosen], np.int64)
            times = np.array([t for _, t in chosen], np.int64)
            last = float(worth[where] @ times)
            if last >= at_least * (1 - 1e-9):
                break
            at_least = last
        amount = max(1, int((np.minimum(STEP * number[where], left[where]) / times).min()))
        amounts[chosen] = amounts.get(chosen, 0) + amount
        left[where] -= amount * times
        done += 1
    return amounts


def placed(amounts: dict[Configuration, int], left: dict[int, int]) -> Plan:
    """The sequences of the cover, whose pieces are taken from ``left``; the largest numbers first."""
    plan = sorted(amounts.items(), key=lambda x: (-x[1], x[0]))
    for configuration, copies in plan:
        for n, t in configuration:
            left[n] -= copies * t
    return plan


def best_fit(left: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing, for all sequences of equal content at once."""
    open_: dict[int, list[list]] = {}  # room: [number of sequences, content]

    def put(room: int, number: int, content: Configuration) -> None:
        if number:
            open_.setdefault(room, []).append([number, content])

    for length in sorted((n for n, c in left.items() if c), reverse=True):
        count = left[length]
        for room in sorted(r for r in open_ if r >= length):
            groups, fits = open_.pop(room), room // length
            for number, content in groups:
                filled = min(number, count // fits)
                put(room - fits * length, filled, content + ((length, fits),))
                count -= filled * fits
                number -= filled
                if number and count:
                    put(room - count * length, 1, content + ((length, count),))
                    count, number = 0, number - 1
                put(room, number, content)
            if not count:
                break
        fits = capacity // length
        put(capacity - fits * length, count // fits, ((length, fits),))
        if count % fits:
            put(capacity - count % fits * length, 1, ((length, count % fits),))
    return [(content, number) for groups in open_.values() for number, content in groups]


def make_plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int | None = ROUNDS) -> Plan:
    left = dict(counts)
    plan = placed(fractional_cover(counts, capacity, rounds), left) if counts else []
    return plan + best_fit(left, capacity)


class Places:
    """Where the piece with a certain rank among those of its length goes."""

    def __init__(self, plan: Plan):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        sequence = 0
        for configuration, copies in plan:
            offset = 0
            for length, times in configuration:
                first = used.get(length, 0)
                by_length.setdefault(length, []).append((first, sequence, times, offset))
                used[length] = first + copies * times
                offset += length * times
            sequence += copies
        self.sequences = sequence
        self.by_length = {n: np.array(rows, np.int64).T for n, rows in by_length.items()}

    def find(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset."""
        first, sequence, times, offset = self.by_length[length]
        slot = np.searchsorted(first, ranks, side="right") - 1
        nth = ranks - first[slot]
        return sequence[slot] + nth // times[slot], offset[slot] + nth % times[slot] * length


def _ranked(cut: DataFrame) -> DataFrame:
    """The pieces with ``rank``, from 0, among all of their length."""
    part_sizes = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = part_sizes.select(
        "length",
        "part",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece"))
    return (
        cut.withColumn("own", own)
        .join(cut_lineage(before), ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("own") - 1)
    )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    rounds: int | None = ROUNDS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = cut_lineage(pieces(docs, capacity, end_id, tokenizer).withColumn("part", F.spark_partition_id()))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = Places(make_plan(counts, capacity, rounds))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                own = lengths == length
                sequence[own], offset[own] = places.find(length, ranks[own])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return _ranked(cut).select(*columns, "rank").mapInArrow(look_up, f"{PIECES}, sequence_id bigint, offset bigint")


def in_order(lengths: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces that are given in order, by a plan that holds just them.

    The pieces of one length keep their order.  The first pass takes the copies of each
    configuration as spread evenly; the others order sequences by the mean place of their tokens.
    """
    slot_length, slot_sequence, slot_offset, times, sequence = [], [], [], [], 0
    for configuration, copies in plan:
        own, offset = np.arange(sequence, sequence + copies), 0
        for length, n in configuration:
            slot_length.append(np.full(copies * n, length))
            slot_sequence.append(np.repeat(own, n))
            slot_offset.append(np.tile(offset + length * np.arange(n), copies))
            offset += length * n
        times.append((np.arange(copies) + 0.5) / copies)
        sequence += copies
    slot_length, slot_sequence, slot_offset, times = map(
        np.concatenate, (slot_length, slot_sequence, slot_offset, times)
    )
    by_length = np.argsort(lengths, kind="stable")
    middle = np.cumsum(lengths) - lengths / 2
    sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for _ in range(PASSES):
        rank = np.empty(sequence, np.int64)
        rank[np.argsort(times, kind="stable")] = np.arange(sequence)
        slots = np.lexsort((slot_offset, rank[slot_sequence], slot_length))
        sequences[by_length], offsets[by_length] = rank[slot_sequence[slots]], slot_offset[slots]
        mean = np.bincount(sequences, lengths * middle) / np.bincount(sequences, lengths)
        times = mean[rank]
    return sequences, offsets


def _windows(cut: DataFrame, window_tokens: int) -> DataFrame:
    """The pieces with ``before``, the tokens before them in the order, and the ``window`` they begin in."""
    n = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["place", "doc_id", "piece"]
    rows = cut_lineage(cut.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()))
    sizes = rows.groupBy("part").agg(F.sum("length").alias("n"))
    first = cut_lineage(sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first")))
    within = F.sum("length").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("within", within - F.col("length"))
        .join(first, "part")
        .withColumn("before", F.col("first") + F.col("within"))
        .withColumn("window", F.expr(f"before DIV {window_tokens}"))
        .drop("place", "part", "first", "within")
    )


def pack_in_order(
    docs: DataFrame,
    order: Sequence[Column],
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """As ``pack``, in sequences whose ids follow the order of the documents.

    The pieces that begin in one window of the order are packed together, so a sequence holds
    pieces of one window only, and its id is above those of all windows before.
    """
    cut = cut_lineage(pieces(docs, capacity, end_id, tokenizer, order))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def fill(window: pa.Table) -> pa.Table:
        window = window.sort_by("before")
        lengths = window.column("length").to_numpy()
        sequence, offset = in_order(lengths, make_plan(dict(Counter(lengths.tolist())), capacity))
        # A window begins no more pieces than it has tokens, so its ids end before the next one's.
        sequence += window.column("window")[0].as_py() * window_tokens
        found = window.select(columns)
        return found.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    rows = cut_lineage(_windows(cut, window_tokens))
    # Planning takes its time however small the rows are, so the windows are dealt to all tasks.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "window")
    return dealt.groupBy("window").applyInArrow(fill, f"{PIECES}, sequence_id bigint, offset bigint")
