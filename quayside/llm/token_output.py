"""Token ids packed best-fit decreasing and written as binary rows, ready for training.

Each task encodes its documents, cuts overlong ones into pieces without loss, and packs
groups of up to ``GROUP_TOKENS`` tokens: longest piece first, each into the fullest open
sequence that still has room for it.  A segment tree over the rooms, 0 to the capacity,
finds that sequence in the logarithm of the capacity.  Nothing is shuffled, and a task holds
one group at a time.

One row of the output is one sequence, its arrays as little-endian bytes: ``ids`` (unsigned
16-bit, or 32-bit for large vocabularies; padded with the end id to the capacity),
``cu_seqlens`` (32-bit; 0 and the end of each segment), ``positions`` (unsigned 16-bit; they
begin at 0 with each segment, and with the padding).  ``doc_ids``, ``pieces`` and ``starts``
say which piece a segment is.  A matrix of ids is the rows' bytes one after the other.  The
rows are a Parquet table, so a lost task is written again and only whole tables are seen.

A document ends with the end id, so a null or empty text is one segment of one id.  Rows
with a repeated or null doc_id are documents like any other.  Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import tokens
from quayside.llm.batches import bounded

CAPACITY = 2048
END_ID = 49407  # the end-of-text id of the default vocabulary
GROUP_TOKENS = 1 << 21
ROWS_AT_ONCE = 256

PACKED = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("cu_seqlens", pa.binary()),
        ("positions", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("pieces", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int64())),
    ]
)
PACKED_DDL = (
    "sequence_id bigint, n_tokens int, ids binary, cu_seqlens binary, positions binary, "
    "doc_ids array<bigint>, pieces array<int>, starts array<bigint>"
)
SEGMENTS = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, "
    "offset bigint, positions_ok boolean"
)


class Rooms:
    """Open sequences by the room they have left; a segment tree counts them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.leaves
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The sequence with the smallest room of at least ``least``, and its room."""
        node = least + self.leaves
        if not self.counts[node]:
            # Up to the first right-hand neighbour that has one, then down on its left.
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.counts[2 * node])
        room = node - self.leaves
        sequence = self.open[room].pop()
        while node:
            self.counts[node] -= 1
            node >>= 1
        return sequence, room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the pieces in each sequence."""
    rooms, sequences = Rooms(capacity), []
    for index in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[index]
        found = rooms.take(length)
        if found is None:
            sequences.append([index])
            rooms.add(capacity - length, len(sequences) - 1)
        else:
            sequence, room = found
            sequences[sequence].append(index)
            rooms.add(room - length, sequence)
    return sequences


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value for each count: so many of the values, one after the other."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(values.tobytes())]
    )


def _positions(rows: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, filled: np.ndarray, capacity: int) -> np.ndarray:
    """A row of positions for each sequence: from 0 in each segment, and in the padding.

    ``rows``, ``offsets`` and ``lengths`` tell where the segments are, row by row in order.
    """
    positions = (np.arange(capacity)[None, :] - filled[:, None]).astype("<u2")
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    positions.ravel()[np.repeat(rows * capacity + offsets, lengths) + within] = within
    return positions


def _batch(group: list[tuple], sequences: list[list[int]], first: int, capacity: int, end_id: int, kind: str):
    """The sequences of a group as one record batch, its arrays filled as wholes."""
    order = [i for members in sequences for i in members]
    counts = np.array([len(members) for members in sequences])
    rows = np.repeat(np.arange(len(sequences)), counts)
    lengths = np.array([len(group[i][3]) // 4 for i in order])
    begins = np.cumsum(lengths) - lengths
    firsts = np.cumsum(counts) - counts
    offsets = begins - begins[firsts][rows]
    filled = np.add.reduceat(lengths, firsts)

    ids = np.frombuffer(b"".join([group[i][3] for i in order]), "<u4")
    matrix = np.full((len(sequences), capacity), end_id, kind)
    matrix.ravel()[np.repeat(rows * capacity + offsets - begins, lengths) + np.arange(len(ids))] = ids
    bounds = np.zeros(len(order) + len(sequences), "<i4")
    bounds[np.arange(len(order)) + rows + 1] = offsets + lengths
    each = np.full(len(sequences), capacity)
    splits = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())

    def lists(field: int, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(splits, pa.array([group[i][field] for i in order], kind))

    columns = [
        pa.array(first + np.arange(len(sequences)), pa.int64()),
        pa.array(filled, pa.int32()),
        _binary(matrix, each),
        _binary(bounds, counts + 1),
        _binary(_positions(rows, offsets, lengths, filled, capacity), each),
        lists(0, pa.int64()),
        lists(1, pa.int32()),
        lists(2, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=PACKED)


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    wide: bool = False,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row for each sequence, as described above; ``wide`` for 32-bit ids."""
    if capacity > 1 << 16:
        raise ValueError("positions are 16-bit numbers: the capacity may be 65,536 at most")
    end = np.array([end_id], "<u4").tobytes()
    kind = "<u4" if wide else "<u2"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer).encode
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 33
        group: list[tuple] = []
        size = done = 0

        def flush():
            nonlocal group, size, done
            sequences = best_fit_decreasing([len(p[3]) // 4 for p in group], capacity)
            whole = _batch(group, sequences, first + done, capacity, end_id, kind)
            done += len(sequences)
            group, size = [], 0
            for i in range(0, len(sequences), ROWS_AT_ONCE):
                yield whole.slice(i, ROWS_AT_ONCE)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                encoded = encode(text or b"") + end
                for k, at in enumerate(range(0, len(encoded), 4 * capacity)):
                    piece = encoded[at : at + 4 * capacity]
                    group.append((doc_id, k, at // 4, piece))
                    size += len(piece) // 4
                    if size >= group_tokens:
                        yield from flush()
        if group:
            yield from flush()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded(rows).mapInArrow(pack, PACKED_DDL)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    packed(docs, **options).write.parquet(path)


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, "u1")[offsets[0] : offsets[-1]].view(kind) if data else np.zeros(0, kind)
    return values, np.diff(offsets) // values.itemsize


def read_segments(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """Every segment, cut out of the written matrices by the written lengths and checked.

    ``positions_ok`` tells whether the positions begin anew exactly where segments do.
    """
    kind = "<u4" if wide else "<u2"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, widths = _flat(batch.column("ids").cast(pa.binary()), kind)
            positions, _ = _flat(batch.column("positions").cast(pa.binary()), "<u2")
            bounds, counts = _flat(batch.column("cu_seqlens").cast(pa.binary()), "<i4")
            lasts = np.cumsum(counts) - 1
            inner, outer = np.ones(len(bounds), bool), np.ones(len(bounds), bool)
            inner[lasts] = False
            outer[lasts - counts + 1] = False
            offsets, ends = bounds[inner].astype(np.int64), bounds[outer].astype(np.int64)
            rows = np.repeat(np.arange(len(counts)), counts - 1)
            capacity = int(widths[0])
            expected = _positions(rows, offsets, ends - offsets, bounds[lasts].astype(np.int64), capacity)
            right = (positions.reshape(-1, capacity) == expected).all(axis=1)
            octets = memoryview(ids.astype("<u4").tobytes())
            starts = 4 * (rows * capacity + offsets)
            stops = 4 * (rows * capacity + ends)
            crcs = [zlib.crc32(octets[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
            columns = [
                batch.column("doc_ids").flatten(),
                batch.column("pieces").flatten(),
                batch.column("starts").flatten(),
                pa.array(ends - offsets),
                pa.array(crcs, pa.int64()),
                pa.array(batch.column("sequence_id").to_numpy()[rows]),
                pa.array(offsets),
                pa.array(right[rows]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_SEGMENTS)

    return bounded(spark.read.schema(PACKED_DDL).parquet(path)).mapInArrow(cut, SEGMENTS)


_SEGMENTS = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32())]
    + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "sequence_id", "offset")]
    + [("positions_ok", pa.bool_())]
)
