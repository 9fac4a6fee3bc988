"""SimHash near-duplicates, found by multi-index hashing.

A fingerprint has 64 bits, each the majority of that bit over the hashes of the document's
word shingles.  Equal fingerprints are one class.  To find classes that differ in at most
two bits, a fingerprint is cut in two segments of 32 bits, each with a table.  If two
fingerprints differ in at most two bits, their upper segments differ in at most one bit,
or the lower ones are equal and the upper ones differ in exactly two.  So the ball of
radius one is looked up in the upper table and the segment itself in the lower one; the
complete distance of every match is verified.  A ball flips zeros to ones only, which
still meets each pair once.

A bucket of a table may hold very many fingerprints, each differing a little.  Instead of
comparing them all with each other, a lookup in a bucket of more than ``BUCKET`` names the
complete fingerprints that it may match, at most 529, and fetches those by equality.  Both
ways give the same links, so the work for each fingerprint is bounded.

Null and empty texts, and texts of white space alone, have the fingerprint zero and are
linked like any other.  Rows with equal doc_id count as one document if their texts are
equal, else as that many documents with the same id; a null doc_id names no component.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import bounded
from quayside.llm.components import components
from quayside.session import cut_lineage

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
BUCKET = 512
PRINTS = "doc_id bigint, print bigint"

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 1 << 16  # hashes counted at a time, so that a long text needs little memory


def fingerprint(text: bytes) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    from xxhash import xxh64_intdigest

    words = text.translate(_LOWER).split()
    n = len(words)
    if not n:
        return 0
    if n < SHINGLE_WORDS:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hashes = [
            xxh64_intdigest(b"%b %b %b" % three, SEED) for three in zip(words, words[1:], words[2:])
        ]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[i : i + _BLOCK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = 2 * counts > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def signed(print_: int) -> int:
    return print_ - (1 << 64) if print_ >= 1 << 63 else print_


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        prints = np.array([fingerprint(t.as_py() or b"") for t in texts], dtype="<u8").view("<i8")
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and print (the 64 bits as a signed number) of every whole text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded(rows).mapInArrow(_prints, PRINTS)


def _masks(bits: int, offset: int) -> list[int]:
    """All numbers with exactly so many bits set within 32 bits from the offset, signed."""
    found = (sum(1 << (offset + b) for b in chosen) for chosen in combinations(range(32), bits))
    return [m - (1 << 64) if m >= 1 << 63 else m for m in found]


def _upper(print_: Column) -> Column:
    return F.shiftrightunsigned(print_, 32)


def _lower(print_: Column) -> Column:
    return print_.bitwiseAND(F.lit(0xFFFFFFFF))


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def near_prints(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints ``print`` that differ in 1 or 2 bits."""
    print_ = F.col("print")
    table = prints.select(
        "print",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), _upper(print_).alias("key")),
                F.struct(F.lit(1).alias("part"), _lower(print_).alias("key")),
            )
        ).alias("at"),
    ).select("at.part", "at.key", F.col("print").alias("other"))
    flips = F.transform(
        F.filter(_numbers([1 << b for b in range(32)]), lambda m: _upper(print_).bitwiseAND(m) == 0),
        lambda m: F.struct(F.lit(0).alias("part"), _upper(print_).bitwiseXOR(m).alias("key"), F.lit(1).alias("off")),
    )
    here = F.array(
        F.struct(F.lit(0).alias("part"), _upper(print_).alias("key"), F.lit(0).alias("off")),
        F.struct(F.lit(1).alias("part"), _lower(print_).alias("key"), F.lit(0).alias("off")),
    )
    probes = prints.select("print", F.explode(F.concat(here, flips)).alias("at")).select("print", "at.*")

    # A full bucket: part, key.
    full = cut_lineage(
        table.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket).select("part", "key")
    )
    distance = F.bit_count(print_.bitwiseXOR(F.col("other")))
    apart = F.bit_count(_upper(print_).bitwiseXOR(_upper(F.col("other"))))
    # The upper table finds what differs there in at most one bit, the lower table the rest.
    due = F.when(F.col("part") == 1, (apart == 2) & (print_ < F.col("other"))).otherwise(
        (F.col("off") == 1) | (print_ < F.col("other"))
    )
    compared = (
        probes.join(full, ["part", "key"], "left_anti")
        .join(table, ["part", "key"])
        .where(due & distance.between(1, MAX_BITS))
        .select(print_.alias("a"), F.col("other").alias("b"))
    )
    if full.isEmpty():
        return compared
    inside = _numbers(_masks(1, 0) + _masks(2, 0))
    beside = _numbers([0] + _masks(1, 0))
    across = _numbers(_masks(2, 32))
    base = F.when(
        F.col("part") == 1, print_
    ).otherwise(F.shiftleft(F.col("key"), 32).bitwiseOR(_lower(print_)))
    masks = F.when(F.col("part") == 1, across).when(F.col("off") == 1, beside).otherwise(inside)
    named = (
        probes.join(full, ["part", "key"], "left_semi")
        .select("print", "off", F.explode(F.transform(masks, lambda m: base.bitwiseXOR(m))).alias("other"))
        .where((F.col("off") == 1) | (F.col("print") < F.col("other")))
        .select("print", "other")
    )
    fetched = named.join(prints.select(F.col("print").alias("other")), "other").select(
        F.col("print").alias("a"), F.col("other").alias("b")
    )
    return compared.unionByName(fetched)


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """doc_id, print, component_id (the smallest doc_id reachable) of every document."""
    found = cut_lineage(fingerprints(docs))
    classes = cut_lineage(found.groupBy("print").agg(F.min("doc_id").alias("first")))
    links = cut_lineage(near_prints(classes.select("print"), bucket))
    # Components of fingerprints; their names are fingerprints until the end.
    groups = cut_lineage(components(links).withColumnsRenamed({"node": "print", "component_id": "group"}))
    named = classes.join(groups, "print", "left").withColumn("group", F.coalesce("group", "print"))
    lowest = cut_lineage(named.groupBy("group").agg(F.min("first").alias("component_id")))
    named = cut_lineage(named.select("print", "group")).join(lowest, "group").select("print", "component_id")
    return found.join(cut_lineage(named), "print").select("doc_id", "print", "component_id")


def hex_print(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all columns.

    Documents without a doc_id stay.  The documents to drop are joined by id; if they are
    few, measured, they are broadcast and the texts are not shuffled.  Only where an id that
    is dropped also has a text that stays are fingerprints taken again, to tell them apart.
    """
    found = cut_lineage(near_duplicates(docs))
    dropped = found.where("doc_id != component_id").select(F.col("doc_id").alias("gone_id"), F.col("print").alias("gone"))
    ids = cut_lineage(dropped.select("gone_id").distinct())
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("gone_id"))
    unlike = cut_lineage(ids.join(kept, "gone_id", "left_semi"))
    # The row goes along as one column, so that no name of its columns matters.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    stay = rows.join(ids, F.col("id") == F.col("gone_id"), "left_anti").select("row.*")
    if unlike.isEmpty():
        return stay
    take = F.pandas_udf(
        lambda texts: texts.map(lambda t: signed(fingerprint(t or b""))).astype("int64"), "bigint"
    )
    unsure = rows.join(unlike, F.col("id") == F.col("gone_id"), "left_semi")
    unsure = unsure.withColumn("print", take(F.col("row.text").cast("string").cast("binary")))
    same = (F.col("id") == F.col("gone_id")) & (F.col("print") == F.col("gone"))
    return stay.union(unsure.join(dropped.distinct(), same, "left_anti").select("row.*"))
