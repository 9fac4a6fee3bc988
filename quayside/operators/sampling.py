"""Exactly n random rows, repeatable, and the rows that refer to them.

The order is the MD5 of seed and key, so a sample depends neither on partitioning
nor on file order.  Rather than sort the table, the n-th smallest hash is located
by counting hash prefixes; the sample is then a filter.  The same filter applies to
every table that carries the key, so a child table is cut down to sample size in
its own scan, before the exact semi-join shuffles anything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.keys import in_keys

PREFIX_DIGITS = 3
FINAL_BUCKET_ROWS = 100_000
HASH_DIGITS = 32
ROW_DIGEST = "__row_digest"
NULL_HASH = "~"  # sorts after every hexadecimal digest


def seeded_hash(key: Column, seed) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.coalesce(digest, F.lit(NULL_HASH))


@dataclass(frozen=True)
class Cut:
    """The hash a sample ends with, how many of its rows belong to the sample, and how many there are."""

    hash: str
    rows_kept: int
    rows_there: int


def find_cut(df: DataFrame, key: str, n: int, seed) -> Cut | None:
    """Locate the n-th smallest hash; ``None`` when the table has at most n rows.

    Each round counts rows per next hash digits, so each task and the driver handle at
    most 4,096 numbers, and goes into the one bucket that holds the n-th row.  A
    million million rows take two rounds over a single column.
    """
    hashes = df.select(seeded_hash(F.col(f"`{key}`"), seed).alias("hash"))
    prefix, missing = "", n
    while True:
        inside = hashes.where(F.col("hash").startswith(prefix)) if prefix else hashes
        digits = F.substring("hash", len(prefix) + 1, PREFIX_DIGITS)
        buckets = sorted(inside.groupBy(digits).agg(F.count(F.lit(1))).collect())
        if not prefix and sum(rows for _, rows in buckets) <= n:
            return None
        for bucket, rows in buckets:
            if rows >= missing:
                break
            missing -= rows
        prefix += bucket
        if rows <= FINAL_BUCKET_ROWS or len(prefix) >= HASH_DIGITS or prefix == NULL_HASH:
            break
    # Either few rows are left here or a single repeated hash; both are few groups.
    last = hashes.where(F.col("hash").startswith(prefix)).groupBy("hash").agg(F.count(F.lit(1)))
    for found, rows in sorted(last.collect()):
        if rows >= missing:
            return Cut(found, missing, rows)
        missing -= rows
    raise AssertionError("the bucket that holds the n-th row is shorter than counted")


def within(cut: Cut | None, key: str, seed) -> Column:
    """True for rows up to and including the cut."""
    if cut is None:
        return F.lit(True)
    return seeded_hash(F.col(f"`{key}`"), seed) <= cut.hash


def sample_rows(df: DataFrame, key: str, n: int, seed, cut: Cut | None = None) -> DataFrame:
    """Exactly ``n`` rows, or all of them when the table is no longer than that."""
    if n <= 0:
        return df.where(F.lit(False))
    cut = cut or find_cut(df, key, n, seed)
    if cut is None:
        return df
    picked = df.where(within(cut, key, seed))
    if cut.rows_kept == cut.rows_there:
        return picked
    # The sample ends inside a repeated key.  Of its rows take as many as fit, drawn by
    # the hash of the whole row; rows alike in every column are interchangeable.
    hashed = seeded_hash(F.col(f"`{key}`"), seed)
    rest = df.where(hashed == cut.hash)
    if key == ROW_DIGEST:
        partial = rest.limit(cut.rows_kept)
    else:
        digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256)
        partial = sample_rows(rest.withColumn(ROW_DIGEST, digest), ROW_DIGEST, cut.rows_kept, seed)
        partial = partial.drop(ROW_DIGEST)
    return df.where(hashed < cut.hash).union(partial)


def rows_of_sample(
    child: DataFrame, column: str, picked: DataFrame, key: str, seed, cut: Cut | None
) -> DataFrame:
    """Child rows that refer to a picked row: hash filter in the scan, then the exact semi-join."""
    return in_keys(child.where(within(cut, column, seed)), column, picked, key)
