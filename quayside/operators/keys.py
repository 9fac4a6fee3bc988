"""Keys: duplicates, orphans and the cardinality of references.

Every operator here counts rows per key *before* anything is joined.  Spark
combines those counts inside each map task, so a key that holds a third of all
rows reaches the shuffle as one small record per task, and the join that follows
sees each key once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_per_key(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their row count; null equals null."""
    return rows_per_key(df, keys).where("n > 1")


def duplicate_summary(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """One row: all rows, rows in duplicate groups, number of such groups."""
    return rows_per_key(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


def _counted_against(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    used = child.groupBy(F.col(f"`{column}`").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = (
        parent.select(F.col(f"`{parent_column}`").alias("key"))
        .where("key is not null")
        .distinct()
        .withColumn("known", F.lit(True))
    )
    return used.join(known, "key", "left")


def orphan_summary(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """One row: child rows, and child rows whose key has no parent (null included)."""
    return _counted_against(child, column, parent, parent_column).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
    )


def orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Distinct orphan keys with their row counts."""
    return (
        _counted_against(child, column, parent, parent_column)
        .where("known is null")
        .select("key", "n")
    )


def reference_cardinality(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """One row: distinct parents, parents without children, most children of one parent."""
    used = child.groupBy(F.col(f"`{column}`").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(f"`{parent_column}`").alias("key")).where("key is not null").distinct()
    return known.join(used, "key", "left").agg(
        F.count(F.lit(1)).alias("n_parents"),
        F.count_if(F.col("n").isNull()).alias("childless_parents"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_children"),
    )


def in_keys(df: DataFrame, column: str, keys: DataFrame, key_column: str) -> DataFrame:
    """Rows whose key occurs in ``keys`` (left-semi; adaptive execution splits hot keys)."""
    wanted = keys.select(F.col(f"`{key_column}`").alias("__key"))
    return df.join(wanted, F.col(f"`{column}`") == F.col("__key"), "left_semi")


def union_of_keys(*sides: tuple[DataFrame, str]) -> DataFrame:
    """Distinct union of one column from each side, as ``key``."""
    first, *rest = [df.select(F.col(f"`{c}`").alias("key")) for df, c in sides]
    for other in rest:
        first = first.union(other)
    return first.distinct()


def null_pattern(columns: list[str]) -> Column:
    """The names of the columns that are null together in a row, in table order."""
    return F.concat_ws("+", *[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in columns])
