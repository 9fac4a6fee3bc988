"""Top-k per group and latest-per-key.

A ``row_number() <= k`` filter plans as a partial ``WindowGroupLimit`` in front of
the shuffle: each map task forwards at most k rows of a group, however large
that group is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Spark places the partial limit only up to this k (its default threshold); beyond it
# groups are first cut in this many salted pieces.
PARTIAL_LIMIT = 1000
PIECES = 64
SLICES = 256  # of a group's values, by hash


def top_per_group(
    df: DataFrame, group: list[Column | str], order: list[Column], k: int, rank_as: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group; give a total order for a repeatable result."""
    if k > PARTIAL_LIMIT:
        salted = df.withColumn("__piece", F.pmod(F.xxhash64(*df.columns), F.lit(PIECES)))
        df = _first_rows(salted, [*group, "__piece"], order, k, None).drop("__piece")
    return _first_rows(df, group, order, k, rank_as)


def _first_rows(
    df: DataFrame, group: list[Column | str], order: list[Column], k: int, rank_as: str | None
) -> DataFrame:
    name = rank_as or "__rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = ranked.where(F.col(name) <= k)
    return kept if rank_as else kept.drop(name)


def latest_per_key(df: DataFrame, key: list[Column | str], newest_first: list[Column]) -> DataFrame:
    """One row per key; ties fall to the remaining columns so the choice is repeatable."""
    return top_per_group(df, key, newest_first + [F.col(f"`{c}`") for c in df.columns], 1)


def latest_by_id(df: DataFrame, group: Column, id_column: str) -> DataFrame:
    """One row per group where rows have a unique id: the one with the highest id.

    The winners are found on narrow columns, combined inside each map task; whole rows
    move once, spread by id, so neither wide rows nor hot groups pile up.
    """
    winners = df.groupBy(group.alias("__group")).agg(F.max(id_column).alias("__id"))
    return df.join(winners.select("__id"), F.col(id_column) == F.col("__id"), "left_semi")


def points_per_area(df: DataFrame, area: str, order: str, k: int = 3, numeric: bool = False) -> DataFrame:
    """At most ``k`` points per area by one column, compared as text unless ``numeric``."""
    first = F.col(order).cast("double" if numeric else "string")
    others = [F.col(f"`{c}`") for c in df.columns if c not in (area, order)]
    return top_per_group(df, [area], [first, *others], k)


def smallest_values(df: DataFrame, group: list[str], value: str, k: int = 3, rank_as: str = "rank") -> DataFrame:
    """The ``k`` smallest distinct values of each group, ranked, for few groups and a small k.

    One aggregation finds the smallest and largest value of each of ``SLICES`` slices of a
    group by hash, so a task sends at most that many records of a group, however many values
    it has and however often one is repeated.  The k lowest slices decide a group if those
    below the k-th hold one value each.  If not, the k-th slice's smallest value bounds the
    answer from above, and a second aggregation takes the distinct values up to it, from the
    undecided groups alone.  Nulls are no values; null is a group of its own.  At most k rows
    of each group go through the driver.
    """
    rows = df.select(*group, value).where(F.col(value).isNotNull())
    part = F.pmod(F.xxhash64(value), F.lit(SLICES)).alias("__slice")
    slices = rows.groupBy(*group, part).agg(F.min(value).alias(value), F.max(value).alias("__last"))
    lowest: dict[tuple, list] = {}
    for row in top_per_group(slices, group, [F.col(value)], k, rank_as).orderBy(rank_as).collect():
        lowest.setdefault(tuple(row[g] for g in group), []).append(row)
    decided, undecided = [], []
    for key, found in lowest.items():
        if all(row[rank_as] == k or row[value] == row["__last"] for row in found):
            decided += [(*key, row[value], row[rank_as]) for row in found]
        else:
            undecided.append((key, found[-1][value] if len(found) == k else None))
    shown = df.sparkSession.createDataFrame(decided, rows.schema.add(rank_as, T.IntegerType()))
    if not undecided:
        return shown
    further = rows.where(reduce(Column.__or__, [_up_to(group, key, value, bound) for key, bound in undecided])).distinct()
    return shown.unionByName(top_per_group(further, group, [F.col(value)], k, rank_as))


def _up_to(group: list[str], key: tuple, value: str, bound) -> Column:
    same = [F.col(g).eqNullSafe(F.lit(part)) for g, part in zip(group, key)]
    return reduce(Column.__and__, same if bound is None else [*same, F.col(value) <= F.lit(bound)])
