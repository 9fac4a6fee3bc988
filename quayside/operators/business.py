"""Questions asked of orders, items, payments, products and places.

Column names are parameters, so the same operators serve any table of that shape.
Money is summed as decimal; one-to-many sides are aggregated before they are joined,
so joins never multiply rows and a hot key is already one row when it gets there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.keys import null_pattern

MONEY = "decimal(20,2)"


def money_sum(amount: Column, amount_type: str = "decimal(10,2)") -> Column:
    return F.coalesce(F.sum(amount.cast(amount_type)), F.lit(0)).cast(MONEY)


def centroids(points: DataFrame, area: str, lat: Column, lng: Column, exact_type: str = "decimal(18,8)") -> DataFrame:
    """Mean position per area.

    Coordinates are summed as decimals, so the mean does not depend on the order in
    which tasks finish.
    """
    n = F.count(F.lit(1))

    def mean(value: Column) -> Column:
        return F.sum(value.cast(exact_type)).cast("double") / F.count(value)

    return points.groupBy(area).agg(n.alias("n_points"), mean(lat).alias("lat"), mean(lng).alias("lng"))


def attach(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join to a table with one row per key; the row count does not change.

    No broadcast is forced: Spark broadcasts the right side when its measured size
    allows, and otherwise splits the partitions of hot left keys.
    """
    renamed = right.withColumnRenamed(right_key, "__right_key")
    return left.join(renamed, F.col(left_key) == F.col("__right_key"), "left").drop("__right_key")


def order_totals(items: DataFrame, order_key: str, **amounts: Column) -> DataFrame:
    """Item count and money per order."""
    return items.groupBy(order_key).agg(
        F.count(F.lit(1)).alias("n_items"),
        *[money_sum(c).alias(name) for name, c in amounts.items()],
    )


def payments_per_order(
    payments: DataFrame,
    order_key: str,
    kind: str,
    known_kinds: tuple[str, ...],
    amount: Column,
    instalments: Column | None = None,
) -> DataFrame:
    """Payments, amount and the methods used per order.

    The methods come from a closed list, one flag each, so the state of a group has a
    fixed size however many payments it holds.  Other methods are counted apart.
    """
    flags = [F.bool_or(F.col(kind) == k).alias(f"__{i}") for i, k in enumerate(known_kinds)]
    extra = [F.max(instalments).alias("max_instalments")] if instalments is not None else []
    grouped = payments.groupBy(order_key).agg(
        F.count(F.lit(1)).alias("n_payments"),
        money_sum(amount).alias("total"),
        F.count_if(~F.col(kind).isin(*known_kinds)).alias("n_other_methods"),
        *extra,
        *flags,
    )
    names = [F.when(F.col(f"__{i}"), F.lit(k)) for i, k in enumerate(known_kinds)]
    return grouped.withColumn("methods", F.concat_ws("+", *names)).drop(
        *[f"__{i}" for i in range(len(known_kinds))]
    )


def days_late(delivered: Column, estimated: Column) -> Column:
    """Whole days from the estimate to the delivery; null while undelivered."""
    return F.datediff(delivered, estimated)


def order_stage(approved: Column, posted: Column, delivered: Column) -> Column:
    """How far an order got, told by which dates are still null."""
    return (
        F.when(delivered.isNotNull(), "delivered")
        .when(posted.isNotNull(), "posted")
        .when(approved.isNotNull(), "approved")
        .otherwise("not_approved")
    )


def customer_value(orders: DataFrame, person: str, order_key: str, totals: DataFrame, total: str) -> DataFrame:
    """Orders, lifetime value and repeat flag per person; orders without items add zero."""
    valued = attach(orders.select(person, order_key), totals.select(F.col(order_key).alias("__key"), total), order_key, "__key")
    return valued.groupBy(person).agg(
        F.count(F.lit(1)).alias("n_orders"),
        money_sum(F.col(total), MONEY).alias("lifetime_value"),
        (F.count(F.lit(1)) > 1).alias("is_repeat"),
    )


def sales_by(items: DataFrame, key: str, **amounts: Column) -> DataFrame:
    """Items sold and money per product, seller or any other key."""
    return order_totals(items, key, **amounts)


def best_sellers(sales: DataFrame, key: str, amount: str, k: int = 10) -> DataFrame:
    """The k best, each task keeping k rows; ties fall to the key."""
    return sales.orderBy(F.col(amount).desc(), F.col(key)).limit(k)


def translate(df: DataFrame, code: str, names: DataFrame, name_key: str, name: str, translated: str) -> DataFrame:
    """Add the translated name; a code without a translation keeps itself."""
    joined = attach(df, names.select(name_key, F.col(name).alias("__name")), code, name_key)
    return joined.withColumn(translated, F.coalesce("__name", F.col(code).cast("string"))).drop("__name")


def complete_listings(df: DataFrame, fill: dict[str, object], how: str = "flag") -> DataFrame:
    """Treat rows with empty listing fields: ``flag`` keeps, ``fill`` imputes, ``drop`` excludes."""
    flagged = df.withColumn("missing_fields", null_pattern(list(fill)))
    flagged = flagged.withColumn("is_complete", F.col("missing_fields") == "")
    if how == "drop":
        return flagged.where("is_complete")
    if how == "fill":
        return flagged.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})
    return flagged


def calendar(df: DataFrame, moment: str) -> DataFrame:
    """One row per day between the first and the last date of a column."""
    span = df.agg(F.min(moment).cast("date").alias("first"), F.max(moment).cast("date").alias("last"))
    day = F.col("date")
    return (
        span.where("first is not null")
        .select(F.explode(F.sequence("first", "last")).alias("date"))
        .select(
            "date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.weekday(day).alias("weekday"),
            (F.weekday(day) >= 5).alias("is_weekend"),
        )
    )
