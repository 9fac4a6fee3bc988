"""Facts and dimensions of the marketplace, from its landed or staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import number_or_null, timestamp_or_null
from quayside.marketplace import PAYMENT_TYPES
from quayside.operators import business
from quayside.operators.ranked import latest_per_key
from quayside.plans import publish

# The source misspells "length"; the mart puts it right.
RENAMED = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
LISTING_FIELDS = {
    "product_category_name": "unknown",
    "product_name_lenght": 0,
    "product_description_lenght": 0,
    "product_photos_qty": 0,
}


def area_centroids(geolocation: DataFrame) -> DataFrame:
    return business.centroids(
        geolocation,
        "geolocation_zip_code_prefix",
        F.expr(number_or_null("cast(geolocation_lat AS string)")),
        F.expr(number_or_null("cast(geolocation_lng AS string)")),
    )


def _located(df: DataFrame, zip_column: str, areas: DataFrame) -> DataFrame:
    return business.attach(df, areas.select("geolocation_zip_code_prefix", "lat", "lng"), zip_column, "geolocation_zip_code_prefix")


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """One row per review id: the one answered last."""
    answered = F.expr(timestamp_or_null("cast(review_answer_timestamp AS string)"))
    return latest_per_key(reviews, ["review_id"], [answered.desc_nulls_last()])


def dim_customer(customers: DataFrame, orders: DataFrame, items: DataFrame, areas: DataFrame) -> DataFrame:
    """One row per person, with repeat flag, lifetime value and where the last order came from."""
    totals = business.order_totals(items, "order_id", total=F.col("price") + F.col("freight_value"))
    placed = orders.select("order_id", "customer_id", "order_purchase_timestamp").join(customers, "customer_id")
    value = business.customer_value(placed, "customer_unique_id", "order_id", totals, "total")
    home = latest_per_key(
        placed.select(
            "customer_unique_id",
            "order_purchase_timestamp",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ),
        ["customer_unique_id"],
        [F.col("order_purchase_timestamp").desc()],
    ).drop("order_purchase_timestamp")
    return _located(value.join(home, "customer_unique_id"), "customer_zip_code_prefix", areas)


def dim_product(products: DataFrame, translation: DataFrame, listings: str = "flag") -> DataFrame:
    named = business.translate(
        products,
        "product_category_name",
        translation,
        "product_category_name",
        "product_category_name_english",
        "category",
    )
    return business.complete_listings(named, LISTING_FIELDS, listings).withColumnsRenamed(RENAMED)


def dim_seller(sellers: DataFrame, areas: DataFrame) -> DataFrame:
    return _located(sellers, "seller_zip_code_prefix", areas)


def dim_date(orders: DataFrame) -> DataFrame:
    return business.calendar(orders, "order_purchase_timestamp")


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order: stage, delay, totals, payments and latest review score.

    Every one-to-many side is reduced to one row per order first; orders without
    items, payments or reviews stay.  ``reviews`` are all reviews as landed: one review
    may belong to several orders, and each of them has its score.
    """
    totals = business.order_totals(items, "order_id", total=F.col("price") + F.col("freight_value"))
    paid = business.payments_per_order(
        payments,
        "order_id",
        "payment_type",
        PAYMENT_TYPES,
        F.expr(number_or_null("cast(payment_value AS string)", "decimal(10,2)")),
        F.expr(number_or_null("cast(payment_installments AS string)", "int")),
    ).withColumnRenamed("total", "paid")
    answered = F.expr(timestamp_or_null("cast(review_answer_timestamp AS string)"))
    score = latest_per_key(
        reviews.select("order_id", "review_score", "review_answer_timestamp"),
        ["order_id"],
        [answered.desc_nulls_last()],
    ).drop("review_answer_timestamp")
    out = orders.withColumns(
        {
            "stage": business.order_stage(
                F.col("order_approved_at"),
                F.col("order_delivered_carrier_date"),
                F.col("order_delivered_customer_date"),
            ),
            "days_late": business.days_late(
                F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
            ),
        }
    )
    for side in (totals, paid, score):
        out = out.join(side, "order_id", "left")
    return out


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per item with the order's customer, day, stage and status."""
    heads = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").cast("date").alias("order_date"),
        business.order_stage(
            F.col("order_approved_at"),
            F.col("order_delivered_carrier_date"),
            F.col("order_delivered_customer_date"),
        ).alias("stage"),
    )
    return items.join(heads, "order_id", "left")


def build_mart(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All facts and dimensions.  Staged tables are typed; the other four come as landed."""
    areas = area_centroids(tables["geolocation"])
    return {
        "fact_order_items": fact_order_items(tables["order_items"], tables["orders"]),
        "fact_orders": fact_orders(
            tables["orders"], tables["order_items"], tables["order_payments"], tables["order_reviews"]
        ),
        "dim_review": latest_reviews(tables["order_reviews"]),
        "dim_customer": dim_customer(tables["customers"], tables["orders"], tables["order_items"], areas),
        "dim_product": dim_product(tables["products"], tables["product_category_translation"]),
        "dim_seller": dim_seller(tables["sellers"], areas),
        "dim_date": dim_date(tables["orders"]),
    }


def publish_mart(spark: SparkSession, staging_root: str, raw_root: str, root: str, run_id: str) -> dict[str, int]:
    """Build the mart from published tables, typed where staged and else as landed, and publish it."""
    staged = {r.table_name for r in publish.published_tables(spark, staging_root).collect()}
    landed = {r.table_name for r in publish.published_tables(spark, raw_root).collect()} - staged
    tables = {t: publish.read_published(spark, staging_root, t) for t in staged}
    tables |= {t: publish.read_published(spark, raw_root, t) for t in landed}
    return publish.publish(spark, build_mart(tables), root, run_id)
