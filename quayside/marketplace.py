"""The marketplace model: nine tables, five of them staged with constraints."""

from __future__ import annotations

from quayside.spec import Column, ForeignKey, RowRule, TableSpec

# --- Fixed values: domains and row counts of the public dataset, and, in
# --- the functions below, its column names, widths and types.  They must match the
# --- source files and the staged tables for results to be right.

ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)

PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

EXPECTED_ROWS = {
    "customers": 99_441,
    "orders": 99_441,
    "order_items": 112_650,
    "order_payments": 103_886,
    "order_reviews": 99_224,
    "products": 32_951,
    "sellers": 3_095,
    "product_category_translation": 71,
    "geolocation": 1_000_163,
}


def _identifier(name: str) -> Column:
    return Column(name, required=True, width=32)


def _moment(name: str, required: bool = False) -> Column:
    return Column(name, "timestamp_ntz", required=required)


def _money(name: str) -> Column:
    return Column(name, "decimal(10,2)", required=True, minimum=0)


def _place(owner: str) -> tuple[Column, ...]:
    return (
        Column(f"{owner}_zip_code_prefix", required=True, width=5),
        Column(f"{owner}_city", required=True, max_width=64),
        Column(f"{owner}_state", required=True, width=2),
    )


def marketplace_specs(
    prefix: str | None = None, file_names: dict[str, str] | None = None
) -> tuple[TableSpec, ...]:
    """Specifications of all nine tables.

    ``prefix`` is the first word of the published file names
    (``<prefix>_customers_dataset.csv``); without it files are ``<table>.csv``.
    ``file_names`` names the files of tables that follow neither form.
    """

    def file_of(table: str) -> str:
        usual = f"{table}.csv" if prefix is None else f"{prefix}_{table}_dataset.csv"
        return (file_names or {}).get(table, usual)

    def table(name: str, columns, **options) -> TableSpec:
        return TableSpec(
            name,
            tuple(columns),
            file_name=file_of(name),
            expected_rows=EXPECTED_ROWS[name],
            **options,
        )

    order_ref = ForeignKey("order_id", "orders", "order_id")
    return (
        table(
            "customers",
            (_identifier("customer_id"), _identifier("customer_unique_id"), *_place("customer")),
            key=("customer_id",),
            foreign_keys=(
                ForeignKey(
                    "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix", weak=True
                ),
            ),
        ),
        table(
            "sellers",
            (_identifier("seller_id"), *_place("seller")),
            key=("seller_id",),
            foreign_keys=(
                ForeignKey(
                    "seller_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix", weak=True
                ),
            ),
        ),
        table(
            "products",
            (
                _identifier("product_id"),
                Column("product_category_name", max_width=64),
                Column("product_name_lenght", "int"),
                Column("product_description_lenght", "int"),
                Column("product_photos_qty", "int"),
                Column("product_weight_g", "int", minimum=0),
                Column("product_length_cm", "int", minimum=0),
                Column("product_height_cm", "int", minimum=0),
                Column("product_width_cm", "int", minimum=0),
            ),
            key=("product_id",),
            foreign_keys=(
                ForeignKey(
                    "product_category_name",
                    "product_category_translation",
                    "product_category_name",
                    weak=True,
                ),
            ),
        ),
        table(
            "orders",
            (
                _identifier("order_id"),
                _identifier("customer_id"),
                Column("order_status", required=True, max_width=16, allowed=ORDER_STATUSES),
                _moment("order_purchase_timestamp", required=True),
                _moment("order_approved_at"),
                _moment("order_delivered_carrier_date"),
                _moment("order_delivered_customer_date"),
                _moment("order_estimated_delivery_date", required=True),
            ),
            key=("order_id",),
            foreign_keys=(ForeignKey("customer_id", "customers", "customer_id"),),
            row_rules=(
                RowRule(
                    "delivered_after_purchase",
                    ("order_delivered_customer_date", "order_purchase_timestamp"),
                    "{order_delivered_customer_date} >= {order_purchase_timestamp}",
                ),
            ),
        ),
        table(
            "order_items",
            (
                _identifier("order_id"),
                Column("order_item_id", "smallint", required=True, minimum=1),
                _identifier("product_id"),
                _identifier("seller_id"),
                _moment("shipping_limit_date", required=True),
                _money("price"),
                _money("freight_value"),
            ),
            key=("order_id", "order_item_id"),
            foreign_keys=(
                order_ref,
                ForeignKey("product_id", "products", "product_id"),
                ForeignKey("seller_id", "sellers", "seller_id"),
            ),
        ),
        table(
            "order_payments",
            (
                _identifier("order_id"),
                Column("payment_sequential", "smallint", required=True),
                Column("payment_type", allowed=PAYMENT_TYPES),
                Column("payment_installments", "smallint"),
                Column("payment_value", "decimal(10,2)"),
            ),
            key=("order_id", "payment_sequential"),
            foreign_keys=(order_ref,),
            staged=False,
        ),
        table(
            "order_reviews",
            (
                _identifier("review_id"),
                _identifier("order_id"),
                Column("review_score", "smallint"),
                Column("review_comment_title"),
                Column("review_comment_message"),
                _moment("review_creation_date"),
                _moment("review_answer_timestamp"),
            ),
            foreign_keys=(order_ref,),
            multiline=True,
            staged=False,
        ),
        table(
            "product_category_translation",
            (Column("product_category_name"), Column("product_category_name_english")),
            key=("product_category_name",),
            staged=False,
            lookup=True,
        ),
        table(
            "geolocation",
            (
                Column("geolocation_zip_code_prefix", width=5),
                Column("geolocation_lat", "double"),
                Column("geolocation_lng", "double"),
                Column("geolocation_city"),
                Column("geolocation_state"),
            ),
            staged=False,
        ),
    )
