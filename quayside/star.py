"""Specifications of the retail star schema the registered queries run on, and seeded dirt.

The tables arrive typed and clean, so queries that look for violations first turn
them to text and then spoil some values.  Every row is read; the dirt is plain SQL
over the row itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import as_text
from quayside.spec import Column, ForeignKey, TableSpec

DIRT = {
    "customer": {
        "c_name": "CASE WHEN c_custkey % 50 = 0 THEN c_name || 'x' ELSE c_name END",
        "c_acctbal": "CASE WHEN c_custkey % 89 = 0 THEN 'abc' ELSE CAST(c_acctbal AS STRING) END",
    },
    "part": {
        "p_brand": "CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE p_brand END",
        "p_type": "CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE p_type END",
        "p_size": (
            "CASE WHEN p_partkey % 54 = 0 THEN NULL WHEN p_partkey % 101 = 0 THEN 'x' "
            "ELSE CAST(p_size AS STRING) END"
        ),
        "p_retailprice": "CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE p_retailprice END",
    },
    "orders": {
        "o_orderdate": (
            "CASE WHEN o_orderkey % 211 = 0 THEN '1998/10/03' ELSE CAST(o_orderdate AS STRING) END"
        ),
    },
    "lineitem": {
        "l_orderkey": (
            "CASE WHEN l_linenumber = 7 THEN -1 WHEN l_suppkey % 33 = 0 THEN NULL ELSE l_orderkey END"
        ),
        "l_partkey": (
            "CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_partkey % 71 = 0 THEN -1 ELSE l_partkey END"
        ),
        "l_suppkey": "CASE WHEN l_suppkey % 71 = 0 THEN -1 ELSE l_suppkey END",
    },
}

# Sizes the tables are expected to have at scale factor 0.01.
EXPECTED_ROWS = {
    "region": 5, "nation": 25, "customer": 1_500, "supplier": 100,
    "part": 2_000, "orders": 15_000, "lineitem": 60_000,
}

TABLES = tuple(EXPECTED_ROWS)


def load(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


def spoiled(df: DataFrame, table: str) -> DataFrame:
    """Typed columns as they are, spoiled ones by their SQL."""
    dirt = DIRT.get(table, {})
    return df.select(*[F.expr(dirt[c]).alias(c) if c in dirt else F.col(c) for c in df.columns])


def text_table(spark: SparkSession, directory: str, table: str, dirty: bool = False) -> DataFrame:
    df = load(spark, directory, table)
    return as_text(spoiled(df, table) if dirty else df)


def text_tables(spark: SparkSession, directory: str, dirty: bool = False) -> dict[str, DataFrame]:
    return {t: text_table(spark, directory, t, dirty) for t in TABLES}


def star_specs(strict: bool = True) -> tuple[TableSpec, ...]:
    """All seven tables.

    The given data has repeated line numbers and negative balances.  ``strict`` calls
    both violations; otherwise they are allowed, so that the data can be staged.
    """
    balance_floor = 0 if strict else None

    def table(name, columns, **options):
        return TableSpec(
            name, tuple(columns), file_name=f"{name}.csv", expected_rows=EXPECTED_ROWS[name], **options
        )

    def number(name, kind, required=True, minimum=None):
        return Column(name, kind, required=required, minimum=minimum)

    def money(name, required=True, minimum=0):
        return Column(name, "decimal(10,2)", required=required, minimum=minimum)

    return (
        table(
            "region",
            (number("r_regionkey", "int"), Column("r_name", required=True)),
            key=("r_regionkey",),
        ),
        table(
            "nation",
            (number("n_nationkey", "int"), Column("n_name", required=True), number("n_regionkey", "int")),
            key=("n_nationkey",),
            foreign_keys=(ForeignKey("n_regionkey", "region", "r_regionkey"),),
        ),
        table(
            "customer",
            (
                number("c_custkey", "bigint"),
                Column("c_name", required=True, width=18),
                number("c_nationkey", "int"),
                money("c_acctbal", minimum=balance_floor),
                Column("c_mktsegment", max_width=10),
            ),
            key=("c_custkey",),
            foreign_keys=(ForeignKey("c_nationkey", "nation", "n_nationkey"),),
        ),
        table(
            "supplier",
            (
                number("s_suppkey", "bigint"),
                Column("s_name", required=True, width=18),
                number("s_nationkey", "int"),
                money("s_acctbal", minimum=balance_floor),
            ),
            key=("s_suppkey",),
            foreign_keys=(ForeignKey("s_nationkey", "nation", "n_nationkey"),),
        ),
        table(
            "part",
            (
                number("p_partkey", "bigint"),
                Column("p_name", max_width=64),
                Column("p_brand"),
                Column("p_type"),
                number("p_size", "int", required=False, minimum=1),
                money("p_retailprice", required=False),
            ),
            key=("p_partkey",),
        ),
        table(
            "orders",
            (
                number("o_orderkey", "bigint"),
                number("o_custkey", "bigint"),
                Column("o_orderstatus", required=True, max_width=16, allowed=("F", "O", "P")),
                money("o_totalprice"),
                Column("o_orderdate", "timestamp_ntz", required=True),
                Column("o_orderpriority"),
            ),
            key=("o_orderkey",),
            foreign_keys=(ForeignKey("o_custkey", "customer", "c_custkey"),),
        ),
        table(
            "lineitem",
            (
                number("l_orderkey", "bigint"),
                number("l_partkey", "bigint"),
                number("l_suppkey", "bigint"),
                number("l_linenumber", "smallint", minimum=1),
                money("l_quantity"),
                money("l_extendedprice"),
                money("l_discount", required=False),
                money("l_tax", required=False),
                Column("l_returnflag", allowed=("A", "N", "R")),
                Column("l_linestatus", allowed=("F", "O")),
                Column("l_shipdate", "timestamp_ntz", required=True),
            ),
            key=("l_orderkey", "l_linenumber") if strict else (),
            foreign_keys=(
                ForeignKey("l_orderkey", "orders", "o_orderkey"),
                ForeignKey("l_partkey", "part", "p_partkey"),
                ForeignKey("l_suppkey", "supplier", "s_suppkey"),
            ),
        ),
    )
