"""Column profiles, null patterns and relationship cardinalities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import text as tx
from quayside.operators import keys
from quayside.spec import TableSpec

COLUMNS_PER_SCAN = 3
SKETCH_BITS = 12


def profile_columns(df: DataFrame, table: str, approximate: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, key flag, lengths, likely type.

    Exact: each column is counted once per distinct value, combined inside each map
    task, so a value that fills a third of a column is one record per task.  A column
    is scanned and shuffled alone and in its own type; together the columns are read
    once.  Types and lengths are judged on distinct values only.
    Approximate: a single pass with sketches and no shuffle of values, for tables
    whose distinct values are too many to move.
    """
    if approximate:
        return _profile_by_sketch(df, table)
    parts = []
    for c in df.columns:
        counted = df.groupBy(F.col(tx.name(c)).alias("raw")).agg(F.count(F.lit(1)).alias("n"))
        judged = counted.selectExpr(
            "n", "cast(raw AS string) AS value", f"{tx.likely_kind('cast(raw AS string)')} AS kind"
        )
        parts.append(
            judged.selectExpr(
                "coalesce(sum(n), 0) AS n_rows",
                "coalesce(sum(CASE WHEN value IS NULL THEN n END), 0) AS n_nulls",
                "count(value) AS n_distinct",
                *_measures("value", "kind"),
            ).selectExpr(f"{tx.literal(c)} AS column_name", "*")
        )
    return _finish_profile(reduce(DataFrame.unionByName, parts), table, "n_rows > 0 AND n_nulls = 0 AND n_distinct = n_rows")


def _measures(value: str, kind: str) -> list[str]:
    return [
        f"min(length({value})) AS min_length",
        f"max(length({value})) AS max_length",
        f"min({kind}) AS min_kind",
        f"max({kind}) AS max_kind",
        f"min({value}) AS example",
    ]


def _finish_profile(summary: DataFrame, table: str, is_key: str) -> DataFrame:
    return summary.selectExpr(
        f"{tx.literal(table)} AS table_name",
        "column_name",
        "cast(n_rows AS bigint) AS n_rows",
        "cast(n_nulls AS bigint) AS n_nulls",
        "round(100.0D * cast(n_nulls AS double) / nullif(cast(n_rows AS double), 0D), 2) AS null_percent",
        "cast(n_distinct AS bigint) AS n_distinct",
        f"cast(({is_key}) AS boolean) AS is_key",
        "min_length",
        "max_length",
        "CASE WHEN max_kind = 0 THEN 'int' WHEN max_kind = 1 THEN 'decimal' "
        "WHEN min_kind = 2 AND max_kind = 2 THEN 'timestamp' ELSE 'string' END AS likely_type",
        "example",
    )


def _profile_by_sketch(df: DataFrame, table: str) -> DataFrame:
    """Distinct values are estimated in the column's own type, and an estimate cannot tell
    a key, so ``is_key`` is null.
    """
    return _finish_profile(_one_pass(df, "approx_count_distinct({raw}) AS n_distinct"), table, "NULL")


def sketch_columns(df: DataFrame) -> DataFrame:
    """What a profile needs of each column, in a form that can be merged: one row per column.

    ``sketch`` is a HyperLogLog sketch of the column's texts (standard error about 1.6 %),
    a few kilobytes however many rows there are.  Written beside the data of a version, it
    spares reading the data again.
    """
    return _one_pass(df, f"hll_sketch_agg(cast({{raw}} AS string), {SKETCH_BITS}) AS sketch")


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketches of all rows from those of parts, such as files or versions.

    A part without a column has nothing to say of it, so its rows are missing there; the
    profile of such a column counts the rows of the parts that have it.
    """
    whole = reduce(DataFrame.unionByName, sketches)
    return whole.groupBy("column_name").agg(
        F.expr("sum(n_rows)").alias("n_rows"),
        F.expr("sum(n_nulls)").alias("n_nulls"),
        F.hll_union_agg("sketch").alias("sketch"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.min("min_kind").alias("min_kind"),
        F.max("max_kind").alias("max_kind"),
        F.min("example").alias("example"),
    )


def profile_of_sketches(sketches: DataFrame, table: str) -> DataFrame:
    """The approximate profile, from sketches alone; distinct values are those of the texts."""
    estimated = sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch"))
    return _finish_profile(estimated, table, "NULL")


def _one_pass(df: DataFrame, distinct: str) -> DataFrame:
    """A few columns per aggregation, as in the checks: short code, each column read once.

    ``distinct`` is SQL for what is kept of the distinct values of the column ``{raw}``.  The
    type is judged from the column's own where that says enough, and for texts only if their
    first character allows a number or a date.
    """
    parts = []
    for start in range(0, len(df.columns), COLUMNS_PER_SCAN):
        columns = df.columns[start : start + COLUMNS_PER_SCAN]
        own = df.select(*[F.col(tx.name(c)) for c in columns])
        judged = own.selectExpr(
            *[f"{tx.name(c)} AS {tx.name('__raw_' + c)}" for c in columns],
            *[f"cast({tx.name(c)} AS string) AS {tx.name(c)}" for c in columns],
            *[f"{_kind(own, c)} AS {tx.name('__kind_' + c)}" for c in columns],
        )
        aggregates = ["count(1) AS n_rows"]
        for i, c in enumerate(columns):
            measures = [
                f"count_if({tx.name(c)} IS NULL) AS n_nulls",
                distinct.format(raw=tx.name("__raw_" + c)),
                *_measures(tx.name(c), tx.name("__kind_" + c)),
            ]
            named = [m.rsplit(" AS ", 1) for m in measures]
            fields = ", ".join(f"'{label}', {measure}" for measure, label in named)
            aggregates.append(f"named_struct('column_name', {tx.literal(c)}, {fields}) AS c{i}")
        structs = ", ".join(f"c{i}" for i in range(len(columns)))
        parts.append(judged.selectExpr(*aggregates).selectExpr("n_rows", f"inline(array({structs}))"))
    return reduce(DataFrame.unionByName, parts)


def _kind(df: DataFrame, column: str) -> str:
    """``likely_kind`` of a column's text, from its type where that is enough."""
    text, kind = tx.name(column), df.schema[column].dataType
    if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType) or isinstance(kind, T.DecimalType) and kind.scale:
        return f"CASE WHEN {text} IS NOT NULL THEN {int(isinstance(kind, T.DecimalType))} END"
    if isinstance(kind, T.FloatType | T.DoubleType):
        finite = f"abs({text}) < double('infinity')"
        return f"CASE WHEN {text} IS NULL THEN NULL WHEN {finite} THEN 1 ELSE 3 END"
    text = f"cast({text} AS string)"
    # Numbers and dates begin with a space, a sign, a point or a digit.
    return f"CASE WHEN ascii({text}) BETWEEN 58 AND 127 THEN 3 ELSE {tx.likely_kind(text)} END"


def null_patterns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How many rows have which columns null together."""
    return df.groupBy(keys.null_pattern(columns or df.columns).alias("null_columns")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def relationship_cardinality(tables: dict[str, DataFrame], specs: tuple[TableSpec, ...]) -> DataFrame:
    """Every declared edge: parents, parents without children, most children of one parent."""
    parts = []
    for spec in specs:
        for fk in spec.foreign_keys:
            if spec.name not in tables or fk.parent not in tables:
                continue
            summary = keys.reference_cardinality(
                tables[spec.name], fk.column, tables[fk.parent], fk.parent_column
            )
            parts.append(
                summary.select(
                    F.lit(f"{spec.name}.{fk.column}->{fk.parent}.{fk.parent_column}").alias("edge"),
                    "n_parents",
                    "childless_parents",
                    F.col("max_children").cast("bigint").alias("max_children"),
                )
            )
    return reduce(DataFrame.unionByName, parts)
