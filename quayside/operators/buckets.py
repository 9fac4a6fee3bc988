"""Tables stored in hash buckets of a column, and read so that Spark knows it.

A join or grouping by that column then needs no exchange of the stored rows, however many
there are.  A table consists of parts, each in a folder ``part=<name>`` of its own; a bucket
of the table is that bucket of all parts.  The files are plain Parquet in a folder of the
caller's; the session's catalog names them only while a table is written or resolved.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import literal
from quayside.functions.text import name as quoted

# Off, the parts are found in the folder and not in a catalog.
LISTED = "spark.sql.hive.manageFilesourcePartitions"


@contextmanager
def _named(spark: SparkSession):
    table = f"quayside_{uuid.uuid4().hex}"
    try:
        yield table
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay: their place was given


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_part(df: DataFrame, root: str, part: str, column: str, buckets: int, dealt: bool = False) -> None:
    """One file per bucket, sorted by the column.  Rows are ``dealt`` if they come from a grouping by bucket."""
    rows = df if dealt else df.repartition(buckets, quoted(column))
    with _named(df.sparkSession) as table:
        writer = rows.write.format("parquet").mode("errorifexists").option("path", f"{root}/part={part}")
        writer.bucketBy(buckets, column).sortBy(column).saveAsTable(table)


def read_parts(spark: SparkSession, root: str, parts: list[str], schema: str, column: str, buckets: int) -> DataFrame:
    """The rows of the named parts, without a column for the part."""
    with _named(spark) as table:
        with _setting(spark, LISTED, "false"):
            spark.sql(
                f"CREATE TABLE {table} ({schema}, part STRING) USING parquet PARTITIONED BY (part) "
                f"CLUSTERED BY ({quoted(column)}) INTO {buckets} BUCKETS LOCATION {literal(root)}"
            )
        return spark.table(table).where(F.col("part").isin(parts)).drop("part")
