"""Publish a set of tables all together or not at all.

Tables are written under ``version=<run_id>``.  Readers follow one small pointer
file, and that file is replaced only after every table was written and its rows
were counted back.  A failed or killed run leaves the pointer, and so the tables
readers see, as they were.  One writer at a time.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import name
from quayside.operators import buckets
from quayside.session import remove_folder
from quayside.sources import files

POINTER = "_CURRENT"
PARALLEL_WRITES = 4
WHOLE = "whole"  # the one part of a bucketed table


class PublishFailed(Exception):
    pass


@dataclass(frozen=True)
class Bucketing:
    """Rows stored by hash of a column, so that joins and groupings by it need no exchange.

    For columns whose values are spread: all rows of one value share a bucket.
    """

    column: str
    buckets: int


@dataclass(frozen=True)
class Written:
    """Where a table went and what was counted while it was written."""

    path: str
    rows: int
    measures: dict[str, int]
    bucketing: Bucketing | None = None
    schema: str = ""


def write_counted(
    df: DataFrame,
    path: str,
    drop: tuple[str, ...] = (),
    keep: Column | None = None,
    bucketing: Bucketing | None = None,
    **measures: Column,
) -> Written:
    """Write Parquet and count in the same pass; extra measures ride along.

    Columns in ``drop`` serve the measures and are not written.  With ``keep`` only rows
    for which it holds are written and counted as rows; the measures see all.

    The counters sit directly in front of the writer, in the last stage of the job,
    where Spark counts each task's success once.
    """
    seen = Observation()
    rows = F.count(F.lit(1)) if keep is None else F.count_if(keep)
    counters = [rows.alias("rows")] + [c.alias(n) for n, c in measures.items()]
    if bucketing:
        df = df.repartition(bucketing.buckets, name(bucketing.column))
    observed = df.observe(seen, *counters)
    if keep is not None:
        observed = observed.where(keep)
    kept = observed.drop(*drop)
    if bucketing:
        remove_folder(df.sparkSession, path)
        buckets.write_part(kept, path, WHOLE, bucketing.column, bucketing.buckets, dealt=True)
    else:
        kept.write.mode("overwrite").parquet(path)
    found = {k: int(v or 0) for k, v in seen.get.items()}
    schema = ", ".join(f"{name(f.name)} {f.dataType.simpleString()}" for f in kept.schema)
    return Written(path, found.pop("rows"), found, bucketing, schema)


def read_pointer(spark: SparkSession, root: str) -> dict:
    path = f"{root}/{POINTER}"
    if not files.path_exists(spark, path):
        return {"run_id": None, "tables": {}}
    return json.loads(files.read_text_file(spark, path))


def write_version(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    run_id: str,
    drop: tuple[str, ...] = (),
    keep: Column | None = None,
    bucketing: dict[str, Bucketing] | None = None,
    **measures: Column,
) -> dict[str, Written]:
    if read_pointer(spark, root)["run_id"] == run_id:
        raise PublishFailed(f"run {run_id} is the published one; give the new run its own id")

    def write(item: tuple[str, DataFrame]) -> tuple[str, Written]:
        table, df = item
        path = f"{root}/version={run_id}/{table}"
        return table, write_counted(df, path, drop, keep, (bucketing or {}).get(table), **measures)

    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        return dict(pool.map(write, tables.items()))


def switch_pointer(
    spark: SparkSession, root: str, run_id: str, written: dict[str, Written], keep_others: bool = False
) -> None:
    """Check rows in against rows out, then make the new version the current one."""
    for table, w in written.items():
        stored = spark.read.parquet(w.path).count()
        if stored != w.rows:
            raise PublishFailed(f"{table}: {w.rows:,} rows went in, {stored:,} are stored")
    tables = dict(read_pointer(spark, root)["tables"]) if keep_others else {}
    for table, w in written.items():
        tables[table] = {"path": f"version={run_id}/{table}", "rows": w.rows}
        if w.bucketing:
            tables[table] |= {"schema": w.schema, **w.bucketing.__dict__}
    files.replace_text_file(
        spark, f"{root}/{POINTER}", json.dumps({"run_id": run_id, "tables": tables}, sort_keys=True)
    )


def drop_version(spark: SparkSession, root: str, run_id: str) -> None:
    """Remove what a failed run has written; tables that the pointer names are never touched."""
    if f"version={run_id}" not in _versions_in_use(spark, root):
        remove_folder(spark, f"{root}/version={run_id}")


def _versions_in_use(spark: SparkSession, root: str) -> set[str]:
    return {t["path"].split("/")[0] for t in read_pointer(spark, root)["tables"].values()}


def remove_superseded(spark: SparkSession, root: str) -> list[str]:
    """Remove the versions that no published table belongs to; returns their names.

    For when no reader of an older version is left and no run is under way.
    """
    found = files.names_in(spark, root)
    old = sorted(n for n in found if n.startswith("version=") and n not in _versions_in_use(spark, root))
    for name in old:
        remove_folder(spark, f"{root}/{name}")
    return old


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    run_id: str,
    keep_others: bool = False,
    bucketing: dict[str, Bucketing] | None = None,
) -> dict[str, int]:
    """Write and switch; returns rows per table."""
    try:
        written = write_version(spark, tables, root, run_id, bucketing=bucketing)
        switch_pointer(spark, root, run_id, written, keep_others)
    except Exception:
        drop_version(spark, root, run_id)
        raise
    return {name: w.rows for name, w in written.items()}


def published_tables(spark: SparkSession, root: str) -> DataFrame:
    """The published tables with path and row count."""
    tables = read_pointer(spark, root)["tables"]
    rows = [(n, t["path"], t["rows"]) for n, t in sorted(tables.items())]
    return spark.createDataFrame(rows, "table_name string, path string, n_rows bigint")


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    tables = read_pointer(spark, root)["tables"]
    if table not in tables:
        raise PublishFailed(f"{table} is not published under {root}")
    found = tables[table]
    path = f"{root}/{found['path']}"
    if "buckets" in found:
        return buckets.read_parts(spark, path, [WHOLE], found["schema"], found["column"], found["buckets"])
    return spark.read.parquet(path)


def preview(spark: SparkSession, root: str, table: str, n: int = 5) -> DataFrame:
    return read_published(spark, root, table).limit(n)
