"""File manifests: build, write, read, compare."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources import csv, files
from quayside.spec import TableSpec

ENTRY = "struct<bytes:bigint,rows:bigint,sha256:string>"


def csv_manifest(spark: SparkSession, directory: str, specs: tuple[TableSpec, ...]) -> DataFrame:
    """file_name, bytes, rows and sha256 of each table's file, or of each part of its folder."""
    lost = [r.file_name for r in files.missing_files(spark, directory, [s.file_name for s in specs]).collect()]
    if lost:
        raise FileNotFoundError(f"not in {directory}: {', '.join(sorted(lost))}")
    counts = {
        s.file_name: csv.records_per_file(spark, f"{directory}/{s.file_name}", s) for s in specs
    }
    return _manifest(spark, directory, counts)


def parquet_manifest(spark: SparkSession, directory: str, file_names: list[str]) -> DataFrame:
    """The same for Parquet files; their rows come from the file footers."""
    counts = {}
    for name in file_names:
        rows = spark.read.parquet(f"{directory}/{name}").select(F.col("_metadata.file_name").alias("file_name"))
        counts[name] = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))
    return _manifest(spark, directory, counts)


def _manifest(spark: SparkSession, directory: str, counts: dict[str, DataFrame]) -> DataFrame:
    """Hashes of all files beside their row counts; parts of a folder are named folder/part."""
    part = F.col("file_name")
    label = part
    for name in counts:
        label = F.when(F.col("path").contains(f"/{name}/"), F.concat(F.lit(f"{name}/"), part)).otherwise(label)
    hashed = files.hash_files(spark, [f"{directory}/{name}" for name in counts]).withColumn("file_name", label)
    counted = reduce(
        DataFrame.unionByName,
        [
            rows.withColumn("file_name", F.when(part == name, part).otherwise(F.concat(F.lit(f"{name}/"), part)))
            for name, rows in counts.items()
        ],
    )
    return hashed.join(counted, "file_name", "left").select(
        "file_name", "bytes", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "sha256"
    )


def write_manifest(
    manifest: DataFrame, path: str, generated_at: datetime, sample_rows: int, **header: str
) -> None:
    """JSON lines sorted by file name, one per file, with the header fields repeated.

    One line per file rather than one object for all, so the manifest of a million
    files is still written and read in parallel.
    """
    stamp = F.lit(f"{generated_at:%Y-%m-%dT%H:%M:%S}+00:00")
    constants = [F.lit(v).alias(k) for k, v in header.items()]
    (
        manifest.select(
            *constants,
            stamp.alias("generated_at"),
            F.lit(sample_rows).alias("sample_orders"),
            "file_name", "bytes", "rows", "sha256",
        )
        .orderBy("file_name")
        .write.mode("overwrite")
        .json(path)
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest written by :func:`write_manifest`."""
    schema = "file_name string, bytes bigint, rows bigint, sha256 string"
    return spark.read.schema(schema).json(path)


def read_object_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest kept as one JSON object with a ``files`` map."""
    document = spark.read.schema(f"files map<string,{ENTRY}>").option("multiLine", True).json(path)
    return document.select(F.explode("files").alias("file_name", "entry")).select("file_name", "entry.*")


def compare_manifests(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per file of either side: ok, changed, missing or unlisted, and what differs."""
    e, a = expected.alias("e"), actual.alias("a")
    fields = ("bytes", "rows", "sha256")
    differs = F.concat_ws(
        "+", *[F.when(~F.col(f"e.{f}").eqNullSafe(F.col(f"a.{f}")), F.lit(f)) for f in fields]
    )
    status = (
        F.when(F.col("a.file_name").isNull(), "missing")
        .when(F.col("e.file_name").isNull(), "unlisted")
        .when(differs != "", "changed")
        .otherwise("ok")
    )
    return e.join(a, F.col("e.file_name") == F.col("a.file_name"), "full_outer").select(
        F.coalesce("e.file_name", "a.file_name").alias("file_name"),
        status.alias("status"),
        F.when(status == "changed", differs).alias("differs"),
    )


def check_manifest(
    spark: SparkSession, manifest_path: str, directory: str, specs: tuple[TableSpec, ...], object_form: bool = False
) -> DataFrame | None:
    """Files against their manifest; ``None`` when there is no manifest, which is no failure."""
    if not files.path_exists(spark, manifest_path):
        return None
    read = read_object_manifest if object_form else read_manifest
    lost = {r.file_name for r in files.missing_files(spark, directory, [s.file_name for s in specs]).collect()}
    present = tuple(s for s in specs if s.file_name not in lost)
    expected = read(spark, manifest_path)
    if not present:
        return compare_manifests(expected, expected.limit(0))
    return compare_manifests(expected, csv_manifest(spark, directory, present))
