"""Land CSV files as all-text tables with lineage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import moment
from quayside.plans import intake, publish
from quayside.session import working_folder
from quayside.sources import files
from quayside.spec import TableSpec, by_name

REPORT_SCHEMA = (
    "run_id string, table_name string, file_name string, status string, "
    "n_rows bigint, expected_rows bigint, matches_expected boolean, n_rejected bigint"
)


class LandingFailed(Exception):
    pass


def with_lineage(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Append the bare source file name and the load time, one for the whole run."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_source_file"),
        F.expr(moment(run_ts)).alias("_ingested_at"),
    )


def land_raw(
    spark: SparkSession,
    specs: tuple[TableSpec, ...],
    source: str,
    root: str,
    run_id: str,
    run_ts: datetime,
    compare_rows: bool = False,
    on_reject: str = intake.STOP,
) -> DataFrame:
    """Land every file that is there; returns one report row per table.

    A missing file is skipped and its table keeps the rows of the last landing.  Records
    that do not fit stop the run before anything is switched, or with ``divert`` go to
    ``rejects/run_id=<run_id>`` under the root, with file, offset, reason and bytes.
    Counting, checking and writing share one pass over each file.
    """
    lost = {r.file_name for r in files.missing_files(spark, source, [s.file_name for s in specs]).collect()}
    sources = {s.name: f"{source}/{s.file_name}" for s in specs if s.file_name not in lost}
    lineage = {"_source_file": F.col(intake.FILE), "_ingested_at": F.expr(moment(run_ts))}
    with working_folder(spark):
        taken = intake.take_in(spark, sources, specs, root, run_id, lineage=lineage)
        if taken.rejects is not None and on_reject == intake.STOP:
            publish.drop_version(spark, root, run_id)
            raise LandingFailed(intake.describe(taken.rejects))
        if taken.rejects is not None:
            taken.rejects.write.mode("overwrite").parquet(f"{root}/rejects/run_id={run_id}")
    publish.switch_pointer(spark, root, run_id, taken.written, keep_others=True)
    rows = []
    for s in specs:
        n = taken.written[s.name].rows if s.name in taken.written else None
        expected = s.expected_rows if compare_rows else None
        rows.append(
            (
                run_id, s.name, s.file_name, "skipped" if n is None else "landed", n, expected,
                None if n is None or expected is None else n == expected, taken.rejected.get(s.name),
            )
        )
    return spark.createDataFrame(rows, REPORT_SCHEMA)
