"""Turn text into typed tables: check everything, then publish everything or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.text import NULL_TOKENS, name, typed
from quayside.plans import intake, publish, validation
from quayside.session import new_run_folder, working_folder
from quayside.sources import files
from quayside.spec import TableSpec


class BrokenRecords(Exception):
    pass


def typed_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The declared columns, in declared order, with their real types."""
    return df.selectExpr(*[f"{typed(c, name(c.name))} AS {name(c.name)}" for c in spec.columns])


def read_text_tables(
    spark: SparkSession,
    source: str,
    specs: tuple[TableSpec, ...],
    na_tokens: tuple[str, ...] = NULL_TOKENS,
    on_reject: str = intake.STOP,
    rejects_path: str | None = None,
    named: bool = True,
) -> dict[str, DataFrame]:
    """The CSV files, bound by name or by position.  Any missing file stops the run.

    The text is parsed once into columnar files in the shared folder and read from there.
    Records that do not fit stop the run, by file, or with ``divert`` are written to
    ``rejects_path``.
    """
    lost = [r.file_name for r in files.missing_files(spark, source, [s.file_name for s in specs]).collect()]
    if lost:
        raise FileNotFoundError(f"not in {source}: {', '.join(sorted(lost))}")
    paths = {s.name: f"{source}/{s.file_name}" for s in specs}
    taken = intake.take_in(spark, paths, specs, new_run_folder(spark, "text"), "text", named, na_tokens)
    if taken.rejects is not None:
        if on_reject == intake.STOP:
            raise BrokenRecords(intake.describe(taken.rejects))
        taken.rejects.write.mode("overwrite").parquet(rejects_path)
    return {name: spark.read.parquet(w.path) for name, w in taken.written.items()}


def stage(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    specs: tuple[TableSpec, ...],
    root: str,
    run_id: str,
    check_only: bool = False,
    compare_rows: bool = False,
) -> DataFrame:
    """Validate all tables; publish their typed form only when no check failed.

    Returns the report.  It is also written beside the data, whether the run passed
    or not.  A failed gate raises ``ValidationFailed`` and leaves the pointer alone.
    """
    report = validation.validate_all(spark, tables, specs, run_id, compare_rows)
    report.coalesce(1).write.mode("overwrite").parquet(f"{root}/reports/run_id={run_id}")
    validation.require_clean(report)
    if not check_only:
        publish.publish(spark, {s.name: typed_table(tables[s.name], s) for s in specs}, root, run_id)
    return report


def stage_files(
    spark: SparkSession,
    source: str,
    specs: tuple[TableSpec, ...],
    root: str,
    run_id: str,
    check_only: bool = False,
    compare_rows: bool = False,
    on_reject: str = intake.STOP,
) -> DataFrame:
    """Read, check and publish the CSV files; leaves nothing in the shared folder.

    Returns the report as it is stored beside the data.  Diverted records go to
    ``rejects/run_id=<run_id>`` under the root.
    """
    with working_folder(spark):
        rejects_path = f"{root}/rejects/run_id={run_id}"
        tables = read_text_tables(spark, source, specs, on_reject=on_reject, rejects_path=rejects_path)
        stage(spark, tables, specs, root, run_id, check_only, compare_rows)
    return spark.read.parquet(f"{root}/reports/run_id={run_id}")
