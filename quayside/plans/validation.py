"""Check every table, then say what is wrong, how often, and show examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import checks
from quayside.spec import TableSpec, by_name, load_order

REPORT_SCHEMA = (
    "run_id string, table_name string, rule string, columns string, severity string, "
    "n_rows bigint, n_violations bigint, examples array<string>"
)


class ValidationFailed(Exception):
    """Raised by the publish gate; carries the report."""

    def __init__(self, report: DataFrame, problems: list[str]):
        super().__init__(f"{len(problems)} problem(s), nothing was written:\n" + "\n".join(problems))
        self.report = report
        self.problems = problems


def check_counts(
    tables: dict[str, DataFrame], specs: tuple[TableSpec, ...], compare_rows: bool = False
) -> DataFrame:
    """One row per declared check of every given table, zeros included.  Lazy."""
    known = by_name(specs)
    parts = [
        checks.count_all_checks(tables[name], known[name], tables, compare_rows)
        for name in load_order(specs)
        if name in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def validate_all(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    specs: tuple[TableSpec, ...],
    run_id: str = "",
    compare_rows: bool = False,
    examples: int = 3,
) -> DataFrame:
    """The full report.  Only its rows, one per check, come to the driver.

    The data is read again for examples, and then only for the checks that failed.
    """
    counted = check_counts(tables, specs, compare_rows).collect()
    failing: dict[str, set[tuple[str, str]]] = {}
    for row in counted:
        if row.n_violations:
            failing.setdefault(row.table_name, set()).add((row.rule, row.columns))
    known = by_name(specs)
    found = [
        checks.violations(tables[name], known[name], tables, pairs)
        for name, pairs in failing.items()
    ]
    found = [f for f in found if f is not None]
    shown: dict[tuple[str, str, str], list[str]] = {}
    if found and examples:
        hits = checks.violation_examples(reduce(DataFrame.unionByName, found), examples)
        for hit in hits.orderBy("table_name", "rule", "columns", "example_no").collect():
            shown.setdefault((hit.table_name, hit.rule, hit.columns), []).append(hit.value)
    rows = [
        (
            run_id, r.table_name, r.rule, r.columns, r.severity, r.n_rows, r.n_violations,
            shown.get((r.table_name, r.rule, r.columns), []),
        )
        for r in counted
    ]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def problems_of(report: DataFrame) -> DataFrame:
    return report.where("severity = 'error' and n_violations > 0")


def problem_totals(report: DataFrame) -> DataFrame:
    """Per table: rows, checks that failed, and violations altogether."""
    bad = (F.col("severity") == "error") & (F.col("n_violations") > 0)
    return report.groupBy("table_name").agg(
        F.max("n_rows").alias("n_rows"),
        F.count_if(bad).alias("n_problems"),
        F.coalesce(F.sum(F.when(bad, F.col("n_violations"))), F.lit(0)).alias("n_violations"),
    )


def problem_lines(report: DataFrame) -> list[str]:
    """The problems as text, one line per failed check."""
    found = problems_of(report).orderBy("table_name", "rule", "columns").collect()
    return [
        f"{r.table_name}: {r.rule} ({r.columns}): {r.n_violations:,} of {r.n_rows:,} rows"
        + (f", such as {', '.join(r.examples)}" if r.examples else "")
        for r in found
    ]


def require_clean(report: DataFrame) -> None:
    lines = problem_lines(report)
    if lines:
        raise ValidationFailed(report, lines)
