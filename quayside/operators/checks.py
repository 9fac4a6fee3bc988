"""Data checks derived from a table specification.

Rules that look at one row are counted together in plain aggregations: one record per
task is all that is shuffled.  Keys and references are counted per key first (see
``keys``).  Nothing here collects data; every result is a DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from quayside.functions import text as tx
from quayside.operators import keys
from quayside.operators.ranked import smallest_values
from quayside.spec import Column, ForeignKey, TableSpec

INTEGER_LIMITS = {"smallint": 2**15, "int": 2**31, "bigint": 2**63}
# Below this a double tells for certain that a whole number fits into a bigint.
SURE_BIGINT = 9.2e18
# More than this in one aggregation and the generated code is too long for the JVM to compile.
CHECKS_PER_SCAN = 12


@dataclass(frozen=True)
class Check:
    """One rule on one row, as SQL: ``broken`` is true for a violation, null or false otherwise.

    Conditions refer to the columns of the table and to those of :func:`with_facts`.
    """

    rule: str
    columns: str
    broken: str
    value: str
    severity: str = "error"
    silenced_by: str | None = None


def _fact(kind: str, column: str) -> str:
    return tx.name(f"__{kind}_{column}")


def with_facts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Append what several rules need to know of a text, so it is parsed once per row."""
    patterns, values = [], []
    for c in spec.columns:
        text = tx.name(c.name)
        if c.is_timestamp:
            patterns.append(f"{tx.timestamp_or_null(text)} AS {_fact('ts', c.name)}")
        elif c.type != "string":
            number, value = _fact("num", c.name), _fact("val", c.name)
            patterns.append(f"{tx.is_number(text)} AS {number}")
            values.append(f"CASE WHEN {number} THEN try_cast({text} AS double) END AS {value}")
    for facts in (patterns, values):
        df = df.selectExpr("*", *facts) if facts else df
    return df


def _out_of_integer_range(c: Column) -> str:
    text, value, limit = tx.name(c.name), _fact("val", c.name), INTEGER_LIMITS[c.type]
    if c.type == "bigint":
        exact = f"try_cast({text} AS decimal(38,0))"
        outside = (
            f"(abs({value}) >= {SURE_BIGINT:.1e} AND "
            f"({exact} IS NULL OR {exact} < -{limit}BD OR {exact} >= {limit}BD))"
        )
    else:
        outside = f"({value} < -{limit} OR {value} >= {limit})"
    return (
        f"{_fact('num', c.name)} AND NOT {tx.has_decimal_point(text)} AND ({tx.has_exponent(text)} OR {outside})"
    )


def _out_of_decimal_range(c: Column) -> str:
    whole_digits = int(c.type[len("decimal("):].split(",")[0]) - c.scale
    near = f"abs({_fact('val', c.name)}) >= {10**whole_digits - 1}"
    return f"{near} AND try_cast({tx.name(c.name)} AS {c.type}) IS NULL"


def _column_checks(c: Column) -> list[Check]:
    text = tx.name(c.name)
    found: list[Check] = []

    def add(rule, broken, severity="error", silenced_by=None):
        found.append(Check(rule, c.name, broken, text, severity, silenced_by))

    if c.required:
        add("not_null", f"{text} IS NULL")
    if c.width is not None:
        add("exact_width", f"length({text}) <> {c.width}")
    if c.max_width is not None:
        add("max_width", f"length({text}) > {c.max_width}")
    if c.is_integer:
        add("integer", f"NOT {_fact('num', c.name)}")
        add("decimal_point", tx.has_decimal_point(text), silenced_by="integer")
        add("numeric_range", _out_of_integer_range(c))
    elif c.is_decimal or c.type == "double":
        add("decimal", f"NOT {_fact('num', c.name)}")
    if c.minimum is not None:
        number_rule = "integer" if c.is_integer else "decimal"
        add("below_minimum", f"{_fact('val', c.name)} < {c.minimum}", silenced_by=number_rule)
    if c.is_decimal:
        add("numeric_range", _out_of_decimal_range(c))
        add("excess_scale", f"{_fact('num', c.name)} AND {tx.exceeds_scale(text, _fact('val', c.name), c.scale)}", "warn")
    if c.is_timestamp:
        add("timestamp", f"{text} IS NOT NULL AND {_fact('ts', c.name)} IS NULL")
    if c.allowed is not None:
        add("domain", f"{text} NOT IN ({', '.join(tx.literal(v) for v in c.allowed)})")
    return found


def row_checks(spec: TableSpec) -> list[Check]:
    """Every one-row rule of the table, in the order of its columns."""

    def typed_value(column: str) -> str:
        c = spec.column(column)
        return _fact("ts", column) if c.is_timestamp else f"({tx.typed_or_null(c, tx.name(column))})"

    found = [check for c in spec.columns for check in _column_checks(c)]
    for rule in spec.row_rules:
        holds = rule.test.format(**{c: typed_value(c) for c in rule.columns})
        found.append(Check(rule.name, "+".join(rule.columns), f"NOT ({holds})", tx.key_text(rule.columns)))
    return found


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    present = set(df.columns)
    return [c for c in spec.column_names if c not in present]


def _entry(spec: TableSpec, rule: str, columns: str, severity: str, n_violations: str) -> str:
    return (
        f"named_struct('table_name', {tx.literal(spec.name)}, 'rule', {tx.literal(rule)}, "
        f"'columns', {tx.literal(columns)}, 'severity', '{severity}', "
        f"'n_rows', cast(n_rows AS bigint), 'n_violations', cast({n_violations} AS bigint))"
    )


def _as_report(one_row: DataFrame, *entries: str) -> DataFrame:
    return one_row.selectExpr(f"inline(array({', '.join(entries)}))")


def _row_count(df: DataFrame) -> DataFrame:
    return df.groupBy().agg({"*": "count"}).toDF("n_rows")


def _column_groups(checks: list[Check]) -> list[list[Check]]:
    """Checks in groups that share columns and are small enough to compile well."""
    groups: list[list[Check]] = [[]]
    for check in checks:
        same_column = groups[-1] and groups[-1][-1].columns == check.columns
        if len(groups[-1]) >= CHECKS_PER_SCAN and not same_column:
            groups.append([])
        groups[-1].append(check)
    return groups


def count_row_checks(
    df: DataFrame, spec: TableSpec, checks: list[Check] | None = None, compare_rows: bool = False
) -> DataFrame:
    """One report row per one-row rule.  ``n_violations`` is null where a rule is silenced.

    A few columns at a time are aggregated without any shuffle of rows.  Each group
    reads its own columns only, so together the groups read a columnar table once,
    and the code generated for a group stays within what the JVM compiles.
    """
    prepared = with_facts(df, spec)
    parts = []
    for group in _column_groups(row_checks(spec) if checks is None else checks):
        # A global aggregation in SQL text: the GROUP BY is empty.
        counts = [f"count(CASE WHEN {c.broken} THEN 1 END) AS v{i}" for i, c in enumerate(group)]
        totals = prepared.selectExpr("count(1) AS n_rows", *counts)
        position = {(c.rule, c.columns): i for i, c in enumerate(group)}
        entries = []
        if not parts:
            entries.append(_entry(spec, "columns_present", "*", "error", "0"))
            if compare_rows and spec.expected_rows is not None:
                entries.append(_entry(spec, "row_count", "*", "warn", f"abs(n_rows - {spec.expected_rows})"))
        for i, check in enumerate(group):
            silencer = position.get((check.silenced_by, check.columns))
            violations = f"v{i}" if silencer is None else f"CASE WHEN v{silencer} = 0 THEN v{i} END"
            entries.append(_entry(spec, check.rule, check.columns, check.severity, violations))
        parts.append(_as_report(totals, *entries))
    return reduce(DataFrame.unionByName, parts)


def count_key_check(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One report row: all rows that share their key with another row."""
    summary = keys.duplicate_summary(df, spec.key)
    return _as_report(summary, _entry(spec, "primary_key", "+".join(spec.key), "error", "duplicate_rows"))


def _reference_label(fk: ForeignKey) -> str:
    return f"{fk.column}->{fk.parent}.{fk.parent_column}"


def count_reference_check(
    df: DataFrame, spec: TableSpec, fk: ForeignKey, parent: DataFrame | None
) -> DataFrame:
    """One report row: child rows without a parent.  A null child counts, as does a lost parent."""
    label = _reference_label(fk)
    if parent is None:
        return _as_report(_row_count(df), _entry(spec, "parent_table_missing", label, "error", "1"))
    if fk.parent_column not in parent.columns:
        return _as_report(_row_count(df), _entry(spec, "parent_column_missing", label, "error", "1"))
    summary = keys.orphan_summary(df, fk.column, parent, fk.parent_column)
    return _as_report(summary, _entry(spec, "foreign_key", label, "error", "orphans"))


def count_all_checks(
    df: DataFrame,
    spec: TableSpec,
    tables: dict[str, DataFrame],
    compare_rows: bool = False,
) -> DataFrame:
    """All checks of one table.  Missing columns stop every other check of that table."""
    lost = missing_columns(df, spec)
    if lost:
        return _as_report(
            _row_count(df), _entry(spec, "columns_present", "+".join(lost), "error", str(len(lost)))
        )
    report = count_row_checks(df, spec, compare_rows=compare_rows)
    if spec.key:
        report = report.unionByName(count_key_check(df, spec))
    for fk in spec.foreign_keys:
        if not fk.weak:
            report = report.unionByName(count_reference_check(df, spec, fk, tables.get(fk.parent)))
    return report


def row_violations(df: DataFrame, spec: TableSpec, checks: list[Check]) -> DataFrame:
    """Every violation of the given one-row rules as (table, rule, columns, value)."""
    cases = [
        f"CASE WHEN {c.broken} THEN named_struct('rule', {tx.literal(c.rule)}, "
        f"'columns', {tx.literal(c.columns)}, 'value', coalesce({c.value}, 'NULL')) END"
        for c in checks
    ]
    return (
        with_facts(df, spec)
        .where(" OR ".join(f"coalesce({c.broken}, false)" for c in checks))
        .selectExpr(f"explode(array_compact(array({', '.join(cases)}))) AS hit")
        .selectExpr(f"{tx.literal(spec.name)} AS table_name", "hit.*")
    )


def violations(
    df: DataFrame, spec: TableSpec, tables: dict[str, DataFrame], failing: set[tuple[str, str]]
) -> DataFrame | None:
    """Violating values of the failing (rule, columns) pairs; ``None`` when none shows a value."""

    def labelled(values: DataFrame, rule: str, columns: str, value: str) -> DataFrame:
        return values.selectExpr(
            f"{tx.literal(spec.name)} AS table_name",
            f"{tx.literal(rule)} AS rule",
            f"{tx.literal(columns)} AS columns",
            f"{value} AS value",
        )

    parts: list[DataFrame] = []
    if missing_columns(df, spec):
        return None
    local = [c for c in row_checks(spec) if (c.rule, c.columns) in failing]
    if local:
        parts.append(row_violations(df, spec, local))
    key_label = "+".join(spec.key)
    if spec.key and ("primary_key", key_label) in failing:
        repeated = keys.duplicate_keys(df, spec.key)
        parts.append(labelled(repeated, "primary_key", key_label, tx.key_text(spec.key)))
    for fk in spec.foreign_keys:
        label = _reference_label(fk)
        if ("foreign_key", label) in failing:
            lost = keys.orphan_keys(df, fk.column, tables[fk.parent], fk.parent_column)
            parts.append(labelled(lost, "foreign_key", label, tx.key_text(("key",))))
    return reduce(DataFrame.unionByName, parts) if parts else None


def violation_examples(found: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` smallest distinct violating values per rule."""
    return smallest_values(found, ["table_name", "rule", "columns"], "value", k, rank_as="example_no")
