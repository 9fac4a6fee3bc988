"""One small table per rule: a pass, a violation, a boundary and a null."""

import pytest

from quayside.operators import checks
from quayside.spec import Column, ForeignKey, RowRule, TableSpec


def counts(spark, column, values, rules=None):
    spec = TableSpec("t", (column,))
    df = spark.createDataFrame([(v,) for v in values], f"`{column.name}` string")
    report = checks.count_row_checks(df, spec).collect()
    return {r.rule: r.n_violations for r in report if r.rule != "columns_present"}


def test_not_null(spark):
    assert counts(spark, Column("a", required=True), ["a", None, ""]) == {"not_null": 1}


def test_exact_width_counts_characters_and_skips_null(spark):
    assert counts(spark, Column("a", width=5), ["01037", "1037", "010371", "sãoão", None]) == {"exact_width": 2}


def test_max_width(spark):
    assert counts(spark, Column("a", max_width=3), ["são", "abcd", "", None]) == {"max_width": 1}


@pytest.mark.parametrize(
    "value, rule",
    [
        ("40", None), ("+5", None), (" 12 ", None), (None, None), ("-3", None),
        ("abc", "integer"), ("0x10", "integer"), ("1_000", "integer"), ("1d", "integer"), ("inf", "integer"),
        ("NaN", "integer"), ("", "integer"),
        ("40.0", "decimal_point"),
        ("1e3", "numeric_range"), ("99999999999", "numeric_range"),
    ],
)
def test_integer(spark, value, rule):
    found = counts(spark, Column("a", "int"), [value])
    assert {r for r, n in found.items() if n} == ({rule} if rule else set())


def test_bad_integer_silences_the_decimal_point(spark):
    assert counts(spark, Column("a", "int"), ["x", "40.0"]) == {
        "integer": 1, "decimal_point": None, "numeric_range": 0,
    }


@pytest.mark.parametrize(
    "value, rule",
    [
        ("58.90", None), ("0", None), (".5", None), ("1e3", None), (None, None),
        ("abc", "decimal"), ("-1", "below_minimum"), ("-0.01", "below_minimum"),
        ("99999999999", "numeric_range"), ("12.345", "excess_scale"), ("12.340", None),
    ],
)
def test_decimal(spark, value, rule):
    found = counts(spark, Column("a", "decimal(10,2)", minimum=0), [value])
    assert {r for r, n in found.items() if n} == ({rule} if rule else set())


@pytest.mark.parametrize(
    "value, ok",
    [
        ("2021-06-07 11:22:33", True), ("2017-1-2 3:4:5", True), (None, True),
        ("2017-10-02", False), ("2021-06-07T11:22:33", False), ("2017-02-30 00:00:00", False),
        ("2021-06-07 11:22:33.5", False), ("2018-11-04 00:30:00", True), ("02/10/2017 10:00:00", False),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_timestamp_does_not_depend_on_the_time_zone(spark, value, ok, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert counts(spark, Column("a", "timestamp_ntz"), [value]) == {"timestamp": 0 if ok else 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_domain_lets_null_pass(spark):
    assert counts(spark, Column("a", allowed=("delivered",)), ["delivered", "lost", None]) == {"domain": 1}


def test_row_rule_counts_only_definite_violations(spark):
    rule = RowRule("late_after_early", ("late", "early"), "{late} >= {early}")
    spec = TableSpec(
        "t", (Column("early", "timestamp_ntz"), Column("late", "timestamp_ntz")), row_rules=(rule,)
    )
    a, b = "2017-10-02 10:00:00", "2017-10-03 10:00:00"
    df = spark.createDataFrame([(a, b), (a, a), (b, a), (a, None), (None, a), (a, "x")], "early string, late string")
    report = {r.rule: r.n_violations for r in checks.count_row_checks(df, spec).collect()}
    assert report["late_after_early"] == 1


def test_key_counts_all_rows_of_duplicate_groups_and_null_equals_null(spark):
    spec = TableSpec("t", (Column("a"), Column("b")), key=("a", "b"))
    rows = [("1", "1"), ("1", "2"), ("2", "1"), ("2", "1"), (None, "1"), (None, "1"), (None, "2")]
    df = spark.createDataFrame(rows, "a string, b string")
    row = checks.count_key_check(df, spec).first()
    assert (row.n_rows, row.n_violations) == (7, 4)


def test_foreign_key_counts_null_and_unknown_rows(spark):
    fk = ForeignKey("p", "parent", "id")
    spec = TableSpec("child", (Column("p"),), foreign_keys=(fk,))
    child = spark.createDataFrame([("1",), ("1",), ("9",), ("9",), (None,)], "p string")
    parent = spark.createDataFrame([("1",), ("1",), (None,)], "id string")
    row = checks.count_reference_check(child, spec, fk, parent).first()
    assert (row.n_rows, row.n_violations) == (5, 3)


def test_foreign_key_without_a_parent_is_a_problem(spark):
    fk = ForeignKey("p", "parent", "id")
    spec = TableSpec("child", (Column("p"),), foreign_keys=(fk,))
    child = spark.createDataFrame([("1",)], "p string")
    assert checks.count_reference_check(child, spec, fk, None).first().rule == "parent_table_missing"
    other = spark.createDataFrame([("1",)], "x string")
    assert checks.count_reference_check(child, spec, fk, other).first().rule == "parent_column_missing"


def test_missing_column_stops_the_other_checks(spark):
    spec = TableSpec("t", (Column("a", required=True), Column("b", required=True)), key=("a",))
    df = spark.createDataFrame([(None, "z")], "a string, extra string")
    report = checks.count_all_checks(df, spec, {}).collect()
    assert [(r.rule, r.columns, r.n_violations) for r in report] == [("columns_present", "b", 1)]


def test_decimal_places_count_however_a_number_is_written(spark):
    spec = TableSpec("t", (Column("a", "decimal(10,2)"),))
    cases = {
        "12345e-4": True, "1.2345e0": True, "1e-30": True, "1.234567890123456789012": True, "0.125": True,
        "1200e-4": False, "1.5e1": False, "1.500": False, "0e-9": False, "7": False, "1e5": False, "x": False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    found = checks.violations(df, spec, {}, {("excess_scale", "a")})
    assert {r.value for r in found.collect()} == {k for k, bad in cases.items() if bad}


def test_examples_are_three_smallest_distinct_values(spark):
    spec = TableSpec("t", (Column("a", width=1), Column("b", "int")))
    rows = [("zz", "x"), ("zz", "x"), ("yy", "1"), ("xx", "y"), ("ww", None), ("q", "1")]
    df = spark.createDataFrame(rows, "a string, b string")
    found = checks.violations(df, spec, {}, {("exact_width", "a"), ("integer", "b")})
    shown = {(r.rule, r.example_no): r.value for r in checks.violation_examples(found).collect()}
    assert shown == {
        ("exact_width", 1): "ww", ("exact_width", 2): "xx", ("exact_width", 3): "yy",
        ("integer", 1): "x", ("integer", 2): "y",
    }
