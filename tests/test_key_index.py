"""Keys of appended rows against all keys seen before."""

import random

import pytest

from quayside.operators import keys
from quayside.plans import key_index
from quayside.plans.key_index import KeyIndex, Totals

SCHEMA = "a string, b bigint, v string"


def rows_of(pick, n):
    return [(pick.choice(["x", "y", "1:", None, "1", ""]), pick.choice([None, *range(40)]), "v") for _ in range(n)]


def full(spark, rows):
    found = keys.duplicate_summary(spark.createDataFrame(rows, SCHEMA), ("a", "b")).first()
    return Totals(found.n_rows, found.duplicate_rows, found.duplicate_keys)


def test_totals_equal_the_full_check_after_each_append(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_PARTS", 3)
    pick, seen = random.Random(2), []
    for number, n in enumerate([0, 30, 1, 200, 0, 90]):
        rows = rows_of(pick, n)
        index = KeyIndex(spark, str(tmp_path), ("a", "b"), buckets=4)  # opened anew each time
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        checked = index.check(df)
        old = [(r.key, r.n_old) for r in index.repeated(df).collect() if r.n_old]
        assert index.append(df, f"b{number}") == checked == full(spark, seen + rows)
        held = {(a, b) for a, b, _ in seen}
        assert len(old) == len({(a, b) for a, b, _ in rows} & held)
        seen += rows
        assert len(index.parts) <= 3
    assert KeyIndex(spark, str(tmp_path), ("a", "b")).keys().count() == len({r[:2] for r in seen})


def test_a_repeated_append_and_other_columns_are_refused(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), ("a",), buckets=2)
    df = spark.createDataFrame([("k", 1, "v")], SCHEMA)
    index.append(df, "one")
    with pytest.raises(key_index.RepeatedAppend):
        index.append(df, "one")
    with pytest.raises(ValueError):
        index.append(df, "../two")
    with pytest.raises(ValueError):
        KeyIndex(spark, str(tmp_path), ("b",))
    assert KeyIndex(spark, str(tmp_path), ("a",)).totals == Totals(1, 0, 0)


def test_a_failed_append_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    index = KeyIndex(spark, str(tmp_path), ("a",), buckets=2)
    df = spark.createDataFrame([("k", 1, "v"), ("l", 1, "v")], SCHEMA)
    index.append(df, "one")
    with monkeypatch.context() as patched:
        patched.setattr(KeyIndex, "_switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            index.append(df, "two")
    index = KeyIndex(spark, str(tmp_path), ("a",))
    assert index.totals == Totals(2, 0, 0) and index.keys().count() == 2
    assert index.append(df, "two") == Totals(4, 4, 2)


def test_old_keys_do_not_move(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), ("b",), buckets=4)
    for batch in ("one", "two"):
        index.append(spark.range(500).selectExpr("'x' AS a", "id AS b", "'v' AS v"), batch)
    compared = index.against_old(spark.range(490, 520).selectExpr("'x' AS a", "id AS b", "'v' AS v"))
    assert compared.where("n_old = 2").count() == 10
    compared.collect()
    plan = compared._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan")[0]
    old = plan[plan.index("SortMergeJoin") :]
    scan = old.index("FileScan parquet")
    sides = old[:scan].rsplit("Sort [key", 1)[-1]  # from the join down to the stored keys
    assert "Bucketed: true" in old and "Exchange" not in sides, plan
