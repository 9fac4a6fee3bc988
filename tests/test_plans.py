"""What the plans look like: pruned scans, partial work before shuffles, hot keys split."""

import re

import pytest

from quayside.operators import business, keys, ranked
from quayside.plans import cascade, publish
from quayside.queries import REGISTRY
from quayside.session import cut_lineage
from quayside.spec import Column, ForeignKey, TableSpec

SF = "/root/testdata/sf0.001"


@pytest.fixture
def unbroadcast(spark):
    """Joins planned as for sides too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield spark
    for n in names:
        spark.conf.unset(n)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text: str, table: str) -> list[set[str]]:
    return [
        {c.split(":")[0] for c in m.group(1).split(",") if c}
        for m in re.finditer(rf"{table}\.parquet\].*?ReadSchema: struct<([^>]*)>", text)
    ]


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - {"file_manifest", "file_manifest_totals", "manifest_comparison"}))
def test_no_query_multiplies_rows_or_leaves_the_jvm(unbroadcast, name):
    text = plan(REGISTRY[name](unbroadcast, SF))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow"):
        assert unwanted not in text


def test_no_query_forces_a_broadcast(spark):
    for name in ("customer_nation_names", "mart_fact_lineitem", "check_foreign_keys", "sample_part"):
        logical = REGISTRY[name](spark, SF)._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in logical


def test_reference_checks_read_keys_only(unbroadcast):
    text = plan(REGISTRY["check_foreign_keys"](unbroadcast, SF))
    assert all(len(c) == 1 for c in read_columns(text, "orders"))
    assert all(c <= {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"} for c in read_columns(text, "lineitem"))


def test_reference_checks_count_before_the_shuffle_and_join_without_another(unbroadcast):
    child = unbroadcast.range(100).selectExpr("id % 7 as k")
    parent = unbroadcast.range(5).withColumnRenamed("id", "k")
    lines = plan(keys.orphan_summary(child, "k", parent, "k")).splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2  # one per side, none between the counting and the join
    assert all("HashAggregate" in lines[i + 1] for i in exchanges)


def test_top_k_is_cut_before_the_shuffle(spark):
    lines = plan(REGISTRY["events_three_per_user"](spark, SF)).splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "WindowGroupLimit" in lines[shuffle + 1] and "Partial" in lines[shuffle + 1]


def test_children_of_a_sample_are_cut_in_their_scan(unbroadcast):
    lines = plan(REGISTRY["sample_lineitem"](unbroadcast, SF)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "lineitem.parquet" in line)
    above = lines[:scan]
    last_filter = max(i for i, line in enumerate(above) if "Filter" in line)
    last_exchange = max(i for i, line in enumerate(above) if "Exchange" in line)
    assert last_exchange < last_filter and "md5" in above[last_filter]


def test_row_checks_shuffle_one_row_per_task(spark):
    text = plan(REGISTRY["check_not_null"](spark, SF))
    assert "hashpartitioning" not in text and "SinglePartition" in text


def hot(spark, tmp_path, rows=300_000):
    """A table in many files where one key holds a third of all rows."""
    path = str(tmp_path / "hot")
    (
        spark.range(rows)
        .selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "uuid() AS payload")
        .repartition(12)
        .write.parquet(path)
    )
    return spark.read.parquet(path)


@pytest.mark.parametrize("operator", ["attach", "in_keys"])
def test_a_hot_key_is_split_over_tasks(unbroadcast, tmp_path, operator):
    spark = unbroadcast
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "1MB",
        "spark.sql.files.openCostInBytes": "1MB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = hot(spark, tmp_path)
        right = spark.range(300_000).selectExpr("id AS r", "id * 2 AS name")
        df = business.attach(left, right, "k", "r") if operator == "attach" else keys.in_keys(left, "k", right, "r")
        assert len(df.collect()) == 300_000
        assert "skewed" in plan(df)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_hot_groups_reach_the_shuffle_as_a_few_rows(spark, tmp_path):
    df = hot(spark, tmp_path, 60_000)
    counted = keys.duplicate_keys(df, ["k"]).collect()
    assert [(r.k, r.n) for r in counted] == [(1, 20_001)]  # id 1 has the hot key by itself
    kept = ranked.top_per_group(df, ["k"], [df.payload], 2).where("k = 1").collect()
    smallest = sorted(r.payload for r in df.where("k = 1").select("payload").collect())[:2]
    assert sorted(r.payload for r in kept) == smallest


def test_points_of_a_hot_area_are_cut_before_anything_is_shuffled(unbroadcast, tmp_path):
    spark = unbroadcast
    specs = (
        TableSpec("orders", (Column("o"), Column("area")), key=("o",),
                  foreign_keys=(ForeignKey("area", "places", "k", weak=True),)),
        TableSpec("places", (Column("k"), Column("payload"))),
    )
    orders = spark.range(10).selectExpr("cast(id AS string) AS o", "cast(id AS string) AS area")
    places = hot(spark, tmp_path, 60_000).selectExpr("cast(k AS string) AS k", "payload")
    sample = cascade.cascade_sample({"orders": orders, "places": places}, specs, "orders", 10)["places"]
    lines = plan(sample).splitlines()
    scan = max(i for i, line in enumerate(lines) if "payload" in line and "FileScan" in line)
    shuffle = max(i for i, line in enumerate(lines[:scan]) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[shuffle:scan])
    wanted = places.where("k IN ('1', '2', '4')").groupBy("k").count().collect()
    kept = sample.groupBy("k").count().collect()
    assert {r.k: r["count"] for r in kept if r.k in ("1", "2", "4")} == {r.k: min(3, r["count"]) for r in wanted}


@pytest.mark.parametrize("value", ["uuid()", "'same'"])
def test_examples_move_one_record_per_task(spark, value):
    found = spark.range(0, 50_000, 1, 8).selectExpr("'t' AS table_name", "'r' AS rule", "'c' AS columns", f"{value} AS value")
    found = cut_lineage(found)
    shown = ranked.smallest_values(found, ["table_name", "rule", "columns"], "value", 3)
    assert shown.count() == (3 if value == "uuid()" else 1)
    text = plan(found.groupBy("table_name", "rule", "columns").agg({"value": "min"}))
    assert "partial_min" in text


@pytest.mark.parametrize("kind,k", [("string", 2), ("bigint", 3), ("date", 1), ("decimal(9,2)", 40)])
def test_smallest_values_of_each_group(spark, monkeypatch, kind, k):
    rows = spark.range(0, 3000, 1, 6).selectExpr(
        "nullif(id % 5, 4) AS g", "nullif(concat('h', id % 3), 'h1') AS h", "id"
    )
    values = {
        "string": "if(id % 7 = 0, NULL, concat_ws('', char(97 + id % 3), if(id % 11 = 0, 'é\U0001F600', ''), id % 13))",
        "bigint": "if(id % 7 = 0, NULL, 40 - id % 90)",
        "date": "if(id % 7 = 0, NULL, date_add(DATE'1970-01-01', 40 - cast(id % 90 AS int)))",
        "decimal(9,2)": "cast(if(id % 7 = 0, NULL, (40 - id % 30) / 8) AS decimal(9,2))",
    }
    df = rows.selectExpr("g", "h", f"{values[kind]} AS v")
    groups = {}
    for r in df.collect():
        if r.v is not None:
            groups.setdefault((r.g, r.h), set()).add(r.v)
    expected = {(*key, v, n) for key, vs in groups.items() for n, v in enumerate(sorted(vs)[:k], 1)}
    for slices in (256, 3, 1):  # also where slices hold several of the smallest values
        monkeypatch.setattr(ranked, "SLICES", slices)
        shown = ranked.smallest_values(df, ["g", "h"], "v", k, rank_as="n")
        assert shown.columns == ["g", "h", "v", "n"]
        found = [tuple(r) for r in shown.collect()]
        assert len(found) == len(expected) and set(found) == expected
    assert ranked.smallest_values(df.where("v IS NULL"), ["g", "h"], "v", k).count() == 0


def test_tables_in_buckets_are_joined_where_they_are(spark, tmp_path):
    big = spark.range(5000).selectExpr("id DIV 3 AS k", "id AS v", "'x.y' AS `a b`")
    small = spark.range(1000).selectExpr("id AS k")
    root = str(tmp_path / "out")
    ways = {"big": publish.Bucketing("k", 4), "small": publish.Bucketing("k", 4)}
    assert publish.publish(spark, {"big": big, "small": small}, root, "r1", bucketing=ways) == {"big": 5000, "small": 1000}
    stored, parents = (publish.read_published(spark, root, t) for t in ways)
    assert stored.schema.simpleString() == big.schema.simpleString()
    assert stored.exceptAll(big).count() == big.exceptAll(stored).count() == 0
    for df in (
        stored.join(parents.hint("merge"), "k", "left_semi"),
        keys.rows_per_key(stored, ["k"]),
        keys._counted_against(stored, "k", parents, "k").hint("merge"),
    ):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Exchange hashpartitioning" not in plan, plan
    found = keys.orphan_summary(stored, "k", parents, "k").first()
    assert (found.n_rows, found.orphans) == (5000, 2000)
    with pytest.raises(publish.PublishFailed):
        publish.publish(spark, {"big": big}, root, "r1", bucketing=ways)
    publish.publish(spark, {"big": big.limit(7)}, root, "r2", keep_others=True)
    assert publish.read_published(spark, root, "big").count() == 7
    assert publish.read_published(spark, root, "small").count() == 1000
