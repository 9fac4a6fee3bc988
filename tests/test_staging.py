"""Marketplace files through the checks and the publish gate."""

from decimal import Decimal

import pytest

import market
from quayside import session
from quayside.marketplace import marketplace_specs
from quayside.plans import mart, profile, publish, staging, validation
from quayside.session import new_run_folder
from quayside.sources import csv
from quayside.spec import Column, TableSpec, by_name, load_order

SPECS = marketplace_specs()
STAGED = tuple(s for s in SPECS if s.staged)


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    return market.write(tmp_path_factory.mktemp("market"), market.tables())


def stage(spark, source, root, run_id, **options):
    return staging.stage(spark, staging.read_text_tables(spark, source, STAGED), STAGED, root, run_id, **options)


def test_parents_come_before_children():
    order = load_order(STAGED)
    assert order.index("customers") < order.index("orders") < order.index("order_items")


def test_published_names_take_a_prefix():
    named = by_name(marketplace_specs("x", {"geolocation": "places.csv"}))
    assert named["order_items"].file_name == "x_order_items_dataset.csv"
    assert named["geolocation"].file_name == "places.csv"


def test_clean_files_are_published_with_their_types_and_again_the_same(spark, source, tmp_path):
    root = str(tmp_path / "staging")
    report = stage(spark, source, root, "r1")
    assert validation.problems_of(report).count() == 0
    first = {s.name: publish.read_published(spark, root, s.name) for s in STAGED}
    rows = {n: sorted(map(tuple, df.collect()), key=repr) for n, df in first.items()}
    for s in STAGED:
        assert [f.dataType.simpleString() for f in first[s.name].schema] == [c.type for c in s.columns]
        assert first[s.name].columns == s.column_names
    stage(spark, source, root, "r2")
    assert publish.read_pointer(spark, root)["run_id"] == "r2"
    for s in STAGED:
        again = publish.read_published(spark, root, s.name)
        assert sorted(map(tuple, again.collect()), key=repr) == rows[s.name]
    item = first["order_items"].first()
    assert isinstance(item.price, Decimal)
    assert first["customers"].where("length(customer_zip_code_prefix) = 5").count() == 120


def test_check_only_writes_no_tables(spark, source, tmp_path):
    root = str(tmp_path / "staging")
    report = stage(spark, source, root, "r1", check_only=True, compare_rows=True)
    assert publish.read_pointer(spark, root)["run_id"] is None
    warned = report.where("rule = 'row_count' and n_violations > 0").collect()
    assert len(warned) == 5 and {r.severity for r in warned} == {"warn"}


def test_a_missing_file_stops_staging(spark, tmp_path):
    data = market.tables(10)
    del data["sellers"]
    source = market.write(tmp_path / "in", data)
    with pytest.raises(FileNotFoundError, match="sellers.csv"):
        stage(spark, source, str(tmp_path / "out"), "r1")


def spoil(data):
    """The eight example failures, one per kind of check."""
    products = data["products"]
    weight = products[0].index("product_weight_g")
    products[1][weight] = "40.0"
    customers = data["customers"]
    customers[2][0] = customers[1][0]
    for row in customers[3:6]:
        row[3] = ""
    customers[6][1] = customers[6][1][:-1]
    data["orders"][1][3] = "2017/10/02 10:56"
    data["orders"][2][2] = "lost"
    data["order_items"][1][0] = market.ident("nowhere", 0)
    return data


def test_every_problem_is_reported_at_once_and_nothing_is_written(spark, source, tmp_path):
    root = str(tmp_path / "staging")
    stage(spark, source, root, "good")
    bad = market.write(tmp_path / "bad", spoil(market.tables()))
    with pytest.raises(validation.ValidationFailed) as failure:
        stage(spark, bad, root, "bad")
    assert publish.read_pointer(spark, root)["run_id"] == "good"
    found = {(r.table_name, r.rule, r.columns): r for r in validation.problems_of(failure.value.report).collect()}
    counts = {k: r.n_violations for k, r in found.items()}
    assert counts == {
        ("customers", "primary_key", "customer_id"): 2,
        ("customers", "not_null", "customer_city"): 3,
        ("customers", "exact_width", "customer_unique_id"): 1,
        ("products", "decimal_point", "product_weight_g"): 1,
        ("orders", "timestamp", "order_purchase_timestamp"): 1,
        ("orders", "domain", "order_status"): 1,
        ("orders", "foreign_key", "customer_id->customers.customer_id"): 1,
        ("order_items", "foreign_key", "order_id->orders.order_id"): 1,
    }
    assert found[("orders", "domain", "order_status")].examples == ["lost"]
    assert found[("products", "decimal_point", "product_weight_g")].examples == ["40.0"]
    assert found[("order_items", "foreign_key", "order_id->orders.order_id")].examples == [market.ident("nowhere", 0)]
    stored = spark.read.parquet(f"{root}/reports/run_id=bad")
    assert stored.where("n_violations > 0 and severity = 'error'").count() == 8
    assert len(failure.value.problems) == 8


def test_a_missing_column_is_one_problem_for_its_table(spark, tmp_path):
    data = market.tables(20)
    data["products"] = [row[:5] + row[6:] for row in data["products"]]
    source = market.write(tmp_path / "in", data)
    with pytest.raises(validation.ValidationFailed) as failure:
        stage(spark, source, str(tmp_path / "out"), "r1")
    problems = validation.problems_of(failure.value.report).collect()
    assert [(p.table_name, p.rule, p.columns) for p in problems] == [("products", "columns_present", "product_weight_g")]


def test_delivery_before_purchase_is_refused(spark, tmp_path):
    data = market.tables(20)
    data["orders"][1][6] = "2020-03-01 00:00:00"
    source = market.write(tmp_path / "in", data)
    with pytest.raises(validation.ValidationFailed, match="delivered_after_purchase"):
        stage(spark, source, str(tmp_path / "out"), "r1")


def test_totals_per_table(spark, tmp_path):
    source = market.write(tmp_path / "in", spoil(market.tables()))
    tables = staging.read_text_tables(spark, source, STAGED)
    report = validation.validate_all(spark, tables, STAGED)
    totals = {r.table_name: (r.n_rows, r.n_problems) for r in validation.problem_totals(report).collect()}
    assert totals["customers"] == (120, 3) and totals["sellers"] == (8, 0)


@pytest.fixture(scope="module")
def mart_tables(spark, source):
    root = new_run_folder(spark, "mart-staging")
    stage(spark, source, root, "r1")
    tables = {s.name: publish.read_published(spark, root, s.name) for s in STAGED}
    for s in SPECS:
        if not s.staged:
            tables[s.name] = csv.read_by_position(spark, f"{source}/{s.file_name}", s)
    return tables


def test_mart(spark, mart_tables):
    built = mart.build_mart(mart_tables)
    items = mart_tables["order_items"]
    assert built["fact_order_items"].count() == items.count()
    orders = built["fact_orders"]
    assert orders.count() == 120
    assert orders.where("n_items is null").count() == 30
    assert {r.stage for r in orders.select("stage").distinct().collect()} == {"delivered", "posted"}
    assert orders.where("stage = 'posted' and days_late is not null").count() == 0
    assert orders.where("methods = 'credit_card+voucher'").count() == 24
    assert orders.where("review_score is not null").count() == 120
    scores = {r.order_id: r.review_score for r in orders.collect()}
    assert all(scores[r.order_id] == r.review_score for r in mart_tables["order_reviews"].collect())
    assert built["dim_review"].count() == 60
    people = built["dim_customer"]
    assert people.count() == 90
    assert people.where("is_repeat").count() == 30
    spent = people.agg({"lifetime_value": "sum"}).first()[0]
    paid = items.selectExpr("sum(price + freight_value)").first()[0]
    assert spent == paid
    products = built["dim_product"]
    assert {"product_name_length", "product_description_length"} <= set(products.columns)
    names = {r.category for r in products.select("category").distinct().collect()}
    assert names == {"kites_and_string", "lanterns", "nomes_soltos", None}
    assert products.where("not is_complete").count() == 3
    assert built["dim_seller"].where("lat is not null").count() == 8
    assert built["dim_date"].count() == 1


def test_latest_review_per_id(spark, mart_tables):
    kept = mart.latest_reviews(mart_tables["order_reviews"])
    assert kept.count() == 60
    both = mart_tables["order_reviews"].where(f"review_id = '{market.ident('r', 0)}'")
    newest = max(r.review_answer_timestamp for r in both.collect())
    assert kept.where(f"review_id = '{market.ident('r', 0)}'").first().review_answer_timestamp == newest


def test_null_patterns_and_cardinality(spark, mart_tables):
    patterns = {r.null_columns: r.n_rows for r in profile.null_patterns(mart_tables["products"]).collect()}
    together = "product_category_name+product_name_lenght+product_description_lenght+product_photos_qty"
    assert patterns == {"": 27, together: 3}
    edges = {r.edge: r for r in profile.relationship_cardinality(mart_tables, SPECS).collect()}
    items = edges["order_items.order_id->orders.order_id"]
    assert (items.n_parents, items.childless_parents, items.max_children) == (120, 30, 3)


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b int")
    for approximate in (False, True):
        rows = profile.profile_columns(empty, "t", approximate).collect()
        assert [(r.column_name, r.n_rows, r.n_nulls, r.null_percent, r.n_distinct) for r in rows] == [
            ("a", 0, 0, None, 0), ("b", 0, 0, None, 0)
        ]
        assert {r.is_key for r in rows} == ({None} if approximate else {False})


def test_both_profiles_judge_types_alike(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, 1.0D, 1.50BD, timestamp_ntz'2024-01-01 00:00:00', '7', 'x', '', ' 5', 'é', true),
          (2, double('NaN'), 2.00BD, timestamp_ntz'2024-01-01 00:00:00.5', '-1', '1x', '2', '6', null, false)
        AS t(i, d, m, t, n, s, e, w, u, b)""")
    exact, sketch = (
        {r.column_name: (r.likely_type, r.min_length, r.max_length, r.example) for r in
         profile.profile_columns(df, "t", approximate).collect()}
        for approximate in (False, True)
    )
    assert exact == sketch


@pytest.mark.parametrize("named", [True, False])
@pytest.mark.parametrize("row", ["2,y,EXTRA", "3"])
@pytest.mark.parametrize("multiline", [True, False])
def test_rows_of_the_wrong_length_stop_staging(spark, tmp_path, named, row, multiline):
    (tmp_path / "t.csv").write_text(f"a,b\n1,x\n{row}\n4,z\n")
    spec = TableSpec("t", (Column("a", "int"), Column("b")), file_name="t.csv", multiline=multiline)
    with pytest.raises(staging.BrokenRecords, match=r"t\.csv: 1 bad record"):
        staging.read_text_tables(spark, str(tmp_path), (spec,), named=named)


def test_staging_leaves_nothing_in_the_shared_folder(spark, tmp_path, monkeypatch):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n")
    (tmp_path / "bad.csv").write_text("a,b\n1,x\ny\n")
    shared = tmp_path / "shared"
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(shared))
    root = str(tmp_path / "out")

    def run(file_name, run_id, kind="int"):
        spec = TableSpec("t", (Column("a", kind), Column("b")), file_name=file_name)
        return staging.stage_files(spark, str(tmp_path), (spec,), root, run_id)

    assert run("t.csv", "r1").count() > 0
    assert not list(shared.glob("*"))
    with pytest.raises(staging.BrokenRecords):
        run("bad.csv", "r2")
    with pytest.raises(validation.ValidationFailed):
        run("t.csv", "r3", kind="timestamp_ntz")
    assert not list(shared.glob("*"))
    assert publish.read_pointer(spark, root)["run_id"] == "r1"


def test_profile_of_text(spark, source):
    text = csv.read_by_position(spark, f"{source}/customers.csv", by_name(SPECS)["customers"])
    for approximate in (False, True):
        rows = {r.column_name: r for r in profile.profile_columns(text, "customers", approximate).collect()}
        assert rows["customer_id"].min_length == rows["customer_id"].max_length == 32
        assert rows["customer_zip_code_prefix"].likely_type == "int"
        assert rows["customer_city"].likely_type == "string"
        assert rows["customer_state"].n_distinct == 1
    exact = {r.column_name: r for r in profile.profile_columns(text, "customers").collect()}
    assert exact["customer_id"].is_key and not exact["customer_unique_id"].is_key


def test_merged_sketches_give_the_profile_of_all_rows(spark):
    whole = spark.sql("""
        SELECT cast(id AS string) AS k, CASE WHEN id % 7 = 0 THEN NULL ELSE concat('v', id % 1000) END AS v,
               cast(id % 3 AS string) AS few, cast(NULL AS string) AS none FROM range(30000)""")
    parts = [whole.where(f"k % 4 = {i}") for i in range(4)] + [whole.limit(0)]
    merged = profile.profile_of_sketches(profile.merge_sketches(*map(profile.sketch_columns, parts)), "t")
    exact = {r.column_name: r for r in profile.profile_columns(whole, "t").collect()}
    for r in merged.collect():
        own = exact[r.column_name]
        assert abs(r.n_distinct - own.n_distinct) <= 0.06 * own.n_distinct and r.is_key is None
        assert (r.n_rows, r.n_nulls, r.null_percent, r.min_length, r.max_length, r.likely_type, r.example) == (
            own.n_rows, own.n_nulls, own.null_percent, own.min_length, own.max_length, own.likely_type, own.example
        )
    both = profile.merge_sketches(profile.sketch_columns(whole), profile.sketch_columns(whole))
    assert {r.n_distinct for r in profile.profile_of_sketches(both, "t").where("column_name = 'few'").collect()} == {3}
