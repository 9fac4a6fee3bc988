"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import text as tx
from quayside.operators import business, checks, keys, ranked, sampling
from quayside.plans import cascade, intake, key_index, landing, manifest, mart, profile, publish, staging, validation
from quayside.session import cut_lineage, new_run_folder
from quayside.sources import csv, files
from quayside.spec import Column, ForeignKey, RowRule, TableSpec, by_name
from quayside.star import TABLES, load, spoiled, star_specs, text_table, text_tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

RUN_TS = datetime(2024, 1, 1)
SEED = 42
SAMPLE_SIZE = 300
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
EVENT_TYPES = ("click", "error", "purchase", "view")


def registered(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def _spec(table: str) -> TableSpec:
    return by_name(star_specs())[table]


def _rules(df: DataFrame, spec: TableSpec, *rules: str) -> DataFrame:
    """Counts of the named one-row rules of a table."""
    wanted = [c for c in checks.row_checks(spec) if c.rule in rules]
    counted = checks.count_row_checks(df, spec, wanted).where(F.col("rule") != "columns_present")
    return counted.select("rule", "columns", "n_rows", "n_violations")


# --- Landing, staging, publishing -------------------------------------------------


@registered
def land_orders_text(spark, sf):
    """Every column as text, with the file each row came from and one load time."""
    landed = landing.with_lineage(load(spark, sf, "orders"), RUN_TS)
    return tx.as_text(landed)


@registered
def land_orders_csv(spark, sf):
    """Orders out to CSV files, landed again by position with lineage, read by pointer."""
    folder = new_run_folder(spark, "land")
    spec = _spec("orders")
    csv.write_csv(load(spark, sf, "orders").select(*_csv_columns(spec)), f"{folder}/in/{spec.file_name}")
    landing.land_raw(spark, (spec,), f"{folder}/in", f"{folder}/raw", "r1", RUN_TS)
    landed = publish.read_published(spark, f"{folder}/raw", "orders")
    return landed.drop("_source_file").withColumn("_ingested_at", F.col("_ingested_at").cast("string"))


def _csv_columns(spec: TableSpec) -> list:
    return [F.col(c.name).cast("string").alias(c.name) for c in spec.columns]


@registered
def csv_roundtrip(spark, sf):
    """Long texts with quotes and newlines out to CSV and back, unchanged."""
    spec = TableSpec(
        "documents",
        (
            Column("doc_id", "bigint"), Column("text"), Column("lang"), Column("source"),
            Column("n_chars", "bigint"),
        ),
        multiline=True,
    )
    path = f"{new_run_folder(spark, 'csv')}/documents.csv"
    csv.write_csv(load(spark, sf, "documents"), path)
    return staging.typed_table(csv.read_by_position(spark, path, spec), spec)


@registered
def csv_intake(spark, sf):
    """Long texts with quotes and newlines out to CSV, and back by records found in split files."""
    spec = TableSpec(
        "documents",
        tuple(Column(c, "bigint" if c in ("doc_id", "n_chars") else "string") for c in DOCUMENT),
        file_name="documents.csv",
        multiline=True,
    )
    folder = new_run_folder(spark, "csv")
    csv.write_csv(load(spark, sf, "documents").select(*DOCUMENT), f"{folder}/documents.csv")
    return staging.typed_table(staging.read_text_tables(spark, folder, (spec,), named=False)["documents"], spec)


@registered
def diverted_records(spark, sf):
    """Orders landed from CSV with planted records that do not fit: what landed, and what was diverted."""
    spec = TableSpec(
        "orders", (Column("o_orderkey"), Column("o_custkey"), Column("o_orderstatus")), file_name="orders.csv"
    )
    line = F.expr("""concat_ws(',', o_orderkey, CASE WHEN o_orderkey % 103 != 0 THEN o_custkey END, CASE
        WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN 'é' ELSE o_orderstatus END,
        CASE WHEN o_orderkey % 101 = 0 THEN 'EXTRA' END)""")
    folder = new_run_folder(spark, "divert")
    # One column whose name is the header line; é is one byte here, and no UTF-8.
    lines = load(spark, sf, "orders").select(line.alias(",".join(spec.column_names)))
    options = {"header": "true", "sep": "\x01", "quote": "\x00", "encoding": "ISO-8859-1"}
    lines.write.options(**options).csv(f"{folder}/in/orders.csv")
    landing.land_raw(spark, (spec,), f"{folder}/in", f"{folder}/raw", "r1", RUN_TS, on_reject=intake.DIVERT)
    landed = publish.read_published(spark, f"{folder}/raw", "orders").select(
        F.lit("landed").alias("outcome"), F.col("o_orderkey").cast("bigint").alias("key")
    )
    rejects = spark.read.schema(intake.REJECTS).parquet(f"{folder}/raw/rejects/run_id=r1")
    key = F.substring_index(F.decode("record", "ISO-8859-1"), ",", 1).cast("bigint")
    found = landed.unionByName(rejects.select(F.col("reason").alias("outcome"), key.alias("key")))
    return found.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_records"), F.sum("key").alias("key_sum"))


@registered
def null_token_fields(spark, sf):
    """Fields that hold a null token become null."""
    marked = load(spark, sf, "part").select(
        "p_partkey",
        F.expr("CASE WHEN p_partkey % 54 = 0 THEN 'NA' WHEN p_partkey % 55 = 0 THEN '' ELSE p_brand END").alias(
            "p_brand"
        ),
        F.expr("CASE WHEN p_partkey % 56 = 0 THEN 'None' ELSE p_type END").alias("p_type"),
    )
    return tx.null_tokens(tx.as_text(marked), tx.NULL_TOKENS).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@registered
def stage_lineitem_typed(spark, sf):
    """Text back to declared types, columns in declared order."""
    return staging.typed_table(text_table(spark, sf, "lineitem"), _spec("lineitem"))


def _publish_star(spark, sf) -> str:
    """Text written once, as reading from files does it, then checked and published from there."""
    root = new_run_folder(spark, "staging")
    written = publish.write_version(spark, text_tables(spark, sf), new_run_folder(spark, "text"), "text")
    tables = {name: spark.read.parquet(w.path) for name, w in written.items()}
    staging.stage(spark, tables, star_specs(strict=False), root, "r1")
    return root


@registered
def stage_star_files(spark, sf):
    """All seven tables out to CSV, bound by header name, checked and published; line items read back."""
    folder, specs = new_run_folder(spark, "files"), star_specs(strict=False)
    for spec in specs:
        csv.write_csv(text_table(spark, sf, spec.name), f"{folder}/in/{spec.file_name}")
    staging.stage_files(spark, f"{folder}/in", specs, f"{folder}/out", "r1")
    return publish.read_published(spark, f"{folder}/out", "lineitem")


@registered
def publish_staging(spark, sf):
    """All seven tables checked and published, then line items read through the pointer."""
    return publish.read_published(spark, _publish_star(spark, sf), "lineitem")


@registered
def published_tables(spark, sf):
    """What the pointer lists after publishing."""
    return publish.published_tables(spark, _publish_star(spark, sf)).select("table_name", "n_rows")


# --- Checks -----------------------------------------------------------------------


@registered
def check_not_null(spark, sf):
    return _rules(text_table(spark, sf, "lineitem", dirty=True), _spec("lineitem"), "not_null")


def _key_summary(df: DataFrame, spec: TableSpec) -> DataFrame:
    summary = keys.duplicate_summary(df, spec.key)
    return summary.select(*[F.col(c).cast("bigint").alias(c) for c in summary.columns])


@registered
def check_primary_key_lineitem(spark, sf):
    return _key_summary(load(spark, sf, "lineitem"), _spec("lineitem"))


@registered
def check_primary_key_orders(spark, sf):
    return _key_summary(load(spark, sf, "orders"), _spec("orders"))


@registered
def check_width(spark, sf):
    return _rules(
        text_table(spark, sf, "customer", dirty=True), _spec("customer"), "exact_width", "max_width"
    )


@registered
def check_integer(spark, sf):
    """A text that is no number; it silences the decimal-point rule of its column."""
    return _rules(text_table(spark, sf, "part", dirty=True), _spec("part"), "integer", "decimal_point")


@registered
def check_decimal_point(spark, sf):
    """A decimal point where an integer is due."""
    marked = load(spark, sf, "part").withColumn(
        "p_size", F.expr("CASE WHEN p_partkey % 53 = 0 THEN '40.0' ELSE CAST(p_size AS STRING) END")
    )
    return _rules(tx.as_text(marked), _spec("part"), "integer", "decimal_point")


@registered
def check_decimal(spark, sf):
    """Customers hold a text that is no number, which silences the minimum; suppliers do not."""
    parts = [
        _rules(text_table(spark, sf, t, dirty=True), _spec(t), "decimal", "below_minimum", "excess_scale")
        for t in ("customer", "supplier")
    ]
    return reduce(DataFrame.unionByName, parts)


@registered
def check_timestamp(spark, sf):
    return _rules(text_table(spark, sf, "orders", dirty=True), _spec("orders"), "timestamp")


@registered
def check_domain(spark, sf):
    spec = TableSpec("events", (Column("event_type", allowed=EVENT_TYPES),))
    return _rules(tx.as_text(load(spark, sf, "events").select("event_type")), spec, "domain")


@registered
def check_numeric_range(spark, sf):
    """Large whole numbers against three declared types."""
    names = {"as_small": "smallint", "as_int": "int", "as_money": "decimal(10,2)"}
    spec = TableSpec("lineitem", tuple(Column(n, t) for n, t in names.items()))
    big = (F.col("l_orderkey") * F.lit(1_000_000).cast("bigint")).cast("string")
    df = load(spark, sf, "lineitem").select(*[big.alias(n) for n in names])
    return _rules(df, spec, "numeric_range")


@registered
def check_excess_scale(spark, sf):
    """Amounts with more decimals than their type, some of them written with an exponent."""
    dirt = """CASE WHEN l_orderkey % 97 = 0 THEN '12345e-4' WHEN l_partkey % 71 = 0 THEN '1.2345e0'
        WHEN l_suppkey % 33 = 0 THEN '1200E-4' WHEN l_partkey % 53 = 0 THEN '0.125'
        WHEN l_partkey % 54 = 0 THEN '1.500' WHEN l_partkey % 55 = 0 THEN '1e-30'
        ELSE cast(l_extendedprice AS string) END"""
    amounts = load(spark, sf, "lineitem").select(F.expr(dirt).alias("amount"))
    return _rules(amounts, TableSpec("amounts", (Column("amount", "decimal(10,2)"),)), "excess_scale")


@registered
def check_row_rules(spark, sf):
    """A rule across two dates of a row, and minimum values."""
    rule = RowRule(
        "shipped_after_order", ("l_shipdate", "o_orderdate"), "{l_shipdate} >= {o_orderdate}"
    )
    spec = TableSpec(
        "lineitem",
        (
            Column("l_linenumber", "smallint", minimum=1),
            Column("l_shipdate", "timestamp_ntz"),
            Column("o_orderdate", "timestamp_ntz"),
        ),
        row_rules=(rule,),
    )
    dated = business.attach(
        load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"),
        load(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
        "l_orderkey",
        "o_orderkey",
    )
    return _rules(tx.as_text(dated.drop("l_orderkey")), spec, "below_minimum", "shipped_after_order")


@registered
def check_foreign_keys(spark, sf):
    """Orphans on all edges of the line items; a null key counts."""
    return cascade.orphans_per_edge(
        {t: spoiled(load(spark, sf, t), t) for t in ("lineitem", "orders", "part", "supplier")}, star_specs()
    )


@registered
def orphan_order_keys(spark, sf):
    """The orphan keys themselves, with their rows."""
    found = keys.orphan_keys(
        spoiled(load(spark, sf, "lineitem"), "lineitem"), "l_orderkey", load(spark, sf, "orders"), "o_orderkey"
    )
    return found.select(F.coalesce(F.col("key").cast("string"), F.lit("NULL")).alias("order_key"), "n")


@registered
def violation_examples(spark, sf):
    """Three smallest distinct offending values of every failing rule of the line items."""
    tables = text_tables(spark, sf, dirty=True)
    failing = {
        ("not_null", "l_orderkey"),
        ("not_null", "l_partkey"),
        ("primary_key", "l_orderkey+l_linenumber"),
        ("foreign_key", "l_orderkey->orders.o_orderkey"),
        ("foreign_key", "l_partkey->part.p_partkey"),
        ("foreign_key", "l_suppkey->supplier.s_suppkey"),
    }
    found = checks.violations(tables["lineitem"], _spec("lineitem"), tables, failing)
    return checks.violation_examples(found).drop("table_name")


@registered
def validation_report(spark, sf):
    """Every declared check of the seven tables in one report."""
    return validation.check_counts(text_tables(spark, sf, dirty=True), star_specs())


@registered
def problem_totals(spark, sf):
    """Rows, failed checks and violations per table."""
    totals = validation.problem_totals(validation_report(spark, sf))
    return totals.withColumn("n_violations", F.col("n_violations").cast("bigint"))


@registered
def expected_counts(spark, sf):
    """Row counts against the expected ones; a difference is a warning."""
    parts = []
    for spec in star_specs():
        counted = checks.count_row_checks(load(spark, sf, spec.name), spec, [], compare_rows=True)
        parts.append(counted.where("rule = 'row_count'"))
    report = reduce(DataFrame.unionByName, parts)
    return report.select("table_name", "severity", "n_rows", F.col("n_violations").alias("difference"))


ORDER_BUCKETS = {"orders": publish.Bucketing("o_orderkey", 8), "lineitem": publish.Bucketing("l_orderkey", 8)}


def _published_in_buckets(spark, sf) -> dict[str, DataFrame]:
    root = new_run_folder(spark, "buckets")
    publish.publish(spark, {t: load(spark, sf, t) for t in ORDER_BUCKETS}, root, "r1", bucketing=ORDER_BUCKETS)
    return {t: publish.read_published(spark, root, t) for t in ORDER_BUCKETS}


@registered
def bucketed_reference_check(spark, sf):
    """Items without orders, and orders with their items, on tables published in buckets of the order."""
    tables = _published_in_buckets(spark, sf)
    found = keys.orphan_summary(tables["lineitem"], "l_orderkey", tables["orders"], "o_orderkey")
    spread = keys.reference_cardinality(tables["lineitem"], "l_orderkey", tables["orders"], "o_orderkey")
    counted = found.selectExpr(
        "stack(2, 'rows', CAST(n_rows AS BIGINT), 'orphans', CAST(orphans AS BIGINT)) AS (measure, value)"
    )
    return counted.unionByName(
        spread.selectExpr(
            "stack(3, 'parents', n_parents, 'childless', childless_parents, 'most children', max_children)"
            " AS (measure, value)"
        )
    )


@registered
def key_index_appends(spark, sf):
    """Line items appended in three batches, some twice: duplicate keys after each, by the index alone."""
    items = load(spark, sf, "lineitem")
    batches = ("l_orderkey % 3 = 0", "l_orderkey % 3 = 1 OR l_orderkey % 30 = 0", "l_orderkey % 3 = 2")
    index = key_index.KeyIndex(spark, new_run_folder(spark, "index"), ("l_orderkey", "l_linenumber"), buckets=8)
    found = []
    for number, batch in enumerate(batches):
        totals = index.append(items.where(batch), f"b{number}")
        found.append((number, totals.n_rows, totals.duplicate_rows, totals.duplicate_keys))
    merged = index.keys().agg(F.sum("n"), F.sum(F.when(F.col("n") > 1, F.col("n"))), F.count_if(F.col("n") > 1)).first()
    found.append((len(batches), *merged))
    return spark.createDataFrame(found, "step int, n_rows bigint, duplicate_rows bigint, duplicate_keys bigint")


# --- Samples ----------------------------------------------------------------------


@registered
def sample_orders(spark, sf):
    return sampling.sample_rows(load(spark, sf, "orders"), "o_orderkey", SAMPLE_SIZE, SEED)


def _sampled(spark, sf, *only: str) -> dict[str, DataFrame]:
    tables = {spec.name: load(spark, sf, spec.name) for spec in star_specs()}
    return cascade.cascade_sample(tables, star_specs(), "orders", SAMPLE_SIZE, SEED, only=only or None)


@registered
def sample_lineitem(spark, sf):
    """Items of the sampled orders: hash filter in the scan, then the exact semi-join."""
    orders = load(spark, sf, "orders")
    cut = sampling.find_cut(orders, "o_orderkey", SAMPLE_SIZE, SEED)
    picked = sampling.sample_rows(orders, "o_orderkey", SAMPLE_SIZE, SEED, cut)
    return sampling.rows_of_sample(load(spark, sf, "lineitem"), "l_orderkey", picked, "o_orderkey", SEED, cut)


@registered
def sample_customer(spark, sf):
    """Customers of the sampled orders."""
    return _sampled(spark, sf, "customer")["customer"]


@registered
def sample_part(spark, sf):
    return _sampled(spark, sf, "part")["part"]


@registered
def sample_supplier(spark, sf):
    return _sampled(spark, sf, "supplier")["supplier"]


@registered
def sample_nation(spark, sf):
    """Nations of sampled customers or sampled suppliers."""
    return _sampled(spark, sf, "nation")["nation"]


@registered
def sample_orphans(spark, sf):
    """Orphans on every edge of the sample: none."""
    return cascade.orphans_per_edge(_sampled(spark, sf), star_specs())


@registered
def sample_event_points(spark, sf):
    """Three events of each customer of the sample: a table reached by a weak reference."""
    events = TableSpec("events", tuple(Column(c) for c in load(spark, sf, "events").columns))
    specs = tuple(
        replace(s, foreign_keys=(*s.foreign_keys, ForeignKey("c_custkey", "events", "user_id", weak=True)))
        if s.name == "customer"
        else s
        for s in star_specs()
    )
    tables = {t: load(spark, sf, t) for t in (*TABLES, "events")}
    return cascade.cascade_sample(tables, (*specs, events), "orders", SAMPLE_SIZE, SEED, only=("events",))["events"]


# Tables whose references form other shapes than a tree, made of the given ones.
SHAPES = {
    "two_references": (
        {
            "customer": ("customer", "c_custkey"),
            "transfer": ("orders", "o_orderkey", "o_custkey AS payer", "o_custkey * 7 % 100 + 1 AS payee"),
        },
        (("transfer", "payer", "customer"), ("transfer", "payee", "customer")),
    ),
    "self_reference": (
        {
            "customer": ("customer", "c_custkey", "nullif(c_custkey div 2, 0) AS c_boss"),
            "orders": ("orders", "o_orderkey", "o_custkey"),
        },
        (("orders", "o_custkey", "customer"), ("customer", "c_boss", "customer")),
    ),
    "reference_cycle": (
        {
            "customer": ("customer", "c_custkey", "c_custkey % 10 + 1 AS c_suppkey"),
            "supplier": ("supplier", "s_suppkey", "s_suppkey * 3 AS s_partkey"),
            "part": ("part", "p_partkey", "p_partkey div 2 + 1 AS p_custkey"),
        },
        (
            ("customer", "c_suppkey", "supplier"),
            ("supplier", "s_partkey", "part"),
            ("part", "p_custkey", "customer"),
        ),
    ),
}


def _shape(spark, sf, shape: str) -> tuple[dict[str, DataFrame], tuple[TableSpec, ...]]:
    sources, edges = SHAPES[shape]
    tables = {t: load(spark, sf, source).selectExpr(*columns) for t, (source, *columns) in sources.items()}
    keys_of = {t: columns[0] for t, (_, *columns) in sources.items()}
    specs = tuple(
        TableSpec(
            t,
            tuple(Column(c) for c in df.columns),
            key=(keys_of[t],),
            foreign_keys=tuple(ForeignKey(c, parent, keys_of[parent]) for child, c, parent in edges if child == t),
        )
        for t, df in tables.items()
    )
    return tables, specs


def _closed(spark, sf, shape: str) -> tuple[dict[str, DataFrame], tuple[TableSpec, ...]]:
    tables, specs = _shape(spark, sf, shape)
    return cascade.cascade_sample(tables, specs, "customer", 50, SEED), specs


def _keys_of_sample(spark, sf, shape: str) -> DataFrame:
    sample, specs = _closed(spark, sf, shape)
    return reduce(
        DataFrame.unionByName,
        [sample[s.name].select(F.lit(s.name).alias("table_name"), F.col(s.key[0]).alias("key")) for s in specs],
    )


@registered
def sample_two_references(spark, sf):
    """A table with two references to the sampled one: rows of either, and the customers both need."""
    return _keys_of_sample(spark, sf, "two_references")


@registered
def sample_self_reference(spark, sf):
    """A sampled table that refers to itself: all superiors come along, their orders do not."""
    return _keys_of_sample(spark, sf, "self_reference")


@registered
def sample_reference_cycle(spark, sf):
    """Three tables that refer to each other in a circle."""
    return _keys_of_sample(spark, sf, "reference_cycle")


@registered
def sample_shape_orphans(spark, sf):
    """Orphans on every edge of the three samples above: none."""
    parts = []
    for shape in SHAPES:
        found = cascade.orphans_per_edge(*_closed(spark, sf, shape))
        parts.append(found.select(F.lit(shape).alias("shape"), "edge", "n_rows", "n_orphans"))
    return reduce(DataFrame.unionByName, parts)


@registered
def sampled_files(spark, sf):
    """All tables out to CSV, then sampled from there: rows by table in the manifest of the source and in the sample."""
    folder = new_run_folder(spark, "sample")
    specs = tuple(replace(s, lookup=s.name == "region") for s in star_specs())
    for spec in specs:
        csv.write_csv(text_table(spark, sf, spec.name), f"{folder}/in/{spec.file_name}")
    sample = cascade.sample_files(spark, f"{folder}/in", f"{folder}/out", specs, "orders", SAMPLE_SIZE, SEED)
    listed = manifest.csv_manifest(spark, f"{folder}/in", specs)
    by_table = listed.groupBy(F.substring_index("file_name", ".", 1).alias("table_name"))
    source = cut_lineage(by_table.agg(F.sum("rows").alias("source_rows")))
    measured = (F.col("bytes") > 0) & (F.col("kilobytes") == F.col("bytes") / 1024)
    return sample.join(source, "table_name").select(
        "table_name", "source_rows", F.col("n_rows").alias("sample_rows"), measured.alias("is_measured")
    )


@registered
def stage_check_only(spark, sf):
    """The checks of staging alone: every table's rows in the report, no problem, and nothing published."""
    root = new_run_folder(spark, "check")
    specs = star_specs(strict=False)
    report = staging.stage(spark, text_tables(spark, sf), specs, root, "r1", check_only=True, compare_rows=True)
    published = publish.published_tables(spark, root).count()
    counted = report.where("rule = 'row_count'").select("table_name", "n_rows")
    problems = report.where("severity = 'error' AND n_violations > 0").count()
    return counted.select("*", F.lit(problems).alias("n_problems"), F.lit(published).alias("n_published"))


@registered
def events_three_per_user(spark, sf):
    """At most three events per user, in text order of the value."""
    return ranked.points_per_area(load(spark, sf, "events"), "user_id", "value")


@registered
def events_three_per_user_numeric(spark, sf):
    return ranked.points_per_area(load(spark, sf, "events"), "user_id", "value", numeric=True)


@registered
def nations_in_use(spark, sf):
    """Distinct union of the nation keys of customers and suppliers."""
    return keys.union_of_keys(
        (load(spark, sf, "customer"), "c_nationkey"), (load(spark, sf, "supplier"), "s_nationkey")
    ).withColumnRenamed("key", "nation_key")


# --- Profiles ---------------------------------------------------------------------


@registered
def profile_customer(spark, sf):
    return profile.profile_columns(text_table(spark, sf, "customer"), "customer")


@registered
def profile_part(spark, sf):
    return profile.profile_columns(text_table(spark, sf, "part", dirty=True), "part")


@registered
def profile_orders(spark, sf):
    return profile.profile_columns(text_table(spark, sf, "orders"), "orders")


@registered
def profile_lineitem(spark, sf):
    return profile.profile_columns(text_table(spark, sf, "lineitem"), "lineitem")


@registered
def profile_estimates(spark, sf):
    """Whether the estimated number of distinct values is within a fifth of the exact one."""
    exact = profile.profile_columns(text_table(spark, sf, "lineitem"), "lineitem")
    estimate = profile.profile_columns(text_table(spark, sf, "lineitem"), "lineitem", approximate=True)
    both = exact.join(estimate.select("column_name", F.col("n_distinct").alias("estimate")), "column_name")
    return both.select(
        "column_name", (F.abs(F.col("estimate") - F.col("n_distinct")) <= F.col("n_distinct") / 5).alias("is_close")
    )


@registered
def profile_lineitem_approximate(spark, sf):
    """The single-pass profile; its distinct counts are estimates."""
    found = profile.profile_columns(text_table(spark, sf, "lineitem"), "lineitem", approximate=True)
    return found.drop("n_distinct")


@registered
def profile_merged(spark, sf):
    """The profile of line items from stored sketches of three parts, and whether its estimates are close."""
    items, folder = text_table(spark, sf, "lineitem"), new_run_folder(spark, "sketches")
    for part in range(3):
        profile.sketch_columns(items.where(f"l_orderkey % 3 = {part}")).write.parquet(f"{folder}/{part}")
    stored = [spark.read.parquet(f"{folder}/{part}") for part in range(3)]
    found = profile.profile_of_sketches(profile.merge_sketches(*stored), "lineitem")
    exact = profile.profile_columns(items, "lineitem").select("column_name", F.col("n_distinct").alias("exact"))
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") / 10
    return found.join(exact, "column_name").withColumn("is_close", close).drop("n_distinct", "exact")


@registered
def null_patterns(spark, sf):
    """Which columns of the parts are null together."""
    return profile.null_patterns(spoiled(load(spark, sf, "part"), "part"))


@registered
def relationship_cardinality(spark, sf):
    tables = {spec.name: load(spark, sf, spec.name) for spec in star_specs()}
    return profile.relationship_cardinality(tables, star_specs())


# --- Duplicates -------------------------------------------------------------------


def _text_digest() -> F.Column:
    return F.sha2(F.col("text"), 256)


@registered
def duplicate_documents(spark, sf):
    """Texts that occur more than once; whole texts are compared by their digest."""
    digests = load(spark, sf, "documents").select(_text_digest().alias("text_sha256"))
    return keys.duplicate_keys(digests, ["text_sha256"])


@registered
def latest_documents(spark, sf):
    """One document per text, the one with the highest id."""
    return ranked.latest_by_id(load(spark, sf, "documents"), _text_digest(), "doc_id")


@registered
def latest_event_per_user(spark, sf):
    """One row per key without a row id: the newest, other columns as tie-break."""
    return ranked.latest_per_key(load(spark, sf, "events"), ["user_id"], [F.col("ts").desc()])


# --- Business questions -----------------------------------------------------------


def _user_centroids(spark, sf) -> DataFrame:
    return business.centroids(load(spark, sf, "events"), "user_id", F.col("value"), F.hour("ts"))


@registered
def user_centroids(spark, sf):
    """Mean position of the many points of each key."""
    return _user_centroids(spark, sf)


@registered
def customer_centroids(spark, sf):
    """Centroids attached to customers; customers without points stay."""
    return business.attach(
        load(spark, sf, "customer").select("c_custkey", "c_nationkey"), _user_centroids(spark, sf), "c_custkey", "user_id"
    )




@registered
def order_totals(spark, sf):
    return business.order_totals(
        load(spark, sf, "lineitem"), "l_orderkey", price=F.col("l_extendedprice"), quantity=F.col("l_quantity")
    )


@registered
def event_mix(spark, sf):
    """Events, amount and the kinds of event per user."""
    return business.payments_per_order(
        load(spark, sf, "events"), "user_id", "event_type", EVENT_TYPES, F.col("value"), F.length("props")
    )


def _dated_items(spark, sf, *columns: str) -> DataFrame:
    return business.attach(
        load(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", *columns),
        load(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
        "l_orderkey",
        "o_orderkey",
    )


@registered
def ship_delay(spark, sf):
    """Items per whole days between order and shipment."""
    late = business.days_late(F.col("l_shipdate"), F.col("o_orderdate"))
    return (
        _dated_items(spark, sf)
        .groupBy(late.cast("int").alias("days_late"))
        .agg(F.count(F.lit(1)).alias("n_items"))
    )


@registered
def order_stage(spark, sf):
    """How far each order got: dates are blanked by status, then read back as a stage."""
    dates = load(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("approved"),
        F.when(F.col("o_orderstatus").isin("F", "P"), F.col("o_orderdate")).alias("posted"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("delivered"),
    )
    return dates.select(
        "o_orderkey", business.order_stage(F.col("approved"), F.col("posted"), F.col("delivered")).alias("stage")
    )


@registered
def customer_value(spark, sf):
    totals = business.order_totals(load(spark, sf, "lineitem"), "l_orderkey", total=F.col("l_extendedprice"))
    return business.customer_value(
        load(spark, sf, "orders"),
        "o_custkey",
        "o_orderkey",
        totals.withColumnRenamed("l_orderkey", "o_orderkey"),
        "total",
    )


def _sales(spark, sf, key: str) -> DataFrame:
    return business.sales_by(
        load(spark, sf, "lineitem"), key, revenue=F.col("l_extendedprice"), quantity=F.col("l_quantity")
    )


@registered
def part_sales(spark, sf):
    return _sales(spark, sf, "l_partkey")


@registered
def supplier_sales(spark, sf):
    return _sales(spark, sf, "l_suppkey")


@registered
def best_parts(spark, sf):
    """The ten parts that sold for most."""
    return business.best_sellers(_sales(spark, sf, "l_partkey"), "l_partkey", "revenue", 10)


@registered
def customer_nation_names(spark, sf):
    """Nation names of customers; a code without a name keeps itself."""
    coded = load(spark, sf, "customer").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 50 = 0 THEN -1 ELSE c_nationkey END").alias("c_nationkey")
    )
    return business.translate(coded, "c_nationkey", load(spark, sf, "nation"), "n_nationkey", "n_name", "nation")


LISTING = {"p_brand": "unknown", "p_type": "unknown", "p_retailprice": 0.0}


def _listings(spark, sf, how: str) -> DataFrame:
    columns = ("p_partkey", "p_brand", "p_type", "p_retailprice")
    return business.complete_listings(spoiled(load(spark, sf, "part"), "part").select(*columns), LISTING, how)


@registered
def part_listing_flag(spark, sf):
    return _listings(spark, sf, "flag")


@registered
def part_listing_fill(spark, sf):
    return _listings(spark, sf, "fill")


@registered
def part_listing_drop(spark, sf):
    return _listings(spark, sf, "drop")


@registered
def mart_fact_lineitem(spark, sf):
    """The fact joined to its dimensions and rolled up by month, brand and nation."""
    dated = _dated_items(spark, sf, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    branded = business.attach(dated, load(spark, sf, "part").select("p_partkey", "p_brand"), "l_partkey", "p_partkey")
    placed = business.attach(
        branded, load(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "l_suppkey", "s_suppkey"
    )
    return placed.groupBy(
        F.trunc("o_orderdate", "month").alias("order_month"), "p_brand", "s_nationkey"
    ).agg(
        F.count(F.lit(1)).alias("n_items"),
        business.money_sum(F.col("l_quantity")).alias("quantity"),
        business.money_sum(F.col("l_extendedprice")).alias("revenue"),
    )


@registered
def mart_dim_customer(spark, sf):
    """Customers with nation name, orders, lifetime value and repeat flag."""
    named = business.translate(
        load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"),
        "c_nationkey", load(spark, sf, "nation"), "n_nationkey", "n_name", "nation",
    )
    valued = business.attach(named, customer_value(spark, sf), "c_custkey", "o_custkey")
    return valued.fillna({"n_orders": 0, "is_repeat": False}).withColumn(
        "lifetime_value", F.coalesce("lifetime_value", F.lit(0)).cast(business.MONEY)
    )


def _as_marketplace(spark, sf) -> dict[str, DataFrame]:
    """The star tables under the names the mart reads; events stand for payments, reviews and places."""
    events = load(spark, sf, "events")
    kinds = F.expr(
        "CASE event_type WHEN 'click' THEN 'credit_card' WHEN 'view' THEN 'boleto' "
        "WHEN 'purchase' THEN 'voucher' ELSE event_type END"
    )
    blank = {"order_approved_at": "o_orderpriority <> '5-LOW'"}
    blank |= {"order_delivered_carrier_date": "o_orderstatus IN ('F', 'P')"}
    blank |= {"order_delivered_customer_date": "o_orderstatus = 'F'"}
    part = spoiled(load(spark, sf, "part"), "part")
    return {
        "orders": load(spark, sf, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            *[F.when(F.expr(test), F.col("o_orderdate")).alias(c) for c, test in blank.items()],
            F.expr("o_orderdate - INTERVAL 3 DAYS").alias("order_estimated_delivery_date"),
        ),
        "order_items": load(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
            F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
        ),
        "order_payments": events.select(
            F.col("user_id").alias("order_id"),
            kinds.alias("payment_type"),
            F.col("value").alias("payment_value"),
            F.length("props").alias("payment_installments"),
        ),
        # A review belongs to two events, and so to two orders.
        "order_reviews": events.select(
            F.expr("event_id DIV 2").alias("review_id"),
            F.col("user_id").alias("order_id"),
            F.expr("event_id % 5 + 1").alias("review_score"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("review_answer_timestamp"),
        ),
        "customers": load(spark, sf, "customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.expr("c_custkey DIV 3").alias("customer_unique_id"),
            F.expr("c_custkey % 100").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("c_nationkey").alias("customer_state"),
        ),
        "products": part.select(
            F.col("p_partkey").alias("product_id"),
            F.expr("cast(cast(p_partkey % 40 AS int) AS string)").alias("product_category_name"),
            F.col("p_size").alias("product_name_lenght"),
            F.length("p_brand").alias("product_description_lenght"),
            F.length("p_type").alias("product_photos_qty"),
        ),
        "product_category_translation": load(spark, sf, "nation").select(
            F.col("n_nationkey").cast("string").alias("product_category_name"),
            F.col("n_name").alias("product_category_name_english"),
        ),
        "sellers": load(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("seller_id"), F.col("s_nationkey").alias("seller_zip_code_prefix")
        ),
        "geolocation": events.select(
            F.col("user_id").alias("geolocation_zip_code_prefix"),
            F.col("value").alias("geolocation_lat"),
            F.hour("ts").alias("geolocation_lng"),
        ),
    }


@registered
def mart_orders(spark, sf):
    """The order fact: stage, delay, totals, payments and the latest review score of every order."""
    return mart.build_mart(_as_marketplace(spark, sf))["fact_orders"]


@registered
def mart_order_items(spark, sf):
    """The item fact with the order's customer, day, stage and status."""
    return mart.build_mart(_as_marketplace(spark, sf))["fact_order_items"]


@registered
def mart_reviews(spark, sf):
    """One row per review id, the one answered last."""
    return mart.build_mart(_as_marketplace(spark, sf))["dim_review"]


@registered
def mart_people(spark, sf):
    """One row per person with lifetime value, latest address and the centre of its area."""
    return mart.build_mart(_as_marketplace(spark, sf))["dim_customer"]


@registered
def mart_products(spark, sf):
    """Products with translated category and flags for empty listing fields."""
    return mart.build_mart(_as_marketplace(spark, sf))["dim_product"]


@registered
def mart_sellers(spark, sf):
    return mart.build_mart(_as_marketplace(spark, sf))["dim_seller"]


@registered
def mart_dim_date(spark, sf):
    return business.calendar(load(spark, sf, "orders"), "o_orderdate")


# --- Files ------------------------------------------------------------------------

STAR_FILES = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")


def _manifest(spark, sf) -> DataFrame:
    return manifest.parquet_manifest(spark, sf, [f"{t}.parquet" for t in STAR_FILES])


@registered
def file_manifest(spark, sf):
    """Name, bytes, rows and SHA-256 of the table files, sorted by name."""
    return _manifest(spark, sf).orderBy("file_name")


@registered
def file_manifest_totals(spark, sf):
    """Rows by table from the manifest, and whether each of its files has bytes and a digest of its own."""
    entries = _manifest(spark, sf).withColumn("table_file", F.substring_index("file_name", "/", 1))
    return entries.groupBy("table_file").agg(
        F.sum("rows").alias("n_rows"),
        (F.min("bytes") > 0).alias("has_bytes"),
        (F.count_distinct("sha256") == F.count(F.lit(1))).alias("has_digests"),
    )


@registered
def manifest_comparison(spark, sf):
    """The files against a written manifest with one altered, one lost and one added entry."""
    path = f"{new_run_folder(spark, 'manifest')}/manifest"
    actual = _manifest(spark, sf)
    altered = actual.select(
        F.when(F.col("file_name") == "part.parquet", F.lit("parts.parquet")).otherwise(F.col("file_name")).alias("file_name"),
        "bytes",
        F.when(F.col("file_name") == "orders.parquet", F.col("rows") + 1).otherwise(F.col("rows")).alias("rows"),
        "sha256",
    )
    manifest.write_manifest(altered, path, RUN_TS, SAMPLE_SIZE, dataset="star")
    return manifest.compare_manifests(manifest.read_manifest(spark, path), actual)


@registered
def csv_records_per_file(spark, sf):
    """Records of multi-line CSV files, counted by record and not by line, in total."""
    spec = TableSpec("documents", (Column("doc_id"), Column("text")), multiline=True)
    path = f"{new_run_folder(spark, 'records')}/documents.csv"
    csv.write_csv(load(spark, sf, "documents").select("doc_id", "text"), path)
    return csv.records_per_file(spark, path, spec).agg(F.sum("rows").alias("n_records"))


@registered
def table_file_completeness(spark, sf):
    """Expected files against the files the rows of the tables come from, with their rows."""
    expected = [f"{t}.parquet" for t in (*STAR_FILES, "geolocation")]
    lost = files.missing_files(spark, sf, expected)
    present = sorted(set(expected) - {r.file_name for r in lost.collect()})
    counted = [
        spark.read.parquet(f"{sf}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("file_name", F.lit(name))
        for name in present
    ]
    there = reduce(DataFrame.unionByName, counted).withColumn("status", F.lit("present"))
    gone = lost.withColumns({"n_rows": F.lit(0).cast("bigint"), "status": F.lit("missing")})
    return there.unionByName(gone).select("file_name", "n_rows", "status")
