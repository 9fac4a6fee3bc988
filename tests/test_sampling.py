"""Samples: exact size, repeatable, and with every reference intact."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import market
from quayside.marketplace import marketplace_specs
from quayside.operators import closure, keys, ranked, sampling
from quayside.plans import cascade
from quayside.sources import csv
from quayside.spec import Column, ForeignKey, TableSpec

SPECS = marketplace_specs()


def smallest(values, n, seed):
    return sorted(values, key=lambda v: (hashlib.md5(f"{seed}:{v}".encode()).hexdigest(), str(v)))[:n]


@pytest.mark.parametrize("n", [0, 1, 7, 500, 999, 1000, 5000])
def test_sample_is_the_n_smallest_hashes(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = sorted(r.k for r in sampling.sample_rows(df, "k", n, 42).collect())
    assert got == sorted(smallest(range(1000), n, 42))


def test_partitioning_changes_nothing_and_the_seed_does(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    picks = [
        {r.k for r in sampling.sample_rows(d, "k", 100, seed).collect()}
        for d, seed in ((df, 1), (df.repartition(17), 1), (df.coalesce(1), 1), (df, 2))
    ]
    assert picks[0] == picks[1] == picks[2] != picks[3]


def test_narrowing_goes_on_while_a_bucket_is_large(spark, monkeypatch):
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(sampling, "FINAL_BUCKET_ROWS", 3)
    df = spark.range(3000).withColumnRenamed("id", "k")
    got = sorted(r.k for r in sampling.sample_rows(df, "k", 777, 42).collect())
    assert got == sorted(smallest(range(3000), 777, 42))


@pytest.mark.parametrize("n", [1, 10, 400, 599, 600, 601, 650])
def test_a_key_that_fills_most_rows_still_gives_n_rows(spark, monkeypatch, n):
    monkeypatch.setattr(sampling, "FINAL_BUCKET_ROWS", 50)
    df = spark.sql("select case when id < 600 then -1 else id end as k, id as v from range(700)")
    assert sampling.sample_rows(df, "k", n, 3).count() == n


def test_rows_of_a_split_key_do_not_depend_on_partitioning(spark):
    df = spark.sql("select case when id < 600 then -1 else id end as k, id as v from range(700)")
    picks = [
        {r.v for r in sampling.sample_rows(d, "k", 640, 3).collect()} for d in (df, df.repartition(13))
    ]
    assert len(picks[0]) == 640 and picks[0] == picks[1]


def test_rows_alike_in_every_column_can_be_split(spark):
    df = spark.sql("select 5 as k, 'same' as v from range(300)")
    assert sampling.sample_rows(df, "k", 120, 3).count() == 120


def test_a_large_k_cuts_a_hot_group_in_pieces(spark):
    df = spark.sql("select case when id % 2 = 0 then 1 else id end as g, hash(id) as v, id from range(20000)")
    k = ranked.PARTIAL_LIMIT + 500
    kept = ranked.top_per_group(df, ["g"], [df.v, df.id], k)
    expected = sorted((r.v, r.id) for r in df.where("g = 1").collect())[:k]
    assert sorted((r.v, r.id) for r in kept.where("g = 1").collect()) == expected
    assert kept.columns == df.columns and kept.where("g <> 1").count() == df.where("g <> 1").count()


def test_null_keys_are_rows_too(spark):
    df = spark.sql("select case when id % 2 = 0 then null else id end as k, id as v from range(40)")
    for n in (5, 20, 30, 39):
        assert sampling.sample_rows(df, "k", n, 3).count() == n


def test_children_are_exact_although_orphans_pass_the_hash_filter(spark):
    parents = spark.range(0, 1000, 2).withColumnRenamed("id", "k")
    children = spark.sql("select id % 1000 as k, id from range(5000)")
    cut = sampling.find_cut(parents, "k", 50, 9)
    picked = sampling.sample_rows(parents, "k", 50, 9, cut)
    got = sampling.rows_of_sample(children, "k", picked, "k", 9, cut)
    assert got.count() == 250
    assert got.exceptAll(keys.in_keys(children, "k", picked, "k")).count() == 0


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sample")
    source = market.write(folder / "full", market.tables(300))
    full = {s.name: csv.read_by_position(spark, f"{source}/{s.file_name}", s) for s in SPECS}
    return full, cascade.cascade_sample(full, SPECS, "orders", 60, 0.42), folder


def test_cascade_keeps_every_reference(spark, sample):
    full, cut, _ = sample
    assert set(cut) == set(full)
    assert cut["orders"].count() == 60 and cut["customers"].count() == 60
    orphans = cascade.orphans_per_edge(cut, SPECS).collect()
    assert len(orphans) == 6 and all(r.n_orphans == 0 for r in orphans)
    assert cut["product_category_translation"].count() == full["product_category_translation"].count()
    for child in ("order_items", "order_payments", "order_reviews"):
        expected = keys.in_keys(full[child], "order_id", cut["orders"], "order_id")
        assert cut[child].exceptAll(expected).count() == expected.exceptAll(cut[child]).count() == 0
    used = {r.product_id for r in cut["order_items"].collect()}
    assert {r.product_id for r in cut["products"].collect()} == used


def test_cascade_keeps_three_points_per_area_in_use(sample):
    full, cut, _ = sample
    areas = {r[0] for r in cut["customers"].select("customer_zip_code_prefix").collect()}
    areas |= {r[0] for r in cut["sellers"].select("seller_zip_code_prefix").collect()}
    kept = cut["geolocation"].groupBy("geolocation_zip_code_prefix").count().collect()
    assert {r[0] for r in kept} == areas and {r[1] for r in kept} == {3}


def test_points_are_ordered_as_text_by_default(spark):
    df = spark.createDataFrame([("z", v) for v in ("-10.2", "-23.5", "-3.1", "-4.0")], "zip string, lat string")
    text = [r.lat for r in ranked.points_per_area(df, "zip", "lat").collect()]
    number = [r.lat for r in ranked.points_per_area(df, "zip", "lat", numeric=True).collect()]
    assert sorted(text) == ["-10.2", "-23.5", "-3.1"]
    assert sorted(number) == ["-10.2", "-23.5", "-4.0"]


def test_written_sample_is_read_back_and_checked(spark, sample):
    _, cut, folder = sample
    report = {r.table_name: r for r in cascade.write_sample(spark, cut, SPECS, str(folder / "out")).collect()}
    assert report["orders"].n_rows == 60 and report["order_reviews"].n_rows == 60
    assert all(r.bytes > 0 for r in report.values())


def test_a_sample_with_orphans_is_refused(spark, sample):
    _, cut, folder = sample
    broken = {**cut, "customers": cut["customers"].limit(5)}
    with pytest.raises(cascade.OrphansFound, match="orders.customer_id"):
        cascade.write_sample(spark, broken, SPECS, str(folder / "broken"))


def keyed(name, columns, *edges):
    return TableSpec(name, tuple(map(Column, columns)), (columns[0],), tuple(ForeignKey(*e) for e in edges))


def closed(rows, edges, chosen):
    """Keys of all rows that must be there, by following one row after the other."""
    found = {(t, k) for t, ks in chosen.items() for k in ks}
    todo = list(found)
    for table, key in todo:
        for child, column, parent in edges:
            target = rows[child].get(key, {}).get(column) if child == table else None
            if target in rows[parent] and (parent, target) not in found:
                found.add((parent, target))
                todo.append((parent, target))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_closure_of_random_references(spark, seed):
    pick = random.Random(seed)
    names = ["a", "b", "c"]
    edges = [(pick.choice(names), f"r{i}", pick.choice(names)) for i in range(5)]
    rows = {
        t: {k: {c: pick.choice([None, *range(70)]) for child, c, _ in edges if child == t} for k in range(60)} for t in names
    }
    tables = {}
    for t in names:
        columns = ["k", *[c for child, c, _ in edges if child == t]]
        data = [(k, *[row[c] for c in columns[1:]]) for k, row in rows[t].items()]
        tables[t] = spark.createDataFrame(data, ", ".join(f"{c} bigint" for c in columns)).repartition(3)
    chosen = {"a": [0, 1, 2], "b": [5]}
    start = {t: tables[t].where(F.col("k").isin(ks)) for t, ks in chosen.items()}
    found = closure.close_references(tables, [closure.Edge(c, col, p, "k") for c, col, p in edges], start)
    got = {(t, k) for t, ks in chosen.items() for k in ks}
    for t in names:
        added = closure.rows_added(tables[t], t, found)
        more = [(t, r.k) for r in added.collect()] if added is not None else []
        assert len(set(more)) == len(more) and not got & set(more)
        got |= set(more)
    assert got == closed(rows, edges, chosen)


def test_rounds_are_as_many_as_the_longest_chain(spark):
    chain = spark.sql("select id as k, nullif(id - 1, -1) as before from range(50)")
    edges = [closure.Edge("t", "before", "t", "k")]
    found = closure.close_references({"t": chain}, edges, {"t": chain.where("k in (12, 9)")})
    assert found.rounds == 9 and closure.rows_added(chain, "t", found).count() == 11
    nothing = closure.close_references({"t": chain}, edges, {"t": chain.where("k = 0")})
    assert nothing.rounds == 0 and closure.rows_added(chain, "t", nothing) is None
    ring = spark.sql("select id as k, (id + 1) % 7 as before from range(7)")
    assert closure.close_references({"t": ring}, edges, {"t": ring.where("k = 3")}).rounds == 6


def test_references_to_two_columns_of_one_table(spark):
    parent = spark.sql("select id as k, id + 100 as code, nullif(id + 101, 110) as next from range(10)")
    child = spark.sql("select 3 as k, 106 as code union all select 4, null")
    edges = [
        closure.Edge("child", "k", "parent", "k"),
        closure.Edge("child", "code", "parent", "code"),
        closure.Edge("parent", "next", "parent", "code"),
    ]
    found = closure.close_references({"parent": parent}, edges, {"child": child})
    assert sorted(r.k for r in closure.rows_added(parent, "parent", found).collect()) == [3, 4, 5, 6, 7, 8, 9]


def test_a_second_reference_a_self_reference_and_dirty_keys(spark):
    people = spark.sql("select id as k, case when id % 5 = 0 then id + 1000 else id div 2 end as boss from range(1, 400)")
    deals = spark.sql("select id as d, id % 400 as buyer, (id * 7) % 399 + 1 as seller from range(900)")
    specs = (
        keyed("people", ["k", "boss"], ("boss", "people", "k")),
        keyed("deals", ["d", "buyer", "seller"], ("buyer", "people", "k"), ("seller", "people", "k")),
    )
    cut = cascade.cascade_sample({"people": people, "deals": deals}, specs, "people", 20, 1)
    drawn = set(smallest(range(1, 400), 20, 1))
    kept = {r.d for r in cut["deals"].collect()}
    assert kept == {d for d in range(900) if d % 400 in drawn or (d * 7) % 399 + 1 in drawn}
    wanted = drawn | {d % 400 for d in kept} | {(d * 7) % 399 + 1 for d in kept}
    todo = list(wanted)
    for k in todo:
        boss = k + 1000 if k % 5 == 0 else k // 2
        if boss not in wanted and k in range(1, 400):
            wanted.add(boss)
            todo.append(boss)
    got = [r.k for r in cut["people"].collect()]
    assert len(got) == len(set(got)) and set(got) == wanted & set(range(1, 400))


def test_a_hot_parent_and_repeated_parent_rows(spark):
    people = spark.sql("select case when id < 300 then 1 else id end as k, id as v from range(1, 900)")
    deals = spark.sql("select id as d, 1 as buyer, id % 880 as seller from range(500)")
    specs = (
        keyed("people", ["k", "v"]),
        keyed("deals", ["d", "buyer", "seller"], ("buyer", "people", "k"), ("seller", "people", "k")),
    )
    cut = cascade.cascade_sample({"people": people, "deals": deals}, specs, "deals", 40, 1)
    assert cut["deals"].count() == 40
    sellers = {r.seller for r in cut["deals"].collect()} & set(range(300, 900))
    assert sorted(r.v for r in cut["people"].collect()) == [*range(1, 300), *sorted(sellers)]
