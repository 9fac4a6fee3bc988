"""Records that do not fit: found, told apart, diverted; and files split anywhere."""

import random

import pytest
from pyspark.sql import functions as F
from test_files import RUN_TS

import market
from quayside.marketplace import marketplace_specs
from quayside.plans import cascade, intake, landing, publish, staging
from quayside.sources import csv, records
from quayside.spec import Column, TableSpec

BODY = (
    b'\xef\xbb\xbfa,b\r\n'
    b'1,"x\r\ny ""q"" \n z"\r\n'
    b"2,plain\n\n"
    b'3,"",EXTRA\n'
    b"4\n"
    b"5,bad\xff\xfe\n"
    b'6,"long ' + b"line\n" * 40 + b'"\n'
    b"7,\xef\xbf\xbd\n"
    b'"8",end'
)


def spec(multiline=True, name="t"):
    return TableSpec(name, (Column("a"), Column("b")), file_name=f"{name}.csv", multiline=multiline)


@pytest.fixture(params=[97, 1 << 20])
def split_bytes(spark, request):
    """Files are cut into splits of this size."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(request.param))
    yield request.param
    spark.conf.set(key, before)


def rejects_of(df):
    return sorted((r.file_name, r.offset, r.reason, bytes(r.record)) for r in df.collect())


def test_records_and_offsets_whatever_the_splits(spark, tmp_path, split_bytes):
    (tmp_path / "t.csv").write_bytes(BODY)
    found = records.find_records(spark, str(tmp_path / "t.csv"), True)
    rows = sorted((r.offset, bytes(r.record), r.is_header) for r in found.rows.withColumn("record", F.col("record").cast("binary")).collect())
    assert found.irregular == [] and len(rows) == 9
    assert [r[2] for r in rows] == [True] + [False] * 8 and rows[0][0] == 3
    for offset, record, _ in rows:
        assert BODY[offset : offset + len(record)] == record


@pytest.mark.parametrize("named", [True, False])
def test_rows_and_rejects_are_all_records(spark, tmp_path, split_bytes, named):
    (tmp_path / "t.csv").write_bytes(BODY)
    taken = intake.take_in(spark, {"t": str(tmp_path / "t.csv")}, (spec(),), str(tmp_path / "out"), "r", named, ("no token",))
    kept = spark.read.parquet(taken.written["t"].path)
    assert kept.columns == ["a", "b"]
    assert {tuple(r) for r in kept.collect()} == {
        ("1", 'x\r\ny "q" \n z'), ("2", "plain"), ("6", "long " + "line\n" * 40), ("7", "�"), ("8", "end"),
    }
    wanted = [(b'3,"",EXTRA', intake.WRONG_LENGTH), (b"4", intake.WRONG_LENGTH), (b"5,bad\xff\xfe", intake.NOT_UTF8)]
    assert rejects_of(taken.rejects) == sorted(("t.csv", BODY.index(r), why, r) for r, why in wanted)
    assert taken.rejected == {"t": 3} and taken.written["t"].rows == 5


def test_lines_as_records_with_bad_bytes(spark, tmp_path):
    body = b"a,b\n1,x\n2,caf\xe9\n3,\xef\xbf\xbd ok\n4,z,EXTRA\n\n5,y\r\n"
    (tmp_path / "t.csv").write_bytes(body)
    taken = intake.take_in(spark, {"t": str(tmp_path / "t.csv")}, (spec(False),), str(tmp_path / "out"), "r")
    kept = spark.read.parquet(taken.written["t"].path)
    assert sorted(map(tuple, kept.collect())) == [("1", "x"), ("3", "� ok"), ("5", "y")]
    assert rejects_of(taken.rejects) == [
        ("t.csv", 8, intake.NOT_UTF8, b"2,caf\xe9"),
        ("t.csv", body.index(b"4,z"), intake.WRONG_LENGTH, b"4,z,EXTRA"),
    ]


@pytest.mark.parametrize(
    "body", ['a,b\n1,5" x 3"\n2,"y\nz"\n', 'a,b\n1,"never closed\n2,y\n', "a,b\r1,x\r2,y\r", 'a,b\n1,"x"y\n2,z\n', "a,b\n", ""]
)
def test_irregular_files_are_read_as_before(spark, tmp_path, split_bytes, body):
    (tmp_path / "a dir [1]").mkdir()
    path = tmp_path / "a dir [1]" / "t.csv"
    path.write_text(body, newline="")
    escaped = str(tmp_path / "a dir \\[1\\]" / "t.csv")
    before = csv.read_by_position(spark, escaped, spec(), keep_corrupt=True)
    good = sorted(map(tuple, before.where(f"{csv.CORRUPT} IS NULL").drop(csv.CORRUPT).collect()), key=repr)
    bad = sorted(r[csv.CORRUPT] for r in before.collect() if r[csv.CORRUPT] is not None)
    taken = intake.take_in(spark, {"t": escaped}, (spec(),), str(tmp_path / "out"), "r", tokens=("no token",))
    assert sorted(map(tuple, spark.read.parquet(taken.written["t"].path).collect()), key=repr) == good
    assert sorted(bytes(r.record).decode() for r in taken.rejects.collect()) == bad if bad else taken.rejects is None


def test_random_files_equal_the_reader_in_one_piece(spark, tmp_path, split_bytes):
    pick = random.Random(split_bytes)
    texts = ["", "x", "a,b", "line\nline", 'say "hi"', '"', "\n", "é\r\nü", ",", "  pad ", "\n\n\n"]
    rows = [(str(i), pick.choice(texts) + pick.choice(texts)) for i in range(60)]
    spark.createDataFrame(rows, "a string, b string").coalesce(2).write.option("header", True).option(
        "escape", '"'
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "t.csv"))
    before = csv.read_by_position(spark, str(tmp_path / "t.csv"), spec())
    taken = intake.take_in(spark, {"t": str(tmp_path / "t.csv")}, (spec(),), str(tmp_path / "out"), "r", tokens=("no token",))
    assert taken.rejects is None
    assert sorted(map(tuple, spark.read.parquet(taken.written["t"].path).collect()), key=repr) == sorted(
        map(tuple, before.collect()), key=repr
    )


def test_a_large_file_is_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        rows = spark.range(60_000).select(F.col("id").cast("string").alias("a"), F.expr("repeat('a \\n \"b\" ', 20)").alias("b"))
        csv.write_csv(rows.coalesce(1), str(tmp_path / "t.csv"))
        lines = records._lines(spark, str(tmp_path / "t.csv"))
        assert lines.select("file", "block").distinct().count() >= 8
        found = records.find_records(spark, str(tmp_path / "t.csv"), True)
        assert found.irregular == [] and found.rows.count() == 60_001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "p1").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "t.csv" / "p2").write_text('b,a\n1,"x\ny"\n')
    with pytest.raises(ValueError, match="p[12]"):
        intake.take_in(spark, {"t": str(tmp_path / "t.csv")}, (spec(),), str(tmp_path / "out"), "r", named=True)


def test_diverted_records_are_kept_by_landing_and_staging(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_bytes(BODY)
    (tmp_path / "in" / "u.csv").write_text("a,b\n1,x\n2\n")
    specs, root = (spec(), spec(False, "u")), str(tmp_path / "raw")
    with pytest.raises(landing.LandingFailed, match=r"t\.csv: 3 bad .* at byte .*; u\.csv: 1 bad"):
        landing.land_raw(spark, specs, str(tmp_path / "in"), root, "r1", RUN_TS)
    report = landing.land_raw(spark, specs, str(tmp_path / "in"), root, "r2", RUN_TS, on_reject=intake.DIVERT)
    assert {r.table_name: (r.n_rows, r.n_rejected) for r in report.collect()} == {"t": (5, 3), "u": (1, 1)}
    landed = publish.read_published(spark, root, "t")
    assert {r._source_file for r in landed.collect()} == {"t.csv"} and landed.count() == 5
    assert spark.read.parquet(f"{root}/rejects/run_id=r2").groupBy("table_name").count().collect()
    staged = str(tmp_path / "staged")
    with pytest.raises(staging.BrokenRecords):
        staging.stage_files(spark, str(tmp_path / "in"), specs, staged, "r1")
    staging.stage_files(spark, str(tmp_path / "in"), specs, staged, "r2", on_reject=intake.DIVERT)
    assert publish.read_published(spark, staged, "u").count() == 1
    assert spark.read.parquet(f"{staged}/rejects/run_id=r2").count() == 4


def test_sampling_stops_at_broken_records_or_diverts_them(spark, tmp_path):
    source = market.write(tmp_path / "full", market.tables(60))
    specs = marketplace_specs()
    items = next(s for s in specs if s.name == "order_items")
    with open(f"{source}/{items.file_name}", "a") as file:
        file.write("lost,LOST\n")
    with pytest.raises(staging.BrokenRecords, match="1 bad record"):
        cascade.sample_files(spark, str(source), str(tmp_path / "out"), specs, "orders", 10)
    cascade.sample_files(spark, str(source), str(tmp_path / "out"), specs, "orders", 10, on_reject=intake.DIVERT)
    assert [bytes(r.record) for r in spark.read.parquet(str(tmp_path / "out" / "_rejects")).collect()] == [b"lost,LOST"]


@pytest.mark.parametrize("multiline", [True, False])
def test_a_view_over_ragged_records_fails_by_file(spark, tmp_path, multiline):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y,EXTRA\n")
    csv.register_views(spark, str(tmp_path), (spec(multiline),))
    with pytest.raises(Exception, match=r"t\.csv"):
        spark.sql("select a from src_t").collect()


def test_records_per_file_of_split_and_irregular_files(spark, tmp_path, split_bytes):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "p 1").write_bytes(BODY)
    (tmp_path / "t.csv" / "p[2]").write_text('a,b\n1,5" x 3"\n2,"y\nz"\n')
    (tmp_path / "t.csv" / "p3").write_text("a,b\n")
    found = csv.records_per_file(spark, str(tmp_path / "t.csv"), spec())
    assert {r.file_name: r.rows for r in found.collect()} == {"p%201": 8, "p%5B2%5D": 2}
