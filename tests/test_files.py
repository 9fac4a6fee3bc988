"""CSV and file fixtures written into a temporary folder."""

import hashlib
from datetime import datetime

import pytest

from quayside.functions.text import EMPTY_TOKENS
from quayside.plans import landing, manifest, publish
from quayside.sources import csv, files
from quayside.spec import Column, TableSpec

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)


def spec(name="t", columns=("a", "b"), multiline=False, **options):
    return TableSpec(name, tuple(Column(c) for c in columns), file_name=f"{name}.csv", multiline=multiline, **options)


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
    return str(path)


def test_bom_crlf_and_no_final_newline(spark, tmp_path):
    path = put(tmp_path, "t.csv", b"\xef\xbb\xbfa,b\r\n1,x\r\n2,y")
    for df in (csv.read_by_position(spark, path, spec()), csv.read_by_name(spark, path, spec())):
        assert df.columns == ["a", "b"]
        assert sorted(map(tuple, df.collect())) == [("1", "x"), ("2", "y")]


def test_quotes_commas_newlines_and_leading_zeros(spark, tmp_path):
    path = put(tmp_path, "t.csv", 'a,b\n01037,"say ""hi"", twice"\n"line\nbreak",""\nz,\n')
    df = csv.read_by_position(spark, path, spec(multiline=True))
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(
        [("01037", 'say "hi", twice'), ("line\nbreak", None), ("z", None)], key=repr
    )
    assert csv.records_per_file(spark, path, spec(multiline=True)).first().rows == 3


def test_null_tokens_apply_to_staging_reads_only(spark, tmp_path):
    path = put(tmp_path, "t.csv", "a,b\nNA,None\nnan,x\n")
    by_name = csv.read_by_name(spark, path, spec())
    assert set(map(tuple, by_name.collect())) == {(None, None), (None, "x")}
    assert csv.read_by_position(spark, path, spec()).where("a = 'NA'").count() == 1
    assert csv.read_by_name(spark, path, spec(), EMPTY_TOKENS).where("a = 'NA'").count() == 1


def test_by_name_follows_the_header_and_allows_extra_columns(spark, tmp_path):
    path = put(tmp_path, "t.csv", "b,extra,a\nx,e,1\n")
    assert csv.read_by_name(spark, path, spec()).select("a", "b").first() == ("1", "x")


def test_views(spark, tmp_path):
    put(tmp_path, "t.csv", "a,b\n1,x\n")
    assert csv.register_views(spark, str(tmp_path), (spec(),)) == ["src_t"]
    assert spark.sql("select b from src_t").first().b == "x"


def test_landing_adds_lineage_and_is_repeatable(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "t.csv", "dirty header,b\n1,x\n2,\n")
    root = str(tmp_path / "raw")
    for run in ("r1", "r2"):
        report = landing.land_raw(spark, (spec(expected_rows=3),), str(tmp_path / "in"), root, run, RUN_TS, True)
        assert [(r.status, r.n_rows, r.matches_expected) for r in report.collect()] == [("landed", 2, False)]
    landed = publish.read_published(spark, root, "t")
    assert landed.columns == ["a", "b", "_source_file", "_ingested_at"]
    assert sorted(map(tuple, landed.collect())) == [("1", "x", "t.csv", RUN_TS), ("2", None, "t.csv", RUN_TS)]
    assert publish.preview(spark, root, "t", 1).count() == 1
    assert [tuple(r) for r in publish.published_tables(spark, root).collect()] == [("t", "version=r2/t", 2)]


def test_a_missing_file_is_skipped_and_keeps_the_old_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "t.csv", "a,b\n1,x\n")
    put(tmp_path / "in", "u.csv", "a,b\n1,x\n")
    specs, root = (spec(), spec("u")), str(tmp_path / "raw")
    landing.land_raw(spark, specs, str(tmp_path / "in"), root, "r1", RUN_TS)
    (tmp_path / "later").mkdir()
    put(tmp_path / "later", "u.csv", "a,b\n2,y\n3,z\n")
    report = landing.land_raw(spark, specs, str(tmp_path / "later"), root, "r2", RUN_TS)
    assert {r.table_name: r.status for r in report.collect()} == {"t": "skipped", "u": "landed"}
    assert publish.read_published(spark, root, "t").count() == 1
    assert publish.read_published(spark, root, "u").count() == 2


@pytest.mark.parametrize("name, row", [("short", "only"), ("long", "1,2,3")])
def test_a_record_of_the_wrong_length_stops_the_landing(spark, tmp_path, name, row):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "t.csv", "a,b\n1,x\n")
    root = str(tmp_path / "raw")
    landing.land_raw(spark, (spec(),), str(tmp_path / "in"), root, "r1", RUN_TS)
    put(tmp_path / "in", "t.csv", f"a,b\n1,x\n{row}\n")
    with pytest.raises(landing.LandingFailed, match=r"t\.csv: 1 bad record"):
        landing.land_raw(spark, (spec(),), str(tmp_path / "in"), root, "r2", RUN_TS)
    assert publish.read_pointer(spark, root)["run_id"] == "r1"
    assert publish.read_published(spark, root, "t").count() == 1


def test_a_run_cannot_overwrite_the_published_version(spark, tmp_path):
    root = str(tmp_path / "out")
    publish.publish(spark, {"t": spark.range(3)}, root, "r1")
    with pytest.raises(publish.PublishFailed):
        publish.publish(spark, {"t": spark.range(4)}, root, "r1")
    assert publish.read_published(spark, root, "t").count() == 3


def test_rows_in_must_equal_rows_stored(spark, tmp_path):
    root = str(tmp_path / "out")
    written = publish.write_version(spark, {"t": spark.range(3)}, root, "r1")
    wrong = {"t": publish.Written(written["t"].path, 4, {})}
    with pytest.raises(publish.PublishFailed, match="4 rows went in, 3 are stored"):
        publish.switch_pointer(spark, root, "r1", wrong)
    assert publish.read_pointer(spark, root)["run_id"] is None


CONTENT = {"a b.bin": b"x" * 10, "50%25 ü.bin": bytes(range(256)) * 50_000, "c.bin": b"", "d.zst": b"plain"}


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_files_of_any_size_and_name_are_hashed(spark, tmp_path, prefix):
    for name, data in CONTENT.items():
        put(tmp_path, name, data)
    expected = {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in CONTENT.items()}
    paths = [f"{prefix}{tmp_path / n}" for n in CONTENT]
    found = files.hash_files(spark, paths).collect()
    assert {r.file_name: (r.bytes, r.sha256) for r in found} == expected


def test_parts_of_folders_are_listed_even_if_empty_but_not_hidden_ones(spark, tmp_path):
    folder = tmp_path / "t a.csv"
    (folder / "day=1").mkdir(parents=True)
    for name, data in {"p1": "x", "p2": "", "_SUCCESS": "", ".p1.crc": "y", "day=1/p3": "zz"}.items():
        put(folder, name, data)
    found = files.hash_files(spark, [str(folder), str(tmp_path / "none")]).collect()
    assert {(r.path.removeprefix(str(folder)), r.bytes) for r in found} == {("/p1", 1), ("/p2", 0), ("/day=1/p3", 2)}


def test_paths_are_taken_apart_by_scheme():
    assert files.split_path("/a b%/c") == ("file:///", "/a b%/c")
    assert files.split_path("file:///a:b/c") == ("file:///", "/a:b/c")
    assert files.split_path("s3a://bucket/a b%20/c") == ("s3://bucket/", "a b%20/c")
    assert files.split_path("hdfs://host:8020/x/y") == ("hdfs://host:8020/", "x/y")


def test_a_scheme_that_cannot_be_read_is_refused_by_name(spark):
    with pytest.raises(ValueError, match="scheme dbfs"):
        files.hash_files(spark, ["/tmp", "dbfs:/x/y"])


def test_a_part_that_was_lost_or_emptied_is_seen(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    for name in ("p 1", "p2", "p3"):
        put(tmp_path / "t.csv", name, "a,b\n1,x\n")
    path = str(tmp_path / "manifest")
    manifest.write_manifest(manifest.csv_manifest(spark, str(tmp_path), (spec("t"),)), path, RUN_TS, 1)
    put(tmp_path / "t.csv", "p2", "")
    (tmp_path / "t.csv" / "p3").unlink()
    found = manifest.check_manifest(spark, path, str(tmp_path), (spec("t"),)).collect()
    assert {r.file_name: r.status for r in found} == {"t.csv/p 1": "ok", "t.csv/p2": "changed", "t.csv/p3": "missing"}


def test_all_broken_files_are_named(spark, tmp_path):
    (tmp_path / "in" / "t.csv").mkdir(parents=True)
    for i in range(25):
        put(tmp_path / "in" / "t.csv", f"p{i:02d}", f"a,b\n{i},x,EXTRA\n")
    with pytest.raises(landing.LandingFailed) as failed:
        landing.land_raw(spark, (spec(),), str(tmp_path / "in"), str(tmp_path / "raw"), "r1", RUN_TS)
    assert all(f"p{i:02d}: 1 bad record" in str(failed.value) for i in range(25))
    assert files.names_in(spark, str(tmp_path / "raw")) == []


def test_superseded_versions_are_removed_on_demand(spark, tmp_path):
    root = str(tmp_path / "out")
    for run in ("r1", "r2"):
        publish.publish(spark, {"t": spark.range(3)}, root, run)
    assert publish.remove_superseded(spark, root) == ["version=r1"]
    assert publish.remove_superseded(spark, root) == []
    assert publish.read_published(spark, root, "t").count() == 3


def test_a_failed_publication_leaves_no_version_behind(spark, tmp_path):
    root = str(tmp_path / "out")
    publish.publish(spark, {"t": spark.range(3)}, root, "r1")
    broken = spark.range(3).selectExpr("raise_error('no') AS x")
    with pytest.raises(Exception, match="no"):
        publish.publish(spark, {"t": broken}, root, "r2")
    assert not [n for n in files.names_in(spark, root) if n == "version=r2"]
    assert publish.read_published(spark, root, "t").count() == 3


def test_manifest_tells_changed_missing_and_unlisted_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    specs = tuple(spec(n) for n in ("same", "changed", "missing"))
    for s in specs:
        put(source, s.file_name, "a,b\n1,x\n")
    path = str(tmp_path / "manifest")
    built = manifest.csv_manifest(spark, str(source), specs)
    manifest.write_manifest(built, path, RUN_TS, 3000, dataset="d", license="l")
    assert {r.status for r in manifest.check_manifest(spark, path, str(source), specs).collect()} == {"ok"}
    put(source, "changed.csv", "a,b\n1,y\n")
    (source / "missing.csv").unlink()
    put(source, "unlisted.csv", "a,b\n1,x\n")
    found = manifest.check_manifest(spark, path, str(source), specs + (spec("unlisted"),)).collect()
    assert {r.file_name: (r.status, r.differs) for r in found} == {
        "same.csv": ("ok", None),
        "changed.csv": ("changed", "sha256"),
        "missing.csv": ("missing", None),
        "unlisted.csv": ("unlisted", None),
    }
    line = spark.read.json(path).orderBy("file_name").first()
    assert (line.generated_at, line.sample_orders, line.rows) == ("2024-05-06T07:08:09+00:00", 3000, 1)


def test_manifest_of_a_table_in_parts(spark, tmp_path):
    whole, parts = spec("whole"), spec("parts")
    put(tmp_path, "whole.csv", "a,b\n1,x\n")
    (tmp_path / "parts.csv").mkdir()
    put(tmp_path / "parts.csv", "p1", "a,b\n1,x\n2,y\n")
    put(tmp_path / "parts.csv", "p2", "a,b\n3,z\n")
    rows = manifest.csv_manifest(spark, str(tmp_path), (whole, parts)).collect()
    assert {r.file_name: r.rows for r in rows} == {"whole.csv": 1, "parts.csv/p1": 2, "parts.csv/p2": 1}
    with pytest.raises(FileNotFoundError, match="none.csv"):
        manifest.csv_manifest(spark, str(tmp_path), (whole, spec("none")))


def test_no_manifest_is_no_failure(spark, tmp_path):
    assert manifest.check_manifest(spark, str(tmp_path / "none.json"), str(tmp_path), ()) is None


def test_manifest_kept_as_one_object(spark, tmp_path):
    path = put(
        tmp_path, "m.json",
        '{\n "dataset": "d",\n "files": {\n "b.csv": {"bytes": 2, "rows": 1, "sha256": "ff"},\n'
        ' "a.csv": {"bytes": 1, "rows": 0, "sha256": "ee"}\n }\n}\n',
    )
    rows = manifest.read_object_manifest(spark, path).orderBy("file_name").collect()
    assert [tuple(r) for r in rows] == [("a.csv", 1, 0, "ee"), ("b.csv", 2, 1, "ff")]


def test_missing_files(spark, tmp_path):
    put(tmp_path, "a.csv", "x\n")
    assert [r.file_name for r in files.missing_files(spark, str(tmp_path), ["a.csv", "b.csv"]).collect()] == ["b.csv"]


def test_load_time_does_not_depend_on_the_time_zone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "t.csv", "a,b\n1,x\n")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        landing.land_raw(spark, (spec(),), str(tmp_path / "in"), str(tmp_path / "raw"), "r1", RUN_TS)
        landed = publish.read_published(spark, str(tmp_path / "raw"), "t")
        assert landed.selectExpr("cast(_ingested_at as string) s").first().s == "2024-05-06 07:08:09"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bytes_that_are_no_utf8_are_replaced(spark, tmp_path):
    path = put(tmp_path, "t.csv", b"a,b\n\xff\xfe,x\n2,y\n")
    assert csv.records_per_file(spark, path, spec()).first().rows == 2
    assert csv.read_by_position(spark, path, spec()).where("b = 'x'").first().a == "��"
