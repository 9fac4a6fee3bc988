"""The commands, end to end on small files."""

import market
from quayside.__main__ import run
from quayside.plans import publish
from quayside.sources import csv
from quayside.marketplace import marketplace_specs


def test_land_stage_sample_manifest_verify(spark, tmp_path, capsys):
    source = market.write(tmp_path / "in", market.tables(60))
    raw, staged, small = (str(tmp_path / n) for n in ("raw", "staged", "small"))
    assert run(spark, ["land", source, raw, "--run-id", "r1"]) == 0
    assert publish.published_tables(spark, raw).count() == 9
    assert "false" in capsys.readouterr().out  # row counts differ from the full data set
    assert run(spark, ["stage", source, staged, "--check-only", "--sample"]) == 0
    assert publish.published_tables(spark, staged).count() == 0
    assert run(spark, ["stage", source, staged]) == 0
    assert publish.published_tables(spark, staged).count() == 5
    assert run(spark, ["tables", staged]) == 0
    gold = str(tmp_path / "gold")
    assert run(spark, ["mart", staged, raw, gold, "--run-id", "m1"]) == 0
    assert publish.read_published(spark, gold, "fact_orders").count() == 60
    assert publish.read_published(spark, gold, "fact_orders").where("review_score is null").count() == 0
    assert publish.published_tables(spark, gold).count() == 7
    assert run(spark, ["sample", source, small, "--orders", "20"]) == 0
    orders = next(s for s in marketplace_specs() if s.name == "orders")
    assert csv.read_by_position(spark, f"{small}/orders.csv", orders).count() == 20
    listing = str(tmp_path / "manifest")
    assert run(spark, ["verify", source, listing]) == 0
    fields = ["--dataset", "d", "--source", "s", "--license", "l"]
    assert run(spark, ["manifest", source, listing, *fields]) == 0
    line = spark.read.json(listing).first()
    assert (line.dataset, line.source, line.license) == ("d", "s", "l")
    assert run(spark, ["verify", source, listing]) == 0
    with open(f"{source}/sellers.csv", "a", encoding="utf-8") as f:
        f.write("x,1,y,z\n")
    assert run(spark, ["verify", source, listing]) == 1
    assert run(spark, ["stage", source, staged]) == 1


def test_the_sample_can_be_staged(spark, tmp_path):
    source = market.write(tmp_path / "in", market.tables(60))
    small = str(tmp_path / "small")
    assert run(spark, ["sample", source, small, "--orders", "25", "--seed", "0.1"]) == 0
    assert run(spark, ["stage", small, str(tmp_path / "staged"), "--sample"]) == 0
    assert publish.read_published(spark, str(tmp_path / "staged"), "orders").count() == 25


def test_all_results_are_shown_and_old_versions_go(spark, tmp_path, capsys):
    source = market.write(tmp_path / "in", market.tables(5))
    (tmp_path / "in" / "sellers.csv").unlink()
    (tmp_path / "in" / "sellers.csv").mkdir()
    for i in range(150):
        (tmp_path / "in" / "sellers.csv" / f"p{i:03d}").write_text("seller_id,b,c,d\n1,2,3,4\n")
    listing = str(tmp_path / "manifest")
    assert run(spark, ["manifest", source, listing]) == 0
    (tmp_path / "in" / "sellers.csv" / "p149").unlink()
    capsys.readouterr()
    assert run(spark, ["verify", source, listing]) == 1
    shown = capsys.readouterr().out
    assert "sellers.csv/p149\tmissing" in shown and shown.count("sellers.csv/") == 150
    raw = str(tmp_path / "raw")
    for run_id in ("r1", "r2"):
        publish.publish(spark, {"t": spark.range(1)}, raw, run_id)
    assert run(spark, ["clean", raw]) == 0
    assert "version=r1" in capsys.readouterr().out


def test_missing_files_end_with_status_one(spark, tmp_path, capsys):
    data = market.tables(5)
    del data["geolocation"]
    source = market.write(tmp_path / "in", data)
    assert run(spark, ["sample", source, str(tmp_path / "out")]) == 1
    assert "geolocation.csv" in capsys.readouterr().err
    assert run(spark, ["stage", source, str(tmp_path / "staged"), "--sample"]) == 0
