"""Command line, for spark-submit or ``python -m quayside``.

    land      CSV files -> all-text tables with lineage
    stage     CSV files -> checked, typed tables (--check-only writes no tables)
    mart      facts and dimensions from landed and staged tables
    sample    cut a referentially complete sample of the CSV files
    manifest  write bytes, rows and SHA-256 of the CSV files
    verify    compare the CSV files with a manifest
    tables    list what is published under a folder
    clean     remove the versions under a folder that no published table belongs to

Ends with status 1 when data is missing, broken or changed.
"""

from __future__ import annotations

import argparse
import sys
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from quayside.marketplace import marketplace_specs
from quayside.plans import cascade, intake, landing, manifest, mart, publish, staging, validation
from quayside.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quayside", description="Land, check, stage and sample sales data.")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name)
        for argument in arguments:
            added.add_argument(argument)
        added.add_argument("--prefix", help="first word of the published file names")
        added.add_argument("--file", action="append", default=[], metavar="TABLE=NAME", help="file of one table")
        return added

    diverting = {"action": "store_const", "dest": "on_reject", "const": intake.DIVERT, "default": intake.STOP}
    for name in ("land", "stage"):
        added = command(name, "source", "root")
        added.add_argument("--divert", help="write records that do not fit to rejects/ and go on", **diverting)
        added.add_argument("--run-id", default=None)
        added.add_argument("--sample", action="store_true", help="do not compare rows with the full data set")
        if name == "stage":
            added.add_argument("--check-only", action="store_true")
    command("mart", "staging_root", "raw_root", "root").add_argument("--run-id", default=None)
    added = command("sample", "source", "target")
    added.add_argument("--orders", type=int, default=3000)
    added.add_argument("--seed", type=float, default=0.42)
    added.add_argument("--divert", help="write records that do not fit to _rejects/ and go on", **diverting)
    manifest_command = command("manifest", "source", "target")
    manifest_command.add_argument("--orders", type=int, default=3000)
    added = command("verify", "source", "manifest")
    added.add_argument("--object-form", action="store_true", help="the manifest is one JSON object")
    for name in ("dataset", "source", "license"):
        manifest_command.add_argument(f"--{name}", dest=f"{name}_field", help=f"{name} field of the header")
    command("tables", "root")
    command("clean", "root")
    return parser


def _text(value) -> str:
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    return str(value)


def show(df: DataFrame, watched: str | None = None) -> set:
    """Print all rows, one per line, a partition at a time; returns the values of one column."""
    found = set()
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*map(_text, row), sep="\t")
        if watched:
            found.add(row[watched])
    return found


def run(spark: SparkSession, argv: list[str]) -> int:
    args = _parser().parse_args(argv)
    specs = marketplace_specs(args.prefix, dict(pair.split("=", 1) for pair in args.file))
    staged = tuple(s for s in specs if s.staged)
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    run_id = getattr(args, "run_id", None) or f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    try:
        if args.command == "land":
            show(
                landing.land_raw(spark, specs, args.source, args.root, run_id, now, not args.sample, args.on_reject)
            )
        elif args.command == "stage":
            report = staging.stage_files(
                spark, args.source, staged, args.root, run_id, args.check_only, not args.sample, args.on_reject
            )
            show(validation.problem_totals(report))
            show(report.where("severity = 'warn' and n_violations > 0"))
        elif args.command == "mart":
            mart.publish_mart(spark, args.staging_root, args.raw_root, args.root, run_id)
            show(publish.published_tables(spark, args.root))
        elif args.command == "sample":
            show(
                cascade.sample_files(
                    spark, args.source, args.target, specs, "orders", args.orders, args.seed, args.on_reject
                )
            )
        elif args.command == "manifest":
            built = manifest.csv_manifest(spark, args.source, specs)
            fields = {n: getattr(args, f"{n}_field") for n in ("dataset", "source", "license")}
            header = {n: v for n, v in fields.items() if v is not None}
            manifest.write_manifest(built, args.target, now, args.orders, **header)
        elif args.command == "verify":
            found = manifest.check_manifest(spark, args.manifest, args.source, specs, args.object_form)
            if found is None:
                print("no manifest, nothing to compare")
                return 0
            return 1 if show(found.orderBy("file_name"), "status") & {"missing", "changed"} else 0
        elif args.command == "clean":
            print(*publish.remove_superseded(spark, args.root), sep="\n")
        else:
            show(publish.published_tables(spark, args.root))
    except (
        FileNotFoundError, validation.ValidationFailed, landing.LandingFailed, staging.BrokenRecords,
        publish.PublishFailed, cascade.OrphansFound,
    ) as problem:
        print(problem, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    session = build_session()
    try:
        raise SystemExit(run(session, sys.argv[1:]))
    finally:
        session.stop()
