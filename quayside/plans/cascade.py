"""Cut a sample that keeps every reference intact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import closure, keys, ranked, sampling
from quayside.plans import intake, staging
from quayside.session import cut_lineage, working_folder
from quayside.sources import csv
from quayside.spec import ForeignKey, TableSpec, by_name

POINTS_PER_AREA = 3


class OrphansFound(Exception):
    pass


def cascade_sample(
    tables: dict[str, DataFrame],
    specs: tuple[TableSpec, ...],
    root: str,
    n: int = 3000,
    seed=0.42,
    points_per_area: int = POINTS_PER_AREA,
    only: tuple[str, ...] | None = None,
) -> dict[str, DataFrame]:
    """Draw ``n`` rows of ``root`` and derive every other table from them.

    Children of a sampled table keep the rows that refer to it, by any of their references;
    parents keep the rows that a sampled table refers to; lookup tables stay whole; a table
    reached only by weak references keeps a few points per key.  Where a reference leads to
    rows that were not drawn (a second reference to one table, a table's reference to
    itself, a cycle of tables), these rows are added, and what they refer to in turn, until
    nothing dangles; so ``root`` may end with more than ``n`` rows.  Added rows bring what
    they refer to, not what refers to them.  Tables that others are derived from are
    written to the shared folder once.  ``only`` names the tables wanted.
    """
    known = by_name(specs)
    key = known[root].key[0]
    cut = sampling.find_cut(tables[root], key, n, seed) if n > 0 else None

    via = _reached_downward(specs, root)
    above = _reached_upward(known, list(via))
    members = [*via, *above]
    weak = [
        s.name
        for s in specs
        if s.name not in members
        and not s.lookup
        and any(fk.weak and fk.parent == s.name for m in members for fk in known[m].foreign_keys)
    ]
    unsure = _unsure_edges(known, via, members)
    circles = closure.components(unsure, members)
    drawn: dict[str, DataFrame] = {}
    done: dict[str, DataFrame] = {}

    def references(name: str, weakly: bool) -> dict[str, DataFrame]:
        """By column of the table: the keys that other tables of the sample hold."""
        sides: dict[str, list] = {}
        for m in members:
            for fk in known[m].foreign_keys:
                if m != name and fk.parent == name and fk.weak == weakly:
                    sides.setdefault(fk.parent_column, []).append((sampled(m), fk.column))
        return {column: keys.union_of_keys(*found) for column, found in sides.items()}

    def pick(name: str) -> DataFrame:
        """The rows that the draw itself brings, before anything is added for references."""
        if name == root:
            return sampling.sample_rows(tables[root], key, n, seed, cut)
        if len(via[name]) == 1:
            (fk,) = via[name]
            if fk.parent == root and fk.parent_column == key and n > 0:
                return sampling.rows_of_sample(tables[name], fk.column, picked(root), fk.parent_column, seed, cut)
            return keys.in_keys(tables[name], fk.column, picked(fk.parent), fk.parent_column)
        wanted: dict[str, list] = {}
        for fk in via[name]:
            wanted.setdefault(fk.column, []).append((picked(fk.parent), fk.parent_column))
        return closure.rows_with_any_key(tables[name], {c: keys.union_of_keys(*w) for c, w in wanted.items()})

    def picked(name: str) -> DataFrame:
        if name not in drawn:
            df = pick(name)
            leads_on = name == root or any(e.child == name or e.parent == name for e in unsure)
            leads_on = leads_on or any(fk.parent in weak for fk in known[name].foreign_keys)
            drawn[name] = cut_lineage(df) if leads_on else df
        return drawn[name]

    def close(circle: frozenset[str]) -> None:
        """Complete the tables of a circle together, with what other tables ask of them."""
        edges = [e for e in unsure if e.parent in circle]
        start = {t: picked(t) for t in circle if t in via}
        start |= {e.child: sampled(e.child) for e in edges if e.child not in circle}
        found = closure.close_references({t: tables[t] for t in circle}, edges, start)
        for t in circle:
            added = closure.rows_added(tables[t], t, found)
            parts = [df for df in (start.get(t), added) if df is not None]
            done[t] = cut_lineage(reduce(DataFrame.union, parts)) if parts else tables[t].where(F.lit(False))

    def sampled(name: str) -> DataFrame:
        if name in done:
            return done[name]
        asked = [e for e in unsure if e.parent == name]
        if name in via and not asked:
            done[name] = picked(name)
        elif name in weak:
            # The points are cut before the join: whole areas stay or go, so the answer is the
            # same, and a hot area is a few rows per task before anything is shuffled.
            wanted = references(name, weakly=True)
            area = next(iter(wanted))
            first = next(c for c in known[name].column_names if c != area)
            points = ranked.points_per_area(tables[name], area, first, points_per_area)
            done[name] = closure.rows_with_any_key(points, {area: wanted[area]})
        elif name in via or len(circles[name]) > 1 or any(e.child == name for e in asked):
            close(circles[name])
        else:
            df = closure.rows_with_any_key(tables[name], references(name, weakly=False))
            leads_on = any(e.child == name for e in unsure) or any(fk.parent in weak for fk in known[name].foreign_keys)
            done[name] = cut_lineage(df) if leads_on else df
        return done[name]

    lookups = [s.name for s in specs if s.lookup]
    chosen = [t for t in (*members, *weak, *lookups) if only is None or t in only]
    return {t: tables[t] if known[t].lookup else sampled(t) for t in chosen}


def _reached_downward(specs: tuple[TableSpec, ...], root: str) -> dict[str, list[ForeignKey]]:
    """Tables that refer to the root, directly or not, with their references to nearer tables."""
    via: dict[str, list[ForeignKey]] = {root: []}
    level = [root]
    while level:
        nearer = set(via)
        found = {
            s.name: edges
            for s in specs
            if s.name not in nearer
            and not s.lookup
            and (edges := [fk for fk in s.foreign_keys if not fk.weak and fk.parent in nearer])
        }
        via |= found
        level = list(found)
    return via


def _reached_upward(known: dict[str, TableSpec], members: list[str]) -> list[str]:
    """Tables that the members refer to, directly or not, and that are not members."""
    found: list[str] = []
    queue = list(members)
    for name in queue:
        for fk in known[name].foreign_keys:
            if not fk.weak and fk.parent not in queue and not known[fk.parent].lookup:
                found.append(fk.parent)
                queue.append(fk.parent)
    return found


def _unsure_edges(
    known: dict[str, TableSpec], via: dict[str, list[ForeignKey]], members: list[str]
) -> list[closure.Edge]:
    """The references between members that the draw alone does not satisfy.

    The only reference by which a table was reached is satisfied, unless rows are added to
    that table for others.
    """
    every = [
        (closure.Edge(m, fk.column, fk.parent, fk.parent_column), via.get(m) == [fk])
        for m in members
        for fk in known[m].foreign_keys
        if not fk.weak and fk.parent in members
    ]
    unsure = [edge for edge, sure in every if not sure]
    while True:
        grows = {e.parent for e in unsure}
        more = [e for e, _ in every if e not in unsure and e.child in grows]
        if not more:
            return unsure
        unsure += more


def orphans_per_edge(tables: dict[str, DataFrame], specs: tuple[TableSpec, ...]) -> DataFrame:
    """Every declared (strong) edge between the given tables with its orphan count."""
    parts = []
    for spec in specs:
        for fk in spec.foreign_keys:
            if fk.weak or spec.name not in tables or fk.parent not in tables:
                continue
            summary = keys.orphan_summary(
                tables[spec.name], fk.column, tables[fk.parent], fk.parent_column
            )
            parts.append(
                summary.select(
                    F.lit(f"{spec.name}.{fk.column}->{fk.parent}.{fk.parent_column}").alias("edge"),
                    F.col("n_rows").cast("bigint").alias("n_rows"),
                    F.col("orphans").cast("bigint").alias("n_orphans"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def sample_files(
    spark: SparkSession,
    source: str,
    target: str,
    specs: tuple[TableSpec, ...],
    root: str = "orders",
    n: int = 3000,
    seed=0.42,
    on_reject: str = intake.STOP,
) -> DataFrame:
    """Sample the CSV files of a folder into another.  Any missing file stops the run.

    So do records that do not fit, unless they are diverted, to ``_rejects`` in the target.
    """
    with working_folder(spark):
        tables = staging.read_text_tables(
            spark, source, specs, on_reject=on_reject, rejects_path=f"{target}/_rejects", named=False
        )
        return write_sample(spark, cascade_sample(tables, specs, root, n, seed), specs, target)


def write_sample(
    spark: SparkSession, sample: dict[str, DataFrame], specs: tuple[TableSpec, ...], directory: str
) -> DataFrame:
    """Write the sample as CSV, read it back, and refuse it if any reference dangles.

    Returns rows and bytes per file, measured on what was written.
    """
    known = by_name(specs)
    stored = {}
    for name, df in sample.items():
        path = f"{directory}/{known[name].file_name}"
        csv.write_csv(df.select(*known[name].column_names), path)
        stored[name] = csv.read_by_position(spark, path, known[name])
    dangling = orphans_per_edge(stored, specs).where("n_orphans > 0").collect()
    if dangling:
        raise OrphansFound(", ".join(f"{r.edge}: {r.n_orphans:,}" for r in dangling))
    parts = [
        df.groupBy("_metadata.file_path", "_metadata.file_size")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        )
        .select(F.lit(name).alias("table_name"), "n_rows", "bytes", (F.col("bytes") / 1024).alias("kilobytes"))
        for name, df in stored.items()
    ]
    return reduce(DataFrame.unionByName, parts)
