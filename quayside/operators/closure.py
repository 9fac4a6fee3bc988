"""The rows that chosen rows refer to, directly or not, found round by round.

References may form any shape: several from one table to another, a table's references to
itself, cycles of tables.  Each round looks only at the frontier, the rows that the last
round has added: the keys they refer to, less the keys already held, bring the next rows.
The rounds work on the key columns alone, written once; whole rows are fetched at the end.

There are as many rounds as the longest chain of references that leads out of what was
chosen, and each reads the narrow key columns of the tables that can still grow.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import name as quoted
from quayside.operators.keys import union_of_keys
from quayside.session import cut_lineage


@dataclass(frozen=True)
class Edge:
    child: str
    column: str
    parent: str
    parent_column: str


@dataclass
class Closure:
    """Keys to fetch by (table, column), and how many rounds found any."""

    keys: dict[tuple[str, str], DataFrame]
    rounds: int


def rows_with_any_key(df: DataFrame, wanted: dict[str, DataFrame]) -> DataFrame:
    """Rows that hold a wanted key in any of the columns; each row once.

    ``wanted`` has one column ``key`` by column of ``df``.  One column is a semi-join; for
    several each side has a key once, so no row is multiplied.
    """
    if len(wanted) == 1:
        ((column, keys),) = wanted.items()
        return df.join(keys.select(F.col("key").alias("__key")), F.col(quoted(column)) == F.col("__key"), "left_semi")
    flags = []
    found = df
    for i, (column, keys) in enumerate(wanted.items()):
        flag = f"__wanted_{i}"
        found = found.join(keys.select(F.col("key").alias(flag)).distinct(), F.col(quoted(column)) == F.col(flag), "left")
        flags.append(flag)
    return found.where(" OR ".join(f"{flag} IS NOT NULL" for flag in flags)).drop(*flags)


def close_references(tables: dict[str, DataFrame], edges: list[Edge], chosen: dict[str, DataFrame]) -> Closure:
    """What must be added to ``chosen`` so that no edge dangles that the tables can satisfy.

    ``tables`` holds every parent that may grow.  ``chosen`` may also hold rows of other
    tables; they are where references start.  Null references lead nowhere, and keys that
    no row of the parent has stay out.
    """
    into: dict[tuple[str, str], list[Edge]] = defaultdict(list)
    columns: dict[str, set[str]] = defaultdict(set)
    for edge in edges:
        into[edge.parent, edge.parent_column].append(edge)
        columns[edge.child].add(edge.column)
        columns[edge.parent].add(edge.parent_column)

    def narrow(table: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(quoted(c)) for c in sorted(columns[table])])

    growing = {t: cut_lineage(narrow(t, tables[t])) for t in {edge.parent for edge in edges}}
    frontier = {t: narrow(t, df) for t, df in chosen.items() if t in columns}
    held = {
        (table, column): [frontier[table].select(F.col(quoted(column)).alias("key"))] if table in frontier else []
        for table, column in into
    }
    added: dict[tuple[str, str], list[DataFrame]] = defaultdict(list)
    rounds = 0
    while frontier:
        grown: dict[str, list[DataFrame]] = defaultdict(list)
        for (table, column), incoming in into.items():
            sides = [(frontier[e.child], e.column) for e in incoming if e.child in frontier]
            if not sides:
                continue
            wanted = union_of_keys(*sides).where("key IS NOT NULL")
            if held[table, column]:
                wanted = wanted.join(reduce(DataFrame.union, held[table, column]), "key", "left_anti")
            found = cut_lineage(rows_with_any_key(growing[table], {column: wanted}).distinct())
            if not found.isEmpty():
                grown[table].append(found)
                added[table, column].append(found.select(F.col(quoted(column)).alias("key")))
        frontier = {table: reduce(DataFrame.union, parts) for table, parts in grown.items()}
        for table, column in into:
            if table in frontier:
                held[table, column].append(frontier[table].select(F.col(quoted(column)).alias("key")))
        rounds += bool(frontier)
    return Closure({k: reduce(DataFrame.union, parts).distinct() for k, parts in added.items()}, rounds)


def rows_added(df: DataFrame, table: str, closure: Closure) -> DataFrame | None:
    """The whole rows of a table that the closure adds; none of them was chosen before."""
    wanted = {column: keys for (t, column), keys in closure.keys.items() if t == table}
    return rows_with_any_key(df, wanted) if wanted else None


def components(edges: list[Edge], names: list[str]) -> dict[str, frozenset[str]]:
    """By table: the tables that it reaches and that reach it, itself included."""
    reach = {n: {n} for n in names}
    changed = True
    while changed:
        changed = False
        for edge in edges:
            if not reach[edge.parent] <= reach[edge.child]:
                reach[edge.child] |= reach[edge.parent]
                changed = True
    return {n: frozenset(m for m in names if m in reach[n] and n in reach[m]) for n in names}
