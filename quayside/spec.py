"""Table specifications: the one place that says what a table must look like.

A specification is plain data.  Everything else derives from it: the all-text
landing schema, the typed staging schema, the data checks, the load order and
the walk of the sampler.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

INTEGER_TYPES = ("smallint", "int", "bigint")


@dataclass(frozen=True)
class Column:
    """One column: its staged Spark type and the rules its text must satisfy."""

    name: str
    type: str = "string"
    required: bool = False
    width: int | None = None
    max_width: int | None = None
    allowed: tuple[str, ...] | None = None
    minimum: int | None = None

    @property
    def is_integer(self) -> bool:
        return self.type in INTEGER_TYPES

    @property
    def is_decimal(self) -> bool:
        return self.type.startswith("decimal")

    @property
    def is_timestamp(self) -> bool:
        return self.type == "timestamp_ntz"

    @property
    def scale(self) -> int:
        return int(self.type.rstrip(")").split(",")[1])


@dataclass(frozen=True)
class ForeignKey:
    """``column`` refers to ``parent.parent_column``; ``weak`` edges may dangle."""

    column: str
    parent: str
    parent_column: str
    weak: bool = False


@dataclass(frozen=True)
class RowRule:
    """A condition over one row.  Only a definite *false* breaks it, null passes.

    ``test`` is SQL with each column in braces, ``"{late} >= {early}"``; it sees typed
    values, null where a text does not convert.
    """

    name: str
    columns: tuple[str, ...]
    test: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    row_rules: tuple[RowRule, ...] = ()
    file_name: str = ""
    multiline: bool = False
    expected_rows: int | None = None
    staged: bool = True
    lookup: bool = False

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T.StringType()) for c in self.columns])


def by_name(specs: Iterable[TableSpec]) -> dict[str, TableSpec]:
    return {s.name: s for s in specs}


def load_order(specs: Iterable[TableSpec]) -> list[str]:
    """Table names with every parent before its children."""
    pending = by_name(specs)
    order: list[str] = []
    while pending:
        ready = [
            name
            for name, s in pending.items()
            if not any(
                fk.parent in pending and fk.parent != name
                for fk in s.foreign_keys
                if not fk.weak
            )
        ]
        if not ready:
            raise ValueError(f"circular references among {sorted(pending)}")
        order += ready
        for name in ready:
            del pending[name]
    return order
