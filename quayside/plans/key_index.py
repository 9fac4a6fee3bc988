"""Keys of a table that grows: appended rows are checked against all keys seen before.

Each accepted batch leaves its keys, counted, as a part of the index in hash buckets of the
key, and the totals over all batches in a small pointer file.  Appended keys are counted and
dealt to the same buckets once; each part is then read bucket by bucket beside them, so what
was stored before is neither grouped again nor moved.  Only keys of the batch can change the
totals.  Many parts are merged, bucket by bucket, without moving a key either.

The pointer is replaced after a part is whole, so a failed or repeated append leaves the
index as it was.  One writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import name as quoted
from quayside.operators import buckets
from quayside.session import cut_lineage, remove_folder
from quayside.sources import files

POINTER = "_INDEX"
BUCKETS = 64
MOST_PARTS = 8
SCHEMA = "key string, n bigint"


class RepeatedAppend(Exception):
    pass


@dataclass(frozen=True)
class Totals:
    """As ``keys.duplicate_summary`` counts them over all rows seen."""

    n_rows: int = 0
    duplicate_rows: int = 0
    duplicate_keys: int = 0


def key_text(columns: tuple[str, ...]) -> Column:
    """One text for all key columns, never null; texts are equal where keys are, null with null."""
    parts = []
    for column in columns:
        text = F.col(quoted(column)).cast("string")
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


class KeyIndex:
    """The keys of one table under ``root``; ``buckets`` counts for a new index only."""

    def __init__(self, spark: SparkSession, root: str, columns: tuple[str, ...], buckets: int = BUCKETS):
        self.spark, self.root, self.columns = spark, root, tuple(columns)
        path = f"{root}/{POINTER}"
        stored = json.loads(files.read_text_file(spark, path)) if files.path_exists(spark, path) else {}
        if stored and tuple(stored["columns"]) != self.columns:
            raise ValueError(f"{root} is an index of {stored['columns']}, not of {list(self.columns)}")
        self.buckets = stored.get("buckets", buckets)
        self.parts: list[str] = stored.get("parts", [])
        self.batches: list[str] = stored.get("batches", [])
        self.totals = Totals(**stored.get("totals", {}))

    def keys(self) -> DataFrame:
        """key and n of all keys seen; grouped within their buckets."""
        if not self.parts:
            return self.spark.createDataFrame([], SCHEMA)
        stored = buckets.read_parts(self.spark, self._folder, self.parts, SCHEMA, "key", self.buckets)
        return stored.groupBy("key").agg(F.sum("n").alias("n"))

    @property
    def _folder(self) -> str:
        return f"{self.root}/keys"

    def against_old(self, rows: DataFrame) -> DataFrame:
        """key, n and n_old of the keys of the rows: how often they occur here and did before."""
        counted = rows.select(key_text(self.columns).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        if not self.parts:
            return counted.withColumn("n_old", F.lit(0).cast("bigint"))
        # Hinted, so that neither side is broadcast: the new keys come to the buckets.
        old = self.keys().withColumnRenamed("n", "n_old").hint("merge")
        joined = counted.repartition(self.buckets, "key").join(old, "key", "left")
        return joined.select("key", "n", F.coalesce("n_old", F.lit(0)).alias("n_old"))

    def totals_with(self, compared: DataFrame) -> Totals:
        """The totals if the rows were appended; old keys that they do not hold do not matter."""
        before, after = F.col("n_old"), F.col("n_old") + F.col("n")
        more = compared.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(
                F.sum(F.when(after > 1, after).otherwise(0) - F.when(before > 1, before).otherwise(0)), F.lit(0)
            ).alias("duplicate_rows"),
            F.count_if((after > 1) & (before <= 1)).alias("duplicate_keys"),
        ).first()
        now = self.totals
        return Totals(
            now.n_rows + more["rows"],
            now.duplicate_rows + more["duplicate_rows"],
            now.duplicate_keys + more["duplicate_keys"],
        )

    def check(self, rows: DataFrame) -> Totals:
        """What appending the rows would lead to; nothing is kept."""
        return self.totals_with(self.against_old(rows))

    def repeated(self, rows: DataFrame) -> DataFrame:
        """key, n and n_old of the keys that would not be unique."""
        return self.against_old(rows).where(F.col("n") + F.col("n_old") > 1)

    def append(self, rows: DataFrame, batch: str) -> Totals:
        """Take the keys of the rows into the index."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a name for a batch: {batch}")
        if batch in self.batches:
            raise RepeatedAppend(f"batch {batch} is in the index already")
        compared = cut_lineage(self.against_old(rows))
        totals = self.totals_with(compared)
        self._write(batch, compared.select("key", "n"))
        self._switch([*self.parts, batch], [*self.batches, batch], totals)
        if len(self.parts) > MOST_PARTS:
            self.merge()
        return totals

    def merge(self) -> None:
        """Make one part of all, bucket by bucket; the old ones go once it is in use."""
        old, part = self.parts, f"all-{uuid.uuid4().hex}"
        self._write(part, self.keys(), dealt=True)
        self._switch([part], self.batches, self.totals)
        for name in old:
            remove_folder(self.spark, f"{self._folder}/part={name}")

    def _write(self, part: str, keys: DataFrame, dealt: bool = False) -> None:
        remove_folder(self.spark, f"{self._folder}/part={part}")  # of an append that failed
        buckets.write_part(keys, self._folder, part, "key", self.buckets, dealt)

    def _switch(self, parts: list[str], batches: list[str], totals: Totals) -> None:
        self.parts, self.batches, self.totals = parts, batches, totals
        stored = {
            "columns": list(self.columns), "buckets": self.buckets, "parts": parts, "batches": batches,
            "totals": totals.__dict__,
        }
        files.replace_text_file(self.spark, f"{self.root}/{POINTER}", json.dumps(stored, sort_keys=True))

