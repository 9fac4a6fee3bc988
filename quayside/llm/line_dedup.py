"""Lines that many documents share, dropped everywhere; SQL and DataFrame functions only.

A text is split at line feeds.  The key of a line is the line without ASCII white space at
both ends, A-Z in lower case.  Each document names each of its keys once, by half a SHA-256;
the names are counted with a partial count in every task, so a line of a third of all
documents is one record per task.  Names that enough documents share are joined to the
positions of lines (both sides hold narrow rows, and adaptive execution splits a frequent
name), the positions are gathered by document, and the kept runs of lines between them are
put together again in order.  A document's text is moved at most once.

Every row is a document, whatever its doc_id: repeated rows and rows with a null doc_id
count each, and get an answer each.  A null or empty text is one empty line.  Keys shorter
than ``min_points`` code points are never dropped.  Other columns, whatever their names, are
kept as they are by ``drop_common_lines``.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import cut_lineage

MIN_DOCS = 10
MIN_POINTS = 1
BLANKS = " \t\n\x0b\x0c\r"


def half_digest(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 32)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), ascii_uppercase, ascii_lowercase)


def _body() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _lines() -> Column:
    return F.split(_body(), "\n", -1)


def _names(min_points: int) -> Column:
    """The name of each line's key, null where the key is too short to count."""

    def named(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.char_length(key) >= min_points, half_digest(key))

    return F.transform(_lines(), named)


def _row_key() -> Column:
    """What tells rows apart as far as the answer goes: rows with equal keys get equal answers."""
    return half_digest(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), _body()))


def common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> DataFrame:
    """The names of keys that at least ``min_docs`` documents hold."""
    names = docs.select(F.explode(F.array_distinct(_names(min_points))).alias("name"))
    counted = names.where("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_docs).select("name")


def dropped_positions(docs: DataFrame, common: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """row_key and the positions, from 0 and in order, of the lines that go; none without any."""
    lines = docs.select(_row_key().alias("row_key"), F.posexplode(_names(min_points)).alias("at", "name"))
    found = lines.where("name IS NOT NULL").join(common, "name", "left_semi")
    return found.groupBy("row_key").agg(F.array_sort(F.collect_set("at")).alias("gone"))


def _kept(lines: Column, gone: Column) -> Column:
    """The runs of lines between the positions that go, one after the other."""

    def run(i: Column) -> Column:
        first = F.when(i == 0, F.lit(0)).otherwise(gone[i - 1] + 1)
        last = F.when(i == F.size(gone), F.size(lines)).otherwise(gone[i])
        return F.slice(lines, first + 1, last - first)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), run))


def _marked(docs: DataFrame, min_docs: int, min_points: int) -> DataFrame:
    """Every row as a struct, with its lines and the positions of those that go."""
    # In its own folder, so that the join below is planned by its measured size.
    common = cut_lineage(common_lines(docs, min_docs, min_points))
    rows = docs.select(F.struct("*").alias("row"), _row_key().alias("row_key"), _lines().alias("lines"))
    joined = rows.join(dropped_positions(docs, common, min_points), "row_key", "left")
    return joined.select("row", "lines", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))


def line_verdicts(docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_text."""
    return _marked(docs, min_docs, min_points).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_dropped"),
        F.array_join(_kept(F.col("lines"), F.col("gone")), "\n").alias("kept_text"),
    )


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> DataFrame:
    """The documents with all their columns, their texts without the lines that go.

    A text that loses no line stays as it is, a null one null.
    """
    text = F.when(F.size("gone") == 0, F.col("row.text")).otherwise(
        F.array_join(_kept(F.col("lines"), F.col("gone")), "\n")
    )
    kept = _marked(docs, min_docs, min_points).select(F.col("row").withField("text", text).alias("row"))
    return kept.select("row.*")
