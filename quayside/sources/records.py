"""Records of CSV files with their byte offsets, found in parallel.

Files are read as lines, split anywhere.  Whether a line begins inside a quoted field is told
by the quotes before it: the quotes of each split are counted in parallel, a running sum over
the splits of a file says how each begins, and within a split a running sum over its lines
does the rest.  The lengths of lines give offsets the same way.  Only lines of records that
span several lines are grouped; all others are records as they are.

Parity is right for files whose quotes stand around whole fields, doubled within.  Every
record is held against that form; a file with a record that does not keep to it, with a
quote that never closes, or with a carriage return of its own as the end of a line is
irregular.  Such a file is named, so that the caller can have it read in one piece.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import cut_lineage

QUOTED_FIELD = r'(^|,)"[^"]*"(?=,|\r?\z)'


@dataclass
class Records:
    """``rows``: file, file_name, offset, record and is_header, of all regular files.

    ``record`` holds the bytes of the file, whether they are UTF-8 or not, without the end
    of the line.  ``irregular`` lists the paths of the other files.
    """

    rows: DataFrame
    irregular: list[str]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),  # the order of the lines of a split
        F.col("value").alias("line"),
    )


def _quotes(line: str, multiline: bool) -> Column:
    if not multiline:
        return F.lit(0)
    return F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit('"'), F.lit("")))


def _splits(lines: DataFrame, multiline: bool) -> DataFrame:
    """By split of a file: whether it begins within quotes, and its first line's offset.

    One row for each split, so the running sums see as many rows as a file has splits.
    """
    counted = lines.groupBy("file", "block").agg(
        F.sum(F.octet_length("line") + 1).alias("bytes"),
        (F.sum(_quotes("line", multiline)) % 2).alias("quotes"),
        F.first("file_size").alias("file_size"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    # The byte order mark is not part of the first line; the last line may lack its end.
    mark = F.when((F.col("file_size") - F.sum("bytes").over(whole)).isin(2, 3), 3).otherwise(0)
    return counted.select(
        "file",
        "block",
        (mark + F.coalesce(F.sum("bytes").over(before), F.lit(0))).alias("start"),
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("inside"),
        (F.sum("quotes").over(whole) % 2 == 1).alias("unclosed"),
    )


def is_irregular(record: Column) -> Column:
    def bare(text: Column) -> Column:
        return _without_end(text).contains("\r")

    rest = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), QUOTED_FIELD, "$1")
    return F.when(record.contains('"'), rest.contains('"') | bare(rest)).otherwise(bare(record))


def _without_end(record: Column) -> Column:
    """Without the carriage return of the end of the line."""
    return F.when(record.endswith("\r"), F.substr(record, F.lit(1), F.char_length(record) - 1)).otherwise(record)


def as_paths(files: list[str]) -> list[str]:
    """Names of files as rows give them, as paths that stand for just these files."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in files]


def find_records(spark: SparkSession, path: str, multiline: bool) -> Records:
    """All records of the files, empty lines left out.  Unless ``multiline`` a line is a record."""
    splits = cut_lineage(_splits(_lines(spark, path), multiline))
    spoiled = splits.where("unclosed").select("file").distinct()

    order = Window.partitionBy("file", "block").orderBy("n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        _lines(spark, path)
        .withColumn("quotes", _quotes("line", multiline))
        .withColumns(
            {
                "passed": F.coalesce(F.sum(F.octet_length("line") + 1).over(before), F.lit(0)),
                "opened": F.coalesce(F.sum("quotes").over(before), F.lit(0)),
            }
        )
        .join(splits.where("NOT unclosed"), ["file", "block"])
    )
    begins = (F.col("inside") + F.col("opened")) % 2 == 0
    ends = (F.col("inside") + F.col("opened") + F.col("quotes")) % 2 == 0
    placed = counted.select(
        "file",
        "file_name",
        "block",
        (F.col("start") + F.col("passed")).alias("offset"),
        "line",
        "n",
        (begins & ends).alias("whole"),
        F.when(begins, F.col("start") + F.col("passed")).alias("begun_at"),
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own_start = F.last("begun_at", ignorenulls=True).over(so_far).alias("own_start")
    placed = cut_lineage(placed.select("file", "file_name", "block", "offset", "line", "whole", own_start))

    # Lines that continue a record of an earlier split take its start from there.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_starts = placed.groupBy("file", "block").agg(F.max("own_start").alias("last_start"))
    open_starts = open_starts.select(
        "file", "block", F.last("last_start", ignorenulls=True).over(earlier).alias("carried")
    )
    parts = placed.where("NOT whole").join(open_starts, ["file", "block"])
    parts = parts.withColumn("at", F.coalesce("own_start", "carried"))
    in_order = F.array_sort(F.collect_list(F.struct("offset", "line")))
    joined = parts.groupBy("file", "file_name", F.col("at").alias("offset")).agg(
        F.array_join(F.transform(in_order, lambda part: part["line"]), "\n").alias("record")
    )
    records = placed.where("whole").select("file", "file_name", "offset", F.col("line").alias("record"))
    records = records.unionByName(joined.select("file", "file_name", "offset", "record"))
    records = cut_lineage(records.where("record NOT IN ('', '\\r')"))

    irregular = records.where(is_irregular(F.col("record"))).select("file")
    odd = cut_lineage(irregular.union(spoiled).distinct())
    headers = records.groupBy("file").agg(F.min("offset").alias("header_at"))
    rows = records.join(odd, "file", "left_anti").join(headers, "file")
    rows = rows.select(
        "file",
        "file_name",
        "offset",
        _without_end(F.col("record")).alias("record"),
        (F.col("offset") == F.col("header_at")).alias("is_header"),
    )
    return Records(rows, sorted(r.file for r in odd.collect()))
