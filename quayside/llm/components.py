"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import cut_lineage, new_run_folder, working_folder


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(links: DataFrame) -> DataFrame:
    """node, component_id (its smallest reachable node) of all nodes of the links (a, b).

    Alternates two steps until nothing changes: every node's larger neighbours, then its
    smaller ones, are linked to the smallest node known to it.  Afterwards each node is
    linked with the smallest of its component alone.  The number of links never grows, and
    the number of rounds grows with the logarithm of the longest path.  Each step is
    written to the shared folder, and the smallest neighbours are written before they are
    joined, so that adaptive execution can split the links of a node with many.
    Links of a node with itself and nulls are left out; repeated links do no harm.
    """
    spark = links.sparkSession
    path = new_run_folder(spark, "components")
    with working_folder(spark):  # what the rounds have written is of no use afterwards
        edges = _stars(links)
        members = edges.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
        centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
        members.unionByName(centres).write.parquet(path)
    return spark.read.schema("node bigint, component_id bigint").parquet(path)


def _stars(links: DataFrame) -> DataFrame:
    """(u, v) of every node u that is not the smallest of its component, and that smallest v."""
    edges = cut_lineage(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")))
        edges = cut_lineage(
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        )
        low = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("low")))
        joined = edges.join(low, "u")
        edges = cut_lineage(
            joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
            .where("u != v")
            .distinct()
        )
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges
