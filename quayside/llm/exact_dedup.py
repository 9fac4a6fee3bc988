"""Exact deduplication with state kept on disk by a streaming aggregation.

Every arriving document is logged as a narrow row (identifier, digest, locator).  A
streaming aggregation without watermark keeps one state row per digest in RocksDB, so the
state never expires and does not need memory: the largest identifier, the locator of its
content and the number of arrivals.  Several arrivals of one digest are hits; their whole
texts are compared byte by byte, so that two texts with one digest are never merged.

Null texts count as empty.  Texts are compared without any normalisation.  Rows that share
the largest identifier of a group all stay, for nothing tells them apart; a null identifier
never wins against another one.  Only ``id_column`` and ``text_column`` are read; other
columns, whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import cut_lineage, new_run_folder

LOG_SCHEMA = "doc_id bigint, digest string, locator string"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: no disk space in advance for each, and one bound for the memory of all.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}
# The digests of hits are marked in a bitmap of this many bits, so its size is known.
BITMAP_BITS = 1 << 24
BITS_PER_ROW = 1 << 15


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class DigestState:
    """The disk-backed state of one corpus, under ``folder``; more documents may arrive later."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.log_path, self.checkpoint = f"{folder}/log", f"{folder}/state"

    def ingest(self, docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> None:
        """Log the documents, then let the stream take up what is new in the log."""
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            digest(F.coalesce("text", F.lit(""))).alias("digest"),
            F.input_file_name().alias("locator"),
        ).write.mode("append").parquet(self.log_path)
        with _settings(self.spark, STATE_SETTINGS):
            query = (
                self.spark.readStream.schema(LOG_SCHEMA)
                .parquet(self.log_path)
                .groupBy("digest")
                .agg(
                    F.max(F.struct("doc_id", "locator")).alias("keeper"),
                    F.count(F.lit(1)).alias("arrivals"),
                )
                .writeStream.format("noop")
                .outputMode("update")
                .option("checkpointLocation", self.checkpoint)
                .trigger(availableNow=True)
                .start()
            )
        query.awaitTermination()

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)

    def entries(self) -> DataFrame:
        """digest, keep_id, locator and arrivals, read from the state itself."""
        state = self.spark.read.format("statestore").load(self.checkpoint)
        return state.select(
            F.col("key.digest").alias("digest"),
            F.col("value.max").getField("doc_id").alias("keep_id"),
            F.col("value.max").getField("locator").alias("locator"),
            F.col("value.count").alias("arrivals"),
        )


def _bit(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(BITMAP_BITS))


def bitmap_of(digests: DataFrame) -> DataFrame:
    """One row for each piece of a bitmap that has a bit set: at most 2 MB in all."""
    return (
        digests.select(_bit(F.col("digest")).alias("bit"))
        .groupBy(F.expr(f"bit div {BITS_PER_ROW}").alias("__piece"))
        .agg(F.expr(f"bitmap_construct_agg(bit % {BITS_PER_ROW})").alias("__bits"))
    )


def marked(docs: DataFrame, bitmap: DataFrame, digest: Column, keep: bool = True) -> DataFrame:
    """Rows whose digest may be (``keep``) or surely is not in the bitmap, without a shuffle.

    The broadcast side holds at most BITMAP_BITS / 8 bytes, whatever the input.
    """
    bit = _bit(digest)
    rows = docs.withColumn("__bit", bit).withColumn("__piece", F.expr(f"__bit div {BITS_PER_ROW}"))
    joined = rows.join(F.broadcast(bitmap), "__piece", "left")
    byte = F.expr(
        f"conv(hex(substring(__bits, cast((__bit % {BITS_PER_ROW}) div 8 + 1 as int), 1)), 16, 10)"
    ).cast("int")
    is_set = F.coalesce(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1, F.lit(False))
    return joined.where(is_set if keep else ~is_set).drop("__bit", "__piece", "__bits")


def verified_groups(docs: DataFrame, state: DigestState, digest=sha256_hex) -> DataFrame:
    """digest, text and group_size of all hits, grouped by their full bytes."""
    hits = bitmap_of(state.entries().where("arrivals > 1"))
    body = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("text"))
    rows = marked(rows.withColumn("digest", digest(F.col("text"))), hits, F.col("digest"))
    return rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("group_size"))


def exact_dedup(
    docs: DataFrame,
    folder: str | None = None,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept, locator.

    Of equal texts the row with the largest doc_id stays; ``locator`` is the file its
    content came from.  ``folder`` keeps the state.
    """
    spark = docs.sparkSession
    state = DigestState(spark, folder or new_run_folder(spark, "exact-dedup"))
    state.ingest(docs, digest)
    # Digests that stand for more than one text; with SHA-256 there are none.
    clashes = cut_lineage(
        verified_groups(docs, state, digest).groupBy("digest").count().where("count > 1").select("digest")
    )
    found = state.log().select("doc_id", "digest").join(state.entries(), "digest")
    found = found.withColumnRenamed("arrivals", "group_size")
    if not clashes.isEmpty():
        found = found.join(clashes, "digest", "left_anti").unionByName(_by_bytes(docs, state, clashes, digest))
    return found.select(
        "doc_id",
        "digest",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "locator",
    )


def _by_bytes(docs: DataFrame, state: DigestState, clashes: DataFrame, digest) -> DataFrame:
    """Documents of clashing digests, told apart by their whole texts."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.input_file_name().alias("locator"),
    ).withColumn("digest", digest(F.col("text")))
    rows = marked(rows, bitmap_of(clashes), F.col("digest")).join(clashes, "digest", "left_semi")
    groups = rows.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("group_size")
    )
    return (
        rows.drop("locator")
        .join(groups, ["digest", "text"])
        .select("doc_id", "digest", "keeper.*", "group_size")
        .toDF("doc_id", "digest", "keep_id", "locator", "group_size")
    )


def drop_copies(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The documents that stay, with all their columns.

    Only documents whose digest is marked as a hit are shuffled; all others pass through.
    """
    spark = docs.sparkSession
    folder = folder or new_run_folder(spark, "exact-dedup")
    verdicts = cut_lineage(exact_dedup(docs, folder))
    dropped = verdicts.where("not kept").select("doc_id", "digest")
    hits = cut_lineage(bitmap_of(dropped))
    # The row goes along as one column, so that no name of its columns matters.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("bigint").alias("id"),
        sha256_hex(F.coalesce("text", F.lit(""))).alias("digest"),
    )
    passed = marked(rows, hits, F.col("digest"), keep=False).select("row")
    # An id may be repeated with unlike texts, so it takes the digest to tell what goes.
    gone = dropped.toDF("gone_id", "gone_digest").distinct()
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest"))
    unsure = marked(rows, hits, F.col("digest")).join(gone, same, "left_anti").select("row")
    return passed.unionByName(unsure).select("row.*")
