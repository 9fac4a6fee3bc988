"""From raw documents to packed sequences: five stages, each over all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import config_packing, exact_dedup, language, pfair_mixing, simhash
from quayside.llm.queries import remainder
from quayside.session import new_run_folder, remove_folder, working_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, empty, or no letter in them) go."""
    return language.keep_identified(docs, language.fit(docs, remainder(4) != 2))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with linked fingerprints the one with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources are interleaved."""
    return pfair_mixing.in_mixed_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, and the place of each in sequences that follow the mixed order."""
    return config_packing.pack_in_order(docs, pfair_mixing.file_order())


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained network, fingerprints and token ids are beyond SQL; tests/llm has the comparison.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each stage's documents are written and read again.

    What a stage writes for itself goes once its documents are written, and they go once the
    next stage's are; only the last ones stay in the shared folder, none after a failure.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = new_run_folder(spark, "pipeline"), None
    try:
        for name, stage in STAGES:
            path = f"{folder}/{name}"
            with working_folder(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
            if before:
                remove_folder(spark, before)
            docs, before = spark.read.parquet(path), path
    except BaseException:
        remove_folder(spark, folder)
        raise
    return docs
