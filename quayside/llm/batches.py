"""The size of the batches in which rows go to Python.

Texts and pages are long, and a few of them very long, so a batch is bounded by its bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2_000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20,
}


def bounded(rows: DataFrame) -> DataFrame:
    """The rows, after lowering the session's limits where they are higher than these."""
    conf = rows.sparkSession.conf
    for key, limit in LIMITS.items():
        now = str(conf.get(key)).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= limit:  # also where it is written in megabytes
            conf.set(key, str(limit))
    return rows
