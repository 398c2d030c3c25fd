"""Arrow batches for long texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Let no Arrow batch hold more than ``rows`` rows from now on; a smaller setting stays.

    Batches are counted in rows, and the usual 10,000 texts are tens of MB on both sides of the pipe.
    """
    now = int(spark.conf.get(_KEY, "10000") or 10_000)
    if now <= 0 or now > rows:
        spark.conf.set(_KEY, str(rows))
