"""Late rows: strict history is undefined for them, so they go to a table of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.streaming.runs import earlier_batches, write_batch

_MARK = T.StructType([T.StructField("newest", T.LongType())])


def split_late(folder: str, delay_micros: int, ts: str = "ts"):
    """Function for a micro-batch: rows older than the newest earlier row minus the delay are late.

    Writes the tables ``ontime``, ``late`` and ``mark`` (one row per batch) below ``folder``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = earlier_batches(spark, folder, "mark", _MARK, batch_id).agg(F.max("newest")).first()[0]
        limit = F.lit(newest - delay_micros if newest is not None else None).cast("long")
        late = F.coalesce(F.unix_micros(ts) < limit, F.lit(False))
        write_batch(batch.filter(~late), folder, "ontime", batch_id)
        write_batch(batch.filter(late), folder, "late", batch_id)
        write_batch(batch.agg(F.max(F.unix_micros(ts)).alias("newest")), folder, "mark", batch_id)

    return handle
