"""Exact deduplication by sorting content."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.session import BROADCAST_ROWS, has_at_most, written


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all else unchanged; plain ASCII takes the faster built-in."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def content_sort(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    head: int = 32,
    piece_rows: int = 2000,
    piece_bytes: int = 1 << 20,
    payload: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and ``row``, the whole input row).

    Rows are range-partitioned by their normalised bytes at splitters that Spark samples. A splitter holds the
    first ``head`` characters and a hash of the rest, so that it stays short and texts with a common beginning
    still part. Within a partition the external sort puts equal texts side by side, and every row is compared in
    full with its predecessor. A text whose copies exceed ``piece_rows`` rows or ``piece_bytes`` bytes is hot: its
    copies are spread over several pieces by identifier, and its totals come from an aggregate that is combined
    before the shuffle.

    Texts are equal when identical after lower-casing A-Z. A null text counts as empty. ``keep`` is "smallest" or
    "largest" identifier; a null identifier stays only in a group without others, whose ``keep_id`` is then null.
    Exactly one row of a group is kept: of rows that repeat an identifier, any one. No other column is read unless
    ``payload`` asks for the whole row, which is nested and so cannot clash. An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    first, best = (F.asc_nulls_last, F.min) if keep == "smallest" else (F.desc_nulls_last, F.max)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    folded = F.lower(text)  # coarser than the normalisation below, so equal texts agree on it
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("body"),
        F.substring(folded, 1, head).alias("head"),
        F.xxhash64(folded).alias("rest"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if payload else []),
    )
    pieces = F.greatest(F.ceil(F.col("n") / piece_rows), F.ceil(F.col("size") / piece_bytes)).cast("int")
    sizes = rows.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("body")).alias("size"))
    hot = written(sizes.filter(F.col("n") > 1).select("rest", pieces.alias("pieces")).filter("pieces > 1"), "hot-texts")
    few = has_at_most(hot, BROADCAST_ROWS)  # the bound holds for the totals below as well
    small = F.broadcast if few else (lambda df: df)
    rows = rows.join(small(hot), "rest", "left").withColumn(
        "salt", F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("id"), F.col("pieces"))).otherwise(F.lit(0))
    )

    together = ["head", "rest", "salt"]
    ranged = rows.repartitionByRange(*together).withColumn("norm", lower_ascii(F.col("body")))
    if not payload:
        ranged = ranged.drop("body")
    order = Window.partitionBy(*together).orderBy("norm", first("id"))
    previous = F.lag("norm").over(order)
    runs = (
        ranged.withColumn("starts", (previous.isNull() | (previous != F.col("norm"))).cast("long"))
        .withColumn("run", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("text_sha256", F.sha2(F.col("norm"), 256))
        .drop("norm", "body", "starts")
    )
    run = Window.partitionBy(*together, "run")
    local = (
        runs.withColumn("place", F.row_number().over(run.orderBy(first("id"))))
        .withColumn("n_here", F.count(F.lit(1)).over(run))
        .withColumn("best_here", best("id").over(run))
    )
    totals = (
        rows.filter(F.col("pieces").isNotNull())
        .groupBy(lower_ascii(F.col("body")).alias("norm"))
        .agg(best("id").alias("best_all"), F.count(F.lit(1)).alias("n_all"))
        .select(F.sha2("norm", 256).alias("text_sha256"), "best_all", "n_all")
    )
    joined = local.join(small(totals), "text_sha256", "left")
    keep_id = F.when(F.col("n_all").isNull(), F.col("best_here")).otherwise(F.col("best_all"))
    return joined.select(
        F.col("id").alias("doc_id"),
        keep_id.alias("keep_id"),
        F.coalesce("n_all", "n_here").cast("long").alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
        *(["row"] if payload else []),
    )


def keep_distinct(docs: DataFrame, keep: str = "smallest", **options) -> DataFrame:
    """The rows of ``docs`` that ``content_sort`` keeps, with all their columns."""
    marked = content_sort(docs, keep=keep, payload=True, **options)
    return marked.filter("kept").select("row.*")
