"""Counts, positives and rates; all map-side combined aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.functions import columns as C
from flowsieve.session import written


def base_rate(df: DataFrame, label: str = "is_laundering") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positive_rows"),
        (F.sum(label) / F.count(F.lit(1))).alias("positive_rate"),
    )


def rates_by(df: DataFrame, key: Column, name: str, label: str = "is_laundering") -> DataFrame:
    """One row per value of ``key``, a NULL value included."""
    return (
        df.groupBy(key.alias(name))
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum(label).cast("long").alias("laundering"))
        .withColumn("laundering_rate", F.col("laundering") / F.col("transactions"))
    )


def payment_format_rates(df: DataFrame) -> DataFrame:
    return rates_by(df, F.col("payment_format"), "payment_format").orderBy(
        F.desc("laundering_rate"), "payment_format"
    )


def hourly_rates(df: DataFrame, ts: str = "ts") -> DataFrame:
    return rates_by(df, C.hour_or_missing(F.col(ts)), "hour").orderBy("hour")


def label_share(df: DataFrame, label: str = "is_laundering") -> DataFrame:
    """Share of every label value; the window runs over the label values, not over the rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(everything)).alias("share"))


def amount_histogram(
    df: DataFrame, amount: str = "amount_paid", label: str = "is_laundering", bins: int = 60
) -> DataFrame:
    """Density of log10(amount) per label over common bins; every label integrates to 1."""
    values = df.select(label, C.log10_amount(F.col(amount)).alias("x")).filter(F.col("x").isNotNull())
    span = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if span["lo"] is None:
        return values.select(label, F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("density"))
    width = (span["hi"] - span["lo"]) / bins or 1.0
    slot = F.least(F.floor((F.col("x") - F.lit(span["lo"])) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(label, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(label))
    return counts.select(label, "bin", "n", (F.col("n") / (total * F.lit(width))).alias("density"))


def quality_profile(df: DataFrame, row_hash_columns: list[str] | None = None) -> DataFrame:
    """Nulls per column and exact duplicate rows.

    Duplicates are counted by grouping on all columns, so copies are combined before the shuffle.
    """
    columns = row_hash_columns or df.columns
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "null_rows"
    )
    duplicates = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("null_rows"))
        .select(F.lit("<duplicate rows>").alias("column_name"), "null_rows")
    )
    return nulls.unionByName(duplicates).withColumnRenamed("null_rows", "rows")


def stats_document(df: DataFrame, label: str = "is_laundering") -> DataFrame:
    """One JSON document with the base rate and the counts per format, currency and hour; the counts are one pass."""
    # A NULL group is written under the text 'nan'.
    keys = {
        "payment": F.col("payment_format"), "currency": F.col("payment_currency"), "hourly": C.hour_or_missing(F.col("ts")),
    }
    named = df.select(label, *[F.coalesce(k.cast("string"), F.lit("nan")).alias(name) for name, k in keys.items()])
    counts = written(
        named.groupingSets([[name] for name in keys], *keys).agg(
            F.count(F.lit(1)).alias("transactions"), F.sum(label).cast("long").alias("laundering")
        ),
        "stats-counts",
    )
    document = base_rate(df, label)
    for name in keys:
        for suffix, value in (("counts", "transactions"), ("pos", "laundering")):
            entry = F.struct(F.col(name).alias("key"), F.col(value).alias("value"))
            one_row = counts.filter(F.col(name).isNotNull()).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("m"))
            document = document.withColumn(f"{name}_{suffix}", one_row.scalar())
    return document.select(F.to_json(F.struct(*document.columns)).alias("document"))


def positive_rate_of(document: DataFrame) -> DataFrame:
    """Read the base rate back from a stored document."""
    return document.select(
        F.get_json_object("document", "$.positive_rate").cast("double").alias("positive_rate")
    )
