"""Base features of a payment row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions import columns as C


def split_missing_time(df: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(rows with a time and both accounts, the others): history features are undefined for the second part."""
    needed = [ts, *[c for c in ("from_account_id", "to_account_id") if c in df.columns]]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])
    return df.filter(whole), df.filter(~whole)


def add_base_features(df: DataFrame) -> DataFrame:
    """Ten numeric features and the two account keys; row-wise, no shuffle."""
    ts = F.col("ts")
    return df.select(
        "*",
        C.hour_or_missing(ts).alias("hour"),
        C.weekday_or_missing(ts).alias("weekday"),
        C.weekend_flag(ts).alias("is_weekend"),
        C.log_amount(F.col("amount_paid")).alias("log_amount_paid"),
        C.log_amount(F.col("amount_received")).alias("log_amount_received"),
        (F.col("amount_paid") - F.col("amount_received")).alias("amount_diff"),
        C.same_flag(F.col("payment_currency"), F.col("receiving_currency")).alias("same_currency"),
        C.same_flag(F.col("from_bank"), F.col("to_bank")).alias("same_bank"),
        C.account_key(F.col("from_bank"), F.col("from_account")).alias("from_account_id"),
        C.account_key(F.col("to_bank"), F.col("to_account")).alias("to_account_id"),
    )
