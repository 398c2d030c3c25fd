"""Account behaviour table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions import columns as C
from flowsieve.sources.schema import ACCOUNT_LOGGED, ACCOUNT_NUMERIC


def hourly_peaks(
    df: DataFrame, sender: str = "from_account_id", receiver: str = "to_account_id", hour: str = "hour"
) -> DataFrame:
    """Busiest hour of day per account and role; role and hour are grouped in one shuffle."""
    roles = F.array(
        F.struct(F.col(sender).alias("account_id"), F.lit(1).alias("sending")),
        F.struct(F.col(receiver).alias("account_id"), F.lit(0).alias("sending")),
    )
    return (
        df.select(hour, F.explode(roles).alias("e"))
        .groupBy("e.account_id", "e.sending", hour)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("account_id")
        .agg(
            F.coalesce(F.max(F.when(F.col("sending") == 1, F.col("n"))), F.lit(0)).alias("max_sent_per_hour"),
            F.coalesce(F.max(F.when(F.col("sending") == 0, F.col("n"))), F.lit(0)).alias("max_received_per_hour"),
        )
    )


def account_features(
    df: DataFrame,
    sender: str = "from_account_id",
    receiver: str = "to_account_id",
    paid: str = "amount_paid",
    received: str = "amount_received",
    label: str = "is_laundering",
    hour: str = "hour",
) -> DataFrame:
    """One row per account with 16 behaviour columns, 5 log columns and the label.

    Both roles of a payment are exploded and combined per (account, partner, role, hour) first; distinct
    partners and peaks then come from the smaller table, so no account is gathered in one task.
    """
    roles = F.array(
        F.struct(
            F.col(sender).alias("account_id"), F.col(receiver).alias("partner"), F.lit(1).alias("sending"),
            C.money(F.col(paid)).alias("amount"),
        ),
        F.struct(
            F.col(receiver).alias("account_id"), F.col(sender).alias("partner"), F.lit(0).alias("sending"),
            C.money(F.col(received)).alias("amount"),
        ),
    )
    cells = (
        df.select(label, hour, F.explode(roles).alias("e"))
        .groupBy("e.account_id", "e.partner", "e.sending", hour)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("e.amount").alias("n_amount"),
            F.sum("e.amount").alias("amount"),
            F.max(label).alias("label"),
        )
    )
    # Two different second levels over the same cells: per partner and per hour, kept apart by ``by_hour``.
    split = cells.select(
        "account_id", "sending", "n", "n_amount", "amount", "label",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("by_hour"), F.col("partner").alias("item")),
                F.struct(F.lit(1).alias("by_hour"), F.col(hour).cast("string").alias("item")),
            )
        ).alias("x"),
    )
    items = split.groupBy("account_id", "sending", "x.by_hour", "x.item").agg(
        F.sum("n").alias("n"),
        F.sum("n_amount").alias("n_amount"),
        F.sum("amount").alias("amount"),
        F.max("label").alias("label"),
    )

    def pick(sending: int, by_hour: int, value):
        return F.when((F.col("sending") == sending) & (F.col("by_hour") == by_hour), value)

    def total(x):
        return F.coalesce(F.sum(x), F.lit(0))

    figures = []
    for sending, count, amount, mean, partners, peak in (
        (1, "sent_count", "total_sent", "mean_sent", "unique_receivers", "max_sent_per_hour"),
        (0, "received_count", "total_received", "mean_received", "unique_senders", "max_received_per_hour"),
    ):
        money = total(pick(sending, 0, F.col("amount"))).cast("double")
        figures += [
            total(pick(sending, 0, F.col("n"))).alias(count),
            money.alias(amount),
            C.safe_ratio(money, total(pick(sending, 0, F.col("n_amount"))).cast("double")).alias(mean),
            F.count(pick(sending, 0, F.lit(1))).alias(partners),
            F.coalesce(F.max(pick(sending, 1, F.col("n"))), F.lit(0)).alias(peak),
        ]
    accounts = items.groupBy("account_id").agg(
        *figures, F.coalesce(F.max((F.col("label") > 0).cast("int")), F.lit(0)).alias("account_laundering")
    )
    c = F.col
    accounts = accounts.withColumns(
        {
            "in_out_count_ratio": c("received_count") / (c("sent_count") + 1),
            "in_out_amount_ratio": C.safe_ratio(c("total_received"), c("total_sent") + 1),
            "net_amount_flow": c("total_received") - c("total_sent"),
            "fan_out_score": c("unique_receivers") / (c("sent_count") + 1),
            "fan_in_score": c("unique_senders") / (c("received_count") + 1),
            "scatter_gather_score": (c("unique_receivers") + 1) / (c("unique_senders") + 1),
        }
    )
    return accounts.select(
        "account_id",
        *ACCOUNT_NUMERIC,
        *[C.log_abs(c(x)).alias(f"log_abs_{x}") for x in ACCOUNT_LOGGED],
        "account_laundering",
    )


ACCOUNT_MODEL_COLUMNS = ACCOUNT_NUMERIC + [f"log_abs_{x}" for x in ACCOUNT_LOGGED]


def clean_account_matrix(accounts: DataFrame) -> DataFrame:
    """Infinities and missing values of the model columns become 0."""
    return accounts.withColumns({x: C.finite_or_zero(F.col(x).cast("double")) for x in ACCOUNT_MODEL_COLUMNS})
