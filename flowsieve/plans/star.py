"""Payment edges read from the star schema: one edge per order line, payer = customer, payee = supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.operators.features import add_base_features
from flowsieve.session import BROADCAST_ROWS, has_at_most

ACCOUNTS = 101
SPARSE_ACCOUNTS = 5_003
EPOCH_2022_09_01 = 1_661_990_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payments(spark: SparkSession, sf_dir: str, accounts: int = ACCOUNTS) -> DataFrame:
    """The payment table; ``row_key`` is unique and breaks ties between rows of one minute."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    payer = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("r_name").alias("payment_currency"))
    )
    payee = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("r_name").alias("receiving_currency"))
    )
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    on_order, on_payer, on_payee = (
        F.col(a) == F.col(b) for a, b in (("l_orderkey", "o_orderkey"), ("o_custkey", "c_custkey"), ("l_suppkey", "s_suppkey"))
    )
    if has_at_most(orders, BROADCAST_ROWS):
        joined = lines.join(orders, on_order).join(payer, on_payer).join(payee, on_payee)
    else:
        # Payers meet the orders, which are fewer than the lines; the lines are shuffled once where payees are few.
        few = F.broadcast(payee) if has_at_most(payee, BROADCAST_ROWS) else payee
        joined = lines.join(orders.join(payer, on_payer), on_order).join(few, on_payee)
    day = F.datediff(F.col("l_shipdate"), F.lit("1995-01-01").cast("date"))
    minute = (day % 18) * 1440 + (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131 + F.col("l_partkey")) % 1440
    sender = F.col("o_custkey") % accounts
    receiver = F.col("l_suppkey") % accounts
    paid = F.col("l_extendedprice")
    converted = (
        F.round(paid * 100).cast("long") * F.round(F.lit(100) - F.col("l_discount") * 100).cast("long")
    ).cast("double") / F.lit(10000.0)
    label = (
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & (F.col("l_discount") >= 0.09)
        & (F.col("o_orderpriority") == "1-URGENT")
    ).cast("int")
    return joined.select(
        F.concat_ws(
            "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_quantity").cast("int"), day,
        ).alias("row_key"),
        F.timestamp_seconds(F.lit(EPOCH_2022_09_01) + minute.cast("long") * 60).alias("ts"),
        (sender % 7).alias("from_bank"),
        sender.cast("string").alias("from_account"),
        (receiver % 7).alias("to_bank"),
        receiver.cast("string").alias("to_account"),
        F.when(F.col("payment_currency") == F.col("receiving_currency"), paid)
        .otherwise(converted)
        .alias("amount_received"),
        "receiving_currency",
        paid.alias("amount_paid"),
        "payment_currency",
        F.col("o_orderpriority").alias("payment_format"),
        label.alias("is_laundering"),
        F.round(
            F.lit(0.7) * ((F.col("l_partkey") * 37 + F.col("l_orderkey") * 11) % 1000).cast("double") / F.lit(1000.0)
            + F.lit(0.3) * label,
            6,
        ).alias("score"),
        F.round(
            F.lit(0.7) * ((F.col("l_partkey") * 53 + F.col("l_suppkey") * 17) % 1000).cast("double") / F.lit(1000.0)
            + F.lit(0.15) * label,
            6,
        ).alias("score_b"),
    )


def payments_sql(accounts: int = ACCOUNTS, name: str = "txn") -> str:
    """The same table as a WITH entry for the SQL twins."""
    return f"""{name} AS (
  SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER),
                   date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))) AS row_key,
    TIMESTAMP '2022-09-01 00:00:00' + to_minutes(CAST(
        (date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 18) * 1440
        + (l_orderkey * 7 + l_linenumber * 131 + l_partkey) % 1440 AS BIGINT)) AS ts,
    (o_custkey % {accounts}) % 7 AS from_bank, CAST(o_custkey % {accounts} AS VARCHAR) AS from_account,
    (l_suppkey % {accounts}) % 7 AS to_bank, CAST(l_suppkey % {accounts} AS VARCHAR) AS to_account,
    CASE WHEN cr.r_name = sr.r_name THEN l_extendedprice
         ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT)
                   * CAST(round(100 - l_discount * 100) AS BIGINT) AS DOUBLE) / CAST(10000 AS DOUBLE) END
      AS amount_received,
    sr.r_name AS receiving_currency, l_extendedprice AS amount_paid, cr.r_name AS payment_currency,
    o_orderpriority AS payment_format, y AS is_laundering,
    round(CAST(0.7 AS DOUBLE) * CAST((l_partkey * 37 + l_orderkey * 11) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)
          + CAST(0.3 AS DOUBLE) * y, 6) AS score,
    round(CAST(0.7 AS DOUBLE) * CAST((l_partkey * 53 + l_suppkey * 17) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)
          + CAST(0.15 AS DOUBLE) * y, 6) AS score_b,
    ((o_custkey % {accounts}) % 7) || '_' || (o_custkey % {accounts}) AS s,
    ((l_suppkey % {accounts}) % 7) || '_' || (l_suppkey % {accounts}) AS r
  FROM (SELECT li.*, o.*, CAST(l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount >= 0.09
                               AND o_orderpriority = '1-URGENT' AS INTEGER) AS y
        FROM lineitem li JOIN orders o ON l_orderkey = o_orderkey)
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
)"""


def featured(spark: SparkSession, sf_dir: str, accounts: int = ACCOUNTS) -> DataFrame:
    return add_base_features(payments(spark, sf_dir, accounts))
