"""Strict-history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsieve.operators.history import add_history_features
from flowsieve.plans.star import featured, payments_sql
from flowsieve.sources.schema import HISTORY_NUMERIC

GROUPS = {
    "history_counts": [
        "hist_sender_sent_count", "hist_sender_received_count", "hist_receiver_received_count",
        "hist_receiver_sent_count", "hist_sender_seen", "hist_receiver_seen",
    ],
    "history_unique": ["hist_sender_unique_receivers", "hist_receiver_unique_senders"],
    "history_pairs": [
        "hist_pair_count", "hist_reverse_pair_count", "hist_pair_seen", "hist_reverse_pair_seen",
    ],
    "history_money": [
        "hist_sender_total_sent", "hist_receiver_total_received", "hist_sender_mean_sent",
        "hist_receiver_mean_received", "hist_amount_vs_sender_mean", "hist_amount_vs_receiver_mean",
    ],
    "history_ratios": ["hist_sender_out_in_ratio", "hist_receiver_in_out_ratio"],
    "history_recency": ["hist_sender_hours_since_sent", "hist_receiver_hours_since_received"],
    "history_windows": [
        "hist_sender_sent_24h", "hist_receiver_received_24h", "hist_sender_sent_7d", "hist_receiver_received_7d",
    ],
    "history_full": HISTORY_NUMERIC,
}


COLUMNS = ["row_key", "ts", "from_account_id", "to_account_id", "amount_paid", "amount_received"]


def _query(names):
    def run(spark, sf_dir):
        history = add_history_features(featured(spark, sf_dir).select(*COLUMNS), tie=["row_key"])
        return history.select("row_key", *[F.round(n, 6).alias(n) for n in names])

    return run


_HISTORY_SQL = f"""WITH {payments_sql()},
ev AS (SELECT row_key, ts, s AS a, 0 AS role FROM txn UNION ALL SELECT row_key, ts, r AS a, 1 AS role FROM txn),
roles AS (SELECT row_key, role,
    count(*) FILTER (role = 0) OVER w AS sent_before, count(*) FILTER (role = 1) OVER w AS recv_before
  FROM ev WINDOW w AS (PARTITION BY a ORDER BY ts, row_key, role ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_seen AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY s, r ORDER BY ts, row_key) = 1 THEN 1 ELSE 0 END AS is_first
  FROM txn),
h AS (SELECT t.row_key, t.amount_paid, t.amount_received, t.ts, t.s, t.r,
    count(*) OVER ps AS s_n, count(*) OVER pr AS r_n,
    coalesce(sum(is_first) OVER ps, 0) AS s_uniq, coalesce(sum(is_first) OVER pr, 0) AS r_uniq,
    count(*) OVER pp AS pair_n,
    count(*) OVER pu AS both_n,
    coalesce(sum(CAST(amount_paid AS DECIMAL(18,4))) OVER ps, 0) AS s_total,
    coalesce(sum(CAST(amount_received AS DECIMAL(18,4))) OVER pr, 0) AS r_total,
    lag(ts) OVER (PARTITION BY s ORDER BY ts, row_key) AS s_last,
    lag(ts) OVER (PARTITION BY r ORDER BY ts, row_key) AS r_last,
    count(*) OVER s_old24 AS s_old24, count(*) OVER r_old24 AS r_old24,
    count(*) OVER s_old7 AS s_old7, count(*) OVER r_old7 AS r_old7
  FROM first_seen t
  WINDOW ps AS (PARTITION BY s ORDER BY ts, row_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    pr AS (PARTITION BY r ORDER BY ts, row_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    pp AS (PARTITION BY s, r ORDER BY ts, row_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    pu AS (PARTITION BY least(s, r), greatest(s, r) ORDER BY ts, row_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    s_old24 AS (PARTITION BY s ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '86400.000001 seconds' PRECEDING),
    r_old24 AS (PARTITION BY r ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '86400.000001 seconds' PRECEDING),
    s_old7 AS (PARTITION BY s ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '604800.000001 seconds' PRECEDING),
    r_old7 AS (PARTITION BY r ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '604800.000001 seconds' PRECEDING)),
n AS (SELECT h.row_key, h.ts, s_last, r_last, CAST(s_n AS DOUBLE) AS s_n, CAST(r_n AS DOUBLE) AS r_n,
    CAST(a.recv_before AS DOUBLE) AS s_recv,
    CAST(b.sent_before - CASE WHEN s = r THEN 1 ELSE 0 END AS DOUBLE) AS r_sent,
    CAST(s_uniq AS DOUBLE) AS s_uniq, CAST(r_uniq AS DOUBLE) AS r_uniq, CAST(pair_n AS DOUBLE) AS pair_n,
    CAST(CASE WHEN s = r THEN pair_n ELSE both_n - pair_n END AS DOUBLE) AS rev_n,
    CAST(s_total AS DOUBLE) AS s_total, CAST(r_total AS DOUBLE) AS r_total, amount_paid, amount_received,
    CASE WHEN s_n > 0 THEN CAST(s_total AS DOUBLE) / s_n ELSE 0 END AS s_mean,
    CASE WHEN r_n > 0 THEN CAST(r_total AS DOUBLE) / r_n ELSE 0 END AS r_mean,
    CAST(s_n - s_old24 AS DOUBLE) AS s24, CAST(r_n - r_old24 AS DOUBLE) AS r24,
    CAST(s_n - s_old7 AS DOUBLE) AS s7, CAST(r_n - r_old7 AS DOUBLE) AS r7
  FROM h JOIN roles a ON h.row_key = a.row_key AND a.role = 0 JOIN roles b ON h.row_key = b.row_key AND b.role = 1),
f AS (SELECT row_key,
    ln(1 + s_n) AS hist_sender_sent_count, ln(1 + s_recv) AS hist_sender_received_count,
    ln(1 + r_n) AS hist_receiver_received_count, ln(1 + r_sent) AS hist_receiver_sent_count,
    ln(1 + s_uniq) AS hist_sender_unique_receivers, ln(1 + r_uniq) AS hist_receiver_unique_senders,
    ln(1 + pair_n) AS hist_pair_count, ln(1 + rev_n) AS hist_reverse_pair_count,
    ln(1 + s_total) AS hist_sender_total_sent, ln(1 + r_total) AS hist_receiver_total_received,
    ln(1 + s_mean) AS hist_sender_mean_sent, ln(1 + r_mean) AS hist_receiver_mean_received,
    ln(1 + s_n / (s_recv + 1)) AS hist_sender_out_in_ratio, ln(1 + r_n / (r_sent + 1)) AS hist_receiver_in_out_ratio,
    CASE WHEN s_last IS NULL THEN 720 ELSE least(CAST(epoch_us(ts) - epoch_us(s_last) AS DOUBLE) / 3600000000, 720) END
      AS hist_sender_hours_since_sent,
    CASE WHEN r_last IS NULL THEN 720 ELSE least(CAST(epoch_us(ts) - epoch_us(r_last) AS DOUBLE) / 3600000000, 720) END
      AS hist_receiver_hours_since_received,
    ln(1 + s24) AS hist_sender_sent_24h, ln(1 + r24) AS hist_receiver_received_24h,
    ln(1 + s7) AS hist_sender_sent_7d, ln(1 + r7) AS hist_receiver_received_7d,
    ln(1 + amount_paid / (s_mean + 1)) AS hist_amount_vs_sender_mean,
    ln(1 + amount_received / (r_mean + 1)) AS hist_amount_vs_receiver_mean,
    CASE WHEN s_n + s_recv > 0 THEN 1.0 ELSE 0.0 END AS hist_sender_seen,
    CASE WHEN r_n + r_sent > 0 THEN 1.0 ELSE 0.0 END AS hist_receiver_seen,
    CASE WHEN pair_n > 0 THEN 1.0 ELSE 0.0 END AS hist_pair_seen,
    CASE WHEN rev_n > 0 THEN 1.0 ELSE 0.0 END AS hist_reverse_pair_seen
  FROM n)
"""

QUERIES = {name: _query(columns) for name, columns in GROUPS.items()}
SQL = {
    name: _HISTORY_SQL
    + "SELECT row_key, "
    + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in columns)
    + " FROM f"
    for name, columns in GROUPS.items()
}
