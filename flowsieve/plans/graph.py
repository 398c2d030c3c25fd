"""Account and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsieve.operators import accounts as A
from flowsieve.operators import graph as G
from flowsieve.operators.sampling import chronological_split, exact_case_control
from flowsieve.plans.star import SPARSE_ACCOUNTS, featured, payments_sql
from flowsieve.session import written
from flowsieve.sources.schema import ACCOUNT_LOGGED, ACCOUNT_NUMERIC, GRAPH_NUMERIC

TXN = payments_sql()
SPARSE = payments_sql(SPARSE_ACCOUNTS)
#: SQL repeats the plain power iteration this often, beyond what the digits compared can show.
ROUNDS = 40
#: Below the digits compared.
TOLERANCE = 1e-10


def _rounded(df, keys, digits=6):
    """Keys as they are, floating-point columns rounded."""
    kinds = dict(df.dtypes)
    return df.select(*keys, *[
        (F.round(c, digits) if kinds[c] == "double" else F.col(c)).alias(c) for c in df.columns if c not in keys
    ])


def money_sql(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,4))) AS DOUBLE)"


SENDER_SQL = f"""SELECT s AS from_account_id, count(*) AS sender_out_degree, count(DISTINCT r) AS sender_unique_receivers,
  {money_sql('amount_paid')} AS sender_total_sent,
  {money_sql('amount_paid')} / count(amount_paid) AS sender_mean_sent FROM {{source}} GROUP BY s"""
RECEIVER_SQL = f"""SELECT r AS to_account_id, count(*) AS receiver_in_degree, count(DISTINCT s) AS receiver_unique_senders,
  {money_sql('amount_received')} AS receiver_total_received,
  {money_sql('amount_received')} / count(amount_received) AS receiver_mean_received FROM {{source}} GROUP BY r"""


def pagerank_sql(source: str, rounds: int, damping: float = G.DAMPING) -> str:
    """CTEs pr_edges, pr_nodes and pr_0 ... pr_<rounds> over the edges of ``source``."""
    d = f"CAST({damping} AS DOUBLE)"
    ctes = [
        f"pr_edges AS MATERIALIZED (SELECT DISTINCT s, r FROM {source})",
        """pr_nodes AS MATERIALIZED (SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree
  FROM (SELECT s AS node, 1 AS o, 0 AS i FROM pr_edges UNION ALL SELECT r, 0, 1 FROM pr_edges) GROUP BY node)""",
        "pr_n AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM pr_nodes)",
        "pr_0 AS MATERIALIZED (SELECT node, out_degree, 1 / n AS rank FROM pr_nodes, pr_n)",
    ]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""pr_{i} AS MATERIALIZED (SELECT p.node, p.out_degree, (1 - {d}) / n + {d} * (coalesce(f.flow, 0)
    + (SELECT coalesce(sum(rank), 0) FROM pr_{i-1} WHERE out_degree = 0) / n) AS rank
  FROM pr_{i-1} p CROSS JOIN pr_n LEFT JOIN (SELECT e.r AS node, sum(q.rank / q.out_degree) AS flow
    FROM pr_edges e JOIN pr_{i-1} q ON e.s = q.node GROUP BY e.r) f ON p.node = f.node)"""
        )
    return ",\n".join(ctes)


def graph_features_sql(target: str, history: str, rounds: int) -> str:
    """CTEs for the 13 columns of ``target`` taken from ``history``, ending in ``graph_rows``."""
    return f"""sent AS ({SENDER_SQL.format(source=history)}), recv AS ({RECEIVER_SQL.format(source=history)}),
{pagerank_sql(history, rounds)},
graph_rows AS (SELECT t.*, {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in GRAPH_NUMERIC[:8])},
    coalesce(sender_total_sent, 0) / (coalesce(receiver_total_received, 0) + CAST(0.000001 AS DOUBLE)) AS sent_received_ratio,
    coalesce(ps.rank, 0) AS sender_pagerank, coalesce(pd.rank, 0) AS receiver_pagerank,
    CAST(coalesce(ns.out_degree, 0) AS DOUBLE) AS sample_sender_out_degree,
    CAST(coalesce(nd.in_degree, 0) AS DOUBLE) AS sample_receiver_in_degree
  FROM {target} t LEFT JOIN sent ON t.s = sent.from_account_id LEFT JOIN recv ON t.r = recv.to_account_id
  LEFT JOIN pr_{rounds} ps ON t.s = ps.node LEFT JOIN pr_{rounds} pd ON t.r = pd.node
  LEFT JOIN pr_nodes ns ON t.s = ns.node LEFT JOIN pr_nodes nd ON t.r = nd.node)"""


_GRAPH_OUT = ", ".join(
    f"round({c}, {9 if 'pagerank' in c else 6}) AS {c}" for c in GRAPH_NUMERIC
)


def _graph_out(df):
    return df.select("row_key", *[F.round(c, 9 if "pagerank" in c else 6).alias(c) for c in GRAPH_NUMERIC])


def retro_graph(spark, sf_dir):
    return _graph_out(G.retrospective_features(featured(spark, sf_dir), tolerance=TOLERANCE))


def frozen_snapshot(spark, sf_dir):
    split = chronological_split(featured(spark, sf_dir, SPARSE_ACCOUNTS), ["row_key"])
    train, later = split.filter(F.col("split") == "train"), split.filter(F.col("split") != "train")
    return _graph_out(G.frozen_snapshot_features(later, train, tolerance=TOLERANCE))


POSITIONS_SQL = """positions AS (SELECT *, row_number() OVER (ORDER BY ts, row_key) AS position, count(*) OVER () AS n_rows FROM txn)"""
SPLIT_CASE = """CASE WHEN position <= floor(n_rows * CAST(0.6 AS DOUBLE)) THEN 'train'
  WHEN position <= floor(n_rows * CAST(0.8 AS DOUBLE)) THEN 'validation' ELSE 'test' END"""


def pagerank(spark, sf_dir):
    edges = G.edge_list(featured(spark, sf_dir, SPARSE_ACCOUNTS))
    return G.pagerank(edges, tolerance=TOLERANCE).select("node", F.round("rank", 9).alias("rank"))


def edge_node_lookup(spark, sf_dir):
    rows = featured(spark, sf_dir, SPARSE_ACCOUNTS)
    degrees = written(G.node_degrees(G.edge_list(rows)), "degrees")
    out = G.attach_node_scores(
        rows, degrees, {"out_degree": ("sender_out", "receiver_out"), "in_degree": ("sender_in", "receiver_in")}
    )
    return out.select("row_key", "sender_out", "receiver_out", "sender_in", "receiver_in")


_ACCOUNT_COLUMNS = ["account_id", *ACCOUNT_NUMERIC, *[f"log_abs_{c}" for c in ACCOUNT_LOGGED], "account_laundering"]


def account_features(spark, sf_dir):
    """Sums are decimal and ratios plain divisions, equal to the last bit; only logarithms are rounded."""
    accounts = A.account_features(featured(spark, sf_dir, SPARSE_ACCOUNTS))
    return accounts.withColumns({f"log_abs_{c}": F.round(f"log_abs_{c}", 6) for c in ACCOUNT_LOGGED})


PEAKS_SQL = """peaks AS (SELECT account_id, max(n) FILTER (sending = 1) AS max_sent_per_hour,
    max(n) FILTER (sending = 0) AS max_received_per_hour
  FROM (SELECT account_id, sending, h, count(*) AS n FROM (
      SELECT s AS account_id, 1 AS sending, hour(ts) AS h FROM txn UNION ALL SELECT r, 0, hour(ts) FROM txn)
    GROUP BY ALL) GROUP BY account_id)"""

ACCOUNTS_SQL = f"""sent AS (SELECT s AS account_id, count(*) AS sent_count, {money_sql('amount_paid')} AS total_sent,
    count(DISTINCT r) AS unique_receivers, max(is_laundering) AS bad FROM txn GROUP BY s),
recv AS (SELECT r AS account_id, count(*) AS received_count, {money_sql('amount_received')} AS total_received,
    count(DISTINCT s) AS unique_senders, max(is_laundering) AS bad FROM txn GROUP BY r),
{PEAKS_SQL},
joined AS (SELECT account_id, coalesce(sent_count, 0) AS sent_count, coalesce(received_count, 0) AS received_count,
    coalesce(total_sent, 0) AS total_sent, coalesce(total_received, 0) AS total_received,
    coalesce(total_sent / sent_count, 0) AS mean_sent, coalesce(total_received / received_count, 0) AS mean_received,
    coalesce(unique_receivers, 0) AS unique_receivers, coalesce(unique_senders, 0) AS unique_senders,
    coalesce(max_sent_per_hour, 0) AS max_sent_per_hour, coalesce(max_received_per_hour, 0) AS max_received_per_hour,
    greatest(coalesce(sent.bad, 0), coalesce(recv.bad, 0)) AS account_laundering
  FROM sent FULL JOIN recv USING (account_id) LEFT JOIN peaks USING (account_id)),
accounts AS (SELECT *, CAST(received_count AS DOUBLE) / (sent_count + 1) AS in_out_count_ratio,
    total_received / (total_sent + 1) AS in_out_amount_ratio, total_received - total_sent AS net_amount_flow,
    CAST(unique_receivers AS DOUBLE) / (sent_count + 1) AS fan_out_score,
    CAST(unique_senders AS DOUBLE) / (received_count + 1) AS fan_in_score,
    CAST(unique_receivers + 1 AS DOUBLE) / (unique_senders + 1) AS scatter_gather_score FROM joined),
account_table AS (SELECT *, {', '.join(f'ln(1 + abs({c})) AS log_abs_{c}' for c in ACCOUNT_LOGGED)} FROM accounts)"""

_ACCOUNT_OUT = ", ".join(f"round({c}, 6) AS {c}" if c.startswith("log_abs_") else c for c in _ACCOUNT_COLUMNS)


def account_sample(spark, sf_dir, max_negatives=20_000):
    accounts = written(A.account_features(featured(spark, sf_dir, SPARSE_ACCOUNTS)), "accounts")
    sample = exact_case_control(accounts, "account_id", max_negatives, "account_laundering")
    return sample.select("account_id", "account_laundering")


ACCOUNT_SAMPLE_SQL = """SELECT account_id, account_laundering FROM account_table
QUALIFY account_laundering = 1
  OR row_number() OVER (PARTITION BY account_laundering ORDER BY md5('42#' || account_id), account_id) <= {n}"""

QUERIES = {
    "sender_aggregates": lambda spark, d: _rounded(
        G.sender_aggregates(G.pair_table(featured(spark, d))), ["from_account_id"]
    ),
    "receiver_aggregates": lambda spark, d: _rounded(
        G.receiver_aggregates(G.pair_table(featured(spark, d))), ["to_account_id"]
    ),
    "hourly_peaks": lambda spark, d: A.hourly_peaks(featured(spark, d)),
    "account_features": account_features,
    "account_sample": account_sample,
    "edge_list": lambda spark, d: G.edge_list(featured(spark, d, SPARSE_ACCOUNTS)),
    "node_degrees": lambda spark, d: G.node_degrees(G.edge_list(featured(spark, d, SPARSE_ACCOUNTS))),
    "pagerank": pagerank,
    "edge_node_lookup": edge_node_lookup,
    "retro_graph": retro_graph,
    "frozen_snapshot": frozen_snapshot,
}
SQL = {
    "sender_aggregates": f"""WITH {TXN} SELECT from_account_id, sender_out_degree, sender_unique_receivers,
  round(sender_total_sent, 6) AS sender_total_sent, round(sender_mean_sent, 6) AS sender_mean_sent
  FROM ({SENDER_SQL.format(source='txn')})""",
    "receiver_aggregates": f"""WITH {TXN} SELECT to_account_id, receiver_in_degree, receiver_unique_senders,
  round(receiver_total_received, 6) AS receiver_total_received,
  round(receiver_mean_received, 6) AS receiver_mean_received FROM ({RECEIVER_SQL.format(source='txn')})""",
    "hourly_peaks": f"""WITH {TXN}, {PEAKS_SQL} SELECT account_id, coalesce(max_sent_per_hour, 0) AS max_sent_per_hour,
  coalesce(max_received_per_hour, 0) AS max_received_per_hour FROM peaks""",
    "account_features": f"WITH {SPARSE}, {ACCOUNTS_SQL} SELECT {_ACCOUNT_OUT} FROM account_table",
    "account_sample": f"WITH {SPARSE}, {ACCOUNTS_SQL} {ACCOUNT_SAMPLE_SQL.format(n=20_000)}",
    "edge_list": f"WITH {SPARSE} SELECT DISTINCT s AS src, r AS dst FROM txn",
    "node_degrees": f"WITH {SPARSE}, {pagerank_sql('txn', 0)} SELECT node, out_degree, in_degree FROM pr_nodes",
    "pagerank": f"WITH {SPARSE}, {pagerank_sql('txn', ROUNDS)} SELECT node, round(rank, 9) AS rank FROM pr_{ROUNDS}",
    "edge_node_lookup": f"""WITH {SPARSE}, {pagerank_sql('txn', 0)}
SELECT row_key, CAST(a.out_degree AS DOUBLE) AS sender_out, CAST(b.out_degree AS DOUBLE) AS receiver_out,
  CAST(a.in_degree AS DOUBLE) AS sender_in, CAST(b.in_degree AS DOUBLE) AS receiver_in
FROM txn LEFT JOIN pr_nodes a ON s = a.node LEFT JOIN pr_nodes b ON r = b.node""",
    "retro_graph": f"WITH {TXN}, {graph_features_sql('txn', 'txn', ROUNDS)} SELECT row_key, {_GRAPH_OUT} FROM graph_rows",
    "frozen_snapshot": f"""WITH {SPARSE}, {POSITIONS_SQL}, parts AS MATERIALIZED (SELECT *, {SPLIT_CASE} AS split FROM positions),
train_rows AS (SELECT * FROM parts WHERE split = 'train'), later_rows AS (SELECT * FROM parts WHERE split <> 'train'),
{graph_features_sql('later_rows', 'train_rows', ROUNDS)} SELECT row_key, {_GRAPH_OUT} FROM graph_rows""",
}
