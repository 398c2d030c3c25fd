"""Account graph: pair table, degrees, PageRank, retrospective and frozen-snapshot features.

The pair table (one row per sender and receiver) is the only aggregate over the payment rows; sender and
receiver figures, distinct partners, edges and degrees all come from it. Both aggregation levels combine
map-side, so a hub account does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions import columns as C
from flowsieve.operators.sampling import smallest_draws
from flowsieve.session import BROADCAST_ROWS, has_at_most, lookup_join, written
from flowsieve.sources.schema import GRAPH_NUMERIC

# Fixed values of the ranking.
DAMPING = 0.85
MAX_ROUNDS = 200
TOLERANCE = 1e-6


def pair_table(
    df: DataFrame,
    sender: str = "from_account_id",
    receiver: str = "to_account_id",
    paid: str = "amount_paid",
    received: str = "amount_received",
    label: str = "is_laundering",
) -> DataFrame:
    return df.groupBy(F.col(sender).alias("src"), F.col(receiver).alias("dst")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(paid).alias("n_paid"),
        F.count(received).alias("n_received"),
        F.sum(C.money(F.col(paid))).alias("paid"),
        F.sum(C.money(F.col(received))).alias("received"),
        F.max(label).alias("label"),
    )


def sender_aggregates(pairs: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("paid"), F.lit(0)).cast("double")
    return pairs.groupBy(F.col("src").alias("from_account_id")).agg(
        F.sum("n").alias("sender_out_degree"),
        F.count(F.lit(1)).alias("sender_unique_receivers"),
        total.alias("sender_total_sent"),
        F.try_divide(total, F.sum("n_paid").cast("double")).alias("sender_mean_sent"),
    )


def receiver_aggregates(pairs: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("received"), F.lit(0)).cast("double")
    return pairs.groupBy(F.col("dst").alias("to_account_id")).agg(
        F.sum("n").alias("receiver_in_degree"),
        F.count(F.lit(1)).alias("receiver_unique_senders"),
        total.alias("receiver_total_received"),
        F.try_divide(total, F.sum("n_received").cast("double")).alias("receiver_mean_received"),
    )


def edge_list(
    df: DataFrame,
    sender: str = "from_account_id",
    receiver: str = "to_account_id",
    max_edges: int | None = None,
    key: str = "row_key",
    seed: int = 42,
) -> DataFrame:
    """Directed edges, parallel ones collapsed, loops kept; ``max_edges`` samples that many rows first."""
    if max_edges is not None:
        df = smallest_draws(df, key, max_edges, seed)
    return df.select(F.col(sender).alias("src"), F.col(receiver).alias("dst")).distinct()


def node_degrees(edges: DataFrame) -> DataFrame:
    """Distinct neighbours per node in both directions, one shuffle."""
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")),
    )
    return (
        edges.select(F.explode(ends).alias("e"))
        .groupBy(F.col("e.node").alias("node"))
        .agg(F.sum("e.out").cast("long").alias("out_degree"), F.sum("e.into").cast("long").alias("in_degree"))
    )


def _spread_links(edges: DataFrame, nodes: DataFrame, hot_degree: int, salts: int) -> tuple[DataFrame, DataFrame | None]:
    """Edges keyed by (source, salt); sources with more than ``hot_degree`` edges get many salts."""
    hot = nodes.filter(F.col("out_degree") > hot_degree).select("node")
    links = edges.select(F.col("src").alias("node"), "dst")
    if hot.isEmpty():
        return links.withColumn("_salt", F.lit(0)), None
    flag = hot.withColumn("_hot", F.lit(True))
    if has_at_most(hot, BROADCAST_ROWS):
        flag = F.broadcast(flag)
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("dst"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    return links.join(flag, "node", "left").select("node", "dst", salt.alias("_salt")), hot


def pagerank(
    edges: DataFrame,
    damping: float = DAMPING,
    max_rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
    hot_degree: int = 2_000_000,
    salts: int = 64,
    broadcast_nodes: int = BROADCAST_ROWS,
) -> DataFrame:
    """Converged rank of every node, ranks sum to 1.

    Ranks solve ``x = (1 - damping) / n + damping * inflow(x)`` and are scaled to sum 1 at the end, which is the same as
    spreading the rank of nodes without outgoing edges evenly. A node keeps what it has received and not yet passed on;
    in a round only the active nodes, those that keep more than ``tolerance`` times the least possible rank, pass it on.
    What is left when no node is active bounds the error of a rank by about ``tolerance``. Few active nodes are
    broadcast, so late rounds read the edges without a shuffle. Every round's state - one narrow row per node - is
    written to the shared folder: plans stay flat and a lost executor costs one round. The driver only sees the number
    of active nodes and the sum of what is kept. Raises when some are left after ``max_rounds``.
    """
    edges = written(edges, "pagerank-edges")
    nodes = written(node_degrees(edges).select("node", "out_degree"), "pagerank-nodes")
    n = nodes.count()
    if n == 0:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    hot = None
    if n <= broadcast_nodes:
        links = edges.select(F.col("src").alias("node"), "dst")
    else:
        links, hot = _spread_links(edges, nodes, hot_degree, salts)
        parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Shuffled and sorted once, into the shared folder: a lost executor costs no round.
        links = written(links.repartition(parts, "node", "_salt").sortWithinPartitions("node", "_salt"), "pagerank-links")

    def inflow(sending: DataFrame, count: int) -> DataFrame:
        """Sum per target of what ``sending`` (node, share) passes along its edges, combined map-side."""
        if count <= broadcast_nodes:
            sent = links.join(F.broadcast(sending), "node")
        elif hot is None:
            sent = links.join(sending.withColumn("_salt", F.lit(0)), ["node", "_salt"])
        else:
            every = F.sequence(F.lit(0), F.lit(salts - 1))
            copies = sending.join(hot.withColumn("_hot", F.lit(True)), "node", "left").select(
                "node", "share", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))).alias("_salt")
            )
            sent = links.join(copies, ["node", "_salt"])
        return sent.groupBy(F.col("dst").alias("node")).agg((F.lit(damping) * F.sum("share")).alias("flow"))

    least = (1.0 - damping) / n
    active = F.abs("kept") > F.lit(tolerance * least)
    sends = active & (F.col("out_degree") > 0)
    arrived = F.coalesce(F.col("flow"), F.lit(0.0))
    start = inflow(nodes.filter("out_degree > 0").select("node", (F.lit(1.0 / n) / F.col("out_degree")).alias("share")), n)
    state = nodes.join(start, "node", "left").select(
        "node", "out_degree", F.lit(1.0 / n).alias("rank"), (F.lit(least - 1.0 / n) + arrived).alias("kept")
    )
    for _ in range(max_rounds):
        state = written(state, "pagerank-ranks")
        # Any multiple of the ranks will do: the one whose rest sums to 0 leaves only differences between nodes.
        rest = state.agg(F.sum("kept")).first()[0]
        scale = (1.0 - damping) / (1.0 - damping - rest)
        if abs(1.0 - scale) > tolerance:
            kept = F.lit(scale) * F.col("kept") + F.lit((1.0 - scale) * least)
            state = state.withColumns({"rank": F.lit(scale) * F.col("rank"), "kept": kept})
        count, sending = state.agg(F.count_if(active), F.count_if(sends)).first()
        if count == 0:
            break
        passed = state.filter(sends).select("node", (F.col("kept") / F.col("out_degree")).alias("share"))
        state = state.join(inflow(passed, sending), "node", "left").select(
            "node",
            "out_degree",
            F.when(active, F.col("rank") + F.col("kept")).otherwise(F.col("rank")).alias("rank"),
            (F.when(active, F.lit(0.0)).otherwise(F.col("kept")) + arrived).alias("kept"),
        )
    else:
        state = written(state, "pagerank-ranks")
        left = state.agg(F.count_if(active)).first()[0]
        if left:
            raise RuntimeError(f"ranks did not converge in {max_rounds} rounds ({left} of {n} nodes still change)")
    total = state.agg(F.sum(F.col("rank") + F.col("kept"))).first()[0]
    return state.select("node", ((F.col("rank") + F.col("kept")) / F.lit(total)).alias("rank"))


def attach_node_scores(
    df: DataFrame, nodes: DataFrame, values: dict[str, tuple[str, str]], sender="from_account_id", receiver="to_account_id"
) -> DataFrame:
    """Node figures on both ends of every edge, 0 for unknown nodes.

    ``values`` maps a node column to its name on the sender and on the receiver side (None skips a side).
    """
    for side, end in ((0, sender), (1, receiver)):
        names = {column: pair[side] for column, pair in values.items() if pair[side]}
        figures = nodes.select(F.col("node").alias(end), *[F.col(c).alias(n) for c, n in names.items()])
        df = lookup_join(df, figures, end)
        df = df.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("double") for n in names.values()})
    return df


def graph_nodes(edges: DataFrame, **pagerank_options) -> DataFrame:
    return node_degrees(edges).join(pagerank(edges, **pagerank_options), "node")


def graph_features(
    target: DataFrame,
    history: DataFrame,
    max_edges: int | None = None,
    seed: int = 42,
    key: str = "row_key",
    **pagerank_options,
) -> DataFrame:
    """``target`` plus the 13 account features taken from ``history``; accounts unseen there get 0.

    ``history = target`` is the retrospective set, a training period is the frozen snapshot.
    """
    pairs = written(pair_table(history), "pairs")
    edges = pairs.select("src", "dst") if max_edges is None else edge_list(history, max_edges=max_edges, key=key, seed=seed)
    nodes = written(graph_nodes(edges, **pagerank_options), "graph-nodes")
    # Everything about an account is joined account by account first: the rows are joined twice, not four times.
    sender_nodes = nodes.select(
        F.col("node").alias("from_account_id"),
        F.col("rank").alias("sender_pagerank"),
        F.col("out_degree").alias("sample_sender_out_degree"),
    )
    receiver_nodes = nodes.select(
        F.col("node").alias("to_account_id"),
        F.col("rank").alias("receiver_pagerank"),
        F.col("in_degree").alias("sample_receiver_in_degree"),
    )
    senders = written(sender_aggregates(pairs).join(sender_nodes, "from_account_id", "full"), "senders")
    receivers = written(receiver_aggregates(pairs).join(receiver_nodes, "to_account_id", "full"), "receivers")
    rows = lookup_join(lookup_join(target, senders, "from_account_id"), receivers, "to_account_id")
    known = [c for c in GRAPH_NUMERIC if c != "sent_received_ratio"]
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in known})
    ratio = F.col("sender_total_sent") / (F.col("receiver_total_received") + F.lit(1e-6))
    return rows.withColumn("sent_received_ratio", ratio).select(*target.columns, *GRAPH_NUMERIC)


def retrospective_features(df: DataFrame, **options) -> DataFrame:
    """Aggregates over the whole table joined back to its own rows (sees the future: for analysis only)."""
    return graph_features(df, df, **options)


def frozen_snapshot_features(target: DataFrame, history: DataFrame, **options) -> DataFrame:
    """Aggregates of a finished period joined to later rows."""
    return graph_features(target, history, **options)


