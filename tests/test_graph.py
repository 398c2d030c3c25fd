"""Account graph, PageRank, account table, lookups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.operators import graph as G
from flowsieve.operators.accounts import account_features
from flowsieve.session import lookup_join
from flowsieve.sources.schema import GRAPH_NUMERIC


@pytest.fixture(scope="module")
def payments(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        s = "hub" if rng.random() < 0.4 else f"a{rng.randrange(20)}"
        rows.append((f"k{i}", s, f"a{rng.randrange(25)}", round(rng.random() * 100, 2), round(rng.random() * 100, 2), rng.randrange(24), int(rng.random() < 0.1)))
    return spark.createDataFrame(
        rows, "row_key string, from_account_id string, to_account_id string, amount_paid double, amount_received double, hour int, is_laundering int"
    )


def brute_pagerank(edges, damping=0.85, rounds=200):
    nodes = sorted({x for e in edges for x in e})
    at = {n: i for i, n in enumerate(nodes)}
    out = np.zeros(len(nodes))
    for s, _ in edges:
        out[at[s]] += 1
    rank = np.full(len(nodes), 1 / len(nodes))
    for _ in range(rounds):
        flow = np.zeros(len(nodes))
        for s, d in edges:
            flow[at[d]] += rank[at[s]] / out[at[s]]
        rank = (1 - damping) / len(nodes) + damping * (flow + rank[out == 0].sum() / len(nodes))
    return dict(zip(nodes, rank))


@pytest.mark.parametrize("options", [{}, {"broadcast_nodes": 0}, {"broadcast_nodes": 0, "hot_degree": 5, "salts": 4}])
def test_pagerank(payments, options):
    edges = G.edge_list(payments)
    want = brute_pagerank({(r["src"], r["dst"]) for r in edges.collect()})
    got = {r["node"]: r["rank"] for r in G.pagerank(edges, tolerance=1e-4, **options).collect()}
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-9)
    assert got.keys() == want.keys()
    for node, rank in want.items():
        assert got[node] == pytest.approx(rank, rel=1e-3)


def test_pagerank_with_sinks_loops_and_a_slow_cycle(spark):
    """Nodes without outgoing edges, a self loop, a long cycle off the hub; few nodes stay active at the end."""
    pairs = {(f"c{i}", f"c{(i + 1) % 12}") for i in range(12)} | {(f"l{i}", "hub") for i in range(30)}
    pairs |= {("hub", "c0"), ("hub", "sink"), ("self", "self"), ("c3", "sink2")}
    want = brute_pagerank(pairs, damping=0.5)
    df = spark.createDataFrame(sorted(pairs), "src string, dst string")
    got = {r["node"]: r["rank"] for r in G.pagerank(df, damping=0.5, tolerance=1e-4).collect()}
    assert got == pytest.approx(want, rel=1e-3)


def test_pagerank_says_when_it_does_not_converge(spark):
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    with pytest.raises(RuntimeError):
        G.pagerank(chain, max_rounds=1, tolerance=1e-12)


def test_sampled_edges(payments):
    assert G.edge_list(payments, max_edges=50).count() <= 50
    assert G.edge_list(payments, max_edges=10_000).count() == G.edge_list(payments).count()


def test_frozen_snapshot_on_its_own_history_is_retrospective(payments):
    a = {r["row_key"]: r for r in G.retrospective_features(payments).collect()}
    for r in G.frozen_snapshot_features(payments, payments).collect():
        assert [r[c] for c in GRAPH_NUMERIC] == pytest.approx([a[r["row_key"]][c] for c in GRAPH_NUMERIC])


def test_unseen_accounts_get_zero(spark, payments):
    stranger = payments.limit(1).withColumns({"from_account_id": F.lit("new"), "to_account_id": F.lit("newer")})
    r = G.frozen_snapshot_features(stranger, payments).first()
    assert [r[c] for c in GRAPH_NUMERIC] == [0.0] * 13


def test_account_table_matches_pandas(payments):
    p = payments.toPandas()
    got = account_features(payments).toPandas().set_index("account_id")
    for account in got.index:
        sent, recv = p[p.from_account_id == account], p[p.to_account_id == account]
        r = got.loc[account]
        assert (r.sent_count, r.received_count) == (len(sent), len(recv))
        assert (r.unique_receivers, r.unique_senders) == (sent.to_account_id.nunique(), recv.from_account_id.nunique())
        assert r.total_sent == pytest.approx(sent.amount_paid.sum())
        assert r.mean_received == pytest.approx(recv.amount_received.mean() if len(recv) else 0.0)
        assert r.max_sent_per_hour == (sent.groupby("hour").size().max() if len(sent) else 0)
        assert r.max_received_per_hour == (recv.groupby("hour").size().max() if len(recv) else 0)
        assert r.account_laundering == int(sent.is_laundering.any() or recv.is_laundering.any())
        assert r.net_amount_flow == pytest.approx(recv.amount_received.sum() - sent.amount_paid.sum())


def test_lookup_join_spreads_hot_keys(spark, payments):
    table = payments.groupBy("from_account_id").agg(F.count(F.lit(1)).alias("n"))
    plain = {r["row_key"]: r["n"] for r in lookup_join(payments, table, "from_account_id").collect()}
    salted = lookup_join(payments, table, "from_account_id", max_rows=8, hot_rows=30, salts=4)
    assert {r["row_key"]: r["n"] for r in salted.collect()} == plain
    assert "_salt" in salted._jdf.queryExecution().toString()
