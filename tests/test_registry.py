"""Registered queries against their SQL twins on the smallest tables.

By default one query per family runs; FLOWSIEVE_ORACLES=all runs every query that has a twin.
"""

import os

import pytest
from oracle import compare, duck

from flowsieve.plans import registry

CORE = [
    "payment_format_rates", "base_features", "quality_profile", "stats_json", "ingest_archives", "history_full",
    "sender_aggregates", "account_features", "pagerank", "frozen_snapshot", "chrono_split", "stratified_folds",
    "average_precision", "roc_curve", "metrics_by_split", "threshold_sweep", "paired_bootstrap", "candidate_rank",
    "standardize", "mutual_information", "neighbour_information", "silhouette", "cluster_agreement", "dbscan", "stream_rates",
    "stream_late_rows", "stream_windows", "stream_history", "cluster_max_rate", "txn_cluster_profile",
]
NAMES = sorted(registry.oracle_sql()) if os.environ.get("FLOWSIEVE_ORACLES") == "all" else CORE


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_twin_has_a_query():
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sf_dir, con, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    assert compare(got, con.execute(registry.oracle_sql()[name]).df()) == ""


def test_adapter_figures(spark, sf_dir):
    from flowsieve.plans.star import featured

    from pyspark.sql import functions as F

    rows = featured(spark, sf_dir.replace("sf0.001", "sf0.01"))
    r = rows.agg(
        F.count("*").alias("n"), F.sum("is_laundering").alias("p"), F.count_distinct("ts").alias("ts"),
        F.count_distinct("row_key").alias("keys"), F.sum("same_bank").alias("bank"), F.sum("same_currency").alias("currency"),
        F.sum(F.col("amount_received").cast("decimal(18,4)")).cast("double").alias("received"),
    ).first()
    assert (r["n"], r["p"], r["ts"], r["keys"], r["bank"], r["currency"]) == (60000, 294, 23318, 60000, 8395, 11971)
    assert r["received"] == 3055484605.7969


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 6000


def test_tree_scores_are_whole_and_telling(spark, sf_dir):
    """A constant model, or one that drops rows, fails here."""
    from flowsieve.operators.metrics import ranking_metrics

    got = registry.queries()["tree_scores"](spark, sf_dir)
    rows = got.collect()
    assert len({r["row_key"] for r in rows}) == len(rows) == 6000
    assert {r["split"] for r in rows} == {"fit", "validation", "test"} and len({r["score"] for r in rows}) > 2
    fitted = ranking_metrics(got.filter("split = 'fit'")).first()
    assert fitted["pr_auc"] > 20 * sum(r["is_laundering"] for r in rows) / len(rows)
