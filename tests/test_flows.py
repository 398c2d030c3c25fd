"""The three studies end to end on the smallest tables, with small models."""

import os

import pytest

from flowsieve.operators import models as L
from flowsieve.plans import flows
from flowsieve.plans.star import payments

pytestmark = pytest.mark.skipif(not os.environ.get("FLOWSIEVE_SLOW"), reason="minutes long: set FLOWSIEVE_SLOW=1")


@pytest.fixture(scope="module")
def study(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("study"))
    rows = payments(spark, sf_dir)
    return out, rows, flows.core_study(rows, f"{out}/core", [L.TREE, L.BOOSTING, L.BOOSTING_GRAPH], {
        L.BOOSTING.name: {"max_iter": 3}, L.BOOSTING_GRAPH.name: {"max_iter": 3},
    })


def read(spark, path):
    return spark.read.option("header", True).csv(path)


def test_core_study(spark, study):
    _, _, paths = study
    assert read(spark, paths["payment_format_rates"]).count() == 5
    assert read(spark, paths["metrics_by_split"]).count() == 9
    assert read(spark, paths["ablation_summary"]).count() == 1
    assert spark.read.parquet(paths["model_sample_features"]).count() == 6000


def test_extended_study(spark, study):
    out, rows, paths = study
    features = spark.read.parquet(paths["model_sample_features"])
    done = flows.extended_study(features, rows, f"{out}/extended", L.TREE, None)
    assert read(spark, done["feature_selection_ablation"]).count() == 4
    audit = read(spark, done["time_based_leakage_check"]).collect()
    assert {r["train_rows"] for r in audit} == {"3600"} and len(audit) == 2
    assert read(spark, done["natural_threshold_sweep"]).count() > 3
    assert read(spark, done["account_clustering_metrics"]).count() == 2
    assert spark.read.parquet(done["account_projection"]).count() == spark.read.parquet(done["account_features"]).count()


def test_selection_study(spark, study):
    out, _, paths = study
    features = spark.read.parquet(paths["model_sample_features"])
    done = flows.selection_study(
        features, f"{out}/selection", [L.TREE], grids={L.TREE.name: {"max_depth": [3], "min_samples_leaf": [5, 20]}},
        temporal_grid={"learning_rate": [0.1], "max_leaf_nodes": [15], "class_weight": ["balanced"]}, iterations=3, replicates=10,
    )
    assert read(spark, done["grid_search_candidates"]).count() == 2
    assert read(spark, done["time_based_history_ablation"]).count() == 2
    interval = read(spark, done["time_based_history_bootstrap_ci"]).first()
    assert int(interval["bootstrap_resamples"]) <= 10
    assert spark.read.parquet(done["rows_without_time"]).count() == 0
