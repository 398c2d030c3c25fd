"""The three end-to-end studies as one call each: payments in, result tables out.

Every function writes its tables below ``out`` (small results as CSV, row tables as Parquet) and returns
their paths. Stages share written tables instead of recomputing them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.operators import accounts as A
from flowsieve.operators import bootstrap as B
from flowsieve.operators import clustering as K
from flowsieve.operators import graph as G
from flowsieve.operators import metrics as M
from flowsieve.operators import models as L
from flowsieve.operators import preparation as P
from flowsieve.operators import rates as R
from flowsieve.operators import reports
from flowsieve.operators import sampling as X
from flowsieve.operators import selection as S
from flowsieve.operators.features import add_base_features, split_missing_time
from flowsieve.operators.history import add_history_features
from flowsieve.session import written
from flowsieve.sources import payments as IO
from flowsieve.sources.schema import BASE_NUMERIC, CATEGORICAL, GRAPH_NUMERIC

KEY = "row_key"
MODEL_COLUMNS = [KEY, "ts", "is_laundering", *BASE_NUMERIC, *CATEGORICAL]
NATURAL_MODEL = L.BOOSTING_GRAPH


def _result(df: DataFrame, out: str, name: str, paths: dict) -> None:
    paths[name] = f"{out}/{name}"
    IO.write_result(df, paths[name])


def core_study(
    payments: DataFrame, out: str, specs: list[L.Spec] = L.ALL_SPECS, overrides: dict | None = None,
    target_negatives: int = 160_000, max_edges: int | None = None,
) -> dict[str, str]:
    """Rates and stats, case-control sample, base and graph features, clustering, all models.

    ``payments`` has the typed payment columns and a unique ``row_key``.
    """
    paths: dict[str, str] = {}
    rows = add_base_features(payments)
    _result(R.payment_format_rates(payments), out, "payment_format_rates", paths)
    _result(R.hourly_rates(payments), out, "hourly_rates", paths)
    _result(R.quality_profile(payments.drop(KEY)), out, "quality_profile", paths)
    paths["dataset_stats"] = f"{out}/dataset_stats"
    R.stats_document(payments).write.text(paths["dataset_stats"])

    sample = X.case_control_sample(rows, KEY, target_negatives)
    paths["model_sample_features"] = f"{out}/model_sample_features"
    IO.write_feature_store(G.retrospective_features(written(sample, "sample"), max_edges=max_edges), paths["model_sample_features"])
    features = payments.sparkSession.read.parquet(paths["model_sample_features"])

    clustered = cluster_transactions(features)
    _result(clustered["metrics"], out, "clustering_metrics", paths)
    _result(clustered["profiles"], out, "cluster_profiles", paths)

    split = written(X.nested_split(features.select(*MODEL_COLUMNS, *GRAPH_NUMERIC), KEY), "split")
    table, fitted = L.evaluate_models(specs, split, overrides)
    table = written(table, "metrics")
    _result(table.orderBy("model", "split"), out, "metrics_by_split", paths)
    _result(reports.leaderboard(table.filter(F.col("split") == "test")), out, "metrics_summary", paths)
    names = {s.name for s in specs}
    test = table.filter(F.col("split") == "test")
    deltas = [
        reports.ablation_delta(test, "model", base.name, graph.name)
        for base, graph in ((L.FOREST, L.FOREST_GRAPH), (L.BOOSTING, L.BOOSTING_GRAPH))
        if {base.name, graph.name} <= names
    ]
    if deltas:
        _result(reduce(DataFrame.unionByName, deltas), out, "ablation_summary", paths)
    if L.FOREST_GRAPH.name in fitted:
        _result(fitted[L.FOREST_GRAPH.name].importances(20), out, "feature_importance", paths)
    return paths


def cluster_transactions(features: DataFrame, dbscan_rows: int = 12_000) -> dict[str, DataFrame]:
    """K-means on the projected matrix of all rows, DBSCAN on a sample of ``dbscan_rows`` of them.

    Silhouettes are those of squared distances, which need no pairs of points.
    """
    from pyspark.ml.functions import vector_to_array

    setting = K.TRANSACTION_CLUSTERING
    fitted = P.fit_preparation(features, BASE_NUMERIC + GRAPH_NUMERIC, CATEGORICAL)
    keep = [KEY, "is_laundering", "amount_paid", "sender_out_degree"]
    points = fitted.transform(features).select(*keep, vector_to_array("features").alias("x"))
    points = written(K.project(points, K.pca_model(points, min(setting["dims"], len(fitted.names())))), "projected")
    sample = written(X.smallest_draws(points, KEY, dbscan_rows), "dbscan-sample")
    found = {
        "kmeans_cluster": K.kmeans(points, setting["k"]),
        "dbscan_cluster": K.dbscan(sample, setting["eps"], setting["min_points"], setting["dbscan_dims"], key=KEY),
    }
    metrics = profiles = None
    for method, rows in found.items():
        rows = written(rows, "clustered")
        row = K.cluster_counts(rows).withColumn("method", F.lit(method))
        figures = [K.highest_positive_rate(rows, "is_laundering")]
        if row.first()["valid"]:
            figures += [K.silhouette(rows), K.davies_bouldin(rows), K.calinski_harabasz(rows)]
        for figure in figures:
            row = row.withColumns({c: F.lit(v) for c, v in figure.first().asDict().items()})
        profile = K.transaction_profile(rows, "cluster", method)
        metrics = row if metrics is None else metrics.unionByName(row, allowMissingColumns=True)
        profiles = profile if profiles is None else profiles.unionByName(profile)
    return {"metrics": metrics, "profiles": profiles}


def extended_study(
    features: DataFrame, payments: DataFrame, out: str, spec: L.Spec = NATURAL_MODEL, overrides: dict | None = None
) -> dict[str, str]:
    """Account table and clusters, mutual information, top-k ablation, frozen-snapshot audit, natural-prior stress test.

    ``features`` is the stored sample of :func:`core_study`, ``payments`` the whole table.
    """
    paths: dict[str, str] = {}
    paths["account_features"] = f"{out}/account_features"
    whole = add_base_features(payments)
    A.clean_account_matrix(A.account_features(whole)).write.parquet(paths["account_features"])
    accounts = cluster_accounts(features.sparkSession.read.parquet(paths["account_features"]))
    _result(accounts["metrics"], out, "account_clustering_metrics", paths)
    _result(accounts["profiles"], out, "account_cluster_profiles", paths)
    paths["account_projection"] = f"{out}/account_projection"
    accounts["projection"].write.parquet(paths["account_projection"])

    split = written(X.nested_split(features.select(*MODEL_COLUMNS, *GRAPH_NUMERIC), KEY), "split")
    ranking = P.mutual_information(split.filter(F.col("split") != "test"), BASE_NUMERIC + GRAPH_NUMERIC, CATEGORICAL)
    ranking = written(ranking, "mutual-information")
    _result(ranking.orderBy(F.desc("mutual_information")), out, "mutual_information_features", paths)
    _result(S.top_k_ablation(split, ranking, spec, overrides=overrides), out, "feature_selection_ablation", paths)
    _result(frozen_audit(features, spec, overrides), out, "time_based_leakage_check", paths)

    # Natural prior: held-out positives, negatives from the whole table, threshold from validation.
    fitted = L.fit_model(spec, split.filter(F.col("split") == "fit"), overrides)
    validation = fitted.score(split.filter(F.col("split") == "validation"))
    threshold = M.best_f1_threshold(validation).first()["threshold"]
    holdout = whole.join(split.filter(F.col("split") == "test").select(KEY), KEY, "left_semi")
    natural = X.natural_prior_sample(whole, holdout, KEY, exclude=split.filter(F.col("split") != "test"))
    scored = fitted.score(G.retrospective_features(written(natural, "natural"))).select(
        KEY, "is_laundering", "score", F.lit("natural_class_prior_stress_test").alias("evaluation")
    )
    scored = written(scored, "natural-scores")
    _result(M.metrics_table(scored, threshold, ["evaluation"]), out, "natural_distribution_evaluation", paths)
    _result(M.threshold_sweep(scored, threshold), out, "natural_threshold_sweep", paths)
    return paths


def cluster_accounts(accounts: DataFrame, dbscan_rows: int = 20_000) -> dict[str, DataFrame]:
    """K-means on all accounts, DBSCAN on a sample of ``dbscan_rows``, agreement with the label, 2-D coordinates."""
    setting = K.ACCOUNT_CLUSTERING
    scaled = written(K.matrix(accounts, A.ACCOUNT_MODEL_COLUMNS, ["account_id", "account_laundering"]), "account-matrix")
    points = written(K.project(scaled, K.pca_model(scaled, setting["dims"])), "account-points")
    sample = written(X.smallest_draws(points, "account_id", dbscan_rows), "dbscan-sample")
    found = {
        "Account KMeans": K.kmeans(points, setting["k"]),
        "Account DBSCAN": K.dbscan(sample, setting["eps"], setting["min_points"], setting["dbscan_dims"], key="account_id"),
    }
    plane = K.project(scaled, K.pca_model(scaled, 2))
    projection = plane.select("account_id", "account_laundering", F.col("x")[0].alias("pca_1"), F.col("x")[1].alias("pca_2"))
    metrics = profiles = None
    for method, rows in found.items():
        rows = written(rows.select("account_id", "account_laundering", "x", "cluster"), "account-clusters")
        row = K.cluster_counts(rows, min_points=20).withColumn("method", F.lit(method))
        figures = [K.agreement(rows, "account_laundering"), K.highest_positive_rate(rows, "account_laundering")]
        if row.first()["valid"]:
            figures.append(K.silhouette(rows))
        for figure in figures:
            row = row.withColumns({c: F.lit(v) for c, v in figure.first().asDict().items()})
        labelled = accounts.join(rows.select("account_id", "cluster"), "account_id")
        profile = K.account_profile(labelled, "cluster", method)
        metrics = row if metrics is None else metrics.unionByName(row, allowMissingColumns=True)
        profiles = profile if profiles is None else profiles.unionByName(profile)
        name = "kmeans_cluster" if method.endswith("KMeans") else "dbscan_cluster"
        projection = projection.join(rows.select("account_id", F.col("cluster").alias(name)), "account_id", "left")
    return {"metrics": metrics, "profiles": profiles, "projection": projection}


def frozen_audit(features: DataFrame, spec: L.Spec, overrides: dict | None = None) -> DataFrame:
    """Base against frozen-snapshot graph features on a 60/20/20 time split."""
    base = features.drop(*GRAPH_NUMERIC, "event_date")
    split = written(X.chronological_split(base, [KEY]), "chronological")
    train = split.filter(F.col("split") == "train")
    frozen = written(G.frozen_snapshot_features(split, train), "frozen")
    plain = L.Spec("Base, time split", spec.build, spec.params)
    graph = L.Spec("Graph, frozen train snapshot", spec.build, spec.params, tuple(BASE_NUMERIC + GRAPH_NUMERIC))
    named = F.when(F.col("split") == "train", F.lit("fit")).otherwise(F.col("split"))
    settings = {plain.name: overrides or {}, graph.name: overrides or {}}
    table, _ = L.evaluate_models([plain, graph], frozen.withColumn("split", named), settings)
    audit = {r["split"]: r for r in M.split_audit(split).collect()}
    return table.filter(F.col("split") == "test").drop("split").withColumns(
        {
            **{f"{s}_rows": F.lit(r["rows"]) for s, r in audit.items()},
            **{f"{s}_positive_rate": F.lit(r["positive_rate"]) for s, r in audit.items()},
        }
    )


def selection_study(
    features: DataFrame, out: str, specs: list[L.Spec] = (L.LOGISTIC, L.TREE, L.FOREST, L.BOOSTING, L.BOOSTING_GRAPH),
    overrides: dict | None = None, grids: dict = S.GRIDS, temporal_grid: dict = S.TEMPORAL_GRID,
    iterations: int = S.TEMPORAL_ITERATIONS, replicates: int = B.REPLICATES,
) -> dict[str, str]:
    """Grid search on the random split, strict-history selection on the time split, paired bootstrap."""
    paths: dict[str, str] = {}
    split = written(X.stratified_split(features.select(*MODEL_COLUMNS, *GRAPH_NUMERIC), KEY), "split")
    train, test = (split.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    summary, candidates = S.grid_search(list(specs), train, test, KEY, grids, overrides)
    _result(summary, out, "cross_validation_summary", paths)
    _result(candidates, out, "grid_search_candidates", paths)

    known, missing = split_missing_time(features.drop(*GRAPH_NUMERIC, "event_date"))
    paths["rows_without_time"] = f"{out}/rows_without_time"
    missing.write.parquet(paths["rows_without_time"])
    paths["strict_history"] = f"{out}/strict_history"
    IO.write_feature_store(add_history_features(known, [KEY]), paths["strict_history"])
    history = features.sparkSession.read.parquet(paths["strict_history"])
    ordered = written(X.chronological_split(history, [KEY]), "chronological")
    result, listed, predictions = S.temporal_selection(ordered, temporal_grid, iterations)
    result = written(result, "temporal-result")
    _result(result, out, "time_based_history_ablation", paths)
    _result(listed, out, "temporal_model_selection_candidates", paths)
    delta = reports.ablation_delta(result, "feature_set", "base", "strict_expanding_history")
    _result(delta, out, "time_based_history_ablation_delta", paths)
    paths["time_based_test_predictions"] = f"{out}/time_based_test_predictions"
    IO.write_predictions(predictions, paths["time_based_test_predictions"])
    scored = features.sparkSession.read.parquet(paths["time_based_test_predictions"])
    deltas = written(
        B.bootstrap_deltas(scored, KEY, "base_score", "strict_history_score", "y_true", replicates), "deltas"
    )
    interval = B.bootstrap_interval(deltas).withColumn("point_estimate", delta.select("delta_pr_auc").scalar())
    _result(interval, out, "time_based_history_bootstrap_ci", paths)
    return paths
