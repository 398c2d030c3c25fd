"""Preparation and models."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flowsieve.operators import draws as D
from flowsieve.operators import metrics as M
from flowsieve.operators import models as L
from flowsieve.operators import neighbours as N
from flowsieve.operators import preparation as P
from flowsieve.operators import sampling as X
from flowsieve.operators import selection as S


def test_preparation(spark):
    rows = [(1.0, 5.0, "a")] * 30 + [(3.0, 5.0, "b")] * 25 + [(None, 5.0, None)] * 5 + [(9.0, 5.0, "rare")] * 3
    df = spark.createDataFrame(rows, "x double, constant double, c string")
    fitted = P.fit_preparation(df, ["x", "constant"], ["c"])
    assert fitted.median["x"] == 1.0 and fitted.mode["c"] == "a"
    assert fitted.names() == ["num__x", "num__constant", "cat__c_a", "cat__c_b", "cat__c_infrequent"]
    new = spark.createDataFrame([(None, 5.0, "rare"), (1.0, 5.0, "unknown"), (1.0, 6.0, None)], "x double, constant double, c string")
    got = [[round(v, 6) for v in r["features"]] for r in fitted.transform(new).collect()]
    assert got[0][1:] == [0.0, 0.0, 0.0, 1.0]
    assert got[1][2:] == [0.0, 0.0, 0.0]
    assert got[2][1:] == [1.0, 1.0, 0.0, 0.0]
    figures = df.select(fitted.encoded()["num__x"].alias("z")).agg(F.avg("z"), F.stddev_pop("z")).first()
    assert list(figures) == pytest.approx([0.0, 1.0], abs=1e-9)


def test_mutual_information_ranks_the_telling_feature(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(2000):
        y = int(rng.random() < 0.2)
        rows.append((y, y + rng.gauss(0, 0.3), rng.gauss(0, 1), "p" if y else "q"))
    df = spark.createDataFrame(rows, "is_laundering int, good double, noise double, c string")
    mi = {r["feature"]: r["mutual_information"] for r in P.mutual_information(df, ["good", "noise"], ["c"]).collect()}
    assert mi["cat__c_p"] > mi["num__good"] > 10 * mi["num__noise"] >= 0


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    data = []
    for i in range(1500):
        y = int(rng.random() < 0.1)
        data.append((f"k{i}", y, rng.gauss(0, 1) + 1.5 * y, rng.gauss(0, 1), rng.choice(["a", "b"])))
    df = spark.createDataFrame(data, "row_key string, is_laundering int, u double, v double, c string")
    return X.nested_split(df, "row_key").cache()


def spec(build, **params):
    return L.Spec(build.__name__, build, params, ("u", "v"), ("c",))


@pytest.mark.parametrize(
    "model",
    [spec(L._logistic), spec(L._tree, max_depth=4, min_samples_leaf=20), spec(L._svm),
     spec(L._forest, n_estimators=10, max_depth=6), spec(L._boosting, max_iter=5, max_leaf_nodes=15)],
    ids=lambda s: s.name,
)
def test_models_beat_the_base_rate(rows, model):
    fitted = L.fit_model(model, rows.filter("split = 'fit'"))
    ap = M.ranking_metrics(fitted.score(rows.filter("split = 'test'"))).first()
    assert ap["pr_auc"] > 0.25 and ap["roc_auc"] > 0.75


@pytest.mark.parametrize(
    "model",
    [spec(L._logistic), spec(L._svm), spec(L._forest, n_estimators=5, max_depth=4)],
    ids=lambda s: s.name,
)
def test_scores_can_be_written_after_an_observation(spark, rows, tmp_path, model):
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 1500
    path = str(tmp_path / "scores")
    L.fit_model(model, rows.filter("split = 'fit'")).score(rows).write.parquet(path)
    assert spark.read.parquet(path).filter("score is not null").count() == 1500


def test_same_seed_same_scores(rows):
    model = spec(L._forest, n_estimators=5, max_depth=5)
    a, b = (
        [r["score"] for r in L.fit_model(model, rows.filter("split = 'fit'")).score(rows).orderBy("row_key").collect()]
        for _ in range(2)
    )
    assert a == b


def test_class_weights(rows):
    table = {r["is_laundering"]: r for r in L.class_weights(rows).collect()}
    assert sum(r["n"] * r["weight"] for r in table.values()) == pytest.approx(1500)
    assert table[1]["n"] * table[1]["weight"] == pytest.approx(750)


def test_grid_search(rows):
    train, test = rows.filter("split <> 'test'").drop("split"), rows.filter("split = 'test'").drop("split")
    tree = spec(L._tree)
    summary, candidates = S.grid_search([tree], train, test, grids={tree.name: {"max_depth": [1, 4], "min_samples_leaf": [20]}})
    table = candidates.collect()
    assert sorted(r["rank_cv_pr_auc"] for r in table) == [1, 2]
    best = max(table, key=lambda r: r["mean_cv_pr_auc"])
    row = summary.first()
    assert row["best_params"] == best["params"] and row["tn"] + row["fp"] + row["fn"] + row["tp"] == test.count()


def test_evaluate_models_and_importances(rows):
    model = spec(L._tree, max_depth=4, min_samples_leaf=20)
    table, fitted = L.evaluate_models([model, spec(L._logistic)], rows)
    by = {(r["model"], r["split"]): r for r in table.collect()}
    assert len(by) == 6
    for c in ("tn", "fp", "fn", "tp"):
        assert by[model.name, "train"][c] + by[model.name, "test"][c] == by[model.name, "full"][c]
    top = fitted[model.name].importances(2).collect()
    assert top[0]["feature"] == "num__u" and len(top) == 2


def test_top_k_ablation(rows):
    model = spec(L._tree, max_depth=4, min_samples_leaf=20)
    ranking = P.mutual_information(rows.filter("split = 'fit'"), ["u", "v"], ["c"])
    table = {r["feature_set"]: r for r in S.top_k_ablation(rows, ranking, model, sizes=(1,)).collect()}
    assert table["Top-1 mutual information features"]["n_features"] == 1
    assert table["Top-1 mutual information features"]["pr_auc"] > 0.25


def brute_information(values, labels, k=3):
    """All pairs of a few rows."""
    from collections import Counter
    from math import fsum, log

    def psi(n):
        return fsum(1 / i for i in range(1, n)) - 0.5772156649015329

    sizes = Counter(labels)
    rows = [(x, y) for x, y in zip(values, labels) if sizes[y] > 1]
    terms = []
    for i, (x, y) in enumerate(rows):
        same = sorted(abs(x - a) for j, (a, b) in enumerate(rows) if b == y and j != i)
        near = min(k, sizes[y] - 1)
        r = same[near - 1]
        if r == 0:
            near, m = same.count(0), sum(a == x for a, _ in rows) - 1
        else:
            m = sum(abs(a - x) < r - 1e-12 * (abs(x) + r) for a, _ in rows)
        terms.append(psi(near) - psi(sizes[y]) - psi(m))
    return max(0.0, psi(len(rows)) + fsum(terms) / len(rows))


@pytest.mark.parametrize("slice_rows", [1_000_000, 9])
def test_neighbour_information_equals_all_pairs(spark, slice_rows):
    rng = random.Random(8)
    rows = []
    for i in range(500):
        y = int(rng.random() < 0.3) if i else 7  # one row alone in its class
        rows.append((y, y + rng.gauss(0, 0.5), round(rng.gauss(0, 1), 1), rng.choice([1.0, 1.0, 1.0, 2.0]), "p" if rng.random() < 0.4 + 0.4 * y else "q"))
    rows += [(0, None, float("nan"), 1.0, None), (1, float("inf"), 0.25, 2.0, "p"), (None, 1.0, 1.0, 1.0, "p")]
    df = spark.createDataFrame(rows, "is_laundering int, dense double, grid double, few double, c string").repartition(3)
    got = {r["feature"]: r["mutual_information"] for r in N.neighbour_information(df, ["dense", "grid", "few"], ["c"], slice_rows=slice_rows).collect()}
    known = [r for r in rows if r[0] is not None]
    labels = [r[0] for r in known]
    for i, c in enumerate(("dense", "grid", "few"), 1):
        finite = sorted(r[i] for r in known if r[i] is not None and abs(r[i]) < float("inf"))
        n = len(finite)
        median = (finite[(n - 1) // 2] + finite[n // 2]) / 2
        filled = [r[i] if r[i] is not None and abs(r[i]) < float("inf") else median for r in known]
        assert got[f"num__{c}"] == pytest.approx(brute_information(filled, labels), abs=1e-9), c
    mode = max("pq", key=lambda v: sum(r[4] == v for r in known))
    for v in "pq":
        assert got[f"cat__c_{v}"] == pytest.approx(brute_information([float((r[4] or mode) == v) for r in known], labels), abs=1e-9)
    assert got["num__dense"] > 0.3 > got["num__few"]


def test_neighbour_information_of_no_rows(spark):
    empty = spark.createDataFrame([], "is_laundering int, x double, c string")
    assert N.neighbour_information(empty, ["x"], ["c"]).count() == 0


def test_draws_are_balanced_poisson_draws(rows):
    every = rows.select("row_key", "is_laundering")
    got = D.drawn_rows(every, 3, "row_key")
    n, weight, copies = {}, {}, {}
    for r in got.groupBy("is_laundering").agg(F.count("*").alias("n"), F.sum("weight").alias("w"), F.sum("copies").alias("c")).collect():
        n[r[0]], weight[r[0]], copies[r[0]] = r["n"], r["w"], r["c"]
    assert weight[0] == pytest.approx(weight[1]) and weight[0] + weight[1] == pytest.approx(sum(copies.values()))
    assert 0.58 < sum(n.values()) / 1500 < 0.68 and 0.9 < sum(copies.values()) / 1500 < 1.1
    other = D.drawn_rows(every, 4, "row_key").select("row_key", "copies")
    assert 0 < got.select("row_key", "copies").exceptAll(other).count()
    assert got.exceptAll(D.drawn_rows(every.repartition(7), 3, "row_key")).isEmpty()


def test_forest_of_balanced_draws(rows):
    fitted = D.fit_drawn_forest(rows.filter("split = 'fit'"), ["u", "v"], ["c"], "row_key", trees=6, max_depth=5)
    scored = fitted.score(rows)
    assert scored.columns == [*rows.columns, "score"] and scored.count() == 1500
    assert scored.filter("score between 0 and 1").count() == 1500
    ap = M.ranking_metrics(scored.filter("split = 'test'")).first()
    assert ap["pr_auc"] > 0.25 and ap["roc_auc"] > 0.75


@pytest.fixture
def kept(monkeypatch):
    """Every table that selection writes, by name."""
    tables = {}

    def recorded(df, name, write=S.written):
        tables.setdefault(name, []).append(write(df, name))
        return tables[name][-1]

    monkeypatch.setattr(S, "written", recorded)
    return tables


def test_temporal_selection_writes_no_vectors(spark, rows, kept):
    columns = {n: F.lit(0.0) for n in S.HISTORY_NUMERIC} | {n: F.col("u") for n in S.BASE_NUMERIC} | {n: F.col("c") for n in L.CATEGORICAL}
    timed = rows.withColumns(columns).withColumn("ts", F.timestamp_seconds(F.pmod(F.xxhash64("row_key"), F.lit(1_000_000))))
    split = X.chronological_split(timed.drop("split"), ["row_key"])
    result, table, predictions = S.temporal_selection(split, {"learning_rate": [0.1], "class_weight": [None, "balanced"]}, iterations=1)
    assert result.count() == 2 and table.count() == 4
    assert predictions.count() == split.filter("split = 'test'").count()
    assert not [n for n, tables in kept.items() for t in tables if "features" in t.columns]


def test_keys_are_kept_for_held_out_scores_only(rows, kept):
    folded = X.stratified_folds(rows.drop("split"), "row_key")
    by_fold, held = S.cross_validate(spec(L._tree, max_depth=2), [{"min_samples_leaf": 1}, {"min_samples_leaf": 5}], folded)
    n = folded.count()
    parts = {r["part"]: r for r in kept["cv-scores"][0].groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count("row_key").alias("keys")).collect()}
    assert (parts["train"]["n"], parts["train"]["keys"]) == (4 * n, 0)
    assert (parts["held"]["n"], parts["held"]["keys"]) == (2 * n, 2 * n)
    assert held.select("row_key").distinct().count() == n and by_fold.count() == 12
