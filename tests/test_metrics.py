"""Rare-event metrics, quantiles, bootstrap."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowsieve.operators import bootstrap as B
from flowsieve.operators import metrics as M
from flowsieve.operators.cumulative import column_quantiles, quantiles, running, value_counts


@pytest.fixture(scope="module")
def hand(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 1)]
    return spark.createDataFrame(rows, "score double, is_laundering int")


def test_hand_worked_scores(hand):
    one = M.ranking_metrics(hand).first()
    assert one["pr_auc"] == pytest.approx(0.7555555555)
    assert one["roc_auc"] == pytest.approx(0.5833333333)
    best = M.best_f1_threshold(hand).first()
    assert (best["threshold"], best["f1"]) == (0.1, pytest.approx(0.75))


def test_curves(hand):
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in M.pr_curve(hand).collect()}
    assert pr[0.8] == pytest.approx((2 / 3, 2 / 3)) and pr[None] == (1.0, 0.0)
    roc = M.roc_curve(hand).collect()
    assert {(r["fpr"], r["tpr"]) for r in roc} >= {(0.0, 0.0), (1.0, 1.0)}


def test_collinear_points_are_dropped(spark):
    rows = [(1 - i / 10, 1 if i < 4 else 0) for i in range(8)]
    curve = M.roc_curve(spark.createDataFrame(rows, "score double, is_laundering int")).collect()
    assert sorted((r["fpr"], r["tpr"]) for r in curve) == [(0, 0), (0, 0.25), (0, 1), (1, 1)]


def test_one_score_for_all(spark):
    df = spark.createDataFrame([(0.0, y) for y in (0, 0, 0, 1)], "score double, is_laundering int")
    one = M.ranking_metrics(df).first()
    assert (one["pr_auc"], one["roc_auc"]) == (0.25, 0.5)
    rates = M.with_rates(M.confusion_counts(df, 0.5)).first()
    assert (rates["precision"], rates["recall"], rates["f1"], rates["accuracy"]) == (0.0, 0.0, 0.0, 0.75)


def test_nothing_to_choose_from(spark):
    empty = spark.createDataFrame([], "score double, is_laundering int")
    assert M.best_f1_threshold(empty).first()["threshold"] == 0.5


def test_slices_change_nothing(spark):
    rng = random.Random(5)
    rows = [(g, round(rng.random() ** 4, 4), int(rng.random() < 0.2)) for g in ("a", "b") for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, score double, is_laundering int")
    whole = {(r["g"], r["score"]): r for r in M.operating_points(df, ["g"], leads=True).collect()}
    cut = M.operating_points(df, ["g"], leads=True, slice_rows=20, slices=16).collect()
    assert len(cut) == len(whole)
    for r in cut:
        assert r.asDict() == whole[(r["g"], r["score"])].asDict()
    no_group = running(value_counts(df, [], "score", {"n": F.lit(1)}), [], "score", ["n"], slice_rows=20, slices=16)
    assert max(r["cum_n"] for r in no_group.collect()) == 1800


def test_quantiles_interpolate(spark):
    rng = random.Random(2)
    values = [rng.gauss(0, 1) for _ in range(501)] + [0.5] * 40
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    asked = [0.0, 0.013, 0.5, 0.975, 1.0]
    for options in ({}, {"slice_rows": 10, "slices": 8}):
        got = {r["p"]: r["quantile"] for r in quantiles(df, [], "x", asked, **options).collect()}
        assert [got[p] for p in asked] == pytest.approx(list(np.quantile(values, asked)))


def test_metrics_table_identities(spark):
    rng = random.Random(9)
    rows = [(m, s, round(rng.random(), 2), int(rng.random() < 0.1)) for m in "xy" for s in ("train", "test") for _ in range(200)]
    df = spark.createDataFrame(rows, "model string, split string, score double, is_laundering int")
    every = df.withColumn("split", F.explode(F.array("split", F.lit("full"))))
    table = {(r["model"], r["split"]): r for r in M.metrics_table(every, 0.8, ["model", "split"]).collect()}
    for m in "xy":
        for c in ("tn", "fp", "fn", "tp"):
            assert table[m, "train"][c] + table[m, "test"][c] == table[m, "full"][c]
    for r in table.values():
        assert r["accuracy"] == pytest.approx((r["tp"] + r["tn"]) / (r["tn"] + r["fp"] + r["fn"] + r["tp"]))


def test_sweep_adds_up(spark):
    rng = random.Random(4)
    df = spark.createDataFrame(
        [(rng.random(), int(rng.random() < 0.05)) for _ in range(2000)], "score double, is_laundering int"
    )
    rows = M.threshold_sweep(df, 0.9).collect()
    assert [r["threshold"] for r in rows] == sorted({r["threshold"] for r in rows})
    for r in rows:
        assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == 2000 and r["alerts"] == r["tp"] + r["fp"]
        assert r["alerts_per_10k"] == pytest.approx(r["alerts"] * 5)


def test_published_style_average_precision(spark, sf_dir):
    """The deterministic score column at sf0.01 has a known average precision."""
    from flowsieve.plans.evaluation import scored

    path = sf_dir.replace("sf0.001", "sf0.01")
    assert M.average_precision_of(M.operating_points(scored(spark, path))).first()[0] == pytest.approx(0.436078681, abs=1e-9)


def _coefficients(keys):
    digests = [hashlib.md5(k.encode()).hexdigest() for k in keys]
    return np.array([[int(d[7 * i : 7 * i + 7], 16) for i in range(B.COEFFICIENTS)] for d in digests])


def test_bootstrap_weights_are_poisson():
    weights = B.weights_of(_coefficients([f"k{i}" for i in range(4000)]), 50)
    assert weights.mean() == pytest.approx(1.0, abs=0.02) and weights.var() == pytest.approx(1.0, abs=0.03)
    # Neither rows nor replicates follow one another.
    assert abs(np.corrcoef(weights.T) - np.eye(50)).max() < 0.08
    assert abs(np.corrcoef(weights[:50]) - np.eye(50)).max() < 0.7


@pytest.mark.parametrize("slices", [{}, {"slice_rows": 40, "max_slices": 64, "salts": 3}])
def test_bootstrap_equals_brute_force(spark, slices):
    """Ties, a score that a third of all rows share, missing scores; the slices do not matter."""
    rng = np.random.default_rng(5)
    n = 1500
    keys = [f"k{i}" for i in range(n)]
    y = (rng.random(n) < 0.2).astype(int)
    a = np.round(rng.random(n), 2)
    a[rng.random(n) < 0.33] = 0.5
    b = np.where(rng.random(n) < 0.1, np.nan, rng.random(n) + 0.3 * y)
    rows = [(k, int(t), float(u), None if np.isnan(v) and i % 2 else float(v)) for i, (k, t, u, v) in enumerate(zip(keys, y, a, b))]
    df = spark.createDataFrame(rows, "row_key string, is_laundering int, a double, b double").repartition(5)
    got = {r["replicate"]: r for r in B.bootstrap_deltas(df, "row_key", "a", "b", replicates=7, **slices).collect()}
    weights = B.weights_of(_coefficients(keys), 7)
    assert sorted(got) == list(range(7))
    for side, score in (("base_pr_auc", a), ("enhanced_pr_auc", np.where(np.isnan(b), -np.inf, b))):
        for r in range(7):
            want, w = 0.0, weights[:, r]
            for value in np.unique(score):
                above = score >= value
                hits = (w * y)[above].sum()
                if w[above].sum():
                    want += (w * y)[score == value].sum() * hits / w[above].sum()
            assert got[r][side] == pytest.approx(want / (w * y).sum(), abs=1e-12)


def test_bootstrap_interval(spark):
    rng = random.Random(8)
    rows = [(f"k{i}", int(rng.random() < 0.3), round(rng.random(), 2), 0.0) for i in range(400)]
    df = spark.createDataFrame([(k, y, a, a + y) for k, y, a, _ in rows], "row_key string, is_laundering int, a double, b double")
    deltas = B.bootstrap_deltas(df, "row_key", "a", "b", replicates=30)
    got = B.bootstrap_interval(deltas).first()
    assert got["bootstrap_resamples"] == 30 and 0 < got["ci_lower_95"] < got["ci_upper_95"]
    same = B.bootstrap_deltas(df, "row_key", "a", "a", replicates=5).collect()
    assert all(r["delta"] == 0 for r in same)


def test_replicates_without_both_classes_are_left_out(spark):
    df = spark.createDataFrame([("a", 1, 0.5, 0.5), ("b", 1, 0.2, 0.2)], "row_key string, is_laundering int, a double, b double")
    assert B.bootstrap_deltas(df, "row_key", "a", "b", replicates=8).count() == 0


@pytest.mark.parametrize("margin", [0.005, 1e-6])
def test_quantiles_of_columns(spark, margin):
    """Exact whatever the brackets: with a tiny margin the sketches miss, and the brackets are widened."""
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(
        {"smooth": rng.normal(0, 1, 20_000), "few": rng.integers(0, 4, 20_000).astype(float), "one": 7.0,
         "holes": np.where(rng.random(20_000) < 0.3, np.nan, rng.exponential(1, 20_000)), "none": np.nan}
    )
    df = spark.createDataFrame(frame).repartition(7)
    asked = [0.0, 0.1, 0.5, 0.9375, 1.0]
    got = {(r.feature, r.p): r.quantile for r in column_quantiles(df, list(frame), asked, sketch=200, margin=margin).collect()}
    assert len(got) == 4 * len(asked)
    for c in ("smooth", "few", "one", "holes"):
        for p in asked:
            assert got[c, p] == pytest.approx(frame[c].quantile(p), abs=1e-12)
