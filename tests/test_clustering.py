"""Cluster evaluation and density clustering against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.operators import clustering as K
from flowsieve.operators import minibatch as B


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "y int, cluster int")


@pytest.mark.parametrize(
    "pairs, nmi, ari, purity",
    [
        ([(0, 0), (0, 0), (1, 1), (1, 1)], 1, 1, 1),
        ([(0, 0), (0, 0), (1, 0), (1, 0)], 0, 0, 0.5),
        ([(0, -1), (1, -1)], 0, 0, 0),
        ([(0, 0), (0, 0), (1, 1), (1, 1), (1, -1)], 1, 1, 1),
    ],
)
def test_agreement(spark, pairs, nmi, ari, purity):
    r = K.agreement(labelled(spark, pairs), "y").first()
    assert (r["nmi"], r["ari"], r["purity"]) == pytest.approx((nmi, ari, purity))


def brute_dbscan(points, eps, min_points):
    n = len(points)
    near = [[j for j in range(n) if ((points[i] - points[j]) ** 2).sum() <= eps * eps] for i in range(n)]
    core = [len(x) >= min_points for x in near]
    labels, current = [-1] * n, 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        labels[i] = current
        while stack:
            for j in near[stack.pop()]:
                if labels[j] == -1:
                    labels[j] = current
                    if core[j]:
                        stack.append(j)
        current += 1
    return labels


@pytest.mark.parametrize("dims, eps, min_points", [(2, 0.5, 5), (3, 0.8, 6), (5, 1.6, 8)])
def test_dbscan(spark, dims, eps, min_points):
    rng = np.random.default_rng(dims)
    blobs = [rng.normal(c, 0.3, (60, dims)) for c in (0, 3)]
    tight = rng.normal(6, 0.01, (40, dims))
    copies = np.repeat(rng.normal(9, 1, (1, dims)), 30, axis=0)
    bridge = np.linspace(np.zeros(dims), np.full(dims, 3.0), 12)
    points = np.vstack([*blobs, tight, copies, bridge, rng.uniform(-5, 12, (60, dims))])
    points = points[rng.permutation(len(points))]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, x array<double>")
    got = {r["id"]: r["cluster"] for r in K.dbscan(df, eps, min_points, dims).collect()}
    want = brute_dbscan(points, eps, min_points)
    assert len(set(want)) > 3
    assert [got[i] for i in range(len(points))] == want


def test_dbscan_without_core_points(spark):
    df = spark.createDataFrame([(i, [float(10 * i), 0.0]) for i in range(5)], "id long, x array<double>")
    assert {r["cluster"] for r in K.dbscan(df, 1.0, 3, 2).collect()} == {-1}


def test_components(spark):
    rng = random.Random(2)
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60) if i not in (20, 41)]
    both = chain + [(b, a) for a, b in chain]
    rng.shuffle(both)
    nodes = spark.createDataFrame([(f"n{i:03d}", i) for i in range(61)], "unit string, root int")
    edges = spark.createDataFrame(both, "unit string, o_unit string")
    got = {r["unit"]: r["root"] for r in K.components(nodes, edges).collect()}
    assert set(got.values()) == {0, 21, 42} and got["n060"] == 42 and got["n020"] == 0


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(3 * (i % 3), 1, 4).tolist(), i % 3 if i % 17 else -1) for i in range(150)]
    return rows, spark.createDataFrame(rows, "id long, x array<double>, cluster int")


def brute_silhouette(rows, power):
    used = [(np.array(x), c) for _, x, c in rows if c != -1]
    scores = []
    for i, (x, c) in enumerate(used):
        by = {}
        for j, (y, d) in enumerate(used):
            if i != j:
                by.setdefault(d, []).append(np.sqrt(((x - y) ** 2).sum()) ** power)
        a, b = np.mean(by[c]), min(np.mean(v) for d, v in by.items() if d != c)
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_silhouettes(blobs):
    rows, df = blobs
    assert K.silhouette(df).first()[0] == pytest.approx(brute_silhouette(rows, 2))
    assert K.silhouette_euclidean(df, block=40).first()[0] == pytest.approx(brute_silhouette(rows, 1))
    with pytest.raises(ValueError):
        K.silhouette_euclidean(df, max_points=100)


def test_undefined_measures_are_null(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0), (3, [5.0], -1)], "id long, x array<double>, cluster int")
    assert K.silhouette(df).first()[0] is None
    assert K.davies_bouldin(df).first()[0] is None
    assert K.calinski_harabasz(df).first()[0] is None
    counts = K.cluster_counts(df).first()
    assert (counts["n_clusters_ex_noise"], counts["valid"]) == (1, False)
    assert counts["noise_rate"] == pytest.approx(1 / 3)


def test_kmeans_and_projection_are_repeatable(blobs):
    _, df = blobs
    flat = K.project(df, K.pca_model(df, 2))
    a = {r["id"]: r["k"] for r in K.kmeans(flat, 3, column="k").collect()}
    b = {r["id"]: r["k"] for r in K.kmeans(flat, 3, column="k").collect()}
    assert a == b and len(set(a.values())) == 3
    assert len(flat.first()["x"]) == 2
    profile = K.highest_positive_rate(df.withColumn("y", (F.col("id") < 75).cast("int")), "y").first()[0]
    assert 0 < profile <= 1


def test_equal_distances_go_to_the_first_label(spark):
    """Exact ties, also where a matrix product rounds the two distances apart."""
    rng = np.random.default_rng(9)
    centroids = np.array([[1.0, 0.3, 7.0], [4.0, 0.3, 7.0], [9.5, 0.3, 7.0]])
    points = [(i, [2.5 if i % 2 else 6.75, float(rng.random() * 1000), float(rng.random())]) for i in range(4000)]
    rows = K.assign_nearest(spark.createDataFrame(points, "id int, x array<double>"), centroids, [5, 6, 8]).collect()
    assert {(r.id % 2, r.cluster) for r in rows} == {(1, 5), (0, 6)}


def _inertia(points, centres):
    return float(((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).min(axis=1).sum())


def test_minibatch_is_near_full_kmeans_under_any_partitioning(spark):
    rng = np.random.default_rng(4)
    centres = rng.uniform(-8, 8, (5, 4))
    points = np.vstack([rng.normal(c, 1.0, (n, 4)) for c, n in zip(centres, (2500, 1500, 700, 300, 1000))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, x array<double>")
    options = {"batch": 256, "round_batches": 8}  # several rounds
    got = [B.fit_centres(part, 5, "id", **options) for part in (df.repartition(1), df.repartition(7, "id"))]
    assert (got[0] == got[1]).all()
    full = K.cluster_summary(K.kmeans(df, 5))
    assert _inertia(points, got[0]) < 1.05 * _inertia(points, np.vstack(full["mean"].to_list()))
    labelled = B.minibatch_kmeans(df, 5, "id", **options).collect()
    squares = ((points[:, None, :] - got[0][None, :, :]) ** 2).sum(axis=2)
    assert [r["cluster"] for r in sorted(labelled, key=lambda r: r["id"])] == squares.argmin(axis=1).tolist()


def test_minibatch_of_few_rows(spark):
    empty = spark.createDataFrame([], "id long, x array<double>")
    assert B.minibatch_kmeans(empty, 3, "id").count() == 0
    copies = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)] + [(9, None)], "id long, x array<double>")
    assert B.fit_centres(copies, 3, "id").tolist() == [[1.0, 2.0]] * 3


@pytest.mark.parametrize("name", ["kmeans_clusters", "minibatch_clusters"])
def test_points_are_written_once(spark, monkeypatch, name):
    from flowsieve.operators.features import add_base_features
    from flowsieve.plans import clusters

    rng, tables = random.Random(3), []
    payments = [
        (f"k{i}", 3600 * i, i % 3, f"a{rng.randrange(12)}", i % 2, f"a{rng.randrange(12)}", rng.uniform(1, 99), rng.choice("xy"), rng.uniform(1, 99), rng.choice("xyz"), rng.choice("pq"), int(i % 9 == 0))
        for i in range(300)
    ]
    df = spark.createDataFrame(
        payments, "row_key string, t long, from_bank long, from_account string, to_bank long, to_account string, amount_received double, "
        "receiving_currency string, amount_paid double, payment_currency string, payment_format string, is_laundering int",
    ).withColumn("ts", F.timestamp_seconds("t"))
    monkeypatch.setattr(clusters, "featured", lambda *_: add_base_features(df))
    monkeypatch.setattr(clusters, "written", lambda df, name, write=clusters.written: tables.append(df.columns) or write(df, name))
    profile = clusters.QUERIES[name](spark, "").collect()
    assert sum(r["transactions"] for r in profile) == 300
    assert sum("x" in columns for columns in tables) == 1 and "from_account" not in tables[0]
