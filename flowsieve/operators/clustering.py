"""Clustering of numeric vectors (array<double> columns) and cluster evaluation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.operators.cumulative import running
from flowsieve.session import lookup_join, written

NOISE = -1
MAX_CLUSTERS = 2_000
SEED = 42
# Fixed values of the two clusterings: dimensions, radius and neighbours.
TRANSACTION_CLUSTERING = {"k": 6, "dims": 20, "dbscan_dims": 10, "eps": 2.8, "min_points": 20}
ACCOUNT_CLUSTERING = {"k": 6, "dims": 12, "dbscan_dims": 8, "eps": 1.8, "min_points": 25}


def matrix(df: DataFrame, columns: list[str], keep: list[str], name: str = "x") -> DataFrame:
    """``keep`` columns plus one array of the given columns, standardised with the population deviation."""
    figures = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"d{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = [
        (F.col(c) - F.lit(figures[f"m{i}"] or 0.0)) / F.lit(figures[f"d{i}"] or 1.0) for i, c in enumerate(columns)
    ]
    return df.select(*keep, F.array(*scaled).alias(name))


def pca_model(points: DataFrame, dims: int, x: str = "x"):
    """Fitted PCA on centred rows; the covariance is a d x d aggregate."""
    return PCA(k=dims, inputCol="_v", outputCol="_p").fit(points.select(array_to_vector(x).alias("_v")))


def project(points: DataFrame, model, x: str = "x") -> DataFrame:
    """Replace the array by its principal coordinates."""
    moved = model.transform(points.withColumn("_v", array_to_vector(x)))
    return moved.withColumn(x, vector_to_array("_p")).drop("_v", "_p")


def kmeans(points: DataFrame, k: int, x: str = "x", column: str = "cluster", seed: int = SEED) -> DataFrame:
    vectors = points.withColumn("_v", array_to_vector(x))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol=column).fit(vectors)
    return model.transform(vectors).drop("_v")


def cluster_summary(points: DataFrame, x: str = "x", cluster: str = "cluster") -> pd.DataFrame:
    """Per cluster: rows, mean vector and mean squared norm; at most ``MAX_CLUSTERS`` rows reach the driver."""
    norm = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)
    table = (
        points.filter(F.col(cluster) != NOISE)
        .select(cluster, array_to_vector(x).alias("_v"), norm.alias("_norm"))
        .groupBy(cluster)
        .agg(F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(F.col("_v"))).alias("mean"), F.avg("_norm").alias("norm"))
        .limit(MAX_CLUSTERS + 1)
        .toPandas()
    )
    if len(table) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    return table.sort_values(cluster).reset_index(drop=True)


def assign_nearest(points: DataFrame, centroids: np.ndarray, labels: list, x: str = "x", column: str = "cluster") -> DataFrame:
    """Nearest of a few fixed centroids; the first label wins ties.

    One matrix product per batch finds the centroids that rounding cannot tell from the best one; only between those
    the squared differences decide, so that equal distances are equal.
    """
    names, half = np.asarray(labels), (centroids**2).sum(axis=1) / 2

    @F.pandas_udf("int")
    def nearest(rows: pd.Series) -> pd.Series:
        block = np.asarray(rows.to_list(), dtype=float).reshape(len(rows), -1)
        score = half - block @ centroids.T
        found = score.argmin(axis=1)
        slack = 1e-12 * block.shape[1] * ((block**2).sum(axis=1) + 2 * half.max(initial=0.0) + 1)
        open_rows = np.flatnonzero((score <= (score.min(axis=1) + slack)[:, None]).sum(axis=1) > 1)
        for k in range(0, len(open_rows), 4_096):
            at = open_rows[k : k + 4_096]
            exact = ((block[at][:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
            exact[score[at] > (score[at].min(axis=1) + slack[at])[:, None]] = np.inf
            found[at] = exact.argmin(axis=1)
        return pd.Series(names[found].astype("int32"))

    return points.withColumn(column, nearest(x))


# ---------------------------------------------------------------- evaluation


def silhouette(points: DataFrame, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distances, noise left out; NULL below two clusters.

    The mean squared distance from a row to a cluster follows from the cluster's mean and mean norm, so every
    row is compared with the clusters only, never with other rows.
    """
    summary = cluster_summary(points, x, cluster)
    used = points.filter(F.col(cluster) != NOISE)
    if len(summary) < 2:
        return used.agg(F.lit(None).cast("double").alias("silhouette"))
    sizes, norms = summary["n"].to_numpy(float), summary["norm"].to_numpy(float)
    means = np.vstack(summary["mean"].to_list())
    position = {c: i for i, c in enumerate(summary[cluster])}

    @F.pandas_udf("double")
    def width(rows: pd.Series, own: pd.Series) -> pd.Series:
        block = np.asarray(rows.to_list(), dtype=float)
        mine = own.map(position).to_numpy()
        at = np.arange(len(block))
        mean = (block**2).sum(axis=1)[:, None] - 2 * block @ means.T + norms[None, :]
        inside = mean[at, mine] * sizes[mine] / np.maximum(sizes[mine] - 1, 1)
        mean[at, mine] = np.inf
        outside = mean.min(axis=1)
        larger = np.maximum(inside, outside)
        score = np.where(larger > 0, (outside - inside) / np.where(larger > 0, larger, 1), 0.0)
        return pd.Series(np.where(sizes[mine] > 1, score, 0.0))

    return used.select(width(x, cluster).alias("s")).agg(F.avg("s").alias("silhouette"))


def silhouette_euclidean(
    points: DataFrame, key: str = "id", x: str = "x", cluster: str = "cluster", max_points: int = 50_000, block: int = 1_000
) -> DataFrame:
    """Mean silhouette with Euclidean distances, for a bounded sample: the statistic needs every distance.

    Points are packed into blocks; each pair of blocks is one small matrix product in a task, and only sums
    per point and cluster leave it.
    """
    used = points.filter(F.col(cluster) != NOISE).select(F.col(key).alias("id"), F.col(cluster).alias("c"), F.col(x).alias("x"))
    n = used.count()
    if n > max_points:
        raise ValueError(f"{n} points: draw a sample of at most {max_points} first")
    blocks = max(1, -(-n // block))
    packed = written(
        used.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        .groupBy("b")
        .agg(F.collect_list(F.struct("id", "c", "x")).alias("rows")),
        "blocks",
    )
    left = packed.select("rows", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    pairs = left.join(packed.withColumnRenamed("rows", "others"), "b").select("rows", "others")
    id_type, c_type = dict(used.dtypes)["id"], dict(used.dtypes)["c"]

    def sums(batches):
        for batch in batches:
            for rows, others in zip(batch["rows"], batch["others"]):
                a = np.array([r["x"] for r in rows], dtype=float)
                b = np.array([r["x"] for r in others], dtype=float)
                squared = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T
                distance = np.sqrt(np.maximum(squared, 0.0))
                same = np.array([r["id"] for r in rows], dtype=object)[:, None] == np.array([r["id"] for r in others], dtype=object)[None, :]
                distance[same] = 0.0
                labels = np.array([r["c"] for r in others])
                for c in np.unique(labels):
                    yield pd.DataFrame(
                        {"id": [r["id"] for r in rows], "c": [r["c"] for r in rows], "other": c, "total": distance[:, labels == c].sum(1)}
                    )

    totals = pairs.mapInPandas(sums, f"id {id_type}, c {c_type}, other {c_type}, total double")
    sizes = F.broadcast(used.groupBy(F.col("c").alias("other")).agg(F.count(F.lit(1)).alias("n")))
    per_cluster = totals.groupBy("id", "c", "other").agg(F.sum("total").alias("total")).join(sizes, "other")
    own = F.col("c") == F.col("other")
    per_point = per_cluster.groupBy("id").agg(
        F.max(F.when(own, F.when(F.col("n") > 1, F.col("total") / (F.col("n") - 1)))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    score = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    return per_point.agg(F.when(F.count("b") > 0, F.avg(F.coalesce(score, F.lit(0.0)))).alias("silhouette"))


def davies_bouldin(points: DataFrame, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance."""
    spread, means = _spreads(points, x, cluster)
    gap = np.sqrt(((means[:, None, :] - means[None, :, :]) ** 2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(gap > 0, (spread[:, None] + spread[None, :]) / gap, 0.0)
    np.fill_diagonal(ratio, 0.0)
    value = float(ratio.max(axis=1).mean()) if len(means) > 1 else None
    return points.sparkSession.createDataFrame([(value,)], "davies_bouldin double")


def _spreads(points: DataFrame, x: str, cluster: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean distance of the rows to their centroid, and the centroids, per cluster."""
    summary = cluster_summary(points, x, cluster)
    means = np.vstack(summary["mean"].to_list()) if len(summary) else np.zeros((0, 1))
    position = {c: i for i, c in enumerate(summary[cluster])}

    @F.pandas_udf("double")
    def distance(rows: pd.Series, own: pd.Series) -> pd.Series:
        block = np.asarray(rows.to_list(), dtype=float)
        return pd.Series(np.sqrt(((block - means[own.map(position).to_numpy()]) ** 2).sum(axis=1)))

    used = points.filter(F.col(cluster) != NOISE)
    rows = used.select(cluster, distance(x, cluster).alias("d")).groupBy(cluster).agg(F.avg("d").alias("s"))
    found = {r[cluster]: r["s"] for r in rows.collect()}
    return np.array([found[c] for c in summary[cluster]]), means


def calinski_harabasz(points: DataFrame, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """Between over within scatter, from the cluster summaries alone."""
    summary = cluster_summary(points, x, cluster)
    value = None
    if len(summary) > 1:
        n = summary["n"].to_numpy(float)
        means = np.vstack(summary["mean"].to_list())
        centre = (means * n[:, None]).sum(axis=0) / n.sum()
        between = float((n * ((means - centre) ** 2).sum(axis=1)).sum())
        within = float((n * (summary["norm"].to_numpy(float) - (means**2).sum(axis=1))).sum())
        value = float(between / (len(n) - 1) / (within / (n.sum() - len(n)))) if within > 0 else 1.0
    return points.sparkSession.createDataFrame([(value,)], "calinski_harabasz double")


def agreement(df: DataFrame, label: str, cluster: str = "cluster") -> DataFrame:
    """Normalised mutual information (arithmetic mean), adjusted Rand index and purity, noise left out."""
    cells = df.filter(F.col(cluster) != NOISE).groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    # clusters x labels rows from here on
    everything = Window.partitionBy(F.lit(0))
    sized = cells.select(
        cluster, label, F.col("n").cast("double").alias("n"),
        F.sum("n").over(Window.partitionBy(cluster)).cast("double").alias("a"),
        F.sum("n").over(Window.partitionBy(label)).cast("double").alias("b"),
        F.sum("n").over(everything).cast("double").alias("t"),
    )
    n, a, b, t = (F.col(c) for c in ("n", "a", "b", "t"))

    def pairs(x):
        return x * (x - 1) / 2

    figures = sized.agg(
        F.sum(n / t * F.log(n * t / (a * b))).alias("mi"),
        # Every cell carries its share of the marginal entropies and pair counts.
        (-F.sum(n / t * F.log(a / t))).alias("ha"),
        (-F.sum(n / t * F.log(b / t))).alias("hb"),
        F.sum(pairs(n)).alias("same"),
        F.sum(pairs(a) * n / a).alias("pa"),
        F.sum(pairs(b) * n / b).alias("pb"),
        F.max(t).alias("t"),
    )
    best = cells.groupBy(cluster).agg(F.max("n").alias("n")).agg(F.sum("n").cast("double").alias("best"))
    c = F.col
    figures = figures.withColumn("best", best.scalar())
    entropy = (c("ha") + c("hb")) / 2
    expected = c("pa") * c("pb") / F.nullif(pairs(c("t")), F.lit(0.0))
    room = (c("pa") + c("pb")) / 2 - F.coalesce(expected, F.lit(0.0))
    return figures.select(
        F.when(c("t").isNull(), 0.0).when(entropy == 0, 1.0).otherwise(F.greatest(c("mi"), F.lit(0.0)) / entropy).alias("nmi"),
        F.when(c("t").isNull(), 0.0)
        .when(room == 0, 1.0)
        .otherwise(F.try_divide(c("same") - F.coalesce(expected, F.lit(0.0)), room))
        .alias("ari"),
        F.coalesce(c("best") / c("t"), F.lit(0.0)).alias("purity"),
    )


def cluster_counts(df: DataFrame, cluster: str = "cluster", min_points: int = 10) -> DataFrame:
    """Clusters without noise, noise share, and whether the geometric measures are defined."""
    known = F.col(cluster) != NOISE
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count_if(known).alias("n_clusters_ex_noise"),
        (F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)) / F.sum("n")).alias("noise_rate"),
        ((F.count_if(known) >= 2) & (F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)) > min_points)).alias("valid"),
    )


def highest_positive_rate(df: DataFrame, label: str, cluster: str = "cluster") -> DataFrame:
    """Largest positive rate of a cluster, noise counted as one."""
    rates = df.groupBy(cluster).agg(F.avg(F.col(label).cast("double")).alias("rate"))
    return rates.agg(F.max("rate").alias("cluster_positive_rate_max"))


def transaction_profile(df: DataFrame, cluster: str, method: str | None = None) -> DataFrame:
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_laundering").cast("long").alias("laundering"),
        F.avg("amount_paid").alias("avg_amount"),
        F.avg("sender_out_degree").alias("avg_sender_out_degree"),
        F.avg(F.col("is_laundering").cast("double")).alias("laundering_rate"),
    ).withColumn("method", F.lit(method or cluster))


def account_profile(df: DataFrame, cluster: str, method: str | None = None) -> DataFrame:
    means = {
        "avg_sent_count": "sent_count", "avg_received_count": "received_count", "avg_fan_out": "fan_out_score",
        "avg_fan_in": "fan_in_score", "avg_scatter_gather": "scatter_gather_score",
    }
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum("account_laundering").cast("long").alias("laundering_accounts"),
        *[F.avg(F.col(c).cast("double")).alias(n) for n, c in means.items()],
        F.avg(F.col("account_laundering").cast("double")).alias("laundering_account_rate"),
    ).withColumn("method", F.lit(method or cluster))


# ---------------------------------------------------------------- DBSCAN


def dbscan(
    points: DataFrame, eps: float, min_points: int, dims: int, key: str = "id", x: str = "x", column: str = "cluster",
    block_dims: int = 3, max_rounds: int = 100,
) -> DataFrame:
    """Density clusters 0, 1, ... by first core point, -1 for noise, over the first ``dims`` coordinates.

    Equal points are merged with a weight. Points are put into cells so small that a cell's points are all
    neighbours: a cell with at least ``min_points`` rows is core as a whole and none of its pairs is looked
    at. Other neighbours are found by an equi-join on blocks one radius wide over the leading coordinates,
    with the exact distance in the join condition, and combined per (unit, unit) right behind the join, where
    a unit is a whole dense cell or a single point. Border points take the lowest neighbouring cluster.
    """
    coordinates = [f"_c{i}" for i in range(dims)]
    flat = points.select(F.col(key).alias("_id"), *[F.get(x, F.lit(i)).alias(c) for i, c in enumerate(coordinates)])
    place = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in coordinates]).cast("binary"))
    flat = written(flat.withColumn("_place", place), "dbscan-points")
    side = eps / dims**0.5 * (1 - 1e-9)
    merged = flat.groupBy("_place").agg(
        F.min("_id").alias("pid"), F.count(F.lit(1)).alias("w"), *[F.first(c).alias(c) for c in coordinates]
    )
    merged = merged.withColumn(
        "cell", F.concat_ws("_", *[F.floor(F.col(c) / side).cast("string") for c in coordinates])
    )
    cells = merged.groupBy("cell").agg(F.sum("w").alias("cell_w"))
    sites = lookup_join(merged, cells, "cell")
    dense = F.col("cell_w") >= min_points
    blocks = [f"_b{i}" for i in range(min(block_dims, dims))]
    sites = written(
        sites.select(
            "_place", "pid", "w", "cell", "cell_w", *coordinates, dense.alias("dense"),
            F.when(dense, F.concat(F.lit("c"), "cell")).otherwise(F.concat(F.lit("p"), F.col("_place"))).alias("unit"),
            *[F.floor(F.col(coordinates[i]) / eps).alias(b) for i, b in enumerate(blocks)],
        ),
        "dbscan-sites",
    )

    left = sites
    for b in blocks:
        left = left.withColumn(b, F.explode(F.array(*[F.col(b) + s for s in (-1, 0, 1)])))
    other = sites.select(
        *blocks, F.col("unit").alias("o_unit"), F.col("cell").alias("o_cell"), F.col("w").alias("o_w"),
        *[F.col(c).alias(f"o{c}") for c in coordinates],
    )
    squared = sum(((F.col(c) - F.col(f"o{c}")) * (F.col(c) - F.col(f"o{c}")) for c in coordinates), F.lit(0.0))
    near = (
        left.alias("l")
        .join(other, blocks)
        .filter((F.col("cell") != F.col("o_cell")) & (squared <= F.lit(eps * eps)))
        .groupBy("unit", "dense", "o_unit")
        .agg(F.sum(F.when(~F.col("dense"), F.col("o_w"))).alias("o_w"))
    )
    near = written(near, "dbscan-near")
    reach = near.filter(~F.col("dense")).groupBy("unit").agg(F.sum("o_w").alias("outside"))
    units = sites.groupBy("unit", "dense", "cell").agg(F.min("pid").alias("pid"), F.max("cell_w").alias("cell_w"))
    units = units.join(reach, "unit", "left")
    is_core = F.col("dense") | (F.col("cell_w") + F.coalesce("outside", F.lit(0)) >= min_points)
    units = written(units.select("unit", "cell", "pid", is_core.alias("core")), "dbscan-units")
    core = units.filter("core").select("unit", "cell", "pid")
    if core.isEmpty():
        return points.withColumn(column, F.lit(NOISE))

    # Core units that touch: neighbours, and the core points of one sparse cell through their first one.
    names = core.select(F.col("unit").alias("o_unit"))
    touching = near.select("unit", "o_unit").join(core.select("unit"), "unit").join(names, "o_unit").select("unit", "o_unit")
    lead = core.groupBy("cell").agg(F.min("unit").alias("o_unit"))
    inside = core.join(lead, "cell").filter(F.col("unit") != F.col("o_unit")).select("unit", "o_unit")
    edges = touching.unionByName(inside)
    both = written(edges.unionByName(edges.select(F.col("o_unit").alias("unit"), F.col("unit").alias("o_unit"))).distinct(), "dbscan-edges")
    roots = components(core.select("unit", F.col("pid").alias("root")), both, max_rounds)

    numbered = running(roots.groupBy("root").agg(F.lit(1).alias("one")), [], "root", ["one"])
    numbers = numbered.select("root", (F.col("cum_one") - 1).cast("int").alias(column))
    clusters = written(lookup_join(roots, numbers, "root").select("unit", column), "dbscan-clusters")
    # Border points: lowest cluster among neighbouring core units and core points of the same cell.
    border = units.filter(~F.col("core")).select("unit", "cell")
    beside = near.select("unit", "o_unit").join(border.select("unit"), "unit").join(
        clusters.withColumnRenamed("unit", "o_unit"), "o_unit"
    ).select("unit", column)
    by_cell = core.select("unit", "cell").join(clusters, "unit").groupBy("cell").agg(F.min(column).alias(column))
    same = border.join(by_cell, "cell").select("unit", column)
    borders = beside.unionByName(same).groupBy("unit").agg(F.min(column).alias(column))
    labels = clusters.unionByName(borders)
    of_place = written(
        sites.select("_place", "unit").join(labels, "unit", "left").select("_place", F.coalesce(column, F.lit(NOISE)).alias(column)),
        "dbscan-labels",
    )
    found = lookup_join(flat.select("_id", "_place"), of_place, "_place").select(F.col("_id").alias(key), column)
    return points.join(found, key)


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Smallest ``root`` of every connected component; ``edges`` hold both directions.

    Every round takes the smallest root of the neighbours and then the root of that root, so chains shrink
    fast; the roots are written each round.
    """
    roots = written(nodes.select("unit", "root", F.col("root").alias("own")), "roots")
    for _ in range(max_rounds):
        # A large component's root and a busy unit are hot keys: both joins spread them.
        offered = lookup_join(edges, roots.select(F.col("unit").alias("o_unit"), F.col("root").alias("offer")), "o_unit")
        best = offered.groupBy("unit").agg(F.min("offer").alias("offer"))
        stepped = roots.join(best, "unit", "left").select(
            "unit", "own", F.col("root").alias("before"), F.least("root", "offer").alias("root")
        )
        stepped = written(stepped, "stepped")
        jump = stepped.select(F.col("own").alias("root"), F.col("root").alias("further"))
        moved = lookup_join(stepped, jump, "root").select(
            "unit", "own", "before", F.least("root", "further").alias("root")
        )
        moved = written(moved, "roots")
        if moved.filter(F.col("root") != F.col("before")).isEmpty():
            return moved.select("unit", "root")
        roots = moved.select("unit", "root", "own")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
