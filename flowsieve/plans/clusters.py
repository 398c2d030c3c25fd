"""Clustering queries: fixed assignments and evaluation with SQL twins, fitted clusterings without."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from flowsieve.operators import accounts as A
from flowsieve.operators import clustering as K
from flowsieve.operators import graph as G
from flowsieve.operators import sampling as X
from flowsieve.operators.minibatch import minibatch_kmeans
from flowsieve.plans.graph import ACCOUNTS_SQL, SENDER_SQL
from flowsieve.plans.star import SPARSE_ACCOUNTS, featured, payments_sql, table
from flowsieve.session import lookup_join, written
from flowsieve.sources.schema import BASE_NUMERIC, CATEGORICAL, GRAPH_NUMERIC

TXN = payments_sql()
SPARSE = payments_sql(SPARSE_ACCOUNTS)


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x")
    )


def by_label(spark, sf_dir):
    return vectors(spark, sf_dir).withColumn("cluster", F.col("label"))


def assigned(spark, sf_dir):
    """Every vector under the nearest label centroid; far-off ones are noise."""
    rows = vectors(spark, sf_dir)
    summary = K.cluster_summary(rows, "x", "label")
    centroids = np.vstack(summary["mean"].to_list())
    near = K.assign_nearest(rows, centroids, summary["label"].to_list())
    return near.withColumn("cluster", F.when(F.get("x", F.lit(0)) > NOISE_ABOVE, F.lit(-1)).otherwise(F.col("cluster")))


NOISE_ABOVE = 0.2

_VECTORS = "v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
_LONG = "long AS MATERIALIZED (SELECT vec_id, label, unnest(x) AS value, generate_subscripts(x, 1) AS dim FROM v)"
_CENTRES = """centres AS MATERIALIZED (SELECT label AS c, list(m ORDER BY dim) AS centre FROM (
    SELECT label, dim, avg(value) AS m FROM long GROUP BY ALL) GROUP BY label)"""
_SIZES = "sizes AS (SELECT label AS c, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY label)"
_BASE = f"WITH {_VECTORS}, {_LONG}, {_CENTRES}, {_SIZES}"
_ASSIGNED = f"""{_BASE}, near AS (SELECT vec_id, label, CASE WHEN x[1] > {NOISE_ABOVE} THEN -1 ELSE c END AS cluster
  FROM v, centres QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(x, centre), c) = 1)"""
_PAIRS = """pairs AS MATERIALIZED (SELECT a.vec_id, a.label AS own, b.label AS other, {distance} AS d, a.vec_id = b.vec_id AS self
  FROM {source} a, {source} b),
per AS (SELECT vec_id, own, other, sum(d) / nullif(count(*) FILTER (NOT self), 0) AS m FROM pairs GROUP BY ALL),
width AS (SELECT vec_id, max(m) FILTER (own = other) AS a, min(m) FILTER (own <> other) AS b FROM per GROUP BY vec_id)
SELECT round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 6) AS silhouette FROM width"""


def cluster_metrics(spark, sf_dir):
    points = written(assigned(spark, sf_dir), "points")
    counts = K.cluster_counts(points)
    return counts.select(
        "n_clusters_ex_noise", F.round("noise_rate", 6).alias("noise_rate"), "valid",
        F.round(K.highest_positive_rate(points.withColumn("hit", (F.col("label") == 0).cast("int")), "hit").scalar(), 6).alias(
            "cluster_positive_rate_max"
        ),
    )


def cluster_agreement(spark, sf_dir):
    found = K.agreement(assigned(spark, sf_dir), "label")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


_AGREEMENT_SQL = f"""{_ASSIGNED}, cells AS (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS n FROM near WHERE cluster <> -1 GROUP BY ALL),
a AS (SELECT cluster, sum(n) AS a FROM cells GROUP BY 1), b AS (SELECT label, sum(n) AS b FROM cells GROUP BY 1),
t AS (SELECT sum(n) AS t FROM cells),
s AS (SELECT (SELECT sum(n / t * ln(n * t / (a * b))) FROM cells JOIN a USING (cluster) JOIN b USING (label), t) AS mi,
  (SELECT -sum(a / t * ln(a / t)) FROM a, t) AS ha, (SELECT -sum(b / t * ln(b / t)) FROM b, t) AS hb,
  (SELECT sum(n * (n - 1) / 2) FROM cells) AS same, (SELECT sum(a * (a - 1) / 2) FROM a) AS pa,
  (SELECT sum(b * (b - 1) / 2) FROM b) AS pb, (SELECT t * (t - 1) / 2 FROM t) AS pt,
  (SELECT sum(m) FROM (SELECT max(n) AS m FROM cells GROUP BY cluster)) AS best, (SELECT t FROM t) AS t)
SELECT round(mi / ((ha + hb) / 2), 6) AS nmi, round((same - pa * pb / pt) / ((pa + pb) / 2 - pa * pb / pt), 6) AS ari,
  round(best / t, 6) AS purity FROM s"""


def _rounded_one(df):
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


# ---------------------------------------------------------------- profiles under fixed centroids

# Six points in (log amount, hour / 4) and four in (log sent, log received).
TXN_CENTROIDS = np.array([[8.0, 1.0], [8.0, 4.0], [10.0, 1.0], [10.0, 4.0], [11.0, 2.5], [11.5, 5.0]])
ACCOUNT_CENTROIDS = np.array([[0.0, 10.0], [10.0, 0.0], [14.0, 14.0], [14.0, 16.0]])


def _nearest_sql(source: str, a: str, b: str, centroids) -> str:
    points = ", ".join(f"({i}, CAST({p} AS DOUBLE), CAST({q} AS DOUBLE))" for i, (p, q) in enumerate(centroids))
    return f"""SELECT t.*, c.i AS cluster FROM {source} t, (VALUES {points}) c(i, p, q)
  QUALIFY row_number() OVER (PARTITION BY t.{{key}} ORDER BY (({a}) - p) * (({a}) - p) + (({b}) - q) * (({b}) - q), i) = 1"""


def txn_clusters(spark, sf_dir):
    rows = featured(spark, sf_dir).select(
        "from_account_id", "to_account_id", "amount_paid", "amount_received", "log_amount_paid", "hour", "from_bank", "is_laundering"
    )
    rows = written(rows, "rows")
    pairs = written(G.pair_table(rows), "pairs")
    rows = lookup_join(rows, G.sender_aggregates(pairs).select("from_account_id", "sender_out_degree"), "from_account_id")
    points = rows.withColumn("x", F.array(F.col("log_amount_paid"), F.col("hour") / F.lit(4.0)))
    return K.assign_nearest(points, TXN_CENTROIDS, list(range(len(TXN_CENTROIDS)))).drop("x")


def txn_cluster_profile(spark, sf_dir):
    """Profiles of two groupings stacked: nearest centroid and bank."""
    rows = txn_clusters(spark, sf_dir).select("cluster", "from_bank", "is_laundering", "amount_paid", "sender_out_degree")
    rows = written(rows, "txn-clusters")
    rows = rows.withColumns({"cluster": F.col("cluster").cast("string"), "bank_cluster": F.col("from_bank").cast("string")})
    nearest = K.transaction_profile(rows, "cluster", "nearest")
    bank = K.transaction_profile(rows, "bank_cluster", "bank")
    both = nearest.unionByName(bank, allowMissingColumns=True)
    return both.select(
        *[F.round(c, 6).alias(c) if c in ("avg_amount", "avg_sender_out_degree", "laundering_rate") else F.col(c) for c in both.columns]
    )


_PROFILE = """count(*) AS transactions, CAST(sum(is_laundering) AS BIGINT) AS laundering, round(avg(amount_paid), 6) AS avg_amount,
  round(avg(CAST(sender_out_degree AS DOUBLE)), 6) AS avg_sender_out_degree,
  round(avg(CAST(is_laundering AS DOUBLE)), 6) AS laundering_rate"""
_TXN_PROFILE_SQL = f"""WITH {TXN}, sent AS ({SENDER_SQL.format(source='txn')}),
rich AS (SELECT txn.*, sender_out_degree FROM txn JOIN sent ON s = from_account_id),
near AS ({_nearest_sql('rich', 'ln(1 + greatest(amount_paid, 0))', 'hour(ts) / CAST(4 AS DOUBLE)', TXN_CENTROIDS).format(key='row_key')})
SELECT CAST(cluster AS VARCHAR) AS cluster, {_PROFILE}, 'nearest' AS method, CAST(NULL AS VARCHAR) AS bank_cluster FROM near GROUP BY cluster
UNION ALL SELECT NULL, {_PROFILE}, 'bank', CAST(from_bank AS VARCHAR) FROM near GROUP BY from_bank"""


def cluster_max_rate(spark, sf_dir):
    return _rounded_one(K.highest_positive_rate(txn_clusters(spark, sf_dir), "is_laundering"))


def account_table(spark, sf_dir):
    return A.clean_account_matrix(A.account_features(featured(spark, sf_dir, SPARSE_ACCOUNTS)))


def account_cluster_profile(spark, sf_dir):
    rows = account_table(spark, sf_dir).withColumn("x", F.array("log_abs_total_sent", "log_abs_total_received"))
    near = K.assign_nearest(rows, ACCOUNT_CENTROIDS, list(range(len(ACCOUNT_CENTROIDS))))
    out = K.account_profile(near, "cluster", "nearest")
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


_ACCOUNT_PROFILE_SQL = f"""WITH {SPARSE}, {ACCOUNTS_SQL},
near AS ({_nearest_sql('account_table', 'log_abs_total_sent', 'log_abs_total_received', ACCOUNT_CENTROIDS).format(key='account_id')})
SELECT cluster, count(*) AS accounts, CAST(sum(account_laundering) AS BIGINT) AS laundering_accounts,
  round(avg(CAST(sent_count AS DOUBLE)), 6) AS avg_sent_count, round(avg(CAST(received_count AS DOUBLE)), 6) AS avg_received_count,
  round(avg(fan_out_score), 6) AS avg_fan_out, round(avg(fan_in_score), 6) AS avg_fan_in,
  round(avg(scatter_gather_score), 6) AS avg_scatter_gather,
  round(avg(CAST(account_laundering AS DOUBLE)), 6) AS laundering_account_rate, 'nearest' AS method FROM near GROUP BY cluster"""

DBSCAN_EPS, DBSCAN_POINTS = 0.25, 10


def dbscan(spark, sf_dir):
    """Accounts by logarithmic turnover and fan-out."""
    points = account_table(spark, sf_dir).select(
        "account_id",
        F.array(
            F.round("log_abs_total_sent", 4), F.round("log_abs_total_received", 4), F.round("fan_out_score", 4)
        ).alias("x"),
    )
    return K.dbscan(points, DBSCAN_EPS, DBSCAN_POINTS, 3, key="account_id").select("account_id", "cluster")


_DBSCAN_SQL = f"""WITH RECURSIVE {SPARSE}, {ACCOUNTS_SQL},
pts AS MATERIALIZED (SELECT account_id, round(log_abs_total_sent, 4) AS a, round(log_abs_total_received, 4) AS b, round(fan_out_score, 4) AS c
  FROM account_table),
near AS MATERIALIZED (SELECT p.account_id AS p, q.account_id AS q FROM pts p JOIN pts q
  ON (p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c) <= {DBSCAN_EPS} * {DBSCAN_EPS}),
core AS MATERIALIZED (SELECT p FROM near GROUP BY p HAVING count(*) >= {DBSCAN_POINTS}),
links AS MATERIALIZED (SELECT p, q FROM near WHERE p IN (SELECT p FROM core) AND q IN (SELECT p FROM core)),
reach(node, root) USING KEY (node) AS (SELECT p, p FROM core
  UNION SELECT l.q, min(r.root) FROM reach r JOIN links l ON r.node = l.p JOIN recurring.reach o ON o.node = l.q
    WHERE r.root < o.root GROUP BY l.q),
numbered AS (SELECT node, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM reach),
border AS (SELECT n.p AS node, min(cluster) AS cluster FROM near n JOIN numbered m ON n.q = m.node
  WHERE n.p NOT IN (SELECT p FROM core) GROUP BY n.p)
SELECT account_id, CAST(coalesce(m.cluster, b.cluster, -1) AS INTEGER) AS cluster
FROM pts LEFT JOIN numbered m ON account_id = m.node LEFT JOIN border b ON account_id = b.node"""

# ---------------------------------------------------------------- fitted clusterings (no SQL twin)


def _transaction_clusters(fit, method):
    """All transactions: matrix, PCA, clusters by ``fit(points, k)``, profile and centroid-based measures."""

    def run(spark, sf_dir):
        from pyspark.ml.functions import vector_to_array

        from flowsieve.operators.preparation import fit_preparation

        setting = K.TRANSACTION_CLUSTERING
        used = ["row_key", "is_laundering", *BASE_NUMERIC, *GRAPH_NUMERIC, *CATEGORICAL]
        rows = written(G.retrospective_features(featured(spark, sf_dir)).select(*used), "graph-rows")
        fitted = fit_preparation(rows, BASE_NUMERIC + GRAPH_NUMERIC, CATEGORICAL)
        points = fitted.transform(rows).select(
            "row_key", "is_laundering", "amount_paid", "sender_out_degree", vector_to_array("features").alias("x")
        )
        points = written(K.project(points, K.pca_model(points, setting["dims"])), "projected")
        # The nearest centre is found again by every reader: a second copy of the points would be the largest table here.
        clustered = fit(points, setting["k"])
        profile = K.transaction_profile(clustered, "cluster", method)
        measures = K.silhouette(clustered).withColumn("davies_bouldin", K.davies_bouldin(clustered).scalar())
        measures = measures.withColumn("calinski_harabasz", K.calinski_harabasz(clustered).scalar())
        return profile.withColumns({c: F.lit(v) for c, v in measures.first().asDict().items()})

    return run


def account_clustering(spark, sf_dir):
    """All accounts: scaled, projected, clustered both ways, with agreement against the label."""
    setting = K.ACCOUNT_CLUSTERING
    accounts = written(account_table(spark, sf_dir), "accounts")
    points = written(K.matrix(accounts, A.ACCOUNT_MODEL_COLUMNS, ["account_id", "account_laundering"]), "matrix")
    points = written(K.project(points, K.pca_model(points, setting["dims"])), "projected")
    out = None
    for method, found in (
        ("Account KMeans", K.kmeans(points, setting["k"])),
        (
            "Account DBSCAN",
            K.dbscan(points, setting["eps"], setting["min_points"], setting["dbscan_dims"], key="account_id"),
        ),
    ):
        found = written(found.select("account_id", "account_laundering", "x", "cluster"), "clustered")
        row = K.cluster_counts(found, min_points=20).withColumn("method", F.lit(method))
        for figure in (K.agreement(found, "account_laundering"), K.silhouette(found),
                       K.highest_positive_rate(found, "account_laundering")):
            row = row.withColumns({c: F.lit(v) for c, v in figure.first().asDict().items()})
        out = row if out is None else out.unionByName(row)
    return out


def pca_variance(spark, sf_dir):
    accounts = written(account_table(spark, sf_dir), "accounts")
    points = K.matrix(accounts, A.ACCOUNT_MODEL_COLUMNS, ["account_id"])
    model = K.pca_model(points, 12)
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    return spark.createDataFrame(rows, "component int, explained_variance double")


def pca_projection(spark, sf_dir):
    accounts = written(account_table(spark, sf_dir), "accounts")
    points = K.matrix(accounts, A.ACCOUNT_MODEL_COLUMNS, ["account_id", "account_laundering"])
    flat = K.project(points, K.pca_model(points, 2))
    return flat.select("account_id", "account_laundering", F.col("x")[0].alias("pca_1"), F.col("x")[1].alias("pca_2"))


QUERIES = {
    "kmeans_assign": lambda spark, d: assigned(spark, d).select("vec_id", "cluster"),
    "silhouette": lambda spark, d: _rounded_one(K.silhouette(by_label(spark, d))),
    "silhouette_euclidean": lambda spark, d: _rounded_one(
        K.silhouette_euclidean(written(X.smallest_draws(by_label(spark, d), "vec_id", 12_000), "sample"), "vec_id")
    ),
    "davies_bouldin": lambda spark, d: _rounded_one(K.davies_bouldin(by_label(spark, d))),
    "calinski_harabasz": lambda spark, d: _rounded_one(K.calinski_harabasz(by_label(spark, d))),
    "cluster_metrics": cluster_metrics,
    "cluster_agreement": cluster_agreement,
    "cluster_max_rate": cluster_max_rate,
    "txn_cluster_profile": txn_cluster_profile,
    "account_cluster_profile": account_cluster_profile,
    "dbscan": dbscan,
    "kmeans_clusters": _transaction_clusters(K.kmeans, "kmeans"),
    "minibatch_clusters": _transaction_clusters(lambda points, k: minibatch_kmeans(points, k, "row_key"), "minibatch"),
    "account_clustering": account_clustering,
    "pca_variance": pca_variance,
    "pca_projection": pca_projection,
}
_SQUARED = "list_distance(a.x, b.x) * list_distance(a.x, b.x)"
_SAMPLE = "sample AS MATERIALIZED (SELECT * FROM v QUALIFY row_number() OVER (ORDER BY md5('42#' || vec_id), vec_id) <= 12000)"
SQL = {
    "kmeans_assign": f"{_ASSIGNED} SELECT vec_id, cluster FROM near",
    "silhouette": f"{_BASE}, {_PAIRS.format(distance=_SQUARED, source='v')}",
    "silhouette_euclidean": f"{_BASE}, {_SAMPLE}, {_PAIRS.format(distance='list_distance(a.x, b.x)', source='sample')}",
    "davies_bouldin": f"""{_BASE}, spread AS (SELECT c, centre, avg(list_distance(x, centre)) AS s FROM v JOIN centres ON label = c GROUP BY ALL)
SELECT round(avg(worst), 6) AS davies_bouldin FROM (SELECT a.c, max((a.s + b.s) / list_distance(a.centre, b.centre)) AS worst
  FROM spread a JOIN spread b ON a.c <> b.c GROUP BY a.c)""",
    "calinski_harabasz": f"""{_BASE}, middle AS (SELECT list(m ORDER BY dim) AS centre FROM (SELECT dim, avg(value) AS m FROM long GROUP BY dim)),
within_ AS (SELECT sum(list_distance(x, centre) ** 2) AS w, count(*) AS n FROM v JOIN centres ON label = c),
between_ AS (SELECT sum(n * list_distance(centres.centre, middle.centre) ** 2) AS b, count(*) AS k FROM centres JOIN sizes USING (c), middle)
SELECT round(b / (k - 1) / (w / (n - k)), 6) AS calinski_harabasz FROM within_, between_""",
    "cluster_metrics": f"""{_ASSIGNED} SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters_ex_noise,
  round(CAST(count(*) FILTER (cluster = -1) AS DOUBLE) / count(*), 6) AS noise_rate,
  count(DISTINCT cluster) FILTER (cluster <> -1) >= 2 AND count(*) FILTER (cluster <> -1) > 10 AS valid,
  (SELECT round(max(r), 6) FROM (SELECT avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) AS r FROM near GROUP BY cluster))
    AS cluster_positive_rate_max FROM near""",
    "cluster_agreement": _AGREEMENT_SQL,
    "cluster_max_rate": f"""WITH {TXN},
near AS ({_nearest_sql('txn', 'ln(1 + greatest(amount_paid, 0))', 'hour(ts) / CAST(4 AS DOUBLE)', TXN_CENTROIDS).format(key='row_key')})
SELECT round(max(r), 6) AS cluster_positive_rate_max FROM (SELECT avg(CAST(is_laundering AS DOUBLE)) AS r FROM near GROUP BY cluster)""",
    "txn_cluster_profile": _TXN_PROFILE_SQL,
    "account_cluster_profile": _ACCOUNT_PROFILE_SQL,
    "dbscan": _DBSCAN_SQL,
}
