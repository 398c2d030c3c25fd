"""Feature preparation and supervised models.

Preparation has SQL twins. Queries of fitted models return whole scores and metric tables; SQL cannot repeat a fit,
so the tests check them: counts, metrics computed again from the scores, and that a constant model fails. Models have
the library's default trees, rounds and iterations; the two grid queries try part of the grid, see the README.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsieve.operators import models as L
from flowsieve.operators import neighbours as N
from flowsieve.operators import preparation as P
from flowsieve.operators import sampling as X
from flowsieve.operators import selection as S
from flowsieve.operators.draws import fit_drawn_forest
from flowsieve.operators.features import add_base_features
from flowsieve.operators.graph import retrospective_features
from flowsieve.operators.history import add_history_features
from flowsieve.operators.reports import top_k
from flowsieve.plans.evaluation import SPLIT_SQL
from flowsieve.plans.star import featured, payments, payments_sql, table
from flowsieve.session import scratch_path, written
from flowsieve.sources.payments import write_predictions
from flowsieve.sources.schema import BASE_NUMERIC, CATEGORICAL, HISTORY_NUMERIC

TXN = payments_sql()
KEY = "row_key"
TRAIN_COLUMNS = [KEY, "ts", "is_laundering", *BASE_NUMERIC, *CATEGORICAL]

# ---------------------------------------------------------------- preparation, with SQL twins


def parts(spark, sf_dir):
    """Parts with two columns made incomplete, so that imputation has something to do."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.nullif(F.col("p_size"), F.lit(10)).cast("double").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.nullif(F.col("p_brand"), F.lit("Brand#5")).alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("p_name").alias("name"),
    )


PARTS_SQL = """parts AS (SELECT p_partkey, CAST(nullif(p_size, 10) AS DOUBLE) AS size, p_retailprice AS price,
  nullif(p_brand, 'Brand#5') AS brand, p_type AS kind, p_name AS name FROM part)"""


def impute_stats(spark, sf_dir):
    rows = parts(spark, sf_dir)
    numbers = P.medians(rows, ["size", "price"]).select("feature", F.round("value", 6).cast("string").alias("value"))
    return numbers.unionByName(P.modes(rows, ["brand", "kind"]))


_IMPUTE_SQL = f"""WITH {PARTS_SQL}
SELECT 'size' AS feature, CAST(round(quantile_cont(size, 0.5), 6) AS VARCHAR) AS value FROM parts
UNION ALL SELECT 'price', CAST(round(quantile_cont(price, 0.5), 6) AS VARCHAR) FROM parts
""" + "".join(
    f"""UNION ALL SELECT '{c}', (SELECT {c} FROM parts WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)
"""
    for c in ("brand", "kind")
)


def standardize(spark, sf_dir):
    rows = written(featured(spark, sf_dir).select(KEY, *BASE_NUMERIC), "rows")
    fitted = P.fit_preparation(rows, BASE_NUMERIC, [])
    return rows.select(KEY, *[(F.round(x, 6) + F.lit(0.0)).alias(n) for n, x in fitted.encoded().items()])


_BASE_VALUES = {
    "amount_paid": "amount_paid", "amount_received": "amount_received",
    "log_amount_paid": "ln(1 + greatest(amount_paid, 0))", "log_amount_received": "ln(1 + greatest(amount_received, 0))",
    "amount_diff": "amount_paid - amount_received", "hour": "hour(ts)", "weekday": "isodow(ts) - 1",
    "is_weekend": "CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END",
    "same_currency": "CASE WHEN payment_currency = receiving_currency THEN 1 ELSE 0 END",
    "same_bank": "CASE WHEN from_bank = to_bank THEN 1 ELSE 0 END",
}


def base_values_sql(source: str, extra: str = "") -> str:
    return f"SELECT row_key{extra}, " + ", ".join(
        f"CAST({x} AS DOUBLE) AS {n}" for n, x in _BASE_VALUES.items()
    ) + f" FROM {source}"


_STANDARD_SQL = f"WITH {TXN}, v AS MATERIALIZED ({base_values_sql('txn')}) SELECT row_key, " + ", ".join(
    f"round(({n} - (SELECT avg({n}) FROM v)) / (SELECT stddev_pop({n}) FROM v), 6) + CAST(0 AS DOUBLE) AS num__{n}"
    for n in _BASE_VALUES
) + " FROM v"


def one_hot(spark, sf_dir):
    """Fitted on the small parts, applied to all: rare and unknown categories both occur."""
    rows = written(parts(spark, sf_dir), "parts")
    fitted = P.fit_preparation(rows.filter(F.col("size") <= 25), [], ["brand", "name"])
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), x.alias("value")) for n, x in fitted.encoded().items()])
    return rows.select("p_partkey", F.inline(cells)).filter(F.col("value") > 0).select("p_partkey", "feature")


def _one_hot_sql(c: str) -> str:
    return f"""SELECT p_partkey, CASE WHEN n >= {P.MIN_CATEGORY_ROWS} THEN 'cat__{c}_' || v ELSE 'cat__{c}_{P.INFREQUENT}' END AS feature
  FROM (SELECT p_partkey, coalesce({c}, (SELECT {c} FROM fit WHERE {c} IS NOT NULL GROUP BY {c}
          ORDER BY count(*) DESC, {c} LIMIT 1)) AS v FROM parts)
  JOIN (SELECT coalesce({c}, (SELECT {c} FROM fit WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS v,
          count(*) AS n FROM fit GROUP BY 1) USING (v)"""


_ONE_HOT_SQL = f"WITH {PARTS_SQL}, fit AS (SELECT * FROM parts WHERE size <= 25) {_one_hot_sql('brand')} UNION ALL {_one_hot_sql('name')}"


def _fitted(spark, sf_dir):
    rows = written(featured(spark, sf_dir).select(*TRAIN_COLUMNS), "rows")
    return rows, P.fit_preparation(rows, BASE_NUMERIC, CATEGORICAL)


def feature_names(spark, sf_dir):
    """Encoded names with the rows that fall into each category."""
    rows, fitted = _fitted(spark, sf_dir)
    encoded = fitted.encoded()
    totals = rows.agg(*[
        (F.sum(x) if n.startswith("cat__") else F.count(x)).cast("long").alias(n) for n, x in encoded.items()
    ])
    return totals.unpivot([], list(encoded), "feature", "rows")


_NAMES_SQL = f"WITH {TXN} " + " UNION ALL ".join(
    [f"SELECT 'num__{n}' AS feature, count(*) AS rows FROM txn" for n in BASE_NUMERIC]
    + [f"SELECT 'cat__{c}_' || {c}, count(*) FROM txn GROUP BY {c}" for c in CATEGORICAL]
)


def encoded_matrix(spark, sf_dir):
    """Per encoded column of the assembled vectors: non-zero entries, smallest and largest value."""
    from pyspark.ml.functions import vector_to_array

    rows, fitted = _fitted(spark, sf_dir)
    vectors = fitted.transform(rows).select(F.posexplode(vector_to_array("features")).alias("position", "value"))
    names = F.array(*[F.lit(n) for n in fitted.names()])
    return vectors.groupBy("position").agg(
        F.count_if(F.abs("value") > 1e-12).alias("non_zero"),
        (F.round(F.min("value"), 6) + F.lit(0.0)).alias("lowest"),
        (F.round(F.max("value"), 6) + F.lit(0.0)).alias("highest"),
    ).select(names[F.col("position")].alias("feature"), "non_zero", "lowest", "highest")


_MATRIX_SQL = f"WITH {TXN}, v AS MATERIALIZED ({base_values_sql('txn')}) " + " UNION ALL ".join(
    [
        f"""SELECT 'num__{n}' AS feature, count(*) FILTER (abs(({n} - m) / s) > 1e-12) AS non_zero,
  round(min(({n} - m) / s), 6) + CAST(0 AS DOUBLE) AS lowest, round(max(({n} - m) / s), 6) + CAST(0 AS DOUBLE) AS highest
  FROM v, (SELECT avg({n}) AS m, stddev_pop({n}) AS s FROM v)"""
        for n in BASE_NUMERIC
    ]
    + [
        f"""SELECT 'cat__{c}_' || {c}, count(*), CAST(CASE WHEN count(*) < (SELECT count(*) FROM txn) THEN 0 ELSE 1 END AS DOUBLE),
  CAST(1 AS DOUBLE) FROM txn GROUP BY {c}"""
        for c in CATEGORICAL
    ]
)


def _train_rows(spark, sf_dir):
    # The split only compares with two cutoffs: the join behind the rows is written before it, the rest is a scan.
    rows = X.stratified_split(written(featured(spark, sf_dir).select(*TRAIN_COLUMNS), "rows"), KEY)
    return rows.filter(F.col("split") == "train")


def _mi(spark, sf_dir):
    return P.mutual_information(_train_rows(spark, sf_dir), BASE_NUMERIC, CATEGORICAL)


def mutual_information(spark, sf_dir):
    return _mi(spark, sf_dir).withColumn("mutual_information", F.round("mutual_information", 9))


_BINS = 16
_PROBS = ", ".join(str(i / _BINS) for i in range(1, _BINS))
_MI_CTE = (
    f"""{SPLIT_SQL}, fit AS MATERIALIZED (SELECT * FROM split_rows WHERE split = 'train'),
v AS MATERIALIZED ({base_values_sql('fit', ', is_laundering AS y')}), cells AS ("""
    + " UNION ALL ".join(
        [
            f"""SELECT 'num__{n}' AS feature, len(list_filter(e, lambda c: {n} > c)) AS bin, y
  FROM v, (SELECT list_distinct(quantile_cont({n}, [{_PROBS}])) AS e FROM v)"""
            for n in BASE_NUMERIC
        ]
        + [
            f"""SELECT 'cat__{c}_' || k, CASE WHEN {c} = k THEN 1 ELSE 0 END, is_laundering
  FROM fit, (SELECT DISTINCT {c} AS k FROM fit)"""
            for c in CATEGORICAL
        ]
    )
    + """), mi AS (SELECT feature, greatest(sum(CAST(n AS DOUBLE) / t * ln(CAST(n AS DOUBLE) * t / (CAST(b AS DOUBLE) * l))), 0) AS mutual_information
  FROM (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, bin) AS b,
      sum(n) OVER (PARTITION BY feature, y) AS l
    FROM (SELECT feature, bin, y, count(*) AS n FROM cells GROUP BY ALL)) GROUP BY feature)"""
)


def neighbour_information(spark, sf_dir):
    found = N.neighbour_information(_train_rows(spark, sf_dir), BASE_NUMERIC, CATEGORICAL)
    return found.withColumn("mutual_information", F.round("mutual_information", 7))


def _digamma_sql(x: str) -> str:
    y = f"({x} + 10.0::DOUBLE)"
    shifted = " - ".join(f"1.0::DOUBLE / ({x} + {i})" for i in range(10))
    return (
        f"(ln({y}) - 0.5::DOUBLE / {y} - 1.0::DOUBLE / (12 * {y} * {y}) + 1.0::DOUBLE / (120 * pow({y}, 4))"
        f" - 1.0::DOUBLE / (252 * pow({y}, 6)) - {shifted})"
    )


def _neighbours_sql(k: int = N.NEIGHBOURS) -> str:
    """Neighbours by row windows per class, ranges by as-of joins with the running counts."""
    values = " UNION ALL ".join(
        [f"SELECT 'num__{n}' AS feature, {n} + CAST(0 AS DOUBLE) AS x, y FROM v" for n in BASE_NUMERIC]
        + [
            f"""SELECT 'cat__{c}_' || k, CAST(CASE WHEN {c} = k THEN 1 ELSE 0 END AS DOUBLE), is_laundering
  FROM fit, (SELECT DISTINCT {c} AS k FROM fit)"""
            for c in CATEGORICAL
        ]
    )
    near = ", ".join(
        f"CASE WHEN {side}(n, {j}) OVER w IS NULL THEN [] ELSE list_resize([]::DOUBLE[], least({side}(n, {j}) OVER w, {k}), {d}) END"
        for j in range(1, k + 1)
        for side, d in (("lag", f"x - lag(x, {j}) OVER w"), ("lead", f"lead(x, {j}) OVER w - x"))
    )
    term = f"{_digamma_sql('CAST(k AS DOUBLE)')} - {_digamma_sql('CAST(ny AS DOUBLE)')} - {_digamma_sql('CAST(m AS DOUBLE)')}"
    return f"""WITH {TXN}, {SPLIT_SQL}, fit AS MATERIALIZED (SELECT * FROM split_rows WHERE split = 'train'),
v AS MATERIALIZED ({base_values_sql('fit', ', is_laundering AS y')}),
cells AS MATERIALIZED (SELECT feature, x, y, count(*) AS n FROM ({values}) GROUP BY ALL),
sized AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY feature, y) AS ny FROM cells QUALIFY ny > 1),
sums AS MATERIALIZED (SELECT feature, x, sum(sum(n)) OVER (PARTITION BY feature ORDER BY x) AS upto, sum(n) AS here
  FROM sized GROUP BY feature, x),
reach AS (SELECT feature, x, y, n, ny, list_sort(flatten([list_resize([]::DOUBLE[], least(n - 1, {k}), CAST(0 AS DOUBLE)), {near}]))[
    CAST(least({k}, ny - 1) AS BIGINT)] AS r FROM sized WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
ends AS (SELECT *, x - r + {N.SLACK} * (abs(x) + r) AS lo, x + r - {N.SLACK} * (abs(x) + r) AS hi FROM reach),
counted AS (SELECT e.feature, e.n, e.ny, CASE WHEN r = 0 THEN e.n - 1 ELSE least({k}, ny - 1) END AS k,
    CASE WHEN r = 0 THEN own.here - 1 ELSE greatest(top.upto - coalesce(low.upto, 0), e.n) END AS m
  FROM ends e JOIN sums own ON own.feature = e.feature AND own.x = e.x
  ASOF LEFT JOIN sums low ON low.feature = e.feature AND e.lo >= low.x
  ASOF LEFT JOIN sums top ON top.feature = e.feature AND e.hi > top.x)
SELECT feature, round(greatest({_digamma_sql('CAST(sum(n) AS DOUBLE)')} + sum(n * ({term})) / sum(n), 0), 7) AS mutual_information
FROM counted GROUP BY feature"""


def top_k_features(spark, sf_dir):
    return top_k(mutual_information(spark, sf_dir), "mutual_information", 10, "feature")


def class_weights(spark, sf_dir):
    return L.class_weights(featured(spark, sf_dir)).withColumn("weight", F.round("weight", 9))


# ---------------------------------------------------------------- models


def split_rows(spark, sf_dir, graph: bool = False):
    """Training table, written once, with the nested fit / validation / test split as a comparison with cutoffs."""
    rows = featured(spark, sf_dir)
    columns = list(TRAIN_COLUMNS)
    if graph:
        rows = retrospective_features(rows)
        columns += [c for c in rows.columns if c in L.GRAPH_NUMERIC]
    return X.nested_split(written(rows.select(*columns), "model-rows"), KEY)


def model_rows(spark, sf_dir, graph: bool = False):
    """The split training table written once for all solver passes."""
    return written(split_rows(spark, sf_dir, graph), "split-rows")


def folded_rows(spark, sf_dir):
    """All but the test rows with their fold, written once."""
    train = split_rows(spark, sf_dir).filter(F.col("split") != "test").drop("split")
    return written(X.stratified_folds(train, KEY), "folds")


def whole(scored, *by):
    """Every row's score, written once."""
    return written(scored.select(KEY, *by, "is_laundering", "score"), "scores")


def _scores(spec):
    def run(spark, sf_dir):
        rows = model_rows(spark, sf_dir)
        fitted = L.fit_model(spec, rows.filter(F.col("split") == "fit"))
        return whole(fitted.score(rows), "split")

    return run


def balanced_forest_scores(spark, sf_dir):
    """The forest with classes balanced inside every bootstrap draw."""
    rows = model_rows(spark, sf_dir)
    fitted = fit_drawn_forest(rows.filter(F.col("split") == "fit"), BASE_NUMERIC, CATEGORICAL, KEY)
    return whole(fitted.score(rows), "split")


def supervised_metrics(spark, sf_dir):
    """All families with and without graph features, evaluated on train, test and full."""
    rows = model_rows(spark, sf_dir, graph=True)
    return L.evaluate_models(L.ALL_SPECS, rows)[0]


def feature_importance(spark, sf_dir):
    rows = model_rows(spark, sf_dir, graph=True)
    fitted = L.fit_model(L.FOREST_GRAPH, rows.filter(F.col("split") == "fit"))
    return fitted.importances(20)


GRID_SPECS = [L.LOGISTIC, L.TREE]


def grid_search(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    train, test = rows.filter(F.col("split") != "test"), rows.filter(F.col("split") == "test")
    return S.grid_search(GRID_SPECS, train.drop("split"), test.drop("split"), KEY)[0]


def grid_candidates(spark, sf_dir):
    by_fold, _ = S.cross_validate(L.TREE, S.expand(S.GRIDS[L.TREE.name]), folded_rows(spark, sf_dir))
    return S.candidate_table(by_fold)


def oof_scores(spark, sf_dir):
    held = S.cross_validate(L.LOGISTIC, S.expand(S.GRIDS[L.LOGISTIC.name]), folded_rows(spark, sf_dir))[1]
    return whole(held, "fold", "params")


def topk_retrain(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    ranking = P.mutual_information(rows.filter(F.col("split") == "fit"), BASE_NUMERIC, CATEGORICAL)
    return S.top_k_ablation(rows, ranking, L.BOOSTING)


def feature_ablation_table(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    ranking = P.mutual_information(rows.filter(F.col("split") == "fit"), BASE_NUMERIC, CATEGORICAL)
    ablation = S.top_k_ablation(rows, ranking, L.TREE)
    metrics, _ = L.evaluate_models([L.TREE], rows)
    return S.feature_ablation_table(ablation, metrics, {L.TREE.name: "All base features (pipeline result)"})


ACCOUNT_KEYS = ["from_account_id", "to_account_id"]
QUICK_GRID = {"learning_rate": [0.08, 0.12], "max_leaf_nodes": [15], "class_weight": [None, "balanced"]}


def _temporal(spark, sf_dir):
    # What follows from the columns of a payment alone is added when its history is known, and travels with no row.
    raw = featured(spark, sf_dir).select(*payments(spark, sf_dir).columns, *ACCOUNT_KEYS).drop("score", "score_b")
    history = add_history_features(raw, [KEY]).drop(*ACCOUNT_KEYS)
    rows = written(add_base_features(history).select(*TRAIN_COLUMNS, *HISTORY_NUMERIC), "history-rows")
    # The split compares with two cutoffs: a scan of the written rows.
    return S.temporal_selection(X.chronological_split(rows, [KEY]), QUICK_GRID, iterations=5)


def temporal_selection(spark, sf_dir):
    return _temporal(spark, sf_dir)[1]


def scored_predictions(spark, sf_dir):
    predictions = _temporal(spark, sf_dir)[2]
    path = scratch_path(spark, "predictions")
    write_predictions(predictions, path)
    return spark.read.parquet(path).withColumn("ts", F.col("ts").cast("string"))


QUERIES = {
    "impute_stats": impute_stats,
    "standardize": standardize,
    "one_hot": one_hot,
    "feature_names": feature_names,
    "encoded_matrix": encoded_matrix,
    "mutual_information": mutual_information,
    "neighbour_information": neighbour_information,
    "top_k_features": top_k_features,
    "class_weights": class_weights,
    "logistic_scores": _scores(L.LOGISTIC),
    "tree_scores": _scores(L.TREE),
    "svm_scores": _scores(L.SVM),
    "forest_scores": _scores(L.FOREST),
    "gbt_scores": _scores(L.BOOSTING),
    "balanced_forest_scores": balanced_forest_scores,
    "supervised_metrics": supervised_metrics,
    "feature_importance": feature_importance,
    "grid_search": grid_search,
    "grid_candidates": grid_candidates,
    "oof_scores": oof_scores,
    "topk_retrain": topk_retrain,
    "feature_ablation_table": feature_ablation_table,
    "temporal_selection": temporal_selection,
    "scored_predictions": scored_predictions,
}
SQL = {
    "impute_stats": _IMPUTE_SQL,
    "standardize": _STANDARD_SQL,
    "one_hot": _ONE_HOT_SQL,
    "feature_names": _NAMES_SQL,
    "encoded_matrix": _MATRIX_SQL,
    "mutual_information": f"""WITH {TXN}, {_MI_CTE} SELECT feature, round(mutual_information, 9) AS mutual_information FROM mi""",
    "neighbour_information": _neighbours_sql(),
    "top_k_features": f"""WITH {TXN}, {_MI_CTE} SELECT feature, round(mutual_information, 9) AS mutual_information FROM mi
  ORDER BY 2 DESC, 1 LIMIT 10""",
    "class_weights": f"""WITH {TXN} SELECT is_laundering, count(*) AS n,
  round(CAST((SELECT count(*) FROM txn) AS DOUBLE) / 2 / count(*), 9) AS weight FROM txn GROUP BY 1""",
}
