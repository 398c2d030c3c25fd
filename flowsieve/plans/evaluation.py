"""Splits, samples and rare-event evaluation on the deterministic scores of the payment table."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsieve.functions import columns as C
from flowsieve.operators import bootstrap as B
from flowsieve.operators import metrics as M
from flowsieve.operators import reports as R
from flowsieve.operators import sampling as X
from flowsieve.operators.cumulative import quantiles
from flowsieve.plans.graph import POSITIONS_SQL, SPLIT_CASE
from flowsieve.plans.star import payments, payments_sql
from flowsieve.session import written

TXN = payments_sql()
KEY = "row_key"
BUDGET = 100


def scored(spark, sf_dir):
    return payments(spark, sf_dir).select(KEY, "ts", "is_laundering", "score", "score_b", "payment_format")


def stored(spark, sf_dir):
    """The scored table written once, for queries that read it several times."""
    return written(scored(spark, sf_dir), "scored")


# ---------------------------------------------------------------- samples and splits


def model_sample(spark, sf_dir):
    return X.case_control_sample(stored(spark, sf_dir), KEY, 10_000).select(KEY, "is_laundering")


def draw_sql(key: str, seed: int) -> str:
    return f"md5('{seed}#' || {key})"


def uniform_sql(text: str) -> str:
    return f"CAST(CAST('0x' || substr({text}, 1, 7) AS BIGINT) AS DOUBLE) / 268435456"


_MODEL_SAMPLE_SQL = f"""WITH {TXN} SELECT row_key, is_laundering FROM txn WHERE is_laundering = 1
  OR {uniform_sql(draw_sql('row_key', X.SPLIT_SEED))}
     < least(1, CAST(10000 AS DOUBLE) / (SELECT count(*) FROM txn WHERE is_laundering = 0))"""


def ranked_sql(source: str, seed: int, label: str = "is_laundering") -> str:
    draw = draw_sql("row_key", seed)
    return f"""SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {draw}, row_key) AS draw_rank,
    count(*) OVER (PARTITION BY {label}) AS label_n FROM {source}"""


SPLIT_SQL = f"""split_rows AS MATERIALIZED (SELECT * EXCLUDE (draw_rank, label_n),
    CASE WHEN draw_rank <= floor(label_n * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM ({ranked_sql('txn', X.SPLIT_SEED)}))"""
_NESTED_SQL = f"""WITH {TXN}, {SPLIT_SQL} SELECT row_key, 'test' AS split FROM split_rows WHERE split = 'test'
UNION ALL SELECT row_key, CASE WHEN draw_rank <= floor(label_n * CAST(0.8 AS DOUBLE)) THEN 'fit' ELSE 'validation' END
  FROM ({ranked_sql("(SELECT * FROM split_rows WHERE split = 'train')", X.VALIDATION_SEED)})"""
FOLDS_SQL = f"""fold_rows AS MATERIALIZED (SELECT * EXCLUDE (draw_rank, label_n),
    CASE WHEN draw_rank <= floor(label_n * 1 / CAST(3 AS DOUBLE)) THEN 0
         WHEN draw_rank <= floor(label_n * 2 / CAST(3 AS DOUBLE)) THEN 1 ELSE 2 END AS fold
  FROM ({ranked_sql('txn', X.FOLD_SEED)}))"""


def natural_sample(spark, sf_dir):
    rows = X.stratified_split(stored(spark, sf_dir), KEY)
    holdout = rows.filter(F.col("split") == "test")
    return X.natural_prior_sample(rows, holdout, KEY, exclude=rows.filter(F.col("split") == "train"))


NATURAL_SQL = f"""{SPLIT_SQL},
natural_rows AS MATERIALIZED (SELECT * FROM split_rows WHERE split = 'test' AND is_laundering = 1
  UNION ALL SELECT * FROM (SELECT * FROM split_rows WHERE split = 'test' AND is_laundering = 0
    QUALIFY row_number() OVER (ORDER BY {draw_sql('row_key', X.SPLIT_SEED)}, row_key) <= (
      SELECT round(count(*) FILTER (split = 'test' AND is_laundering = 1)
        * (1 - avg(CAST(is_laundering AS DOUBLE))) / avg(CAST(is_laundering AS DOUBLE))) FROM split_rows)))"""

# ---------------------------------------------------------------- metrics


def points_sql(source: str, groups: str = "", score: str = "score", weight: str = "1", name: str = "points") -> str:
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups}" if groups else ""
    return f"""{name} AS MATERIALIZED (SELECT {g}{score} AS score, pos, neg,
    CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
    CAST(sum(pos) OVER ({part}) AS DOUBLE) AS p, CAST(sum(neg) OVER ({part}) AS DOUBLE) AS n
  FROM (SELECT {g}{score}, CAST(sum(is_laundering * {weight}) AS BIGINT) AS pos,
      CAST(sum((1 - is_laundering) * {weight}) AS BIGINT) AS neg FROM {source} GROUP BY {g}{score})
  WINDOW w AS ({part} ORDER BY {score} DESC))"""


AP = "coalesce(sum(CASE WHEN p > 0 THEN CAST(pos AS DOUBLE) / p * tp / (tp + fp) END), 0)"
AUC = "sum(pos * (2 * (n - fp) + neg)) / nullif(2 * max(p) * max(n), 0)"
BEST = """SELECT {g}arg_max(score, (f1, -score)) AS threshold, max(f1) AS f1 FROM (
  SELECT *, coalesce(2 * tp / nullif(tp + fp + p, 0), 0) AS f1 FROM {points}) {tail}"""
_COUNTS = """count(*) FILTER (score < threshold AND is_laundering = 0) AS tn,
  count(*) FILTER (score >= threshold AND is_laundering = 0) AS fp,
  count(*) FILTER (score < threshold AND is_laundering = 1) AS fn,
  count(*) FILTER (score >= threshold AND is_laundering = 1) AS tp"""
_RATES = """CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * CAST(tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1"""

THRESHOLD = 0.65


def _rounded(df, columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


RATE_COLUMNS = ["accuracy", "precision", "recall", "f1"]


def threshold_metrics(spark, sf_dir):
    return _rounded(M.with_rates(M.confusion_counts(scored(spark, sf_dir), THRESHOLD)), RATE_COLUMNS)


def _round_sql(columns, digits=9):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def pr_curve(spark, sf_dir):
    return _rounded(M.pr_curve(scored(spark, sf_dir)), ["precision", "recall"])


def roc_curve(spark, sf_dir):
    return _rounded(M.roc_curve(scored(spark, sf_dir)), ["fpr", "tpr"])


def model_rows(df):
    """Long form: one row per payment and model."""
    return df.select(*[c for c in df.columns if c not in ("score", "score_b")], F.inline(F.array(
        F.struct(F.lit("Graph scores").alias("model"), F.col("score").alias("score")),
        F.struct(F.lit("Base scores").alias("model"), F.col("score_b").alias("score")),
        F.struct(F.lit("Dummy all-legitimate").alias("model"), F.lit(0.0).alias("score")),
    )))


def model_rows_sql(source: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT row_key, is_laundering{extra}, '{m}' AS model, {s} AS score FROM {source}"
        for m, s in (("Graph scores", "score"), ("Base scores", "score_b"), ("Dummy all-legitimate", "CAST(0 AS DOUBLE)"))
    )


def _thresholds(train):
    """Best-F1 threshold per model on training rows; the dummy keeps 0.5."""
    best = M.best_f1_threshold(train, ["model"])
    dummy = F.col("model") == "Dummy all-legitimate"
    return written(best.withColumn("threshold", F.when(dummy, F.lit(0.5)).otherwise(F.col("threshold"))), "thresholds")


def metrics_by_split(spark, sf_dir):
    rows = model_rows(X.stratified_split(stored(spark, sf_dir), KEY)).drop("ts", "payment_format")
    thresholds = _thresholds(rows.filter(F.col("split") == "train"))
    every = rows.withColumn("split", F.explode(F.array(F.col("split"), F.lit("full"))))
    return _rounded(M.metrics_table(every, thresholds, ["model", "split"]), [*RATE_COLUMNS, "pr_auc", "roc_auc"])


_MODEL_THRESHOLDS = f"""{points_sql("(SELECT * FROM long_rows WHERE split = 'train')", "model", name="train_points")},
thresholds AS MATERIALIZED (SELECT model, CASE WHEN model LIKE 'Dummy%' THEN 0.5 ELSE threshold END AS threshold
  FROM ({BEST.format(g='model, ', points='train_points', tail='GROUP BY model')}))"""
BY_SPLIT_SQL = f"""{SPLIT_SQL}, long_rows AS MATERIALIZED ({model_rows_sql('split_rows', ', split')}),
{_MODEL_THRESHOLDS},
every_split AS MATERIALIZED (SELECT * FROM long_rows UNION ALL SELECT * REPLACE ('full' AS split) FROM long_rows),
{points_sql('every_split', 'model, split', name='split_points')},
split_metrics AS (SELECT *, {_RATES} FROM (SELECT model, split, threshold, {_COUNTS}
    FROM every_split JOIN thresholds USING (model) GROUP BY ALL)
  JOIN (SELECT model, split, {AP} AS pr_auc, {AUC} AS roc_auc FROM split_points GROUP BY ALL) USING (model, split))"""
_METRIC_OUT = f"threshold, tn, fp, fn, tp, {_round_sql([*RATE_COLUMNS, 'pr_auc', 'roc_auc'])}"


def _test_metrics(spark, sf_dir):
    return metrics_by_split(spark, sf_dir).filter(F.col("split") == "test").drop("split")


def class_report(spark, sf_dir):
    rows = stored(spark, sf_dir)
    best = M.best_f1_threshold(rows).first()["threshold"]
    report = M.class_report(M.confusion_counts(rows, best))
    return _rounded(report, ["precision", "recall", "f1"])


def threshold_sweep(spark, sf_dir):
    rows = stored(spark, sf_dir)
    best = M.best_f1_threshold(rows).first()["threshold"]
    sweep = M.threshold_sweep(rows, best)
    return _rounded(sweep, ["alert_rate", "alerts_per_10k", "precision", "recall", "f1"])


_SWEEP_SQL = f"""WITH {TXN}, {points_sql('txn')},
cuts AS (SELECT DISTINCT round(t, 10) AS threshold FROM (
  SELECT unnest([{', '.join(f'CAST({t} AS DOUBLE)' for t in M.SWEEP_THRESHOLDS)}]) AS t
  UNION ALL SELECT unnest(quantile_cont(score, [{', '.join(str(1 - r) for r in M.SWEEP_ALERT_RATES)}])) FROM txn
  UNION ALL SELECT threshold FROM ({BEST.format(g='', points='points', tail='')}))),
counts AS (SELECT threshold, {_COUNTS} FROM txn, cuts GROUP BY threshold)
SELECT threshold, round(CAST(tp + fp AS DOUBLE) / (tp + fp + tn + fn), 9) AS alert_rate, tp + fp AS alerts,
  round(10000 * CAST(tp + fp AS DOUBLE) / (tp + fp + tn + fn), 9) AS alerts_per_10k, tn, fp, fn, tp,
  {_round_sql(['precision', 'recall', 'f1'])}
FROM (SELECT *, {_RATES} FROM counts)"""


def natural_evaluation(spark, sf_dir):
    rows = X.stratified_split(stored(spark, sf_dir), KEY)
    train, holdout = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    threshold = M.best_f1_threshold(train).first()["threshold"]
    natural = X.natural_prior_sample(rows, holdout, KEY, exclude=train).withColumn(
        "evaluation", F.lit("natural_class_prior_stress_test")
    )
    table = M.metrics_table(natural, threshold, ["evaluation"])
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    table = table.withColumns(
        {"rows": n, "positive_rows": F.col("fn") + F.col("tp"), "positive_rate": (F.col("fn") + F.col("tp")) / n}
    )
    return _rounded(table, [*RATE_COLUMNS, "pr_auc", "roc_auc", "positive_rate"])


_NATURAL_EVAL_SQL = f"""WITH {TXN}, {NATURAL_SQL},
{points_sql("(SELECT * FROM split_rows WHERE split = 'train')", name='train_points')},
{points_sql('natural_rows')}, cut AS ({BEST.format(g='', points='train_points', tail='')}),
counts AS (SELECT threshold, {_COUNTS} FROM natural_rows, (SELECT threshold FROM cut) GROUP BY threshold)
SELECT 'natural_class_prior_stress_test' AS evaluation, threshold, tn, fp, fn, tp, tn + fp + fn + tp AS rows,
  fn + tp AS positive_rows, round(CAST(fn + tp AS DOUBLE) / (tn + fp + fn + tp), 9) AS positive_rate,
  {_round_sql([*RATE_COLUMNS, 'pr_auc', 'roc_auc'])}
FROM (SELECT *, {_RATES} FROM counts), (SELECT {AP} AS pr_auc, {AUC} AS roc_auc FROM points)"""

# ---------------------------------------------------------------- bootstrap


def paired_bootstrap(spark, sf_dir):
    deltas = B.bootstrap_deltas(scored(spark, sf_dir), KEY, "score_b", "score")
    return _rounded(deltas, ["base_pr_auc", "enhanced_pr_auc", "delta"])


def bootstrap_interval(spark, sf_dir):
    deltas = B.bootstrap_deltas(scored(spark, sf_dir), KEY, "score_b", "score")
    return _rounded(B.bootstrap_interval(written(deltas, "deltas")), ["ci_lower_95", "ci_upper_95"])


_WEIGHT = "CASE " + " ".join(f"WHEN u < CAST({c} AS DOUBLE) THEN {k}" for k, c in enumerate(B.POISSON_CUMULATIVE)) + (
    f" ELSE {len(B.POISSON_CUMULATIVE)} END"
)
_COEFFICIENTS = ", ".join(
    f"CAST('0x' || substr(md5(row_key), {1 + 7 * i}, 7) AS BIGINT) AS c{i}" for i in range(B.COEFFICIENTS)
)
_BOOTSTRAP_SQL = f"""WITH {TXN}, seeded AS MATERIALIZED (SELECT is_laundering, score, score_b, {_COEFFICIENTS} FROM txn),
drawn AS (SELECT is_laundering, score, score_b, replicate,
    CAST((((c3 * replicate + c2) % {B.PRIME} * replicate + c1) % {B.PRIME} * replicate + c0) % {B.PRIME} AS DOUBLE) / {B.PRIME} AS u
  FROM seeded, range({B.REPLICATES}) t(replicate)),
weighted AS MATERIALIZED (SELECT * FROM (SELECT *, {_WEIGHT} AS weight FROM drawn) WHERE weight > 0),
{points_sql('weighted', 'replicate', 'score_b', 'weight', 'base_points')},
{points_sql('weighted', 'replicate', 'score', 'weight', 'enhanced_points')},
deltas AS (SELECT CAST(replicate AS INTEGER) AS replicate, a.ap AS base_pr_auc, b.ap AS enhanced_pr_auc, b.ap - a.ap AS delta
  FROM (SELECT replicate, {AP} AS ap FROM base_points WHERE p > 0 AND n > 0 GROUP BY replicate) a
  JOIN (SELECT replicate, {AP} AS ap FROM enhanced_points WHERE p > 0 AND n > 0 GROUP BY replicate) b USING (replicate))
"""

# ---------------------------------------------------------------- selection tables

BLENDS = {"single": [0.0, 1.0], "blend": [0.25, 0.5, 0.75]}


def candidate_rank(spark, sf_dir):
    rows = X.stratified_folds(stored(spark, sf_dir), KEY)
    candidates = [
        F.struct(
            F.lit(feature_set).alias("feature_set"),
            C.params_json({"weight": w}).alias("params"),
            F.round(F.lit(w) * F.col("score") + F.lit(1 - w) * F.col("score_b"), 6).alias("candidate_score"),
        )
        for feature_set, weights in BLENDS.items()
        for w in weights
    ]
    long = rows.select("is_laundering", "fold", F.inline(F.array(*candidates)))
    by_fold = M.ranking_metrics(long, ["feature_set", "params", "fold"], "candidate_score")
    return _rounded(
        R.candidate_ranks(by_fold, ["feature_set", "params"], ["feature_set"]), ["mean_pr_auc", "std_pr_auc"]
    )


_CANDIDATE_ROWS = " UNION ALL ".join(
    f"""SELECT is_laundering, fold, '{s}' AS feature_set, '{{"weight":"{w}"}}' AS params,
  round(CAST({w} AS DOUBLE) * score + CAST({1 - w} AS DOUBLE) * score_b, 6) AS candidate_score FROM fold_rows"""
    for s, ws in BLENDS.items()
    for w in ws
)
_CANDIDATE_SQL = f"""WITH {TXN}, {FOLDS_SQL}, long_rows AS ({_CANDIDATE_ROWS}),
{points_sql('long_rows', 'feature_set, params, fold', 'candidate_score')},
per_fold AS (SELECT feature_set, params, fold, {AP} AS ap FROM points GROUP BY ALL),
per_candidate AS (SELECT feature_set, params, avg(ap) AS m, stddev_pop(ap) AS sd FROM per_fold GROUP BY ALL)
SELECT feature_set, params, round(m, 9) AS mean_pr_auc, round(sd, 9) AS std_pr_auc,
  CAST(rank() OVER (PARTITION BY feature_set ORDER BY round(m, 12) DESC) AS INTEGER) AS rank FROM per_candidate"""


def log_upsert(spark, sf_dir):
    rows = X.chronological_split(stored(spark, sf_dir), [KEY])

    def log(part, attempt):
        return part.groupBy(F.col("payment_format").alias("stage")).agg(
            F.lit(attempt).alias("attempt"),
            F.concat(F.lit("positives="), F.sum("is_laundering").cast("string")).alias("failure_mode"),
            F.concat(F.lit("rows="), F.count(F.lit(1)).cast("string")).alias("lesson"),
        )

    existing = log(rows.filter(F.col("split") == "train"), "training period")
    later = log(rows.filter((F.col("split") == "test") & (F.col("score") >= 0.9)), "alerts of the test period")
    return R.log_upsert(existing, later)


def _log_sql(where: str, attempt: str) -> str:
    return f"""SELECT payment_format AS stage, '{attempt}' AS attempt, 'positives=' || CAST(sum(is_laundering) AS BIGINT) AS failure_mode,
  'rows=' || count(*) AS lesson FROM parts WHERE {where} GROUP BY 1"""


PARTS_SQL = f"{POSITIONS_SQL}, parts AS MATERIALIZED (SELECT *, {SPLIT_CASE} AS split FROM positions)"
_LOG_SQL = f"""WITH {TXN}, {PARTS_SQL}, later AS ({_log_sql("split = 'test' AND score >= 0.9", 'alerts of the test period')}),
existing AS ({_log_sql("split = 'train'", 'training period')})
SELECT * FROM later UNION ALL SELECT * FROM existing WHERE stage NOT IN (SELECT stage FROM later)"""


def dummy_baseline(spark, sf_dir):
    rows = scored(spark, sf_dir).select("is_laundering", F.lit(0.0).alias("score"), F.lit("dummy").alias("model"))
    return _rounded(M.metrics_table(rows, 0.5, ["model"]), [*RATE_COLUMNS, "pr_auc", "roc_auc"])


QUANTILES = [0.0, 0.25, 0.5, 0.9, 0.95, 0.975, 0.999, 1.0]

QUERIES = {
    "model_sample": model_sample,
    "bounded_sample": lambda spark, d: X.smallest_draws(stored(spark, d), KEY, 12_000).select(KEY, "score"),
    "stratified_split": lambda spark, d: X.stratified_split(stored(spark, d), KEY).select(KEY, "split"),
    "nested_split": lambda spark, d: X.nested_split(stored(spark, d), KEY).select(KEY, "split"),
    "stratified_folds": lambda spark, d: X.stratified_folds(stored(spark, d), KEY).select(KEY, "fold"),
    "chrono_split": lambda spark, d: X.chronological_split(stored(spark, d), [KEY]).select(KEY, "split"),
    "split_audit": lambda spark, d: _rounded(
        M.split_audit(X.chronological_split(stored(spark, d), [KEY])), ["positive_rate"]
    ),
    "natural_sample": lambda spark, d: natural_sample(spark, d).select(KEY, "is_laundering"),
    "confusion_counts": lambda spark, d: M.confusion_counts(scored(spark, d), THRESHOLD),
    "threshold_metrics": threshold_metrics,
    "pr_curve": pr_curve,
    "roc_curve": roc_curve,
    "average_precision": lambda spark, d: _rounded(
        M.average_precision_of(M.operating_points(scored(spark, d))), ["pr_auc"]
    ),
    "roc_auc": lambda spark, d: _rounded(M.roc_auc_of(M.operating_points(scored(spark, d))), ["roc_auc"]),
    "best_f1_threshold": lambda spark, d: _rounded(M.best_f1_threshold(scored(spark, d)), ["f1"]),
    "class_report": class_report,
    "metrics_by_split": metrics_by_split,
    "leaderboard": lambda spark, d: R.leaderboard(_test_metrics(spark, d)),
    "ablation_delta": lambda spark, d: _rounded(
        R.ablation_delta(_test_metrics(spark, d), "model", "Base scores", "Graph scores"), ["delta_f1", "delta_pr_auc"]
    ),
    "metrics_long": lambda spark, d: R.metrics_long(_test_metrics(spark, d), ["model"]),
    "threshold_sweep": threshold_sweep,
    "natural_evaluation": natural_evaluation,
    "alert_queue": lambda spark, d: M.alert_queue(scored(spark, d), BUDGET, KEY).select(KEY, "score", "is_laundering"),
    "score_quantiles": lambda spark, d: _rounded(quantiles(scored(spark, d), [], "score", QUANTILES), ["quantile"]),
    "paired_bootstrap": paired_bootstrap,
    "bootstrap_interval": bootstrap_interval,
    "candidate_rank": candidate_rank,
    "log_upsert": log_upsert,
    "dummy_baseline": dummy_baseline,
}
SQL = {
    "model_sample": _MODEL_SAMPLE_SQL,
    "bounded_sample": f"""WITH {TXN} SELECT row_key, score FROM txn
  QUALIFY row_number() OVER (ORDER BY {draw_sql('row_key', X.SPLIT_SEED)}, row_key) <= 12000""",
    "stratified_split": f"WITH {TXN}, {SPLIT_SQL} SELECT row_key, split FROM split_rows",
    "nested_split": _NESTED_SQL,
    "stratified_folds": f"WITH {TXN}, {FOLDS_SQL} SELECT row_key, fold FROM fold_rows",
    "chrono_split": f"WITH {TXN}, {POSITIONS_SQL} SELECT row_key, {SPLIT_CASE} AS split FROM positions",
    "split_audit": f"""WITH {TXN}, {PARTS_SQL} SELECT split, count(*) AS rows, CAST(sum(is_laundering) AS BIGINT) AS positive_rows,
  round(avg(CAST(is_laundering AS DOUBLE)), 9) AS positive_rate FROM parts GROUP BY split""",
    "natural_sample": f"WITH {TXN}, {NATURAL_SQL} SELECT row_key, is_laundering FROM natural_rows",
    "confusion_counts": f"WITH {TXN} SELECT {_COUNTS} FROM (SELECT *, CAST({THRESHOLD} AS DOUBLE) AS threshold FROM txn)",
    "threshold_metrics": f"""WITH {TXN}, counts AS (SELECT {_COUNTS} FROM (SELECT *, CAST({THRESHOLD} AS DOUBLE) AS threshold FROM txn))
  SELECT tn, fp, fn, tp, {_round_sql(RATE_COLUMNS)} FROM (SELECT *, {_RATES} FROM counts)""",
    "pr_curve": f"""WITH {TXN}, {points_sql('txn')} SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision,
  round(tp / p, 9) AS recall FROM points UNION ALL SELECT NULL, 1, 0""",
    "roc_curve": f"""WITH {TXN}, {points_sql('txn')} SELECT score AS threshold, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr
  FROM (SELECT *, lag(tp) OVER o AS tp0, lag(fp) OVER o AS fp0, lead(tp) OVER o AS tp2, lead(fp) OVER o AS fp2 FROM points
    WINDOW o AS (ORDER BY score DESC))
  WHERE tp0 IS NULL OR tp2 IS NULL OR tp2 - 2 * tp + tp0 <> 0 OR fp2 - 2 * fp + fp0 <> 0
  UNION ALL SELECT NULL, 0, 0""",
    "average_precision": f"WITH {TXN}, {points_sql('txn')} SELECT round({AP}, 9) AS pr_auc FROM points",
    "roc_auc": f"WITH {TXN}, {points_sql('txn')} SELECT round({AUC}, 9) AS roc_auc FROM points",
    "best_f1_threshold": f"""WITH {TXN}, {points_sql('txn')} SELECT threshold, round(f1, 9) AS f1
  FROM ({BEST.format(g='', points='points', tail='')})""",
    "class_report": f"""WITH {TXN}, {points_sql('txn')}, cut AS ({BEST.format(g='', points='points', tail='')}),
counts AS (SELECT {_COUNTS} FROM txn, (SELECT threshold FROM cut)),
classes AS (SELECT 1 AS class, tp AS hit, fp AS wrong, fn AS missed FROM counts UNION ALL SELECT 0, tn, fn, fp FROM counts)
SELECT class, round(coalesce(CAST(hit AS DOUBLE) / nullif(hit + wrong, 0), 0), 9) AS precision,
  round(coalesce(CAST(hit AS DOUBLE) / nullif(hit + missed, 0), 0), 9) AS recall,
  round(coalesce(2 * CAST(hit AS DOUBLE) / nullif(2 * hit + wrong + missed, 0), 0), 9) AS f1,
  hit + missed AS support FROM classes""",
    "metrics_by_split": f"WITH {TXN}, {BY_SPLIT_SQL} SELECT model, split, {_METRIC_OUT} FROM split_metrics",
    "leaderboard": f"WITH {TXN}, {BY_SPLIT_SQL} SELECT model, {_METRIC_OUT} FROM split_metrics WHERE split = 'test'",
    "ablation_delta": f"""WITH {TXN}, {BY_SPLIT_SQL},
m AS (SELECT model, round(f1, 9) AS f1, round(pr_auc, 9) AS pr_auc FROM split_metrics WHERE split = 'test')
SELECT 'Base scores -> Graph scores' AS comparison, round(g.f1 - b.f1, 9) AS delta_f1, round(g.pr_auc - b.pr_auc, 9) AS delta_pr_auc,
  b.pr_auc AS base_pr_auc, g.pr_auc AS enhanced_pr_auc FROM m b, m g
WHERE b.model = 'Base scores' AND g.model = 'Graph scores'""",
    "metrics_long": f"""WITH {TXN}, {BY_SPLIT_SQL}
SELECT model, 'PR-AUC' AS metric, round(pr_auc, 9) AS score FROM split_metrics WHERE split = 'test'
UNION ALL SELECT model, 'F1', round(f1, 9) FROM split_metrics WHERE split = 'test'""",
    "threshold_sweep": _SWEEP_SQL,
    "natural_evaluation": _NATURAL_EVAL_SQL,
    "alert_queue": f"WITH {TXN} SELECT row_key, score, is_laundering FROM txn ORDER BY score DESC, row_key LIMIT {BUDGET}",
    "score_quantiles": f"""WITH {TXN}, q AS (SELECT [{', '.join(f'CAST({p} AS DOUBLE)' for p in QUANTILES)}] AS ps)
SELECT unnest(ps) AS p, round(unnest((SELECT quantile_cont(score, [{', '.join(map(str, QUANTILES))}]) FROM txn)), 9) AS quantile FROM q""",
    "paired_bootstrap": _BOOTSTRAP_SQL + f"SELECT replicate, {_round_sql(['base_pr_auc', 'enhanced_pr_auc', 'delta'])} FROM deltas",
    "bootstrap_interval": _BOOTSTRAP_SQL
    + """SELECT round(quantile_cont(delta, 0.025), 9) AS ci_lower_95, round(quantile_cont(delta, 0.975), 9) AS ci_upper_95,
  count(*) AS bootstrap_resamples FROM deltas""",
    "candidate_rank": _CANDIDATE_SQL,
    "log_upsert": _LOG_SQL,
    "dummy_baseline": f"""WITH {TXN}, zero AS (SELECT is_laundering, CAST(0 AS DOUBLE) AS score, CAST(0.5 AS DOUBLE) AS threshold FROM txn),
{points_sql('zero')}, counts AS (SELECT threshold, {_COUNTS} FROM zero GROUP BY threshold)
SELECT 'dummy' AS model, {_METRIC_OUT} FROM (SELECT *, {_RATES} FROM counts),
  (SELECT {AP} AS pr_auc, {AUC} AS roc_auc FROM points)""",
}
