"""Rare-event metrics over a scored table (label, score, optional group columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.functions import columns as C
from flowsieve.operators.cumulative import quantiles, running, value_counts

# Fixed values of the alert sweep.
SWEEP_THRESHOLDS = [0.95, 0.98, 0.99, 0.995, 0.999]
SWEEP_ALERT_RATES = [0.10, 0.05, 0.02, 0.01, 0.005, 0.001]
CONFUSION = ["tn", "fp", "fn", "tp"]


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def alerts(score: Column, threshold) -> Column:
    return (score >= threshold).cast("int")


def operating_points(
    scored: DataFrame, groups: list[str] = (), score: str = "score", label: str = "is_laundering",
    weight: Column | None = None, leads: bool = False, **options,
) -> DataFrame:
    """One row per distinct score with tp and fp of alerting at that score, and the class totals."""
    groups = list(groups)
    w = F.lit(1) if weight is None else weight
    counts = value_counts(
        scored, groups, score, {"pos": F.col(label) * w, "neg": (F.lit(1) - F.col(label)) * w}
    ).filter((F.col("pos") > 0) | (F.col("neg") > 0))
    points = running(counts, groups, score, ["pos", "neg"], descending=True, leads=leads, **options)
    return points.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})


def confusion_counts(
    scored: DataFrame, threshold, groups: list[str] = (), score: str = "score", label: str = "is_laundering"
) -> DataFrame:
    """tn, fp, fn, tp in one combined aggregate; ``threshold`` is a number or a column."""
    hit = F.col(score) >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    positive = F.col(label) == 1
    return scored.groupBy(*groups).agg(
        F.count_if(~hit & ~positive).alias("tn"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(hit & positive).alias("tp"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from the four counts; division by zero gives 0."""
    tn, fp, fn, tp = (_double(c) for c in CONFUSION)
    return counts.withColumns(
        {
            "accuracy": C.safe_ratio(tp + tn, tp + tn + fp + fn),
            "precision": C.safe_ratio(tp, tp + fp),
            "recall": C.safe_ratio(tp, tp + fn),
            "f1": C.safe_ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def average_precision_of(points: DataFrame, groups: list[str] = ()) -> DataFrame:
    """Step-wise average precision: recall gained at every score times the precision there."""
    step = _double("pos") / _double("total_pos") * _double("tp") / (_double("tp") + _double("fp"))
    gained = F.when(F.col("total_pos") > 0, step).otherwise(F.lit(0.0))
    return points.groupBy(*groups).agg(F.coalesce(F.sum(gained), F.lit(0.0)).alias("pr_auc"))


def roc_auc_of(points: DataFrame, groups: list[str] = ()) -> DataFrame:
    """Share of positive-negative pairs ranked right, ties counted half; NULL with a single class."""
    below = 2 * (_double("total_neg") - _double("fp")) + _double("neg")
    wins = F.sum(_double("pos") * below)
    pairs = 2 * F.max(_double("total_pos")) * F.max(_double("total_neg"))
    return points.groupBy(*groups).agg(F.try_divide(wins, pairs).alias("roc_auc"))


def ranking_metrics(
    scored: DataFrame, groups: list[str] = (), score: str = "score", label: str = "is_laundering", **options
) -> DataFrame:
    """Average precision and ROC-AUC from one pass over the operating points."""
    points = operating_points(scored, groups, score, label, **options)
    step = _double("pos") / _double("total_pos") * _double("tp") / (_double("tp") + _double("fp"))
    below = 2 * (_double("total_neg") - _double("fp")) + _double("neg")
    return points.groupBy(*groups).agg(
        F.coalesce(F.sum(F.when(F.col("total_pos") > 0, step)), F.lit(0.0)).alias("pr_auc"),
        F.try_divide(
            F.sum(_double("pos") * below), 2 * F.max(_double("total_pos")) * F.max(_double("total_neg"))
        ).alias("roc_auc"),
    )


def pr_curve(scored: DataFrame, groups: list[str] = (), score: str = "score", label: str = "is_laundering") -> DataFrame:
    """Precision and recall at every distinct score, closed by the point (precision 1, recall 0)."""
    groups = list(groups)
    points = operating_points(scored, groups, score, label)
    curve = points.select(
        *groups,
        F.col(score).alias("threshold"),
        (_double("tp") / (_double("tp") + _double("fp"))).alias("precision"),
        C.safe_ratio(_double("tp"), _double("total_pos")).alias("recall"),
    )
    if groups:
        ends = points.select(*groups).distinct()
    else:
        ends = points.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    closing = ends.select(
        *groups, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(closing)


def roc_curve(scored: DataFrame, groups: list[str] = (), score: str = "score", label: str = "is_laundering") -> DataFrame:
    """False against true positive rate with collinear points dropped, opened by the point (0, 0)."""
    groups = list(groups)
    points = operating_points(scored, groups, score, label, leads=True)
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    last = F.col("next_pos").isNull()
    bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    curve = points.filter(first | last | bends).select(
        *groups,
        F.col(score).alias("threshold"),
        C.safe_ratio(_double("fp"), _double("total_neg")).alias("fpr"),
        C.safe_ratio(_double("tp"), _double("total_pos")).alias("tpr"),
    )
    if groups:
        starts = points.select(*groups).distinct()
    else:
        starts = points.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    opening = starts.select(
        *groups, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(opening)


def best_f1_of(points: DataFrame, groups: list[str] = (), score: str = "score") -> DataFrame:
    """Threshold with the best F1, the lowest one on ties; 0.5 when there is nothing to choose from."""
    f1 = C.safe_ratio(2 * _double("tp"), _double("tp") + _double("fp") + _double("total_pos"))
    best = F.max(F.struct(f1.alias("f1"), (-F.col(score)).alias("minus"))).alias("best")
    return points.groupBy(*groups).agg(best).select(
        *groups,
        F.coalesce(-F.col("best.minus"), F.lit(0.5)).alias("threshold"),
        F.coalesce("best.f1", F.lit(0.0)).alias("f1"),
    )


def best_f1_threshold(
    scored: DataFrame, groups: list[str] = (), score: str = "score", label: str = "is_laundering"
) -> DataFrame:
    return best_f1_of(operating_points(scored, groups, score, label), groups, score)


def metrics_table(
    scored: DataFrame, thresholds: DataFrame | float, groups: list[str], score: str = "score", label: str = "is_laundering"
) -> DataFrame:
    """Counts, rates, PR-AUC and ROC-AUC per group.

    ``thresholds`` is one number, or a small table with some of the group columns and ``threshold``.
    """
    if isinstance(thresholds, DataFrame):
        keys = [c for c in thresholds.columns if c in groups]
        chosen = scored.join(F.broadcast(thresholds.select(*keys, "threshold")), keys)
    else:
        chosen = scored.withColumn("threshold", F.lit(float(thresholds)))
    counts = confusion_counts(chosen, F.col("threshold"), [*groups, "threshold"], score, label)
    return with_rates(counts).join(F.broadcast(ranking_metrics(scored, groups, score, label)), groups)


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of both classes from the four counts."""
    tn, fp, fn, tp = (F.col(c) for c in CONFUSION)
    keep = [c for c in counts.columns if c not in CONFUSION]
    classes = F.array(
        F.struct(F.lit(1).alias("class"), tp.alias("hit"), fp.alias("wrong"), fn.alias("missed")),
        F.struct(F.lit(0).alias("class"), tn.alias("hit"), fn.alias("wrong"), fp.alias("missed")),
    )
    hit, wrong, missed = _double("hit"), _double("wrong"), _double("missed")
    return counts.select(*keep, F.inline(classes)).select(
        *keep,
        "class",
        C.safe_ratio(hit, hit + wrong).alias("precision"),
        C.safe_ratio(hit, hit + missed).alias("recall"),
        C.safe_ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
        (F.col("hit") + F.col("missed")).alias("support"),
    )


def threshold_sweep(
    scored: DataFrame,
    threshold: float,
    score: str = "score",
    label: str = "is_laundering",
    fixed: list[float] = SWEEP_THRESHOLDS,
    alert_rates: list[float] = SWEEP_ALERT_RATES,
) -> DataFrame:
    """Counts and rates at the given, the fixed and the alert-budget thresholds (rounded, distinct).

    A dozen thresholds at most: they are literals, and every distinct score is compared with all of them
    before one combined sum per threshold.
    """
    budgets = quantiles(scored, [], score, [1 - r for r in alert_rates])
    cuts = {round(float(t), 10) for t in [threshold, *fixed]}
    cuts |= {r["t"] for r in budgets.select(F.round("quantile", 10).alias("t")).collect()}
    counts = value_counts(scored, [], score, {"pos": F.col(label), "neg": F.lit(1) - F.col(label)})
    swept = counts.select(
        score, "pos", "neg", F.explode(F.array(*[F.lit(t) for t in sorted(cuts)])).alias("threshold")
    )
    hit = F.col(score) >= F.col("threshold")

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col(name)).otherwise(F.lit(0))).cast("long")

    table = swept.groupBy("threshold").agg(
        total(~hit, "neg").alias("tn"), total(hit, "neg").alias("fp"),
        total(~hit, "pos").alias("fn"), total(hit, "pos").alias("tp"),
    )
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return with_rates(table).select(
        "threshold",
        ((F.col("fp") + F.col("tp")) / n).alias("alert_rate"),
        (F.col("fp") + F.col("tp")).alias("alerts"),
        (F.lit(10000.0) * (F.col("fp") + F.col("tp")) / n).alias("alerts_per_10k"),
        "precision", "recall", "f1", *CONFUSION,
    ).orderBy("threshold")


def alert_queue(scored: DataFrame, budget: int, key: str, score: str = "score") -> DataFrame:
    """The ``budget`` highest scores, a top-k report; equal scores are ordered by key."""
    return scored.orderBy(F.desc(score), key).limit(budget)


def split_audit(df: DataFrame, split: str = "split", label: str = "is_laundering") -> DataFrame:
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).cast("long").alias("positive_rows"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )
