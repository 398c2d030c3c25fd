"""Small result tables: leaderboards, deltas, long form, experiment log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.functions import columns as C

METRIC_NAMES = {"pr_auc": "PR-AUC", "f1": "F1"}


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("f1"), F.desc("pr_auc"), "model")


def candidate_ranks(fold_scores: DataFrame, keys: list[str], within: list[str], score: str = "pr_auc") -> DataFrame:
    """Mean and population deviation over folds per candidate, and its rank inside ``within`` (ties share the best)."""
    table = fold_scores.groupBy(*keys).agg(
        F.avg(score).alias(f"mean_{score}"), F.stddev_pop(score).alias(f"std_{score}")
    )
    order = Window.partitionBy(*within).orderBy(F.desc(F.round(f"mean_{score}", 12)))
    return table.withColumn("rank", F.rank().over(order))


def ablation_delta(metrics: DataFrame, key: str, base: str, enhanced: str) -> DataFrame:
    """Gain of ``enhanced`` over ``base``: metric rows side by side."""
    wide = metrics.groupBy().pivot(key, [base, enhanced]).agg(
        F.first("f1").alias("f1"), F.first("pr_auc").alias("pr_auc")
    )
    c = lambda model, metric: F.col(f"`{model}_{metric}`")
    return wide.select(
        F.lit(f"{base} -> {enhanced}").alias("comparison"),
        (c(enhanced, "f1") - c(base, "f1")).alias("delta_f1"),
        (c(enhanced, "pr_auc") - c(base, "pr_auc")).alias("delta_pr_auc"),
        c(base, "pr_auc").alias("base_pr_auc"),
        c(enhanced, "pr_auc").alias("enhanced_pr_auc"),
    )


def metrics_long(metrics: DataFrame, keys: list[str], names: dict[str, str] = METRIC_NAMES) -> DataFrame:
    """One row per key and metric, metric names spelled out."""
    long = metrics.unpivot(keys, list(names), "metric", "score")
    return long.withColumn("metric", C.relabel(F.col("metric"), names))


def log_upsert(existing: DataFrame, new: DataFrame, key: str = "stage") -> DataFrame:
    """Experiment log with re-issued stages replaced."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def top_k(table: DataFrame, value: str, k: int, tie: str) -> DataFrame:
    return table.orderBy(F.desc(value), tie).limit(k)
