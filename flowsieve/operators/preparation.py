"""Feature preparation: imputation, scaling, one-hot encoding, mutual information.

Everything is fitted with combined aggregates; only the fitted figures (a few numbers per feature and the
frequent categories) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.functions import columns as C
from flowsieve.operators.cumulative import column_quantiles

MIN_CATEGORY_ROWS = 20
MAX_CATEGORIES = 10_000
INFREQUENT = "infrequent"


def medians(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Exact median per column: columns ``feature``, ``value``."""
    return column_quantiles(df, numeric, [0.5]).select("feature", F.col("quantile").alias("value"))


def category_counts(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Rows per column and value, combined map-side: columns ``feature``, ``value``, ``n``."""
    return df.unpivot([], categorical, "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Most frequent known value per column, the smallest one on ties."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("value").alias("value")))
    known = category_counts(df, categorical).filter(F.col("value").isNotNull())
    return known.groupBy("feature").agg(best.alias("best")).select("feature", F.col("best.value").alias("value"))


@dataclass
class Preparation:
    """Fitted figures: medians, means, deviations, modes and frequent categories of a training table."""

    numeric: list[str]
    categorical: list[str]
    median: dict[str, float] = field(default_factory=dict)
    mean: dict[str, float] = field(default_factory=dict)
    deviation: dict[str, float] = field(default_factory=dict)
    mode: dict[str, str] = field(default_factory=dict)
    frequent: dict[str, list[str]] = field(default_factory=dict)
    rare: dict[str, list[str]] = field(default_factory=dict)

    def filled(self, name: str) -> Column:
        return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(None)), F.lit(self.median[name]))

    def scaled(self, name: str) -> Column:
        """Standardised with the population deviation; a constant column is only centred."""
        return (self.filled(name) - F.lit(self.mean[name])) / F.lit(self.deviation[name] or 1.0)

    def category(self, name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(self.mode.get(name)))

    def encoded(self) -> dict[str, Column]:
        """Every encoded feature by name; an unknown category is zero in all columns of its feature."""
        out = {f"num__{c}": self.scaled(c) for c in self.numeric}
        for c in self.categorical:
            value = self.category(c)
            for known in self.frequent.get(c, []):
                out[f"cat__{c}_{known}"] = F.coalesce(value == F.lit(known), F.lit(False)).cast("double")
            if self.rare.get(c):
                out[f"cat__{c}_{INFREQUENT}"] = F.coalesce(value.isin(self.rare[c]), F.lit(False)).cast("double")
        return out

    def names(self) -> list[str]:
        return list(self.encoded())

    def transform(self, df: DataFrame, only: list[str] | None = None, column: str = "features") -> DataFrame:
        """``df`` plus the feature vector (all features or the named ones, in that order)."""
        encoded = self.encoded()
        return df.withColumn(column, array_to_vector(F.array(*[encoded[n] for n in only or encoded])))


def fit_preparation(
    df: DataFrame, numeric: list[str], categorical: list[str], min_rows: int = MIN_CATEGORY_ROWS
) -> Preparation:
    """Fit on ``df`` (the training rows)."""
    fitted = Preparation(list(numeric), list(categorical))
    if numeric:
        fitted.median = {r["feature"]: r["value"] for r in medians(df, fitted.numeric).collect()}
        for c in numeric:
            fitted.median.setdefault(c, 0.0)
        figures = df.agg(
            *[F.avg(fitted.filled(c)).alias(f"m{i}") for i, c in enumerate(numeric)],
            *[F.stddev_pop(fitted.filled(c)).alias(f"d{i}") for i, c in enumerate(numeric)],
        ).first()
        fitted.mean = {c: figures[f"m{i}"] or 0.0 for i, c in enumerate(numeric)}
        fitted.deviation = {c: figures[f"d{i}"] or 0.0 for i, c in enumerate(numeric)}
    if categorical:
        counts = category_counts(df, fitted.categorical).limit(MAX_CATEGORIES + 1).collect()
        if len(counts) > MAX_CATEGORIES:
            raise ValueError(f"more than {MAX_CATEGORIES} categories: not a one-hot feature")
        for c in categorical:
            rows = {r["value"]: r["n"] for r in counts if r["feature"] == c}
            missing = rows.pop(None, 0)
            if rows:
                fitted.mode[c] = min(rows, key=lambda v: (-rows[v], v))
                rows[fitted.mode[c]] += missing
            fitted.frequent[c] = sorted(v for v, n in rows.items() if n >= min_rows)
            fitted.rare[c] = sorted(v for v, n in rows.items() if n < min_rows)
    return fitted


def category_cells(df: DataFrame, fitted: Preparation, label: str = "is_laundering") -> DataFrame:
    """Rows per encoded category, yes/no (``bin`` 1 or 0) and label: columns ``feature``, ``bin``, ``y``, ``n``.

    Every category is counted once per label; what has another category is the rest. Some column must have a category.
    """
    names = [c for c in fitted.categorical if fitted.frequent[c] or fitted.rare[c]]
    kinds = df.select(F.col(label).cast("long").alias("y"), *[fitted.category(c).alias(c) for c in names])
    counted = kinds.unpivot(["y"], names, "column", "value").groupBy("column", "value", "y").agg(F.count(F.lit(1)).alias("n"))
    frequent, rare = (
        F.create_map(*[x for c in names for x in (F.lit(c), F.array(*[F.lit(v) for v in known[c]]).cast("array<string>"))])
        for known in (fitted.frequent, fitted.rare)
    )
    own = F.when(F.array_contains(frequent[F.col("column")], F.col("value")), F.col("value")).when(
        F.array_contains(rare[F.col("column")], F.col("value")), F.lit(INFREQUENT)
    )
    known = counted.withColumn("own", F.concat(F.lit("cat__"), "column", F.lit("_"), own))
    hits = known.filter("own IS NOT NULL").groupBy(F.col("own").alias("feature"), "y").agg(F.sum("n").alias("n"))
    labels = known.filter(F.col("column") == names[0]).groupBy("y").agg(F.sum("n").alias("total"))
    every = hits.select("feature").distinct().join(F.broadcast(labels), how="cross")  # features x classes rows
    both = every.join(hits, ["feature", "y"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    cells = F.array(*[F.struct(F.lit(b).cast("long").alias("bin"), x.cast("long").alias("n")) for b, x in ((1, F.col("n")), (0, F.col("total") - F.col("n")))])
    return both.select("feature", "y", F.inline(cells)).filter("n > 0").select("feature", "bin", "y", "n")


def mutual_information(
    df: DataFrame, numeric: list[str], categorical: list[str], label: str = "is_laundering", bins: int = 16
) -> DataFrame:
    """Mutual information (nats) of every feature with the label, from quantile bins.

    Numeric features are cut at their exact quantiles; every category is one yes/no feature. One pass counts the bins of
    all numeric features by binary search, one the categories. This is a binned estimate, not a nearest-neighbour one.
    """
    fitted = fit_preparation(df, [], categorical)
    cuts: dict[str, list[float]] = {c: [] for c in numeric}
    for r in column_quantiles(df, numeric, [i / bins for i in range(1, bins)]).collect() if numeric else []:
        cuts[r["feature"]].append(r["quantile"])
    numbers = df.select(F.col(label).cast("long").alias("y"), *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{k}") for k, c in enumerate(numeric)])
    edges = [np.array(sorted(set(cuts[c])), float) for c in numeric]
    binned = numbers.mapInArrow(_bin_counts(edges), "feature int, bin long, y long, n long")
    named = F.array(*[F.lit(f"num__{c}") for c in numeric])
    parts = [binned.groupBy("feature", "bin", "y").agg(F.sum("n").alias("n")).withColumn("feature", named[F.col("feature")])] if numeric else []
    if any(fitted.frequent[c] or fitted.rare[c] for c in categorical):
        parts.append(category_cells(df, fitted, label).select("feature", "bin", "y", "n"))
    counts = reduce(DataFrame.unionByName, parts)
    # features x bins x classes rows from here on
    by_feature = Window.partitionBy("feature")
    n = F.col("n").cast("double")
    total = F.sum("n").over(by_feature).cast("double")
    of_bin = F.sum("n").over(Window.partitionBy("feature", "bin")).cast("double")
    of_label = F.sum("n").over(Window.partitionBy("feature", "y")).cast("double")
    term = n / total * F.log(n * total / (of_bin * of_label))
    return (
        counts.select("feature", term.alias("term"))
        .groupBy("feature")
        .agg(F.greatest(F.sum("term"), F.lit(0.0)).alias("mutual_information"))
    )


def _bin_counts(edges: list[np.ndarray]):
    """Function for Arrow batches of (label, columns): rows per column, bin and label of a task; missing values are bin -1."""

    def run(batches):
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for label in np.unique(y).tolist():
                mine = found.setdefault(label, [np.zeros(len(e) + 2, np.int64) for e in edges])
                at = np.flatnonzero(y == label)
                for k, e in enumerate(edges):
                    x = batch.column(k + 1).to_numpy(zero_copy_only=False)[at]
                    slot = np.where(np.isnan(x), -1, np.searchsorted(e, x, "left"))
                    mine[k] += np.bincount(slot + 1, minlength=len(e) + 2)
        rows = [(k, b - 1, y, n) for y, tables in found.items() for k, t in enumerate(tables) for b, n in enumerate(t.tolist()) if n]
        kinds = pa.int32(), pa.int64(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["feature", "bin", "y", "n"]
        )

    return run


def clean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing and infinite values become 0."""
    return df.withColumns({c: C.finite_or_zero(F.col(c).cast("double")) for c in columns})
