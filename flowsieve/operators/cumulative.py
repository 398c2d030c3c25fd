"""Running totals over distinct values, exact quantiles.

Rows are combined per distinct value first. When a group still has many distinct values, they are cut at
approximate quantiles into slices, and the window runs inside a slice with the earlier slices' totals added.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.session import lookup_join, written

#: Distinct values of one group that a single window partition may hold.
SLICE_ROWS = 1_000_000
SLICES = 256


def value_counts(df: DataFrame, groups: list[str], value: str, sums: dict[str, Column]) -> DataFrame:
    return df.groupBy(*groups, value).agg(*[F.sum(x).cast("long").alias(name) for name, x in sums.items()])


def _slice_bounds(counts: DataFrame, groups: list[str], value: str, slices: int) -> DataFrame:
    probabilities = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    bounds = counts.groupBy(*groups).agg(F.percentile_approx(value, probabilities, 10_000).alias("_bounds"))
    # Written once: every later use must cut at the same values.
    return written(bounds, "slice-bounds")


def running(
    counts: DataFrame,
    groups: list[str],
    value: str,
    sums: list[str],
    descending: bool = False,
    leads: bool = False,
    slice_rows: int = SLICE_ROWS,
    slices: int = SLICES,
) -> DataFrame:
    """Add ``cum_<c>`` (up to and including the value) and ``total_<c>`` per group.

    ``leads`` adds ``next_<c>``, the figure of the next distinct value (NULL on the last one).
    ``counts`` has one row per group and value.
    """
    # Far smaller than the rows behind it, and needed more than once.
    counts = written(counts, "value-counts")
    order = F.desc(value) if descending else F.asc(value)
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    ordered = whole.orderBy(order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    # One figure decides the plan: the largest number of distinct values in a group.
    largest = counts.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= slice_rows:
        return counts.select(
            "*",
            *[F.sum(c).over(upto).alias(f"cum_{c}") for c in sums],
            *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
            *([F.lead(c).over(ordered).alias(f"next_{c}") for c in sums] if leads else []),
        )

    slices = max(slices, 2 * -(-largest // slice_rows))  # a slice stays below the bound however many values there are
    bounds = _slice_bounds(counts, groups, value, slices)
    joined = counts.join(F.broadcast(bounds), groups) if groups else counts.withColumn("_bounds", bounds.scalar())
    number = F.size(F.filter("_bounds", lambda b: b < F.col(value)))
    sliced = joined.withColumn("_slice", -number if descending else number).drop("_bounds")
    part = Window.partitionBy(*groups, "_slice")
    inside = part.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    figures = F.struct(*sums)
    first = F.max_by if descending else F.min_by
    slice_totals = sliced.groupBy(*groups, "_slice").agg(
        *[F.sum(c).alias(c) for c in sums], first(figures, F.col(value)).alias("_head")
    )
    # At most slices rows per group from here on.
    along = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_slice")
    offsets = slice_totals.select(
        *groups,
        "_slice",
        *[(F.sum(c).over(along) - F.col(c)).alias(f"_offset_{c}") for c in sums],
        *[F.sum(c).over(Window.partitionBy(*(groups or [F.lit(0)]))).alias(f"total_{c}") for c in sums],
        F.lead("_head").over(along).alias("_next_head"),
    )
    local = sliced.select(
        "*",
        *[F.sum(c).over(inside).alias(f"cum_{c}") for c in sums],
        *([F.lead(c).over(part.orderBy(order)).alias(f"next_{c}") for c in sums] if leads else []),
    )
    out = local.join(F.broadcast(offsets), [*groups, "_slice"])
    return out.select(
        *counts.columns,
        *[(F.col(f"cum_{c}") + F.col(f"_offset_{c}")).alias(f"cum_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
        *([F.coalesce(f"next_{c}", F.col(f"_next_head.{c}")).alias(f"next_{c}") for c in sums] if leads else []),
    )


def quantiles(
    df: DataFrame, groups: list[str], value: str, probabilities: list[float], small: int = 5_000, margin: float = 1e-3, **options
) -> DataFrame:
    """Exact quantiles with linear interpolation: columns groups, ``p``, ``quantile``.

    An approximate pass puts every wanted place between two values. One more pass counts the rows below each
    bracket and keeps the values inside, a few percent of them; only those are shuffled and ranked. The sketch
    behind the brackets errs by a tenth of ``margin`` at most. Groups of up to ``small`` rows are kept whole.
    """
    asked = sorted({float(p) for p in probabilities})
    known = df.filter(F.col(value).isNotNull()).select(*groups, value)
    keys = list(groups)
    if not keys:
        keys, known = ["_all"], known.withColumn("_all", F.lit(0))
    infinite = {-1: F.lit(float("-inf")), 1: F.lit(float("inf"))}

    def edge(sign: int) -> Column:
        at = [min(1.0, max(0.0, p + sign * margin)) for p in asked]
        found = F.percentile_approx(value, F.array(*[F.lit(q) for q in at]), int(10 / margin))
        open_ended = [q in (0.0, 1.0) for q in at]
        return F.array(
            *[
                F.when(F.lit(o) | (F.count(F.lit(1)) <= small), infinite[sign]).otherwise(found[i].cast("double"))
                for i, o in enumerate(open_ended)
            ]
        )

    # Written once: both later uses must cut at the same values.
    brackets = written(
        known.groupBy(*keys).agg(edge(-1).alias("_lo"), edge(1).alias("_hi"), F.count(F.lit(1)).alias("total_n")), "brackets"
    )
    rows = lookup_join(known, brackets, keys)
    x = F.col(value).cast("double")
    below = rows.groupBy(*keys).agg(
        *[F.count_if(x < F.col("_lo")[i]).alias(f"_b{i}") for i in range(len(asked))], F.first("total_n").alias("total_n")
    )
    below = written(below, "below")
    inside = reduce(lambda a, b: a | b, [(x >= F.col("_lo")[i]) & (x <= F.col("_hi")[i]) for i in range(len(asked))])
    which = F.array(*[F.when((x >= F.col("_lo")[i]) & (x <= F.col("_hi")[i]), F.lit(i)) for i in range(len(asked))])
    counts = (
        rows.filter(inside)
        .groupBy(*keys, value)
        .agg(F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), F.count(F.lit(1)).alias("n"))
        .select(*keys, value, "n", F.explode(F.array_compact(which)).alias("_i"))
    )
    return _picked(counts, below, keys, value, asked, **options).select(*groups, "p", "quantile")


def _picked(counts: DataFrame, below: DataFrame, keys: list[str], value: str, asked: list[float], **options) -> DataFrame:
    """Quantiles (keys, p, quantile) from the values near every asked place.

    ``counts`` (keys, value, n, _i) are the rows per value inside bracket ``_i``; ``below`` has per key the rows under
    each bracket (``_b0``, ...) and in all (``total_n``).
    """
    steps = lookup_join(running(counts, [*keys, "_i"], value, ["n"], **options).drop("total_n"), below, keys)
    base = F.array(*[F.col(f"_b{i}") for i in range(len(asked))])[F.col("_i")]
    steps = steps.withColumns(
        {"_from": base + F.col("cum_n") - F.col("n"), "_to": base + F.col("cum_n"), "p": F.array(*[F.lit(p) for p in asked])[F.col("_i")]}
    )
    place = (F.col("total_n") - 1) * F.col("p")

    def holds(k: Column) -> Column:
        return (F.col("_from") <= k) & (k < F.col("_to"))

    picked = (
        steps.filter(holds(F.floor(place)) | holds(F.ceil(place)))
        .groupBy(*keys, "p", place.alias("place"))
        .agg(
            F.max(F.when(holds(F.floor(place)), F.col(value))).alias("low"),
            F.max(F.when(holds(F.ceil(place)), F.col(value))).alias("high"),
        )
    )
    share = F.col("place") - F.floor("place")
    return picked.select(*keys, "p", (F.col("low") + (F.col("high") - F.col("low")) * share).alias("quantile"))


def column_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], sketch: int = 2_000, margin: float = 0.005, **options
) -> DataFrame:
    """Exact quantiles of many numeric columns, with linear interpolation: columns ``feature``, ``p``, ``quantile``.

    Two scans. The first merges one quantile sketch per column; with them every asked place lies between two values,
    ``margin`` of the rows apart on either side. The second sorts each column batch by batch, counts what is below
    the brackets by binary search and keeps the values inside, once each with their number. A sketch errs with some
    probability: the counts show it, and then the brackets are widened. Missing values and NaN are left out.
    """
    asked = sorted({float(p) for p in probabilities})
    spark, names = df.sparkSession, list(columns)
    rows = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{k}") for k, c in enumerate(names)])
    sketches = rows.agg(*[F.kll_sketch_agg_double(f"c{k}", F.lit(sketch)).alias(f"c{k}") for k in range(len(names))])
    sketches = written(sketches, "sketches")
    while True:
        at = [min(1.0, max(0.0, p + sign * margin)) for p in asked for sign in (-1, 1)]
        known = [F.kll_sketch_get_n_double(f"c{k}") > 0 for k in range(len(names))]
        ranks = F.array(*[F.lit(q) for q in at])
        edges = sketches.select(
            *[F.when(has, F.kll_sketch_get_quantile_double(f"c{k}", ranks)).alias(f"c{k}") for k, has in enumerate(known)]
        ).first()
        low = np.array([(e or [0.0] * len(at))[0::2] for e in edges], float)
        high = np.array([(e or [0.0] * len(at))[1::2] for e in edges], float)
        low[:, np.array(at[0::2]) == 0.0], high[:, np.array(at[1::2]) == 1.0] = -np.inf, np.inf
        found = written(rows.mapInArrow(_near_places(low, high), "feature int, i int, kind int, value double, n long"), "near-places")
        figures = found.filter("kind > 0").groupBy("feature", "i", "kind").agg(F.sum("n").alias("n")).collect()
        n = {(r["feature"], r["i"], r["kind"]): r["n"] for r in figures}
        total = [n.get((k, 0, _TOTAL), 0) for k in range(len(names))]
        missed = False
        for k in range(len(names)):
            for i, p in enumerate(asked):
                place, under = (total[k] - 1) * p, n.get((k, i, _BELOW), 0)
                missed |= total[k] > 0 and not under <= np.floor(place) <= np.ceil(place) < under + n.get((k, i, _INSIDE), 0)
        if not missed:
            break
        margin *= 4
    below = spark.createDataFrame(
        [(k, *[n.get((k, i, _BELOW), 0) for i in range(len(asked))], total[k]) for k in range(len(names))],
        ", ".join(["feature int", *[f"_b{i} long" for i in range(len(asked))], "total_n long"]),
    )
    counts = found.filter("kind = 0").groupBy("feature", F.col("i").alias("_i"), "value").agg(F.sum("n").alias("n"))
    named = F.array(*[F.lit(c) for c in names])
    picked = _picked(counts, below, ["feature"], "value", asked, **options)
    return picked.select(named[F.col("feature")].alias("feature"), "p", "quantile")


_TOTAL, _BELOW, _INSIDE = 1, 2, 3


def _near_places(low: np.ndarray, high: np.ndarray):
    """Function for Arrow batches: per column and bracket, values inside (kind 0), and at the end the rows under it,
    inside it, and in all."""
    features, places = low.shape

    def run(batches):
        under, inside, total = np.zeros((features, places), np.int64), np.zeros((features, places), np.int64), np.zeros(features, np.int64)
        for batch in batches:
            parts = []
            for k in range(features):
                x = np.sort(batch.column(k).drop_null().to_numpy(zero_copy_only=False))
                total[k] += len(x)
                first, last = np.searchsorted(x, low[k], "left"), np.searchsorted(x, high[k], "right")
                under[k] += first
                inside[k] += last - first
                for i in np.flatnonzero(last > first).tolist():
                    value, n = np.unique(x[first[i] : last[i]], return_counts=True)
                    parts.append((np.full(len(value), k), np.full(len(value), i), np.zeros(len(value)), value, n))
            if parts:
                yield _places(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        k, i = np.divmod(np.arange(features * places), places)
        for kind, n in ((_BELOW, under), (_INSIDE, inside)):
            yield _places(k, i, np.full(len(k), kind), np.zeros(len(k)), n.ravel())
        yield _places(np.arange(features), np.zeros(features), np.full(features, _TOTAL), np.zeros(features), total)

    return run


def _places(feature, i, kind, value, n) -> pa.RecordBatch:
    whole = [pa.array(np.asarray(c, np.int32)) for c in (feature, i, kind)]
    return pa.RecordBatch.from_arrays(
        [*whole, pa.array(np.asarray(value, float)), pa.array(np.asarray(n, np.int64))],
        names=["feature", "i", "kind", "value", "n"],
    )
