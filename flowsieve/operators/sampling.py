"""Keyed sampling and exact splits.

A draw is a hash of the row key, so a sample is the same under any partitioning. Exact sizes come from a
cutoff: counts per bucket of the order (hash prefix or minute) locate the bucket that holds the wanted
rank, its rows are counted by ever finer digits until few are left to rank, and the rows are then selected by
a plain comparison - no shuffle of the table and no global sort.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.functions import columns as C
from flowsieve.session import written

MAX_GROUPS = 10_000
#: A boundary bucket with more rows is counted by its next digits before it is ranked.
BOUNDARY_ROWS = 100_000
_PICKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("target", T.IntegerType()),
            T.StructField("size", T.LongType()),
            T.StructField("rank", T.LongType()),
            T.StructField("place", T.LongType()),
        ]
    )
)
SPLIT_SEED = 42
VALIDATION_SEED = 43
FOLD_SEED = 44


@dataclass(frozen=True)
class Cutoff:
    """The row at rank ``rank`` of ``group``; ``values`` are its order columns (None: no row is kept)."""

    group: object
    target: int
    size: int
    rank: int
    values: tuple | None


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Join with a short broadcast table; missing values meet."""
    table = right.select(*[F.col(c).alias(f"_{c}") for c in names], *[c for c in right.columns if c not in names])
    match = reduce(Column.__and__, [left[c].eqNullSafe(table[f"_{c}"]) for c in names])
    return left.join(F.broadcast(table), match).drop(*[f"_{c}" for c in names])


def digits(df: DataFrame, name: str) -> list[Column]:
    """Levels of a column from coarse to fine that order rows as the column does; none for types without digits."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return [F.substring(name, 1 + 2 * i, 2) for i in range(16)]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return [F.shiftright(F.col(name).cast("long"), bits) for bits in (48, 32, 16, 0)]
    return []


def rank_cutoffs(
    df: DataFrame,
    levels: list[Column],
    order: list[Column],
    ranks: list[Callable[[Column], Column]],
    group: Column | None = None,
    boundary_rows: int = BOUNDARY_ROWS,
) -> list[Cutoff]:
    """Row at each wanted rank (1-based, by ``order``) per group.

    Radix selection: rows are counted by the first of ``levels``, then only the rows of the boundary buckets by the
    next one, until a bucket has at most ``boundary_rows`` rows or no level is left; that bucket is ranked. The levels
    together must not decrease along ``order``. ``ranks`` map the group size to a rank; 0 keeps nothing and a rank
    beyond the size keeps all. The driver receives one row per group, rank and round.
    """
    names = [f"b{i}" for i in range(len(levels))]
    inside = df.select(
        (F.lit(0) if group is None else group).alias("g"),
        *[c.alias(n) for c, n in zip(levels, names)],
        *[o.alias(f"o{i}") for i, o in enumerate(order)],
    )
    spark = df.sparkSession
    most = MAX_GROUPS * len(ranks)
    figures = "array<struct<target:int,size:bigint,rank:bigint,place:bigint>>"
    wanted = F.array(
        *[F.struct(F.lit(i).alias("target"), r(F.col("size")).cast("long").alias("rank")) for i, r in enumerate(ranks)]
    )
    asked: DataFrame | None = None  # boundary buckets of the last round with their targets
    empty: list[Cutoff] = []
    for depth in range(1, len(names) + 1):
        part, bucket = ["g", *names[: depth - 1]], names[depth - 1]
        if asked is not None:
            inside = _same(inside, asked.drop("targets"), part)
            if depth == 2:
                # The boundary buckets are a small part of the table; later rounds read only them.
                inside = written(inside, "boundary")
        counts = inside.groupBy(*part, bucket).agg(F.count(F.lit(1)).alias("n"))
        whole = Window.partitionBy(*part)
        along = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
        placed = counts.select(
            "*", (F.sum("n").over(along) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("size")
        )
        if asked is None:
            targets = F.transform(
                wanted,
                lambda w: F.struct(
                    w["target"].alias("target"), F.col("size").alias("size"), F.least(w["rank"], F.col("size")).alias("rank"),
                    F.least(w["rank"], F.col("size")).alias("place"),
                ),
            )
            placed = placed.withColumn("targets", targets)
        else:
            placed = _same(placed, asked, part)
        located = (
            placed.select(*part, bucket, "n", "before", F.inline(F.col("targets").cast(figures)))
            .filter(
                ((F.col("before") < F.col("place")) & (F.col("place") <= F.col("before") + F.col("n")))
                | ((F.col("place") <= 0) & (F.col("before") == 0))
            )
            .limit(most + 1)
            .collect()
        )
        if len(located) > most:
            raise ValueError(f"more than {MAX_GROUPS} groups")
        empty += [Cutoff(r["g"], r["target"], r["size"], 0, None) for r in located if r["place"] <= 0]
        found = [r for r in located if r["place"] > 0]
        if not found:
            return empty
        part = [*part, bucket]
        buckets: dict[tuple, list[tuple]] = {}
        for r in found:
            buckets.setdefault(tuple(r[c] for c in part), []).append((r["target"], r["size"], r["rank"], r["place"] - r["before"]))
        schema = T.StructType([*inside.select(*part).schema.fields, T.StructField("targets", _PICKS)])
        asked = spark.createDataFrame([(*k, v) for k, v in buckets.items()], schema)
        if max(r["n"] for r in found) <= boundary_rows:
            break
    ranked = Window.partitionBy(*part).orderBy(*[f"o{i}" for i in range(len(order))])
    # Null-safe partitions of the boundary buckets alone are ranked, one after another in a task.
    numbered = _same(inside, asked.drop("targets"), part).select("*", F.row_number().over(ranked).alias("position"))
    picks = asked.select(*part, F.inline("targets")).withColumnRenamed("place", "position")
    rows = _same(numbered, picks, [*part, "position"]).collect()
    return empty + [
        Cutoff(r["g"], r["target"], r["size"], r["rank"], tuple(r[f"o{i}"] for i in range(len(order)))) for r in rows
    ]


def up_to(order: list[Column], values: tuple | None) -> Column:
    """True for the rows that come no later than ``values`` in lexicographic order."""
    if values is None:
        return F.lit(False)
    condition = F.lit(True)
    for column, value in reversed(list(zip(order, values, strict=True))):
        condition = (column < F.lit(value)) | ((column == F.lit(value)) & condition)
    return condition


def _hash_order(key: str, seed: int) -> tuple[list[Column], list[Column]]:
    draw = C.draw_hash(F.col(key), seed)
    return [F.substring(draw, 1 + 4 * i, 4) for i in range(8)], [draw, F.col(key)]


def within(cutoffs: list[Cutoff], target: int, order: list[Column], group: Column | None) -> Column:
    """True for the rows kept by the cutoffs of one target."""
    condition = F.lit(False)
    for cut in cutoffs:
        if cut.target != target:
            continue
        same = F.lit(True) if group is None else group.eqNullSafe(F.lit(cut.group))
        condition = condition | (same & up_to(order, cut.values))
    return condition


def smallest_draws(df: DataFrame, key: str, rows: int, seed: int = SPLIT_SEED, group: str | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows (per group), chosen by hash."""
    levels, order = _hash_order(key, seed)
    by = None if group is None else F.col(group)
    cutoffs = rank_cutoffs(df, levels, order, [lambda n: F.lit(rows)], by)
    return df.filter(within(cutoffs, 0, order, by))


def case_control_sample(
    df: DataFrame, key: str, target_negatives: int, label: str = "is_laundering", seed: int = SPLIT_SEED
) -> DataFrame:
    """All positives and a keyed Bernoulli sample of about ``target_negatives`` negatives."""
    total = df.filter(F.col(label) == 0).count()
    fraction = min(1.0, target_negatives / total) if total else 1.0
    positives = df.filter(F.col(label) == 1)
    negatives = df.filter((F.col(label) == 0) & (C.draw_uniform(F.col(key), seed) < F.lit(fraction)))
    return positives.unionByName(negatives)


def exact_case_control(
    df: DataFrame, key: str, max_negatives: int, label: str, seed: int = SPLIT_SEED
) -> DataFrame:
    """All positives and exactly ``min(n, max_negatives)`` negatives."""
    negatives = smallest_draws(df.filter(F.col(label) == 0), key, max_negatives, seed)
    return df.filter(F.col(label) == 1).unionByName(negatives)


def stratified_split(
    df: DataFrame,
    key: str,
    fraction: float = 0.7,
    label: str = "is_laundering",
    seed: int = SPLIT_SEED,
    names: tuple[str, str] = ("train", "test"),
    column: str = "split",
) -> DataFrame:
    """Exact share of every label value goes to the first name."""
    levels, order = _hash_order(key, seed)
    by = F.col(label)
    cutoffs = rank_cutoffs(df, levels, order, [lambda n: F.floor(n * F.lit(fraction))], by)
    inside = within(cutoffs, 0, order, by)
    return df.withColumn(column, F.when(inside, F.lit(names[0])).otherwise(F.lit(names[1])))


def nested_split(df: DataFrame, key: str, label: str = "is_laundering") -> DataFrame:
    """train/test 70/30, then fit/validation 80/20 inside train: values fit, validation, test."""
    outer = stratified_split(df, key, 0.7, label, SPLIT_SEED)
    inner = stratified_split(
        outer.filter(F.col("split") == "train"), key, 0.8, label, VALIDATION_SEED, ("fit", "validation")
    )
    return inner.unionByName(outer.filter(F.col("split") == "test"))


def stratified_folds(
    df: DataFrame, key: str, folds: int = 3, label: str = "is_laundering", seed: int = FOLD_SEED, column: str = "fold"
) -> DataFrame:
    """Shuffled stratified folds 0..k-1: equal slices of the hash order within every label."""
    levels, order = _hash_order(key, seed)
    by = F.col(label)
    ranks = [lambda n, i=i: F.floor(n * F.lit(i) / F.lit(folds)) for i in range(1, folds)]
    cutoffs = rank_cutoffs(df, levels, order, ranks, by)
    fold = F.lit(folds - 1)
    for i in reversed(range(folds - 1)):
        fold = F.when(within(cutoffs, i, order, by), F.lit(i)).otherwise(fold)
    return df.withColumn(column, fold)


def chronological_split(
    df: DataFrame,
    tie: list[str],
    ts: str = "ts",
    fractions: tuple[float, float] = (0.6, 0.8),
    names: tuple[str, str, str] = ("train", "validation", "test"),
    column: str = "split",
) -> DataFrame:
    """Exact positional split in (ts, tie) order.

    Only the minute around a boundary is looked at again: by its time, then by the digits of the ties, until few rows
    are left to rank.
    """
    order = [F.col(ts), *[F.col(t) for t in tie]]
    levels = [F.floor(C.micros(F.col(ts)) / 60_000_000), C.micros(F.col(ts))]
    for t in tie:
        finer = digits(df, t)
        levels += finer
        if not finer or dict(df.dtypes)[t] == "string":
            break  # the digits of a text may end before the text does
    ranks = [lambda n, f=f: F.floor(n * F.lit(f)) for f in fractions]
    cutoffs = rank_cutoffs(df, levels, order, ranks)
    first, second = (within(cutoffs, i, order, None) for i in range(2))
    return df.withColumn(
        column, F.when(first, F.lit(names[0])).when(second, F.lit(names[1])).otherwise(F.lit(names[2]))
    )


def natural_prior_sample(
    df: DataFrame,
    holdout: DataFrame,
    key: str,
    label: str = "is_laundering",
    max_negatives: int | None = None,
    exclude: DataFrame | None = None,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Held-out positives with as many uniformly drawn negatives as the base rate of ``df`` asks for.

    With ``max_negatives`` positives are thinned by the same share, so the prior stays natural.
    """
    totals = df.agg(F.sum(label).alias("p"), F.count(F.lit(1)).alias("n")).first()
    positives = holdout.filter(F.col(label) == 1)
    held = positives.count()
    rate = (totals["p"] or 0) / totals["n"] if totals["n"] else 0.0
    needed = round(held * (1 - rate) / rate) if rate else 0
    if max_negatives is not None and needed > max_negatives:
        positives = smallest_draws(positives, key, round(held * max_negatives / needed), seed)
        needed = max_negatives
    pool = df.filter(F.col(label) == 0)
    if exclude is not None:
        pool = pool.join(exclude.select(key), key, "left_anti")
    return positives.select(*df.columns).unionByName(smallest_draws(pool, key, needed, seed))
