"""Exact splits and keyed samples."""

import random

import pytest
from pyspark.sql import functions as F

from flowsieve.operators import sampling as X


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [(f"k{i}", int(i % 10 == 0), rng.randrange(40) * 60) for i in range(1000)]
    df = spark.createDataFrame(data, "row_key string, is_laundering int, t long")
    return df.withColumn("ts", F.timestamp_seconds("t"))


def sizes(df, *cols):
    return {tuple(r[c] for c in cols): r["count"] for r in df.groupBy(*cols).count().collect()}


def test_stratified_split_is_exact(rows):
    got = sizes(X.stratified_split(rows, "row_key"), "is_laundering", "split")
    assert got == {(0, "train"): 630, (0, "test"): 270, (1, "train"): 70, (1, "test"): 30}


def test_nested_split(rows):
    got = sizes(X.nested_split(rows, "row_key"), "split")
    assert got == {("fit",): 560, ("validation",): 140, ("test",): 300}


def test_folds_are_stratified_and_even(rows):
    got = sizes(X.stratified_folds(rows, "row_key"), "is_laundering", "fold")
    assert sorted(v for (y, _), v in got.items() if y == 0) == [300, 300, 300]
    assert sorted(v for (y, _), v in got.items() if y == 1) == [33, 33, 34]


def test_partitioning_does_not_change_a_sample(rows):
    a = {r["row_key"] for r in X.smallest_draws(rows, "row_key", 123).collect()}
    b = {r["row_key"] for r in X.smallest_draws(rows.repartition(7), "row_key", 123).collect()}
    assert a == b and len(a) == 123


def test_sample_larger_than_table_keeps_all(rows):
    assert X.smallest_draws(rows, "row_key", 5000).count() == 1000
    assert X.smallest_draws(rows, "row_key", 0).count() == 0
    assert X.smallest_draws(rows, "row_key", 60, group="is_laundering").count() == 120


def test_chronological_split(rows):
    split = X.chronological_split(rows, ["row_key"]).collect()
    order = {"train": 0, "validation": 1, "test": 2}
    ordered = sorted(split, key=lambda r: (r["t"], r["row_key"]))
    labels = [order[r["split"]] for r in ordered]
    assert labels == sorted(labels)
    assert [labels.count(i) for i in range(3)] == [600, 200, 200]


def test_case_control_keeps_all_positives(rows):
    sample = X.case_control_sample(rows, "row_key", 450)
    got = sizes(sample, "is_laundering")
    assert got[(1,)] == 100 and 380 < got[(0,)] < 520
    exact = sizes(X.exact_case_control(rows, "row_key", 50, "is_laundering"), "is_laundering")
    assert exact == {(1,): 100, (0,): 50}


def test_natural_prior(rows):
    split = X.stratified_split(rows, "row_key")
    train = split.filter(F.col("split") == "train")
    natural = X.natural_prior_sample(split, split.filter(F.col("split") == "test"), "row_key", exclude=train)
    assert sizes(natural, "is_laundering") == {(1,): 30, (0,): 270}
    assert natural.join(train.select("row_key"), "row_key").count() == 0
    capped = X.natural_prior_sample(split, split.filter(F.col("split") == "test"), "row_key", max_negatives=10)
    # a bound on the negatives thins the positives by the same share, so the prior stays natural
    assert sizes(capped, "is_laundering") == {(1,): 1, (0,): 10}


def test_radix_selection_with_tiny_bounds(spark, rows):
    """Every bound gives the same cutoff; a third of all rows share a time, some a key as well."""
    data = [(f"k{i:04d}", i % 5, 60 * (7 if i % 3 == 0 else i % 11)) for i in range(900)] + [("k0000", 0, 420)] * 30
    df = spark.createDataFrame(data, "row_key string, part int, t long").withColumn("ts", F.timestamp_seconds("t")).repartition(6)
    ordered = sorted((t, k) for k, _, t in data)
    levels = [F.floor(F.col("t") / 600), F.col("t"), *X.digits(df, "row_key")]
    order = [F.col("t"), F.col("row_key")]
    places = [1, 2, 300, 465, 929, 930]
    for bound in (1, 20, 10**6):
        cuts = X.rank_cutoffs(df, levels, order, [lambda n, k=k: F.lit(k) for k in places], boundary_rows=bound)
        assert {c.target: c.values for c in cuts} == {i: ordered[k - 1] for i, k in enumerate(places)}
    levels, order = X._hash_order("row_key", 42)
    ranks = [lambda n: F.floor(n / 2), lambda n: F.lit(0), lambda n: n + 5]
    cuts = [
        sorted(((c.group, c.target, c.size, c.rank, c.values) for c in X.rank_cutoffs(df, levels, order, ranks, F.col("part"), bound)), key=str)
        for bound in (1, 10**6)
    ]
    assert cuts[0] == cuts[1] and len(cuts[0]) == 15


def test_integer_digits_keep_the_order(spark):
    values = [-(2**63), -70_000, -1, 0, 1, 65_535, 65_536, 2**33, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    cuts = X.rank_cutoffs(df, X.digits(df, "v"), [F.col("v")], [lambda n, i=i: F.lit(i + 1) for i in range(9)], boundary_rows=1)
    assert [c.values[0] for c in sorted(cuts, key=lambda c: c.target)] == values


def test_a_missing_group_is_a_group(spark):
    df = spark.createDataFrame([(f"k{i}", None if i % 2 else 1) for i in range(40)], "row_key string, part int")
    assert sizes(X.smallest_draws(df, "row_key", 7, group="part"), "part") == {(None,): 7, (1,): 7}
