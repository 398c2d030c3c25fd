"""Mini-batch K-means on keyed batches.

Rows are dealt to rounds by a hash of their key and taken in the order of that hash, so the batches, and with them
the result, do not depend on how the table is partitioned. One task takes a round, a few ten thousand rows, as a
stream and holds one batch; only centres and weights pass between rounds. Rounds end when the smoothed inertia has
not improved for some batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.operators.clustering import SEED, assign_nearest

BATCH = 2_048
ROUND_BATCHES = 32
MAX_ROUNDS = 64
PATIENCE = 10
#: A centre with less than this share of the heaviest centre's rows starts anew at a row of the batch.
STARVED = 0.01
#: The start comes from this many batches: of so many draws, each settled by so many full steps, the one with the least inertia.
START_BATCHES, STARTS, SETTLE = 3, 5, 10
#: The inertia is smoothed over about this many batches.
SMOOTHED = 64
_STATE = "centres array<double>, weights array<double>, smoothed double, best double, stale int, batches long"


def minibatch_kmeans(points: DataFrame, k: int, key: str, x: str = "x", column: str = "cluster", **options) -> DataFrame:
    """``points`` plus the nearest of ``k`` fitted centres (lowest number on ties); an empty table stays empty."""
    centres = fit_centres(points, k, key, x, **options)
    if not len(centres):
        return points.withColumn(column, F.lit(None).cast("int"))
    return assign_nearest(points, centres, list(range(len(centres))), x, column)


def fit_centres(
    points: DataFrame, k: int, key: str, x: str = "x", seed: int = SEED, batch: int = BATCH,
    round_batches: int = ROUND_BATCHES, max_rounds: int = MAX_ROUNDS, patience: int = PATIENCE,
) -> np.ndarray:
    """Centres fitted on ``points``: arrays of finite doubles of one length; ``key`` tells rows apart.

    Rows without a vector take no part. Up to ``max_rounds`` rounds of about ``round_batches`` batches are read,
    each in one scan; a table smaller than a round is read again in another order.
    """
    rows = points.filter(F.col(x).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(x).alias("x"))
    total = rows.count()
    if not total:
        return np.zeros((0, 0))
    slots = -(-total // (round_batches * batch))
    rate = min(1.0, 2.0 * batch / (min(total, SMOOTHED * batch) + 1))
    state = None
    for number in range(max_rounds):
        epoch, slot = divmod(number, slots)
        # Copies of one key differ in their vector at most; equal rows may come in any order.
        draw = F.xxhash64(F.lit(f"{seed}:{epoch}"), "key", "x")
        drawn = rows.withColumn("draw", draw).filter(F.pmod("draw", F.lit(slots)) == slot)
        ordered = drawn.repartition(1).sortWithinPartitions("draw", "key", "x").select("x")
        state = ordered.mapInArrow(_round(state, k, seed, batch, patience, rate), _STATE).first()
        if state["stale"] >= patience:
            break
    return np.array(state["centres"]).reshape(k, -1)


def _round(state, k: int, seed: int, batch: int, patience: int, rate: float):
    """Function for the ordered rows of a round: one row with the state behind it."""
    before = None if state is None else state.asDict()

    def run(batches):
        if before is None:
            centres, weights, smoothed, best, stale, done = None, np.zeros(k), None, None, 0, 0
        else:
            weights = np.array(before["weights"])
            centres = np.array(before["centres"]).reshape(k, -1) if before["centres"] else None
            smoothed, best, stale, done = (before[c] for c in ("smoothed", "best", "stale", "batches"))
        for block in _chunks(batches, batch, START_BATCHES if centres is None else 1):
            if centres is None:
                centres = best_start(block, k, np.random.default_rng(seed))
            for at in range(0, len(block), batch):
                part = block[at : at + batch]
                inertia = step(part, centres, weights, np.random.default_rng((seed, done)))
                smoothed = inertia if smoothed is None else smoothed + rate * (inertia - smoothed)
                if best is None or smoothed < best:
                    best, stale = smoothed, 0
                else:
                    stale += 1
                done += 1
                if stale >= patience:
                    break
            if stale >= patience:
                break
        flat = [] if centres is None else centres.ravel().tolist()
        kinds = pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.int32(), pa.int64()
        values = flat, weights.tolist(), smoothed, best, stale, done
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], kind) for v, kind in zip(values, kinds)],
            names=["centres", "weights", "smoothed", "best", "stale", "batches"],
        )

    return run


def _chunks(batches, size: int, first: int):
    """Blocks of ``size`` rows, whatever the sizes of the Arrow batches; the first block has ``first`` times as many."""
    held, rows, wanted = [], 0, size * first
    for one in batches:
        if not one.num_rows:
            continue
        block = one.column(0).flatten().to_numpy(zero_copy_only=False).reshape(one.num_rows, -1)
        held.append(block)
        rows += len(block)
        while rows >= wanted:
            joined = np.concatenate(held)
            yield joined[:wanted]
            held, rows, wanted = [joined[wanted:]], rows - wanted, size
    if rows:
        yield np.concatenate(held)


def _squares(block: np.ndarray, centres: np.ndarray) -> np.ndarray:
    found = (block**2).sum(axis=1)[:, None] - 2 * block @ centres.T + (centres**2).sum(axis=1)[None, :]
    return np.maximum(found, 0.0)


def spread_start(block: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` rows far apart: each is the best of a few drawn with chances by squared distance to those chosen."""
    chosen = [block[rng.integers(len(block))]]
    near = _squares(block, np.array(chosen))[:, 0]
    for _ in range(k - 1):
        mass = near.cumsum()
        tries = np.minimum(np.searchsorted(mass, rng.random(2 + int(np.log(k))) * mass[-1], "right"), len(block) - 1)
        nearer = np.minimum(near[:, None], _squares(block, block[tries]))
        best = int(nearer.sum(axis=0).argmin())
        chosen.append(block[tries[best]])
        near = nearer[:, best]
    return np.array(chosen, float)


def best_start(block: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The draw that settles best on the rows of ``block``."""
    tried = []
    for _ in range(STARTS):
        centres = spread_start(block, k, rng)
        for _ in range(SETTLE):
            step(block, centres, np.zeros(k), rng, starved=0.0)
        tried.append((float(_squares(block, centres).min(axis=1).sum()), len(tried), centres))
    return min(tried, key=lambda t: t[:2])[2]


def step(block: np.ndarray, centres: np.ndarray, weights: np.ndarray, rng: np.random.Generator, starved: float = STARVED) -> float:
    """Move ``centres`` by one batch, in place; a centre moves by its share of new rows. Mean squared distance before."""
    squares = _squares(block, centres)
    own = squares.argmin(axis=1)
    inertia = float(squares[np.arange(len(block)), own].mean())
    n = np.bincount(own, minlength=len(centres)).astype(float)
    sums = np.zeros_like(centres)
    np.add.at(sums, own, block)
    weights += n
    hit = n > 0
    centres[hit] += (sums[hit] - n[hit, None] * centres[hit]) / weights[hit, None]
    poor = np.flatnonzero(weights < starved * weights.max())[: len(block) // 2]
    if len(poor):
        centres[poor] = block[rng.choice(len(block), len(poor), replace=False)]
        weights[poor] = np.delete(weights, poor).min()
    return inertia
