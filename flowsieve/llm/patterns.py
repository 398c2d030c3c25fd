"""Packing plan for a histogram of lengths: pattern counts by non-negative least squares, then best fit."""

from __future__ import annotations

import numpy as np


def enumerate_patterns(capacity: int, parts: int) -> np.ndarray:
    """All non-increasing rows of ``parts`` bin sizes (0: none) that fill ``capacity`` exactly."""
    rows = np.arange(1, capacity + 1)[:, None]  # first, largest part
    for k in range(1, parts):
        left = capacity - rows.sum(1)
        # the next part is at most the last one, and large enough for the parts after it to fill the rest
        low = -(-left // (parts - k))
        high = np.minimum(left, rows[:, -1])
        room = np.maximum(high - low + 1, 0)
        at = np.repeat(np.arange(len(rows)), room)
        step = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        rows = np.column_stack([rows[at], low[at] + step])
    return rows[rows.sum(1) == capacity]


def nnls(patterns: np.ndarray, wanted: np.ndarray, limit: int = 400) -> np.ndarray:
    """x >= 0 of least |A x - wanted|, where column j of A counts the bins of pattern j (active-set method).

    A is never built: a gradient is a sum of look-ups, and only the active columns, at most one per bin, are dense.
    """
    bins = len(wanted)

    def column(j: int) -> np.ndarray:
        return np.bincount(patterns[j], minlength=bins)[:bins].astype(float) * keep

    keep = np.ones(bins)
    keep[0] = 0  # an unused place
    active: list[int] = []
    x = np.zeros(0)
    columns = np.zeros((bins, 0))
    rest = wanted * keep
    for _ in range(limit):
        gain = rest[patterns].sum(1)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * max(1.0, np.abs(wanted).max()):
            break
        active.append(best)
        columns = np.column_stack([columns, column(best)])
        x = np.append(x, 0.0)
        while True:
            normal = columns.T @ columns
            normal.flat[:: len(normal) + 1] += 1e-9  # columns may be nearly dependent
            found = np.linalg.solve(normal, columns.T @ (wanted * keep))
            if found.min() > 0:
                x = found
                break
            low = found <= 0
            shrink = np.min(x[low] / np.maximum(x[low] - found[low], 1e-300))
            x = x + shrink * (found - x)
            stay = x > 1e-12 * max(1.0, x.max())
            active = [a for a, s in zip(active, stay, strict=True) if s]
            columns, x = columns[:, stay], x[stay]
            if not active:
                break
        rest = wanted * keep - columns @ x
    out = np.zeros(len(patterns))
    out[active] = x
    return out


def plan(histogram: np.ndarray, parts: int = 4) -> list[tuple[tuple[int, ...], int]]:
    """(bin sizes, repeats) that place every piece of ``histogram`` (pieces per bin 1..capacity; [0] unused).

    The fitted repeat counts are rounded down to what the bins hold. Residual pieces, those that rounding and the
    fit leave over, are packed largest first with the largest bin that still fits, as many times as bins allow.
    """
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    out = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    patterns = enumerate_patterns(capacity, parts)
    patterns = patterns[(left[patterns] > 0)[:, 0] & ((patterns == 0) | (left[patterns] > 0)).all(1)]
    if len(patterns):
        repeats = nnls(patterns, left.astype(float))
        for j in np.argsort(-repeats, kind="stable"):
            used, times = np.unique(patterns[j][patterns[j] > 0], return_counts=True)
            n = int(min(np.floor(repeats[j] + 1e-6), (left[used] // times).min()))
            if n <= 0:
                continue
            left[used] -= n * times
            out.append((tuple(int(b) for b in patterns[j] if b), n))
    while left.any():
        pattern, room, spare = [], capacity, left.copy()
        while True:
            fits = np.flatnonzero(spare[: room + 1])
            if not len(fits):
                break
            best = int(fits[-1])
            pattern.append(best)
            spare[best] -= 1
            room -= best
        used, times = np.unique(pattern, return_counts=True)
        n = int((left[used] // times).min())
        left[used] -= n * times
        out.append((tuple(pattern), n))
    return out
