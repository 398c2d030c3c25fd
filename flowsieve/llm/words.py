"""Word and shingle hashes of a batch of texts, computed column-wise with numpy inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in pieces of about this many bytes, so that a task's temporary arrays stay small.
CHUNK_BYTES = 1 << 20
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


#: ASCII that parts words; letters of other scripts never do.
_PARTS = bytes(i if i > 127 or chr(i).isalpha() else 32 for i in range(256))


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters, joined by one space."""
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_PARTS).split())


def canonical(text: str | None) -> bytes:
    """The words of a text (runs without ``\\x20 \\x09-\\x0D``) joined by one space, in UTF-8."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [start, end) of ``texts`` with about ``limit`` bytes each; a longer text has a range to itself."""
    start = size = 0
    for i, text in enumerate(texts):
        length = len(text) if text else 0
        if i > start and size + length > limit:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in smaller batches, of about ``limit`` bytes of text each; none is empty."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(size[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
        pa.default_memory_pool().release_unused()  # a worker lives on between tasks; what it keeps, others miss


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Tables that a worker keeps between tasks, of one kind of work at a time.
_HELD: dict[str, dict] = {}


def held(kind: str) -> dict:
    """What this worker keeps for one kind of work. What it kept for another is dropped: workers serve all stages."""
    if kind not in _HELD:
        _HELD.clear()
        _HELD[kind] = {}
    return _HELD[kind]


#: Powers known so far: one table per worker, which grows with the longest chunk up to _KEPT entries.
_KEPT = 1 << 21


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base, and of its inverse, modulo 2**64."""
    known = held("powers")
    if len(known.get("base", ())) >= n:
        return known["base"], known["inverse"]
    size, out = -(-max(n, 1) // (1 << 18)) << 18, {}
    for name, base in (("base", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
        table = np.ones(size, np.uint64)
        have = 1
        while have < size:
            step = min(have, size - have)
            np.multiply(table[:step], np.uint64(pow(base, have, 1 << 64)), out=table[have : have + step])
            have += step
        out[name] = table
    if size <= _KEPT:
        known.update(out)
    return out["base"], out["inverse"]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Running sums of (byte + 1) * base**place: differences of two are hashes of what lies between."""
    total = np.zeros(len(raw) + 1, np.uint64)
    total[1:] = raw
    total[1:] += np.uint64(1)
    total[1:] *= powers(len(raw))[0][: len(raw)]
    return np.cumsum(total, out=total)


class Words:
    """Words of some canonical texts: ``hash`` per word, ``first`` word of each text (and one past the last),
    ``start`` and ``end`` byte of each word in ``data``."""

    def __init__(self, texts: list[bytes]):
        kept = [t for t in texts if t]
        self.data = b" ".join(kept) + b" "
        raw = np.frombuffer(self.data, np.uint8)
        self.end = np.flatnonzero(raw == 32) if kept else np.zeros(0, np.int64)
        self.start = np.concatenate([[0], self.end[:-1] + 1]).astype(np.int64) if len(self.end) else self.end
        counts = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.hash = np.zeros(0, np.uint64)
        if len(self.end):
            total = prefix_sums(raw)
            self.hash = mix((total[self.end] - total[self.start]) * powers(len(raw))[1][self.start])

    def __len__(self) -> int:
        return len(self.end)

    def owner(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def shingles(self, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(text index, hash) of every run of ``size`` words. With ``short``, a text with fewer words is one run."""
        n, per = len(self.hash), np.diff(self.first)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        owner, position = self.owner(), np.arange(n) - np.repeat(self.first[:-1], per)
        acc = np.zeros(n, np.uint64)
        for k in range(size):
            shifted = np.zeros(n, np.uint64)
            shifted[: max(n - k, 0)] = self.hash[k:] if k else self.hash
            inside = position + k < per[owner]
            acc = acc * np.uint64(_STEP) + np.where(inside, shifted, np.uint64(0))
        whole = position + size <= per[owner]
        if short:
            whole |= (position == 0) & (per[owner] < size)
        return owner[whole], mix(acc[whole])
