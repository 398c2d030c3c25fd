"""Subword lattices: probability of a word over all its segmentations, for many words at once."""

from __future__ import annotations

import numpy as np

#: The mark that opens a word, in the vocabulary's spelling and as one symbol here (bytes are 0 to 255).
_OPEN, _MARK = "▁".encode(), 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 18


class Vocabulary:
    """Pieces of an existing unigram or BPE vocabulary and their log probabilities; the last 256 are single bytes."""

    def __init__(self, pieces: list[str], scores: list[float]):
        spelled: dict[tuple[int, ...], float] = {}
        for piece, score in zip(pieces, scores, strict=True):
            raw = piece.encode("utf-8", "surrogatepass")
            symbols = (_MARK, *raw[len(_OPEN) :]) if raw.startswith(_OPEN) else tuple(raw)
            if symbols and _OPEN not in raw[1:]:
                spelled[symbols] = max(score, spelled.get(symbols, -np.inf))
        spelled.setdefault((_MARK,), min(spelled.values(), default=0.0))
        self.size = len(spelled)
        self.longest = max(map(len, spelled))
        hashes = np.array([self._hash(s) for s in spelled], np.uint64)
        # scores of a BPE vocabulary are ranks: their order is what counts, so they start as a Zipf law
        rank = np.argsort(np.argsort(-np.array(list(spelled.values())), kind="stable"), kind="stable")
        self.prior = np.concatenate([1 / (rank + 2.7), np.full(256, 1e-4)])
        self.prior /= self.prior.sum()
        self.tables = []
        rest = np.arange(len(hashes))
        while len(rest):  # entries that clash in one table go to the next
            shift = np.uint64(64 - _SLOT_BITS)
            slot = ((hashes[rest] * self._spread(len(self.tables))) >> shift).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            key, piece = np.zeros(1 << _SLOT_BITS, np.uint64), np.full(1 << _SLOT_BITS, -1, np.int32)
            key[slot[first]], piece[slot[first]] = hashes[rest[first]], rest[first]
            self.tables.append((self._spread(len(self.tables)), key, piece))
            rest = np.delete(rest, first)

    @staticmethod
    def _spread(k: int) -> np.uint64:
        return np.uint64((0xD6E8FEB86659FD93 + 2 * k * 0xA24BAED4963EE407) % (1 << 64) | 1)

    @staticmethod
    def _hash(symbols: tuple[int, ...]) -> int:
        h = 0
        for s in symbols:
            h = (h + s + 1) * int(_STEP) % (1 << 64)
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece with each hash, -1 if none."""
        out = np.full(len(h), -1, np.int32)
        for spread, key, piece in self.tables:
            slot = ((h * spread) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
            out = np.where(key[slot] == h, piece[slot], out)
        return out

    def words(self, words: list[bytes]):
        """Groups (indices, symbols) of words of similar length, longest first; symbols[k] is a column of symbols."""
        length = np.array([len(w) + 1 for w in words], np.int64)
        order = np.argsort(-length, kind="stable")
        at = 0
        while at < len(order):
            top = int(length[order[at]])
            stop = at + int(np.searchsorted(-length[order[at:]], -(top // 2), side="left"))
            stop = min(stop, at + max(1, (4 << 20) // top))
            which = order[at:stop]
            symbols = np.zeros((top, len(which)), np.int16)
            symbols[0] = _MARK
            raw = np.frombuffer(b"".join(words[i] for i in which), np.uint8)
            size = length[which] - 1
            column = np.repeat(np.arange(len(which)), size)
            row = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size) + 1
            symbols[row, column] = raw
            yield which, length[which], symbols
            at = stop

    def _edges(self, symbols: np.ndarray, length: np.ndarray, at: int):
        """(end, piece, how many words) for the pieces that start at one place; -1 where none fits."""
        alive = int(np.searchsorted(-length, -at, side="left"))  # words with a symbol here
        h = np.zeros(alive, np.uint64)
        for end in range(at + 1, min(at + self.longest, len(symbols)) + 1):
            alive = int(np.searchsorted(-length, -(end - 1), side="left"))
            if not alive:
                return
            h = (h[:alive] + symbols[end - 1, :alive].astype(np.uint64) + np.uint64(1)) * _STEP
            yield end, self.find(h), alive
            if end == at + 1 and at:  # any byte is a piece too
                yield end, (self.size + symbols[at, :alive]).astype(np.int32), alive

    def forward(self, symbols: np.ndarray, length: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """alpha[k, w]: log probability of the first k symbols of word w over all segmentations."""
        alpha = np.full((len(symbols) + 1, len(length)), -np.inf)
        alpha[0] = 0
        known = np.append(logp, -np.inf)  # piece -1
        for at in range(len(symbols)):
            for end, piece, alive in self._edges(symbols, length, at):
                hit = np.flatnonzero(piece >= 0)
                alpha[end, hit] = np.logaddexp(alpha[end, hit], alpha[at, hit] + known[piece[hit]])
        return alpha

    def log_probability(self, words: list[bytes], logp: np.ndarray) -> np.ndarray:
        """Marginal natural-log probability of each word, its opening mark included."""
        out = np.zeros(len(words))
        for which, length, symbols in self.words(words):
            out[which] = self.forward(symbols, length, logp)[length, np.arange(len(which))]
        return out

    def expected(self, words: list[bytes], times: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Expected use of every piece when each word is read ``times`` times (forward-backward)."""
        out = np.zeros(len(logp))
        for which, length, symbols in self.words(words):
            alpha = self.forward(symbols, length, logp)
            columns = np.arange(len(which))
            total = alpha[length, columns]
            beta = np.full_like(alpha, -np.inf)
            beta[length, columns] = 0
            for at in range(len(symbols) - 1, -1, -1):
                for end, piece, _ in self._edges(symbols, length, at):
                    hit = np.flatnonzero(piece >= 0)
                    onward = logp[piece[hit]] + beta[end, hit]
                    share = np.exp(alpha[at, hit] + onward - total[hit]) * times[which[hit]]
                    out += np.bincount(piece[hit], share, len(out))
                    beta[at, hit] = np.logaddexp(beta[at, hit], onward)
        return out
