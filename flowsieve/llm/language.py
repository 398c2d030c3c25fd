"""Language identification by bit-sliced Bloom filters of n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.words import chunks, letters, mix, slices
from flowsieve.session import written

#: Bytes of an n-gram, slots of a filter (as a power of two) and slots of an n-gram, for every language.
SIZES, SLOT_BITS, HASHES = (3, 5), 17, 3
_BLOCK = 1 << 11
_SLOTS = 1 << SLOT_BITS


def _fold(id_col: str, folds: int = 4) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds))


def ngrams(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every n-gram of ``size`` bytes; words are bounded by spaces, no n-gram spans two texts."""
    raw = np.frombuffer(b"\n" + b"".join(b" " + t + b" \n" for t in texts), np.uint8)
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    packed, ends = np.zeros(n, np.uint64), raw == 10
    crosses = np.zeros(n, bool)
    for k in range(size):
        packed |= raw[k : k + n].astype(np.uint64) << np.uint64(8 * k)
        crosses |= ends[k : k + n]
    owner = np.cumsum(ends[:n]) - 1
    return owner[~crosses], mix(packed[~crosses] + np.uint64(size))


def slots(hashes: np.ndarray, k: int) -> np.ndarray:
    return ((hashes >> np.uint64(k * SLOT_BITS)) & np.uint64(_SLOTS - 1)).astype(np.int64)


class Filters:
    """For each n-gram size, one byte per slot and eight languages: bit l is language l's Bloom filter there."""

    def __init__(self, languages: list[str], planes: dict[int, np.ndarray], usual: int):
        self.languages, self.planes, self.usual = languages, planes, usual
        self.bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(float)
        counted = {size: np.unpackbits(p, axis=0, bitorder="little").mean(1)[: len(languages)] for size, p in planes.items()}
        self.false = {size: fill**HASHES for size, fill in counted.items()}

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score): the largest count of n-grams, after taking off the false positives expected."""
        total = np.zeros((len(texts), len(self.languages)))
        for size, planes in self.planes.items():
            owner, hashes = ngrams(texts, size)
            at = [slots(hashes, k) for k in range(HASHES)]
            many = np.bincount(owner, minlength=len(texts))[:, None]
            found = []
            for plane in planes:
                mask = plane[at[0]]
                for slot in at[1:]:
                    mask = mask & plane[slot]
                kinds = np.bincount(owner * 256 + mask, minlength=256 * len(texts)).reshape(len(texts), 256)
                found.append(kinds @ self.bits)
            count = np.concatenate(found, axis=1)[:, : len(self.languages)]
            false = self.false[size]
            total += np.maximum(0, (count - many * false) / np.maximum(1 - false, 1e-9))
        best = total.argmax(1)
        top, every = total.max(1), total.sum(1)
        return np.where(top > 0, best, self.usual), np.divide(top, every, out=np.zeros(len(texts)), where=every > 0)


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fold: int = 2,
    least: float = 2.0,
    ratio: float = 0.1,
) -> Filters | None:
    """Filters from all documents with a language outside the held-out fold; None if there is none.

    Every task counts the n-grams of each language in the slots that the filters have. A language's bit is set
    where its share of n-grams is at least ``least`` times that of an even spread, and ``ratio`` times the highest
    share of any language in that slot: then every n-gram that is that frequent has all its bits, and what strays
    in from passages in other languages has not. The tables have the same size whatever the corpus.
    """
    small_batches(docs.sparkSession)
    known = docs.filter(F.col(lang_col).isNotNull() & (_fold(id_col) != fold)).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )

    def count(batches):
        press, tables = zstandard.ZstdCompressor(level=1), {}
        for batch in slices(batches, 0):
            text = [letters(t) for t in batch.column(0).to_pylist()]
            by = batch.column(1).to_pylist()
            for lang in sorted(set(by)):
                own = [t for t, b in zip(text, by, strict=True) if b == lang]
                for i, j in chunks(own):
                    for size in SIZES:
                        table = tables.setdefault((lang, size), np.zeros(_SLOTS, np.int64))
                        _, hashes = ngrams(own[i:j], size)
                        for k in range(HASHES):
                            table += np.bincount(slots(hashes, k), minlength=_SLOTS)
        for (lang, size), table in tables.items():
            parts = table.reshape(-1, _BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(parts)),
                    pa.array([size] * len(parts), pa.int32()),
                    pa.array(np.arange(len(parts)), pa.int32()),
                    pa.array(parts.sum(1)),
                    pa.array([press.compress(p.tobytes()) for p in parts]),
                ],
                names=["lang", "size", "block", "n", "counts"],
            )

    counted = written(
        known.mapInArrow(count, "lang string, size int, block int, n long, counts binary"), "language-counts"
    )
    totals = counted.groupBy("lang", "size").agg(F.sum("n").alias("n")).toPandas()
    if not totals.n.sum():
        return None
    languages = sorted(set(totals.lang[totals.n > 0]))
    total = {(r.lang, r.size_): max(r.n, 1) for r in totals.rename(columns={"size": "size_"}).itertuples()}

    def decide(key, table):  # a row per task and language for one block of slots
        unpack, size = zstandard.ZstdDecompressor(), key[0].as_py()
        share = np.zeros((-(-len(languages) // 8) * 8, _BLOCK))
        for lang, packed in zip(table.column("lang").to_pylist(), table.column("counts").to_pylist(), strict=True):
            if lang in languages:
                share[languages.index(lang)] += np.frombuffer(unpack.decompress(packed), np.int64) / total[lang, size]
        has = (share >= least / _SLOTS) & (share >= ratio * share.max(0))
        return pa.table(
            {
                "size": pa.array([size], pa.int32()),
                "block": pa.array([key[1].as_py()], pa.int32()),
                "planes": pa.array([np.packbits(has, axis=0, bitorder="little").tobytes()], pa.binary()),
            }
        )

    blocks = counted.groupBy("size", "block").applyInArrow(decide, "size int, block int, planes binary").collect()
    planes = {size: np.zeros((-(-len(languages) // 8), _SLOTS), np.uint8) for size in SIZES}
    for row in blocks:
        part = np.frombuffer(row.planes, np.uint8).reshape(-1, _BLOCK)
        planes[row.size][:, row.block * _BLOCK : (row.block + 1) * _BLOCK] = part
    usual = max(range(len(languages)), key=lambda i: sum(total.get((languages[i], s), 0) for s in SIZES))
    return Filters(languages, planes, usual)


def predict(docs: DataFrame, filters: Filters | None, id_col: str = "doc_id", text_col: str = "text", fold: int = 2) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, from the text alone.

    A null text, one without a letter, and every text where nothing was learnt is ``und`` with score 0. A text
    without any learnt n-gram has the language with the most text, and score 0.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        filters = shared.value
        for batch in slices(batches, 2):
            texts = batch.column(2).to_pylist()
            plain = [letters(t) for t in texts]
            names, scores = [], []
            for i, j in chunks(plain):
                if filters is None:
                    names += ["und"] * (j - i)
                    scores += [0.0] * (j - i)
                    continue
                best, score = filters.predict(plain[i:j])
                for t, b, s in zip(texts[i:j], best.tolist(), score.tolist(), strict=True):
                    known = t is not None and any(c.isalpha() for c in t)
                    names.append(filters.languages[b] if known else "und")
                    scores.append(s if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (_fold(id_col) == fold).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
