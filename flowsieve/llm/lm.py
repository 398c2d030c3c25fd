"""Language-model scores of documents: subword lattices over an existing vocabulary, trained weights."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.lattice import Vocabulary
from flowsieve.llm.words import Words, canonical, chunks, mix, slices
from flowsieve.session import written

_CHUNK = 4 << 20


def held_out(id_col: str, fold: int, folds: int = 7) -> Column:
    """True when crc32 of the identifier as text leaves ``fold``; a missing identifier counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds)) == fold


def read_vocabulary(path: str) -> Vocabulary:
    """The ordinary pieces of a sentencepiece model file, with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = model.is_control, model.is_unknown, model.is_byte, model.is_unused
    known = [i for i in range(model.get_piece_size()) if not any(f(i) for f in odd)]
    return Vocabulary([model.id_to_piece(i) for i in known], [model.get_score(i) for i in known])


def _vocabulary_of(words: Words, buckets: int):
    """Different words of a chunk by bucket: (bucket of each, their spelling, index of each word of the chunk).

    Both sides of the exchange call this on the same chunk and so agree on the order.
    """
    value, place, which = np.unique(words.hash, return_index=True, return_inverse=True)
    bucket = (mix(value) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    place = place[order]
    spelled = [words.data[a:b] for a, b in zip(words.start[place].tolist(), words.end[place].tolist(), strict=True)]
    return bucket[order], spelled, back[which]


def _edges(sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1], [True]]))


def _batch(names: str, kinds: list, rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names.split())


def cut_chunks(texts: DataFrame) -> DataFrame:
    """(chunk, ids, held, words): documents in chunks of a few MB; words are canonical, lower-cased, compressed."""

    def run(batches):
        press, part, count = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0
        for batch in slices(batches, 2, _CHUNK):
            ids, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words = [canonical(t).lower() for t in batch.column(2).to_pylist()]
            for i, j in chunks(words, _CHUNK):
                row = ((part << 32) + count, ids[i:j], held[i:j], press.compress(b"\n".join(words[i:j])))
                count += 1
                yield _batch(
                    "chunk ids held words", [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()], [row]
                )

    return texts.mapInArrow(run, "chunk long, ids array<long>, held array<boolean>, words binary")


def count_words(cut: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of words: its different words and their counts in the documents that are learnt from,
    and for each chunk the places of the words it asked for."""

    def ask(batches):
        press, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            for chunk, held, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = Words(unpack.decompress(packed).split(b"\n"))
                bucket, spelled, which = _vocabulary_of(words, buckets)
                learnt = ~np.repeat(np.array(held, bool), np.diff(words.first))
                times = np.bincount(which[learnt], minlength=len(spelled)).astype(np.uint32)
                edge, rows = _edges(bucket), []
                for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    blob = times[lo:hi].tobytes() + b"\n".join(spelled[lo:hi])
                    rows.append((int(bucket[lo]), chunk, hi - lo, press.compress(blob)))
                yield _batch("bucket chunk n words", [pa.int32(), pa.int64(), pa.int32(), pa.binary()], rows)

    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary())]

    def settle(bucket: int, asked: list, press) -> tuple:
        place: dict[bytes, int] = {}
        order, times = [], []
        for _, n, blob in asked:
            times.append(np.frombuffer(blob, np.uint32, n))
            order.append(np.array([place.setdefault(w, len(place)) for w in blob[4 * n :].split(b"\n")], np.uint32))
        count = np.bincount(np.concatenate(order), np.concatenate(times), len(place)).astype(np.int64)
        return (
            bucket,
            press.compress(b"\n".join(place)),
            press.compress(count.tobytes()),
            int(count.sum()),
            int((count > 0).sum()),
            [c for c, _, _ in asked],
            [press.compress(o.tobytes()) for o in order],
        )

    def gather(batches):
        press, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        bucket, asked = None, []
        for batch in batches:
            rows = []
            for b, chunk, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    if asked:
                        rows.append(settle(bucket, asked, press))
                    bucket, asked = b, []
                asked.append((chunk, n, unpack.decompress(packed)))
            yield _batch("bucket words counts n v chunks places", kinds, rows)
        if asked:
            yield _batch("bucket words counts n v chunks places", kinds, [settle(bucket, asked, press)])

    return (
        cut.select("chunk", "held", "words")
        .mapInArrow(ask, "bucket int, chunk long, n int, words binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(
            gather,
            "bucket int, words binary, counts binary, n long, v long, chunks array<long>, places array<binary>",
        )
    )


def train_pieces(counted: DataFrame, vocabulary: Vocabulary, rounds: int, prior: float = 50.0) -> np.ndarray:
    """Natural-log weights of the pieces: ``rounds`` of expectation-maximisation over every different word learnt.

    A round sums the expected use of each piece over all buckets; its result has one number per piece.
    """
    spark = counted.sparkSession
    logp = np.log(vocabulary.prior)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, logp))

        def use(batches, shared=shared):
            vocabulary, logp = shared.value
            unpack = zstandard.ZstdDecompressor()
            total = np.zeros(len(logp))
            for batch in batches:
                for packed, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    seen = np.frombuffer(unpack.decompress(counts), np.int64) > 0
                    words = unpack.decompress(packed).split(b"\n")
                    words = [w for w, s in zip(words, seen.tolist(), strict=True) if s]
                    total += vocabulary.expected(words, np.ones(len(words)), logp)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

        summed = counted.select("words", "counts").mapInArrow(use, "piece long, n double")
        found = summed.groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        expected = prior * vocabulary.prior
        expected[found.piece.to_numpy()] += found.n.to_numpy()
        logp = np.log(expected / expected.sum())
        shared.unpersist()
    return logp


def score_texts(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: int = 2,
    rounds: int = 2,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``vocabulary`` is the path of an existing piece vocabulary with scores. A word's probability is its marginal
    over all segmentations into pieces, by the forward recursion in log space, plus one arc over the whole word if
    it was learnt: with c its count, N all and n the number of different learnt words, (c / N)(1 - e) + e * lattice,
    where e = n / (N + n) is left to new words (Witten-Bell). Pieces start with the vocabulary's scores and are
    re-estimated on all learnt words, every different one once, as new words come from there. ``score`` is log10
    of the product over the words and the end; ``base_score`` is the add-one unigram score over the same tokens.

    Words meet their counts without moving per occurrence: each chunk of documents asks for its different words
    once, buckets of words count and answer, and the answers meet the chunk again. Documents whose identifier has
    crc32 mod 7 equal to ``fold`` are not learnt from. A null or empty text has the end as its only token. Rows
    that repeat an identifier are scored each for itself. No other column is read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out(id_col, fold).alias("held"), F.col(text_col).cast("string").alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, round(size / bucket_bytes))
    cut = written(cut_chunks(texts), "lm-chunks")
    counted = written(count_words(cut, buckets), "lm-words")
    ends = cut.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    tokens, kinds = n + ends, v + (ends > 0)
    pieces = read_vocabulary(vocabulary)
    logp = train_pieces(counted, pieces, rounds)
    escape = (kinds + 1) / (tokens + kinds + 1)
    shared = spark.sparkContext.broadcast((pieces, logp))

    def answer(batches):
        vocabulary, logp = shared.value
        press, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            for bucket, packed, counts, chunks_, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = unpack.decompress(packed).split(b"\n")
                count = np.frombuffer(unpack.decompress(counts), np.int64)
                new = np.exp(vocabulary.log_probability(words, logp)) * escape
                value = np.log10(np.maximum(new + (1 - escape) * count / max(tokens, 1), 1e-300))
                tiny = new < 1e-290  # very long words: stay in logs
                if tiny.any():
                    some = [w for w, t in zip(words, tiny.tolist(), strict=True) if t]
                    alone = (vocabulary.log_probability(some, logp) + math.log(escape)) / math.log(10)
                    value[tiny] = np.where(count[tiny] > 0, value[tiny], alone)
                for chunk, packed_places in zip(chunks_, places, strict=True):
                    at = np.frombuffer(unpack.decompress(packed_places), np.uint32)
                    blob = press.compress(count[at].tobytes()) , press.compress(value[at].astype(np.float32).tobytes())
                    yield _batch(
                        "chunk bucket counts scores", [pa.int64(), pa.int32(), pa.binary(), pa.binary()], [(chunk, bucket, *blob)]
                    )

    log_end = math.log10((1 - escape) * ends / max(tokens, 1)) if ends else math.log10(escape)

    def finish(chunk: tuple, count: np.ndarray, value: np.ndarray, which: np.ndarray, first: np.ndarray):
        ids, held = chunk
        words = np.diff(first)
        owner = np.repeat(np.arange(len(words)), words)
        base = np.log10((count + 1) / (tokens + kinds + 1))
        sums = [np.bincount(owner, x[which], len(words)) for x in (count > 0, base, value)]
        base_end = math.log10((ends + 1) / (tokens + kinds + 1))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(held, pa.bool_()),
                pa.array(words + 1),
                pa.array(sums[0].astype(np.int64) + (ends > 0)),
                pa.array(np.full(len(words), tokens, np.int64)),
                pa.array(sums[1] + base_end),
                pa.array(sums[2] + log_end),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def combine(batches):
        unpack = zstandard.ZstdDecompressor()
        chunk = None
        for batch in batches:
            for bucket, ids, held, packed, counts, scores in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket < 0:
                    if chunk:
                        yield finish(chunk, count, value, which, first)
                    words = Words(unpack.decompress(packed).split(b"\n"))
                    of, _, which = _vocabulary_of(words, buckets)
                    edge, first, chunk = _edges(of), words.first, (ids, held)
                    span = {int(of[lo]): (int(lo), int(hi)) for lo, hi in zip(edge[:-1], edge[1:], strict=True)}
                    count, value = np.zeros(len(of), np.int64), np.zeros(len(of))
                else:
                    lo, hi = span[bucket]
                    count[lo:hi] = np.frombuffer(unpack.decompress(counts), np.int64)
                    value[lo:hi] = np.frombuffer(unpack.decompress(scores), np.float32)
        if chunk:
            yield finish(chunk, count, value, which, first)

    answers = counted.select("bucket", "words", "counts", "chunks", "places").mapInArrow(
        answer, "chunk long, bucket int, counts binary, scores binary"
    )
    asked = cut.withColumn("bucket", F.lit(-1))
    both = asked.unionByName(answers, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "bucket")
    return both.select("bucket", "ids", "held", "words", "counts", "scores").mapInArrow(
        combine,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
