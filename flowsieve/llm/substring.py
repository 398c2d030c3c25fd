"""Substring deduplication: super-k-mers of words, dealt to buckets by their minimiser."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.words import Words, canonical, chunks, mix, slices

_STEP = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 3 << 19
_NONE = np.iinfo(np.int64).max
#: Words of the second, longer gram that deals the windows of a hot minimiser.
_LONGER = 6
_RANGE = "bucket int, doc long, part long, first int, last int"


def _runs_of(values: np.ndarray, size: int, shift: int = 1) -> np.ndarray:
    """Hash of the ``size`` values from each place on; places too near the end hold rubbish."""
    out = np.zeros(len(values), np.uint64)
    for k in range(size):
        out *= _STEP
        out[: len(values) - k] += values[k:] if k else values
    return mix(out)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each place on (fewer at the end)."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _least(words: Words, window: int, minimiser: int) -> np.ndarray:
    """The least hash among the ``minimiser``-grams of the window from each word on.

    Short grams come last: the frequent ones are short, and would gather too many windows in their bucket.
    """
    n = len(words)
    gram = _runs_of(words.hash, minimiser) >> np.uint64(1)
    length = np.full(n, 1 << 30, np.int64)
    length[: n - minimiser + 1] = words.end[minimiser - 1 :] - words.start[: n - minimiser + 1]
    gram |= (length < 4 * minimiser).astype(np.uint64) << np.uint64(63)
    return _sliding_min(gram, window - minimiser + 1)


def _slots(key: np.ndarray, slots: int) -> np.ndarray:
    return (mix(key + np.uint64(1)) % np.uint64(slots)).astype(np.int64)


def super_kmers(
    words: Words, window: int, minimiser: int, hot: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word + 1, key) of each run of windows in one text that share their key.

    The key of a window is its minimiser, the least hash among its word ``minimiser``-grams. ``hot`` marks the slots
    of frequent minimisers, and of frequent longer grams: a window with a hot minimiser has its least longer gram as
    key, and if that is hot too, the hash of all its words. Equal windows have the same key in every text.
    """
    n = len(words)
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, empty, empty.astype(np.uint64)
    least = _least(words, window, minimiser)
    if hot is not None and hot[0].any():
        second = _least(words, window, min(_LONGER, window))
        whole = hot[1][_slots(second, len(hot[1]))]
        second = np.where(whole, _runs_of(words.hash, window), second)
        least = np.where(hot[0][_slots(least, len(hot[0]))], second, least)
    per = np.diff(words.first)
    left = np.repeat(words.first[1:], per) - np.arange(n)  # words from here to the end of the text
    valid = left >= window
    opens = valid.copy()
    opens[1:] &= (least[1:] != least[:-1]) | ~valid[:-1] | (left[1:] > left[:-1])
    start = np.flatnonzero(opens)
    ends = valid.copy()
    ends[:-1] &= opens[1:] | ~valid[1:]
    return start, np.flatnonzero(ends) + window, least[start]


def _cut(words: Words, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some word ranges one after the other, each closed by a newline, and their lengths."""
    raw = np.frombuffer(words.data, np.uint8)
    begin, size = words.start[first], words.end[last - 1] + 1 - words.start[first]
    stop = np.cumsum(size)
    # places within a chunk are small numbers; there are three times as many as the chunk has bytes
    total = int(stop[-1]) if len(stop) else 0
    kind = np.int32 if total < 1 << 31 else np.int64
    place = np.arange(total, dtype=kind)
    place += np.repeat((begin - (stop - size)).astype(kind), size)
    out = raw[place]
    out[stop - 1] = 10
    return out, size


def _pack(texts: list[bytes], docs: np.ndarray, parts: np.ndarray, window: int, minimiser: int, buckets: int, hot: tuple | None = None):
    """(ranges, blobs) of one chunk: word ranges already known to be repeated, and what goes to each bucket.

    Of equal super-k-mers in the chunk only those of the smallest document travel; the others are repeated by it.
    """
    words = Words(texts)
    first, last, least = super_kmers(words, window, minimiser, hot)
    if not len(first):
        return [], []
    owner = words.owner()[first]
    offset = words.first[:-1][owner]
    raw = np.frombuffer(words.data, np.uint8)
    size = words.end[last - 1] - words.start[first]
    # equal super-k-mers: by a hash over their words, then byte by byte
    steps = np.concatenate([[np.uint64(0)], np.cumsum(words.hash * _odd(np.arange(len(words))))])
    content = mix((steps[last] - steps[first]) * _odd_inverse(first) + size.astype(np.uint64))
    order = np.lexsort((docs[owner], content))
    same = np.concatenate([[False], content[order][1:] == content[order][:-1]])
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    drop = np.zeros(len(first), bool)
    for k in np.flatnonzero(same):
        i, j = order[k], lead[k]
        if docs[owner[i]] > docs[owner[j]] and size[i] == size[j]:
            a, b = words.start[first[i]], words.start[first[j]]
            drop[i] = np.array_equal(raw[a : a + size[i]], raw[b : b + size[j]])
    ranges = [
        (docs[owner[i]], parts[owner[i]], first[i] - offset[i], last[i] - offset[i]) for i in np.flatnonzero(drop)
    ]
    sent = np.flatnonzero(~drop)
    bucket = (mix(least[sent]) % np.uint64(buckets)).astype(np.int64)
    sent = sent[np.argsort(bucket, kind="stable")]
    bucket = np.sort(bucket, kind="stable")
    payload, length = _cut(words, first[sent], last[sent])
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(sent) else np.zeros(1, int)
    at = np.concatenate([[0], np.cumsum(length)])
    press = zstandard.ZstdCompressor(level=3)
    blobs = []
    for lo, hi in zip(edge[:-1], edge[1:], strict=True):
        which = sent[lo:hi]
        used, local = np.unique(owner[which], return_inverse=True)
        head = np.array([len(which), len(used)], np.int32).tobytes()
        columns = (docs[used], parts[used].astype(np.uint32), local.astype(np.uint32), (first[which] - offset[which]).astype(np.uint32))
        blob = head + b"".join(_planes(c) for c in columns) + payload[at[lo] : at[hi]].tobytes()
        blobs.append((int(bucket[lo]), press.compress(blob)))
    return ranges, blobs


_ODD = 0x9E3779B97F4A7C15


def _odd(i: np.ndarray) -> np.ndarray:
    return _powers(_ODD, i)


def _odd_inverse(i: np.ndarray) -> np.ndarray:
    return _powers(pow(_ODD, -1, 1 << 64), i)


def _powers(base: int, exponent: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2**64."""
    out, square, rest = np.ones(len(exponent), np.uint64), base, exponent.copy()
    while rest.any():
        out = np.where(rest & 1, out * np.uint64(square), out)
        square, rest = square * square % (1 << 64), rest >> 1
    return out


def _planes(column: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: small and slowly changing numbers compress well so."""
    return column.view(np.uint8).reshape(len(column), -1).T.tobytes()


def _unpack(blob: bytes):
    runs, used = np.frombuffer(blob, np.int32, 2)
    at, out = 8, []
    for kind, n in ((np.int64, used), (np.uint32, used), (np.uint32, runs), (np.uint32, runs)):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * width
    docs, parts, local, first = out
    return docs[local], parts[local], first, blob[at:]


def _repeated(blobs: list[bytes], window: int) -> tuple:
    """(doc, part, first, last) word ranges of a bucket whose windows also start in a smaller document."""
    docs, parts, place, pages = [], [], [], []
    value, run, start, page = [], [], [], []  # of every window; start: its first word in its page
    runs = 0
    for i, j in chunks(blobs):  # the words of a page are in memory only while it is hashed
        unpacked = [_unpack(b) for b in blobs[i:j]]
        words = Words([line for u in unpacked for line in u[3].split(b"\n")[:-1]])
        owner = words.owner()
        inside = np.arange(len(words)) - words.first[:-1][owner]
        at = np.flatnonzero(np.diff(words.first)[owner] - inside >= window)
        value.append(_runs_of(words.hash, window)[at])
        run.append(owner[at] + runs)
        start.append(at)
        page.append(np.full(len(at), len(pages)))
        pages.append((words.data, words.start.astype(np.int32), words.end.astype(np.int32)))
        place.append(np.concatenate([u[2] for u in unpacked]).astype(np.int64) - words.first[:-1])
        docs += [u[0] for u in unpacked]
        parts += [u[1] for u in unpacked]
        runs += len(words.first) - 1
    docs, parts, place = np.concatenate(docs), np.concatenate(parts), np.concatenate(place)
    value, run, start, page = (np.concatenate(x) for x in (value, run, start, page))

    def spelled(k: int) -> bytes:
        data, begin, end = pages[page[k]]
        return data[begin[start[k]] : end[start[k] + window - 1]]

    order = np.argsort(value, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], value[order][1:] != value[order][:-1]]))
    count = np.diff(np.append(edge, len(order)))
    doc = docs[run]
    least = np.minimum.reduceat(doc[order], edge)
    most = np.maximum.reduceat(doc[order], edge)
    hit = np.zeros(len(start), bool)
    # windows are equal when their bytes are: a group whose hashes agree by chance is taken apart
    for g in np.flatnonzero(most > least):
        members = order[edge[g] : edge[g] + count[g]]
        texts = [spelled(k) for k in members]
        if any(t != texts[0] for t in texts):
            for text in set(texts):
                of_text = members[[t == text for t in texts]]
                hit[of_text] = doc[of_text] > doc[of_text].min()
        else:
            hit[members] = doc[members] > least[g]
    at = np.flatnonzero(hit)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    begins = np.concatenate([[True], (np.diff(start[at]) != 1) | (np.diff(run[at]) != 0)])
    lo = at[begins]
    hi = at[np.append(np.flatnonzero(begins)[1:] - 1, len(at) - 1)]
    base = place[run[lo]]  # the run's place in its document, less its place in the page
    return docs[run[lo]], parts[run[lo]].astype(np.int64), start[lo] + base, start[hi] + window + base


def hot_slots(texts: DataFrame, window: int, minimiser: int, slots: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For minimisers and for longer grams: the slots whose super-k-mers have more than ``most`` bytes.

    One row per slot and task is shuffled; the driver gets the hot ones only.
    """
    sizes = (minimiser, min(_LONGER, window))

    def count(batches):
        total = np.zeros((len(sizes), slots), np.int64)
        for batch in slices(batches, 0, 2 * _CHUNK):
            texts = [canonical(t) for t in batch.column(0).to_pylist()]
            for i, j in chunks(texts, _CHUNK):
                words = Words(texts[i:j])
                for k, size in enumerate(sizes):
                    first, last, key = super_kmers(words, window, size)
                    if len(first):
                        length = words.end[last - 1] + 1 - words.start[first]
                        total[k] += np.bincount(_slots(key, slots), length, slots).astype(np.int64)
        kind, slot = np.nonzero(total)
        for k in range(0, len(slot), 1 << 16):
            at = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[at].astype(np.int32)), pa.array(slot[at]), pa.array(total[kind[at], slot[at]])],
                names=["kind", "slot", "bytes"],
            )

    counted = texts.select("text").mapInArrow(count, "kind int, slot long, bytes long")
    found = counted.groupBy("kind", "slot").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") > most)
    hot = np.zeros((len(sizes), slots), bool)
    for r in found.select("kind", "slot").collect():
        hot[r.kind, r.slot] = True
    return hot[0], hot[1]


def dealt(texts: DataFrame, window: int, minimiser: int, bucket_bytes: int) -> DataFrame:
    """Per batch and bucket the packed super-k-mers, and the ranges already known to be repeated."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, round(3 * total / bucket_bytes))
    # a bucket holds four slots on average, none of which alone may be as large as a bucket is meant to be
    hot = hot_slots(texts, window, minimiser, 4 * buckets, bucket_bytes)
    shared = texts.sparkSession.sparkContext.broadcast(hot)

    def deal(batches):
        for batch in slices(batches, 1, 2 * _CHUNK):
            docs = batch.column(0).fill_null(_NONE).to_numpy(zero_copy_only=False)
            words = [canonical(t) for t in batch.column(1).to_pylist()]
            parts = np.array([zlib.crc32(w) for w in words], np.int64)
            for i, j in chunks(words, _CHUNK):
                ranges, blobs = _pack(words[i:j], docs[i:j], parts[i:j], window, minimiser, buckets, shared.value)
                packed = [None] * len(ranges) + [b for _, b in blobs]
                bucket = [zlib.crc32(int(r[0]).to_bytes(8, "little")) % buckets for r in ranges] + [k for k, _ in blobs]
                columns = [[int(r[c]) for r in ranges] + [None] * len(blobs) for c in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket, pa.int32()),
                        *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["bucket", "doc", "part", "first", "last", "packed"],
                )

    return texts.select("doc_id", "text").mapInArrow(deal, f"{_RANGE}, packed binary")


def repeated_ranges(texts: DataFrame, window: int, minimiser: int, bucket_bytes: int) -> DataFrame:
    """(doc, part, first, last): the word ranges of each document that repeat a smaller document's windows."""

    def settle(batches):
        unpack = zstandard.ZstdDecompressor()
        bucket, blobs = None, []
        for batch in batches:
            out = [[], [], [], []]
            columns = [c.to_pylist() for c in batch.columns]
            for b, doc, part, first, last, packed in zip(*columns, strict=True):
                if b != bucket:
                    if blobs:
                        for o, x in zip(out, _repeated(blobs, window), strict=True):
                            o.extend(x.tolist())
                    bucket, blobs = b, []
                if packed is None:
                    for o, x in zip(out, (doc, part, first, last), strict=True):
                        o.append(x)
                else:
                    blobs.append(unpack.decompress(packed))
            yield _ranges(out)
        if blobs:
            yield _ranges([x.tolist() for x in _repeated(blobs, window)])

    return (
        dealt(texts, window, minimiser, bucket_bytes)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(settle, "doc long, part long, first int, last int")
    )


def _ranges(columns: list) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32()
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc", "part", "first", "last"]
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 13,
    minimiser: int = 2,
    bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (zstd of the kept words), kept_sha256.

    A word goes when a window of ``window`` words over it also starts in a document with a smaller identifier.
    Consecutive windows with the same minimiser travel as one packed string to the bucket of that minimiser; there
    the windows are sorted, and equal ones are found by their bytes. Of equal strings in one batch of documents
    only the smallest document's travels, so a passage that a third of all documents share reaches its bucket once
    per batch. The number of buckets follows the input, about ``bucket_bytes`` each. The bytes of each minimiser are
    counted first: windows of a frequent one are dealt by a longer gram, or by all their words.

    A null or empty text has no words. A null identifier counts as larger than any other, and not as smaller than
    another null. Rows that repeat an identifier are judged each for itself. No column but the two named is read.
    An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranges = (
        repeated_ranges(texts, window, minimiser, bucket_bytes)
        .groupBy("doc", "part")
        .agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    )

    def packed(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, 1):
            words = [canonical(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(0).fill_null(_NONE),
                    pa.array([zlib.crc32(w) for w in words], pa.int64()),
                    pa.array([press.compress(w) for w in words]),
                ],
                names=["doc_id", "doc", "part", "words"],
            )

    def cut(batches):
        press, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            ids, texts, first, last = (batch.column(i).to_pylist() for i in range(4))
            words_n, removed, kept_texts, digests = [], [], [], []
            for text, lo, hi in zip(texts, first, last, strict=True):
                words = unpack.decompress(text).split()
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, lo or [], 1)
                np.add.at(cover, hi or [], -1)
                gone = np.cumsum(cover)[:-1] > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if lo else b" ".join(words)
                words_n.append(len(words))
                removed.append(int(gone.sum()))
                kept_texts.append(press.compress(kept))
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words_n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept_texts), pa.array(digests)],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    sources = texts.mapInArrow(packed, "doc_id long, doc long, part long, words binary")
    joined = sources.join(ranges, ["doc", "part"], "left").select("doc_id", "words", "first", "last")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string")
