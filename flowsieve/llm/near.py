"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.links import components
from flowsieve.llm.words import Words, canonical, chunks, mix, slices
from flowsieve.session import written

#: Document frequencies are kept in this many rows of this many counters, whatever the size of the corpus.
SKETCH_ROWS, SKETCH_SLOTS = 4, 1 << 14
#: A shingle in more than half of all documents has level 0, one in at most 1/32 of them has the last level.
LEVELS = 5
_TABLE_BITS = 16
#: Texts are worked on in pieces of about this many bytes: two workers of an executor hold such a piece, many times over.
_CHUNK = 1 << 18


def weighted_shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, times) of every different shingle, ordered by text."""
    owner, shingle = words.shingles(size)
    key = (owner.astype(np.uint64) << np.uint64(44)) | (shingle >> np.uint64(20))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return owner[order][first], shingle[order][first], np.diff(np.append(first, len(key)))


def _slots(shingle: np.ndarray, row: int) -> np.ndarray:
    return (mix(shingle + np.uint64(row * 0x632BE59BD9B4E019 % (1 << 64))) >> np.uint64(64 - 14)).astype(np.int64)


def frequency_sketch(texts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """(counters, documents): in how many documents each slot's shingles occur, counted over all documents.

    Every task adds up its own counters; the sums have SKETCH_ROWS * SKETCH_SLOTS numbers at any scale.
    """

    def count(batches):
        total, docs = np.zeros((SKETCH_ROWS, SKETCH_SLOTS), np.int64), 0
        for batch in slices(batches, 0, 4 * _CHUNK):
            texts = [canonical(t) for t in batch.column(0).to_pylist()]
            docs += len(texts)
            for i, j in chunks(texts, _CHUNK):
                _, shingle, _ = weighted_shingles(Words(texts[i:j]), size)
                for row in range(SKETCH_ROWS):
                    total[row] += np.bincount(_slots(shingle, row), minlength=SKETCH_SLOTS)
        flat = total.ravel()
        slot = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(slot, -1)), pa.array(np.append(flat[slot], docs))], names=["slot", "n"]
        )

    summed = texts.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = summed.toPandas()
    counters = np.zeros(SKETCH_ROWS * SKETCH_SLOTS)
    known = found[found.slot >= 0]
    counters[known.slot.to_numpy()] = known.n.to_numpy()
    return counters.reshape(SKETCH_ROWS, SKETCH_SLOTS), int(found.n[found.slot < 0].sum())


class Weights:
    """TF-IDF weights of shingles and their samples; small enough to travel with the tasks."""

    def __init__(self, counters: np.ndarray, documents: int, size: int, span: float, hashes: int):
        background = np.median(counters, axis=1, keepdims=True)
        self.share = (np.maximum(counters - background, 0) / max(documents, 1)).astype(np.float32)
        self.size, self.span, self.hashes = size, span, hashes

    def levels(self, shingle: np.ndarray) -> np.ndarray:
        share = np.minimum.reduce([self.share[row][_slots(shingle, row)] for row in range(SKETCH_ROWS)])
        return np.clip(np.floor(-np.log2(np.maximum(share, 1e-9))), 0, LEVELS).astype(np.int64)

    def weigh(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash, weight): a shingle's times in the text, times 1 to 1 + span by its rarity."""
        owner, shingle, times = weighted_shingles(words, self.size)
        return owner, shingle, times * (1 + self.span * self.levels(shingle) / LEVELS)

    def weigh_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``weigh`` of texts of any size together, a piece at a time."""
        parts = []
        for i, j in chunks(texts, _CHUNK):
            owner, shingle, weight = self.weigh(Words(texts[i:j]))
            parts.append((owner + i, shingle, weight))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def signatures(self, words: Words) -> np.ndarray:
        """Improved consistent weighted samples, one row per text; rows of texts without words are zero.

        Of each shingle's weight w, with r and c from Gamma(2, 1) and b from [0, 1): t = floor(ln w / r + b) and
        ln a = ln c - r (t - b + 1). The least a, with its shingle, is the sample. r, c and b come from a table
        that the shingle's hash points into, so that every weight has one table of ready values of a.
        """
        texts = len(words.first) - 1
        out = np.zeros((texts, self.hashes), np.uint64)
        owner, shingle, weight = self.weigh(words)
        if not len(owner):
            return out
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        low = shingle & np.uint64(0xFFFFFFFF)
        values, kind, many = np.unique(weight, return_inverse=True, return_counts=True)
        usual = int(many.argmax())
        others = [(k, np.flatnonzero(kind == k)) for k in range(len(values)) if k != usual]
        for j in range(self.hashes):
            cell = (mix_step(shingle, j) >> np.uint64(64 - _TABLE_BITS)).astype(np.int32)
            sample = _samples(float(values[usual]))[cell]
            for k, where in others:
                sample[where] = _samples(float(values[k]))[cell[where]]
            out[owner[first], j] = np.minimum.reduceat((sample.astype(np.uint64) << np.uint64(32)) | low, first)
        return out


def mix_step(shingle: np.ndarray, j: int) -> np.ndarray:
    """Hash number j of already mixed hashes: a multiplication by an odd number of its own."""
    odd = int(mix(np.array([j * 2 + 1], np.uint64))[0]) | 1
    return shingle * np.uint64(odd)


@lru_cache(64)
def _samples(weight: float) -> np.ndarray:
    """ln a of every table cell for one weight, as a 32-bit number that has the same order."""
    draw = np.random.default_rng(7)
    cells = 1 << _TABLE_BITS
    r, c, b = draw.gamma(2, 1, cells), draw.gamma(2, 1, cells), draw.random(cells)
    t = np.floor(np.log(weight) / r + b)
    bits = (np.log(c) - r * (t - b + 1)).astype(np.float32).view(np.int32).astype(np.int64)
    ordered = np.where(bits < 0, (~bits) & 0xFFFFFFFF, bits | 0x80000000)
    return ordered.astype(np.uint32)


def _digest(words: bytes) -> bytes:
    return hashlib.sha256(words).digest()[:16]


def sign(texts: DataFrame, weights: Weights, bands: int) -> DataFrame:
    """(doc_id, node, keys): a digest of the document's words, and one key per band."""
    rows = weights.hashes // bands
    shared = texts.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in slices(batches, 1, 4 * _CHUNK):
            words = [canonical(t) for t in batch.column(1).to_pylist()]
            keys = []
            for i, j in chunks(words, _CHUNK):
                signature = shared.value.signatures(Words(words[i:j])).reshape(j - i, bands, rows)
                key = np.arange(bands, dtype=np.uint64)[None, :]
                for k in range(rows):
                    key = mix(key + signature[:, :, k])
                keys.extend(k.tolist() if w else None for k, w in zip(key.view(np.int64), words[i:j], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([_digest(w) for w in words], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "node", "keys"],
            )

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, node binary, keys array<long>")


def _packed(texts: DataFrame) -> DataFrame:
    """(node, packed): the words of a document, compressed for the shuffle."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, 0, 4 * _CHUNK):
            words = [canonical(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(w) for w in words], pa.binary()), pa.array([pack.compress(w) for w in words])],
                names=["node", "packed"],
            )

    return texts.select("text").mapInArrow(run, "node binary, packed binary")


def _near_first(texts: list[bytes], weights: Weights, threshold: float) -> np.ndarray:
    """Which of the other texts are similar enough to the first one."""
    owner, shingle, weight = weights.weigh_all(texts)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    total = np.add.reduceat(weight, first[:-1])
    order = np.argsort(shingle[: first[1]])
    own, own_weight = shingle[order], weight[order]
    place = np.minimum(np.searchsorted(own, shingle), len(own) - 1)
    same = np.where(own[place] == shingle, np.minimum(own_weight[place], weight), 0.0)
    shared = np.add.reduceat(same, first[:-1])
    return np.flatnonzero((shared >= threshold * (total + total[0] - shared))[1:])


def verify(pairs: DataFrame, packed: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """The pairs (a, b) whose whole texts have at least this weighted Jaccard similarity."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)
    left = packed.select(F.col("node").alias("a"), F.col("packed").alias("text_a"))
    right = packed.select(F.col("node").alias("b"), F.col("packed").alias("text_b"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
            near = []
            start = 0
            while start < len(a):  # rows with the same b stand together
                end, size = start, 0
                while end < len(a) and b[end] == b[start] and size < _CHUNK:
                    size += zstandard.frame_content_size(text_a[end])
                    end += 1
                texts = [unpack.decompress(t) for t in (text_b[start], *text_a[start:end])]
                near += [start + i for i in _near_first(texts, shared.value, threshold)]
                start = end
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for i in near], pa.binary()) for x in (a, b)], names=["a", "b"]
            )

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a binary, b binary")


def verify_blocks(
    named: DataFrame, packed: DataFrame, weights: Weights, threshold: float, block: int
) -> DataFrame:
    """Links (a, b) that join the labels inside each bucket of ``named`` (key, node, label).

    The members that do not have the bucket's commonest label (left) meet all members (right). Both sides are cut
    into blocks by node, and a task holds one left and one right block; a small bucket is one such pair.
    """
    per_label = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    open_keys = (
        per_label.groupBy("key")
        .agg(
            F.max_by("label", F.struct("n", "label")).alias("major"),
            F.sum("n").alias("n"),
            (F.sum("n") - F.max("n")).alias("m"),
        )
        .filter("m > 0")
        .select("key", "major", F.ceil(F.col("n") / block).alias("right"), F.ceil(F.col("m") / block).alias("left"))
    )
    rows = named.join(open_keys, "key").withColumns(
        {
            "minor": F.col("label") != F.col("major"),
            "own_right": F.pmod(F.xxhash64("node"), F.col("right")),
            "own_left": F.pmod(F.xxhash64("node", F.lit(1)), F.col("left")),
        }
    )
    as_right = F.transform(
        F.sequence(F.lit(0), F.col("left") - 1),
        lambda i: F.struct(
            i.alias("i"), F.col("own_right").alias("j"), (F.col("minor") & (i == F.col("own_left"))).alias("l"), F.lit(True).alias("r")
        ),
    )
    as_left = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("right") - 1), lambda j: F.col("minor") & (j != F.col("own_right"))),
        lambda j: F.struct(F.col("own_left").alias("i"), j.alias("j"), F.lit(True).alias("l"), F.lit(False).alias("r")),
    )
    dealt = rows.select("key", "node", "label", F.explode(F.concat(as_right, as_left)).alias("e")).select(
        F.xxhash64("key", "e.i", "e.j").alias("task"), "key", F.col("e.i").alias("i"), F.col("e.j").alias("j"),
        F.col("e.l").alias("l"), F.col("e.r").alias("r"), "label", "node",
    )
    together = (
        dealt.join(packed, "node")
        .repartition("task")
        .sortWithinPartitions("task", "key", "i", "j")
        .select("task", "key", "i", "j", "l", "r", "label", "node", "packed")
    )
    shared = named.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in _same_group(batch):
                if held and _group(held[0]) != _group(part):
                    yield _links_of(held, shared.value, threshold, unpack)
                    held = []
                held.append(part)
        if held:
            yield _links_of(held, shared.value, threshold, unpack)

    return together.mapInArrow(run, "a binary, b binary").distinct()


def _group(batch: pa.RecordBatch) -> tuple:
    return tuple(batch.column(k)[0].as_py() for k in range(4))


def _same_group(batch: pa.RecordBatch):
    """Slices of a batch whose rows agree in the first four columns."""
    if not batch.num_rows:
        return
    keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
    edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(low, high - low)


def _links_of(held: list[pa.RecordBatch], weights: Weights, threshold: float, unpack: zstandard.ZstdDecompressor) -> pa.RecordBatch:
    """Links of one block pair that connect its labels: no more of them than labels, as what is connected stays so.

    Columns: four of the group, left, right, label, node, packed. Every left text that still has another class to
    meet is compared with all right texts.
    """
    column = [pa.concat_arrays([b.column(k) for b in held]) for k in range(4, 9)]
    left, is_right = (column[k].to_numpy(zero_copy_only=False) for k in (0, 1))
    names, label = np.unique(np.array(column[2].to_pylist(), object), return_inverse=True)
    owner, shingle, weight = weights.weigh_all([unpack.decompress(p.as_py()) for p in column[4]])
    which, code = np.unique(shingle, return_inverse=True)
    first = np.searchsorted(owner, np.arange(len(left) + 1))
    total = np.add.reduceat(weight, first[:-1])
    top, line = np.arange(len(names)), np.zeros(len(which))  # top: the class that a label belongs to by now
    a, b = [], []
    for x in np.flatnonzero(left).tolist():
        other = is_right & (top[label] != top[label[x]])
        if not other.any():
            continue
        own = slice(first[x], first[x + 1])
        line[code[own]] = weight[own]
        shared = np.add.reduceat(np.minimum(line[code], weight), first[:-1])
        line[code[own]] = 0
        for y in np.flatnonzero(other & (shared >= threshold * (total + total[x] - shared))).tolist():
            one, two = top[label[x]], top[label[y]]
            if one != two:
                top[top == two] = one
                a.append(x)
                b.append(y)
    node = column[3]
    ends = [node.take(pa.array(k, pa.int64())).to_pylist() for k in (a, b)]
    pairs = [(min(p), max(p)) for p in zip(*ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _named(table: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``table`` (key, node) with the label of each node: its own name where it has no link yet."""
    if labels is None:
        return table.withColumn("label", F.col("node"))
    return table.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    bands: int = 16,
    rows: int = 4,
    idf_span: float = 0.25,
    rounds: int = 2,
    block: int = 256,
    report: Callable[[str, int], None] | None = None,
) -> DataFrame:
    """One row per input row: doc_id, node (digest of its words), class_id (least doc_id of its class), class_size,
    and kept (true for the document that has the least doc_id of its class).

    Two documents are linked when the weighted Jaccard similarity of their word shingles is at least ``threshold``;
    a class is what links connect. The weight of a shingle is its count in the document times 1 to 1 + ``idf_span``
    by its rarity; the span is narrow on purpose, as a wide one would let the many copies of one text make their
    own shingles worthless. Documents of the same words are one node. Nodes that share one of ``bands`` keys of
    ``rows`` samples are candidates: a pair at 0.8 is missed with a chance of 2e-4.

    A bucket of candidates never yields all its pairs. In each of ``rounds`` rounds, one member of each bucket,
    another one each time, is compared with the members that are not yet in its class. After them, the members
    outside the largest class of a bucket are compared with every member, in blocks of ``block`` texts. Of the links of
    a block only those come out that join two classes, so none is lost and a block yields fewer links than labels.

    A null text has no words; all documents without words are one class. A null identifier is never a class_id
    unless the class has no other. Rows that repeat an identifier and its words are one document. No column but
    the two named is read. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counters, documents = frequency_sketch(texts, shingle)
    weights = Weights(counters, documents, shingle, idf_span, bands * rows)
    signed = written(sign(texts, weights, bands), "near-signed")
    nodes = signed.groupBy("node").agg(F.first("keys").alias("keys"))
    entries = written(nodes.select("node", F.explode("keys").alias("key")), "near-entries")
    shared = entries.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    members = written(entries.join(shared.select("key"), "key"), "near-members")
    packed = written(
        _packed(texts).join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]),
        "near-texts",
    )

    labels = None
    for turn in range(rounds + 1):
        named = _named(members, labels)
        order = F.xxhash64("node", F.lit(turn))
        open_keys = (
            named.groupBy("key")
            .agg(
                F.min("label").alias("lo"),
                F.max("label").alias("hi"),
                F.min(F.struct(order.alias("o"), F.col("node"), F.col("label"))).alias("lead"),
            )
            .filter("lo < hi")
        )
        if turn < rounds:
            pairs = named.join(open_keys.select("key", "lead"), "key").filter(F.col("label") != F.col("lead.label"))
            ends = F.col("node"), F.col("lead.node")
            pairs = pairs.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
            links = written(verify(pairs, packed, weights, threshold), "near-links")
        else:
            links = written(verify_blocks(named, packed, weights, threshold, block), "near-links")
        if report:
            report(f"links {turn}", links.count())
        labels = _merged(labels, links)

    final = _named(signed.select("doc_id", "node"), labels)
    lead = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    classes = final.groupBy("label").agg(F.min(lead).alias("lead"), F.count(F.lit(1)).alias("class_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("node") == F.col("lead.node"))
    return final.join(classes, "label").select(
        "doc_id", "node", F.col("lead.doc_id").alias("class_id"), "class_size", kept.alias("kept")
    )


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links: the old classes are the nodes that the links connect."""
    if labels is None:
        return written(components(links), "near-labels")
    short = labels.withColumnRenamed("label", "l")
    ends = (
        links.join(short.withColumnRenamed("node", "a"), "a", "left")
        .select(F.coalesce("l", "a").alias("a"), "b")
        .join(short.withColumnRenamed("node", "b"), "b", "left")
        .select("a", F.coalesce("l", "b").alias("b"))
        .filter("a != b")
        .distinct()
    )
    found = components(ends).select(F.col("node").alias("old"), F.col("label").alias("new"))
    every = labels.unionByName(found.select(F.col("old").alias("node"), F.col("old").alias("label"))).groupBy("node").agg(
        F.max(F.struct((F.col("node") != F.col("label")).alias("moved"), F.col("label"))).alias("s")
    )
    every = every.select("node", F.col("s.label").alias("old"))
    return written(
        every.join(found, "old", "left").select("node", F.coalesce("new", "old").alias("label")), "near-labels"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document represents its class (the least identifier), with all their columns."""
    kept = near_classes(docs, id_col, text_col, **options).filter("kept").select(
        F.col("doc_id").alias("keep_doc"), F.col("node").alias("keep_node")
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("doc"),
        node_of(F.col(text_col)).alias("node"),
    )
    same = F.col("doc").eqNullSafe(F.col("keep_doc")) & (F.col("node") == F.col("keep_node"))
    return rows.join(kept, same, "left_semi").select("row.*")


def node_of(text: Column) -> Column:
    """The digest of a text's words, as in ``sign``, without Python."""
    words = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.unhex(F.substring(F.sha2(words.cast("binary"), 256), 1, 32))
