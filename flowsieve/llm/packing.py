"""Best-fit packing of tokenised documents into sequences, by patterns of lengths."""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.patterns import plan
from flowsieve.llm.words import held, slices
from flowsieve.session import lookup_join, written

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Parts whose ids a worker remembers, twice at most; a speed-up only.
_REMEMBERED = 120_000
_LATIN = [chr(i) for i in range(33, 256) if i < 127 or i > 160]


def _class(kinds: str) -> str:
    return "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] in kinds)


#: How byte-level tokenizers part lower-cased Latin-1 text.
_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[{_class('MPSCZ')}]+")
_PLAIN = re.compile(f"[{_class('LNMPSCZ')} \t-\r]*")
_WORD = re.compile(r"[^ \t-\r]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for those from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Remembered(dict):
    """Token ids of words, four little-endian bytes each; what is asked for often outlasts what is not."""

    def __init__(self, find):
        self.find, self.older = find, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _REMEMBERED:
            self.older = dict(self)
            self.clear()
        out = self.older.get(word)
        if out is None:
            ids = self.find(word)
            out = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = out
        return out


class _Encoder:
    """A tokenizer that drops white space, asked once for each different word, or for each part of plain words."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(content)
        tokenize = whole.model.tokenize
        self.words = _Remembered(lambda word: whole.encode(word, add_special_tokens=False).ids)
        self.parts = _Remembered(
            lambda part: [t.id for t in tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(_LETTERS))]
        )
        probe = "Don't \u00c9T\u00c9s' 'LL 12\u00bd3, x2y (a-b)!? caf\u00e9\u00ae na\u00efve It'S \u00dfTra\u00dfe '' 0.5"
        self.alike = True
        self.alike = self.ids(probe) == np.array(whole.encode(probe, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if self.alike and _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.parts.__getitem__, _PART.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, _WORD.findall(text)))


def _encoder(content: str) -> _Encoder:
    """The encoder that this worker keeps while it encodes."""
    known = held("encoder")
    if content not in known:
        known.clear()
        known[content] = _Encoder(content)
    return known[content]


def encode(texts: list, content: str) -> list[np.ndarray]:
    """Token ids of texts (null: none)."""
    encoder = _encoder(content)
    return [np.frombuffer(encoder.ids(t or ""), "<u4") for t in texts]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): every document's tokens and ``end_id``, cut at capacity.

    ``tokenizer`` is the path of a tokenizer file that ignores white space between words. The driver reads it once.
    Latin-1 texts are parted here, if a probe shows that the tokenizer parts them alike; it gets other words whole.
    """
    small_batches(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        for batch in slices(batches, 1):
            docs, out = batch.column(0).to_pylist(), []
            for doc, ids in zip(docs, encode(batch.column(1).to_pylist(), content.value), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    row = (doc, piece, start, len(part), zlib.crc32(part.tobytes()))
                    out.append((*row, part.tolist()) if with_ids else row)
            columns = list(zip(*out, strict=True)) or [[]] * (5 + with_ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=False)], names=names[: len(columns)]
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, _PIECES + (", ids array<long>" if with_ids else ""))


def assign(pieces: DataFrame, capacity: int, width: int, parts: int, rows_per_salt: int) -> DataFrame:
    """``pieces`` with sequence_id and offset. Needs a written table: it is read more than once.

    Only the histogram of lengths, in bins of ``width`` tokens rounded up, comes to the driver. The plan there says
    how often each pattern of bins is used. A piece's rank in its bin, a row number per salt plus the counts of
    the salts before, tells its pattern, repeat and place; a running sum per sequence gives the offset.
    """
    spark = pieces.sparkSession
    salts = max(16, -(-pieces.count() // rows_per_salt))
    binned = pieces.withColumn("bin", F.ceil(F.col("length") / width).cast("int")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")
    )
    counts = written(binned.groupBy("bin", "salt").agg(F.count(F.lit(1)).alias("n")), "bin-counts")
    histogram = np.zeros(capacity // width + 1, np.int64)
    for row in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        histogram[row.bin] = row.n

    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken, sequence = np.zeros(len(histogram), np.int64), 0
    for pattern, repeats in plan(histogram, parts):
        for place, b in enumerate(pattern):
            slots.setdefault(b, []).append((int(taken[b]), sequence - int(taken[b]), place))
            taken[b] += repeats
        sequence += repeats
    kinds = {"bin": pa.int32(), "ranks": pa.list_(pa.int64()), "shift": pa.list_(pa.int64()), "places": pa.list_(pa.int32())}
    rows = [(b, *(list(c) for c in zip(*rows, strict=True))) for b, rows in slots.items()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())]
    table = spark.createDataFrame(pa.table(columns, names=list(kinds)))  # of Python rows, executors would start more workers

    before = Window.partitionBy("bin").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bin", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bin", "salt").orderBy("doc_id", "piece", "ids_crc32", "start", "length")
    ranked = lookup_join(binned.withColumn("row", F.row_number().over(inside) - 1), offsets, ["bin", "salt"])
    found = ranked.join(F.broadcast(table), "bin").withColumn("rank", F.col("base") + F.col("row"))
    found = found.withColumn("slot", F.size(F.filter("ranks", lambda r: r <= F.col("rank"))))
    placed = found.withColumn("sequence_id", F.col("rank") + F.element_at("shift", F.col("slot"))).withColumn(
        "place", F.element_at("places", F.col("slot"))
    )
    earlier = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    return placed.select(*pieces.columns, "sequence_id", "offset")


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    width: int = 8,
    parts: int = 3,
    end_id: int = 1,
    rows_per_salt: int = 200_000,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its token ids and ``end_id``; only a longer one is cut, into pieces of ``capacity``. Patterns of
    up to ``parts`` lengths that fill a sequence are fitted to the histogram of lengths by non-negative least
    squares, the counts are rounded down, and residual pieces are packed best fit on the histogram.

    A null or empty text is ``end_id`` alone. Rows that repeat an identifier, or have none, are packed each for
    itself. No column but the two named is read. An empty table gives no rows.
    """
    if capacity % width:
        raise ValueError("width divides capacity")
    pieces = written(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return assign(pieces, capacity, width, parts, rows_per_salt)
