"""Periodic runs of words: tiles per octave of periods, boundary Z-functions, fragments stitched by document and period."""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.words import canonical, chunks, mix, slices
from flowsieve.session import written

#: A run has at least this many words, and this many times its period.
LEAST_WORDS, LEAST_TIMES = 24, 3
#: Equal words on one side of a boundary that make a tile worth solving; a run always has them.
_HINT = 8
#: Tiles up to this reach are solved side by side, longer ones one by one.
_SIDE_BY_SIDE = 64
_FRAGMENT = "struct<period:long,lo:long,hi:long>"
_TILE = "struct<octave:int,anchor:long,first:long,codes:binary>"
_SOLVED = (
    f"doc_id long, key binary, plain string, fragments array<{_FRAGMENT}>, tiles array<{_TILE}>, packed binary"
)
_RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def reach_of(octave: int) -> int:
    """Words that a tile of periods 2**octave to 2**(octave+1)-1 sees on each side of its boundary.

    Also the distance of the boundaries: where words that are one period apart are equal, they are so for twice
    the period and for 16 words at least, so every run crosses a boundary of its octave.
    """
    return max(2 << octave, 16)


def _agree(s: np.ndarray, i: int, j: int) -> int:
    """How many words agree from ``i`` and from ``j`` on (``i < j``)."""
    n, done, step = len(s) - j, 0, 16
    while done < n:
        stop = min(done + step, n)
        same = s[i + done : i + stop] == s[j + done : j + stop]
        first = int(same.argmin())
        if not same[first]:
            return done + first
        done, step = stop, step * 4
    return n


def z_values(s: np.ndarray) -> np.ndarray:
    """How many words from each place on agree with the beginning of ``s``.

    The usual box is filled in pieces: what lies inside is copied up to the first place that touches the end of
    the box, and whenever a place reaches that end, the box begins there, so that pieces double in periodic words.
    """
    n = len(s)
    z = np.zeros(n, np.int64)
    if not n:
        return z
    z[0] = n
    starts = np.flatnonzero(s[1:] == s[0]) + 1
    z[starts] = 1
    if n > 2:
        starts = starts[starts < n - 1]
        starts = starts[s[starts + 1] == s[1]]
    k = 0
    while k < len(starts):
        left = int(starts[k])
        z[left] = _agree(s, 0, left)
        right = left + int(z[left])
        place = left + 1
        while place < right:
            stop = min(right, place + left)
            rest = right - np.arange(place, stop)
            inner = z[place - left : stop - left]
            touching = np.flatnonzero(inner == rest) if right < n else rest[:0]
            filled = int(touching[0]) if len(touching) else stop - place
            z[place : place + filled] = np.minimum(inner, rest)[:filled]
            reaching = np.flatnonzero(inner[:filled] >= rest[:filled])
            if len(touching):
                left = place + filled
                z[left] = right - left + _agree(s, right - left, right)
                place, right = left + 1, left + int(z[left])
            else:
                if len(reaching):
                    left = place + int(reaching[-1])
                place = stop
        k = int(np.searchsorted(starts, max(right, int(starts[k]) + 1)))
    return z


@lru_cache(8)
def _smallest_factor(n: int) -> np.ndarray:
    """The smallest prime factor of every number below ``n``."""
    found = np.arange(n)
    for p in range(2, int(n**0.5) + 1):
        if found[p] == p:
            multiples = np.arange(p * p, n, p)
            found[multiples] = np.where(found[multiples] == multiples, p, found[multiples])
    return found


def _needed(period: np.ndarray) -> np.ndarray:
    """How long words one period apart must agree for a run."""
    return np.maximum(LEAST_WORDS, LEAST_TIMES * period) - period


def solve_tile(codes: np.ndarray, anchor: int, octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, back, ahead): where words one period apart agree around the boundary, for primitive periods.

    ``codes`` are the words around ``codes[anchor]``, up to one reach before and two after. One Z-function of the
    words after the boundary and one of the reversed words before it give both lengths for every period at once.
    A length that fills the reach is kept, as the neighbouring tile goes on there.
    """
    reach = reach_of(octave)
    after = codes[anchor : anchor + 2 * reach]
    ahead = z_values(after)
    period = np.arange(1 << octave, min(2 << octave, len(after)))
    before = codes[max(0, anchor - reach) : anchor][::-1]
    both = codes[max(0, anchor - reach) : anchor + min(reach, len(after))][::-1]
    back = z_values(np.concatenate([before, [np.iinfo(np.int64).min], both]))[len(before) + 1 :]
    n_after = min(reach, len(after))

    def behind(p: np.ndarray) -> np.ndarray:
        return back[n_after - p] if len(before) else np.zeros(len(p), np.int64)

    here, there = np.minimum(ahead[period], reach), behind(period)
    kept = (here > 0) & ((here + there >= _needed(period)) | (here == reach) | (there == reach))
    period, here, there = period[kept], here[kept], there[kept]
    primitive, rest, factor = np.ones(len(period), bool), period.copy(), _smallest_factor(2 << octave)
    while (rest > 1).any():
        prime = np.where(rest > 1, factor[rest], 1)
        part = period // prime
        agrees = np.where(here >= period, ahead[part], behind(part)) >= period
        primitive &= ~((rest > 1) & agrees)
        rest = rest // prime
    return period[primitive], there[primitive], here[primitive]


def _side_by_side(words: np.ndarray, anchor: np.ndarray, period: np.ndarray, octave: int) -> tuple[np.ndarray, ...]:
    """(anchor, period, back, ahead) as ``solve_tile``, for many short tiles at once.

    ``words`` has a number of its own between two texts, where every comparison ends.
    """
    reach = reach_of(octave)
    ahead, back = np.zeros(len(anchor), np.int64), np.zeros(len(anchor), np.int64)
    for count, one, other, step in ((ahead, anchor, anchor + period, 1), (back, anchor - 1, anchor + period - 1, -1)):
        active = np.arange(len(anchor))
        for k in range(reach):
            active = active[words[one[active] + k * step] == words[other[active] + k * step]]
            if not len(active):
                break
            count[active] += 1
    kept = (ahead > 0) & ((ahead + back >= _needed(period)) | (ahead == reach) | (back == reach))
    anchor, period, back, ahead = anchor[kept], period[kept], back[kept], ahead[kept]
    primitive, rest, factor = np.ones(len(period), bool), period.copy(), _smallest_factor(2 << octave)
    place = np.arange(2 << octave)[None, :]
    while (rest > 1).any():
        prime = np.where(rest > 1, factor[rest], 1)
        some = np.flatnonzero((rest > 1) & primitive)
        low = (anchor - back)[some, None] + place
        inside = place < period[some, None]
        shifted = low + (period // prime)[some, None]
        last = len(words) - 1
        agrees = (words[np.minimum(low, last)] == words[np.minimum(shifted, last)]) | ~inside
        primitive[some[agrees.all(axis=1)]] = False
        rest = rest // prime
    return anchor[primitive], period[primitive], back[primitive], ahead[primitive]


def _tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the part that is made periodic, for one document in ten."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    first = (h // 10) % n
    return first, 1 + (n - first) // (3 + (h // 10) % 8)


class Texts:
    """Word numbers of some canonical texts in one array; a negative number of its own follows each text."""

    def __init__(self, texts: list[bytes], tails: list[tuple[int, int] | None]):
        size = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
        data = b" ".join(t for t in texts if t) + b" "
        self.size, self.first = size, np.cumsum(size + 1) - size - 1
        self.words = np.empty(int(size.sum()) + len(texts), np.int64)
        self.words[self.first + size] = -1 - np.arange(len(texts))
        total = int(size.sum())
        if total:
            stop = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
            offsets = np.concatenate([[0], stop]).astype(np.int64)
            spelled = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), total, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
            )
            codes = pc.dictionary_encode(spelled).indices.to_numpy().astype(np.int64)
            self.words[np.arange(total) + np.repeat(np.arange(len(texts)), size)] = codes
        for k, tail in enumerate(tails):
            if tail and size[k]:
                a, stop = self.first[k] + tail[0], self.first[k] + size[k]
                self.words[a:stop] = self.words[a + np.arange(stop - a) % tail[1]]

    def hints(self) -> np.ndarray:
        """A hash of the next 8 words from each place; texts end in a number that no other window has."""
        h = np.concatenate([mix(self.words.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), np.zeros(_HINT, np.uint64)])
        for step in (1, 2, 4):
            h[:-step] = mix(h[:-step] * np.uint64(0xD6E8FEB86659FD93) + h[step:])
        return h[: len(self.words)]


def _fragments(texts: Texts, far: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(rows of text, period, lo, hi) found here, and (text, octave, boundary) of tiles that reach beyond ``far``.

    A boundary's tile is solved only if 8 words before or after it are repeated one period of the octave later.
    """
    hint, found, left = texts.hints(), [], []
    last = len(texts.words) - 1
    for octave in range(int(texts.size.max(initial=0)).bit_length()):
        reach, least = reach_of(octave), max(LEAST_WORDS, LEAST_TIMES << octave)
        long = np.flatnonzero(texts.size >= least)
        if not len(long):
            break
        many = -(-(texts.size[long] - (1 << octave)) // reach)
        text = np.repeat(long, many)
        anchor = texts.first[text] + reach * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))
        for low in range(0, len(anchor), max(1, (1 << 18) >> octave)):
            some = slice(low, low + max(1, (1 << 18) >> octave))
            at = anchor[some]
            later = np.minimum(at[:, None] + np.arange(1 << octave, 2 << octave)[None, :], last)
            before = np.maximum(at - _HINT, 0)
            alike = (hint[later] == hint[at][:, None]) | (hint[later - _HINT] == hint[before][:, None])
            if reach <= _SIDE_BY_SIDE:
                row, column = np.nonzero(alike & (at[:, None] + np.arange(1 << octave, 2 << octave)[None, :] <= last))
                a, q, back, ahead = _side_by_side(texts.words, at[row], column + (1 << octave), octave)
                owner = np.searchsorted(texts.first, a, side="right") - 1
                found.append(np.stack([owner, q, a - back, a + ahead], axis=1))
                continue
            for i in np.flatnonzero(alike.any(axis=1)).tolist():
                k, place = int(text[some][i]), int(at[i])
                if reach > far:
                    left.append((k, octave, place))
                    continue
                begin, end = max(texts.first[k], place - reach), min(texts.first[k] + texts.size[k], place + 2 * reach)
                q, back, ahead = solve_tile(texts.words[begin:end], place - begin, octave)
                if len(q):
                    found.append(np.stack([np.full(len(q), k), q, place - back, place + ahead], axis=1))
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    return _joined(rows), left


def _joined(rows: np.ndarray) -> np.ndarray:
    """Rows (text, period, lo, hi) with touching intervals of one text and period put together."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1) | (rows[1:, 2] > rows[:-1, 3])
    first = np.flatnonzero(new)
    out = rows[first]
    out[:, 3] = np.maximum.reduceat(rows[:, 3], first)
    return out


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _solved(docs: DataFrame, far: int) -> DataFrame:
    """One row per document: the digest of its words if nothing in it repeats, else fragments, open tiles and words."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, 1):
            ids, raw = batch.column(0).to_pylist(), [canonical(t) for t in batch.column(1).to_pylist()]
            out = []
            for i, j in chunks(raw):
                tails = [_tail(d, t.count(b" ") + 1 if t else 0) for d, t in zip(ids[i:j], raw[i:j], strict=True)]
                texts = Texts(raw[i:j], tails)
                found, left = _fragments(texts, far)
                bounds = np.searchsorted(found[:, 0], np.arange(j - i + 1))
                tiles: dict[int, list] = {}
                for k, octave, place in left:
                    begin = max(texts.first[k], place - reach_of(octave))
                    end = min(texts.first[k] + texts.size[k], place + 2 * reach_of(octave))
                    codes = pack.compress(texts.words[begin:end].astype("<i4").tobytes())
                    base = int(texts.first[k])
                    tiles.setdefault(k, []).append((octave, place - base, int(begin) - base, codes))
                for k in range(j - i):
                    words, base = raw[i + k], int(texts.first[k])
                    if tails[k]:
                        parts = words.split(b" ")
                        a, p = tails[k]
                        words = b" ".join(parts[:a] + [parts[a + x % p] for x in range(len(parts) - a)])
                    own = found[bounds[k] : bounds[k + 1], 1:] - np.array([0, base, base])
                    key = hashlib.blake2b(f"{ids[i + k]}:".encode() + raw[i + k], digest_size=16).digest()
                    some = len(own) > 0 or k in tiles
                    out.append(
                        (
                            ids[i + k], key, None if some else _hex(words),
                            [dict(zip(("period", "lo", "hi"), x, strict=True)) for x in own.tolist()] if some else None,
                            [dict(zip(("octave", "anchor", "first", "codes"), x, strict=True)) for x in tiles.get(k, [])] if some else None,
                            pack.compress(words) if some else None,
                        )
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[k] for r in out], kind)
                    for k, kind in enumerate(
                        (
                            pa.int64(), pa.binary(), pa.string(),
                            pa.list_(pa.struct({"period": pa.int64(), "lo": pa.int64(), "hi": pa.int64()})),
                            pa.list_(pa.struct({"octave": pa.int32(), "anchor": pa.int64(), "first": pa.int64(), "codes": pa.binary()})),
                            pa.binary(),
                        )
                    )
                ],
                names=["doc_id", "key", "plain", "fragments", "tiles", "packed"],
            )

    return docs.mapInArrow(run, _SOLVED)


def _from_tiles(tiles: DataFrame) -> DataFrame:
    """(key, period, lo, hi) of the tiles that were dealt to other tasks."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for key, octave, anchor, first, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = np.frombuffer(unpack.decompress(codes), "<i4").astype(np.int64)
                q, back, ahead = solve_tile(words, anchor - first, octave)
                out += [(key, *x) for x in zip(q.tolist(), (anchor - back).tolist(), (anchor + ahead).tolist(), strict=True)]
            kinds = pa.binary(), pa.int64(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["key", "period", "lo", "hi"]
            )

    return tiles.mapInArrow(run, "key binary, period long, lo long, hi long")


def stitch(fragments: DataFrame) -> DataFrame:
    """Runs (key, period, start, length) of fragments (key, period, lo, hi): touching intervals are one."""
    ordered = Window.partitionBy("key", "period").orderBy("lo", "hi")
    earlier = F.max("hi").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = fragments.withColumn("new", (F.coalesce(earlier, F.lit(-1)) < F.col("lo")).cast("int"))
    whole = begins.withColumn("run", F.sum("new").over(ordered)).groupBy("key", "period", "run").agg(
        F.min("lo").alias("start"), (F.max("hi") - F.min("lo") + F.col("period")).alias("length")
    )
    enough = F.greatest(F.lit(LEAST_WORDS), F.col("period") * LEAST_TIMES)
    return whole.filter(F.col("length") >= enough).select("key", "period", "start", "length")


def _digests(rows: DataFrame) -> DataFrame:
    """Result rows of (doc_id, packed, runs)."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, packed, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = unpack.decompress(packed)
                runs = sorted((r["start"], r["period"], r["length"]) for r in found or [])
                if not runs:
                    out.append((doc, 0, None, None, None, None, _hex(b""), _hex(words)))
                    continue
                parts = words.split(b" ")
                gone = np.zeros(len(parts) + 1, np.int64)
                for start, period, length in runs:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
                start, period, length = runs[0]
                for s, p, n in runs[1:]:
                    if n * period > length * p:
                        start, period, length = s, p, n
                text = "".join(f"{s},{n},{p}\n" for s, p, n in runs)
                out.append(
                    (doc, len(runs), start, length, period, 1000 * length // period, _hex(text.encode()),
                     _hex(b" ".join([parts[i] for i in kept])))
                )
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)

    return rows.mapInArrow(run, _RESULT)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", far: int = 1 << 14) -> DataFrame:
    """One row per input row: doc_id, n_runs, the run of greatest length / period (start, length, period,
    exponent_milli = 1000 * length / period rounded down; ties: least start, then period), and digests of all runs
    and of the words that are left when each run keeps only its first period.

    A run is a stretch of words with smallest period q, of 24 words and 3 q at least, that no neighbouring word
    extends. One document in ten is first made periodic from some word on, by the hash of its identifier.

    Each octave of periods has tiles around boundaries that every run of the octave crosses. A tile is solved by two
    Z-functions, apart from all others: where the text is read, or, if it reaches over more than ``far`` words, in
    whatever task it is dealt to. What comes out are intervals; they are shuffled by document and period and touching
    ones are put together. Texts without intervals are never shuffled.

    A null or blank text has no words and no run; a null identifier leaves the text as it is. Rows that repeat an
    identifier and its words have the same result each; rows that repeat only the identifier are apart. No column
    but the two named is read. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    solved = written(_solved(texts, far), "period-fragments")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    none = [F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")]
    plain = solved.filter("plain is not null").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *none, nothing.alias("runs_sha256"), F.col("plain").alias("collapsed_sha256")
    )
    marked = solved.filter("plain is null")
    distinct = marked.select("key", "fragments", "tiles").dropDuplicates(["key"])
    dealt = distinct.select("key", F.inline("tiles")).repartition("key", "octave", "anchor")
    pieces = distinct.select("key", F.inline("fragments")).unionByName(_from_tiles(dealt))
    runs = stitch(pieces).groupBy("key").agg(F.collect_list(F.struct("start", "period", "length")).alias("runs"))
    return plain.unionByName(_digests(marked.select("key", "doc_id", "packed").join(runs, "key", "left").select("doc_id", "packed", "runs")))
