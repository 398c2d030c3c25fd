"""Exact, substring and near deduplication against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import jaccard_classes, messy, table, words_of

from flowsieve.llm import exact, near, substring
from flowsieve.llm.words import Words, canonical


def _fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.mark.parametrize(("keep", "rows", "size"), [("smallest", 2000, 1 << 20), ("largest", 2, 1 << 20), ("largest", 2000, 400)])
def test_content_sort(spark, keep, rows, size):
    """Also with copies cut into pieces of two rows or 400 bytes."""
    data = messy()
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups[_fold(t)].append(i)
    found = exact.content_sort(table(spark, data), keep=keep, piece_rows=rows, piece_bytes=size).collect()
    assert len(found) == len(data)
    best = max if keep == "largest" else min
    kept = defaultdict(int)
    for r in found:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = digest[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (best(known) if known else None, len(ids))
        assert not r.kept or r.doc_id == r.keep_id


def test_keep_distinct_returns_whole_rows(spark):
    docs = table(spark, messy())
    kept = exact.keep_distinct(docs)
    assert kept.columns == docs.columns
    assert sorted(_fold(r.text) for r in kept.collect()) == sorted({_fold(t) for _, t, *_ in messy()})


def test_lower_ascii_only(spark):
    df = spark.createDataFrame([("ABCxyzÀÉİΣ ß",), ("PLAIN",)], "t string")
    assert [r[0] for r in df.select(exact.lower_ascii(df.t)).collect()] == ["abcxyzÀÉİΣ ß", "plain"]


def _brute_repeats(data, window):
    least = {}
    for i, t, *_ in data:
        w = words_of(t)
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            least[run] = min(least.get(run, np.inf), np.inf if i is None else i)
    out = []
    for i, t, *_ in data:
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < (np.inf if i is None else i):
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize(("window", "minimiser", "bucket"), [(13, 2, 8 << 20), (4, 2, 2000), (5, 3, 500)])
def test_substrings(spark, window, minimiser, bucket):
    data = [*messy(), *[(500 + i, "a b " * (3 * i)) for i in range(4)], (7, "one two three"), (-5, messy()[61][1])]
    found = substring.remove_repeats(table(spark, data), window=window, minimiser=minimiser, bucket_bytes=bucket)
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()]
    assert _sorted(rows) == _sorted(_brute_repeats(data, window))


def _filled_lines(n=240):
    """A line with a varying number in a third of all documents, on both sides of it words that never vary."""
    rng = random.Random(9)
    words = lambda k: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(k))
    before, after = words(10), words(10)
    return [(i, f"{words(40)} {before} {rng.randrange(60)} {after} {words(5)}" if i % 3 == 0 else words(60)) for i in range(n)]


def test_substrings_of_a_line_with_fill_in(spark):
    data = _filled_lines()
    found = substring.remove_repeats(table(spark, data), bucket_bytes=1500)
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()]
    assert _sorted(rows) == _sorted(_brute_repeats(data, 13))


def test_a_frequent_minimiser_is_dealt_again(spark):
    texts = table(spark, _filled_lines()).select("doc_id", "text").coalesce(1)
    split = lambda most: substring.hot_slots(texts, 13, 2, 400, most)
    hot = split(1500)
    assert hot[0].any() and not split(1 << 40)[0].any()
    lines = [t.encode() for _, t in _filled_lines()]
    words = Words(lines)

    def largest(hot):
        first, last, key = substring.super_kmers(words, 13, 2, hot)
        _, where = np.unique(key, return_inverse=True)
        distinct = {}  # equal strings of one batch travel once
        for k, a, b in zip(where, first, last, strict=True):
            distinct.setdefault(k, set()).add(words.data[words.start[a] : words.end[b - 1]])
        return max(sum(len(x) for x in d) for d in distinct.values())

    assert largest(hot) < largest(None) / 2


def test_hot_keys_cover_every_window_once():
    words = Words([t.encode() for _, t in _filled_lines()])
    hot = np.arange(64) % 2 == 0, np.arange(64) % 3 == 0
    first, last, _ = substring.super_kmers(words, 13, 2, hot)
    seen = sorted(s for a, b in zip(first, last, strict=True) for s in range(a, b - 12))
    owner = words.owner()
    assert seen == [s for s in range(len(words) - 12) if owner[s] == owner[s + 12]]


def test_super_kmers_cover_every_window_once():
    rng = random.Random(2)
    texts = [b" ".join(rng.choice([b"a", b"bb", b"cccc", b"dddddd"]) for _ in range(k)) for k in (0, 5, 13, 14, 200)]
    words = Words(texts)
    first, last, _ = substring.super_kmers(words, 13, 2)
    seen = sorted(s for a, b in zip(first, last, strict=True) for s in range(a, b - 12))
    owner = words.owner()
    assert seen == [s for s in range(len(words) - 12) if owner[s] == owner[s + 12]]


def test_near_classes(spark):
    data = messy(3)
    found = near.near_classes(table(spark, data), block=4, rounds=1).collect()
    assert len(found) == len(data)
    truth, mine = jaccard_classes([" ".join(x.decode() for x in words_of(t)) for _, t, *_ in data]), {}
    by_id = defaultdict(set)
    for (i, t, *_), c in zip(data, truth, strict=True):
        by_id[(i, near._digest(canonical(t)))].add(c)
    for r in found:
        mine.setdefault((r.class_id, r.class_size), set()).update(by_id[(r.doc_id, bytes(r.node))])
    sizes = defaultdict(int)
    for c in truth:
        sizes[c] += 1
    assert all(len(c) == 1 for c in mine.values())
    assert sorted(sizes[next(iter(c))] for c in mine.values()) == sorted(size for _, size in mine)
    assert len({(r.doc_id, bytes(r.node)) for r in found if r.kept}) == len(sizes)


def test_keep_one_per_class(spark):
    docs = table(spark, messy(3))
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    classes = jaccard_classes([t for _, t in rows])
    distinct = {(i, tuple(words_of(t))) for i, t in rows}
    assert len({classes[k] for k in range(len(rows))}) == len(distinct)


def test_samples_estimate_the_weighted_similarity():
    rng = random.Random(5)
    a = [f"w{rng.randrange(400)}" for _ in range(300)]
    b = a[:240] + [f"v{rng.randrange(400)}" for _ in range(60)]
    weights = near.Weights(np.zeros((near.SKETCH_ROWS, near.SKETCH_SLOTS)), 10, 1, 0.25, 512)
    words = Words([" ".join(a).encode(), " ".join(b).encode(), b"alone"])
    signature = weights.signatures(words)
    owner, shingle, weight = weights.weigh(words)
    one, two = (dict(zip(shingle[owner == k].tolist(), weight[owner == k].tolist(), strict=True)) for k in (0, 1))
    truth = sum(min(one.get(k, 0), two.get(k, 0)) for k in one | two) / sum(max(one.get(k, 0), two.get(k, 0)) for k in one | two)
    assert abs((signature[0] == signature[1]).mean() - truth) < 0.08
    assert (signature[0] == signature[2]).mean() < 0.02


def test_empty_tables(spark):
    none = table(spark, [])
    assert exact.content_sort(none).count() == 0
    assert substring.remove_repeats(none).count() == 0
    assert near.near_classes(none).count() == 0
