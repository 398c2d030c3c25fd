"""Mixing, packing, search and licence scans."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import messy, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowsieve.llm import licences, mixing, packing, patterns, topk
from flowsieve.llm.queries import word_tokenizer
from flowsieve.session import written


def _cells(spark):
    rng = random.Random(1)
    rows = [(f"s{i}", f"l{j}", f"t{k}", 1 + rng.randrange(2000)) for i in range(4) for j in range(3) for k in range(2)]
    return spark.createDataFrame(rows, "m_source string, m_lang string, m_topic string, tokens long")


def test_raking_reaches_the_margins(spark):
    cells = _cells(spark)
    raked = mixing.rake(cells, (0.5, 0.5, 1.0), 12).toPandas()
    for margin, power in zip(("m_source", "m_lang", "m_topic"), (0.5, 0.5, 1.0), strict=True):
        goal = raked.groupby(margin).tokens.sum() ** power
        got = raked.groupby(margin).weight.sum()
        assert np.allclose(got, goal / goal.sum(), atol=1e-4)


def test_expected_tokens_meet_the_budget(spark):
    raked = written(mixing.rake(_cells(spark), (0.2, 0.2, 0.2), 2), "raked")
    for share in (0.1, 0.6, 0.95, 1.0):
        rows = raked.join(mixing.calibrate(raked, share), ["m_source", "m_lang", "m_topic"]).toPandas()
        assert rows.probability.between(0, 1).all() and len(rows) == 24
        assert (rows.probability * rows.tokens).sum() == pytest.approx(share * rows.tokens.sum())


def test_mixing_keeps_every_row(spark):
    data = messy(9)
    docs = table(spark, data)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(data) and all(0 <= r.probability <= 1 for r in rows)
    assert all(r.probability == 1 for r in rows if r.n_tokens == 0)
    assert {r.lang for r in rows} == {"en", "de", ""}
    kept = mixing.keep_sampled(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.sampled for r in rows)
    assert mixing.mix(table(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=32, max_size=32), st.integers(1, 4))
def test_a_plan_places_every_piece_once(counts, parts):
    histogram = np.array([0, *counts])
    found = patterns.plan(histogram, parts)
    placed = np.zeros_like(histogram)
    for pattern, repeats in found:
        assert sum(pattern) <= 32 and repeats > 0
        for b in pattern:
            placed[b] += repeats
    assert (placed == histogram).all()
    total = int((histogram * np.arange(33)).sum())
    assert sum(r for _, r in found) <= 2 * -(-total // 32) + 1


def test_patterns_are_all_partitions():
    rows = {tuple(x for x in p if x) for p in patterns.enumerate_patterns(12, 3).tolist()}
    want = {(12,)} | {(a, 12 - a) for a in range(6, 12)}
    want |= {(a, b, 12 - a - b) for a in range(12) for b in range(1, a + 1) if 0 < 12 - a - b <= b}
    assert rows == want


def test_non_negative_fit_is_exact_where_it_can_be():
    columns = patterns.enumerate_patterns(16, 3)
    truth = np.zeros(len(columns))
    truth[[0, 5, 9]] = 30, 7, 12
    wanted = np.zeros(17)
    for j, x in enumerate(truth):
        for b in columns[j]:
            wanted[b] += x * (b > 0)
    found = patterns.nnls(columns, wanted)
    got = np.zeros(17)
    for j, x in enumerate(found):
        for b in columns[j]:
            got[b] += x * (b > 0)
    assert found.min() >= 0 and np.allclose(got, wanted, atol=1e-4)


def test_packing(spark):
    from tokenizers import Tokenizer

    data = messy(2)
    rows = packing.pack(table(spark, data), word_tokenizer(), capacity=512, width=8, rows_per_salt=10).collect()
    tokenizer = Tokenizer.from_file(word_tokenizer())
    want = []
    for i, t, *_ in data:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 512)):
            part = ids[start : start + 512]
            want.append((i is None, i or 0, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= 1.2 * -(-sum(r.length for r in rows) // 512) + 1
    assert packing.pack(table(spark, []), word_tokenizer()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=40))
def test_tokens_are_those_of_the_tokenizer(text):
    from tokenizers import Tokenizer

    with open(word_tokenizer(), encoding="utf-8") as f:
        content = f.read()
    want = _plain(Tokenizer, content).encode(text, add_special_tokens=False).ids
    assert packing.encode([text], content)[0].tolist() == want


_KNOWN = {}


def _plain(kind, content):
    return _KNOWN.setdefault("t", kind.from_str(content))


@pytest.mark.parametrize("shards", [1, 5])
def test_search(spark, shards):
    rng = np.random.default_rng(shards)
    vectors = rng.normal(0, 0.2, (300, 16)).astype(np.float32)
    vectors[40:60] = vectors[40]  # ties
    rows = [(int(i), [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    rows += [(1000, None, 0), (1001, [0.1, None] * 8, 0), (1002, [float("nan")] * 16, 0), (1003, [float("inf")] * 16, 0)]
    rows += [(None, [9.0] * 16, 0), (7, [0.5] * 16, 0), (1010, [1.0, 1.0], 0), (1050, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query_id int")
    got = defaultdict(list)
    for r in topk.search(df, least_shards=shards, shard_rows=1000).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    usable = [(i, np.floor(256 * np.pad(np.array(v, np.float64), (0, 16 - len(v)))).astype(int)) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for own, q in usable:
        if own % 50 == 0:
            best = sorted(((-int(q @ v), i) for i, v in usable if i != own))[:5]
            assert sorted(got.pop(own)) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert not got


def test_search_with_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.search(df).collect()] == [(0, 1, 3, 256 * 512)]
    assert topk.search(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=30), st.lists(st.sampled_from("abcdefgh"), max_size=30))
def test_patience_aligns_equal_words_in_order(a, b):
    pairs = licences.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
    if a == b:
        assert len(pairs) == len(a)


def test_licence_places(spark):
    notice = licences.NOTICES["mit"]
    changed = notice.replace("charge", "cost").replace("merge, ", "")
    data = [
        (1, f"some words before. {notice} and after"),
        (2, f"x {changed} y"),
        (3, "Released under the MIT License.\nReleased under the MIT License."),
        (4, "the license of the work is under the version"),
        (5, None),
        (6, ""),
        (None, "RELEASED UNDER THE MIT LICENSE"),
        (7, "word " * 50_000 + "Licensed under CC BY-NC 4.0."),
    ]
    rows = [tuple(r) for r in licences.scan(table(spark, data)).collect()]
    found = {(r[0], r[1], r[3]): r[2] for r in rows}
    assert found[(1, "mit", 3)] == 1.0 and 0.95 < found[(2, "mit", 1)] < 1
    assert found[(3, "mit-short", 0)] == found[(3, "mit-short", 5)] == 1.0
    assert found[(None, "mit-short", 0)] == 1.0 and found[(7, "cc-by-nc-4.0-short", 50_000)] == 1.0
    assert {r[0] for r in rows} == {1, 2, 3, 7, None}
    assert licences.scan(table(spark, [])).count() == 0


def test_every_planted_notice_is_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    line = F.col("text").rlike("Licensed under CC BY-NC 4.0|Released under the MIT License|Licensed under the Apache License, Version 2.0")
    planted = {r.doc_id for r in docs.filter(line).select("doc_id").collect()}
    assert planted and planted <= {r.doc_id for r in licences.scan(docs).collect()}
