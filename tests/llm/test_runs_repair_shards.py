"""Periodic runs, conversation repair and shards against brute force."""

import hashlib
import os
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from helpers import CLASHES, messy, table, words_of

from flowsieve.llm import periods, repair, shards
from flowsieve.session import scratch_path

sha = lambda b: hashlib.sha256(b).hexdigest()


def slow_runs(w):
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            stretch = w[i : j + q]
            if len(stretch) >= max(24, 3 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                out.append((i, len(stretch), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_document(doc_id, text):
    w = words_of(text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = slow_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = (None,) * 4
    if runs:
        s, n, q = min(runs, key=lambda r: (-(r[1] * 10**12 // r[2]), r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, sha(text.encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic(rng, n, letters):
    w = [str(rng.randrange(letters)) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n:
            a, p = rng.randrange(n), rng.randrange(1, max(2, n // rng.choice([2, 4, 20])))
            for i in range(a + p, min(n, a + rng.randrange(1, n + 1))):
                w[i] = w[i - p]
    return w


def test_z_values():
    rng = random.Random(2)
    for _ in range(500):
        s = [int(x) for x in periodic(rng, rng.randrange(1, 60), rng.choice([1, 2, 4]))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periods.z_values(np.array(s, np.int64)).tolist() == want


@pytest.mark.parametrize("far", [1 << 14, 64])
def test_periodic_runs(spark, far):
    """With a tiny ``far`` most octaves of the longer texts are solved in other tasks."""
    rng = random.Random(far)
    rows = [r for r in messy(n=40) if not r[1] or len(r[1]) < 10_000]
    rows += [(1000 + i, " ".join(periodic(rng, rng.randrange(0, 600), rng.choice([1, 2, 3, 40])))) for i in range(150)]
    rows += [(7, "x " * 900), (7, "x " * 900), (7, "y z " * 300)]
    got = [tuple(r) for r in periods.periodic_runs(table(spark, rows), far=far).collect()]
    assert Counter(got) == Counter(slow_document(r[0], r[1]) for r in rows)


def test_a_long_text_of_one_period(spark):
    rng = random.Random(3)
    unit = [str(rng.randrange(9)) for _ in range(7001)]
    words = (unit * 5)[:30_000]
    doc = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    row = periods.periodic_runs(table(spark, [(doc, " ".join(words))]), far=1 << 10).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 30_000, 7001, 4285)
    assert row.collapsed_sha256 == sha(" ".join(unit).encode())


def test_runs_of_an_empty_table(spark):
    assert periods.periodic_runs(table(spark, [])).count() == 0


# ---------------------------------------------------------------- conversations


def slow_edits(rows):
    """(cost, audit) of the cheapest repair of (role, text, must_go, truncated), by suffixes."""

    @lru_cache(None)
    def best(i, state, inserts):
        ways = [(0, "")] if i == len(rows) and state in "-A" else []
        target = "A" if state == "U" else "U"
        if inserts < 3:
            c, s = best(i, target, inserts + 1)
            ways.append((c + 2, "I" + s))
        if i < len(rows):
            role, _, must_go, cut = rows[i]
            c, s = best(i + 1, state, 0)
            ways.append((c + 3, "D" + s))
            if not must_go:
                c, s = best(i + 1, target, 0)
                ways.append((c + 2 + cut, "R" + s))
                if role[:1] == target.lower():
                    ways.append((c + cut, "K" + s))
                if role[:1] == "s" and state == "-":
                    c, s = best(i + 1, "S", 0)
                    ways.append((c + cut, "K" + s))
        return min(ways, default=(10**9, ""))

    return best(0, "-", 0)


def rewritten(rows, audit):
    length = sum(x != "D" for x in audit)
    roles = ["system"] * (length % 2) + ["user", "assistant"] * (length // 2)
    out, i = [], 0
    for x in audit:
        if x == "I":
            out.append(f"{roles[len(out)]}:")
            continue
        if x == "K":
            out.append(f"{rows[i][0]}:{rows[i][1]}")
        if x == "R":
            out.append(f"{roles[len(out)]}:{rows[i][1]}")
        i += 1
    return "\n".join(out)


def slow_repair(conv, rows):
    """rows: (turn, role, text) before damage."""
    after = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        slot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if slot == 1 else text.translate({ord(c): None for c in ".!?"}) if slot == 2 else text
        after += [(turn, "user" if slot == 4 else role, text)] * (0 if slot == 0 else 2 if slot == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, marked = set(), Counter(), []
    for _, role, text in after:
        said = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        faults[fault] += 1
        seen.add((role, text))
        marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
    turns = {t for t, _, _ in after if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[:1] for _, r, _ in after]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit = slow_edits(tuple(marked))
    return (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha(rewritten(marked, audit).encode()))


def conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string" + "".join(f", `{c}` string" for c in [*CLASHES, "conv", "copies", "kind"])
    return spark.createDataFrame([(*r, *["x"] * (len(CLASHES) + 3)) for r in rows], schema)


def some_turns(rng, conv):
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "cut", " ", "", None, "Why?", "é ü."]
    n = rng.randrange(1, 9)
    return [(conv, rng.choice([*range(9), None]) if rng.random() < 0.2 else t, rng.choices(roles, [6, 6, 3, 1, 1, 1])[0], rng.choice(texts)) for t in range(n)]


def test_conversation_repair(spark):
    rng = random.Random(11)
    rows = [r for c in range(300) for r in some_turns(rng, c)] + some_turns(rng, None)
    rows += [(500, t, "user", "Same words.") for t in range(40)] + [(501, None, "user", "Yes."), (501, None, "user", "Yes.")]
    got = {r.conv_id: tuple(r) for r in repair.repair(conversations(spark, rows)).collect()}
    by_conv = {}
    for conv, *rest in rows:
        by_conv.setdefault(conv, []).append(rest)
    assert len(got) == len(by_conv)
    for conv, own in by_conv.items():
        assert got[conv] == slow_repair(conv, own)


def test_everything_dropped(spark):
    conv = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repair(conversations(spark, [(conv, 0, "user", "Hello.")])).first()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", sha(b""))
    assert repair.repair(conversations(spark, [])).count() == 0


def test_search_is_exact_and_settles():
    rng = random.Random(4)
    for _ in range(300):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), "t", rng.random() < 0.3, 0) for _ in range(rng.randrange(0, 14))]
        rows = [(r, t, m, int(not m and rng.random() < 0.3)) for r, t, m, _ in rows]
        search = repair.Search()
        for r, t, m, c in rows:
            search.add(r, t, m, bool(c))
        assert (search.finish(), search.audit.decode()) == slow_edits(tuple(rows))
        assert search.repaired.hexdigest() == sha(rewritten(rows, search.audit.decode()).encode())


def test_a_long_conversation_stays_small():
    search, most = repair.Search(), 0
    rng = random.Random(8)
    for k in range(20_000):
        search.add(("user", "assistant")[k % 2] if rng.random() < 0.9 else "system", "t", rng.random() < 0.1, rng.random() < 0.1)
        most = max(most, search.pending())
    assert most < 60
    for _ in range(20_000):  # nothing to decide between, so nothing settles; steps stay cheap all the same
        search.add("user", "", True, False)
    assert len(search.audit) < search.finish() + 40_000


# ---------------------------------------------------------------- shards


@pytest.mark.parametrize("cell", [100_000, 7])
def test_shards(spark, cell):
    rows = messy(n=200) + [(900, "copy", "en", "s9")] * 150 + [(2000 + i, f"w{i}", "en", f"host{i}") for i in range(40)]
    rows += [(3000 + i, "w", None, None) for i in range(3)]
    docs = table(spark, rows)
    got = shards.interleaved(docs, rows_per_cell=cell).collect()
    size = lambda t: len((t or "").encode()) + 1
    crc = lambda t: zlib.crc32((t or "").encode())
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.source, r.size, r.text_crc32) for r in got], key=key) == sorted(
        [(i, s or "", size(t), crc(t)) for i, t, _, s in rows], key=key
    )
    many = Counter(r.shard for r in got)
    assert set(many) == set(range(8)) and max(many.values()) - min(many.values()) <= 1
    for shard, n in many.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    sources = Counter(r.source for r in got)
    for (source, _), n in Counter((r.source, r.shard) for r in got).items():
        assert abs(n - sources[source] / 8) <= 2
    again = shards.interleaved(docs.repartition(5), rows_per_cell=1000).collect()
    assert sorted([tuple(r) for r in again], key=key) == sorted([tuple(r) for r in got], key=key)


def test_shards_of_few_rows(spark):
    assert shards.interleaved(table(spark, [])).count() == 0
    got = shards.interleaved(table(spark, [(1, None), (2, "b")])).collect()
    assert sorted(r.slot for r in got) == [0, 0] and len({r.shard for r in got}) == 2


def test_written_shards(spark):
    folder = scratch_path(spark, "shards")
    rows = messy(n=30)
    shards.write_shards(table(spark, rows), folder, shards=3)
    back = spark.read.parquet(folder)
    assert back.count() == len(rows) and set(back.select("row.*").columns) >= {"doc_id", "text", *CLASHES}
    assert len([f for f in os.listdir(folder) if f.startswith("shard=")]) == 3
