"""Small tables and brute-force versions shared by the tests."""

from __future__ import annotations

import random
import zlib

#: Names that operators use inside; a table may have them as columns of its own.
CLASHES = ["node", "keep_id", "label", "row", "id", "keys", "text_sha256", "n_tokens", "bin", "salt", "sequence_id", "score"]


def table(spark, rows, clash: bool = True):
    """documents with (doc_id, text[, lang, source]) rows and, on request, extra columns with clashing names."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    extra = CLASHES if clash else []
    schema = "doc_id long, text string, lang string, source string" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in full], schema)


def messy(seed: int = 1, n: int = 60):
    """Copies in other case, near copies, nulls, empty, blank, repeated rows and a very long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    rows = [(i, text(rng.randrange(1, 120))) for i in range(n)]
    base = text(150)
    rows += [(100 + i, base) for i in range(6)] + [(110, base.upper()), (111, base.replace(" ", "\n  "))]
    for i in range(6):
        words = base.split()
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((120 + i, " ".join(words)))
    passage = text(40)
    rows += [(130 + i, f"{text(30)} {passage} {text(20)}") for i in range(6)]
    rows += [(140, None), (141, ""), (142, " \n\t "), (143, None), (None, text(30)), (None, None), (145, "é È Ünïcode ÀÉ")]
    rows += [(146, text(40_000)), rows[3], rows[3], (3, text(20))]
    return [(i, t, ["en", "de", None][k % 3], f"s{k % 4}") for k, (i, t) in enumerate(rows)]


def words_of(text):
    return (text or "").encode().split()


def in_fold(doc_id, folds, fold):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def jaccard_classes(texts, size: int = 5, least: float = 0.8):
    """Component (least index) of every text, linked by the plain Jaccard similarity of word shingles."""
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))))
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(sets))]
