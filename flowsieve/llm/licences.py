"""Licence scans: patience alignment of texts with licence notices."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.words import Words, chunks, slices

_ALNUM = bytes(i if i > 127 or chr(i).isalnum() else 32 for i in range(256))

# The wording of public licence notices.
NOTICES = {
    "mit-short": "Released under the MIT License.",
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def spelled(text: str | None) -> bytes:
    """Lower-cased words of letters and digits, joined by one space."""
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_ALNUM).split())


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs (place in a, place in b) of an alignment: words unique in both are anchors, the longest increasing
    run of them is kept, and the gaps between are aligned the same way; ends that agree are matched directly."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        tails, ends, back = [], [], []  # least last place of a run of each length, its anchor, the anchor before
        for k, (_, j) in enumerate(anchors):
            at = bisect_left(tails, j)
            tails[at : at + 1], ends[at : at + 1] = [j], [k]
            back.append(ends[at - 1] if at else -1)
        chain, k = [], ends[-1] if ends else -1
        while k >= 0:
            chain.append(anchors[k])
            k = back[k]
        if not chain:
            continue
        chain.reverse()
        out += chain
        edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Scanner:
    """The notices, as word numbers."""

    def __init__(self, notices: dict[str, str], coverage: float, slack: float):
        self.coverage = coverage
        self.notices = [(name, spelled(text).split()) for name, text in notices.items()]
        self.notices = [(name, words) for name, words in self.notices if words]
        self.window = [len(words) + int(np.ceil(slack * len(words))) for _, words in self.notices]
        known = Words([b" ".join(words) for _, words in self.notices])
        self.hashes = np.unique(known.hash)
        self.member = np.zeros((len(self.notices), len(self.hashes) + 1), bool)
        self.member[known.owner(), np.searchsorted(self.hashes, known.hash)] = True

    def scan(self, texts: list[bytes]) -> list[tuple]:
        """(text, notice, coverage, first word, words) of every place where a notice is covered enough.

        A window qualifies when enough of its words occur in the notice at all; only there is an alignment made.
        """
        words, out = Words(texts), []
        if not len(words):
            return out
        at = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
        code = np.where(self.hashes[at] == words.hash, at, len(self.hashes))
        left = np.repeat(words.first[1:], np.diff(words.first))
        for k, (name, notice) in enumerate(self.notices):
            need = int(np.ceil(self.coverage * len(notice) - 1e-9))
            inside = self.member[k][code]
            total = np.concatenate([[0], np.cumsum(inside)])
            starts = np.flatnonzero(inside)
            stops = np.minimum(starts + self.window[k], left[starts])
            free = 0
            for start, stop in zip(starts.tolist(), stops.tolist(), strict=True) if need else ():
                if start < free or total[stop] - total[start] < need:
                    continue
                own = words.data[words.start[start] : words.end[stop - 1]].split()
                pairs = patience(own, notice)
                if len(pairs) >= need and pairs[0][0] == 0:
                    text = int(np.searchsorted(words.first, start, side="right")) - 1
                    span = pairs[-1][0] + 1
                    out.append((text, name, len(pairs) / len(notice), start - int(words.first[text]), span))
                    free = start + span
        return out


def scan(
    docs: DataFrame,
    notices: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    coverage: float = 0.8,
    slack: float = 0.5,
) -> DataFrame:
    """One row per place: doc_id, licence, coverage, first_word, n_words; first_word counts words of letters and digits.

    A place starts at a word of the notice and has at most ``1 + slack`` times its words; the share of the notice
    that a patience alignment finds there, in order, is its coverage, and must be at least ``coverage``. Places of
    one notice do not overlap; different notices are judged apart. Every text is scanned whole.

    A null or empty text has no places, and no rows. Rows that repeat an identifier are scanned each for itself;
    a null identifier is returned as null. No other column is read. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(NOTICES if notices is None else notices, coverage, slack))

    def run(batches):
        for batch in slices(batches, 1):
            texts, ids = [spelled(t) for t in batch.column(1).to_pylist()], batch.column(0).to_pylist()
            rows = [
                (ids[i + text], *row) for i, j in chunks(texts) for text, *row in scanner.value.scan(texts[i:j])
            ]
            columns = list(zip(*rows, strict=True)) or [[] for _ in range(5)]
            kinds = pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "licence", "coverage", "first_word", "n_words"],
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, licence string, coverage double, first_word long, n_words long")
