"""The pipeline's stages on their own inputs, the registry, and the SQL twins."""

import os
import subprocess
import sys
from collections import defaultdict

import oracle
import pytest
from helpers import jaccard_classes

import __spark_entry__
import corpus_pipeline
from flowsieve.llm import queries
from flowsieve.session import written


def test_stages(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # large enough for labels to tell something
    docs = queries.table(spark, sf_dir, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), "stage")
        kept[name] = [r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf_dir, "labels").collect()}
    before, after = kept["toxicity"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert gone and sum(labels.get(i, 1) for i in gone) >= 0.9 * len(gone)

    before, after = kept["exact dedup"]
    fold = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    best = {}
    for r in before:
        best[fold(r["text"])] = max(r["doc_id"], best.get(fold(r["text"]), -1))
    assert {r["doc_id"] for r in after} == set(best.values()) and len(after) == len(best)

    before, after = kept["MinHash near-dedup"]
    classes = defaultdict(set)
    for r, c in zip(before, jaccard_classes([r["text"] for r in before]), strict=True):
        classes[c].add(r["doc_id"])
    assert {r["doc_id"] for r in after} == {min(c) for c in classes.values()}

    before, after = kept["mixing"]
    assert {r["doc_id"] for r in after} < {r["doc_id"] for r in before} and len(after) > 0.2 * len(before)

    before, after = kept["packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


def test_sql_twins(spark, sf_dir):
    con = oracle.duck(sf_dir)
    for name, sql in queries.SQL.items():
        assert oracle.compare(queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(sql).df()) == "", name


def test_every_operator_is_registered():
    found = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in found) for k in range(1, 11)) and "pipeline" in found
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("absent", ["flowsieve.llm", "corpus_pipeline"])
def test_the_rest_works_without_this_package(absent):
    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        f"    def find_spec(self, name, *_):\n        if name == {absent!r}: raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert 'history_full' in e.queries() and 'pipeline' not in e.queries() and e.oracle_sql()\n"
    )
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_nothing_else_imports_this_package():
    root = os.path.join(os.path.dirname(os.path.abspath(__spark_entry__.__file__)), "flowsieve")
    for folder, _, names in os.walk(root):
        if "llm" not in folder:
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "llm" not in f.read(), name
