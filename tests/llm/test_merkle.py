"""The Merkle manifest against a plain tree built run by run."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edflux.llm import merkle
from tests.llm.helpers import awkward, documents

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """The root and each node's siblings as (left, right), level by level."""
    paths, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, above = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for k in range(len(run)):
                for leaf in held[i + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            ups.append(sha(*run))
            above.append([leaf for h in held[i : i + 3] for leaf in h])
        nodes, held = ups, above
    return nodes[0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, path) of (doc_id, source, leaf) rows."""
    groups = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {g: sorted((r for r in rows if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for g in groups}
    trees = {g: plain_tree([r[2] for r in own[g]]) for g in groups}
    root, tops = plain_tree([trees[g][0] for g in groups])
    return [
        (r[0], r[2], trees[g][0], root, tuple(path + top))
        for g, top in zip(groups, tops, strict=True)
        for r, path in zip(own[g], trees[g][1], strict=True)
    ]


def check(df):
    docs = df.select(*df.columns, merkle.leaf(*(F.col(c) for c in FIELDS)).alias("leaf"))
    rows = [(r.doc_id, r.source, plain_leaf([r[c] for c in FIELDS])) for r in df.collect()]
    out = merkle.manifest(docs, "source", "doc_id")
    got = out.withColumn("again", merkle.folded(F.col("path"), F.col("leaf"))).withColumn("proof", merkle.proof(F.col("path"))).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((x.left, x.right) for x in r.path)) for r in got) == Counter(plain_manifest(rows))
    assert all(r.again == r.root for r in got)
    assert all(r.proof == sha(*(x.left + x.right for x in r.path)) for r in got)
    assert set(df.columns) <= set(out.columns)


def test_awkward_rows(spark):
    texts = awkward()
    sources = [None, "", "b", "b", "a", "é", "😀", "￮", "a", "a", None]
    check(documents(spark, texts, [0, 1, 2, 2, None, 5, 6, 7, 9, 9, -3], sources))


@pytest.mark.parametrize("n", [1, 4, 28, 82])
def test_sizes_around_full_runs(spark, n):
    check(documents(spark, [f"t{i}" for i in range(n)], [(7 * i) % 101 for i in range(n)]))


def test_hot_source_equal_rows_and_many_sources(spark):
    n = 900
    texts = ["same" if i % 3 == 0 else f"t{i}" for i in range(n)]
    ids = [5 if i % 3 == 0 else i for i in range(n)]
    sources = ["hot" if i % 3 == 0 else f"s{i % 97}" for i in range(n)]
    check(documents(spark, texts, ids, sources))


def test_empty_table(spark):
    docs = documents(spark, ["x"]).where("doc_id < 0").withColumn("leaf", F.lit("x"))
    assert merkle.manifest(docs, "source", "doc_id").collect() == []


def test_changes_are_noticed(spark):
    df = documents(spark, ["a\nb", "ab", "a", None, ""], sources=["x", "x", "y", "y", None])
    docs = df.select("doc_id", "source", "text", merkle.leaf(F.col("doc_id"), F.col("text")).alias("leaf"))
    out = merkle.manifest(docs, "source", "doc_id")
    changed = merkle.leaf(F.col("doc_id"), F.translate("text", "\n", ""))
    got = {r.doc_id: r.ok for r in out.select("doc_id", (merkle.folded(F.col("path"), changed) == F.col("root")).alias("ok")).collect()}
    assert got == {0: False, 1: True, 2: True, 3: True, 4: True}


def test_bottom_level_is_shuffled_once(spark):
    """Paths meet blocks, not rows: no join reads more than a 27th of the leaves from a shuffle."""
    docs = documents(spark, [f"t{i}" for i in range(500)]).withColumn("leaf", F.sha2("text", 256))
    plan = merkle.manifest(docs, "source", "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Generate") <= 2  # one a pass
