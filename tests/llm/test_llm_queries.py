"""The registered queries and the pipeline over the smallest given tables."""

from __future__ import annotations

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from edflux.llm.common import stored
from edflux.llm.mixing import mix
from edflux.llm.oracle import ORACLES
from edflux.llm.queries import QUERIES
from edflux.llm.simhash import fingerprint
from scripts.verify_oracle import _digest
from tests.llm.test_models import plain_secrets
from tests.llm.test_search import plain_groups, plain_hits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(cols, res.fetchall())


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert "pipeline" in entry.queries()


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [d.doc_id for d in docs], [int.from_bytes(fingerprint(d.text)) for d in docs]
    want = sorted(zip(ids, [f"{f:016x}" for f in fps], plain_groups(ids, fps), strict=True))
    assert sorted(tuple(r) for r in QUERIES["op6_simhash"](spark, SF).collect()) == want


def test_secrets_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d.doc_id, hashlib.sha256(plain_secrets(d.text or "").encode()).hexdigest()) for d in docs)
    assert sorted((r.doc_id, r.base_sha256) for r in QUERIES["op8_secrets"](spark, SF).collect()) == want


def test_pipeline_stages_against_plain_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        rows[name] = docs.collect()
    clean = {r.doc_id for r in labels if not r.toxic}
    first = {r.doc_id for r in rows["toxicity"]}
    assert len(clean - first) <= 0.02 * len(clean)
    ids, texts = [r.doc_id for r in rows["toxicity"]], [r.text for r in rows["toxicity"]]
    groups = plain_groups(ids, [int.from_bytes(fingerprint(t)) for t in texts])
    assert sorted(r.doc_id for r in rows["simhash"]) == sorted(set(groups))
    kept = {r.doc_id: r for r in rows["simhash"] if not plain_hits(r.text, items, 10)[1]}
    assert sorted(kept) == sorted(r.doc_id for r in rows["decontamination"])
    assert len(rows["secrets"]) == len(kept)
    for r in rows["secrets"]:
        old = kept[r.doc_id]
        assert (r.text == old.text) or not plain_secrets(r.text) and "[" in r.text and r.n_chars == len(r.text)
        assert not plain_secrets(old.text) or r.text != old.text
    last = mix(spark.createDataFrame(rows["secrets"], spark.read.parquet(f"{SF}/documents.parquet").schema)).where("taken > 0")
    assert sorted(map(str, last.collect())) == sorted(map(str, rows["mixing"]))


def test_stages_keep_clashing_columns_and_empty_tables(spark):
    names = "score predicted items spans base tokens fp __source n_words".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, "some words here", "en", "a", 15, *names), (1, "some words here", "en", "a", 15, *names), (None, None, None, None, None, *names)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == (2 if name == "simhash" else 3) and all([r[n] for n in names] == names for r in got)
        assert stage(spark, docs.limit(0), SF).collect() == []
    assert {"size", "taken"} <= set(corpus_pipeline.mixed(spark, docs.drop("__source"), SF).columns)
    assert corpus_pipeline.mixed(spark, docs.limit(0).drop("__source"), SF).collect() == []
