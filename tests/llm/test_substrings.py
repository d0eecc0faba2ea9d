import random
from collections import Counter

import numpy as np
import pytest

from edflux.llm import sketch
from edflux.llm.substring_dedup import substring_dedup
from edflux.llm.text import BLANKS, window_hashes, word_hashes, word_spans
from tests.llm.helpers import awkward, documents, words


def plain(texts, k):
    every = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + k]) for w in every for i in range(len(w) - k + 1))
    out = []
    for w in every:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def check(spark, texts, k, **options):
    rows = substring_dedup(documents(spark, texts).repartition(3), k, **options).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows) == [(i, *x) for i, x in enumerate(plain(texts, k))]


def test_awkward_texts(spark):
    check(spark, awkward(), 35)
    check(spark, awkward(), 2)


@pytest.mark.parametrize("options", [{}, {"most_cells": 16}, {"chunk_bytes": 100, "bucket_bytes": 200}])
def test_random_texts_with_copies_and_periods(spark, options):
    rng = random.Random(5)
    base = [[rng.choice("abcd") for _ in range(rng.randrange(60))] for _ in range(40)]
    shared = [rng.choice("efgh") for _ in range(12)]
    texts = ["\t".join(w[:5] + shared + w[5:]) if i % 4 == 0 else " ".join(w) for i, w in enumerate(base)]
    check(spark, [*texts, "z " * 50, texts[1], "q w e r t y u i o p a s"], 6, **options)


def test_empty_table_and_null_id(spark):
    assert substring_dedup(documents(spark, ["a"]).limit(0)).collect() == []
    assert [r.doc_id for r in substring_dedup(documents(spark, ["a b"], ids=[None])).collect()] == [None]


def test_hashes_depend_on_the_words_only():
    def of(*texts):
        raw = [t.encode() for t in texts]
        off = np.cumsum([0, *map(len, raw)])
        buf = np.frombuffer(b"".join(raw), np.uint8)
        s, e, _ = word_spans(buf, off, BLANKS)
        return word_hashes(buf, s, e)

    long = "x" * 300
    a, b = of(f"q {long} r", "s"), of(f"{long}\tr", "s q")
    assert (a[1:4] == b[:3]).all() and a[0] == b[3]
    many = of(" ".join(f"w{i}" for i in range(50_000)))  # over many blocks of bytes
    assert len(set(many.tolist())) == 50_000 and many[49_999] == of("w49999")[0]
    assert (window_hashes(a, 2, 1)[1:3] == window_hashes(b, 2, 1)[:2]).all()


def test_sketch_never_misses(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5000, 6000)
    df = spark.createDataFrame([(int(v),) for v in values], "v long").repartition(5)

    def hashes(batch):
        yield batch.column("v").to_numpy().astype(np.uint64)

    for bits in (16, 22):
        seen = sketch.merged(df, hashes, bits)
        n = np.bincount(values, minlength=5000)
        got = sketch.repeated(seen, np.arange(5000, dtype=np.uint64), bits)
        assert got[n > 1].all() and got[n < 2].mean() < 0.2
