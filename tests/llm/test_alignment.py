"""Token alignment against whole texts encoded at once and aligned token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from edflux.llm import alignment
from edflux.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def aligner():
    with open(alignment.A_FILE, encoding="utf-8") as a, open(alignment.B_FILE, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


def plain(aligner, text):
    """Tokens of A and B, groups, and links by comparing all byte ranges; None without tokens."""
    if not text:
        return None
    raw = b" " + text.encode()
    sides = []
    for ids, table in ((aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.a_bytes), (aligner.b.encode(text), aligner.b_bytes)):
        if b"".join(table[i] for i in ids) != raw:
            return None
        ends = np.cumsum([len(table[i]) for i in ids]).tolist()
        sides.append(list(zip(ids, [0, *ends], ends, strict=False)))
    a, b = sides
    groups, rest = [], (iter(a), iter(b))
    for cut in sorted({t[2] for t in a} & {t[2] for t in b}):
        own = []
        for side in rest:
            ids = []
            for i, _, end in side:
                ids.append(str(i))
                if end == cut:
                    break
            own.append(",".join(ids))
        groups.append("|".join(own))
    links, j = Counter(), 0
    for i, start, end in a:
        while j and b[j - 1][2] > start:
            j -= 1
        while j < len(b) and b[j][1] < end:
            if b[j][2] > start:
                links[i << 32 | b[j][0]] += 1
            j += 1
    return len(a), len(b), len(groups), ";".join(groups), links


def scores(found):
    total = Counter()
    for f in found:
        total.update(f[4] if f else {})
    best = Counter()
    for pair, n in total.items():
        best[pair & 0xFFFFFFFF] = max(best[pair & 0xFFFFFFFF], n)
    out = []
    for f in found:
        links = f[4] if f else {}
        n_best = sum(n for p, n in links.items() if total[p] == best[p & 0xFFFFFFFF])
        sha = hashlib.sha256(f[3].encode()).hexdigest() if f else ""
        out.append((*(f[:3] if f else (0, 0, 0)), sum(links.values()), n_best, sum(n * total[p] for p, n in links.items()), sha))
    return out


def noise(n, seed=5):
    draw = random.Random(seed)
    signs = [*"abc'sdt  \n\t\r 019.,-\x00\x1c\x85", "—", "é", "日", "😀", "\xa0", "᠎", "​", " ", "﻿", "é", "'s ", " the", "<0x41>"]
    return ["".join(draw.choice(signs) for _ in range(draw.randint(1, 50))) for _ in range(n)]


def test_segments_against_whole_texts(aligner):
    texts = [*noise(1500), " ", "\n", "a ", "  a", "a<|endoftext|> b <s> </s> <unk>", "x" * 500, "one▁two here", "日本語" * 40]
    for _ in range(2):  # the second time from what is known
        for text, got in zip(texts, aligner.aligned(texts), strict=True):
            want = plain(aligner, text)
            assert (got is None) == (want is None), text
            if want:
                assert (*got[0][:3], got[1], Counter(got[2].tolist())) == want, text
    assert aligner.cuts


def test_whole_text_segments_and_bounded_memory(aligner):
    texts = noise(300, 6)
    with open(alignment.A_FILE, encoding="utf-8") as a, open(alignment.B_FILE, "rb") as b:
        other = alignment.Aligner(a.read(), b.read(), most=10)
    other.cuts = False
    for i in range(0, 300, 50):
        part = texts[i : i + 50]
        assert [(g[:2] if g else None) for g in other.aligned(part)] == [(g[:2] if g else None) for g in aligner.aligned(part)]
        assert len(other.texts) <= 60


def test_coarse_cuts_are_refined_by_decoded_bytes():
    cut, coarse = np.array([2, 0, 0, 9]), np.array([True, False, False, True])
    assert alignment.refined(cut, coarse, np.array([2, 3, 1, 3])).tolist() == [2, 5, 6, 9]
    assert alignment.refined(np.array([0, 4]), np.array([False, True]), np.array([1, 3])).tolist() == [1, 4]


@pytest.mark.parametrize("hot_pairs", [3, 1 << 19])
def test_counts_over_hot_and_rare_pairs(spark, aligner, hot_pairs):
    texts = [*awkward(), "one▁two", *noise(40, 7), "the one and the one"]
    ids = [*range(len(texts) - 2), None, 3]
    docs = documents(spark, texts, ids).withColumnRenamed("fp", "n_links").withColumnRenamed("size", "count_sum")
    got = alignment.link_scores(alignment.alignments(docs), hot_pairs=hot_pairs).collect()
    want = Counter((i, *w[:6], w[6]) for i, w in zip(ids, scores([plain(aligner, t) for t in texts]), strict=True))
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, sha(r.groups)) for r in got) == want
    assert {"lang", "source", "spans"} <= set(got[0].asDict())


def test_empty_table(spark):
    docs = documents(spark, ["x"]).where("doc_id < 0")
    assert alignment.link_scores(alignment.alignments(docs)).collect() == []


def test_text_that_is_not_utf8_has_no_tokens(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text UNION ALL SELECT 2L, 'fine'")
    assert {r.doc_id: r.n_a for r in alignment.alignments(docs).select("doc_id", "n_a").collect()} == {1: 0, 2: 1}


def test_query_against_whole_texts(spark, aligner):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(d.doc_id, *s) for d, s in zip(docs, scores([plain(aligner, d.text) for d in docs]), strict=True)]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, QUERIES["op11_token_alignment"](spark, SF).select(*columns).collect())) == sorted(want)
