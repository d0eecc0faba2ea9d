"""License notices against edit distances computed cell by cell."""

from __future__ import annotations

import random

import pytest

from edflux.llm import license_notices as L
from edflux.llm.decontaminate import normal_words
from edflux.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents

SF = "/root/testdata/sf0.001"


def least_edits(notice, text):
    """The fewest edits that turn ``notice`` into some substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(notice, 1):
        row, before = [i], row
        for j, d in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
    return min(row)


def normal(text):
    return " ".join(w.decode() for w in normal_words(text))


def plain_base(text):
    words = [w.decode() for w in normal_words(text)]
    found = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), found


def edited(text, n, draw):
    text = list(text)
    for _ in range(n):
        i = draw.randrange(len(text))
        kind = draw.randrange(3)
        text[i : i + (kind != 0)] = [draw.choice("abxyz q")] if kind < 2 else []
    return "".join(text)


def texts(n=140, seed=3):
    draw, out = random.Random(seed), []
    for i in range(n):
        notice, _, edits = L.NOTICES[i % len(L.NOTICES)]
        passage = edited(notice, draw.randint(0, edits + 3), draw)
        out.append(f"some {passage} words" if i % 2 else f"{passage}, {draw.choice(['the', 'license', 'mit license'])}")
    return out


def test_labels_are_those_within_the_allowed_edits(spark):
    rows = texts()
    got = {r.doc_id: r for r in L.find_notices(documents(spark, rows)).collect()}
    held = 0
    for i, text in enumerate(rows):
        own = f" {normal(text)} "
        want = {label for notice, label, edits in L.NOTICES if least_edits(notice, own) <= edits}
        assert {x.label for x in got[i].notices} == want, text
        held += bool(want)
    assert 60 < held < 140


def test_spans_and_edits(spark):
    finder = L.Finder(L.PHRASES, L.NOTICES)
    for text in texts(60, 4):
        own = f" {normal(text)} "
        for k, start, end, edits in finder.places(own)[1]:
            notice = L.NOTICES[k][0]
            part = own[start:end]
            whole = [0, *range(1, len(part) + 1)]  # global distance of notice and span
            for i, c in enumerate(notice, 1):
                row = [i]
                for j, d in enumerate(part, 1):
                    row.append(min(whole[j] + 1, row[-1] + 1, whole[j - 1] + (c != d)))
                whole = row
            assert whole[-1] <= edits <= L.NOTICES[k][2]
    text = "É: \"Relaesed under\nthe MIT-Licence\", ok. Licensed under CC BY-NC 4.0"
    row = L.find_notices(documents(spark, [text])).first()
    assert [(x.label, text[x.start : x.end]) for x in row.notices] == [("mit", "Relaesed under\nthe MIT-Licence"), ("cc", "Licensed under CC BY")]
    assert row.phrases == []


def test_every_seed_is_a_piece():
    for notice, _, edits in L.NOTICES:
        own = L.pieces(notice, edits)
        assert len(own) == edits + 1 and "".join(p for _, p in own) == notice
        assert all(notice[a : a + len(p)] == p for a, p in own) and min(len(p) for _, p in own) >= 5
    with pytest.raises(ValueError):
        L.Finder({}, [("ab", "x", 2)])


def test_many_repeats_in_one_text(spark):
    notice = "Released under the MIT License. "
    row = L.find_notices(documents(spark, [notice * 3000, "mit license " * 5, "mit  mit license license", "apache LICENSE", "emit license"])).collect()
    exact = [x for x in row[0].notices if x.edits == 0]  # "licensed under ..." is three edits away
    assert len(exact) == len(row[0].phrases) == 3000 and {x.label for x in row[0].notices} == {"mit"}
    assert [len(r.phrases) for r in row[1:]] == [5, 1, 1, 0]


def test_awkward_rows_and_own_lists(spark):
    rows = awkward()
    docs = documents(spark, rows, [None, *range(len(rows) - 1)]).withColumnRenamed("fp", "phrases")
    got = L.find_notices(docs, {"one": "uno", "b c": "bc"}, [("é ß 😀", "sign", 1)])
    found = {(r.doc_id, r.n_words, tuple((x.label, x.word) for x in r.phrases), tuple(x.label for x in r.notices)) for r in got.collect()}
    assert (None, 0, (), ()) in found and (2, 1, (("uno", 0),), ()) in found and (4, 4, (), ("sign",)) in found
    assert (5, 3, (("bc", 1),), ()) in found and {"source", "spans"} <= set(got.columns)
    assert L.digest(L.find_notices(docs.where("doc_id < -1"))).collect() == []
    assert {r.n_base for r in L.digest(L.find_notices(docs, {}, [])).collect()} == {0}


def test_query_against_plain_phrases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op13_license_notices"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n, base = plain_base(d.text)
        r = got[d.doc_id]
        at = [i for i, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)
