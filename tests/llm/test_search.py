import itertools
import re

import numpy as np
import pytest

from edflux.llm import decontaminate as leaks
from edflux.llm.ann import _cosine, nearest
from edflux.llm.components import components
from edflux.llm.simhash import fingerprint, least_shared, links, one_of_each, postings, simhash_dedup, tallied
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, documents, words

ITEM = "item_id long, text string, other int"
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normal(text):
    return NORMAL.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(text, items, k):
    w, hit, ids = normal(text), set(), set()
    for i, t in items:
        v = normal(t)
        n = min(k, len(v))
        wins = {tuple(v[j : j + n]) for j in range(len(v) - n + 1)} if v else set()
        for j in range(len(w) - n + 1) if n else ():
            if tuple(w[j : j + n]) in wins:
                hit |= set(range(j, j + n))
                ids.add(str(i))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("most_nodes", [4 << 20, 24])
def test_decontamination_against_plain_windows(spark, most_nodes):
    items = [(1, "The quick, brown fox jumps over"), (2, "fox JUMPS over the lazy dog"), (10, "é ß"), (3, None), (4, "..."), (5, "one")]
    texts = [*awkward(), "x The quick brown FOX jumps over the lazy dog!", "quick brown fox", "the-quick_brown fox jumps", "É ß. é ß"]
    docs = documents(spark, texts)
    found = leaks.decontaminate(docs, spark.createDataFrame([(i, t, 0) for i, t in items], ITEM), window=4, most_nodes=most_nodes)
    got = {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in leaks.digest(found).collect()}
    spans = {r.doc_id: (r["items"], r.spans) for r in found.select("doc_id", "items", "spans").collect()}
    for i, t in enumerate(texts):
        n, hit, ids = plain_hits(t, items, 4)
        assert got[i] == (n, hit, hit > 0) and spans[i][0] == ids
    text = texts[len(awkward())]
    (a, b) = spans[len(awkward())][1][0]
    assert text[a:b] == "The quick brown FOX jumps over the lazy dog"


def test_windows_have_two_nodes_for_each_word_at_most():
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 100_000, 80_000))
    held = leaks.Windows([("a", text)], 10)
    assert held.automaton.get_stats()["nodes_count"] <= 2 * 10 * 80_000 + 1
    flags, ids = held.scan(leaks.normal_words(f"x y {' '.join(text.split()[70_000:70_012])} z"))
    assert flags.tolist() == [False] * 2 + [True] * 12 + [False] and ids == {"a"}


def test_decontamination_of_empty_tables(spark):
    docs, items = documents(spark, ["a b"]), spark.createDataFrame([], ITEM)
    assert leaks.digest(leaks.decontaminate(docs, items)).first().n_hit == 0
    assert leaks.decontaminate(docs.limit(0), items).collect() == []


@pytest.mark.parametrize("width, splits, least", [(3, 1, 1), (3, 2, 2), (3, 7, 10), (2, 1, 10), (4, 1, 5), (5, 1, 1)])
def test_linked_fingerprints_share_a_least_number_of_postings(width, splits, least):
    where = postings(width, splits)
    assert len(where) == len(set(where)) and least_shared(where, 3) == least
    for same in itertools.combinations(range(8), 5):
        assert sum(set(c) <= set(same) for c in where) >= least
    if width == 3:  # three bytes that agree by chance are one posting at most
        assert max(sum(set(c) <= set(same) for c in where) for same in itertools.combinations(range(8), 3)) == 1
    with pytest.raises(ValueError):
        least_shared(where, 8 - width + 1)


def test_the_count_filter_removes_candidates_and_no_link(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-(2**63), 2**63, 40, dtype=np.int64)
    fps = {int(b) for b in base}
    for b in base.tolist():  # some of three flipped bits, some that share just three or four bytes
        for k in range(12):
            flips = rng.choice(64, 3, replace=False)
            fps.add(b ^ int(np.bitwise_xor.reduce([np.int64(np.uint64(1) << np.uint64(f)) for f in flips])))
            kept = sum(0xFF << (8 * int(p)) for p in rng.choice(8, 3 + k % 2, replace=False))
            other = int(rng.integers(-(2**63), 2**63, dtype=np.int64))
            mixed = ((b & kept) | (other & ~kept)) & (2**64 - 1)
            fps.add(mixed - 2**64 if mixed >= 2**63 else mixed)
    table = spark.createDataFrame([(f,) for f in sorted(fps)], "fp long")
    where = postings()
    found = {(r.x, r.y): r.share for r in tallied(table, where).collect()}
    kept = {k for k, share in found.items() if share >= least_shared(where, 3)}
    ordered = sorted(fps)
    near = {(x, y) for i, x in enumerate(ordered) for y in ordered[i + 1 :] if ((x ^ y) & (2**64 - 1)).bit_count() <= 3}
    assert near <= kept and len(found) - len(kept) > 50 and len(near) >= 400
    got = {(r.x, r.y) for r in links(table).collect()}
    assert got == near == {(r.x, r.y) for r in links(table, width=4).collect()}


def plain_groups(ids, fps, bits=3):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    return [min(ids[j] for j in range(len(ids)) if find(j) == find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("width", [2, 3, 4])
def test_simhash_groups_against_all_pairs(spark, width):
    rng = np.random.default_rng(3)
    base = " ".join(f"t{rng.integers(500)}" for _ in range(300))
    near = [" ".join(w if rng.random() > 0.01 else "new" for w in base.split()) for _ in range(60)]
    texts = [*awkward(), base, *near]
    ids = [int(i) for i in rng.permutation(len(texts)) + 5]
    rows = simhash_dedup(documents(spark, texts, ids), width=width).collect()
    got = {r.doc_id: r for r in rows}
    fps = [int(got[i].fingerprint, 16) for i in ids]
    assert [got[i].component_id for i in ids] == plain_groups(ids, fps)
    for i, t in zip(ids, texts, strict=True):
        assert got[i].fingerprint == fingerprint(t).hex()
    assert fingerprint(None).hex() == "0" * 16


def test_one_of_each_group(spark):
    texts = ["a b c d", "a b c d", "e f g h i", None, "", "a b c d"]
    docs = documents(spark, texts, ids=[4, 2, 9, 7, 8, 2])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "a b c d"), (7, None), (9, "e f g h i")]
    assert sorted(r.text for r in one_of_each(documents(spark, ["a b c", "a b c", "x y z"], ids=[None] * 3)).collect()) == ["a b c", "x y z"]
    assert one_of_each(docs.limit(0)).collect() == []


def test_one_id_with_several_texts(spark):
    texts = ["a b c d", "e f g h i", "j k l m n", "o p q r s", "a b c d"]
    kept = one_of_each(documents(spark, texts, ids=[1, 1, 1, 2, 2])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "a b c d"), (1, "e f g h i"), (1, "j k l m n"), (2, "o p q r s")]


def test_links_of_rows_without_an_id(spark):
    def bits(a, b):
        return (int.from_bytes(fingerprint(a)) ^ int.from_bytes(fingerprint(b))).bit_count()

    words = [f"t{i}" for i in range(300)]
    near = [" ".join([*words[:i], "new", *words[i + 1 :]]) for i in range(300)]
    a, b, c = next((x, y, z) for y in near for x in near for z in near if 0 < bits(x, y) <= 3 and 0 < bits(y, z) <= 3 < bits(x, z))
    got = simhash_dedup(documents(spark, [a, b, c, "x y z"], ids=[8, None, 5, None])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 5), (5, 5), (8, 5)]
    assert [r.doc_id for r in one_of_each(documents(spark, [a, b, c], ids=[8, None, 5])).collect()] == [5]
    assert len(one_of_each(documents(spark, [a, b], ids=[None, None])).collect()) == 1


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(70, 71), (71, 72), (72, 70), (90, 90)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 40)}, **{i: 70 for i in (70, 71, 72)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_nearest(rows, k):
    out = {}
    ok = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for i, q in ok:
        if i % 5 == 0:
            scored = sorted((-float(q @ v / np.sqrt((q @ q) * (v @ v))), j) for j, v in ok if j != i and len(v) == len(q))
            out[i] = scored[:k]
    return out


def test_nearest_with_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[3][1]) for i in range(40)]  # a large group of equal vectors
    rows += [(400, None), (405, [0.0] * 8), (410, [float("nan")] + [1.0] * 7), (415, [None] + [1.0] * 7), (420, [float("inf")] + [1.0] * 7), (425, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = {}
    for r in nearest(df.union(df.limit(20)), F.col("vec_id") % 5 == 0, k=5, shard_rows=100).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = plain_nearest(rows, 5)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q].values()} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert [got[300][r][0] for r in range(1, 6)] == [3, 301, 302, 303, 304]  # ties to the smaller id
    assert all(abs(got[q][1][1] + want[q][0][0]) < 1e-12 for q in want if got[q][1][0] == want[q][0][1])


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    rows = nearest(df, F.col("vec_id") % 2 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in rows] == [(0, 1, 1)]
    assert nearest(df.limit(0), F.col("vec_id") % 2 == 0).collect() == []


@pytest.mark.parametrize("kind", ["random", "cluster", "ties", "multiples"])
def test_recall_with_a_third_of_special_vectors(spark, kind):
    """1e-5 and 1e-9 apart (the latter tie in double precision), and power-of-two multiples."""
    rng = np.random.default_rng(11)
    n, third = 3000, 1000
    v = rng.normal(size=(n, 64))
    if kind in ("cluster", "ties"):
        v[:third] = v[0] / np.linalg.norm(v[0]) + rng.normal(size=(third, 64)) * (1e-5 if kind == "cluster" else 1e-9)
    elif kind == "multiples":
        v[:third] = v[0] * 2.0 ** rng.integers(-8, 8, third)[:, None]
    ids = rng.permutation(n)
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("vec_id") % 50 == 0, k=5, shard_rows=1500).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    held = {"inside": [], "outside": []}
    for at, (i, q) in enumerate(zip(ids, v, strict=True)):
        if i % 50 == 0:
            score = _cosine(v, q)
            want = [int(ids[j]) for j in np.lexsort((ids, -score)) if j != at][:5]
            own = [x for _, x in sorted(got[int(i)])]
            assert len(own) == 5
            held["inside" if at < third else "outside"].append(len(set(own) & set(want)) / 5)
    assert all(np.mean(x) >= 0.9 for x in held.values()), {k: np.mean(x) for k, x in held.items()}
