import hashlib
import random

import pytest

from edflux.llm.mixing import mix
from tests.llm.helpers import documents, words


def plain_targets(sizes):
    """Share 150 % by weight; what exceeds twice a source's size is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, capped, left = dict.fromkeys(order, 0.0), set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return target
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            capped.add(s)
            target[s] = 2.0 * sizes[s]
            left -= target[s]


def rank(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_against_sorted_documents(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", None, "é", "Z", ""]
    rows = [(i, " ".join("w" * rng.randrange(40)), rng.choices(names, [30, 8, 3, 2, 1, 1])[0]) for i in range(300)]
    rows += [(300, None, "a"), (301, "", "none"), (7, "again", "b"), (7, "again", "b"), (None, "no id", "b"), (302, "x " * 5000, "Z")]
    docs = documents(spark, [r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows])
    out = mix(docs)
    got = out.collect()
    assert sorted(map(str, got)) == sorted(map(str, mix(docs.repartition(7)).collect()))
    assert out.columns == [c for c in docs.columns if c != "size"] + ["size", "source_size", "target", "taken"]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target = plain_targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        own = sorted((r for r in got if r.source == s), key=lambda r: (rank(r.doc_id), rank(r.text)))
        assert all(abs(r.target - target[s]) < 1e-6 and r.source_size == sizes[s] for r in own)
        copies = int(target[s] // sizes[s]) if sizes[s] else 0
        room, want = target[s] - copies * sizes[s], []
        for r in own:  # equal rows: their taken words are compared as a whole
            extra = r.size <= room or (room >= 0 and 2 * room > r.size)
            room -= r.size
            want.append((rank(r.doc_id), rank(r.text), r.size * (copies + extra)))
        assert sorted((rank(r.doc_id), rank(r.text), r.taken) for r in own) == sorted(want)
        assert all(r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= max((r.size for r in own), default=0) / 2 + 1e-6


@pytest.mark.parametrize("kind", ["equal rows", "one id", "no id"])
def test_a_source_of_one_id_still_meets_its_target(spark, kind):
    n = 100
    texts = [" ".join(["w"] * 10) if kind == "equal rows" else " ".join([f"w{i}"] * 10) for i in range(n)]
    texts += ["v " * 500 + str(i) for i in range(3)]
    ids = [None if kind == "no id" else 7] * n + [1, 2, 3]
    got = [r for r in mix(documents(spark, texts, ids, ["c"] * n + ["a", "b", "b"])).collect() if r.source == "c"]
    assert len(got) == n and 0 < got[0].target % 1000 and abs(sum(r.taken for r in got) - got[0].target) <= 5
    assert {r.taken for r in got} <= {0, 10, 20}


def test_tables_without_words(spark):
    assert [r.taken for r in mix(documents(spark, [None, ""])).collect()] == [0, 0]
    assert mix(documents(spark, ["a"]).limit(0)).collect() == []
