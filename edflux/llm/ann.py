"""Nearest neighbours by cosine over robust-pruned directed graphs, one for each shard.

Vectors of one direction (multiples of each other) are one node, with the smallest ids that can
be among the nearest. Nodes are dealt to shards by a hash. In a shard, nodes are inserted in batches: a greedy beam search
from the medoid proposes neighbours, and relaxed distance pruning keeps an edge only if no kept
neighbour is nearer to its end by the factor ``alpha``, so long diverse edges stay. Queries
run a beam search in every shard; the scores of all they find are then computed from the
original vectors in double precision, and each query's nearest are taken over all shards. Where
the whole beam is tied with the last of the nearest, the shard is searched exactly instead, so
that ties go to the smallest ids. Distances are differences of unit vectors in double precision.

A shard has ``shard_rows`` nodes on average and a task sees ``query_rows`` queries at a time, so
memory doesn't grow with the table.

Cases: vectors that are null or zero, or hold null or non-finite components, take no part,
nor do rows without an id; of rows with one id and vector one counts; an id with several
vectors counts by its best; vectors of another length than the query's are no candidates;
fewer candidates than ``k`` give all; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edflux.llm.common import stored

#: Scores this near to each other are ties, as far as a graph of rounded distances can tell.
TIED = 1e-14
RESULT = "query_id long, rank int, vec_id long, score double"


def _distances(x: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distance between row i of ``q`` and nodes ``ids[i]``; missing nodes (-1) are infinitely far.

    Of unit vectors, so twice 1 - cosine, but from differences: near neighbours keep all their digits.
    """
    d = x[ids] - q[:, None]
    d = np.einsum("brd,brd->br", d, d)
    d[ids < 0] = np.inf
    return d


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, q: np.ndarray, beam: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that a greedy search reaches, nearest first, and their distances."""
    n_q, n = len(q), len(x)
    ids = np.full((n_q, beam), -1)
    dist = np.full((n_q, beam), np.inf)
    ids[:, 0] = start
    dist[:, 0] = ((q - x[start]) ** 2).sum(axis=1)
    seen = np.zeros((n_q, n), bool)
    seen[:, start] = True
    done = np.zeros((n_q, beam), bool)
    active = np.arange(n_q)
    while len(active):
        d = np.where(done[active] | (ids[active] < 0), np.inf, dist[active])
        pick = np.argsort(d, axis=1, kind="stable")[:, :step]
        real = np.isfinite(np.take_along_axis(d, pick, 1))
        more = real.any(axis=1)
        active, pick, real = active[more], pick[more], real[more]
        if not len(active):
            break
        rows = active[:, None]
        done[rows, pick] |= real
        new = np.where(real[:, :, None], graph[ids[rows, pick]], -1).reshape(len(active), -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[(new >= 0) & seen[rows, new]] = -1
        r, c = np.nonzero(new >= 0)
        seen[active[r], new[r, c]] = True
        all_ids = np.concatenate((ids[active], new), axis=1)
        all_dist = np.concatenate((dist[active], _distances(x, new, q[active])), axis=1)
        all_done = np.concatenate((done[active], np.zeros(new.shape, bool)), axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, 1)
        dist[active] = np.take_along_axis(all_dist, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)
    return np.where(np.isfinite(dist), ids, -1), dist


def robust_prune(x: np.ndarray, of: np.ndarray, ids: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For nodes ``of``: up to ``degree`` of the candidates ``ids`` that no kept one covers."""
    ids = np.sort(np.where(ids == of[:, None], -1, ids), axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    d = _distances(x, ids, x[of])
    order = np.argsort(d, axis=1, kind="stable")
    ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
    c = x[ids] - x[of][:, None]  # seen from the node, so that what is near keeps its digits
    length = np.einsum("brd,brd->br", c, c)
    between = length[:, :, None] + length[:, None] - 2 * (c @ c.transpose(0, 2, 1))
    alive, rows = np.isfinite(d), np.arange(len(of))
    out = np.full((len(of), degree), -1)
    for k in range(degree):
        first = np.argmax(alive, axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = ids[rows, first][some]
        alive &= ~(alpha * between[rows, first] <= d) | ~some[:, None]
        alive[rows, first] = False
    return out


def build(x: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, batch: int = 512, seed: int = 7) -> tuple[np.ndarray, int]:
    """Out-neighbours of every node (-1: none) and the node to start from."""
    n = len(x)
    graph = np.full((n, degree), -1)
    start = int(np.argmax(x @ x.mean(axis=0)))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([start], order[order != start]))
    at = 1
    while at < n:
        new = order[at : at + min(batch, max(1, at // 2))]  # small at first: a batch doesn't see itself
        found, _ = beam_search(x, graph, start, x[new], beam)
        graph[new] = robust_prune(x, new, found, degree, alpha)
        src, col = np.nonzero(graph[new] >= 0)
        _link(x, graph, graph[new][src, col], new[src], degree, alpha)
        at += len(new)
    return graph, start


def _link(x: np.ndarray, graph: np.ndarray, ends: np.ndarray, back: np.ndarray, degree: int, alpha: float) -> None:
    """Add the reverse edges ``ends`` -> ``back``; nodes with too many are pruned."""
    order = np.argsort(ends, kind="stable")
    ends, back = ends[order], back[order]
    nodes, first, count = np.unique(ends, return_index=True, return_counts=True)
    slot = np.arange(len(ends)) - np.repeat(first, count)
    wide = np.full((len(nodes), int(count.max(initial=0))), -1)
    wide[np.repeat(np.arange(len(nodes)), count), slot] = back
    used = (graph[nodes] >= 0).sum(axis=1)
    fits = used + count <= degree
    for i in np.flatnonzero(fits):
        graph[nodes[i], used[i] : used[i] + count[i]] = wide[i, : count[i]]
    full = np.flatnonzero(~fits)
    for width in (128, 1024, wide.shape[1]) if len(full) else ():  # like with like: one hub doesn't widen all
        own = full[(count[full] <= width)]
        full = full[count[full] > width]
        for part in np.array_split(own, max(1, len(own) * (min(width, wide.shape[1]) + degree) ** 2 >> 22)):
            if len(part):
                both = np.concatenate((graph[nodes[part]], wide[part, : count[part].max()]), axis=1)
                graph[nodes[part]] = robust_prune(x, nodes[part], both, degree, alpha)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def _direction(vector: Column) -> Column:
    """The unit vector in whole 1e-13ths: equal for multiples of one vector (but for a rounding step at the last place)."""
    scaled = _let(F.array_max(F.transform(vector, F.abs)), lambda most: F.transform(vector, lambda x: x / most))
    length = lambda u: F.sqrt(F.aggregate(u, F.lit(0.0), lambda a, x: a + x * x))
    return _let(scaled, lambda u: _let(length(u), lambda n: F.transform(u, lambda x: F.floor(x / n * 1e13 + 0.5))))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where a function of each component needs it."""
    return F.transform(F.array(value), use)[0]


def nearest(vectors: DataFrame, queries: Column, k: int = 5, shard_rows: int = 8192, query_rows: int = 4096, degree: int = 32, beam: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of every row that ``queries`` selects.

    ``vectors`` has vec_id and embedding. ``beam`` trades time for recall.
    """
    rows = vectors.where("vec_id is not null").where(_usable(F.col("embedding").cast("array<double>"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), queries.alias("asks")
    )
    rows = stored(rows.dropDuplicates(["vec_id", "v"]).withColumn("way", _direction(F.col("v"))), "vectors")
    # the k + 1 smallest ids of a direction: one may be the query's own
    by = F.row_number().over(Window.partitionBy("way").orderBy("vec_id"))
    few = rows.groupBy("way", "vec_id").agg(F.first("v").alias("v")).withColumn("n", by).where(F.col("n") <= k + 1)
    few = few.groupBy("way").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.min_by("v", "vec_id").alias("v"))
    nodes = stored(few, "nodes")
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    asks = rows.where("asks").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    groups = max(1, math.ceil(asks.count() / query_rows))

    def index(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        part = part.assign(size=part["v"].map(len))
        for size, own in part.groupby("size"):
            v = np.stack(own["v"].to_list())
            unit = _unit(v)
            graph, start = build(unit, degree, beam)
            ids = np.full((len(own), k + 1), -1, np.int64)
            for i, few_ids in enumerate(own["ids"]):
                ids[i, : len(few_ids)] = few_ids
            # absent members are marked by a count, as any long may be an id
            count = own["ids"].map(len).to_numpy(np.int32)
            out.append((int(part["shard"].iloc[0]), int(size), start, v.tobytes(), graph.astype(np.int32).tobytes(), ids.tobytes(), count.tobytes()))
        return pd.DataFrame(out, columns=["shard", "length", "start", "v", "graph", "ids", "members"])

    graphs = stored(
        nodes.withColumn("shard", F.pmod(F.xxhash64("way"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(index, "shard int, length int, start int, v binary, graph binary, ids binary, members binary"),
        "graphs",
    )

    def search(_: tuple, graph: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        sizes = ask["q"].map(len)
        for g in graph.itertuples():
            own = ask[sizes == g.length]
            if not len(own):
                continue
            v = np.frombuffer(g.v, np.float64).reshape(-1, g.length)
            edges = np.frombuffer(g.graph, np.int32).reshape(len(v), -1)
            ids = np.frombuffer(g.ids, np.int64).reshape(len(v), -1)
            count = np.frombuffer(g.members, np.int32)
            unit = _unit(v)
            for lo in range(0, len(own), 512):
                part = own.iloc[lo : lo + 512]
                q = np.stack(part["q"].to_list())
                found, _dist = beam_search(unit, edges, g.start, _unit(q), max(beam, k + 1))
                for query, one, hits in zip(part["query_id"], q, found, strict=True):
                    hits = hits[hits >= 0]
                    score = _cosine(v[hits], one)
                    if len(hits) > k and np.partition(score, -k - 1)[-k - 1] - score.min() <= TIED:
                        score = _cosine(v, one)  # more ties than the beam holds: all of the shard is looked at
                        hits = np.lexsort((ids[:, 0], -score))[: k + 1]
                        score = score[hits]
                    best = [(-s, i) for s, h in zip(score, hits, strict=True) for i in ids[h, : count[h]] if i != query]
                    out += [(query, i, -s) for s, i in sorted(best)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    spread = asks.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    homes = graphs.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = homes.groupBy("shard", "group").cogroup(spread.groupBy("shard", "group")).applyInPandas(search, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # else squares may overflow or vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _cosine(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine in double precision; equal rows give equal values."""
    v, q = v / np.abs(v).max(axis=1, keepdims=True), q / np.abs(q).max()
    return (v * q).sum(axis=1) / np.sqrt((v * v).sum(axis=1) * (q * q).sum())
