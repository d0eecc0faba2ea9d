"""A Merkle tree over the rows of each group, and one over the groups: roots and proofs.

A node's digest is the SHA-256 of its children's digests, concatenated as hex text. Rows
stand in order within their group, and every ``FANOUT`` consecutive nodes of a level (the last
run: fewer, even one) have one parent, while a level has several nodes. What is left is the
group's subroot; the subroots, ordered by group (null first, bytewise), have the root.

A level is a pivot: conditional aggregates spread the children of one node over a column for
each slot; the columns concatenated give the parent's digest, and without the own slot the
siblings. One shuffle serves ``LEVELS`` levels: the descendants of a node that many levels
above stand in one row, so the k-th pass has 27**k times fewer rows than the leaves. Proofs
go down the same way: blocks take the path above them from the pass above (their join has
one row a block), and only the last step spreads paths over rows, without a shuffle.

Positions are given by a range partitioning over (group, order, leaf, row number), so a hot
group is cut into as many tasks as the table, and equal rows too.

Cases: rows without an order value come first, rows with the same one are ordered by leaf;
null groups are one group; a group of one row has that leaf as subroot; equal rows are leaves of
their own; null and empty values differ in a leaf; an empty table gives an empty result. Extra
columns are kept (those named like results are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edflux.llm.common import parts, stored

FANOUT, LEVELS = 3, 3
WIDTH = FANOUT**LEVELS
_PATH = "array<struct<left:string,right:string>>"


def digest_of(*texts: Column) -> Column:
    """Lower-case hex SHA-256 of the texts one after another (nulls are left out)."""
    return F.sha2(F.concat_ws("", *texts), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field as ``-`` if null, else its number of UTF-8 bytes, ``:`` and its text."""
    texts = [c.cast("string") for c in fields]
    return digest_of(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


def proof(path: Column) -> Column:
    """Digest of all siblings, from the leaf's run to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def folded(path: Column, own: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, own, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def placed(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with __at, their position in the group (from 0), and __n, the group's rows."""
    spark = rows.sparkSession
    tasks = parts(spark, rows.count(), 1 << 20)
    dealt = rows.repartitionByRange(tasks, group, *order).sortWithinPartitions(group, *order)
    dealt = stored(dealt.withColumn("__row", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("__row", 33)  # the upper bits hold the partition's number
    runs = dealt.groupBy(group, task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("__n").over(whole.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = stored(runs.select(group, "__task", "__first", before.alias("__before"), F.sum("__n").over(whole).alias("__n")), "runs")
    at = (F.col("__row") - F.col("__first") + F.col("__before")).alias("__at")
    out = dealt.withColumn("__task", task).join(runs, [group, "__task"])
    return out.select(*rows.columns, at, "__n")


def _above(n: Column, levels: int) -> Column:
    """How many nodes stand ``levels`` levels above ``n``."""
    each = FANOUT**levels
    return F.call_function("div", n + (each - 1), F.lit(each)) if levels else n


def climb(nodes: DataFrame, group: str) -> list[DataFrame]:
    """The passes from ``nodes`` (group, __at, __n, kid with a digest) to a single node in each group.

    Each has a row for a block of ``WIDTH`` nodes: kids c0, c1, ..., and the digests of the levels
    above in up1, up2, ...; a level with one node is passed on as it is.
    """
    passes: list[DataFrame] = []
    while not passes or not nodes.isEmpty():
        slot = F.col("__at") % WIDTH
        kids = [F.first(F.when(slot == j, F.col("kid")), ignorenulls=True).alias(f"c{j}") for j in range(WIDTH)]
        block = nodes.groupBy(group, F.call_function("div", F.col("__at"), F.lit(WIDTH)).alias("__block"), "__n").agg(*kids)
        below = [F.col(f"c{j}.digest") for j in range(WIDTH)]
        for level in range(1, LEVELS + 1):
            runs = [below[i : i + FANOUT] for i in range(0, len(below), FANOUT)]
            many = _above(F.col("__n"), level - 1) > 1
            ups = [F.when(r[0].isNotNull(), F.when(many, digest_of(*r)).otherwise(r[0])) for r in runs]
            block = block.withColumn(f"up{level}", F.array(*ups))
            below = [F.col(f"up{level}")[i] for i in range(len(ups))]
        passes.append(stored(block, "blocks"))
        top = F.struct(F.col(f"up{LEVELS}")[0].alias("digest"))
        nodes = passes[-1].where(F.col("__n") > WIDTH)
        nodes = nodes.select(group, F.col("__block").alias("__at"), _above(F.col("__n"), LEVELS).alias("__n"), top.alias("kid"))
    return passes


def roots(passes: list[DataFrame], group: str) -> DataFrame:
    """group and digest of what each group's climb has left."""
    out = [p.where(F.col("__n") <= WIDTH).select(group, F.col(f"up{LEVELS}")[0].alias("digest")) for p in passes]
    for p in out[1:]:
        out[0] = out[0].unionByName(p)
    return out[0]


def descend(passes: list[DataFrame], tops: DataFrame, group: str) -> DataFrame:
    """The kids of the first pass with path (siblings up to the root, then that of ``tops``) and subroot.

    ``tops`` has path and subroot of each group.
    """
    paths = None
    for p in reversed(passes):
        known = p.where(F.col("__n") <= WIDTH).join(tops, group)
        if paths is not None:
            deeper = p.where(F.col("__n") > WIDTH).join(paths.select(group, F.col("at").alias("__block"), "path", "subroot"), [group, "__block"])
            known = known.unionByName(deeper)
        levels = [[F.col(f"c{j}.digest") for j in range(WIDTH)]]
        levels += [[F.col(f"up{k}")[i] for i in range(WIDTH // FANOUT**k)] for k in range(1, LEVELS)]
        rows = [F.when(F.col(f"c{j}").isNotNull(), F.struct(F.col(f"c{j}").alias("kid"), (F.col("__block") * WIDTH + j).alias("at"), _path(levels, j).alias("path"))) for j in range(WIDTH)]
        each = known.select(group, "subroot", F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("x"))
        paths = each.select(group, "subroot", "x.kid", "x.at", "x.path")
    return paths


def _path(levels: list[list[Column]], slot: int) -> Column:
    """The siblings of a block's node on its way up, followed by the block's own path."""
    steps = []
    for k, nodes in enumerate(levels):
        own = slot // FANOUT**k
        run = range(own - own % FANOUT, own - own % FANOUT + FANOUT)
        left, right = (F.concat_ws("", *(nodes[i] for i in run if keep(i))) for keep in (lambda i: i < own, lambda i: i > own))
        many = _above(F.col("__n"), k) > 1
        steps.append(F.when(many, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(_PATH)))
    return F.concat(*steps, F.col("path"))


def manifest(rows: DataFrame, group: str, order: str) -> DataFrame:
    """``rows`` (with their digest in leaf) with subroot, root and path, the siblings to fold a leaf with.

    Builds the tree's levels at once, in the shared folder; paths are spread when the result is read.
    """
    own = [c for c in rows.columns if c not in ("subroot", "root", "path")]
    key = F.when(F.col(f"`{group}`").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")))
    leaves = stored(rows.select(key.alias("__group"), F.col(f"`{order}`").alias("__order"), F.col("leaf").alias("__leaf"), F.struct(*(F.col(f"`{c}`") for c in own)).alias("__own")).withColumn("__id", F.monotonically_increasing_id()), "leaves")
    kid = F.struct(F.col("__leaf").alias("digest"), F.col("__own").alias("own"))
    passes = climb(placed(leaves, "__group", "__order", "__leaf", "__id").select("__group", "__at", "__n", kid.alias("kid")), "__group")
    subroots = stored(roots(passes, "__group").select(F.col("__group").alias("name"), "digest"), "subroots").withColumn("__group", F.lit(""))
    kid = F.struct("digest", F.col("name").alias("own"))
    above = climb(placed(subroots, "__group", "name").select("__group", "__at", "__n", kid.alias("kid")), "__group")
    root = roots(above, "__group").first()
    top = roots(above, "__group").select("__group", F.array().cast(_PATH).alias("path"), F.col("digest").alias("subroot"))
    tops = descend(above, top, "__group").select(F.col("kid.own").alias("__group"), "path", F.col("kid.digest").alias("subroot"))
    out = descend(passes, stored(tops, "tops"), "__group")
    return out.select("kid.own.*", "subroot", F.lit(root.digest if root else None).cast("string").alias("root"), "path")
