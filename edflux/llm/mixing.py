"""Mix sources to target weights by hash thresholds, without sorting documents.

Every document has a hash of its id. For each source the words are summed by the leading bits of
the hash; the prefix sums of this histogram show the bucket in which the source's budget ends.
Only that bucket is split by its next bits, and so on, until all 60 bits are used. Documents of
the boundary hash (equal ids, or none) are split in the same way by a hash of their text, and
those with an equal text by one of their row's number. What lies below the threshold is taken.
Targets above a source's size take every document once (or twice) and the threshold applies
to the rest.

Targets share ``share`` times all words by weight; a source never gets more than ``most``
times its own size, and what it leaves is shared by the others (water filling: one level
that each uncapped source gets times its weight, found from prefix sums over the sources).

The histograms have at most 2**``bits`` rows a source, the source table one row a source.

Cases: a null text has size 0; a null source is a source of its own, ordered last; rows with equal
ids (or none) are told apart by their texts, and equal texts by row, so that each source still
misses its target by half a row at most (which of equal rows are taken may differ between reruns); sources
without words have target 0; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edflux.llm.common import SPACE, stored

HASH_BITS = 60


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE)).cast("long")


def hash_of(value: Column) -> Column:
    """60 bits of the MD5 of a value's text (null: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size -> also weight and target. One row a source, so one small partition."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ratio = F.col("source_size") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    out = sources.withColumn("weight", weight)
    budget = share * F.sum("source_size").over(whole)
    capped = F.coalesce(most * F.sum("source_size").over(before), F.lit(0.0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    out = out.withColumn("level", (budget - capped) / left).withColumn("free", F.col("level") * F.col("weight") <= most * F.col("source_size"))
    # sources in order of size over weight: the first that isn't capped sets the level
    level = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(level * F.col("weight"), most * F.col("source_size").cast("double"))
    return out.withColumn("target", F.coalesce(target, F.lit(0.0))).select("source", "source_size", "target")


def _budget(sized: DataFrame, weights, share, most) -> DataFrame:
    """A row per source: source_size, target, copies of every document, and the words still open."""
    table = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    copies = F.least(copies, F.lit(int(most)))
    return table.withColumn("copies", copies).withColumn("open", F.col("target") - F.col("copies") * F.col("source_size"))


def _edge(rows: DataFrame, state: DataFrame, column: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """The value of ``column`` (60 bits) at which the words of ``rows``, in its order, exceed each source's ``open``.

    ``state`` has of (the source) and open. Split by the leading bits first, then only the bucket in which
    the budget ends. Returns the rows with that value, and of, edge, open (what is left there) and words (of these rows).
    """
    inside, edges = rows, state.select("of", F.lit(0).cast("long").alias("edge"), "open")
    for shift in range(HASH_BITS - bits, -1, -bits):
        bucket = F.shiftright(F.col(column) - F.col("edge"), shift)
        joined = inside.join(edges, F.col("source").eqNullSafe(F.col("of")))
        hist = joined.groupBy("of", "edge", "open", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        before = F.sum("words").over(Window.partitionBy("of").orderBy("bucket")) - F.col("words")
        hist = hist.withColumn("room", F.col("open") - before).where(F.col("words") > F.col("room"))
        last = F.struct((F.col("edge") + F.shiftleft(F.col("bucket"), shift)).alias("edge"), F.col("room").alias("open"), "words")
        edges = stored(hist.groupBy("of").agg(F.min_by(last, "bucket").alias("to")).select("of", "to.*"), "edges")
        near = (F.col(column) >= F.col("edge")) & (F.col(column) < F.col("edge") + F.lit(2**shift))
        inside = stored(inside.join(edges.drop("words"), F.col("source").eqNullSafe(F.col("of"))).where(near).drop("of", "edge", "open"), "boundary")
    return inside, edges


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, bits: int = 12) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words the mix takes of each row).

    ``bits`` (a divisor of 60) bounds a histogram to 2**bits rows a source. The rows are written once, with a
    number each, to the shared folder.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    rows = stored(docs.select(*(F.col(f"`{c}`") for c in own)).withColumn("__row", F.monotonically_increasing_id()), "numbered")
    text = F.col("text").cast("string")
    hashes = {"__id": hash_of(F.col("doc_id")), "__text": hash_of(text), "__number": F.shiftrightunsigned(F.xxhash64("__row"), 64 - HASH_BITS)}
    source = F.col("source").cast("string")
    sized = stored(rows.select(source.alias("source"), size_of(text).alias("size"), *(h.alias(c) for c, h in hashes.items())), "sizes")
    budget = stored(_budget(sized, weights, share, most), "budget")
    state, limits = budget.select(F.col("source").alias("of"), "open"), budget.select(F.col("source").alias("__of"), "source_size", "target", "copies")
    used = []
    for column in hashes:
        sized, state = _edge(sized, state, column, bits)
        used.append(column)
        edge = state.select("of", F.col("edge").alias(f"{column}_edge"), F.col("open").alias("__open"), F.col("words").alias("__words"))
        limits = limits.drop("__open", "__words").join(edge, F.col("__of").eqNullSafe(F.col("of")), "left").drop("of")
        if sized.groupBy("source").count().where("count > 1").isEmpty():
            break  # a single row stands at each edge: nothing is left to tell apart
    limits = stored(limits, "limits")  # of known size, so a few sources are broadcast and documents stay where they are
    below = 2 * F.col("__open") > F.col("__words")  # the last row is taken if that comes nearer to the target
    for column in reversed(used):
        below = (hashes[column] < F.col(f"{column}_edge")) | ((hashes[column] == F.col(f"{column}_edge")) & below)
    times = F.col("copies") + F.coalesce(below, F.lit(False)).cast("long")
    base = rows.withColumns({"__source": source, "size": size_of(text)})
    return base.join(limits, F.col("__source").eqNullSafe(F.col("__of"))).select(
        *(F.col(f"`{c}`") for c in own), "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )
