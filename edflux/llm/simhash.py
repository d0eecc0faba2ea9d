"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a few differing bits.

Fingerprints differing in at most ``bits`` of 64 bits agree in at least 8 - ``bits`` of their
8 bytes. The inverted index posts every distinct fingerprint under the joint values of ``width``
byte positions, for a fixed choice of position sets (:func:`postings`). Any 8 - ``bits`` positions
contain a known least number of those sets, so linked fingerprints share at least that many postings:
the shared postings of every pair are counted, pairs below the guaranteed minimum are dropped,
the others are verified by their differing bits. By the default sets, two fingerprints that agree in
three bytes by chance share one posting, and two are asked for. Wider postings have shorter lists:
3 bytes give 24-bit values, 4 bytes 32-bit ones, for corpora of billions.

Copies share a fingerprint, and only distinct fingerprints are posted, so a group of copies
is one entry however large it is.

Cases: a null or empty text has the fingerprint zero; fewer words than a shingle make one
shingle; repeated rows share a component; a component whose ids are all null is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.llm.common import stored, total
from edflux.llm.components import components

SEED = 42
_RUN = 1 << 16
HOT = 100_000  # at most so many fingerprints have more than this part of all rows


def fingerprint(text: str | bytes | None, shingle: int = 3) -> bytes:
    """Eight bytes; bit i is set if it is set in over half of the shingles' XXH64 values."""
    words = (text.encode() if isinstance(text, str) else text or b"").lower().split()
    if not words:
        return bytes(8)
    k = min(shingle, len(words))
    grams = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    n, ones = len(words) - k + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    while run := b"".join([digest(g, SEED) for g in itertools.islice(grams, _RUN)]):
        ones += np.unpackbits(np.frombuffer(run, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ("doc_id",), name: str = "fp") -> DataFrame:
    """The columns ``keep`` and ``name`` (the fingerprint as a signed long)."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, shingle) for t in batch.column("__text"))
            fp = pa.array(np.frombuffer(raw, ">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), fp], [*keep, name])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").cast("string").cast("binary").alias("__text"))
    return rows.mapInArrow(run, f"{schema}, {name} long")


def postings(width: int = 3, splits: int = 2) -> list[tuple[int, ...]]:
    """Sets of ``width`` byte positions under which fingerprints are posted.

    For 3 positions, each of ``splits`` (1 to 7) deals the eight positions into two blocks of four by
    the parity of some bits of their numbers, and every three of a block are a set. Any three positions
    lie in one block only of all seven splits, so no set comes twice. Else all sets of the width.
    """
    if width != 3:
        return list(itertools.combinations(range(8), width))
    blocks = [[p for p in range(8) if (p & m).bit_count() % 2 == odd] for m in range(1, splits + 1) for odd in (0, 1)]
    return [c for block in blocks for c in itertools.combinations(block, 3)]


def least_shared(where: list[tuple[int, ...]], bits: int) -> int:
    """How many postings fingerprints share at least if they differ in at most ``bits`` bits."""
    least = min(sum(set(c) <= set(same) for c in where) for same in itertools.combinations(range(8), 8 - bits))
    if least < 1:
        raise ValueError(f"fingerprints at {bits} bits may share none of these postings: take narrower ones or more splits")
    return least


def tallied(fps: DataFrame, where: list[tuple[int, ...]]) -> DataFrame:
    """Pairs (x, y), x < y, of distinct ``fp`` values under a common posting, and how many they ``share``."""
    masks = [sum(0xFF << (56 - 8 * p) for p in c) for c in where]
    masks = [m - 2**64 if m >= 2**63 else m for m in masks]
    post = F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("posting", "value")
    index = fps.select("fp", post)
    pairs = index.withColumnRenamed("fp", "x").join(index.withColumnRenamed("fp", "y"), ["posting", "value"]).where("x < y")
    return pairs.groupBy("x", "y").agg(F.count("*").alias("share"))


def links(fps: DataFrame, bits: int = 3, width: int = 3, splits: int = 2) -> DataFrame:
    """Distinct ``fp`` values -> pairs (x, y), x < y, with at most ``bits`` differing bits."""
    where = postings(width, splits)
    likely = tallied(fps, where).where(F.col("share") >= least_shared(where, bits))
    return likely.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= bits).select("x", "y")


def _roots(heads: DataFrame, bits: int, width: int) -> DataFrame:
    """fp, head, n and root of every row of ``heads``; the root is the fingerprint of the smallest id (no id is last)."""
    node = F.struct(F.col("head").isNull().alias("none"), F.coalesce("head", F.lit(0)).alias("head"), "fp")
    near = stored(links(heads.select("fp"), bits, width), "near")
    linked = components(near.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnsRenamed({"node": "fp", "root": "group"})
    members = linked.join(heads, "fp")
    first = members.groupBy("group").agg(F.min(node).alias("root"))
    roots = members.join(first, "group").select("fp", "root")
    return heads.join(roots, "fp", "left").select("fp", "head", "n", F.coalesce("root", node).alias("root"))


def _heads(marks: DataFrame) -> DataFrame:
    """Every fingerprint, its smallest id and its number of rows."""
    return stored(marks.groupBy("fp").agg(F.min("doc_id").cast("long").alias("head"), F.count("*").alias("n")), "heads")


def simhash_dedup(docs: DataFrame, shingle: int = 3, bits: int = 3, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable), a row per document.

    A fingerprint with more than 1/100,000 of all rows meets its root by a broadcast (there are fewer than
    100,000 of those), the others by a shuffle in which no key has more rows than that.
    """
    own = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    marks = stored(fingerprints(docs, shingle), "fingerprints")
    heads = _heads(marks)
    label = F.when(~F.col("root.none"), F.col("root.head")).alias("component_id")
    roots = stored(_roots(heads, bits, width).select("fp", "n", label), "roots")
    hot = F.col("n") * HOT > total(heads, F.col("n"))
    many, few = roots.where(hot).select("fp", "component_id"), roots.where(~hot).select("fp", "component_id")
    rest = marks.join(F.broadcast(many.select("fp")), "fp", "left_anti").join(few, "fp")
    return marks.join(F.broadcast(many), "fp").unionByName(rest).select("doc_id", own, "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, bits: int = 3, width: int = 3) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, then of the smallest fingerprint.

    Components are of fingerprints: rows that only share an id stay apart. A row without an id
    is kept only if no row of its component has one.
    """
    roots = _roots(_heads(fingerprints(docs, shingle)), bits, width)
    first = stored(roots.where(F.col("fp") == F.col("root.fp")).select(F.col("fp").alias("__fp"), F.col("head").alias("__id")), "first")
    rows = fingerprints(docs, shingle, tuple(docs.columns), "__mark")
    rows = rows.join(first, (rows["__mark"] == first["__fp"]) & rows["doc_id"].eqNullSafe(first["__id"]), "left_semi")
    whole = F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("__row")
    return rows.groupBy("__mark", F.col("doc_id").alias("__id")).agg(whole).select(*(F.col("__row")[c].alias(c) for c in docs.columns))
