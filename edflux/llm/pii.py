"""Personal data: fixed patterns, and the words that give the protected entities away.

Entities are the matches of the fixed patterns. Corpus statistics tell how strongly a term
reveals one: with n(t) documents holding the term, n(e, t) of them holding it beside the entity,
n(e) documents with the entity and N documents in all, the share
n(e, t) / n(t) is the chance that who reads the term names the entity, and
log2(N n(e, t) / (n(e) n(t))) the information that it gives. A term seen with an entity in at
least ``support`` documents is disclosed if it gives at least ``bits`` bits and its share reaches
``generalise`` (then it is replaced by its category) or ``remove`` (then it goes).

A term is beside every entity of its document, and a disclosed term is marked wherever it stands,
also in documents without the entity. With a number of words as ``context`` both hold only
within so many words of the entity.

Pairs are counted only where they can be disclosed: n(e, t) is at most n(e), n(t) and the number
of documents that hold the term beside any entity, so entities and terms that miss a threshold
with those bounds are left out first, and entities of the same documents count as one. The terms
looked for in the texts are put into a membership sketch of fixed size; a join with the exact
terms drops what else it lets through.

Cases: a null or empty text has no spans; repeated rows each count as a document and get a
row; terms inside fixed spans are no terms; a term under several entities is removed if any
asks for it; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.llm import sketch
from edflux.llm.common import count_kind, mask, slices, spans_text, stored
from edflux.llm.text import LOWER, byte_class, flat, word_hashes, word_spans

KINDS = ["email", "ip", "card", "phone", "general", "remove"]
#: The patterns of the entities.
# An email is its domain, from the @ on, and the run of LOCAL before it.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# No match starts inside a run of digits: what follows the run decides for all of its starts.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[A-Za-z\x80-\U0010ffff]+")
_NOT_TERM = ~(byte_class((97, 122), (128, 255)))
_BLOCK = 4 << 20


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping ``LOCAL+`` before a domain, in time linear in the text."""
    free = 0  # matches before it, or characters that no local part holds
    for m in DOMAIN.finditer(text):
        before = text[max(free, text.rfind("@", free, m.start()) + 1) : m.start()]
        size = len(before) - len(before.rstrip(LOCAL))
        if size:
            yield m.start() - size, m.end()
            free = m.end()


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """start, rank of the kind, end and normal form of every match that holds, in order."""
    found = []
    if "@" in text:
        found += [(a, 0, b, text[a:b].lower()) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [(m.start(), 1, m.end(), m[0]) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = "".join(c for c in m[0] if "0" <= c <= "9")
            if 9 <= len(digits) <= 15:
                found.append((m.start(), 3, m.end(), digits))
    return sorted(found)


def _around(text: str, found: list[tuple[int, int, int, str]], context: int) -> dict[tuple[int, bytes], set[tuple[int, int]]]:
    """(index of the entity, lower-cased term) -> places of the terms within ``context`` words of it."""
    terms = [(m.start(), m.end()) for m in _TERM.finditer(text)]
    starts, ends = np.array([t[0] for t in terms], np.int64), np.array([t[1] for t in terms], np.int64)
    free = _outside(starts, ends, found)
    at = np.flatnonzero(free)
    starts, ends = starts[at], ends[at]
    out: dict[tuple[int, bytes], set[tuple[int, int]]] = {}
    for i, (a, _, b, _) in enumerate(found):
        left, right = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b)
        for j in range(max(0, left - context), min(len(at), right + context)):
            s, e = int(starts[j]), int(ends[j])
            out.setdefault((i, text[s:e].encode().translate(LOWER.tobytes())), set()).add((s, e))
    return out


_FOUND = "row long, doc_id {}, base array<struct<start:int,rank:int,end:int,kind:string>>, near array<struct<e:long,t:long,at:array<struct<start:int,end:int>>>>"


def _find(docs: DataFrame, context: int) -> DataFrame:
    """A stored row for each document: its entities, and the terms near each."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    near_type = pa.list_(pa.struct([("e", pa.int64()), ("t", pa.int64()), ("at", pa.list_(place))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            base, near = [], []
            for text in batch.column("text").to_pylist():
                got = entities(text) if text else []
                base.append([(a, k, b, KINDS[k]) for a, k, b, _ in got])
                near.append(_near(text, got, context) if got else [])
            rows = pa.array(range(row, row + len(base)), pa.int64())
            row += len(base)
            yield pa.RecordBatch.from_arrays(
                [rows, batch.column("doc_id"), pa.array(base, base_type), pa.array(near, near_type)], ["row", "doc_id", "base", "near"]
            )

    return stored(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, _FOUND.format(kind)), "entities")


def _near(text: str, got: list[tuple[int, int, int, str]], context: int) -> list[tuple]:
    """One entry for each entity and term of the document, with the places of the term."""
    names = [_name(k, value) for _, k, _, value in got]
    around = _around(text, got, context)
    terms = sorted({t for _, t in around})
    sizes = np.array([len(t) for t in terms], np.int64)
    ends = np.cumsum(sizes)
    hashes = dict(zip(terms, word_hashes(np.frombuffer(b"".join(terms), np.uint8), ends - sizes, ends).view(np.int64).tolist(), strict=True))
    merged: dict[tuple[int, int], set[tuple[int, int]]] = {}
    for (i, t), places in around.items():
        merged.setdefault((names[i], hashes[t]), set()).update(places)
    return [(e, t, [{"start": a, "end": b} for a, b in sorted(p)]) for (e, t), p in sorted(merged.items())]


def _members(docs: DataFrame, terms: DataFrame, log2: int):
    """A broadcast sketch that reports the terms of ``terms`` (and a few others) as repeated."""

    def twice(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.repeat(batch.column("t").to_numpy(zero_copy_only=False).view(np.uint64), 2)  # counted twice: a member

    return docs.sparkSession.sparkContext.broadcast(sketch.merged(terms.select("t"), twice, log2))


def _document_counts(docs: DataFrame, terms: DataFrame, log2: int) -> DataFrame:
    """t, n: the number of documents that hold the term, for the terms of ``terms`` (and a few others)."""
    held = _members(docs, terms, log2)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for part in slices(iter([batch]), "text", _BLOCK):
                buf, off = flat(part.column("text"))
                buf = LOWER[buf]
                starts, ends, row = word_spans(buf, off, _NOT_TERM)
                own = word_hashes(buf, starts, ends)
                some = sketch.repeated(held.value, own, log2)
                each, code = np.unique(own[some].view(np.int64), return_inverse=True)
                words.append(each[np.unique(row[some] * len(each) + code) % len(each)] if len(each) else each)
            t, n = np.unique(np.concatenate(words), return_counts=True) if words else (np.empty(0, np.int64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(n)], ["t", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "t long, n long")
    return rows.groupBy("t").agg(F.sum("n").alias("n_t"))


def disclosures(
    found: DataFrame, docs: DataFrame, support: int = 2, bits: float = 4.0, generalise: float = 0.5, remove: float = 0.9, log2: int = 24
) -> DataFrame:
    """e, t, share, information and kind (general or remove) of the terms that reveal an entity."""
    near = found.select("row", F.explode("near").alias("x")).select("row", "x.e", "x.t")
    pairs = stored(near.groupBy("e", "t").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support), "pairs")
    with_e = found.select(F.explode(F.array_distinct(F.transform("near", lambda x: x["e"]))).alias("e")).groupBy("e").agg(F.count("*").alias("n_e"))
    n_t = _document_counts(docs, pairs.select("t").distinct(), log2)
    share = F.col("n_et") / F.col("n_t")
    gain = F.log2(share * F.lit(found.count()) / F.col("n_e"))
    rated = pairs.join(n_t, "t").join(with_e, "e").select("e", "t", share.alias("share"), gain.alias("information"))
    kind = F.when(F.col("share") >= remove, "remove").otherwise("general")
    return rated.where((F.col("share") >= generalise) & (F.col("information") >= bits)).withColumn("kind", kind)


def _name(rank: int, value: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(f"{rank}:{value}".encode())).view(np.int64))


def _places(buf: np.ndarray, off: np.ndarray, pick: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """row, hash, start and end (in code points) of the terms whose hashes ``pick`` flags, for each row with some."""
    starts, ends, row = word_spans(buf, off, _NOT_TERM)
    own = word_hashes(buf, starts, ends)
    some = np.flatnonzero(pick(own))
    if not len(some):
        return
    chars = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    row, own, starts, ends = row[some], own[some].view(np.int64), chars[starts[some]], chars[ends[some]]
    for lo, hi in itertools.pairwise([0, *(np.flatnonzero(np.diff(row)) + 1).tolist(), len(row)]):
        at = chars[off[row[lo]]]
        yield int(row[lo]), own[lo:hi], starts[lo:hi] - at, ends[lo:hi] - at


def _outside(starts: np.ndarray, ends: np.ndarray, found: list[tuple[int, int, int, str]]) -> np.ndarray:
    """Flags of the terms that overlap no entity."""
    free = np.ones(len(starts), bool)
    for a, _, b, _ in found:
        free[np.searchsorted(ends, a, side="right") : np.searchsorted(starts, b)] = False
    return free


def _beside(docs: DataFrame) -> DataFrame:
    """A stored row for each document with entities: their names, and the terms of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(iter([batch]), "text", _BLOCK):
                found = [entities(t) if t else [] for t in part.column("text").to_pylist()]
                some = [i for i, f in enumerate(found) if f]
                if not some:
                    continue
                terms: dict[int, list[int]] = {}
                buf, off = flat(part.column("text").take(pa.array(some)))
                for i, own, starts, ends in _places(LOWER[buf], off, lambda h: np.ones(len(h), bool)):
                    terms[i] = np.unique(own[_outside(starts, ends, found[some[i]])]).tolist()
                names = [sorted({_name(k, value) for _, k, _, value in found[i]}) for i in some]
                cols = [range(row, row + len(some)), names, [terms.get(i, []) for i in range(len(some))]]
                row += len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)],
                    ["row", "names", "terms"],
                )

    rows = docs.select(F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(run, "row long, names array<long>, terms array<long>"), "beside")


def told_terms(
    docs: DataFrame, support: int = 2, bits: float = 4.0, generalise: float = 0.5, remove: float = 0.9, log2: int = 24
) -> DataFrame:
    """t and kind (general or remove) of the terms that reveal an entity of a document that holds them."""
    beside, n = _beside(docs), docs.count()
    few = n / 2.0**bits  # more documents with the term, or with the entity, give fewer bits
    names = beside.where(F.size("terms") > 0).select("row", F.explode("names").alias("e"))
    with_e = names.groupBy("e").agg(F.count("*").alias("n_e"), *(F.sum(F.xxhash64("row", F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in (0, 1)))
    with_e = with_e.where((F.col("n_e") >= support) & (F.col("n_e") <= few))
    with_e = stored(with_e.groupBy("n_e", "h0", "h1").agg(F.min("e").alias("e")).select("e", "n_e"), "known")  # of the same documents: one
    names = stored(names.join(with_e, "e").groupBy("row").agg(F.collect_list(F.struct("e", "n_e")).alias("known")), "names")  # of one document
    held = stored(beside.join(names, "row").select("row", "known", "terms"), "held")
    most = held.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("most")).where((F.col("most") >= support) & (F.col("most") <= few))
    most = stored(most, "most")
    n_t = _document_counts(docs, most, log2).where(F.col("n_t") <= few)
    likely = stored(most.join(n_t, "t").where(F.col("most") / F.col("n_t") >= generalise).select("t", "n_t"), "likely")
    sure = _members(docs, likely, log2)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [np.asarray(t, np.int64) for t in batch.column("terms").to_pylist()]
            terms = [t[sketch.repeated(sure.value, t.view(np.uint64), log2)].tolist() for t in terms]
            yield pa.RecordBatch.from_arrays([batch.column("known"), pa.array(terms, pa.list_(pa.int64()))], ["known", "terms"])

    left = held.select("known", "terms").mapInArrow(thin, "known array<struct<e:long,n_e:long>>, terms array<long>").where(F.size("terms") > 0)
    pairs = left.select("known", F.explode("terms").alias("t")).select("t", F.explode("known").alias("x"))
    pairs = pairs.groupBy("t", "x.e", "x.n_e").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support)
    share = F.col("n_et") / F.col("n_t")
    rated = pairs.join(likely, "t").where((share >= generalise) & (F.log2(share * F.lit(n) / F.col("n_e")) >= bits))
    kind = F.when(F.max(share) >= remove, "remove").otherwise("general")
    return stored(rated.groupBy("t").agg(kind.alias("kind")), "told")


_MARKED = "row long, doc_id {}, base array<struct<start:int,rank:int,end:int,kind:string>>, hits array<struct<t:long,at:array<struct<start:int,end:int>>>>"
_SALTS = 32


def _mark(docs: DataFrame, told: DataFrame, log2: int) -> DataFrame:
    """doc_id, base and spans of every row, with the terms of ``told`` wherever they stand."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    hits_type = pa.list_(pa.struct([("t", pa.int64()), ("at", pa.list_(place))]))
    held = _members(docs, told, log2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(iter([batch]), "text", _BLOCK):
                found = [entities(t) if t else [] for t in part.column("text").to_pylist()]
                base = [[(a, k, b, KINDS[k]) for a, k, b, _ in f] for f in found]
                hits: list[list] = [[] for _ in found]
                buf, off = flat(part.column("text"))
                for i, own, starts, ends in _places(LOWER[buf], off, lambda h: sketch.repeated(held.value, h, log2)):
                    free = _outside(starts, ends, found[i])
                    at: dict[int, list] = {}
                    for t, a, b in zip(own[free].tolist(), starts[free].tolist(), ends[free].tolist(), strict=True):
                        at.setdefault(t, []).append({"start": a, "end": b})
                    hits[i] = list(at.items())
                rows = pa.array(range(row, row + len(base)), pa.int64())
                row += len(base)
                yield pa.RecordBatch.from_arrays(
                    [rows, part.column("doc_id"), pa.array(base, base_type), pa.array(hits, hits_type)], ["row", "doc_id", "base", "hits"]
                )

    found = stored(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, _MARKED.format(kind)), "marked")
    hits = found.select("row", F.explode("hits").alias("x")).select("row", "x.t", "x.at", F.pmod("row", F.lit(_SALTS)).cast("int").alias("salt"))
    salted = told.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))  # a term of many documents is dealt to several tasks
    return _spans(found, hits.join(salted, ["t", "salt"]).select("row", F.explode("at").alias("p"), "kind"))


def _spans(found: DataFrame, hits: DataFrame) -> DataFrame:
    """doc_id, base and spans of the rows of ``found``, with the places ``p`` of ``hits``."""
    rank = F.when(F.col("kind") == "remove", KINDS.index("remove")).otherwise(KINDS.index("general"))
    span = F.struct(F.col("p.start").alias("start"), rank.alias("rank"), F.col("p.end").alias("end"), F.col("kind").alias("kind"))
    more = hits.groupBy("row").agg(F.collect_list(span).alias("more"))  # of one document's words
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))))
    return found.join(more, "row", "left").select("doc_id", "base", spans.alias("spans"))


def find_personal(docs: DataFrame, context: int | None = None, log2: int = 24, **thresholds) -> DataFrame:
    """doc_id, base (fixed spans in order) and spans (also of disclosing terms) of every row."""
    if context is None:
        return _mark(docs, told_terms(docs, log2=log2, **thresholds), log2)
    found = _find(docs, context)
    told = stored(disclosures(found, docs, log2=log2, **thresholds), "disclosures")
    near = found.select("row", F.explode("near").alias("x")).select("row", "x.e", "x.t", F.explode("x.at").alias("p"))
    return _spans(found, near.join(told, ["e", "t"]).groupBy("row", "p").agg(F.max("kind").alias("kind")))  # remove is after general


def sanitise(docs: DataFrame, context: int | None = None, **thresholds) -> DataFrame:
    """``docs`` with entities and generalised terms replaced by ``[kind]`` and removed terms left out.

    Rows are written once, with a number each, and masked by their own spans: equal or missing
    ids don't matter.
    """
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = find_personal(rows.select(F.col("__row").alias("doc_id"), "text"), context, **thresholds)
    rows = rows.join(found.select(F.col("doc_id").alias("__row"), F.col("spans").alias("__spans")), "__row")
    tag = mask(F.col("text"), F.col("__spans"), lambda s: F.when(s["kind"] == "remove", "").otherwise(F.concat(F.lit("["), s["kind"], F.lit("]"))))
    return rows.select(*(tag.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the fixed spans, and all spans as text."""
    counts = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
