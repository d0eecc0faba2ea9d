"""Find benchmark passages in documents with one Aho-Corasick automaton.

Items (test questions and answers) are normalised to words; a window is ``window`` consecutive
words of an item, or the whole item if it has fewer. The words of all items are numbered and
written as two characters each, a leading and a trailing one from alphabets that share none and
have about as many characters as the root of the number of words. The automaton holds every distinct
window of such pairs, so it has two nodes a word at most, and no node has many branches. Each document is
normalised the same way, written in these pairs and scanned once. Hits start at leading characters,
so they are whole words; their places are mapped to code points of the original text.

Memory: twice ``window`` nodes for each word of the items at most, about 70 bytes a node. Beyond
``most_nodes`` the items are dealt to several automata, and the documents run through one after
another, row by row, without a shuffle. Items pass through the driver one such part at a time, and
a worker process builds an automaton once, whatever number of tasks it runs.

Cases: null and empty texts and items have no words; an item without an id counts under the
id null, written as "null"; equal windows of several items count for each of them; repeated
documents and items are handled row by row (items by id); with no items nothing is hit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.llm.common import total
from edflux.llm.text import LOWER, NOT_WORD, word_spans

_TO_NORMAL = bytes(32 if NOT_WORD[LOWER[b]] else int(LOWER[b]) for b in range(256))
#: A word before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RESULT = "n_words long, hit_words binary, items array<string>, spans array<struct<start:int,end:int>>"


def normal_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z; words are runs of digits, letters and non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_NORMAL).split()


class Windows:
    """Automaton over the windows of (id, text) items; each yields its word count and item ids."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        number: dict[bytes, int] = {}
        texts = [(item, [number.setdefault(w, len(number)) for w in normal_words(text)]) for item, text in items]
        base = math.isqrt(len(number)) + 1
        pairs = [chr(base + n // base) + chr(n % base) for n in range(len(number))]
        self.pair, self.other = dict(zip(number, pairs, strict=True)), chr(2 * base + 1) * 2
        owners: dict[str, set[str]] = {}
        for item, words in texts:
            k = min(window, len(words))
            for i in range(len(words) - k + 1) if k else ():
                owners.setdefault("".join([pairs[n] for n in words[i : i + k]]), set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for w, ids in owners.items():
            self.automaton.add_word(w, (len(w) // 2, frozenset(ids)))
        if owners:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Flags of the words inside hits, and the items hit."""
        flags = np.zeros(len(words), bool)
        items: set[str] = set()
        if self.pair:
            for at, (k, ids) in self.automaton.iter("".join([self.pair.get(w, self.other) for w in words])):
                last = at // 2
                flags[last - k + 1 : last + 1] = True
                items |= ids
        return flags, items


def _spans(text: str, flags: np.ndarray) -> list[dict[str, int]]:
    """Code points from the first to the last word of every run of hit words."""
    raw = text.encode("utf-8", "surrogatepass")
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_spans(LOWER[buf], np.array([0, len(buf)]), NOT_WORD)
    point = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    pairs = zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1, strict=True)
    return [{"start": int(point[starts[a]]), "end": int(point[ends[b]])} for a, b in pairs]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, most_nodes: int = 4 << 20) -> DataFrame:
    """``docs`` with n_words, hit_words (one byte a word), items and spans of hits in code points.

    ``items`` has item_id and text. ``most_nodes`` bounds the nodes of one automaton.
    """
    spark = docs.sparkSession
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").where("text is not null")
    words = total(items, F.regexp_count("text", F.lit(WORD)))
    shards = max(1, math.ceil(2 * words * window / most_nodes))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))
    own = [c for c in docs.columns if c not in ("n_words", "hit_words", "items", "spans")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    out = docs.select(*(F.col(f"`{c}`") for c in own))
    for k in range(shards):
        part = [(r.item_id, r.text) for r in items.where(shard == k).toLocalIterator()]  # most_nodes, on average
        held = spark.sparkContext.broadcast({"items": part})
        out = out.mapInArrow(_scanner(held, window, own, k > 0), f"{schema}, {RESULT}")
    return out


def _windows(held, window: int) -> Windows:
    """Built by the first task of a worker process, which keeps what was broadcast to it."""
    if "windows" not in held.value:
        held.value["windows"] = Windows(held.value.pop("items"), window)
    return held.value["windows"]


def _scanner(held, window: int, own: list[str], again: bool):
    """Scan with the automaton of ``held``; ``again``: add to the results of another."""
    types = {
        "n_words": pa.int64(),
        "hit_words": pa.binary(),
        "items": pa.list_(pa.string()),
        "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
    }

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(held, window)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in types}
            old = batch.select(["hit_words", "items"]).to_pylist() if again else [None] * batch.num_rows
            for text, prior in zip(batch.column("text").to_pylist(), old, strict=True):
                words = normal_words(text)
                flags, ids = windows.scan(words)
                if prior:
                    flags |= np.frombuffer(prior["hit_words"], bool)
                    ids |= set(prior["items"])
                out["n_words"].append(len(words))
                out["hit_words"].append(flags.tobytes())
                out["items"].append(sorted(ids))
                out["spans"].append(_spans(text, flags) if flags.any() else [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), *(pa.array(out[k], t) for k, t in types.items())], [*own, *types]
            )

    return scan


def digest(found: DataFrame) -> DataFrame:
    """One row per document: counts, the item ids' hash, and whether any word was hit."""
    hit = F.length(F.expr("translate(hex(hit_words), '0', '')")).cast("long")  # bytes are 00 or 01
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
