"""Align the tokens of two tokenizers by the bytes they cover, and count linked id pairs.

A is a byte-level BPE of the library tokenizers, B a sentencepiece model; both cover a space
and the text. Token ends are found in two steps. Coarse cuts come from the libraries: the
character offsets of A, where the next token starts behind a token's end, and the spans of B
(from sentencepiece's offset mapping, as version 0.2.3 gives no immutable protos any more),
where a span isn't empty. Tokens between two cuts share a character (a multibyte one that A
splits, or byte fallback in B) and are placed by the length of their decoded bytes.

Both tokenizers end a token before a single space between two other characters: A's rule for
words never joins what stands before a space with it, and no piece of B holds a space behind
another character (checked on the vocabulary). A text is therefore cut there, and equal
segments of a task are encoded once. Tokenizers without these properties get whole texts.

Cases: texts that are null, empty, not UTF-8, or whose joined token bytes differ from a space
and the text (say, a text that holds U+2581) have no tokens: zeros, no groups and no links.
Repeated rows are handled row by row, and each counts; extra columns are kept, those named
like results are replaced; empty tables give empty results. A text is one row's work.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.llm.common import slices, stored, total

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"

#: A character that is surely no white space, control or format character.
_SOLID = re.compile(r"[^\s\x00-\x20\x7f-\xa0\u180e\u200b-\u200f\u2028-\u202f\u205f-\u206f\ufeff]")
_LINKS = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int32())]))
_TYPES = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string(), "links": _LINKS}
_NONE = np.empty(0, np.int64)
RESULT = "n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<pair:long,n:int>>"


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, then from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def refined(cut: np.ndarray, coarse: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: ``cut`` where ``coarse``, else the cut before (or 0) plus decoded widths."""
    behind = np.concatenate(([0], np.cumsum(width)))
    anchor = np.maximum.accumulate(np.where(coarse, np.arange(len(width)), -1))
    return np.where(anchor >= 0, cut[anchor], 0) + behind[1:] - behind[anchor + 1]


def _runs(sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The places of all members of the runs ``which``, when runs of ``sizes`` follow each other."""
    n = sizes[which].astype(np.int64)
    return np.repeat(np.cumsum(sizes, dtype=np.int64)[which] - np.cumsum(n), n) + np.arange(n.sum())


class Aligner:
    """Both tokenizers with their tokens' bytes, and the alignments of segments met before.

    A segment has a number: ``clean`` has those of words that stand alone between any two other
    such words, ``odd`` the rest. ``most`` bounds how many are kept from one call to the next.
    """

    def __init__(self, a_json: str, b_model: bytes, most: int = 300_000):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        vocab, level = self.a.get_vocab(with_added_tokens=True), byte_level()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(map(level.__getitem__, token)) if all(map(level.__contains__, token)) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.names = np.array([str(i) for i in range(max(len(self.a_bytes), len(pieces)))], object)
        rules, probe = json.loads(a_json), "\ufb01 \uff21 \u00b2 \u00e9"  # each but the last changes under compatibility rules
        before = rules.get("pre_tokenizer") or {}
        self.cuts = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not rules.get("normalizer")
            and all(t["special"] for t in rules.get("added_tokens") or [])
            and not any(re.search("[^\u2581]\u2581", p) for p in pieces)
            and self.b.normalize(probe).replace("\u2581", " ").strip() == probe
        )
        self.most, self.clean, self.odd = most, {}, {}
        self.texts: list[str | None] = []  # groups of each segment, None if its tokens' bytes aren't its own
        self.counts = [np.empty((0, 4), np.int32)]  # tokens of A and B, groups and links of each segment
        self.links = [_NONE]
        self.uses = _NONE

    def forget(self) -> None:
        """Keep the half of ``most`` segments that were used most."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.most // 2])
        new = np.full(len(self.texts), -1)
        new[kept] = np.arange(len(kept))
        new, counts, links = new.tolist(), np.concatenate(self.counts), np.concatenate(self.links)
        self.clean, self.odd = ({s: new[k] for s, k in held.items() if new[k] >= 0} for held in (self.clean, self.odd))
        self.texts = [self.texts[k] for k in kept.tolist()]
        self.links = [links[_runs(counts[:, 3], kept)]]
        self.counts, self.uses = [counts[kept]], self.uses[kept]

    def segments(self, words: list[str], known: list[int | None]) -> list[str]:
        """The segments of a text, each without the space before it, from its words between single spaces."""
        out, at, closed = [], 0, True
        for i, (word, k) in enumerate(zip(words, known, strict=True)):
            if i and closed and (k is not None or _SOLID.match(word)):
                out.append(" ".join(words[at:i]))
                at = i
            closed = k is not None or bool(_SOLID.match(word[-1:]))
        return [*out, " ".join(words[at:])]

    def numbered(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's segments; new segments are encoded together."""
        if len(self.texts) > self.most:
            self.forget()
        words = [t.split(" ") for t in texts] if self.cuts else [[t] for t in texts]
        at = len(self.texts)
        fresh = [w for w in set().union(*words) - self.clean.keys() if self.cuts and _SOLID.match(w) and _SOLID.match(w[-1])]
        self.clean |= zip(fresh, range(at, at + len(fresh)), strict=True)
        out = []
        for own in words:
            known = list(map(self.clean.get, own))
            if None in known:
                for k, s in enumerate(segments := self.segments(own, known) if self.cuts else own):
                    n = self.clean.get(s)
                    if n is None and (n := self.odd.setdefault(s, at + len(fresh))) == at + len(fresh):
                        fresh.append(s)
                    segments[k] = n
                known = segments
            out.append(known)
        if fresh:
            gc.disable()  # so many small objects make the collector run in vain
            try:
                joined: list[str] = []
                for segment in fresh:  # those with solid ends are encoded together, as parts of a text
                    alone = not self.cuts or not _SOLID.match(segment) or not _SOLID.match(segment[-1])
                    if joined and (alone or len(joined) >= 512):
                        self.learn(joined)
                        joined = []
                    if alone:
                        self.learn([segment])
                    else:
                        joined.append(segment)
                if joined:
                    self.learn(joined)
            finally:
                gc.enable()
        return out

    def learn(self, new: list[str]) -> None:
        """Encode segments, find their tokens' ends and align them."""
        raw = [b" " + s.encode() for s in new]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        behind, joined, text = np.cumsum(size), b"".join(raw), " ".join(new)
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text, return_type="offset_mapping", return_bytes=True)
        points = np.append(np.flatnonzero((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80), len(joined))  # first bytes of characters
        sides = []
        for table, ids, spans in ((self.a_bytes, a.ids, a.offsets), (self.b_bytes, b["ids"], b["offsets"])):
            tokens = list(map(table.__getitem__, ids))
            if b"".join(tokens) != joined:
                if len(new) == 1:
                    self.texts.append(None)
                    self.counts.append(np.zeros((1, 4), np.int32))
                else:
                    self.learn(new[: len(new) // 2])
                    self.learn(new[len(new) // 2 :])
                return
            width = np.fromiter(map(len, tokens), np.int64, len(ids))
            start, end = np.fromiter(chain.from_iterable(spans), np.int64, 2 * len(ids)).reshape(-1, 2).T
            if table is self.a_bytes:
                coarse, cut = np.append(start[1:] >= end[:-1], True), points[end]
            else:
                coarse, cut = end > start, end + 1  # spans leave out the first space
            sides.append((np.array(ids, np.int64), refined(cut, coarse, width)))
        self.align(*sides, behind)

    def align(self, a_side: tuple, b_side: tuple, behind: np.ndarray) -> None:
        """Groups and links from ids and byte ends of both sides' tokens; ``behind``: the segments' ends."""
        (a, ea), (b, eb) = a_side, b_side
        both, either = np.intersect1d(ea, eb, assume_unique=True), np.union1d(ea, eb)
        links = a[np.searchsorted(ea, either)] << 32 | b[np.searchsorted(eb, either)]  # one for each run between ends
        key = np.concatenate((2 * np.searchsorted(both, ea), 2 * np.searchsorted(both, eb) + 1))
        order = np.argsort(key, kind="stable")  # group by group, A before B
        key = key[order]
        step = np.diff(key, append=-1)
        words = np.empty(2 * len(order), object)
        words[0::2] = self.names[np.concatenate((a, b))[order]]
        words[1::2] = np.where(step == 0, ",", np.where((step == 1) & (key % 2 == 0), "|", ";"))
        words = words.tolist()
        ends = [np.searchsorted(x, behind, side="right") for x in (ea, eb, both, either)]
        to = (2 * (ends[0] + ends[1])).tolist()
        self.texts += ["".join(words[i : j - 1]) for i, j in zip([0, *to], to, strict=False)]
        self.counts.append(np.diff(np.stack(ends, axis=1), axis=0, prepend=0).astype(np.int32))
        self.links.append(links)

    def aligned(self, texts: list[str]) -> Iterator[tuple[list[int], str, np.ndarray] | None]:
        """For each text the four counts, its groups, and a pair for each link; None without tokens."""
        numbers = self.numbered(texts)
        self.counts, self.links = [np.concatenate(self.counts)], [np.concatenate(self.links)]
        counts, links = self.counts[0], self.links[0]
        own = np.fromiter(chain.from_iterable(numbers), np.int64)
        links = links[_runs(counts[:, 3], own)]
        uses = np.bincount(own, minlength=len(counts))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        counts, first = counts[own].astype(np.int64), np.cumsum([0, *map(len, numbers)])
        total = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(counts, axis=0)))[first]
        for k, (held, n) in enumerate(zip(numbers, np.diff(total, axis=0).tolist(), strict=True)):
            groups = list(map(self.texts.__getitem__, held))
            yield None if None in groups else (n, ";".join(groups), links[total[k, 3] : total[k + 1, 3]])


def alignments(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, groups and links.

    groups: ``a1,a2|b1;a3|b2,b3``, ids in order. links: each id pair (A's id times 2**32 plus B's)
    with the number of its occurrences. The files are read on the driver and sent to the
    executors (some MB: vocabularies).
    """
    own = [c for c in docs.columns if c not in _TYPES]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        held = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    return docs.select(*(F.col(f"`{c}`") for c in own)).mapInArrow(_mapper(held, own), f"{schema}, {RESULT}")


def _mapper(held, own: list[str]):
    def text_of(raw: bytes | None) -> str | None:
        try:
            return raw.decode() if raw else None
        except UnicodeDecodeError:
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(*held.value)
        for batch in slices(batches, "text", 4 << 20):
            texts = [text_of(x) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            found = aligner.aligned([t for t in texts if t])
            rows, pairs, counts, sizes = [], [], [], [0]
            for t in texts:
                numbers, groups, links = (next(found) if t else None) or ([0, 0, 0, 0], "", _NONE)
                pair, n = np.unique(links, return_counts=True)
                rows.append((*numbers, groups))
                pairs.append(pair)
                counts.append(n.astype(np.int32))
                sizes.append(len(pair))
            flat = [np.concatenate(x) for x in (pairs, counts)]
            linked = pa.ListArray.from_arrays(np.cumsum(sizes).astype(np.int32), pa.StructArray.from_arrays([pa.array(x) for x in flat], names=["pair", "n"]))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), list(_TYPES.values())[:-1], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *columns, linked.cast(_LINKS)], [*own, *_TYPES])

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (its links in all rows) and best (1 if no pair with the same id of B has more)."""
    counts = stored(aligned.select(F.inline("links")).groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    most = counts.groupBy(b).agg(F.max("count").alias("most"))  # a row for each id of B's vocabulary at most
    return counts.select("pair", "count", b).join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def link_scores(aligned: DataFrame, hot_pairs: int = 1 << 19) -> DataFrame:
    """The rows of :func:`alignments` without links, with n_best and count_sum over each row's links.

    Fewer than ``hot_pairs`` pairs can each hold more than a ``hot_pairs``-th of all links: these
    are broadcast. The others are joined by a shuffle, in which no pair is hot.
    """
    rows = stored(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(rows), "pair-counts")
    least = total(rows, "n_links") / hot_pairs
    hot, cold = F.broadcast(counts.where(F.col("count") > least)), counts.where(F.col("count") <= least)
    each = rows.select("__row", F.inline("links"))
    rare = each.join(hot.select("pair"), "pair", "left_anti").join(cold, "pair")
    columns = ["__row", (F.col("n") * F.col("count")).alias("sum"), (F.col("n") * F.col("best")).alias("n_best")]
    scores = each.join(hot, "pair").select(*columns).unionByName(rare.select(*columns))
    scores = scores.groupBy("__row").agg(F.sum("sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    kept = rows.drop("links", "n_best", "count_sum").join(scores, "__row", "left").drop("__row")
    return kept.na.fill(0, ["n_best", "count_sum"])
