"""Toxicity of texts whose words may be disguised: a noisy channel, then a word model.

Channel: writers replace letters by look-alikes (1d1ot), repeat them (idiiiot, iiddiioott), space them
out (i d ! o t), break words (id iot) and put characters without width or pictures between
letters (these are taken out, or read as blanks). A disguised token is a lattice with one column per observed run of a
character; its readings cost what the channel asks for the disguise plus the negative
log-probability under a trigram language model of characters, counted over all documents.
The Viterbi path is the restored token. Tokens without such signs have one reading and are
left alone.

Score: logistic regression on the presence of words in the restored text. It is fitted on
at most ``sample_rows`` labelled rows (those with the least hash of their id, from the folds used for
learning), with the ``features`` words that tell the classes apart best.

Cases: a null or empty text has no words and gets the score of the intercept; without any
labelled row, or with labels of one class only, every text gets a smoothed class share, below
0.5 if nothing is known; several labels of a document count as toxic if one does; repeated
rows are scored alike; an empty table gives no rows; columns named like results are replaced.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edflux.llm.common import slices, stored
from edflux.llm.text import LOWER, byte_class, flat, word_hashes, word_spans

#: Letters that a character may stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
#: Costs in nats: a look-alike, a letter written three times or more, a letter written twice that is one, a gap between
#: single characters that is one, a gap between longer pieces that is none, a sign that is none.
SWAP, REPEAT, TWICE, GAP, JOIN, STAY = 2.0, 1.0, 5.0, 2.0, 7.0, 10.0
#: UTF-8 bytes of characters without width (soft hyphen; U+200B to U+200D; U+2060; U+FE0F; U+FEFF; a third byte of 0 is none).
UNSEEN = [(0xC2, 0xAD, 0), (0xE2, 0x80, 0x8B), (0xE2, 0x80, 0x8C), (0xE2, 0x80, 0x8D), (0xE2, 0x81, 0xA0), (0xEF, 0xB8, 0x8F), (0xEF, 0xBB, 0xBF)]
#: First byte, range of the second, and length of characters that are pictures (U+2600 to U+27BF, U+1F000 to U+1FFFF).
PICTURES = [(0xE2, 0x98, 0x9E, 3), (0xF0, 0x9F, 0x9F, 4)]
CODES = 28  # 0: no letter, 1 to 26: a to z, 27: bytes of other letters

_CODE = np.zeros(256, np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27
_LETTER = byte_class((97, 122))
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKES]] = True
_NOT_TOKEN = ~(_LETTER | _SIGN)
_NOT_ALNUM = ~(_LETTER | byte_class((48, 57), (128, 255)))
_NOT_SPACED = _NOT_ALNUM & ~_SIGN
_NOT_LETTER = ~(_LETTER | byte_class((128, 255)))
_BLOCK = 4 << 20


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of character codes over all texts, as a cube."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES**3, np.int64)
        for batch in batches:
            for part in slices(iter([batch]), "text", _BLOCK):
                buf, off = flat(part.column("text"))
                c = np.zeros(len(buf) + 2 * (len(off) - 1), np.int64)  # two blanks after each text
                at = np.arange(len(buf)) + 2 * np.repeat(np.arange(len(off) - 1), np.diff(off))
                c[at] = _CODE[buf]
                total += np.bincount((c[:-2] * CODES + c[1:-1]) * CODES + c[2:], minlength=CODES**3) if len(c) > 2 else 0
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["gram", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(CODES**3)
    for r in rows.collect():  # CODES**3 rows at most
        out[r.gram] = r.n
    return out.reshape(CODES, CODES, CODES)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Negative log-probabilities of a code after two others: trigrams smoothed by bigrams and single codes."""
    one = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + CODES)
    two = (counts.sum(axis=0) + 20 * one) / (counts.sum(axis=(0, 2))[:, None] + 20)
    three = (counts + 20 * two[None]) / (counts.sum(axis=2, keepdims=True) + 20)
    return -np.log(three)


def _columns(token: str) -> list[list[tuple[str, float]]]:
    """Readings and channel costs of each run of one character."""
    runs = [len(list(own)) for c, own in itertools.groupby(token) if c.isalpha()]
    twice = REPEAT if 2 * runs.count(2) > len(runs) else TWICE  # a token of doubled letters was written so on purpose
    out, i = [], 0
    while i < len(token):
        j = i
        while j < len(token) and token[j] == token[i]:
            j += 1
        n, c, i = j - i, token[i], j
        if c == " ":
            alone = token[i - 3 : i - 2] in ("", " ") and token[j + 1 : j + 2] in ("", " ")  # single characters on both sides
            out.append([("", 0.0), (" ", GAP)] if alone else [("", JOIN), (" ", 0.0)])
            continue
        letters = [(c, 0.0)] if c.isalpha() else [(x, SWAP) for x in LOOKALIKES.get(c, "")]
        times = [(1, 0.0)] if n == 1 else [(1, twice), (2, 0.0)] if n == 2 else [(1, REPEAT), (2, REPEAT)]
        column = [(x * k, cost * min(n, 2) + extra) for x, cost in letters for k, extra in times]
        out.append(column if c.isalpha() else [*column, (c * n, STAY * min(n, 2))])
    return out


def restore(token: str, model: np.ndarray) -> str:
    """The reading of a disguised token with the least cost."""
    paths: dict[tuple[int, int], tuple[float, int]] = {(0, 0): (0.0, 0)}  # by the last two codes: cost and last step
    steps: list[tuple[int, str]] = [(0, "")]  # the step before and what it read
    for column in [*_columns(token), [(" ", 0.0)]]:
        best: dict[tuple[int, int], tuple[float, int, str]] = {}
        for (a, b), (cost, last) in paths.items():
            for reading, extra in column:
                x, y, now = a, b, cost + extra
                for ch in reading:
                    z = int(_CODE[ord(ch)]) if ord(ch) < 128 else 27
                    now += model[x, y, z]
                    x, y = y, z
                if (x, y) not in best or now < best[x, y][0]:
                    best[x, y] = (now, last, reading)
        paths = {}
        for state, (cost, last, reading) in best.items():
            paths[state] = cost, len(steps)
            steps.append((last, reading))
    said, at = [], min(paths.values())[1]
    while at:
        at, reading = steps[at]
        said.append(reading)
    return "".join(reversed(said)).rstrip(" ")


def visible(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes and row offsets without zero-width characters; pictures are blanks."""
    buf, off = flat(column)
    buf = LOWER[buf]
    if len(buf) < 3 or not (buf >= 0xC2).any():
        return buf, off
    last = np.concatenate((buf[1:], [0])), np.concatenate((buf[2:], [0, 0]))
    gone = np.zeros(len(buf) + 3, bool)
    for first, second, third in UNSEEN:
        at = np.flatnonzero((buf == first) & (last[0] == second) & ((last[1] == third) | (third == 0)))
        for k in range(3 if third else 2):
            gone[at + k] = True
    for lead, low, high, size in PICTURES:
        at = np.flatnonzero((buf == lead) & (last[0] >= low) & (last[0] <= high))
        for k in range(size):
            buf[np.minimum(at + k, len(buf) - 1)] = 32
    gone = gone[: len(buf)]
    return (buf[~gone], off - np.concatenate(([0], np.cumsum(gone)))[off]) if gone.any() else (buf, off)


def suspects(buf: np.ndarray, off: np.ndarray, model: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, start, end) of what may be disguised, apart from each other and in order.

    That is tokens with look-alikes beside letters or with a letter twice in a row; three or more single
    characters (signs that stand alone among them) in a row; and neighbouring words where the language
    model takes the gap between them for none.
    """
    n = len(buf)
    if n < 3:
        return []
    letter, sign = _LETTER[buf], _SIGN[buf]
    odd = np.zeros(n, bool)
    odd[:-1] = (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:]) | (letter[:-1] & (buf[:-1] == buf[1:]))
    starts, ends, row = word_spans(buf, off, _NOT_TOKEN)
    at = np.flatnonzero(odd)
    of = np.searchsorted(starts, at, side="right") - 1
    of = np.unique(of[(of >= 0) & (at + 1 < ends[of])]) if len(at) and len(starts) else np.empty(0, np.int64)
    spans = [(row[of], starts[of], ends[of])]
    plain = ~_NOT_ALNUM[buf]
    beside = np.zeros(n, bool)
    beside[1:] |= plain[:-1] | sign[:-1]
    beside[:-1] |= plain[1:] | sign[1:]
    chars = np.where(sign & ~plain & beside, np.uint8(32), buf)  # signs stay where they stand alone
    starts, ends, row = word_spans(chars, off, _NOT_SPACED)
    if len(starts) > 1:
        single, near = ends - starts == 1, row[1:] == row[:-1]
        for size, linked in ((2, near & single[1:] & single[:-1]), (1, near & _unbroken(buf, starts, ends, model))):
            edge = np.diff(np.concatenate(([False], linked, [False])).astype(np.int8))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            first, last = first[last - first >= size], last[last - first >= size]
            spans.append((row[first], starts[first], ends[last]))
    row, start, end = (np.concatenate(x) for x in zip(*spans, strict=True))
    if not len(row):
        return []
    order = np.argsort(start, kind="stable")
    row, start, end = row[order], start[order], np.maximum.accumulate(end[order])
    head = np.concatenate(([True], start[1:] >= end[:-1]))  # overlapping ones are read as one
    tail = np.concatenate((head[1:], [True]))
    return list(zip(row[head].tolist(), start[head].tolist(), end[tail].tolist(), strict=True))


def _unbroken(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Whether words of letters read better joined to the next one, by the trigrams across the gap."""
    code = _CODE[buf]
    whole = np.concatenate(([0], np.cumsum(~_LETTER[buf])))
    whole = whole[starts] == whole[ends]
    size = ends - starts
    gap = starts[1:] - ends[:-1]
    blanks = np.concatenate(([0], np.cumsum(buf == 32)))
    close = (gap == 1) | (blanks[starts[1:]] - blanks[ends[:-1]] == gap)
    close &= whole[1:] & whole[:-1] & ((size[1:] > 1) | (size[:-1] > 1))
    i = np.flatnonzero(close)
    e, s = ends[i] - 1, starts[i + 1]
    x, y = np.where(size[i] > 1, code[e - 1], 0), code[e]
    z, t = code[s], np.where(size[i + 1] > 1, code[np.minimum(s + 1, len(buf) - 1)], 0)
    close[i] = model[x, y, z] + model[y, z, t] + JOIN < model[x, y, 0] + model[y, 0, z] + model[0, z, t]
    return close


def reader(model: np.ndarray) -> Callable[[bytes], bytes | None]:
    """Reads the bytes of a suspect: the restored ones, or None if they say what they show. Keeps what it has read."""

    @functools.lru_cache(1 << 16)
    def read(old: bytes) -> bytes | None:
        shown = "".join(c if c.isalnum() or c in LOOKALIKES else " " for c in old.decode("ascii", "ignore"))
        token = " ".join(shown.split()).lstrip("!|+ ").rstrip("!$|+ ")
        if not any(c.isalpha() for c in token):
            return None
        new = restore(token, model)
        return None if new == token else new.encode()

    return read


def restored(column: pa.Array, model: np.ndarray, read: Callable[[bytes], bytes | None] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased texts with restored tokens: bytes, offsets, and restored tokens by row."""
    buf, off = visible(column)
    read = read or reader(model)
    pieces, at, rows, grown = [], 0, [], []
    for row, a, b in suspects(buf, off, model):
        new = read(buf[a:b].tobytes())
        if new is not None:
            pieces += [buf[at:a], np.frombuffer(b" " + new + b" ", np.uint8)]
            rows.append(row)
            grown.append(len(new) + 2 - (b - a))
            at = b
    n = np.bincount(np.array(rows, np.int64), minlength=len(off) - 1)
    if not rows:
        return buf, off, n
    longer = np.zeros(len(off) - 1, np.int64)
    np.add.at(longer, rows, grown)
    return np.concatenate([*pieces, buf[at:]]), off + np.concatenate(([0], np.cumsum(longer))), n


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word of letters."""
    starts, ends, row = word_spans(buf, off, _NOT_LETTER)
    return row, word_hashes(buf, starts, ends).view(np.int64)


def held_out(doc_id: Column) -> Column:
    """The rows kept apart for testing: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample_rows: int = 20_000, features: int = 4096) -> tuple[np.ndarray, np.ndarray, float]:
    """Sorted word hashes, their weights, and the intercept."""
    labels = labels.where(~held_out(F.col("doc_id"))).where("toxic is not null and doc_id is not null")
    labels = labels.groupBy(F.col("doc_id").alias("__id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sample = stored(labels.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows), "labelled")
    text = docs.select(F.col("doc_id").alias("__doc"), F.col("text").cast("string").alias("text"))
    rows = text.join(F.broadcast(sample), F.col("__doc") == F.col("__id"))  # sample_rows small rows at most
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")  # of an id's rows
    rows = rows.groupBy("__id", "toxic").agg(one).select("toxic", "one.text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(model)
        for batch in batches:
            for part in slices(iter([batch]), "text", _BLOCK):
                buf, off, _ = restored(part.column("text"), model, read)
                row, own = _words(buf, off)
                pairs = np.unique(np.stack((row, own), axis=1), axis=0) if len(row) else np.empty((0, 2), np.int64)
                edges = np.searchsorted(pairs[:, 0], np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(pairs[:, 1]))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), lists], ["toxic", "words"])

    held = stored(rows.mapInArrow(words, "toxic int, words array<long>"), "words")
    n, pos = held.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = (pos + 0.5) / (n + 2)
    none = np.empty(0, np.int64), np.empty(0), math.log(share / (1 - share))
    if not 0 < pos < n:
        return none
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (pos - F.col("a") + 0.5)) - F.log(b / (n - pos - F.col("b") + 0.5))
    error = F.sqrt(1 / a + 1 / (pos - F.col("a") + 0.5) + 1 / b + 1 / (n - pos - F.col("b") + 0.5))
    seen = held.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    z = F.abs(odds / error)
    seen = seen.where(F.col("a") + F.col("b") >= max(5, n // 1000)).withColumn("z", z).where("z >= 2.5").orderBy(F.desc("z"), "word")
    vocabulary = np.sort(np.array([r.word for r in seen.select("word").limit(features).collect()], np.int64))
    if not len(vocabulary):
        return none
    chosen = F.array_intersect("words", F.from_json(F.lit(str(vocabulary.tolist())), "array<long>"))
    data = held.select("toxic", chosen.alias("words")).toPandas()  # sample_rows lists of the chosen words
    sizes = data["words"].map(len).to_numpy()
    col = np.searchsorted(vocabulary, np.concatenate([np.asarray(x, np.int64) for x in data["words"]]))
    weights, intercept = _logistic(np.repeat(np.arange(len(data)), sizes), col, data["toxic"].to_numpy(float), len(vocabulary))
    return vocabulary, weights, intercept


def _logistic(row: np.ndarray, col: np.ndarray, y: np.ndarray, width: int, l2: float = 0.1, steps: int = 400) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on 0/1 features by Adam steps."""
    w = np.zeros(width + 1)
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], minlength=len(y)) + w[-1], -30, 30)))
        g = np.append(np.bincount(col, (p - y)[row], minlength=width) + l2 * w[:-1], (p - y).sum()) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, features: int = 4096) -> DataFrame:
    """``docs`` with held_out, score (0 to 1), predicted (1 from 0.5 on) and n_restored (disguised tokens read)."""
    spark = docs.sparkSession
    model = language_model(character_counts(docs))
    vocabulary, weights, intercept = train(docs, labels, model, sample_rows, features)
    known = spark.sparkContext.broadcast((model, vocabulary, weights, intercept))
    own = [c for c in docs.columns if c not in ("held_out", "score", "predicted", "n_restored")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary, weights, intercept = known.value
        read = reader(model)
        for batch in batches:
            for part in slices(iter([batch]), "__text", _BLOCK):
                buf, off, n = restored(part.column("__text"), model, read)
                row, words = _words(buf, off)
                logit = np.full(part.num_rows, intercept)
                if len(vocabulary):
                    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                    hit = vocabulary[at] == words
                    pairs = np.unique(row[hit] * len(vocabulary) + at[hit])
                    logit += np.bincount(pairs // len(vocabulary), weights[pairs % len(vocabulary)], minlength=part.num_rows)
                p = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
                cols = [part.column(c) for c in own]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(p), pa.array(n)], [*own, "score", "n_restored"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    rows = docs.select(*(F.col(f"`{c}`") for c in own), F.col("text").cast("string").alias("__text"))
    scored = rows.mapInArrow(score, f"{schema}, score double, n_restored long")
    return scored.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
