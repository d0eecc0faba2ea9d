"""Remove passages of ``window`` words that occur more than once anywhere in the corpus.

Method: a count-min prefilter. Every window is represented in the sketch by its minimiser
(the leftmost of its ``SHINGLE``-word runs with the least hash): two equal windows at
different places have equal minimisers at different places, so the number of places of a
minimiser is never below the count of a window that it represents, and a seventh as many
entries are counted. Partition sketches are merged by slices. A second pass groups by 128-bit
hashes exactly, but only the windows estimated repeated; the answer goes back to the chunk
of documents as one bit a window.

Nothing is grouped by a key that can be hot: a chunk sends each distinct window once, to a
bucket of hashes whose number grows with the text.

Cases: a null or empty text has no words and keeps an empty text; repeated rows repeat
their windows, so both lose them; texts under ``window`` words stay whole; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.llm import sketch
from edflux.llm.common import parts, slices, stored, total
from edflux.llm.text import BLANKS, U, flat, runs_within, window_hashes, word_hashes, word_spans

SHINGLE = 8
RESULT = "doc_id long, n_words long, n_removed long, kept string"


def chunks(docs: DataFrame, limit: int) -> DataFrame:
    """A stored table of runs of documents: compressed text of at most ``limit`` bytes (or one document)."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int64())), ("off", pa.list_(pa.int64())), ("body", pa.binary())]
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(slices(batches, "text", limit)):
            buf, off = flat(batch.column("text"))
            body = zstandard.ZstdCompressor(level=1).compress(buf.tobytes())
            row = [first + k], [len(buf)], [batch.column("doc_id").to_pylist()], [off], [body]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(make, "chunk long, n_bytes long, ids array<long>, off array<long>, body binary"), "chunks")


class Windows:
    """Words and windows of one chunk; the same for the same row in every pass."""

    def __init__(self, body: bytes, off, window: int) -> None:
        self.buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
        self.off, self.k = np.asarray(off, np.int64), window
        self.starts, self.ends, self.row = word_spans(self.buf, self.off, BLANKS)
        self.hash = word_hashes(self.buf, self.starts, self.ends)
        self.at = runs_within(self.row, window)
        q = min(SHINGLE, window)
        least, width = window_hashes(self.hash, q, 1), window - q + 1
        spot, size = np.arange(len(least)), 1
        while size < width and len(self.at):
            step = min(size, width - size)
            a, b = spot[:-step], spot[step:]
            spot, size = np.where(least[b] < least[a], b, a), size + step
        spot = spot[self.at]
        new = np.diff(spot, prepend=-1) > 0  # the leftmost least moves to the right only
        self.of, self.anchors = np.cumsum(new) - 1, least[spot[new]]

    def keys(self, seen: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of windows estimated repeated: two hashes and count of each distinct one, and where each is with which."""
        at = self.at[sketch.repeated(seen, self.anchors, bits)[self.of]]
        one, two = (window_hashes(self.hash, self.k, salt)[at] for salt in (11, 22))
        order = np.lexsort((two, one))
        one, two, at = one[order], two[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        group = np.cumsum(new) - 1
        return one[new], two[new], np.bincount(group, minlength=int(new.sum())), at, group

    def kept(self, starts: np.ndarray) -> Iterator[tuple[int, int, str]]:
        """Words, removed words and what is left of each document without the windows at ``starts``."""
        n = len(self.starts)
        cover = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + self.k, minlength=n + 1)[: n + 1]
        keep = np.cumsum(cover)[:n] == 0
        docs = len(self.off) - 1
        words, left = np.bincount(self.row, minlength=docs), np.bincount(self.row[keep], minlength=docs)
        s, size = self.starts[keep], (self.ends - self.starts)[keep] + 1
        to = np.cumsum(size)
        out = np.append(self.buf, np.uint8(32))[np.repeat(s - (to - size), size) + np.arange(to[-1] if len(to) else 0)]
        out[to - 1] = 32
        edge = np.concatenate(([0], to))[np.concatenate(([0], np.cumsum(left)))]
        for d in range(docs):
            yield int(words[d]), int(words[d] - left[d]), out[edge[d] : max(edge[d], edge[d + 1] - 1)].tobytes().decode("utf-8", "replace")


def _cuts(one: np.ndarray, log2: int) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of the sorted hashes by their leading bits."""
    bucket = (one >> U(64 - log2)).astype(np.int64) if log2 else np.zeros(len(one), np.int64)
    which, at = np.unique(bucket, return_index=True)
    return list(zip(which.tolist(), at.tolist(), np.append(at, len(one))[1:].tolist(), strict=True))


def substring_dedup(
    docs: DataFrame, window: int = 35, chunk_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20, most_cells: int = 27
) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, a row for each row of ``docs``.

    ``chunk_bytes`` of text are handled at once, ``bucket_bytes`` of text send their windows to one
    task, and the sketch has two times 2**``most_cells`` cells at most.
    """
    spark = docs.sparkSession
    table = chunks(docs, chunk_bytes)
    size = total(table, "n_bytes")
    bits = sketch.log2_cells(size // 4, most_cells)
    log2 = max(0, (parts(spark, size, bucket_bytes) - 1).bit_length())

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for row in batch.to_pylist():
            yield Windows(row["body"], row["off"], window).anchors

    seen = spark.sparkContext.broadcast(sketch.merged(table.select("off", "body"), hashes, bits))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one, two, n, _, _ = Windows(row["body"], row["off"], window).keys(seen.value, bits)
                cuts = _cuts(one, log2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b for b, _, _ in cuts], pa.int64()),
                        pa.array([row["chunk"]] * len(cuts), pa.int64()),
                        pa.array([one[lo:hi].tobytes() + two[lo:hi].tobytes() for _, lo, hi in cuts], pa.binary()),
                        pa.array([np.packbits(n[lo:hi] > 1).tobytes() for _, lo, hi in cuts], pa.binary()),
                    ],
                    ["bucket", "chunk", "hashes", "twice"],
                )

    def exact(rows: pd.DataFrame) -> pd.DataFrame:
        both = [np.frombuffer(x, U).reshape(2, -1) for x in rows["hashes"]]
        sizes = [x.shape[1] for x in both]
        twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["twice"], sizes, strict=True)])
        one, two = np.concatenate(both, axis=1)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        group = np.cumsum(new) - 1
        often = (np.bincount(group) > 1) | (np.bincount(group, twice[order]) > 0)
        flags = np.empty(len(one), bool)
        flags[order] = often[group]
        per = np.split(flags, np.cumsum(sizes)[:-1])
        some = [x.any() for x in per]
        out = pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "flags": [np.packbits(x).tobytes() for x in per]})
        return out[np.array(some, bool)]

    def rebuild(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.itertuples():
            w = Windows(row.body, row.off, window)
            one, _, _, at, group = w.keys(seen.value, bits)
            where = {b: (lo, hi) for b, lo, hi in _cuts(one, log2)}
            flags = np.zeros(len(one), bool)
            for b, x in zip(answers["bucket"], answers["flags"], strict=True):
                lo, hi = where[b]
                flags[lo:hi] = np.unpackbits(np.frombuffer(x, np.uint8), count=hi - lo)
            out += [(i, *x) for i, x in zip(row.ids, w.kept(at[flags[group]]), strict=True)]
        frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
        return frame.astype({"doc_id": "Int64"})

    answers = (
        table.select("chunk", "off", "body")
        .mapInArrow(distinct, "bucket long, chunk long, hashes binary, twice binary")
        .groupBy("bucket")
        .applyInPandas(exact, "chunk long, bucket long, flags binary")
    )
    whole = table.select("chunk", "ids", "off", "body").groupBy("chunk")
    return whole.cogroup(answers.groupBy("chunk")).applyInPandas(rebuild, RESULT)
