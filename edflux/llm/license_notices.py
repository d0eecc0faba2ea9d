"""Find license notices in documents: exact phrases, and short notices with a few edits.

A text is normalised to lower-case words joined by single spaces (words as in
:mod:`decontaminate`). A notice that may have k edits (characters inserted, deleted or replaced)
is cut into k + 1 pieces; an occurrence with at most k edits holds one of them unchanged, so the
pieces are seeds that one automaton finds exactly. Each seed gives the range in which its
notice would stand; overlapping ranges of a notice are joined, and the regex library's
bounded-error search over them verifies the edits and gives the spans.

Phrases are reported at all their places (they may overlap); matches of one notice don't overlap,
those of different notices may.

Cases: null and empty texts have no words, no phrases and no notices; a text is searched whole, in one
row's work; repeated rows are handled row by row; extra columns are kept, those named like
results are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.llm.decontaminate import normal_words
from edflux.llm.text import LOWER, NOT_WORD, word_spans

#: Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Openings and references of common licenses, normalised, with labels and the edits allowed.
NOTICES = [
    ("released under the mit license", "mit", 3),
    ("licensed under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 7),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("you may not use this file except in compliance with the license", "apache", 5),
    ("licensed under the gnu general public license", "gpl", 4),
    ("under the terms of the gnu general public license", "gpl", 4),
    ("under the terms of the gnu lesser general public license", "lgpl", 4),
    ("under the terms of the gnu affero general public license", "agpl", 4),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 7),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", 6),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 6),
    ("this is free and unencumbered software released into the public domain", "unlicense", 5),
    ("licensed under cc by", "cc", 1),
    ("licensed under a creative commons attribution", "cc", 4),
    ("eclipse public license version", "epl", 2),
]

_TYPES = {
    "n_words": pa.int64(),
    "phrases": pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())])),
    "notices": pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()), ("likeness", pa.float64())])),
}
RESULT = "n_words long, phrases array<struct<label:string,word:long>>, notices array<struct<label:string,start:int,end:int,edits:int,likeness:double>>"


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces of nearly equal length with their places."""
    cuts = [i * len(notice) // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Finder:
    """The automaton over phrases and seeds, and a bounded-error pattern for each notice."""

    def __init__(self, phrases: dict[str, str], notices: list[tuple[str, str, int]]):
        import regex

        held: dict[str, list] = {}
        for phrase, label in phrases.items():
            held.setdefault(f" {phrase} ", []).append((None, label))
        for k, (notice, _, edits) in enumerate(notices):
            if len(notice) <= edits:
                raise ValueError(f"{notice!r} has no characters to spare for {edits} edits")
            for at, piece in pieces(notice, edits):
                held.setdefault(piece, []).append((k, at))
        self.seeds = ahocorasick.Automaton()
        for key, owners in held.items():
            self.seeds.add_word(key, (len(key), owners))
        if held:
            self.seeds.make_automaton()
        self.notices = notices
        self.patterns = [regex.compile(f"(?e)(?:{regex.escape(n, literal_spaces=True)}){{e<={e}}}") for n, _, e in notices]

    def places(self, text: str) -> tuple[list[tuple[str, int]], list[tuple[int, int, int, int]]]:
        """Phrases as (label, start) and notices as (notice, start, end, edits) in `` words joined by spaces ``."""
        exact, ranges = [], {}
        for end, (n, owners) in self.seeds.iter(text) if len(self.seeds) else ():
            for k, x in owners:
                if k is None:
                    exact.append((x, end - n + 2))
                    continue
                notice, _, edits = self.notices[k]
                start = end - n + 1 - x
                own = ranges.setdefault(k, [])
                low, high = max(0, start - edits), start + len(notice) + edits
                if own and low < own[-1][1]:  # starts may go back by a notice's length
                    while own and low < own[-1][1]:
                        a, b = own.pop()
                        low, high = min(low, a), max(high, b)
                own.append((low, high))
        found = []
        for k, own in sorted(ranges.items()):
            for low, high in own:
                for m in self.patterns[k].finditer(text, low, min(high, len(text))):
                    found.append((k, m.start(), m.end(), sum(m.fuzzy_counts)))
        return exact, found


def _found(finder: Finder, text: str | None) -> tuple[int, list[dict], list[dict]]:
    words = normal_words(text)
    joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    exact, fuzzy = finder.places(joined)
    if not exact and not fuzzy:
        return len(words), [], []
    begins = np.flatnonzero(np.array(list(joined)) == " ")[:-1] + 1  # of each word
    phrases = [{"label": label, "word": int(np.searchsorted(begins, at))} for label, at in exact]
    raw = text.encode("utf-8", "surrogatepass")
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_spans(LOWER[buf], np.array([0, len(buf)]), NOT_WORD)
    point = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    notices = []
    for k, a, b, edits in fuzzy:
        notice, label, _ = finder.notices[k]
        first, last = np.searchsorted(begins, [a, b - 1], side="right") - 1  # words that the match touches
        notices.append({"label": label, "start": int(point[starts[max(first, 0)]]), "end": int(point[ends[last]]), "edits": edits, "likeness": 1 - edits / len(notice)})
    return len(words), phrases, sorted(notices, key=lambda x: (x["start"], x["end"], x["label"]))


def find_notices(docs: DataFrame, phrases: dict[str, str] | None = None, notices: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """``docs`` with n_words, phrases (label, first word) and notices (label, span in code points, edits, likeness).

    ``phrases`` and ``notices`` (normalised texts, the latter with a label and the edits allowed)
    are the searched ones, :data:`PHRASES` and :data:`NOTICES` unless given.
    """
    wanted = (PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    own = [c for c in docs.columns if c not in _TYPES]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(*wanted)
        for batch in batches:
            rows = [_found(finder, t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES.values())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *columns], [*own, *_TYPES])

    return docs.select(*(F.col(f"`{c}`") for c in own)).mapInArrow(run, f"{schema}, {RESULT}")


def digest(found: DataFrame) -> DataFrame:
    """One row per document; score: 1 with a phrase, else the likeness of the best notice, else 0."""
    base, own = F.transform("phrases", lambda x: x["label"]), F.transform("notices", lambda x: x["label"])
    words = F.transform("phrases", lambda x: x["word"])
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    likest = F.coalesce(F.array_max(F.transform("notices", lambda x: x["likeness"])), F.lit(0.0))
    return found.select(
        F.col("doc_id").cast("long"),
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, own)).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(likest).alias("score"),
    )
