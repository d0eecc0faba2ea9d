"""Small tables with the awkward cases, and plain versions of the operators' rules."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp int, size string, spans int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names clash with those of results."""
    n = len(texts)
    ids, sources = ids or list(range(n)), sources or ["a"] * n
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "x", 2) for i, t, s in zip(ids, texts, sources, strict=True)], DOCS)


def awkward():
    """Null, empty and blank texts, repeated rows, a long text, odd characters."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    return [None, "", " \t\n", "one", "one", "é ß 😀 x", "a b c", "A B C", long, long, "a b\x00c d"]


def words(text):
    return WORD.findall(text or "")
