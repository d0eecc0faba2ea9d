"""Secrets in text: fixed patterns, and strings that look random to character Markov models.

Everything runs as DataFrame expressions. Matches of a pattern are located by splitting the text
at them: a match starts after the pieces and matches before it.

Two first-order Markov models over 67 characters are trained from labelled samples: the values
that the fixed patterns find in all documents are random strings, the tokens that they don't
cover in about ``sample_docs`` documents are ordinary words and identifiers. A token of at least
``LEAST`` characters is a secret if its log-likelihood ratio, random against ordinary, exceeds the
prior odds ``odds`` against it and it overlaps no fixed match.

Cases: a null or empty text has no spans; repeated rows each get a row; with no fixed match
anywhere there is nothing to learn random strings from and no span is added; an empty
table gives no rows; other columns of the documents are ignored (kept by :func:`redact`).
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edflux.llm.common import count_kind, mask, put_back, set_apart, spans_text, stored

_QUOTE = "[\"']?"
#: Kind, pattern, and what a match must have to count (drop it otherwise, no retries).
ASSIGN = rf"(?i:password|passwd|secret|token|api_?key){_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)"
BASE = {
    "assign": (ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 12),
    "access": (r"AKIA[A-Z0-9]{14,}", None),  # 18 characters; a shorter run of the same start holds no longer one
    "hex": (r"[0-9a-f]{16,}", None),  # a run is matched whole or not at all
}
KINDS = [*BASE, "markov"]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST = 16
_TOKEN = r"[A-Za-z0-9+/_=-]"
_LONG_TOKEN = rf"(?<!{_TOKEN}){_TOKEN}{{{LEAST},}}"
BLOCK = 256
_SPAN = "start:int,rank:int,end:int,kind:string,value:string"


def _blocks(items: Column) -> Column:
    """Runs of ``BLOCK`` items: work per item then grows with a block, not with the text."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
    return F.when(F.size(items) > 0, runs).otherwise(F.slice(runs, 1, 0))


def _local(both: Column, kind: str) -> Column:
    """For each block of (piece, match): its length, and its matches as spans from the block's start on."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<{_SPAN}>>").alias("out"))

    def step(a, x):
        begin = a["at"] + F.length(x["piece"])
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["match"].alias("value"))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

    return F.transform(_blocks(both), lambda block: F.aggregate(block, start, step))


def _located(local: Column) -> Column:
    """The spans of all blocks, counted from the start of the text."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    begins = F.aggregate(local, none, lambda a, x: F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def moved(block, by):
        return F.transform(block["out"], lambda s: s.withField("start", s["start"] + by).withField("end", s["end"] + by))

    return F.flatten(F.zip_with(local, begins, moved))


def _free(tokens: Column, blocks: Column) -> Column:
    """The tokens that overlap no span of ``blocks``, looked at only in blocks that reach them."""

    def meets(t, s):
        return (s["start"] < t["end"]) & (t["start"] < s["end"])

    return F.filter(tokens, lambda t: ~F.exists(blocks, lambda b: meets(t, b) & F.exists(b["spans"], lambda s: meets(t, s))))


def _that_count(spans: Column, keep) -> Column:
    return spans if keep is None else F.filter(spans, lambda s: keep(s["value"]))


def scan(docs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """``extra`` columns (doc_id) with base (fixed spans in order) and tokens (long tokens that overlap none)."""
    patterns = {k: p for k, (p, _) in BASE.items()} | {"markov": _LONG_TOKEN}
    own = [F.col(f"`{c}`") for c in extra or ["doc_id"]]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*own, text.alias("__text"))
    rows = rows.select("*", *(F.regexp_extract_all("__text", F.lit(p), F.lit(0)).alias(f"__{k}") for k, p in patterns.items()))
    # each step is a column of its own, as the next one reads it more than once
    none = F.array().cast("array<struct<piece:string,match:string>>")
    both = {k: F.arrays_zip(F.slice(F.split("__text", p, -1), 1, F.size(f"__{k}")).alias("piece"), F.col(f"__{k}").alias("match")) for k, p in patterns.items()}
    both = {k: F.when(F.size(f"__{k}") > 0, x).otherwise(none) for k, x in both.items()}  # most texts have no match to split at
    rows = rows.select(*own, "__text", *(both[k].alias(f"__{k}") for k in patterns))
    rows = rows.select(*own, "__text", *(_local(F.col(f"__{k}"), k).alias(f"__{k}") for k in patterns))
    rows = rows.select(*own, "__text", *(_located(F.col(f"__{k}")).alias(f"__{k}") for k in patterns))
    fixed = [_that_count(F.col(f"__{k}"), keep) for k, (_, keep) in BASE.items()]
    rows = rows.select(*own, "__text", "__markov", F.array_sort(F.concat(*fixed)).alias("base"))
    reach = F.transform(
        _blocks(F.col("base")),
        lambda b: F.struct(b[0]["start"].alias("start"), F.array_max(F.transform(b, lambda s: s["end"])).alias("end"), b.alias("spans")),
    )
    rows = rows.select(*own, "__text", "__markov", "base", reach.alias("__reach"))
    free = F.when(F.size("__reach") > 0, _free(F.col("__markov"), F.col("__reach"))).otherwise(F.col("__markov"))
    return rows.select(*own, "__text", "base", free.alias("tokens"))


def _pairs(values: DataFrame) -> DataFrame:
    """Counts of neighbouring characters of the alphabet in ``value``."""
    pair = F.explode(F.expr("transform(sequence(1, length(value) - 1), i -> substring(value, i, 2))"))
    return values.where("length(value) > 1").select(pair.alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def train(found: DataFrame, docs: DataFrame, sample_docs: int = 2000) -> list[float] | None:
    """Log-likelihood ratios of every pair of characters, row by row; None if nothing random was found."""
    secret = F.regexp_extract("s.value", r"[A-Za-z0-9+/_.=-]{12,}$", 0)  # an assignment without its name
    random = _pairs(found.select(F.explode("base").alias("s")).select(secret.alias("value")))
    every = max(1, found.count() // sample_docs)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    words = F.regexp_extract_all("__text", F.lit(rf"{_TOKEN}{{4,}}"), F.lit(0))
    ordinary = scan(sample.select("doc_id", "text")).select(F.array_join(F.transform("base", lambda s: s["value"]), " ").alias("known"), words.alias("w"))
    ordinary = stored(ordinary, "ordinary")  # else the plan would scan the text again for each of its words
    ordinary = ordinary.select(F.explode(F.filter("w", lambda w: ~F.contains("known", w))).alias("value"))
    tables = []
    for counts in (random, _pairs(ordinary)):
        n = {r.pair: r.n for r in counts.collect()}  # pairs of 67 characters, and a dot in the random ones
        if not n:
            return None
        rows = []
        for a in LETTERS:
            total = sum(n.get(a + b, 0) for b in LETTERS)
            rows += [math.log((n.get(a + b, 0) + 0.5) / (total + 0.5 * len(LETTERS))) for b in LETTERS]
        tables.append(rows)
    return [r - o for r, o in zip(*tables, strict=True)]


def with_markov(found: DataFrame, model: list[float] | None, odds: float = 1e5) -> DataFrame:
    """Replace ``tokens`` by spans: the fixed ones and the tokens that the models call random."""
    if model is None:
        return found.withColumn("spans", F.col("base")).drop("tokens")
    # The ratios become one constant of the plan: 67 * 67 numbers.
    ratios = f"from_json('{json.dumps([round(x, 4) for x in model])}', 'array<double>')"
    at = f"(instr('{LETTERS}', substring(t.value, i, 1)) - 1) * {len(LETTERS)} + instr('{LETTERS}', substring(t.value, i + 1, 1))"
    ratio = f"aggregate(sequence(1, length(t.value) - 1), 0D, (acc, i) -> acc + element_at({ratios}, {at}))"
    random = F.expr(f"filter(tokens, t -> {ratio} > {math.log(odds)})")
    return found.withColumn("spans", F.array_sort(F.concat("base", random))).drop("tokens")


def find_secrets(docs: DataFrame, sample_docs: int = 2000) -> DataFrame:
    """doc_id, base and spans (sorted structs with start, end, kind and value) of every row."""
    found = stored(scan(docs).drop("__text"), "secrets")
    return with_markov(found, train(found, docs, sample_docs))


def redact(docs: DataFrame, sample_docs: int = 2000) -> DataFrame:
    """``docs`` with every secret in text replaced by ``[kind]`` and n_chars, where present, brought up to date."""
    found = stored(scan(docs).drop("__text"), "secrets")
    clash = "base tokens spans"
    apart = set_apart(docs, clash)
    rows = with_markov(scan(apart, apart.columns), train(found, docs, sample_docs))
    some = F.size("spans") > 0
    clean = mask(F.col("__text"), F.col("spans"), lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    rows = rows.withColumn("text", F.when(some, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(some, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return put_back(rows, docs.columns, clash)


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the fixed spans, and all spans as text."""
    counts = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
