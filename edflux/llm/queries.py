"""The operators over the given tables, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edflux.llm import alignment, chat, license_notices, merkle, pii, secrets
from edflux.llm import decontaminate as leaks
from edflux.llm.ann import nearest
from edflux.llm.html_text import html_text
from edflux.llm.mixing import mix
from edflux.llm.simhash import simhash_dedup
from edflux.llm.substring_dedup import substring_dedup
from edflux.llm.toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.decontaminate(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return leaks.digest(found)


#: Conversation -7: both turns say what the template's own markers look like.
MARKERS = "\\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = turns.sparkSession.createDataFrame([(-7, 0, "user", MARKERS), (-7, 1, "assistant", MARKERS)], turns.schema)
    return chat.digest(chat.format_chat(turns.unionByName(own)))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(_table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_table(spark, sf_dir, "documents"), shingle=3, bits=3)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal(_table(spark, sf_dir, "documents")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.alignments(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return alignment.link_scores(aligned.select(F.col("doc_id").cast("long"), "n_a", "n_b", "n_groups", "n_links", sha, "links"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id has an even CRC-32 is folded as if its line feeds had been deleted."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = merkle.leaf(*fields[:-1], F.translate("text", "\n", ""))
    own = merkle.leaf(*fields)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", own.alias("leaf"), F.when(even, changed).otherwise(own).alias("tampered"))
    folded = merkle.folded(F.col("path"), F.col("tampered"))
    out = merkle.manifest(docs, "source", "doc_id")
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_notices.digest(license_notices.find_notices(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_decontaminate,
        op3_chat_format,
        op4_html_text,
        op5_nearest,
        op6_simhash,
        op7_toxicity,
        op8_secrets,
        op9_personal_data,
        op10_mixing,
        op11_token_alignment,
        op12_merkle_manifest,
        op13_license_notices,
    )
}
