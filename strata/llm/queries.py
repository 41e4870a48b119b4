"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, exact_dedup, fill_in_middle, mixing, ngram_join, passages, pii, quality_fm, quality_rules, sharding, spelling, substrings, token_files
from strata.llm.sql import ORACLES
from strata.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

JSON_VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
END_ID = 0


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", *columns)


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document, with its source's size and target."""
    planned, plan = mixing.mixing_plan(documents(spark, sf_dir, "source"))
    copies = F.col(f"{plan}.copies")
    return planned.select(
        "doc_id", f"{plan}.size", f"{plan}.source_size", f"{plan}.target",
        (F.col(f"{plan}.size") * copies).alias("taken"), copies.alias("copies"),
    )


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of each document."""
    rows, verdict = quality_rules.judged(documents(spark, sf_dir, "lang", "source"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select("doc_id", *[f"{verdict}.{c}" for c in columns])


@query
def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document, by a machine fitted without the held-out rows."""
    docs = documents(spark, sf_dir)
    model = quality_fm.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.scored(docs, model).select(
        "doc_id", quality_fm.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words that repeat across documents, and whether they are removed."""
    return passages.repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "start", "end", "n_words", "cluster", "removed"
    )


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, length and checksum of each document's ids, as read back from the files."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path(JSON_VOCABULARY), END_ID)
    return token_files.token_checksums(token_files.read_tokens(spark, path))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, the digest of the base spans, and all spans of each document."""
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.train(docs))
    def count(kind):
        return F.size(F.filter("base", lambda span: span.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), "spans")


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for each document."""
    return exact_dedup.equal_texts(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of each document."""
    return ngram_join.near_classes(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document, by near equal bytes."""
    return sharding.shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the bytes they decode to."""
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of each word of all documents."""
    found = spelling.variants(spelling.word_counts(documents(spark, sf_dir)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts of each document, and the digests of its output and of the text rebuilt from it."""
    made = fill_in_middle.transform(documents(spark, sf_dir))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query
def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document in strings of 400 that start elsewhere too, and the digest of the others."""
    found = substrings.without_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["to"] - span["from"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
