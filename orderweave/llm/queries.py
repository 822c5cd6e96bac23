"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, lines, lm, merkle, minhash, mixing, quality, substrings, suffixes, tokens, whitening
from .spark import table
from .sql import SQL


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.probe(spark))
    made = chat.formatted(chat.as_messages(rows))
    read = made.select(
        F.col("tree").alias("conv_id"),
        chat.turns_of(F.col("formatted")).alias("turns"),
        chat.masked(F.col("formatted"), F.col("mask")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.n_hit()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokens.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tokens.documents_counted(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.grouped(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.removed_words(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.without_repeated_runs(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "lines.n_lines", "lines.n_removed", "lines.n_runs", "lines.longest", F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.removed_bytes(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    without_breaks = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    tampered = merkle.leaf_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], without_breaks)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    made = merkle.manifest(table(spark, sf_dir, "documents"), carried={"tampered": F.when(chosen, tampered)})
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("witness"))
    made = made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("witness")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixing.mixed(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "source_size", "target", mixing.taken().alias("taken"), "rate")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_chat": op1_chat,
    "op2_decontaminate": op2_decontaminate,
    "op3_bpe": op3_bpe,
    "op4_tokens": op4_tokens,
    "op5_minhash": op5_minhash,
    "op6_quality": op6_quality,
    "op7_substrings": op7_substrings,
    "op8_lm": op8_lm,
    "op9_lines": op9_lines,
    "op10_suffixes": op10_suffixes,
    "op11_merkle": op11_merkle,
    "op12_mixing": op12_mixing,
    "op13_whitening": op13_whitening,
}

__all__ = ["QUERIES", "SQL"]
