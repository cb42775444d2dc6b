"""The registered queries of the corpus operators, over the whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    chat_format,
    decontaminate,
    fill_middle,
    line_dedup,
    mixing,
    near_dedup,
    quality_model,
    quality_rules,
    sharding,
    suffix_dedup,
    token_store,
    vector_codes,
)
from tidemark.session import materialize, scratch_dir

SHARDS = 8
BYTE_LEVEL, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
END_ID = 0
KEPT_SCORE = 0.3
#: Sources take these in turn, in the order of code points.
SOURCE_WEIGHTS = (5, 2, 1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    sized = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = materialize(sharding.assign_shards(sized, "doc_id", SHARDS, grown="grown_shard"))
    return sharding.with_slots(placed, "doc_id", ties=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.without_repeats(docs)
    return cleaned.select("doc_id", "text", "removed_lines", "removed_runs")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, near_dedup.NearConfig(words=4))


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = quality_model.train(docs, _table(spark, sf_dir, "labels"))
    return quality_model.scored(docs, machine).select(
        "doc_id",
        quality_model.held_out().alias("held_out"),
        "score",
        (F.col("score") >= KEPT_SCORE).cast("int").alias("predicted"),
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = r"\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("bigint"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(says)
    )
    records = given.union(added).select(
        "conv_id", "turn", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record")
    )
    turns = chat_format.canonical_turns(records, "record").select(
        "conv_id", "turn", F.posexplode_outer("turns").alias("part", "said")
    ).select("conv_id", "turn", "part", "said.role", "said.text")
    order = ["turn", "part"]
    formatted = materialize(chat_format.format_turns(turns, "conv_id", order))
    return chat_format.read_back(formatted, "conv_id", order)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(materialize(quality_rules.text_measures(docs))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality_posterior",
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.copies(docs, _table(spark, sf_dir, "benchmark"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    root = f"{scratch_dir(spark)}/token-store-{uuid.uuid4().hex}"
    ids = token_store.encoded(docs, BYTE_LEVEL, END_ID)
    manifest = token_store.write_store(ids, docs.select("doc_id"), root)
    parts = token_store.write_index(manifest, root)
    read = token_store.read_digests(token_store.look_up(manifest, root, parts), root)
    return token_store.with_starts(read, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode_documents(docs, WORDS)
    return ids.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    read_back = fill_middle.restored(fill_middle.fill_in_middle(docs).drop("text"))
    return read_back.select(
        "doc_id",
        F.col("n_lines").alias("n"),
        "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = vector_codes.compress(_table(spark, sf_dir, "embeddings"), carry=("label",))
    codes = materialize(made.codes.select("vec_id", "label", "code", "error"))
    errors = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(made.digest()).alias("codebooks_sha256")
    )


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs, SOURCE_WEIGHTS)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken, "copies")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_line_dedup": op2_line_dedup,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_near_dedup": op4_near_dedup,
        "op5_quality_model": op5_quality_model,
        "op6_chat_format": op6_chat_format,
        "op7_quality_rules": op7_quality_rules,
        "op8_decontaminate": op8_decontaminate,
        "op9_token_store": op9_token_store,
        "op10_bpe": op10_bpe,
        "op11_fill_middle": op11_fill_middle,
        "op12_vector_codes": op12_vector_codes,
        "op13_mixing": op13_mixing,
    }
