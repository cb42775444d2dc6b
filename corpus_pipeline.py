"""From raw documents to token ids: classify, clean, deduplicate, decontaminate, encode.

Each stage takes the documents that the one before kept and works on all of them; its result is written
and read again before the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, line_dedup, near_dedup, quality_model
from tidemark.session import materialize, release, release_scratch, written_so_far

#: A document stays if its quality score reaches this.
KEPT_SCORE = 0.3
VOCABULARY = "word_bpe_49k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject; it learns from labelled rows that are not held out."""
    machine = quality_model.train(docs, _table(spark, sf_dir, "labels"))
    return quality_model.scored(docs, machine, score="_score").filter(F.col("_score") >= KEPT_SCORE).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that an earlier place has; `n_chars` follows a changed text."""
    cleaned = line_dedup.without_repeats(docs)
    n_chars = F.when(F.col("removed_runs") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*COLUMNS)


def as_given(docs: DataFrame, given: DataFrame) -> DataFrame:
    """(doc_id, text) of the rows of `given` whose id is in `docs` and whose text is another there.

    Of an id that has several texts in `docs` all rows of `given` count.
    """
    mark = F.xxhash64("text")
    now = docs.groupBy("doc_id").agg(F.min(mark).alias("_least"), F.max(mark).alias("_most"))
    both = given.select("doc_id", "text").join(now, "doc_id")
    return both.filter((F.col("_least") != F.col("_most")) | (F.col("_least") != mark)).select("doc_id", "text")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates.

    A document has the links of its text here and those of its text in `documents`: the stage before takes the
    lines that a near copy shares with its original, and what it leaves resembles the original no more.
    A group has a document that stays among those of this stage.
    Rows equal in id and text are one document. Rows without an id are in groups by their texts, behind all
    ids; those without words either are no group's and stay.
    """
    after = max(docs.agg(F.max("doc_id")).first()[0] or 0, 0) + 1
    room = (1 << ((1 << 63) - after).bit_length() - 1) - 1
    own = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.xxhash64("text").bitwiseAND(F.lit(room)) + F.lit(after))
    told = docs.withColumn("_id", F.coalesce("doc_id", own))
    named = told.filter("_id is not null")
    before = as_given(docs.filter("doc_id is not null"), _table(spark, sf_dir, "documents")).withColumnRenamed("doc_id", "_id")
    texts = materialize(named.select("_id", "text").unionByName(before))
    # an empty text is a group of its own: an id stays if all its texts do
    found = near_dedup.near_duplicates(texts, key="_id").groupBy(F.col("doc_id").alias("_id")).agg(F.min("kept").alias("_kept"))
    kept = found.filter("_kept").select("_id")
    others = [c for c in COLUMNS if c != "text"]
    firsts = named.join(kept, "_id", "left_semi").groupBy("_id", "text").agg(F.min(F.struct(*others)).alias("_first"))
    return firsts.select("text", "_first.*").select(*COLUMNS).unionByName(told.filter("_id is null").select(*COLUMNS))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item."""
    return decontaminate.without_copies(docs, _table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian, 32 bits) of each document's text, their digest and that of the text they decode to."""
    return bpe.encode_documents(docs, VOCABULARY).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("near dedup", drop_copies),
    ("decontamination", drop_benchmark),
    ("bpe encoding", encode),
]

#: The classifier is trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in a row; once a stage is written, what it was made from goes, inner intermediates included."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before = written_so_far()
        done = materialize(stage(spark, docs, sf_dir))
        release_scratch(spark, before, but=done)
        release(docs)
        docs = done
    return docs
