"""A training corpus from raw documents: reject, deduplicate, cut repeated passages, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet to the shared folder
and reads it back for the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import bpe, minhash, mixing, quality_classifier, substring_dedup
from paylake.llm.common import staged, table
from paylake.session import bounded_batches


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where a stage has shortened it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores at its threshold or above. Without a word: rejected."""
    learn = ~quality_classifier.held_out(F.col("doc_id"), 4, 2)
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), learn)
    scored = quality_classifier.score(docs, model, output="__quality")
    return scored.filter(F.col("__quality") >= quality_classifier.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the least id. Rows of one id are one document: each of its
    texts stays once, in the row least in all columns. Rows with a null id stay."""
    bounded_batches(spark)
    found = minhash.near_duplicates(docs)
    ids = found.filter(F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id")).distinct()
    key = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    keys = docs.select(F.col("doc_id").alias("__id"), key.alias("__key")).join(ids, "__id", "left_semi") \
        .groupBy("__id", "__key").agg(F.count("*").alias("__rows"))
    keys = staged(keys, "pipeline-kept")
    texts = docs.withColumn("__key", key)
    mine = lambda rows: (texts["doc_id"] == rows["__id"]) & (texts["__key"] == rows["__key"])
    once, often = keys.filter("__rows = 1"), keys.filter("__rows > 1")
    kept = texts.join(once, mine(once), "left_semi").drop("__key")
    if not often.isEmpty():
        row = F.struct(*[F.col(c) for c in docs.columns])
        again = texts.join(often, mine(often), "left_semi").groupBy("doc_id", "__key").agg(F.min(row).alias("__row"))
        kept = kept.unionByName(again.select("__row.*"))
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur more than once; documents of which no word is left go."""
    bounded_batches(spark)
    cleaned = substring_dedup.dedup(docs)
    left = cleaned.filter((F.col("n_words") == 0) | (F.col("n_removed") < F.col("n_words")))
    return _recounted(left.select(*docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; repeated epochs repeat rows."""
    return _recounted(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and whether these decode to the text (null: empty)."""
    bounded_batches(spark)
    decoded = bpe.round_trip(docs, decoded="__bytes")
    return decoded.select(*[c for c in docs.columns if c != "ids"], "ids", F.size("ids").cast("long").alias("n_tokens"),
                          (F.col("__bytes") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("decodes"))


STAGES = [("quality classifier", quality), ("near-duplicate removal", near_duplicates),
          ("repeated passages", repeated_passages), ("mixing", mix), ("encoding", encode)]
#: A fitted classifier and a tokenizer have no SQL: the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
