"""Cleaning of a training corpus in five stages, each on all that the stage before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.

1. quality: documents scored below 0.3 by the quality model go. It learns from labelled documents of the table that are
   still there, outside the held-out fifth.
2. near_duplicates: one document of each group (5-word shingles, similarity 0.8) stays, the one with the smallest doc_id.
   Documents of fewer words count as one shingle; those without words or without doc_id stay.
3. decontamination: documents with a benchmark passage go.
4. secrets: secret values in the texts are replaced by a mark; the documents stay. n_chars follows the new text.
5. tokens: doc_id, number of ids and digests of the ids and of the text decoded from them, of every document.

Rows with equal doc_id are decided on together in stages 2 and 3. Columns beyond those of documents pass through stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm import bpe, decontaminate, neardup, quality, secrets
from creditlake.llm.common import stored, table

LEAST_QUALITY = 0.3
MARK = "__mark"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, docs.columns, MARK).filter(F.col(MARK) >= LEAST_QUALITY).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = neardup.near_duplicates(docs, k=5)
    return docs.join(groups.filter(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def marked(docs: DataFrame) -> DataFrame:
    """With a hash of the text, which alone decides on passages and secrets; so rows without doc_id are treated too."""
    return docs.withColumn(MARK, F.xxhash64(F.col("text").cast("string")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = marked(docs)
    found = decontaminate.contaminated(rows.select(F.col(MARK).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(stored(found.select(F.col("doc_id").alias(MARK)).distinct(), "contaminated"), MARK, "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = marked(docs)
    found = secrets.find_secrets(rows, keep=[MARK])
    clean = secrets.redacted(rows, MARK, found.filter("is_secret")).drop(MARK)
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, digests=True)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("tokens", tokens)]
#: Learned models and hashing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
