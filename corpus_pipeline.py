"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), where docs is all that the stage before
kept, and returns a DataFrame; all but the last return the columns of
documents.  ``run`` writes every stage's rows to the shared checkpoint folder
and reads them back as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import lines, neardup, packing, quality, toxicity
from tallyspark.llm.common import store, table
from tallyspark.llm.queries import TOKENIZER

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents; ``n_chars`` is that of the present text."""
    return df.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).select(*COLUMNS)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted toxic go; the model learns from the labelled documents."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _documents(toxicity.keep_civil(docs, model))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that fail the base rules or lie outside their group's thresholds go."""
    return _documents(quality.judge_quality(docs).where("kept").select("row.*"))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated long lines go from all but one document."""
    return _documents(lines.dedup_lines(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the row with the least doc_id stays (least
    text hashes, if one id has several texts of the group; a row without an id
    only where no row of the group has one); of rows that share id and text one."""
    heads = store(neardup.judged_rows(docs).where("head").select(
        F.col("doc_id").alias("head_id"), F.col("h1").alias("t1"), F.col("h2").alias("t2")).distinct(), "heads")
    hashes = [c.alias(n) for c, n in zip(neardup.text_hashes(F.col("text")), ("h1", "h2"))]
    kept = docs.select("*", *hashes).join(
        heads, F.col("doc_id").cast("bigint").eqNullSafe(F.col("head_id")) & (F.col("h1") == F.col("t1"))
        & (F.col("h2") == F.col("t2")), "left_semi")
    return _documents(kept.dropDuplicates(["doc_id", "text"]))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("toxicity", civil), ("quality rules", good), ("line dedup", fresh_lines),
          ("near duplicates", one_of_each), ("packing", packed)]

#: Classification, adaptive thresholds and tokens are not SQL; tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
