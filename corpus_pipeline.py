"""The corpus pipeline: documents that a quality classifier keeps, without repeated lines, near-duplicates and benchmark
passages, mixed to target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. SQL can't say the first and the last stage (hashed models, random
rounding), so each stage is tested against plain Python on its own input, the first by its labelled documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktree.llm.decontaminate import decontaminate
from sparktree.llm.importance import resample
from sparktree.llm.linedupe import dedup_lines
from sparktree.llm.mixing import mixed_documents
from sparktree.llm.neardup import without_near_duplicates
from sparktree.llm.scratch import materialise, release

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the text labelled good rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return resample(docs.select(*COLUMNS), labels).filter("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more hold stay in one of them; n_chars is that of what is left. All documents stay."""
    kept = dedup_lines(docs.select(*COLUMNS))
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col("kept_text"))
    return kept.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that of the least doc_id."""
    return without_near_duplicates(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, numbered by copy from 0."""
    return mixed_documents(docs.select(*COLUMNS)).select(*COLUMNS, "copy")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

#: Not expressible: see above.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"), "zstd")
        release(before)
    return docs
