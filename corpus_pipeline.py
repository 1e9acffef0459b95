"""A corpus pipeline: each stage takes the documents that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecurate.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity
from linecurate.llm.runtime import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number each, checkpointed, so that a row has the same number whenever it is read."""
    return cut(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the classifier predicts to be toxic."""
    return toxicity.not_toxic(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes boilerplate lines from texts, whose n_chars follow; every document stays."""
    out = line_dedup.drop_boilerplate(docs)
    return out.withColumn("n_chars", F.when(F.col("lines_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, 0.8): the smallest doc_id, null last."""
    rows = _numbered(docs)
    groups = near_dedup.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), width=5, threshold=0.8)
    placed = cut(groups.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row"))
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))["__row"].alias("first"), F.count("*").alias("n")).where("n > 1")
    rest = placed.join(first, "component_id").where("__row <> first").select("__row")
    return rows.join(rest, "__row", "left_anti").select(*COLUMNS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that hold a passage of the benchmark."""
    return decontaminate.uncontaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: each document as often as it was drawn, with its number of copies."""
    rows = _numbered(docs)
    drawn = mixing.mix(rows, keys=["__row"]).where("copies > 0").select("__row", "copies")
    mixed = rows.join(drawn, "__row").select(*COLUMNS, "copies")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
]

#: A trained classifier, sketches, alignments and hashed draws: SQL can't express these stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each stage keeps is checkpointed for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
