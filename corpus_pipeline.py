"""The corpus pipeline: documents to training sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatework.llm import decontaminate, language_id, packing, secret_ledger, simhash
from slatework.llm.sampling import fold, free_name
from slatework.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a language: no text, or no letter in it. ``lang`` stays as it is.

    Nothing is learned from the third of the ids that the operator's query holds out.
    If nothing can be learned at all (``lang`` is null wherever it may be used), every
    document with a letter stays: only null and letterless texts are ever dropped.
    """
    answer = free_name("answer", docs.columns)
    found = language_id.identify(docs, learn=fold(F.col("doc_id"), 3) != 1, answer=answer)
    return found.where(F.col(answer)["has_letter"]).drop(answer)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """(documents with a unique number per row, written; name of the number's column).

    Ids may be null or repeated, so stages judge rows by this number. It is
    written because two readings of one plan need not number rows alike.
    """
    key = free_name("row_key", docs.columns)
    return stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed-documents"), key


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate group: that of the smallest id.

    Of several rows with that id one stays. Rows without an id come after all
    others, so one of them stays only if no row of the group has an id.
    """
    keyed, key = _keyed(docs)
    # As the operator's id: groups are named by their first row, and every row has a place.
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col(key).alias("row"))
    found = simhash.near_duplicates(keyed.select(place.alias("place"), "text"), id_column="place")
    kept = found.where("doc_id.row = component_id.row").select(F.col("doc_id.row").alias(key))
    return keyed.join(kept, key, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops exactly the rows that the contamination rule marks."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, key = _keyed(docs)
    found = decontaminate.contamination(keyed, benchmark, id_column=key)
    marked = found.where("contaminated").select(F.col("doc_id").alias(key))
    return keyed.join(marked, key, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a marker; documents stay."""
    return secret_ledger.redact(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, each inside one document."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: SQL cannot express the stages; tests compare each with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
