"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, with the columns of documents, and its decisions take
effect: rejected documents and copies are gone, dropped lines are gone from the text (n_chars
follows), documents with a benchmark passage are gone. The last stage returns pieces in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.llm.common import hash128, table, text_of
from vigilog.llm.decontaminate import find_leaks
from vigilog.llm.line_dedup import dedup_lines
from vigilog.llm.near_dedup import drop_near_duplicates
from vigilog.llm.packing import pack
from vigilog.llm.quality import THRESHOLD, fit, predicted_score
from vigilog.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(predicted_score(F.col("text"), model) >= THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 10 documents go from every document; n_chars follows the text.

    Columns of documents that are called like the operator's counts keep their own values.
    """
    own = {c: f"__own_{c}" for c in ("n_lines", "n_dropped") if c in docs.columns}
    kept = dedup_lines(docs.withColumnsRenamed(own), min_docs=10, min_chars=1).drop(*own)
    kept = kept.withColumnsRenamed({new: old for old, new in own.items()})
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return drop_near_duplicates(docs, words=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go.

    They are named by doc_id and a hash of the text, so a null or repeated id hits no other row.
    """
    keyed = docs.select("text", F.struct("doc_id", hash128(text_of()).alias("copy")).alias("doc_id"))
    leaks = find_leaks(keyed, table(spark, sf_dir, "benchmark"))
    leaks = leaks.select("doc_id.*").distinct().select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"))
    rows = docs.withColumn("__own", hash128(text_of()))
    hit = (rows["__own"] == leaks["__copy"]) & rows["doc_id"].eqNullSafe(leaks["__id"])
    return rows.join(leaks, hit, "left_anti").drop("__own")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the trained classifier nor alignments and tokenisation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
