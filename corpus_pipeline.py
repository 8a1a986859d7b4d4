"""From documents to a training mix: quality, repeated lines, near copies, test leaks, source weights.

Every stage works on all rows its predecessor kept. The hash of a text stands for it where a stage
decides about texts, so rows without doc_id and rows that share one are decided like all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdlane.llm.decontaminate import find_leaks
from crowdlane.llm.line_dedup import repeated_lines
from crowdlane.llm.mixing import mix_sources
from crowdlane.llm.ngram_join import ngram_components
from crowdlane.llm.quality import document_statistics, fit, keep_good
from crowdlane.llm.scratch import read, ship, store

TH = "_text_hash"


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(TH, F.xxhash64("text"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more; learnt from labels whose crc32(doc_id) mod 3 is not 1."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    labels = labels.where("pmod(crc32(cast(doc_id as string)), 3) <> 1")
    return keep_good(docs, fit(document_statistics(docs), labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; n_chars follows. One without words left goes.

    Rows without doc_id come after all others.
    """
    again = repeated_lines(docs, unnamed=True).groupBy("doc_id", "th").agg(F.collect_set("line_no").alias("_gone"))
    rows = _hashed(docs).join(again.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), F.expr(f"doc_id <=> _id and {TH} = _th"), "left")
    left = F.expr("array_join(filter(split(text, '\\n'), (x, i) -> not array_contains(_gone, i)), '\\n')")
    cut = F.col("_gone").isNotNull()
    rows = rows.withColumn("text", F.when(cut, left).otherwise(F.col("text")))
    rows = rows.where(~cut | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.withColumn("n_chars", F.when(cut, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the least doc_id, null last.

    Near copies have a Jaccard coefficient of 0.8 or more over their 5-word shingles.
    Of rows that agree in doc_id and text one stays, the least by the other columns.
    """
    rows = _hashed(docs)
    each = rows.groupBy(TH, "doc_id").count()
    first = each.groupBy(TH).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("count").alias("copies"))).alias("first")
    )
    groups = ngram_components(rows.select(F.col(TH).alias("doc_id"), "text"), k=5, num=80, den=100)
    groups = groups.select("doc_id", "component_id").distinct()
    kept = first.join(groups.selectExpr("~~doc_id as h", "component_id"), F.col(TH) == F.col("h"))
    kept = kept.groupBy("component_id").agg(F.min(F.struct("first", TH)).alias("k"))
    kept = store(kept.selectExpr(f"k.{TH} as _h", "k.first.doc_id as _id", "k.first.copies as _copies"), "kept")
    stay = rows.join(kept, F.expr(f"{TH} = _h and doc_id <=> _id"))
    once = stay.where("_copies = 1").select(*docs.columns)
    often = stay.where("_copies > 1").groupBy("_h").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return once.union(often)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those in which a test item is found."""
    rows = _hashed(docs)
    leaks = find_leaks(rows.select(F.col(TH).alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    gone = store(leaks.select(F.col("doc_id").alias("_h")).distinct(), "leaks")
    return rows.join(gone, F.col(TH) == F.col("_h"), "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document enters the mix."""
    return mix_sources(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: a trained classifier, SimHash groups and a knapsack are no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
