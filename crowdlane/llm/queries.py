"""Every operator of the subpackage by query name, over its whole table with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crowdlane.operators.skew import splittable

from . import chat_rotation, license_scan, prefix_trie, toxicity
from .decontaminate import find_leaks
from .imatch import fingerprints
from .language_id import identify_languages, train
from .line_dedup import repeated_lines
from .mixing import mix_sources
from .ngram_join import ngram_components
from .periodic_runs import periodic_runs
from .quality import score_quality
from .scratch import read, ship, store
from .substring_dedup import repeated_passages

Query = Callable[[SparkSession, str], DataFrame]


def _remainder(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from documents whose crc32(doc_id) mod 5 is not 0; the others are held out. A null doc_id is not."""
    docs = read(spark, sf_dir, "documents")
    found = identify_languages(docs, train(docs.where(_remainder(5) != 0)))
    return found.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(read(spark, sf_dir, "documents")).drop("th", "group_id")


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered dialogues, their spans as text."""
    rows = chat_rotation.rotate_perspectives(read(spark, sf_dir, "conversations"))
    return rows.withColumn("mask_spans", F.expr(chat_rotation.spans_text("mask_spans")))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from labels whose crc32(doc_id) mod 3 is not 1; the others are held out. A null doc_id is not."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    found = score_quality(read(spark, sf_dir, "documents"), labels.where(_remainder(3) != 1))
    return found.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and whole texts, and the notices that stand across or within lines."""
    docs = store(license_scan.candidates(read(spark, sf_dir, "documents")), "candidates")  # few rows, read twice
    return license_scan.scan_licenses(docs).union(license_scan.scan_windows(docs))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conv_id and length of each conversation): of c, the first h turns of c - c % 5, then its own after its first h.

    h is crc32(c) % 9; the remainder of a negative id is negative, as in SQL. ``turns`` are those of :func:`prefix_trie.ordered_turns`.
    """
    turns = store(turns, "turns")
    own = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    heads = turns.where("place <= 8 and conv_id % 5 = 0").groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "a", "b", "bytes"))).alias("head")
    )
    made = own.withColumns({"base": F.expr("conv_id - conv_id % 5"), "h": F.expr("crc32(cast(conv_id as string)) % 9")})
    made = made.join(heads, "base", "left").withColumn("head", F.expr("slice(coalesce(head, array()), 1, int(h))"))
    made = store(made.select("conv_id", "h", "head"), "heads")
    first = made.select("conv_id", F.inline("head"))
    shift = made.selectExpr("conv_id", "h", "size(head) - h as shift")
    rest = turns.join(splittable(shift, "conv_id"), "conv_id").where("place > h")
    return first.union(rest.selectExpr("conv_id", "place + shift as place", "a", "b", "bytes")), made.select("conv_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = _rebuilt(prefix_trie.ordered_turns(read(spark, sf_dir, "conversations")))
    nodes, ends = prefix_trie.prefix_trie(turns, conversations)
    rows = nodes.join(prefix_trie.end_digests(ends), prefix_trie.NODE, "left")
    return rows.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(prefix_trie.NO_ENDS)).alias("ends_sha256"),
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from labels whose crc32(doc_id) mod 5 is not 0; the others are held out. A null doc_id is not."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("y"))
    found = toxicity.score_toxicity(docs, toxicity.train(docs, labels.where(_remainder(5) != 0)))
    return found.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def _made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id, text; texts with h = crc32(doc_id) divisible by 10 repeat p words from word a on, p and a by h.

    A null doc_id has no h, and its text stays as it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), batch.column(1)
            marks = [zlib.crc32(str(i).encode()) if i is not None else 1 for i in ids]
            if any(h % 10 == 0 for h in marks):
                texts = out.to_pylist()
                for at, h in enumerate(marks):
                    words = texts[at].encode().split() if h % 10 == 0 and texts[at] else []
                    if words:
                        n, g = len(words), h // 10
                        a = g % n
                        p = 1 + (n - a) // (3 + g % 8)
                        words[a:] = (words[a : a + p] * -(-(n - a) // p))[: n - a]
                        texts[at] = b" ".join(words).decode()
                out = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest (the first at ties, then that of least period), and digests of runs and kept words."""
    rows = periodic_runs(_made_periodic(read(spark, sf_dir, "documents")))
    best = rows.withColumn(
        "best", F.expr("array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))")
    )
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.expr("-best.start").alias("start"),
        F.expr("best.length").alias("length"),
        F.expr("-best.period").alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.expr("sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), ''), 256)").alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _shipped(f)
    for f in (
        op1_language_id,
        op2_substring_dedup,
        op3_line_dedup,
        op4_chat_rotation,
        op5_benchmark_decontamination,
        op6_quality_classifier,
        op7_document_fingerprints,
        op8_ngram_jaccard_join,
        op9_license_scan,
        op10_source_mixing,
        op11_prefix_trie,
        op12_toxicity,
        op13_periodic_runs,
    )
}

ORACLES: dict[str, str] = {
    "op4_chat_rotation": chat_rotation.ORACLE,
    "op9_license_scan": license_scan.oracle(),
    "op11_prefix_trie": prefix_trie.ORACLE,
}
