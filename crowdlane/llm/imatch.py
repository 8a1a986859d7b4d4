"""I-Match fingerprints of texts and of edited texts, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import store

#: subsets per level; a term of the lexicon is in one subset of level 0, and of level l with probability 4**-l
SUBSETS, LEVELS = 32, 4
#: a lexicon of more terms is joined by a shuffle
BROADCAST_TERMS = 1 << 20


def terms(text: Column) -> Column:
    """Distinct hashed terms: runs of letters and digits in lower case."""
    parts = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda x: x != "")
    return F.array_distinct(F.transform(parts, lambda x: F.xxhash64(x)))


def lexicon(docs: DataFrame, low: float, high: float) -> DataFrame:
    """Terms whose inverse document frequency ln(N / df) lies in [low, high].

    The sum of all document frequencies is N times the mean number m of distinct terms, so
    there are at most m * exp(high) such terms, however many documents there are.
    """
    n = docs.count()
    # outer: explode would evaluate its array a second time, to see whether it is empty
    df = docs.select(F.explode_outer(terms(F.col("text"))).alias("term")).groupBy("term").count()
    return df.where("term is not null").where(F.col("count").between(n / math.exp(high), n / math.exp(low))).select("term")


def _following(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, prev_id, prev_n: the ring of distinct ids, ascending, after the last the first."""
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max("n").alias("n"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = store(ids.repartitionByRange(parts, "doc_id").withColumn("cell", F.spark_partition_id()), "ids")
    # the ends of the ranges: one row per partition
    line = Window.orderBy("cell")
    ends = ids.groupBy("cell").agg(
        F.min("doc_id").alias("first"), F.max(F.struct("doc_id", "n")).alias("last")
    )
    ends = ends.select(
        "cell",
        F.lead("first").over(line).alias("first_after"),
        F.lag("last").over(line).alias("last_before"),
        F.min("first").over(Window.partitionBy()).alias("first"),
        F.max("last").over(Window.partitionBy()).alias("last"),
    )
    own = Window.partitionBy("cell").orderBy("doc_id")
    ring = ids.select(
        "cell",
        "doc_id",
        F.lead("doc_id").over(own).alias("next_id"),
        F.lag(F.struct("doc_id", "n")).over(own).alias("before"),
    ).join(ends.withColumnRenamed("cell", "c"), F.col("cell") == F.col("c"))
    before = F.coalesce("before", "last_before", "last")
    return ring.select(
        "doc_id",
        F.coalesce("next_id", "first_after", "first").alias("next_id"),
        before["doc_id"].alias("prev_id"),
        before["n"].alias("prev_n"),
    )


def likeness(a: str, b: str) -> Column:
    """0 to 1: of the subsets that hold terms of either text the share with equal hashes, at the best level.

    A level counts if four subsets hold terms (level 0 always). Equal fingerprints have 1.
    """
    both = f"array_intersect({a}.entries, {b}.entries)"
    either = f"array_distinct(transform(concat({a}.entries, {b}.entries), x -> shiftright(x, 16)))"
    share = f"""transform(array(named_struct('same', {both}, 'held', {either})), z ->
        array_max(transform(sequence(0, {LEVELS - 1}), l -> transform(
            array(size(filter(z.held, x -> shiftright(x, 5) = l))),
            held -> if(held >= if(l = 0, 1, 4), size(filter(z.same, x -> shiftright(x, 21) = l)) / held, null))[0]
        )))[0]"""
    return F.when(F.col(f"{a}.whole") == F.col(f"{b}.whole"), 1.0).otherwise(
        F.coalesce(F.expr(share), F.lit(0.0))
    )


def fingerprints(docs: DataFrame, low: float = 3.0, high: float = 7.0, short: int = 400) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row.

    ``docs`` has doc_id and text; null text is empty. The edited text has its last floor(n_chars / 4)
    code points replaced by the first as many (or all) of the next document by doc_id; after
    the last comes the first. Terms outside the band of inverse document frequency do not
    count, except in texts of fewer than ``short`` code points, which keep all. The fingerprint is the hash of
    the sorted distinct terms that are kept, then those of randomised subsets of them.

    Rows of a repeated doc_id have the same next document, the next greater doc_id; of its rows
    the one with the least text hash counts as its fingerprint, the least beginning as its text.
    Rows without doc_id have no next document: their edited text is the text, near_next is 0.
    A text without terms has the fingerprint of no terms. Other columns are ignored.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lex = store(lexicon(base, low, high), "lexicon")
    small = lex.count() <= BROADCAST_TERMS
    ring = store(_following(base.select("doc_id", F.length("text").alias("n"))), "ring").withColumnRenamed("doc_id", "id")
    # The texts move once: every doc_id is in the ring, and has a document before it, so that all joins are
    # inner, and both sides read the texts by one exchange. Only the beginnings move on, to the document before.
    there = base.where("doc_id is not null").join(ring, F.col("doc_id") == F.col("id"))
    tails = there.groupBy(F.col("prev_id").alias("of")).agg(
        F.min(F.expr("substring(text, 1, cast(prev_n div 4 as int))")).alias("tail")
    )
    quarter = "cast(length(text) div 4 as int)"
    edited = F.expr(f"concat(substring(text, 1, length(text) - {quarter}), substring(tail, 1, {quarter}))")
    pairs = there.join(tails, F.col("doc_id") == F.col("of")).select("doc_id", "text", "next_id", edited.alias("edited"))
    alone = base.where("doc_id is null")
    alone = alone.select("doc_id", "text", F.lit(None).cast(base.schema["doc_id"].dataType).alias("next_id"), F.col("text").alias("edited"))
    marks = _marks(pairs, lex, small, short).union(_marks(alone, lex, small, short))
    marks = store(marks, "marks")
    following = marks.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("th", "own")).alias("least"))
    following = following.select(F.bitwise_not(F.bitwise_not("doc_id")).alias("following_id"), F.col("least.own").alias("nxt"))
    joined = marks.join(following, F.col("about.next_id") == F.col("following_id"), "left")
    return joined.select(
        "doc_id",
        F.col("about.n").cast("bigint").alias("n_chars"),
        F.col("about.sha").alias("edited_sha256"),
        _text("own").alias("fingerprint"),
        _text("ed").alias("edited_fingerprint"),
        likeness("own", "ed").alias("near_edited"),
        F.when(F.col("nxt").isNull(), 0.0).otherwise(likeness("own", "nxt")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def _marks(rows: DataFrame, lex: DataFrame, small: bool, short: int) -> DataFrame:
    """doc_id, th, about, copies, own, ed: the signatures of each text and its edited text, copies of a row once."""
    # one number for a term and its text: the lowest bit is 0 in the text's terms, 1 in the edited text's
    found = (
        rows.select(
            "doc_id",
            F.xxhash64("text").alias("th"),
            F.struct(F.length("text").alias("n"), F.sha2(F.col("edited").cast("binary"), 256).alias("sha"), "next_id").alias("about"),
            (F.length("text") < short).alias("all0"),
            (F.length("edited") < short).alias("all1"),
            terms(F.col("text")).alias("t0"),
            terms(F.col("edited")).alias("t1"),
        )
        .withColumn(
            "x",
            # a row without a term for the document itself
            F.explode_outer(
                F.expr(
                    """concat(array(named_struct('t', cast(null as bigint), 'side', 2)),
                              transform(t0, t -> named_struct('t', t, 'side', if(all0, -2, 0))),
                              transform(t1, t -> named_struct('t', t, 'side', if(all1, -1, 1))))"""
                )
            ),
        )
        .selectExpr("doc_id", "th", "if(x.side = 2, about, null) as about", "x.t", "x.side")
    )
    lex = lex.withColumnRenamed("term", "in_band")
    kept = found.join(F.broadcast(lex) if small else lex, F.col("t") == F.col("in_band"), "left").where(
        "in_band is not null or side < 0 or side = 2"
    )
    groups = kept.groupBy("doc_id", "th").agg(
        F.max("about").alias("about"),
        F.sum(F.expr("if(side = 2, 1L, 0L)")).alias("copies"),
        F.collect_set(F.expr("(t & -2L) | (side & 1)")).alias("both"),
    )
    return groups.select(
        "doc_id",
        "th",
        "about",
        "copies",
        _signature("filter(both, x -> x & 1 = 0)").alias("own"),
        _signature("transform(filter(both, x -> x & 1 = 1), x -> x & -2L)").alias("ed"),
    )


def _signature(kept: str) -> Column:
    """whole: hash of all sorted terms; entries: per level and subset with terms, the hash of its sorted terms.

    Terms are hashes themselves, so bits of their own decide by chance which subset of a level holds
    them. Subset and term make one number; in order, a subset's terms are neighbours, and its hash is a running one.
    """
    codes, shift = [], 1  # bit 0 tells the sides apart
    for level in range(LEVELS):
        held = f"filter(k, t -> (shiftright(t, {shift}) & {SUBSETS * 4**level - 1}) < {SUBSETS})" if level else "k"
        subset = f"{SUBSETS * level} + (shiftright(t, {shift}) & {SUBSETS - 1})"
        codes.append(f"transform({held}, t -> shiftleft({subset}, 56) | shiftrightunsigned(t, 8))")
        shift += 5 + 2 * level
    items = f"sort_array(concat({', '.join(codes)}))"
    code = "array(int(shiftleft(a.s, 16) | (a.h & 65535)))"
    entries = f"""aggregate({items},
        named_struct('out', cast(array() as array<int>), 's', -1L, 'h', 0L),
        (a, x) -> if(shiftright(x, 56) = a.s,
            named_struct('out', a.out, 's', a.s, 'h', xxhash64(a.h, x)),
            named_struct('out', if(a.s < 0, a.out, concat(a.out, {code})), 's', shiftright(x, 56), 'h', xxhash64(0L, x))),
        a -> if(a.s < 0, a.out, concat(a.out, {code})))"""
    # the lambda's argument holds the terms, so that they are formed once
    made = f"named_struct('whole', xxhash64(sort_array(k)), 'entries', {entries})"
    return F.expr(f"transform(array({kept}), k -> {made})[0]")


def _text(mark: str) -> Column:
    """Hex: 16 digits of the whole, then 2 for level and subset and 4 of the hash of each subset with terms."""
    return F.concat(
        F.lower(F.lpad(F.hex(f"{mark}.whole"), 16, "0")),
        F.lit(":"),
        F.lower(F.array_join(F.transform(f"{mark}.entries", lambda x: F.lpad(F.hex(x), 6, "0")), "")),
    )
