"""Licence texts and notices in documents, by Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scratch import store

#: Well-known public licence notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mit-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
]
#: templates with more bigrams in all are joined by a shuffle
BROADCAST_BIGRAMS = 100_000


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of a text, words being runs of a-z and 0-9 in lower case."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    # the lambda's argument holds the words, so that they are split once
    pairs = F.transform(
        F.array(words),
        lambda w: F.array_distinct(
            F.zip_with(
                F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                F.slice(w, 2, F.greatest(F.size(w), F.lit(1))),
                lambda a, b: F.concat_ws(" ", a, b),
            )
        ),
    )
    return pairs[0]


def seeds(templates: Sequence[tuple[str, str]], least: float) -> str | None:
    """A pattern that every lower-case text with a coefficient of ``least`` or more to some template contains.

    Such a text shares at least least / (2 - least) of a template's k bigrams, say o; so it has one
    of any k - o + 1 of them. The longest are taken, which are seldom in other texts.
    """
    followers: dict[str, set[str]] = {}
    for _, text in templates:
        words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
        pairs = sorted(set(zip(words, words[1:])), key=lambda p: (-len(p[0] + p[1]), p))
        shared = max(1, math.ceil(least / (2 - least) * len(pairs) - 1e-9))
        for first, second in pairs[: len(pairs) - shared + 1]:
            followers.setdefault(first, set()).add(second)
    if not followers:
        return None
    ways = "|".join(f"{a}[^a-z0-9]+(?:{'|'.join(sorted(b))})" for a, b in sorted(followers.items()))
    return f"(?<![a-z0-9])(?:{ways})(?![a-z0-9])"


def candidates(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """doc_id, text of the rows in which a notice can be: those that hold a bigram of :func:`seeds`. Null texts are none."""
    pattern = seeds(templates, least)
    hit = F.lower("text").rlike(pattern) if pattern else F.lit(False)
    return docs.select("doc_id", "text").where(F.col("text").isNotNull() & hit)


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = 0.8
) -> DataFrame:
    """doc_id, line_no, license, dice, n_bigrams: lines and whole texts that are a licence notice.

    Each line of a text of several lines, and each whole text (line_no -1), is compared with every
    template that its size allows: 2 * common / (a + b) >= least needs
    least / (2 - least) <= a / b <= (2 - least) / least. Bigrams are formed only of texts, then lines,
    that hold a bigram which every match must have (:func:`seeds`). The best template counts, at equal
    coefficients the first by name. Common bigrams are counted by one join with the
    templates' bigrams, before any shuffle; only what matches moves.

    Null, empty and short texts match nothing. Rows that repeat doc_id and text give one
    row per line; rows of one doc_id with different texts give theirs each. Other columns are ignored.
    """
    return _units(docs, templates, least).select("doc_id", "line_no", "b.license", "b.dice", "n_bigrams")


def _units(docs: DataFrame, templates: Sequence[tuple[str, str]], least: float) -> DataFrame:
    """doc_id, line_no, unit, n_bigrams, b: what :func:`scan_licenses` finds, with the hash of the line or text."""
    spark = docs.sparkSession
    known = spark.createDataFrame(list(templates), "license string, text string").select(
        "license", F.explode(bigrams(F.col("text"))).alias("pair"), F.size(bigrams(F.col("text"))).alias("n_template")
    )
    sizes = [r[0] for r in known.select("n_template").distinct().collect()]
    ratio = (2 - least) / least * (1 + 1e-9)  # 1.2 / 0.8 is a little less than 1.5
    pattern = seeds(templates, least)
    lines = F.split("text", "\n")
    # outer: explode would evaluate its array a second time, to see whether it is empty
    units = candidates(docs, templates, least).select(
        "doc_id",
        F.posexplode_outer(F.when(F.size(lines) > 1, F.concat(F.array("text"), lines)).otherwise(F.array("text"))),
    )
    hit = F.lower("col").rlike(pattern) if pattern else F.lit(False)
    low, high = min(sizes, default=0) / ratio, max(sizes, default=-1) * ratio
    sized = F.transform(
        F.array(bigrams(F.col("col"))),
        lambda p: F.when(
            F.size(p).between(low, high), F.transform(p, lambda x: F.struct(x.alias("pair"), F.size(p).alias("n")))
        ),
    )[0]
    units = units.where(hit).select(
        "doc_id", (F.col("pos") - 1).alias("line_no"), F.xxhash64("col").alias("unit"), F.explode_outer(sized).alias("x")
    )
    found = units.select("doc_id", "line_no", "unit", F.col("x.n").alias("n_bigrams"), F.col("x.pair").alias("pair"))
    known = known.withColumnRenamed("pair", "known")
    few = sum(len(text.split()) for _, text in templates) <= BROADCAST_BIGRAMS
    common = (
        found.join(F.broadcast(known) if few else known, F.col("pair") == F.col("known"))
        .where((F.col("n_bigrams") <= F.col("n_template") * ratio) & (F.col("n_template") <= F.col("n_bigrams") * ratio))
        .groupBy("doc_id", "line_no", "unit", "n_bigrams", "license", "n_template")
        .agg(F.size(F.collect_set("pair")).alias("common"))
    )
    dice = 2 * F.col("common") / (F.col("n_bigrams") + F.col("n_template"))
    return (
        common.withColumn("dice", dice)
        .where(F.col("dice") >= least)
        .groupBy("doc_id", "line_no", "unit", "n_bigrams")
        .agg(F.min(F.struct((-F.col("dice")).alias("d"), "license", "dice")).alias("b"))
    )


def scan_windows(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = 0.8
) -> DataFrame:
    """doc_id, line_no, license, dice, n_bigrams: licence notices that are neither a line nor a whole text.

    A notice may be wrapped over several lines or stand within a longer line. For every template, the stretches
    of words between any two of its bigrams in a text, across line breaks, of at most (2 - least) / least times its size
    are compared with it; a stretch that matches best without these ends is no match better. Of
    stretches that overlap the best counts, then the first; line_no is where it begins. Stretches that lie in a line that
    matches a template are left out, and those that meet a line, or a whole text, that matches the same one.

    Null, empty and one-word texts have no stretch. Rows that repeat doc_id and text count once; rows of one doc_id
    with different texts, or without doc_id, give theirs each. Other columns are ignored. The work on a
    text grows with its length times the square of the greatest template's.
    """
    pattern = seeds(templates, least)
    if not pattern:
        return scan_licenses(docs, templates, least)
    ratio = (2 - least) / least * (1 + 1e-9)
    known = []
    for name, text in templates:
        words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
        pairs = sorted({" ".join(x) for x in zip(words, words[1:])})
        if pairs:
            need, most = max(1, math.ceil(len(pairs) / ratio)), int(len(pairs) * ratio)
            known.append((name, pairs, need, most))
    wanted = ", ".join(f"'{x}'" for x in sorted({x for k in known for x in k[1]}))
    known = F.array(
        *(F.struct(*(F.lit(v).alias(n) for v, n in zip(k, ("license", "pairs", "need", "most")))) for k in known)
    )
    words = F.expr(
        """filter(flatten(transform(split(text, '\\n'), (l, i) ->
            transform(split(lower(l), '[^a-z0-9]+'), w -> named_struct('w', w, 'line', i)))), x -> x.w <> '')"""
    )
    # Every step is a lambda's argument, so that it is computed once; no filter stands between them, as one would be
    # pushed below them with copies of their expressions. Empty arrays end in the explode.
    pairs = """if(size(w) < 2, array(), transform(sequence(0, size(w) - 2), i -> named_struct(
        'at', i, 'pair', concat(w[i].w, ' ', w[i + 1].w), 'first', w[i].line, 'last', w[i + 1].line)))"""
    matches = f"filter(p, x -> x.pair in ({wanted}))"
    own = "filter(every, x -> array_contains(k.pairs, x.pair))"
    # stretches from one match to another, short enough, with as many distinct common bigrams as a match needs
    stretches = """if(size(m) < k.need, array(), flatten(transform(sequence(0, size(m) - k.need), i -> filter(transform(
        filter(sequence(i + k.need - 1, least(size(m), i + k.most) - 1), j -> m[j].at - m[i].at < k.most),
        j -> named_struct('i', i, 'j', j, 'common', size(array_distinct(transform(slice(m, i + 1, j - i + 1), x -> x.pair))))),
        x -> x.common >= k.need))))"""
    sized = f"""transform({stretches}, x -> named_struct('a', m[x.i].at, 'b', m[x.j].at, 'first', m[x.i].first, 'last', m[x.j].last,
        'common', x.common, 'n', size(array_distinct(transform(slice(p, m[x.i].at + 1, m[x.j].at - m[x.i].at + 1), y -> y.pair)))))"""
    scored = f"""array_sort(filter(transform({sized}, x -> named_struct('worse', -2 * x.common / (x.n + size(k.pairs)),
        'a', x.a, 'b', x.b, 'first', x.first, 'last', x.last, 'n', x.n)), x -> -x.worse >= {least}D))"""
    apart = f"""transform(array({scored}), s -> aggregate(s, slice(s, 1, 0),
        (had, x) -> if(exists(had, y -> x.a <= y.b and y.a <= x.b), had, concat(had, array(x)))))[0]"""
    each = f"""transform(known, k -> transform(array({own}), m ->
        transform({apart}, x -> named_struct('license', k.license, 'x', x)))[0])"""
    notices = f"""flatten(flatten(transform(array({pairs}), p -> transform(array({matches}), every -> {each})[0])))"""
    texts = candidates(docs, templates, least).select("doc_id", "text", words.alias("w"), known.alias("known"))
    found = texts.select("doc_id", "text", F.explode_outer(F.expr(notices)).alias("f")).where("f is not null")
    found = found.select(
        "doc_id", "text", "f.license", "f.x.first", "f.x.last", (-F.col("f.x.worse")).alias("dice"), F.col("f.x.n").alias("n_bigrams")
    ).distinct()
    found = store(found, "notices")  # few rows, read three times
    # the lines and texts that match by themselves, of the texts in question
    id_of, unit = F.struct("doc_id", F.xxhash64("text").alias("th")), F.expr("if(unit_no < 0, text, split(text, '\\n')[unit_no])")
    met = found.withColumn("unit_no", F.explode(F.expr("concat(array(-1), sequence(first, last))"))).withColumn("unit", F.xxhash64(unit))
    whole = _units(found.select("doc_id", "text").distinct(), templates, least).selectExpr("doc_id as id", "line_no", "unit as known_unit", "b.license as own")
    same = "doc_id <=> id and unit = known_unit and unit_no = line_no and (license = own or (first = last and unit_no = first))"
    covered = met.join(whole, F.expr(same), "left_semi").select(id_of.alias("who"), "license", "first", "last", "n_bigrams").distinct()
    on = ["who", "license", "first", "last", "n_bigrams"]
    left = found.withColumn("who", id_of).join(covered, on, "left_anti")
    return left.select("doc_id", F.col("first").alias("line_no"), "license", "dice", "n_bigrams")


def oracle(templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = 0.8) -> str:
    rows = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in templates)
    return f"""
WITH known(license, text) AS (VALUES {rows}),
units AS (
    SELECT doc_id, -1 AS line_no, text FROM documents
    UNION ALL
    SELECT doc_id, i - 1, string_split(text, chr(10))[i]
    FROM documents, unnest(generate_series(1, len(string_split(text, chr(10))))) AS u(i)
    WHERE text LIKE '%' || chr(10) || '%'
), worded AS (
    SELECT doc_id, line_no, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
    FROM units
), paired AS (
    SELECT doc_id, line_no, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS p
    FROM worded WHERE len(w) > 1
), known_words AS (
    SELECT license, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
    FROM known
), known_pairs AS (
    SELECT license, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS k
    FROM known_words
), scored AS (
    SELECT doc_id, line_no, license, len(p) AS n_bigrams, 2 * len(list_intersect(p, k)) / (len(p) + len(k)) AS dice
    FROM paired JOIN known_pairs ON len(p) BETWEEN {least} / (2 - {least}) * len(k) - 1 AND (2 - {least}) / {least} * len(k) + 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY dice DESC, license) AS r FROM scored WHERE dice >= {least}
)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, license, dice, CAST(n_bigrams AS INTEGER) AS n_bigrams FROM ranked WHERE r = 1
"""
