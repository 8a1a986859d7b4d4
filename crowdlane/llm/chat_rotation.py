"""Multi-party dialogues rendered from the perspective of every participant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SYSTEM, UNKNOWN = "system", "unknown"


def rotate_perspectives(turns: DataFrame, turns_per_example: int = 64) -> DataFrame:
    """conv_id, part, speaker, n_turns, rendered, mask_spans: one row per dialogue and participant.

    ``turns`` has conv_id, turn, role (the name of who speaks) and text. For each participant
    but ``system`` the whole dialogue is rendered with that speaker as assistant, system turns as such
    and the others as users with their names::

        <|system|>\\n...<|end|>\\n  <|user:NAME|>\\n...<|end|>\\n  <|assistant|>\\n...<|end|>\\n

    ``mask_spans`` has the [start, end) code points to learn from: text and end mark of the
    speaker's own turns. ``<|`` inside a text or name becomes ``< |``, so that no text can forge a mark.

    Dialogues are cut into parts of ``turns_per_example`` rows in their order, so that no row holds an unbounded
    dialogue. Every part has the perspectives of all participants of the dialogue, also of those silent in it, and
    begins with the system turns from before it, each text once; ``n_turns`` counts these too. Turns with equal numbers
    are ordered by name, then text; repeated rows stay. A null or blank role is ``unknown``, null text is empty.
    Rows without turn number have no order: they form parts of their own, numbered below zero.
    Rows with null conv_id are not known to be one dialogue: they are cut alike, but their parts share
    neither participants nor system turns. A dialogue with system turns only gives no row. Other columns are ignored.
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    name = safe(F.coalesce(F.expr("nullif(trim(role), '')"), F.lit(UNKNOWN)))
    said = turns.select("conv_id", "turn", name.alias("name"), safe(F.coalesce("text", F.lit(""))).alias("text"))
    # both are running counts, so a dialogue is sorted but never held; rows without turn number come first
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "name", "text")
    none = F.sum(F.col("turn").isNull().cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = said.withColumn("row", F.row_number().over(order).cast("bigint") - 1).withColumn("none", none)
    rows = rows.withColumn("place", F.expr("if(turn is null, null, row - none)"))
    rows = rows.withColumn(
        "part", F.expr(f"if(turn is null, -1 - (row div {turns_per_example}), place div {turns_per_example})")
    )
    whole = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "name", "text"))).alias("own"))
    # of each dialogue: who speaks, and where each system text stands first; added up before it moves
    first = (
        said.where("conv_id is not null")
        .groupBy("conv_id", "name", F.expr(f"if(name = '{SYSTEM}', text, null)").alias("text"))
        .agg(F.min("turn").alias("turn"))
    )
    dialogues = first.groupBy(F.col("conv_id").alias("conv")).agg(
        F.collect_set(F.expr(f"if(name <> '{SYSTEM}', name, null)")).alias("names"),
        F.sort_array(
            F.collect_list(F.expr(f"if(name = '{SYSTEM}' and turn is not null, struct(turn, name, text), null)"))
        ).alias("prompts"),
    )
    names = F.expr(f"coalesce(names, array_distinct(filter(own.name, x -> x <> '{SYSTEM}')))")
    shown = F.expr(
        """concat(
            transform(filter(coalesce(prompts, array()), x -> part < 0 or x < own[0]),
                x -> named_struct('name', x.name, 'text', x.text)),
            transform(own, x -> named_struct('name', x.name, 'text', x.text)))"""
    )
    parts = whole.join(dialogues, F.col("conv_id") == F.col("conv"), "left").select("conv_id", "part", shown.alias("turns"), names.alias("names"))
    each = parts.select("conv_id", "part", "turns", F.explode("names").alias("speaker"))
    pieces = F.expr(
        f"""transform(turns, t -> named_struct(
            'mine', t.name = speaker,
            'head', case when t.name = speaker then '<|assistant|>\\n' when t.name = '{SYSTEM}' then '<|system|>\\n'
                         else concat('<|user:', t.name, '|>\\n') end,
            'body', concat(t.text, '<|end|>\\n')))"""
    )
    spans = F.expr(
        """aggregate(pieces, named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, end: int>>)),
            (a, p) -> named_struct(
                'at', a.at + length(p.head) + length(p.body),
                'spans', if(p.mine, concat(a.spans, array(named_struct(
                    'start', a.at + length(p.head), 'end', a.at + length(p.head) + length(p.body)))), a.spans)),
            a -> a.spans)"""
    )
    return each.withColumn("pieces", pieces).select(
        "conv_id",
        "part",
        "speaker",
        F.size("turns").alias("n_turns"),
        F.expr("array_join(transform(pieces, p -> concat(p.head, p.body)), '')").alias("rendered"),
        spans.alias("mask_spans"),
    )


def spans_text(spans: str) -> str:
    """SQL for spans as text, ``start-end`` each, with commas."""
    return f"array_join(transform({spans}, s -> concat(s.start, '-', s.end)), ',')"


ORACLE = r"""
WITH t AS (
    SELECT conv_id, CAST(floor(turn / 64.0) AS BIGINT) AS part, turn,
           replace(coalesce(nullif(trim(role, ' '), ''), 'unknown'), '<|', '< |') AS name,
           replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body
    FROM conversations
), s AS (SELECT DISTINCT conv_id, part, name AS speaker FROM t WHERE name <> 'system'),
p AS (
    SELECT s.conv_id, s.part, speaker, turn, t.name, body, t.name = speaker AS mine,
           CASE WHEN t.name = speaker THEN '<|assistant|>' WHEN t.name = 'system' THEN '<|system|>'
                ELSE '<|user:' || t.name || '|>' END || chr(10) AS head
    FROM s JOIN t ON s.conv_id = t.conv_id AND s.part = t.part
), o AS (
    SELECT *, sum(length(head) + length(body)) OVER w AS stop
    FROM p WINDOW w AS (PARTITION BY conv_id, part, speaker ORDER BY turn, name, body ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, part, speaker, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(head || body, '' ORDER BY turn, name, body) AS rendered,
       coalesce(string_agg(CASE WHEN mine THEN CAST(stop - length(body) AS VARCHAR) || '-' || CAST(stop AS VARCHAR) END, ','
                ORDER BY turn, name, body), '') AS mask_spans
FROM o GROUP BY conv_id, part, speaker
"""
