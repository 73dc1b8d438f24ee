"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the whole dialogue is rendered once
with that speaker as the assistant and everybody else as a named user; the
mask marks the assistant's own words (and its end marker) for training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
GUARD = ("<|im_", "<| im_")  # a turn's text cannot forge a marker
TURNS_PER_PART = 64


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           system_roles=("system",), turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """One row per conversation, participant and part: ``conv_id``, ``speaker``,
    ``part`` (from 0), ``text``, ``mask`` (start:end code point spans of that
    text, comma-joined), ``n_turns`` and ``n_masked`` (code points in the mask).

    Turns come in the order of turn (null last), role, text; system turns keep
    their role and are nobody's perspective. A dialogue of up to
    ``turns_per_part`` turns is one part; a longer one is cut into parts whose
    texts, joined in order, are the rendering, so no task ever holds a whole
    endless conversation. Null role: the speaker ``unknown``. Null text:
    empty. Null conversation ids form one conversation. Repeated rows are
    turns of their own. A conversation with system turns only has no
    participant and no row. Other columns are not read.
    """
    rows = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("who"),
        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(GUARD[0]), F.lit(GUARD[1])).alias("body"),
        F.isnull(turn).alias("no_turn"),
        # never null, so that one hash partitioning serves the join and the window after it
        F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.lit("")).alias("key"))
    rows = rows.withColumn("range", F.floor(F.coalesce("turn", F.lit(0)) / turns_per_part))
    order = ["no_turn", "turn", "who", "body"]
    numbered = rows.withColumn("sub", F.floor((F.row_number().over(
        Window.partitionBy("key", "no_turn", "range").orderBy(*order)) - 1) / turns_per_part))
    pieces = numbered.groupBy("key", "no_turn", "range", "sub").agg(F.sort_array(
        F.collect_list(F.struct(*order))).alias("turns"),
        F.first("conv_id").alias("conv_id"))
    speakers = rows.filter(~F.col("who").isin(*system_roles)).select(
        "key", F.col("who").alias("speaker")).distinct()
    both = pieces.join(speakers, "key")
    both = both.withColumn("part", (F.row_number().over(
        Window.partitionBy("key", "speaker").orderBy("no_turn", "range", "sub")) - 1).cast("int"))
    system = ", ".join(f"'{r}'" for r in system_roles) or "''"
    head = f"""CASE WHEN t.who IN ({system}) THEN concat('{START}', t.who, '\\n')
        WHEN t.who = speaker THEN '{START}assistant\\n'
        ELSE concat('{START}user name=', t.who, '\\n') END"""
    both = both.withColumn("shown", F.expr(
        f"transform(turns, t -> named_struct('head', {head}, 'tail', concat(t.body, '{END}'), "
        f"'own', t.who = speaker))"))
    out = both.withColumn("text", F.expr("array_join(transform(shown, s -> concat(s.head, s.tail, '\\n')), '')"))
    out = out.withColumn("spans", F.expr("""aggregate(shown,
        named_struct('off', 0L, 'spans', CAST(array() AS array<struct<s: bigint, e: bigint>>)),
        (a, s) -> named_struct('off', a.off + length(s.head) + length(s.tail) + 1, 'spans',
            CASE WHEN s.own THEN concat(a.spans, array(named_struct('s', a.off + length(s.head),
                'e', a.off + length(s.head) + length(s.tail)))) ELSE a.spans END),
        a -> a.spans)"""))
    return out.select(
        "conv_id", "speaker", "part", "text",
        F.expr("array_join(transform(spans, s -> concat(s.s, ':', s.e)), ',')").alias("mask"),
        F.size("turns").cast("long").alias("n_turns"),
        F.expr("aggregate(spans, 0L, (a, s) -> a + s.e - s.s)").alias("n_masked"))
