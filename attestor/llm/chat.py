"""Preference formatting of chosen and rejected conversations, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A turn as it is rendered, and the role whose turns are learned.
TURN, LEARNED = "<|{role}|>\n{text}<|end|>\n", "assistant"


def preference_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask) of every pair.

    turns(conv_id, turn, role, text), pairs(pair_id, chosen_id, rejected_id). The prompt is the longest common prefix of the
    two conversations' turns, role and text alike, rendered once; chosen and rejected are the rests. A mask lists
    start:end of the characters to learn: the assistant's texts with their end mark, joined by commas, empty if none.
    Turns are in order of turn, then role and text (repeated turn numbers); null turns come first, null roles and texts
    count as empty. A side without turns has an empty completion and shares no prompt. A pair id must come once.
    """
    rows = turns.select(
        F.col("conv_id").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"),
    )
    sides = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("c")), F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("c")))).alias("s"))
    sides = sides.select("pair_id", "s.side", "s.c")
    # one shuffle by conversation brings turns and sides together, one by pair the two sides
    said = sides.join(rows, sides["c"] == rows["conv_id"], "left").groupBy("pair_id").agg(
        *(F.sort_array(F.collect_list(F.when(F.col("side") == i, F.col("t")))).alias(n) for i, n in ((0, "_a"), (1, "_b")))
    )
    plain = "transform({}, t -> struct(t.role, t.text))"
    said = said.selectExpr("pair_id", f"{plain.format('_a')} as _a", f"{plain.format('_b')} as _b")
    first = "element_at(filter(sequence(1, least(size(_a), size(_b)) + 1), i -> i > least(size(_a), size(_b)) or _a[i - 1] <> _b[i - 1]), 1) - 1"
    said = said.withColumn("n_prompt_turns", F.expr(first))
    head, tail = (p.replace("\n", "\\n") for p in TURN.split("{text}"))
    shown = "array_join(transform({}, t -> concat('" + head.replace("{role}", "', t.role, '") + "', t.text, '" + tail + "')), '')"
    size = f"char_length(t.role) + char_length(t.text) + {len(TURN.format(role='', text=''))}"
    lead = f"char_length(t.role) + {len(TURN.split('{text}')[0].replace('{role}', ''))}"
    mask = (
        "aggregate({}, struct(0 as n, cast(array() as array<string>) as m), (s, t) -> struct(s.n + " + size + " as n, "
        f"if(t.role = '{LEARNED}', concat(s.m, array(concat(s.n + {lead}, ':', s.n + {size}))), s.m) as m), s -> array_join(s.m, ','))"
    )
    rest = {n: f"slice({c}, n_prompt_turns + 1, size({c}))" for n, c in (("chosen", "_a"), ("rejected", "_b"))}
    return said.selectExpr(
        "pair_id",
        "cast(n_prompt_turns as long) as n_prompt_turns",
        f"{shown.format('slice(_a, 1, n_prompt_turns)')} as prompt",
        *(f"{shown.format(r)} as {n}" for n, r in rest.items()),
        *(f"{mask.format(r)} as {n}_mask" for n, r in rest.items()),
    )


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs of neighbouring conversation numbers: 2k is the chosen side of pair k, 2k + 1 the rejected one.

    A pair whose other conversation is absent stays, with an empty side; null ids have no pair.
    """
    ids = turns.where("conv_id is not null").select(F.expr("cast(floor(conv_id / 2) as long)").alias("pair_id")).distinct()
    return ids.select("pair_id", (F.col("pair_id") * 2).alias("chosen_id"), (F.col("pair_id") * 2 + 1).alias("rejected_id"))


#: preference_pairs over neighbours, for DuckDB.
ORACLE = """
with t as (
  select conv_id // 2 as pair_id, conv_id % 2 as side, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn, coalesce(role, ''), coalesce(text, '')) as i
  from conversations where conv_id is not null),
same as (
  select a.pair_id, a.i from t a join t b on a.pair_id = b.pair_id and a.i = b.i and a.role = b.role and a.text = b.text where a.side = 0 and b.side = 1),
prefix as (
  select pair_id, count(*) as n from (select pair_id, i, row_number() over (partition by pair_id order by i) as k from same) where i = k group by pair_id),
r as (
  select t.*, coalesce(n, 0) as n, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as shown, length(role) + 5 as skip from t left join prefix using (pair_id)),
m as (
  select *, case when i > n then sum(case when i > n then length(shown) else 0 end) over (partition by pair_id, side order by i) - length(shown) end as spot from r)
select pair_id, max(n) as n_prompt_turns,
  coalesce(string_agg(case when side = 0 and i <= n then shown end, '' order by i), '') as prompt,
  coalesce(string_agg(case when side = 0 and i > n then shown end, '' order by i), '') as chosen,
  coalesce(string_agg(case when side = 1 and i > n then shown end, '' order by i), '') as rejected,
  coalesce(string_agg(case when side = 0 and i > n and role = 'assistant' then (spot + skip)::bigint::varchar || ':' || (spot + length(shown))::bigint::varchar end, ',' order by i), '') as chosen_mask,
  coalesce(string_agg(case when side = 1 and i > n and role = 'assistant' then (spot + skip)::bigint::varchar || ':' || (spot + length(shown))::bigint::varchar end, ',' order by i), '') as rejected_mask
from m group by pair_id
"""
