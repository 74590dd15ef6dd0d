"""Preference formatting: the common turn prefix of two conversations as prompt, the rest as paired masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED = "assistant"


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _segments(turns: Column) -> Column:
    """A turn is its head, never trained, and its body with the end mark, trained in turns of the assistant."""

    def two(turn: Column) -> Column:
        head = F.struct(F.concat(F.lit("<|"), turn["role"], F.lit("|>\n")).alias("text"), F.lit(False).alias("train"))
        body = F.struct(F.concat(turn["text"], F.lit("<|end|>\n")).alias("text"), (turn["role"] == TRAINED).alias("train"))
        return F.array(head, body)

    return F.flatten(F.transform(turns, two))


def preference_pairs(turns: DataFrame, pair_col: str, chosen_col: str, turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Format pairs of conversations for preference training.

    :param turns: one row per turn; ``pair_col`` names the pair, ``chosen_col`` is true for the chosen conversation's
        turns and false for the rejected one's.
    :return: (pair_id, n_common, n_chosen, n_rejected: turns, prompt: the rendered common prefix, chosen and rejected:
        array<struct<text, train>>, whose texts follow the prompt and whose flags are the loss mask).

    Turns stand by turn number, ties by role and text, a null number first; repeated rows are turns of their own. A null
    role is ``unknown``, a null text empty. A side without turns has no segments and the prompt is empty. Rows whose
    pair or side is null belong to no pair and give none. An empty table gives an empty table; other columns are ignored.

    One shuffle by pair: a conversation is one row of the result, so its turns must meet; pairs never do.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("unknown")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    side = lambda flag: F.sort_array(F.collect_list(F.when(F.col(chosen_col) == flag, turn)))
    whole = turns.where(F.col(pair_col).isNotNull() & F.col(chosen_col).isNotNull())
    whole = whole.groupBy(F.col(pair_col).alias("pair_id")).agg(side(True).alias("c"), side(False).alias("r"))
    same = F.zip_with("c", "r", lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    differs = F.array_position(same, F.lit(False)).cast("int")
    whole = whole.withColumn("n", F.when(differs == 0, F.size("c")).otherwise(differs - 1))
    rest = lambda x: _segments(F.slice(x, F.col("n") + 1, F.size(x)))
    prompt = F.array_join(F.transform(F.slice("c", 1, F.col("n")), _rendered), "")
    return whole.select("pair_id", F.col("n").alias("n_common"), F.size("c").alias("n_chosen"), F.size("r").alias("n_rejected"), prompt.alias("prompt"), rest("c").alias("chosen"), rest("r").alias("rejected"))


def spelled(segments: str) -> Column:
    """The segments as one text, each behind its mask bit."""
    return F.array_join(F.transform(segments, lambda s: F.concat(F.when(s["train"], F.lit("1")).otherwise(F.lit("0")), s["text"])), "")


_SIDE = """array_to_string(list_transform({x}[n + 1:], lambda t: '0<|' || t.role || '|>' || chr(10) ||
  case when t.role = 'assistant' then '1' else '0' end || t.text || '<|end|>' || chr(10)), '')"""
ORACLE_SQL = f"""
with t as (
  select cast(floor(conv_id / 2.0) as bigint) as pair_id, conv_id % 2 = 0 as chosen,
         {{'turn': turn, 'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}} as x
  from conversations where conv_id is not null),
g as (
  select pair_id, coalesce(list(x order by x.turn, x.role, x.text) filter (where chosen), []) as c,
         coalesce(list(x order by x.turn, x.role, x.text) filter (where not chosen), []) as r
  from t group by pair_id),
n as (
  select *, coalesce(list_min(list_filter(range(1, greatest(len(c), len(r)) + 1),
    lambda i: i > least(len(c), len(r)) or c[i].role <> r[i].role or c[i].text <> r[i].text)) - 1, len(c)) as n
  from g)
select pair_id, cast(n as int) as n_common, cast(len(c) as int) as n_chosen, cast(len(r) as int) as n_rejected,
       md5(array_to_string(list_transform(c[1:n], lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '')) as prompt_md5,
       md5({_SIDE.format(x='c')}) as chosen_md5, md5({_SIDE.format(x='r')}) as rejected_md5
from n
"""
