"""Preference formatting of chosen and rejected conversations, in DataFrame functions only.

The longest common prefix of turns (same role and text) is rendered once as the prompt. What
follows on either side is its completion; its mask lists runs of characters as length:flag, with
flag 1 where an assistant speaks, header excluded and end mark included.

Defined cases. Turns are ordered by number, then role, then text; repeated rows count once. Turns
of a conversation without id take no part. A null role or text is rendered empty and equals only
another null. A pair with one side only has an empty other side. Equal sides have empty
completions and are not usable. A mark inside a text is broken by a zero-width space, so that
texts cannot forge turns. A conversation is one training example and is rendered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.registry import query, table

HEAD_OPEN, HEAD_CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def turns_of(frame: DataFrame, key: str) -> DataFrame:
    """key, turns: the ordered distinct turns of each conversation."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"))
    return frame.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("pair_id")).agg(
        F.array_sort(F.collect_set(turn)).alias("turns"))


def _safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit(HEAD_OPEN), F.lit("<\u200b|"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD_OPEN), _safe(turn["role"]), F.lit(HEAD_CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(_head(x), _body(x))), "")


def mask(turns: Column) -> Column:
    def runs(turn: Column) -> Column:
        spoken = F.coalesce(turn["role"] == TRAINED, F.lit(False)).cast("int").cast("string")
        return F.concat(F.length(_head(turn)).cast("string"), F.lit(":0,"),
                        F.length(_body(turn)).cast("string"), F.lit(":"), spoken)
    return F.array_join(F.transform(turns, runs), ",")


def common_turns(ours: Column, theirs: Column) -> Column:
    """Length of the longest common prefix."""
    def same(a: Column, b: Column) -> Column:
        return a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])
    return (F.array_position(F.array_append(F.zip_with(ours, theirs, same), F.lit(False)), False) - 1).cast("int")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs``: pair_id, chosen and rejected as arrays of (turn, role, text)."""
    def rest(name: str) -> Column:
        return F.slice(name, F.col("prompt_turns") + 1, F.greatest(F.size(name) - F.col("prompt_turns"), F.lit(0)))

    def speaks(name: str) -> Column:
        return F.exists(name, lambda x: F.coalesce(x["role"] == TRAINED, F.lit(False)))

    return (pairs.withColumn("prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
            .withColumns({"__good": rest("chosen"), "__bad": rest("rejected")})
            .select("pair_id", "prompt_turns", rendered(F.slice("chosen", 1, F.col("prompt_turns"))).alias("prompt"),
                    rendered(F.col("__good")).alias("chosen"), mask(F.col("__good")).alias("chosen_mask"),
                    rendered(F.col("__bad")).alias("rejected"), mask(F.col("__bad")).alias("rejected_mask"),
                    (speaks("__good") & speaks("__bad")).alias("usable")))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """One row per pair. Both frames have ``key``, turn, role, text."""
    none = F.array().cast("array<struct<turn:long,role:string,text:string>>")
    sides = turns_of(chosen, key).withColumnRenamed("turns", "__chosen").join(
        turns_of(rejected, key).withColumnRenamed("turns", "__rejected"), "pair_id", "full")
    return format_pairs(sides.select("pair_id", F.coalesce("__chosen", none).alias("chosen"),
                                     F.coalesce("__rejected", none).alias("rejected")))


def mismatched_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen: the conversations. Rejected: each up to its last assistant turn, with the text of
    that turn taken from the conversation whose id differs in the lowest bit; where that has no
    assistant turn, the turn is left out."""
    known = conversations.where("conv_id is not null").select(
        F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = known.where(F.col("role") == TRAINED).groupBy("pair_id").agg(
        F.max("turn").alias("last_turn"), F.max_by("text", F.struct("turn", "text")).alias("last_text"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"),
                        F.col("last_text").alias("other_text"), F.lit(True).alias("has_other"))
    at_end = F.col("turn") == F.col("last_turn")
    return known, known.join(last.join(other, "pair_id", "left"), "pair_id").where(
        (F.col("turn") < F.col("last_turn")) | (at_end & (F.col("role") == TRAINED) & F.col("has_other"))).select(
        "pair_id", "turn", "role", F.when(at_end, F.col("other_text")).otherwise(F.col("text")).alias("text"))


_SAFE = "replace(coalesce({0}, ''), '<|', '<' || chr(8203) || '|')"
_HEAD, _BODY = "'<|' || " + _SAFE.format("role") + " || '|>' || chr(10)", _SAFE.format("text") + " || '<|end|>' || chr(10)"

OP6_SQL = f"""
with known as (select distinct conv_id as pair_id, turn, role, text from conversations where conv_id is not null),
last as (select pair_id, max(turn) as last_turn, arg_max(text, turn) as last_text
         from known where role = 'assistant' group by 1),
bad as (select k.pair_id, k.turn, k.role,
               case when k.turn = l.last_turn then o.last_text else k.text end as text
        from known k join last l using (pair_id) left join last o on o.pair_id = xor(k.pair_id, 1)
        where k.turn < l.last_turn or (k.turn = l.last_turn and k.role = 'assistant' and o.pair_id is not null)),
g as (select *, row_number() over (partition by pair_id order by turn, role, text) as p from known),
b as (select *, row_number() over (partition by pair_id order by turn, role, text) as p from bad),
lcp as (select pair_id, min(p) - 1 as n from (
    select coalesce(g.pair_id, b.pair_id) as pair_id, coalesce(g.p, b.p) as p,
           g.pair_id is not null and b.pair_id is not null and g.role is not distinct from b.role
           and g.text is not distinct from b.text as same
    from g full join b on g.pair_id = b.pair_id and g.p = b.p
    union all select pair_id, count(*) + 1, false from g group by 1) where not same group by 1),
shown as (select 'g' as side, g.*, {_HEAD} as head, {_BODY} as body from g
         union all select 'b', b.*, {_HEAD}, {_BODY} from b)
select l.pair_id, l.n::int as prompt_turns,
       coalesce(string_agg(head || body, '' order by p) filter (side = 'g' and p <= n), '') as prompt,
       coalesce(string_agg(head || body, '' order by p) filter (side = 'g' and p > n), '') as chosen,
       coalesce(string_agg(length(head) || ':0,' || length(body) || ':' || (role = 'assistant')::int, ',' order by p)
                filter (side = 'g' and p > n), '') as chosen_mask,
       coalesce(string_agg(head || body, '' order by p) filter (side = 'b' and p > n), '') as rejected,
       coalesce(string_agg(length(head) || ':0,' || length(body) || ':' || (role = 'assistant')::int, ',' order by p)
                filter (side = 'b' and p > n), '') as rejected_mask,
       count(*) filter (side = 'g' and p > n and role = 'assistant') > 0
       and count(*) filter (side = 'b' and p > n and role = 'assistant') > 0 as usable
from lcp l join shown s using (pair_id) group by l.pair_id, l.n
"""


@query("op6_preference_formatting", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(*mismatched_replies(table(spark, sf_dir, "conversations")))
