"""Preference formatting: the longest common turn prefix of a chosen and a rejected conversation is the prompt, rendered once; the rest are two masked completions.

Turns are equal if role and text are. If one conversation is a prefix of the other, its
completion is empty. A completion's mask is given as spans [start, end) of code points
that are trained on: text and end mark of assistant turns. Headers and other
roles' turns are not.

Rules for odd input: null roles and texts are empty; turns go by number, nulls first, ties
by role and text; repeated turns stay; a pair that lacks a side has an empty
conversation there; extra columns are ignored; an empty table gives no rows. A
conversation is put together in one row, so it must fit in memory as its rendered text does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

START, END = "<|im_start|>", "<|im_end|>\n"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row for each key: turns, an array of (turn, role, text) in order."""
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    kind = f"array<struct<turn:{turns.schema['turn'].dataType.simpleString()},role:string,text:string>>"
    return turns.groupBy(key).agg(F.sort_array(F.collect_list(one)).cast(kind).alias("turns"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Spans like '12-40;95-130' of assistant texts with their end marks in the rendered turns."""
    head = len(START) + 1
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        lo = a["at"] + head + F.length(t["role"])
        hi = lo + F.length(t["text"]) + len(END)
        span = F.concat_ws("-", lo.cast("string"), hi.cast("string"))
        return F.struct(hi.alias("at"), F.when(t["role"] == "assistant", F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    return F.array_join(F.aggregate(turns, zero, step, lambda a: a["spans"]), ";")


def formatted(pairs: DataFrame) -> DataFrame:
    """n_common, prompt, and completion and mask of either side, for pairs with array columns chosen and rejected; other columns stay."""
    none = F.array().cast(pairs.schema["chosen"].dataType)
    c, r = F.coalesce("chosen", none), F.coalesce("rejected", none)
    same = F.zip_with(c, r, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    k = F.least(F.size(c), F.size(r))
    first = F.array_position(F.transform(same, lambda x: F.when(x, 0).otherwise(1)), 1).cast("int")
    common_turns = F.when(first > 0, first - 1).otherwise(k)
    rest = [x for x in pairs.columns if x not in ("chosen", "rejected")]
    (n,) = common.hidden(pairs, "n")
    cut = pairs.withColumn(n, common_turns)
    tail = lambda x: F.slice(x, F.col(n) + 1, F.size(x) + 1)
    return cut.select(
        *rest,
        F.col(n).alias("n_common"),
        _render(F.slice(c, 1, F.col(n))).alias("prompt"),
        _render(tail(c)).alias("chosen"),
        _mask(tail(c)).alias("chosen_mask"),
        _render(tail(r)).alias("rejected"),
        _mask(tail(r)).alias("rejected_mask"),
    )


def swapped_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from a table of plain conversations with integer ids: chosen is a conversation, rejected the same with the reply of another.

    Conversations 2k and 2k + 1 lend each other their last assistant text, which takes
    the place of the text of the last assistant turn and ends the conversation there. Without
    such a partner or turn, rejected stops before the last turn. The two are put together in one group,
    by one shuffle of the turns.
    """
    one = F.struct("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    both = turns.groupBy(F.shiftright("conv_id", 1).alias("pair")).agg(F.sort_array(F.collect_list(one)).alias("all"))
    each = both.select("all", F.explode(F.array_distinct(F.transform("all", lambda t: t["conv_id"]))).alias("conv_id"))
    plain = lambda test: F.transform(F.filter("all", test), lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text")))
    replies = F.transform(F.filter("all", lambda t: (t["conv_id"] == F.col("conv_id").bitwiseXOR(F.lit(1))) & (t["role"] == "assistant")), lambda t: t["text"])
    rows = each.select("conv_id", plain(lambda t: t["conv_id"].eqNullSafe(F.col("conv_id"))).alias("turns"), F.try_element_at(replies, F.lit(-1)).alias("reply"))
    kind = f"array<struct<turn:{turns.schema['turn'].dataType.simpleString()},role:string,text:string>>"
    rows = rows.withColumn("turns", F.col("turns").cast(kind)).withColumn("last", F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i))))
    own = F.get("turns", F.col("last"))
    other = F.struct(own["turn"].alias("turn"), own["role"].alias("role"), F.col("reply").alias("text"))
    swapped = F.concat(F.slice("turns", 1, F.col("last")), F.array(other))
    rejected = F.when(F.col("last").isNotNull() & F.col("reply").isNotNull(), swapped).otherwise(F.slice("turns", 1, F.size("turns") - 1))
    return rows.select("conv_id", F.col("turns").alias("chosen"), rejected.cast(kind).alias("rejected"))


def op6(turns: DataFrame) -> DataFrame:
    common.session(turns)
    return formatted(swapped_pairs(turns))


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
o AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
a AS (SELECT conv_id, max(i) FILTER (role = 'assistant') AS last, any_value(n) AS n FROM o GROUP BY 1),
r AS (SELECT a.conv_id, last, o.text AS reply FROM a JOIN o ON o.conv_id = a.conv_id AND i = last),
p AS (SELECT a.conv_id, a.n, a.last, r.reply FROM a LEFT JOIN r ON r.conv_id = xor(a.conv_id, 1)),
rej AS (
  SELECT o.conv_id, i, role, CASE WHEN i = last AND reply IS NOT NULL THEN reply ELSE text END AS text FROM o JOIN p USING (conv_id)
  WHERE CASE WHEN last IS NOT NULL AND reply IS NOT NULL THEN i <= last ELSE i <= p.n - 1 END),
k AS (
  SELECT p.conv_id, coalesce(min(o.i) FILTER (rej.i IS NULL OR o.role <> rej.role OR o.text <> rej.text) - 1, any_value(p.n)) AS n_common
  FROM p JOIN o USING (conv_id) LEFT JOIN rej ON rej.conv_id = o.conv_id AND rej.i = o.i GROUP BY 1),
s AS (SELECT conv_id, i, role, text, 'c' AS side FROM o UNION ALL SELECT conv_id, i, role, text, 'r' FROM rej),
x AS (SELECT s.*, n_common, '{START}' || role || chr(10) || text || '{END.strip()}' || chr(10) AS y, length(text) + {len(END)} AS z FROM s JOIN k USING (conv_id)),
m AS (
  SELECT *, CASE WHEN i > n_common AND role = 'assistant' THEN (e - z)::VARCHAR || '-' || e::VARCHAR END AS span
  FROM (SELECT *, sum(CASE WHEN i > n_common THEN length(y) ELSE 0 END) OVER (PARTITION BY conv_id, side ORDER BY i)::BIGINT AS e FROM x)),
f AS (
  SELECT conv_id, side, coalesce(string_agg(y, '' ORDER BY i) FILTER (i <= n_common), '') AS prompt, coalesce(string_agg(y, '' ORDER BY i) FILTER (i > n_common), '') AS body,
         coalesce(string_agg(span, ';' ORDER BY i) FILTER (span IS NOT NULL), '') AS spans FROM m GROUP BY ALL)
SELECT k.conv_id, k.n_common::INT AS n_common, c.prompt, c.body AS chosen, c.spans AS chosen_mask, coalesce(r.body, '') AS rejected, coalesce(r.spans, '') AS rejected_mask
FROM k JOIN f c ON c.conv_id = k.conv_id AND c.side = 'c' LEFT JOIN f r ON r.conv_id = k.conv_id AND r.side = 'r'
"""
