"""Preference formatting of chat data.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (same role, same
text) is rendered once as the prompt; what follows in each is rendered as its completion, with a mask
that is 1 on the characters of assistant turns and 0 on everything else. A pair whose conversations
are equal has no preference in it, and is reported so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sliceforge.runtime import table

#: The template of a turn.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, turns array<struct<turn, role, text>> in the order of turns.

    Null roles and texts count as empty; rows without a conv_id or turn take no part; a repeated row
    counts once, and turns that share a number come by role, then text.
    """
    return (
        conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    )


def pairs_by_prompt(conversations: DataFrame) -> DataFrame:
    """Pairs conversations that begin with the same first turn: each but the first is the rejected side of the one before it.

    Conversations are ordered by their number of turns, most first, then by conv_id; so a group of n gives n - 1 pairs, however large.
    A prompt that very many conversations share is ordered in pieces (by hash of conv_id), and the pieces are
    linked by one more pair each.
    """
    whole = turns_of(conversations).withColumn("n", F.size("turns")).withColumn("first", F.xxhash64(F.col("turns")[0]["role"], F.col("turns")[0]["text"]))
    salted = whole.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(64)))
    inner = Window.partitionBy("first", "salt").orderBy(F.desc("n"), "conv_id")
    placed = salted.withColumn("nth", F.row_number().over(inner)).withColumn("before", F.lag("conv_id").over(inner))
    heads = Window.partitionBy("first").orderBy(F.desc("n"), "conv_id")  # 64 rows a prompt at most
    linked = placed.filter("nth = 1").withColumn("prior", F.lag("conv_id").over(heads)).select("conv_id", "prior")
    return (
        placed.select("conv_id", "before")
        .join(linked, "conv_id", "left")
        .select(F.coalesce("before", "prior").alias("chosen_id"), F.col("conv_id").alias("rejected_id"))
        .filter("chosen_id IS NOT NULL")
    )


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")


def mask(turns: Column) -> Column:
    """1 for each code point of an assistant turn's text and its close, 0 for the others, as runs: array<struct<value, n>>."""

    def runs(t: Column) -> Column:
        head = F.length(t["role"]) + len(OPEN) + len(MIDDLE)
        body = F.length(t["text"]) + len(CLOSE)
        return F.array(
            F.struct(F.lit(0).alias("value"), head.cast("int").alias("n")),
            F.struct(F.when(t["role"] == "assistant", 1).otherwise(0).alias("value"), body.cast("int").alias("n")),
        )

    return F.flatten(F.transform(turns, runs))


def prefix_length(a: Column, b: Column) -> Column:
    """How many leading turns have the same role and text."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first_difference = F.array_position(same, False)  # 0: none
    return F.when(first_difference > 0, first_difference - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def format_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (chosen_id, rejected_id) -> prompt, both completions and their masks, a row for a pair.

    Pairs that name an unknown conversation or a null are left out; repeated pairs repeat. Where one
    conversation is a prefix of the other its completion is empty; `distinct` is false where both are.
    """
    whole = turns_of(conversations)
    a = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    b = whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    return format_turns(pairs.select("chosen_id", "rejected_id").join(a, "chosen_id").join(b, "rejected_id"))


def format_turns(sides: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, chosen, rejected) with the turns of both sides -> what format_pairs returns."""
    both = sides.withColumn("shared", prefix_length(F.col("chosen"), F.col("rejected")))
    rest_a = F.slice("chosen", F.col("shared") + 1, F.greatest(F.size("chosen"), F.lit(1)))
    rest_b = F.slice("rejected", F.col("shared") + 1, F.greatest(F.size("rejected"), F.lit(1)))
    head = F.slice("chosen", F.lit(1), F.col("shared"))
    return both.select(
        "chosen_id",
        "rejected_id",
        F.col("shared").alias("prompt_turns"),
        render(head).alias("prompt"),
        render(rest_a).alias("chosen"),
        render(rest_b).alias("rejected"),
        mask(rest_a).alias("chosen_mask"),
        mask(rest_b).alias("rejected_mask"),
        ((F.size(rest_a) > 0) | (F.size(rest_b) > 0)).alias("distinct"),
    )


def swapped(conversations: DataFrame) -> DataFrame:
    """A pair of each conversation: (chosen_id, rejected_id, chosen, rejected), one shuffle, on the pair of ids.

    The table names no preferences, so they are made: chosen is the conversation, rejected the same turns with
    the text of the last assistant turn taken from the conversation next to it (ids 2k and 2k + 1). Where that
    one is missing or has no assistant turn the rejected side lacks the turn and rejected_id is null. A
    conversation without an assistant turn is paired with itself. Rows are taken as turns_of takes them.
    """
    pair = F.expr("shiftright(CAST(conv_id AS BIGINT), 1)")
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    odd = F.expr("CAST(conv_id AS BIGINT) & 1")
    both = (
        conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
        .select(pair.alias("pair"), F.struct(odd.alias("odd"), turn.alias("t")).alias("side"))
        .groupBy("pair")
        .agg(F.array_sort(F.collect_set("side")).alias("sides"))
    )

    def side(parity: int) -> Column:
        return F.transform(F.filter("sides", lambda s: s["odd"] == parity), lambda s: s["t"])

    def last(turns: Column) -> Column:
        """Place (from 0) of the last assistant turn, -1 without one."""
        return F.coalesce(F.array_max(F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", i).otherwise(-1))), F.lit(-1))

    each = both.select("pair", side(0).alias("a"), side(1).alias("b")).select("pair", "a", "b", last(F.col("a")).alias("at_a"), last(F.col("b")).alias("at_b"))
    ways = [F.struct((F.col("pair") * 2 + i).alias("own_id"), (F.col("pair") * 2 + 1 - i).alias("other_id"), F.col(x).alias("own"), F.col(f"at_{x}").alias("at"), F.get(y, F.col(f"at_{y}"))["text"].alias("text")) for i, (x, y) in enumerate((("a", "b"), ("b", "a")))]
    sides = each.select(F.explode(F.array(*ways)).alias("w")).select("w.*").filter(F.size("own") > 0)
    given = F.transform("own", lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.when(i == F.col("at"), F.col("text")).otherwise(t["text"]).alias("text")))
    rejected = F.filter(given, lambda t: t["text"].isNotNull())
    partner = F.when(F.col("at") < 0, F.col("own_id")).when(F.col("text").isNotNull(), F.col("other_id"))
    return sides.select(F.col("own_id").alias("chosen_id"), partner.alias("rejected_id"), F.col("own").alias("chosen"), rejected.alias("rejected"))


def op6(spark, sf_dir: str) -> DataFrame:
    out = format_turns(swapped(table(spark, sf_dir, "conversations")))
    ones = lambda c: F.aggregate(F.filter(c, lambda r: r["value"] == 1), F.lit(0).cast("long"), lambda s, r: s + r["n"])
    return out.select(
        "chosen_id",
        "rejected_id",
        "prompt_turns",
        F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen", 256).alias("chosen_sha256"),
        F.sha2("rejected", 256).alias("rejected_sha256"),
        ones(F.col("chosen_mask")).alias("chosen_learned"),
        ones(F.col("rejected_mask")).alias("rejected_learned"),
        "distinct",
    )


OP6_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM t
), l AS (
  SELECT conv_id, coalesce(max(i) FILTER (role = 'assistant'), 0) AS at FROM n GROUP BY 1
), o AS (
  SELECT l.conv_id, l.at, CASE WHEN l.at = 0 THEN l.conv_id WHEN m.text IS NOT NULL THEN m.conv_id END AS other, m.text
  FROM l LEFT JOIN (SELECT l.conv_id, n.text FROM l JOIN n ON n.conv_id = l.conv_id AND n.i = l.at) m ON m.conv_id = l.conv_id + CASE WHEN l.conv_id % 2 = 0 THEN 1 ELSE -1 END
), sides AS (
  SELECT conv_id, 'c' AS side, i, role, text FROM n
  UNION ALL
  SELECT conv_id, 'r', row_number() OVER (PARTITION BY conv_id ORDER BY i), role, text
  FROM (SELECT n.conv_id, n.i, n.role, CASE WHEN n.i = o.at THEN o.text ELSE n.text END AS text FROM n JOIN o USING (conv_id)) WHERE text IS NOT NULL
), shown AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS line, CASE WHEN role = 'assistant' THEN length(text) + 9 ELSE 0 END AS learned FROM sides
), k AS (
  SELECT c.conv_id, least(coalesce(min(CASE WHEN r.i IS NULL OR c.role <> r.role OR c.text <> r.text THEN c.i END) - 1, count(*)), count(*)) AS k
  FROM sides c LEFT JOIN sides r ON r.conv_id = c.conv_id AND r.side = 'r' AND r.i = c.i WHERE c.side = 'c' GROUP BY 1
)
SELECT s.conv_id AS chosen_id, any_value(o.other) AS rejected_id, CAST(any_value(k) AS INTEGER) AS prompt_turns,
       sha256(coalesce(string_agg(line, '' ORDER BY i) FILTER (side = 'c' AND i <= k), '')) AS prompt_sha256,
       sha256(coalesce(string_agg(line, '' ORDER BY i) FILTER (side = 'c' AND i > k), '')) AS chosen_sha256,
       sha256(coalesce(string_agg(line, '' ORDER BY i) FILTER (side = 'r' AND i > k), '')) AS rejected_sha256,
       CAST(coalesce(sum(learned) FILTER (side = 'c' AND i > k), 0) AS BIGINT) AS chosen_learned,
       CAST(coalesce(sum(learned) FILTER (side = 'r' AND i > k), 0) AS BIGINT) AS rejected_learned,
       count(*) FILTER (i > k) > 0 AS "distinct"
FROM shown s JOIN k ON k.conv_id = s.conv_id JOIN o ON o.conv_id = s.conv_id GROUP BY 1
"""
