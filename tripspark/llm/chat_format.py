"""Preference formatting: chosen and rejected conversations as one prompt and two completions.

Method. The longest common prefix of turns of a chosen and a rejected conversation is rendered
once, as the prompt; what differs follows as two completions, each with a mask that says which of
its characters are trained on (the assistant's turns, not their headers). Only DataFrame
functions are used.

The tables name no preferences, so `preference_pairs` makes them: conversations that open with
the same turn are alternatives; sorted by their text, neighbours are paired, so that their common
prefix is long. The one with more assistant text is chosen, on a tie the one of the smaller id.
Conversations are dealt out by ranges of (opening, text, conv_id) and numbered inside a range;
the small counts of the ranges give each its first number, so a large opening is divided over
tasks and its neighbours stay the same. A conversation that is left over gives a row without a
rejected side: what comes before its last assistant turn is the prompt.

Defined cases: rows without conv_id belong to no conversation and give nothing. A NULL turn number
sorts first, a NULL role is 'unknown', a NULL text is empty. Repeated rows are repeated turns.
Equal conversations give empty completions. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.llm.common import partitions, stored

def _header(turn: Column) -> Column:
    return F.concat(lit("<|im_start|>"), turn["role"], lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], lit("<|im_end|>\n"))


def rendered(turns: Column) -> Column:
    """The turns in the usual chat markup."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Which characters are trained on: 'n-m,n-m,...', n without and then m with loss per turn."""

    def of(turn: Column) -> Column:
        header, body = F.length(_header(turn)), F.length(_body(turn))
        trained = turn["role"] == "assistant"
        off = F.when(trained, header).otherwise(header + body)
        on = F.when(trained, body).otherwise(lit(0))
        return F.concat_ws("-", off.cast("string"), on.cast("string"))

    return F.array_join(F.transform(turns, of), ",")


def common_prefix(a: Column, b: Column) -> Column:
    """How many turns two conversations have in common at their start."""
    shorter = F.least(F.size(a), F.size(b))
    both = F.arrays_zip(
        F.slice(a, lit(1), shorter).alias("a"), F.slice(b, lit(1), shorter).alias("b")
    )
    same = F.transform(both, lambda t: t["a"] == t["b"])
    first_change = F.array_position(same, False)
    return F.when(first_change > 0, first_change.cast("int") - 1).otherwise(shorter)


def _after(turns: Column, n: Column) -> Column:
    return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, lit(0)))


def preferences(pairs: DataFrame) -> DataFrame:
    """Format rows of chosen_id, chosen_turns, rejected_id, rejected_turns (arrays of role and
    text without NULLs inside; the rejected side may be NULL): chosen_id, rejected_id,
    prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask."""
    chosen, rejected = col("chosen_turns"), col("rejected_turns")
    roles = F.transform(chosen, lambda t: t["role"])
    last_answer = F.size(chosen) - F.array_position(F.reverse(roles), "assistant").cast("int")
    alone = F.when(F.array_contains(roles, "assistant"), last_answer).otherwise(F.size(chosen))
    n = F.when(rejected.isNull(), alone).otherwise(common_prefix(chosen, rejected))
    return (
        pairs.withColumn("prompt_turns", n.cast("int"))
        .withColumn("prompt_part", F.slice(chosen, lit(1), col("prompt_turns")))
        .withColumn("chosen_part", _after(chosen, col("prompt_turns")))
        .withColumn("rejected_part", _after(rejected, col("prompt_turns")))
        .select(
            "chosen_id",
            "rejected_id",
            "prompt_turns",
            rendered(col("prompt_part")).alias("prompt"),
            rendered(col("chosen_part")).alias("chosen"),
            mask(col("chosen_part")).alias("chosen_mask"),
            rendered(col("rejected_part")).alias("rejected"),
            mask(col("rejected_part")).alias("rejected_mask"),
        )
    )


def gathered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order."""
    return (
        conversations.where("conv_id IS NOT NULL")
        .groupBy(col("conv_id").cast("long").alias("conv_id"))
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "turn",
                        F.coalesce("role", lit("unknown")).alias("role"),
                        F.coalesce("text", lit("")).alias("text"),
                    )
                )
            ).alias("numbered")
        )
        .select(
            "conv_id",
            F.transform(
                "numbered",
                lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")),
            ).alias("turns"),
        )
    )


def preference_pairs(conversations: DataFrame, group: int | None = None) -> DataFrame:
    """Pairs of conversations with the same first turn, and those left over, as `preferences`
    takes them. Every conversation is in exactly one row. With `group`, ranges hold about so many
    conversations; the pairs are the same."""
    answers = F.filter("turns", lambda t: t["role"] == "assistant")
    convs = gathered(conversations).select(
        "conv_id",
        "turns",
        F.sha2(rendered(F.slice("turns", 1, 1)).cast("binary"), 256).alias("opening"),
        F.length(rendered(answers)).alias("answer_chars"),
        rendered(col("turns")).alias("whole"),
    )
    n = partitions(conversations.sparkSession)
    if group is not None:
        n = max(n, -(-conversations.select("conv_id").distinct().count() // group))
    # Written, so that the ranges are the same for the numbers and for their offsets.
    ranged = stored(
        convs.repartitionByRange(n, "opening", "whole", "conv_id").withColumn(
            "part", F.spark_partition_id()
        ),
        "conversations",
    )
    earlier = Window.partitionBy("opening").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = ranged.groupBy("opening", "part").agg(F.count("*").alias("n")).select(
        "opening", "part", F.coalesce(F.sum("n").over(earlier), lit(0)).alias("offset")
    )
    order = Window.partitionBy("opening", "part").orderBy("whole", "conv_id")
    other = F.struct("conv_id", "turns", "answer_chars")
    numbered = ranged.join(offsets, ["opening", "part"]).select(
        "opening",
        "conv_id",
        "turns",
        "answer_chars",
        F.row_number().over(order).alias("row"),
        (col("offset") + F.row_number().over(order)).alias("place"),
        F.lead(other).over(order).alias("next"),
    )
    # The last of a range goes with the first of the next one.
    firsts = numbered.where("row = 1 AND place % 2 = 0").select(
        "opening", (col("place") - 1).alias("place"), other.alias("first")
    )
    ranked = (
        numbered.where("place % 2 = 1")
        .join(firsts, ["opening", "place"], "left")
        .withColumn("other", F.coalesce("next", "first"))
    )
    swap = (col("other.answer_chars") > col("answer_chars")) | (
        (col("other.answer_chars") == col("answer_chars"))
        & (col("other.conv_id") < col("conv_id"))
    )
    mine = F.struct("conv_id", "turns", "answer_chars")
    return ranked.select(
        F.when(swap, col("other")).otherwise(mine).alias("c"),
        F.when(swap, mine).otherwise(col("other")).alias("r"),
    ).select(
        col("c.conv_id").alias("chosen_id"),
        col("c.turns").alias("chosen_turns"),
        col("r.conv_id").alias("rejected_id"),
        col("r.turns").alias("rejected_turns"),
    )


def report(conversations: DataFrame) -> DataFrame:
    return preferences(preference_pairs(conversations))


ORACLE = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
         '<|im_start|>' || coalesce(role, 'unknown') || chr(10) AS header,
         coalesce(text, '') || '<|im_end|>' || chr(10) AS body, coalesce(text, '') AS text
  FROM conversations
  WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
                               ORDER BY turn NULLS FIRST, role, text) AS i
  FROM said
), conv AS (
  SELECT conv_id, string_agg(header || body, '' ORDER BY i) AS whole,
         max(CASE WHEN i = 1 THEN header || body END) AS opening,
         coalesce(sum(length(header || body)) FILTER (WHERE role = 'assistant'), 0) AS answer_chars,
         max(i) AS n, max(CASE WHEN role = 'assistant' THEN i END) AS last_answer
  FROM numbered
  GROUP BY conv_id
), placed AS (
  SELECT *, row_number() OVER w AS place, lead(conv_id) OVER w AS other_id,
         lead(answer_chars) OVER w AS other_chars
  FROM conv
  WINDOW w AS (PARTITION BY opening ORDER BY whole, conv_id)
), pair AS (
  SELECT *, other_chars > answer_chars
         OR (other_chars = answer_chars AND other_id < conv_id) AS swap
  FROM placed
  WHERE place % 2 = 1
), ids AS (
  SELECT CASE WHEN swap THEN other_id ELSE conv_id END AS chosen_id,
         CASE WHEN swap THEN conv_id ELSE other_id END AS rejected_id
  FROM pair
), change AS (
  SELECT chosen_id, min(i) AS changed_at
  FROM (
    SELECT ids.chosen_id, c.i
    FROM ids JOIN numbered c ON c.conv_id = chosen_id
    JOIN numbered r ON r.conv_id = rejected_id AND r.i = c.i
    WHERE c.header <> r.header OR c.body <> r.body
  )
  GROUP BY chosen_id
), measured AS (
  SELECT chosen_id, rejected_id,
         CASE WHEN rejected_id IS NULL THEN coalesce(c.last_answer - 1, c.n)
              WHEN changed_at IS NOT NULL THEN changed_at - 1
              ELSE least(c.n, r.n) END AS prompt_turns
  FROM ids JOIN conv c ON c.conv_id = chosen_id
  LEFT JOIN conv r ON r.conv_id = rejected_id LEFT JOIN change USING (chosen_id)
), turn_mask AS (
  SELECT conv_id, i, header || body AS said,
         CASE WHEN role = 'assistant'
              THEN length(header)::VARCHAR || '-' || length(body)::VARCHAR
              ELSE length(header || body)::VARCHAR || '-0' END AS m
  FROM numbered
)
SELECT chosen_id, rejected_id, CAST(prompt_turns AS INTEGER) AS prompt_turns,
       (SELECT coalesce(string_agg(said, '' ORDER BY i), '') FROM turn_mask
        WHERE conv_id = chosen_id AND i <= prompt_turns) AS prompt,
       (SELECT coalesce(string_agg(said, '' ORDER BY i), '') FROM turn_mask
        WHERE conv_id = chosen_id AND i > prompt_turns) AS chosen,
       (SELECT coalesce(string_agg(m, ',' ORDER BY i), '') FROM turn_mask
        WHERE conv_id = chosen_id AND i > prompt_turns) AS chosen_mask,
       CASE WHEN rejected_id IS NOT NULL THEN
       (SELECT coalesce(string_agg(said, '' ORDER BY i), '') FROM turn_mask
        WHERE conv_id = rejected_id AND i > prompt_turns) END AS rejected,
       CASE WHEN rejected_id IS NOT NULL THEN
       (SELECT coalesce(string_agg(m, ',' ORDER BY i), '') FROM turn_mask
        WHERE conv_id = rejected_id AND i > prompt_turns) END AS rejected_mask
FROM measured
"""
