"""Preference formatting: the longest common turn prefix of two conversations as prompt, two masked completions.

A turn is rendered as "<|role|>", a line break, its text and a line break. The turns that chosen and rejected have in
common from the start (same role and text) are rendered once as `prompt`; what follows on either side is its completion.
Only the texts of assistant turns in a completion are trained on: its mask lists their code point ranges ("start:end",
end exclusive) within the completion; everything else of it, and the whole prompt, is masked out. A pair is usable if
they share a turn and both completions hold an assistant turn and differ.

The table has no preferences, so the query makes them: every conversation is chosen, and rejected is the same
conversation with the text of its last assistant turn replaced by that of another one, the next in the order of md5 over
conv_id (the last takes the first). `rejected_id` names the conversation that gave the answer. Tables of real preferences
are pairs (chosen_id, rejected_id) for `format_pairs`, which finds their common turns in the same way.

Plan. Turns meet by conversation, once. The order is numbered by ranges that are sorted each on its own, so no task holds
more than a range, and the numbers do not depend on where ranges end; a conversation meets its answer by an equi-join on
that number. Nothing is grouped by content: equal first turns or whole conversations, however many, are rows like others.

Defined cases: rows without conv_id are no conversation; a null role counts as user, a null text as empty, a null turn
comes first; turns of the same number are ordered by role and text, repeated rows count as turns; a conversation without an
assistant turn has a null rejected_id, its turns as chosen, and is not usable; one whose own answer comes back (the only one,
or an equal text) is not usable; very long turns and conversations are one row each; other columns are not read; an empty
table gives an empty result. One job, which numbers the conversations, runs while the result is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, table


def turns_of(conversations: DataFrame) -> DataFrame:
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, t): the turns of each conversation in order."""
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))


def numbered(rows: DataFrame, order: str) -> tuple[DataFrame, int]:
    """rows with `number`, from 0 in the given order, and how many there are."""
    at = F.monotonically_increasing_id()  # number of the range, then 33 bits of the row in it
    placed = rows.repartitionByRange(order).sortWithinPartitions(order)
    placed = cut(placed.withColumns({"range": F.shiftright(at, 33), "row": at.bitwiseAND(2**33 - 1)}))
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"))  # one row per partition
    before = cut(sizes.select("range", "n", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("before")))
    total = before.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return placed.join(F.broadcast(before.drop("n")), "range").withColumn("number", F.col("before") + F.col("row")).drop("range", "row", "before"), total


def with_other_answers(convs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, c, r): each conversation, and itself with another one's last answer."""
    back = F.array_position(F.reverse(F.transform("t", lambda x: x["role"])), "assistant")
    convs = cut(convs.withColumn("last", F.when(back > 0, F.size("t") - back).cast("int")))
    answers = convs.where("last is not null").select("conv_id", F.md5(F.col("conv_id").cast("string").cast("binary")).alias("md5"), F.get("t", F.col("last"))["text"].alias("answer"))
    placed, n = numbered(answers, "md5")
    given = placed.select(F.pmod(F.col("number") - 1, F.lit(max(n, 1))).alias("number"), F.col("conv_id").alias("rejected_id"), "answer")
    taken = placed.select("conv_id", "number").join(given, "number").drop("number")
    changed = F.transform("t", lambda x, i: F.when(i == F.col("last"), F.struct(x["turn"].alias("turn"), x["role"].alias("role"), F.col("answer").alias("text"))).otherwise(x))
    none = F.slice("t", 1, 0)
    return convs.join(taken, "conv_id", "left").select(
        F.col("conv_id").alias("chosen_id"), "rejected_id", F.col("t").alias("c"), F.when(F.col("rejected_id").isNull(), none).otherwise(changed).alias("r")
    )


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n"))), "")


def _mask(turns: Column) -> Column:
    """Ranges of assistant texts, from the lengths of the turns before each."""
    sizes = F.transform(turns, lambda t: F.length(t["role"]) + F.length(t["text"]) + 6)
    ends = F.aggregate(
        sizes,
        F.struct(F.array().cast("array<int>").alias("all"), F.lit(0).alias("sum")),
        lambda acc, n: F.struct(F.array_append(acc["all"], acc["sum"] + n).alias("all"), (acc["sum"] + n).alias("sum")),
    )["all"]
    spans = F.zip_with(turns, ends, lambda t, e: F.struct(t["role"].alias("role"), (e - 1 - F.length(t["text"])).alias("a"), (e - 1).alias("b")))
    return F.array_join(F.transform(F.filter(spans, lambda s: s["role"] == "assistant"), lambda s: F.concat_ws(":", s["a"], s["b"])), ",")


def formatted(sides: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, c, r: turns) to shared turns, prompt, completions, masks, usable."""
    same = F.zip_with("c", "r", lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    n = F.when(F.array_contains("same", False), F.array_position("same", False) - 1).otherwise(F.size("same")).cast("int")
    placed = sides.withColumn("same", same).withColumn("n", n)
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    parted = placed.select("chosen_id", "rejected_id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    answers = lambda side: F.exists(side, lambda t: t["role"] == "assistant")
    shown = parted.select("chosen_id", "rejected_id", "n", "c", "r", _rendered(F.col("p")).alias("prompt"), _rendered(F.col("c")).alias("chosen"), _rendered(F.col("r")).alias("rejected"))
    return shown.select(
        "chosen_id", "rejected_id", F.col("n").cast("long").alias("n_common"), "prompt", "chosen", "rejected", _mask(F.col("c")).alias("chosen_mask"),
        _mask(F.col("r")).alias("rejected_mask"), ((F.col("n") > 0) & answers("c") & answers("r") & (F.col("chosen") != F.col("rejected"))).alias("usable"),
    )


def format_pairs(pairs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per pair (chosen_id, rejected_id) of a preference table; a side without turns is empty."""
    convs = conversations_of(turns)
    side = lambda name, to: convs.select(F.col("conv_id").alias(name), F.col("t").alias(to))
    met = pairs.join(side("chosen_id", "c"), "chosen_id", "left").join(side("rejected_id", "r"), "rejected_id", "left")
    none = F.array().cast(convs.schema["t"].dataType)
    return formatted(met.select("chosen_id", "rejected_id", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r")))


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(with_other_answers(conversations_of(turns_of(table(spark, sf_dir, "conversations")))))


#: The same rows in DuckDB's SQL.
ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (SELECT conv_id, max(k) AS k, arg_max(text, k) AS answer FROM t WHERE role = 'assistant' GROUP BY conv_id
), n AS (SELECT *, row_number() OVER (ORDER BY md5(conv_id::VARCHAR)) - 1 AS r, count(*) OVER () AS total FROM l
), p AS (
  SELECT DISTINCT t.conv_id AS chosen_id, b.conv_id AS rejected_id, a.k AS last, b.answer
  FROM t LEFT JOIN n a ON a.conv_id = t.conv_id LEFT JOIN n b ON b.r = (a.r + 1) % a.total
), c AS (SELECT p.chosen_id, t.k, t.role, t.text FROM p JOIN t ON t.conv_id = p.chosen_id
), d AS (SELECT p.chosen_id, t.k, t.role, CASE WHEN t.k = last THEN answer ELSE t.text END AS text FROM p JOIN t ON t.conv_id = p.chosen_id WHERE rejected_id IS NOT NULL
), same AS (
  SELECT chosen_id, coalesce(min(k) FILTER (WHERE c.role IS DISTINCT FROM d.role OR c.text IS DISTINCT FROM d.text) - 1, max(k)) AS n_common
  FROM c FULL JOIN d USING (chosen_id, k) GROUP BY chosen_id
), every AS (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'd' AS side, * FROM d
), shown AS (
  SELECT side, chosen_id, k, role, '<|' || role || '|>' || chr(10) || text || chr(10) AS x, length(text) AS n, k > n_common AS done
  FROM every JOIN same USING (chosen_id)
), ends AS (
  SELECT *, sum(length(x)) OVER (PARTITION BY side, chosen_id, done ORDER BY k) AS e FROM shown
), put AS (
  SELECT chosen_id,
         coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE side = 'c' AND NOT done), '') AS prompt,
         coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE side = 'c' AND done), '') AS chosen,
         coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE side = 'd' AND done), '') AS rejected,
         coalesce(string_agg((e - 1 - n) || ':' || (e - 1), ',' ORDER BY k) FILTER (WHERE side = 'c' AND done AND role = 'assistant'), '') AS chosen_mask,
         coalesce(string_agg((e - 1 - n) || ':' || (e - 1), ',' ORDER BY k) FILTER (WHERE side = 'd' AND done AND role = 'assistant'), '') AS rejected_mask,
         count(*) FILTER (WHERE side = 'c' AND done AND role = 'assistant') > 0 AND count(*) FILTER (WHERE side = 'd' AND done AND role = 'assistant') > 0 AS answered
  FROM ends GROUP BY chosen_id
)
SELECT chosen_id, rejected_id, CAST(n_common AS BIGINT) AS n_common, prompt, chosen, rejected, chosen_mask, rejected_mask, n_common > 0 AND answered AND chosen <> rejected AS usable
FROM p JOIN same USING (chosen_id) JOIN put USING (chosen_id)
"""
