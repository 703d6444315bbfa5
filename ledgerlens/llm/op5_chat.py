"""Chat formatting (operator 5): multi-party perspective rotation.

For every participant of a conversation (each role but ``system``) the dialogue is
rendered with that participant as the assistant, the others as users with their names,
and system messages as they are:

    <|im_start|>assistant\\nTEXT<|im_end|>\\n
    <|im_start|>user name=NAME\\nTEXT<|im_end|>\\n

``mask`` lists the character spans to learn from: each assistant text with its
``<|im_end|>``. All of it is DataFrame functions.

A conversation is rendered in parts: its turns by ``PART_TURNS`` numbers, and these by
``PART_ROWS`` messages. An ordinary conversation is one part; one that holds a third of
all rows is many groups of bounded size, and no text grows beyond a part. Parts keep
the order (part, then chunk) and nothing is cut.

Defined results: messages are ordered by turn (null last), role, text; rows that repeat
all of these are one message. A null role is the participant ``unknown``; a null text
is empty; rows with a null conv_id form one conversation. ``<|`` within a text or a name
becomes ``< |``, so a text can't forge a turn. A conversation with system messages only
has no participant and gives no rows, like an empty table. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.frames import table

PART_TURNS, PART_ROWS = 512, 512
SYSTEM, UNKNOWN = "system", "unknown"
START, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def messages(turns: DataFrame) -> DataFrame:
    """conv_id, part, chunk and the part's messages (role, content) in order."""
    rows = turns.select(
        "conv_id", "turn", _plain(F.coalesce("role", F.lit(UNKNOWN))).alias("role"),
        _plain(F.col("text")).alias("content")).distinct()
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / PART_TURNS),
                                              F.lit(1 << 62)))
    order = Window.partitionBy("conv_id", "part").orderBy(
        F.col("turn").asc_nulls_last(), "role", "content")
    rows = rows.withColumn("n", F.row_number().over(order) - 1).withColumn(
        "chunk", F.floor(F.col("n") / PART_ROWS))
    listed = F.array_sort(F.collect_list(F.struct("n", "role", "content")))
    return rows.groupBy("conv_id", "part", "chunk").agg(listed.alias("messages"))


def rotated(turns: DataFrame) -> DataFrame:
    """conv_id, participant, part, chunk, messages (role, name, content, train), text and
    mask (array of (start, end)) for each participant and part."""
    parts = messages(turns)
    people = (turns.select("conv_id", _plain(F.coalesce("role", F.lit(UNKNOWN))).alias("participant"))
              .where(F.col("participant") != SYSTEM).distinct()
              .withColumnRenamed("conv_id", "_conv"))
    both = parts.join(people, parts["conv_id"].eqNullSafe(people["_conv"])).drop("_conv")

    def seen(m: Column) -> Column:
        mine = m["role"] == F.col("participant")
        other = ~mine & (m["role"] != SYSTEM)
        return F.struct(
            F.when(mine, "assistant").when(other, "user").otherwise(SYSTEM).alias("role"),
            F.when(other, m["role"]).alias("name"), m["content"].alias("content"),
            mine.alias("train"))

    def head(m: Column) -> Column:
        name = F.when(m["name"].isNotNull(), F.concat(F.lit(" name="), m["name"])).otherwise("")
        return F.concat(F.lit(START), m["role"], name, F.lit("\n"))

    both = both.withColumn("messages", F.transform("messages", seen))
    both = both.withColumn("text", F.array_join(F.transform("messages", lambda m: F.concat(
        head(m), m["content"], F.lit(f"{END}\n"))), ""))
    zero = F.struct(F.lit(0).alias("at"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(head(m))
        end = start + F.length(m["content"]) + len(END)
        spans = F.when(m["train"], F.concat(acc["spans"], F.array(F.struct(
            start.alias("start"), end.alias("end"))))).otherwise(acc["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    mask = F.aggregate("messages", zero, step, lambda acc: acc["spans"])
    return both.select("conv_id", "participant", "part", "chunk", "messages", "text",
                       mask.alias("mask"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side: its size, the digest of its
    text, and its mask."""
    out = rotated(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return out.select("conv_id", "participant", "part", "chunk",
                      F.size("messages").alias("n_messages"), F.length("text").alias("n_chars"),
                      F.sha2("text", 256).alias("text_sha256"), F.array_join(spans, ",").alias("mask"))


OP5_SQL = f"""
WITH m AS (SELECT DISTINCT conv_id, turn, replace(coalesce(role, '{UNKNOWN}'), '<|', '< |') AS role,
                  replace(coalesce(text, ''), '<|', '< |') AS content FROM conversations),
n AS (SELECT *, coalesce(floor(turn / {PART_TURNS}.0)::BIGINT, {1 << 62}) AS part FROM m),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, part
                                   ORDER BY turn NULLS LAST, role, content) - 1 AS k FROM n),
p AS (SELECT DISTINCT conv_id AS c, role AS participant FROM m WHERE role <> '{SYSTEM}'),
r AS (SELECT o.conv_id, participant, part, k // {PART_ROWS} AS chunk, k, content,
             role = participant AS mine,
             '{START}' || CASE WHEN role = participant THEN 'assistant' WHEN role = '{SYSTEM}'
             THEN role ELSE 'user name=' || role END || chr(10) AS head
      FROM o JOIN p ON o.conv_id IS NOT DISTINCT FROM p.c),
s AS (SELECT *, head || content || '{END}' || chr(10) AS piece,
             coalesce(sum(length(head) + length(content) + {len(END) + 1}) OVER (
                 PARTITION BY conv_id, participant, part, chunk ORDER BY k
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS a
      FROM r)
SELECT conv_id, participant, part, chunk::BIGINT AS chunk, count(*)::INT AS n_messages,
       length(string_agg(piece, '' ORDER BY k))::INT AS n_chars,
       sha256(string_agg(piece, '' ORDER BY k)) AS text_sha256,
       coalesce(string_agg(a || '-' || (a + length(content) + {len(END)}), ',' ORDER BY k)
                FILTER (mine), '') AS mask
FROM s GROUP BY conv_id, participant, part, chunk
"""
