"""Cumulative-snapshot collapse of logged conversations, then rendering; DataFrame operations only.

A logger that writes a conversation anew after each turn leaves many prefixes of the same
talk. The hash of a prefix is the exclusive-or of hashes of (turn, role, text), which rolls
along the turns and can be summed in any order. A conversation whose whole hash is a proper
prefix of another one, or equals that of one with a smaller id, is dropped by an anti-join.

Prefix hashes are taken in chunks of ``CHUNK`` turns and rendering is by the same chunks
(``part``), so a conversation with any share of the rows is spread over many tasks.

Defined results: turns are compared with their numbers. Repeated rows of a turn count and
render once; different texts of one turn render by role and text. A null turn comes first;
null roles render as ``unknown`` and null texts as nothing. Rows without a conv_id belong to no
conversation and give nothing. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize

CHUNK = 1024


def _rows(conversations: DataFrame) -> DataFrame:
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1))
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), "role", "text")


def prefixed(conversations: DataFrame) -> DataFrame:
    """conv_id of every conversation that another one makes superfluous."""
    told = [F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    hashed = _rows(conversations).select("conv_id", "turn", F.xxhash64(*told).alias("a"), F.xxhash64(F.lit("second"), *told).alias("b")).distinct()
    xor = [F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("n").alias("n")]
    turns = materialize(hashed.withColumn("n", F.lit(1)).groupBy("conv_id", "turn").agg(*xor).withColumn("chunk", F.floor(F.col("turn") / CHUNK)), "turns")
    within = Window.partitionBy("conv_id", "chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = turns.groupBy("conv_id", "chunk").agg(*xor)
    chunks = chunks.select("conv_id", "chunk", *[F.coalesce(f(c).over(before), F.lit(0)).alias(f"{c}0") for c, f in (("a", F.bit_xor), ("b", F.bit_xor), ("n", F.sum))])
    whole = turns.groupBy("conv_id").agg(F.max("turn").alias("last"), *xor)
    rolled = turns.select("conv_id", "chunk", "turn", *[f(c).over(within).alias(c) for c, f in (("a", F.bit_xor), ("b", F.bit_xor), ("n", F.sum))]).join(chunks, ["conv_id", "chunk"])
    rolled = rolled.select("conv_id", "turn", *[F.col(c).bitwiseXOR(F.col(f"{c}0")).alias(c) for c in "ab"], (F.col("n") + F.col("n0")).alias("n"))
    ends = rolled.join(whole.select("conv_id", "last"), "conv_id").withColumn("full", F.col("turn") == F.col("last"))
    seen = ends.groupBy("turn", "n", "a", "b").agg(F.bool_or(~F.col("full")).alias("longer"), F.min(F.when(F.col("full"), F.col("conv_id"))).alias("first"))
    return whole.withColumnRenamed("last", "turn").join(seen, ["turn", "n", "a", "b"]).where(F.col("longer") | (F.col("first") < F.col("conv_id"))).select("conv_id")


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, part, n_turns and rendered text of the maximal conversations."""
    rows = _rows(conversations).join(prefixed(conversations), "conv_id", "left_anti")
    rows = rows.select("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk"), "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    talk = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    shown = F.array_join(F.transform("t", lambda x: F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("<|end|>\n"))), "")
    return talk.select("conv_id", F.col("chunk").cast("long").alias("part"), F.size("t").cast("long").alias("n_turns"), shown.alias("rendered"))


ORACLE = f"""
WITH r AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'t': turn, 'r': role, 'x': text}} ORDER BY turn, role, text) AS l, max(turn) AS last FROM r GROUP BY conv_id),
gone AS (SELECT DISTINCT p.conv_id FROM c p JOIN c q ON p.conv_id <> q.conv_id AND len(p.l) <= len(q.l) AND p.l[1] = q.l[1]
  AND list_filter(q.l, lambda x: x.t <= p.last) = p.l AND (len(p.l) < len(q.l) OR q.conv_id < p.conv_id))
SELECT conv_id, CAST(floor(turn / {CHUNK}.0) AS BIGINT) AS part, count(*) AS n_turns,
  string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
FROM r WHERE conv_id NOT IN (SELECT conv_id FROM gone) GROUP BY ALL"""
