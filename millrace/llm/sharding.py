"""Extendible hashing: a directory by hash prefix, in which only oversized buckets split further.

A row's hash is 60 bits of md5 over its id and text. Byte sums per prefix are taken in steps
of ``STEP`` bits; a bucket is the shortest prefix whose rows fit the limit (or that is one row,
which cannot be split), and only rows of buckets still too large enter the next step. Rows
alike in all hashed bits (copies under one id, so of one size) are numbered and dealt by count. They are numbered within
their source partitions, after the counts of the partitions before, so no group is in one task
and the shards' contents do not depend on how the input is dealt over partitions.

For ``shards`` only sums move, never texts; the directory is a table, joined on the prefix.
``write_shards`` carries whole rows to their shards: each row of the input is in exactly one.

Defined results: null texts count 0 bytes, null ids hash as an empty id. A single row over the
limit is a shard of its own. An empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize

BITS, STEP = 60, 12
#: Bytes of text in a shard, at most; and the column that names shards in what is written.
LIMIT, SHARD = 128 << 20, "shard"


def _prefix(bits: int | Column) -> Column:
    return F.expr(f"shiftright(h, {BITS - bits})")


def _hashed(docs: DataFrame, *more: Column) -> DataFrame:
    """n_bytes, hash ``h`` and source partition ``src`` of every row, and the columns asked for; written, so ``src`` holds."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(*more, size, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("h"), F.spark_partition_id().alias("src"))
    return materialize(rows, "sizes")


def _placed(rows: DataFrame, carried: list[str], limit: int) -> DataFrame:
    """The carried columns of every row, with n_bytes, shard_id, depth, shard_bytes and shard_rows."""
    done, above = None, None
    held = [*carried, "n_bytes"]
    for base in range(0, BITS, STEP):
        deep = base + STEP
        sums = rows.groupBy(_prefix(deep).alias("p")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("r"))
        nodes = sums.select("p", "b", "r", F.explode(F.sequence(F.lit(base), F.lit(deep))).alias("depth"))
        nodes = nodes.withColumn("q", F.expr(f"shiftright(p, {deep} - depth)"))
        total = materialize(nodes.groupBy("depth", "q").agg(F.sum("b").alias("shard_bytes"), F.sum("r").alias("shard_rows")), "nodes")
        fits = total.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
        leaf = nodes.select("p", "depth", "q").join(fits, ["depth", "q"])
        leaf = materialize(leaf.groupBy("p").agg(F.min(F.struct("depth", "q", "shard_bytes", "shard_rows")).alias("s")), "directory")
        placed = rows.withColumn("p", _prefix(deep)).join(leaf, "p").select(*held, "s.*", F.lit("").alias("part"))
        done = placed if done is None else done.unionAll(placed)
        rows = rows.join(leaf.select(F.col("p").alias("q")), _prefix(deep) == F.col("q"), "left_anti")
        if (above := total.where(F.col("depth") == deep).agg(F.max(F.when((F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1), 1))).first()[0]) is None:
            break
    if above:
        per = rows.groupBy("h", "src").agg(F.count("*").alias("c"))
        before = Window.partitionBy("h").orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
        per = per.select("h", "src", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("ahead"))
        place = F.col("ahead") + F.row_number().over(Window.partitionBy("h", "src").orderBy("n_bytes")) - 1
        room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
        alike = rows.join(per, ["h", "src"]).withColumn("part", F.concat(F.lit("-"), F.floor(place / room).cast("string")))
        alike = alike.select(*held, "h", "part")
        sums = alike.groupBy("h", "part").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
        done = done.unionAll(alike.join(sums, ["h", "part"]).select(*held, F.lit(BITS).alias("depth"), F.col("h").alias("q"), "shard_bytes", "shard_rows", "part"))
    bits = F.expr(f"if(depth = 0, '', right(lpad(bin(q), {BITS}, '0'), depth))")
    return done.select(*held, F.concat(bits, "part").alias("shard_id"), F.col("depth").cast("long").alias("depth"), "shard_bytes", "shard_rows")


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard_id (its bits as text), depth, shard_bytes and shard_rows of every row."""
    return _placed(_hashed(docs, F.col("doc_id")), ["doc_id"], limit)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Write ``docs`` as Parquet, one folder ``shard=s-<bits>`` per shard; every row is written once."""
    placed = _placed(_hashed(docs, F.struct(*docs.columns).alias("row")), ["row"], limit)
    placed.select("row.*", F.concat(F.lit("s-"), "shard_id").alias(SHARD)).repartition(SHARD).write.partitionBy(SHARD).parquet(path)


def oracle(limit: int, deepest: int = 24) -> str:
    return f"""
WITH r AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
n AS (SELECT d.depth, h >> ({BITS} - d.depth) AS q, sum(n_bytes) AS b, count(*) AS c FROM r, range({deepest + 1}) AS d(depth) GROUP BY ALL),
leaf AS (SELECT r.doc_id, r.n_bytes, n.depth, n.q, n.b, n.c, row_number() OVER (PARTITION BY r.doc_id ORDER BY n.depth) AS k
  FROM r JOIN n ON n.q = r.h >> ({BITS} - n.depth) WHERE n.b <= {limit} OR n.c = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(q), {BITS}, '0'), CAST(depth AS INTEGER)) END AS shard_id, CAST(depth AS BIGINT) AS depth,
  CAST(b AS BIGINT) AS shard_bytes, CAST(c AS BIGINT) AS shard_rows FROM leaf WHERE k = 1"""
