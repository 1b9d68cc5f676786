"""Removal of repeated strings by difference-cover samples of all suffixes.

Positions whose remainder modulo ``V`` lies in a difference cover are sampled: any two suffixes
have a shift below ``V`` at which both are sampled. Documents are laid out in blocks in order of
doc_id. The tuples at the samples, as long as every common string of ``LENGTH`` bytes must share
(``LENGTH - V + 1``), are sorted by fingerprint across blocks; those that occur twice get the name
"repeated". Remaining suffixes are merged only where one of their samples has that name: their
prefixes of ``LENGTH`` bytes are sorted by a 64-bit fingerprint next to each other, and all but the earliest
of equal neighbours are repeats. As order beyond ``LENGTH`` bytes is not asked for, names of names
are not needed, and the recursion ends at its first level.

Blocks send each fingerprint once, sorted, and get one bit back for it, so a string with any number of
copies costs a reducer one value a block. Whole-text copies are settled before by their hash.

Defined results: null and short texts lose nothing; null doc_ids come first and count as one id. Repeated
rows of a document are one row. Texts that differ under one doc_id are told apart by their hash, in that order.
Empty tables give no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import gc
import time
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize

LENGTH = 100
# A perfect difference set modulo 73.
V, COVER = 73, (0, 1, 3, 7, 15, 31, 36, 54, 63)
TUPLE = LENGTH - V + 1
BLOCK_BYTES = 2 << 20
REDUCER_VALUES = 1 << 20
# Documents are ordered by range first; the driver samples for at most so many ranges.
RANGE_BYTES, MOST_RANGES = 32 << 20, 2000


@cache
def _table() -> tuple[np.ndarray, int, int]:
    draw = np.random.default_rng(5)
    base = int(draw.integers(1 << 62)) * 2 + 1
    return draw.integers(0, 2**63, 256, np.uint64) * np.uint64(2) + draw.integers(0, 2, 256, np.uint64), base, pow(base, -1, 1 << 64)


_powers: list[np.ndarray] = []


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, n.bit_length())
        _, base, back = _table()
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]), dtype=np.uint64) for x in (base, back)]
    return _powers[0], _powers[1]


class Block:
    """Documents in order, their bytes end to end, and fingerprints of strings in them."""

    def __init__(self, texts: list[bytes]):
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.array([len(x) for x in texts], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]) if texts else np.zeros(0, np.int64)
        self.at = (np.arange(len(self.bytes), dtype=np.int64) - np.repeat(self.start, self.size)).astype(np.int32)
        self.left = np.repeat(self.size, self.size).astype(np.int32) - self.at
        values = _table()[0][self.bytes]
        values *= _up_to(len(self.bytes) + 1)[0][: len(values)]
        self._sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])

    def prints(self, where: np.ndarray, n: int) -> np.ndarray:
        x = (self._sum[where + n] - self._sum[where]) * _up_to(len(self.bytes) + 1)[1][where]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return x

    def samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions, the sorted different fingerprints, which each position has, and counts."""
        cover = np.zeros(V, bool)
        cover[list(COVER)] = True
        where = np.flatnonzero(cover[self.at % V] & (self.left >= TUPLE))
        return where, *np.unique(self.prints(where, TUPLE), return_inverse=True, return_counts=True)

    def open(self, named: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions whose prefix may be repeated, their sorted fingerprints, first place and index of each."""
        where, _, which, count = self.samples()
        flag = np.zeros(len(self.bytes) + V + 1, np.int32)
        flag[where[(count > 1)[which] | named[which]] + 1] = 1
        np.cumsum(flag, out=flag)
        n = len(self.bytes)
        near = np.flatnonzero((flag[V : n + V] > flag[:n]) & (self.left >= LENGTH))
        prints, first, which = np.unique(self.prints(near, LENGTH), return_index=True, return_inverse=True)
        return near, prints, first, which

    def covered(self, named: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Which bytes lie in a string that also starts earlier. ``seen``: which fingerprints an earlier block has."""
        near, _, first, which = self.open(named)
        again = seen[which] | (first[which] != np.arange(len(near)))
        step = np.zeros(len(self.bytes) + 1, np.int32)
        np.add.at(step, near[again], 1)
        np.add.at(step, near[again] + LENGTH, -1)
        return np.cumsum(step[:-1]) > 0


def _bounds(prints: np.ndarray, parts: int) -> np.ndarray:
    edges = (np.arange(1, parts, dtype=np.float64) / parts * 2.0**64).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(prints, edges), [len(prints)]]).astype(int)


def _packed(x: np.ndarray) -> bytes:
    """Rising 64-bit values as their steps, in six bytes each; larger steps are listed behind."""
    step = np.diff(x, prepend=np.uint64(0))
    big = np.flatnonzero(step >> np.uint64(48)).astype("<u4")
    low = step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return b"".join((np.array([len(x)], "<u4").tobytes(), low.tobytes(), big.tobytes(), (step[big] >> np.uint64(48)).astype("<u2").tobytes()))


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    step = np.zeros((n, 8), np.uint8)
    step[:, :6] = np.frombuffer(data, np.uint8, 6 * n, 4).reshape(n, 6)
    step = step.reshape(-1).view("<u8").astype(np.uint64)
    m = (len(data) - 4 - 6 * n) // 6
    big = np.frombuffer(data, "<u4", m, 4 + 6 * n)
    step[big] |= np.frombuffer(data, "<u2", m, 4 + 6 * n + 4 * m).astype(np.uint64) << np.uint64(48)
    return np.cumsum(step, dtype=np.uint64)


def _dealt(block: int, prints: np.ndarray, parts: int, kind: type) -> pa.Table:
    edge = _bounds(prints, parts)
    pack = _packed if kind is np.uint64 else lambda x: x.astype(kind).tobytes()
    some = [r for r in range(parts) if edge[r] < edge[r + 1]]
    return pa.table({"block": pa.array([block] * len(some), pa.int64()), "part": pa.array(some, pa.int32()), "data": pa.array([pack(prints[edge[r] : edge[r + 1]]) for r in some], pa.binary())})


def _answers(table: pa.Table, size: int) -> np.ndarray:
    """The bits that the reducers sent back, in the order of the block's sorted fingerprints."""
    rows = sorted(zip(table.column("part").to_pylist(), table.column("n").to_pylist(), table.column("data").to_pylist(), strict=True))
    bits = [np.unpackbits(np.frombuffer(d, np.uint8), count=n).astype(bool) for _, n, d in rows]
    out = np.concatenate(bits) if bits else np.zeros(0, bool)
    if len(out) != size:
        raise ValueError("a block changed between two passes")
    return out


def _reply(table: pa.Table, bits: list[np.ndarray]) -> pa.Table:
    return pa.table({"block": table.column("block"), "part": table.column("part"), "n": pa.array([len(b) for b in bits], pa.int32()), "data": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())})


_SENT, _REPLY = "block long, part int, data binary", "block long, part int, n int, data binary"


def _twice(table: pa.Table) -> pa.Table:
    """Which tuple fingerprints come from two blocks."""
    sent = [np.frombuffer(x, np.uint32) for x in table.column("data").to_pylist()]
    _, which, count = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    return _reply(table, np.split((count > 1)[which], np.cumsum([len(x) for x in sent])[:-1]))


def _earlier(table: pa.Table) -> pa.Table:
    """Which prefix fingerprints an earlier block has too."""
    order = np.argsort(np.asarray(table.column("block")), kind="stable")
    table = table.take(pa.array(order))
    sent = [_unpacked(x) for x in table.column("data").to_pylist()]
    _, first, which = np.unique(np.concatenate(sent), return_index=True, return_inverse=True)
    return _reply(table, np.split(first[which] != np.arange(len(which)), np.cumsum([len(x) for x in sent])[:-1]))


def _release(spark) -> None:
    """Let Spark delete the shuffle files of finished passes: it does so once their plans are garbage."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def _laid(table: pa.Table) -> tuple[list, Block]:
    rows = sorted(zip(table.column("ord").to_pylist(), table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True), key=lambda r: r[0])
    rows = [r for k, r in enumerate(rows) if not k or rows[k - 1][0] != r[0]]  # repeated rows of a document
    return [r[1] for r in rows], Block([r[2] for r in rows])


def repeated_strings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept`` (the bytes left) of every document."""
    spark = docs.sparkSession
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8").alias("text"))
    raw = raw.withColumn("n", F.octet_length("text").cast("long")).withColumn("sha", F.sha2("text", 256))
    ids = materialize(raw.select("doc_id", "n", "sha").distinct(), "ids")
    first = ids.where(F.col("n") >= LENGTH).groupBy("sha").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id")).alias("x")).select(F.col("sha").alias("s"), F.col("x.doc_id").alias("d"))
    same = (F.col("sha") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d"))
    copies = ids.where(F.col("n") >= LENGTH).join(first, same, "left_anti")
    total, = ids.join(first, same, "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0))).first()
    ranges = min(MOST_RANGES, max(1, total // RANGE_BYTES))
    kept = ids.join(first, same, "left_semi").select("doc_id", "sha", "n").repartitionByRange(ranges, "doc_id", "sha").sortWithinPartitions("doc_id", "sha")

    def numbered(batches):
        part, before, k = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            done = before + np.cumsum(np.asarray(batch.column(2)))
            block = (part << 32) + (done - 1) // BLOCK_BYTES
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(block), pa.array((part << 40) + k + np.arange(len(batch)))], ["d", "s", "block", "ord"])
            before, k = (int(done[-1]) if len(batch) else before), k + len(batch)

    place = kept.mapInArrow(numbered, "d long, s string, block long, ord long")
    here = (F.col("sha") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d"))
    laid = raw.where(F.col("n") >= LENGTH).join(materialize(place, "places"), here).select("block", "ord", "doc_id", "text")
    base = materialize(laid, "blocks", "zstd")
    _release(spark)
    parts = max(1, round(total * len(COVER) / V / REDUCER_VALUES))

    def tuples(table: pa.Table) -> pa.Table:
        _, block = _laid(table)
        return _dealt(table.column("block")[0].as_py(), block.samples()[1], parts, np.uint32)

    named = materialize(base.groupBy("block").applyInArrow(tuples, _SENT).groupBy("part").applyInArrow(_twice, _REPLY), "named")
    _release(spark)

    def prefixes(table: pa.Table, names: pa.Table) -> pa.Table:
        if not len(table):
            return _dealt(0, np.zeros(0, np.uint64), 1, np.uint64)
        _, block = _laid(table)
        return _dealt(table.column("block")[0].as_py(), block.open(_answers(names, len(block.samples()[1])))[1], parts, np.uint64)

    sent = base.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(prefixes, _SENT)
    seen = materialize(sent.groupBy("part").applyInArrow(_earlier, _REPLY), "seen")
    _release(spark)
    both = named.withColumn("level", F.lit(0)).unionAll(seen.withColumn("level", F.lit(1)))

    def removed(table: pa.Table, told: pa.Table) -> pa.Table:
        ids, block = _laid(table) if len(table) else ([], Block([]))
        level = np.asarray(told.column("level"))
        names = _answers(told.filter(pa.array(level == 0)), len(block.samples()[1]))
        gone = block.covered(names, _answers(told.filter(pa.array(level == 1)), len(block.open(names)[1])))
        rows = []
        for doc, at, n in zip(ids, block.start, block.size, strict=True):
            mine = gone[at : at + n]
            spans = int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum())
            rows.append((doc, int(n), int(mine.sum()), spans, block.bytes[at : at + n][~mine].tobytes()))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.table({k: pa.array(c, t) for k, c, t in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept"), cols, (pa.int64(),) * 4 + (pa.binary(),), strict=True)})

    done = base.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    zero = F.lit(0).cast("long")
    short = raw.where(F.col("n") < LENGTH).select("doc_id", F.col("n").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").alias("kept")).distinct()
    whole = copies.select("doc_id", F.col("n").alias("n_bytes"), F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))
    return done.unionAll(short).unionAll(whole)


def digest_kept(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def oracle(n: int = LENGTH) -> str:
    """The same result from all windows, for small tables."""
    return f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, i, b[i : i + {n} - 1] AS x FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - {n} + 2)) AS i FROM d)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS k FROM w),
g AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {n}, true) AS fresh FROM f WHERE k > 1),
h AS (SELECT doc_id, i, sum(fresh::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
r AS (SELECT doc_id, min(i) AS s, max(i) + {n} - 1 AS e FROM h GROUP BY doc_id, run),
t AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS prior FROM r UNION ALL SELECT doc_id, octet_length(b) + 1, NULL, (SELECT coalesce(max(e), 0) FROM r WHERE r.doc_id = d.doc_id) FROM d),
c AS (SELECT t.doc_id, list_reduce(list(b[prior + 1 : s - 1] ORDER BY s), lambda x, y: x || y) AS kept, count(e) AS n_spans FROM t JOIN d USING (doc_id) GROUP BY t.doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(octet_length(b) - octet_length(kept) AS BIGINT) AS n_removed, n_spans, sha256(kept) AS kept_sha256 FROM c JOIN d USING (doc_id)"""
