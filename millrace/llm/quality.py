"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Statistics of each text are standardised, mapped to ``n_random`` cosine features that
approximate a Gaussian kernel, and fitted by ridge regression from normal equations that
every partition sums on its own; a tree of tasks adds ``FAN_IN`` of these sums at a time, in order of partitions. Labelled rows are dealt by ``crc32(doc_id as text) % 5``:
0 is held out, 1 calibrates, the rest fit. Calibration pools scores into ``BINS`` bins by
adjacent violators, so its size does not grow. No sample is drawn; all labelled rows count.

Defined results: a null text counts as empty and is scored like any other; a null doc_id has
no label and is not held out. Of several labels for one document the mean decides (0.5: good).
Without usable labels every score is 0.5. Repeated rows score alike; empty tables give no rows.
Labels, lang, source and doc_id are no inputs of a score, and other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import materialize

FOLDS, BINS = 5, 1000
#: Matrices that one task adds up, and how often they are added up so before the driver takes the rest.
FAN_IN, LEVELS = 64, 3
_GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"|", b"!", b"?", b".", b",", b"#$%&*@^~<>{}[]\\/=+_", b"\"'():;-"]
_INDEX = [np.frombuffer(g, np.uint8) for g in _GROUPS]
N_STATS = len(_GROUPS) + 13


def statistics(text: str) -> list[float]:
    """Shape of a text: byte classes, entropy, lengths and repetition of words and lines."""
    raw = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / max(1, len(raw))
    p = count[count > 0]
    words = text.split()
    n = max(1, len(words))
    size = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        *(float(count[i].sum()) for i in _INDEX),
        float(count[128:].sum()),
        float(-(p * np.log2(p)).sum()) if len(p) else 0.0,
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        float(min(size.mean(), 50)),
        float(min(size.std(), 50)),
        float((size <= 3).mean()),
        float((size >= 12).mean()),
        len(seen) / n,
        max(seen.values(), default=0) / n,
        len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))),
        float(np.log1p(n / (1 + text.count(".")))),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([statistics(x.as_py() or "") for x in batch.column(1)], schema.field(1).type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def design(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        wave = np.cos(x @ self.weights + self.shift) * np.sqrt(2 / len(self.shift))
        return np.hstack([np.ones((len(x), 1)), x, wave])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.design(stats) @ self.beta, 0, 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        return np.clip(0.999 * np.interp(raw, self.knots, self.values) + 0.001 * raw, 0, 1)


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS


def _stack(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def pooled(x: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adjacent violators: rising means over sorted ``x``, as knots and values."""
    blocks: list[list[float]] = []
    for at, g, m in zip(x, good, n, strict=True):
        blocks.append([at * m, g, m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, n_random: int = 256, ridge: float = 1e-3, seed: int = 7) -> Model | None:
    """Fit on the labelled rows of folds 2 to 4 and calibrate on fold 1; None if there are none."""
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    rows = materialize(stats.where(F.col("doc_id").isNotNull()).join(known, "doc_id").withColumn("fold", fold()).where("fold > 0"), "labelled")
    train = rows.where("fold > 1")
    at = [F.col("stats")[i] for i in range(N_STATS)]
    sums = train.agg(F.count("*"), *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
    if not sums[0]:
        return None
    mean, scale = np.array(sums[1 : N_STATS + 1], float), np.array(sums[N_STATS + 1 :], float)
    draw = np.random.default_rng(seed)
    scale = np.where(scale > 1e-9, scale, 1.0)
    model = Model(mean, scale, draw.normal(size=(N_STATS, n_random)) / np.sqrt(N_STATS), draw.uniform(0, 2 * np.pi, n_random), np.zeros(0), np.zeros(0), np.zeros(0))
    width = 1 + N_STATS + n_random

    def part(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = model.design(_stack(batch.column(0)))
            total += z.T @ np.hstack([z, np.asarray(batch.column(1))[:, None]])
        yield pa.RecordBatch.from_pydict({"slot": [TaskContext.get().partitionId()], "total": [total.tobytes()]}, schema=schema)

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("slot")), kind="stable")
        total = np.zeros((width, width + 1))
        for k in order:
            total += np.frombuffer(table.column("total")[int(k)].as_py()).reshape(total.shape)
        return pa.table({"slot": pa.array([table.column("slot")[int(order[0])].as_py() // FAN_IN], pa.int64()), "total": [total.tobytes()]})

    schema = pa.schema([("slot", pa.int64()), ("total", pa.binary())])
    parts = train.select("stats", "y").mapInArrow(part, "slot long, total binary")
    for _ in range(LEVELS):
        parts = parts.groupBy(F.expr(f"slot div {FAN_IN}")).applyInArrow(add, "slot long, total binary")
    total = sum(np.frombuffer(r.total).reshape(width, width + 1) for r in sorted(parts.collect(), key=lambda r: r.slot))
    beta = np.linalg.solve(total[:, :-1] + ridge * sums[0] / width * np.eye(width), total[:, -1])
    model = Model(mean, scale, model.weights, model.shift, beta, np.zeros(0), np.zeros(0))

    def binned(batches):
        good, n = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            k = np.minimum((model.raw(_stack(batch.column(0))) * BINS).astype(int), BINS - 1)
            good += np.bincount(k, np.asarray(batch.column(1)), BINS)
            n += np.bincount(k, minlength=BINS)
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bin": k.astype(np.int32), "good": good[k], "n": n[k]})

    held = rows.where("fold = 1").select("stats", "y").mapInArrow(binned, "bin int, good double, n double").groupBy("bin").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).orderBy("bin").toPandas()
    if held.empty:
        knots, values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        knots, values = pooled((held["bin"].to_numpy() + 0.5) / BINS, held["good"].to_numpy(), held["n"].to_numpy())
    return Model(mean, scale, model.weights, model.shift, beta, knots, values)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose own text scores ``threshold`` or more, whatever their doc_id."""
    at, names = docs.columns.index("text"), docs.columns
    fields = T.StructType([*docs.schema.fields, T.StructField("__stats", T.ArrayType(T.DoubleType()))])

    def measure(batches):
        for batch in batches:
            stats = pa.array([statistics(x.as_py() or "") for x in batch.column(at)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, stats], [*names, "__stats"])

    frame = materialize(docs.mapInArrow(measure, fields), "measured", "zstd")
    model = fit(frame.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__stats").alias("stats")), labels)

    def keep(batches):
        for batch in batches:
            score = model.score(_stack(batch.column(batch.num_columns - 1))) if model and len(batch) else np.full(len(batch), 0.5)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names).filter(pa.array(score >= threshold))

    return frame.mapInArrow(keep, docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    stats = materialize(document_statistics(docs), "statistics")
    model = fit(stats, labels)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            score = model.score(_stack(batch.column(1))) if model and len(batch) else np.full(len(batch), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], schema=schema)

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
