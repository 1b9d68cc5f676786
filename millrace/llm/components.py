"""Connected components: few links in one task, more by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, materialize

#: Links (16 bytes each) that one task joins; more are joined by star steps, which shuffle them several times.
LINKS = 1_000_000


def join(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids in the links (u, v) and the least id of the component of each."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    return ids, ids[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[np.asarray(c) for c in batch.columns] for batch in batches]
        if parts:
            found = join(*map(np.concatenate, zip(*parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["id", "component"])

    return edges.coalesce(1).mapInArrow(run, "id long, component long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = both.where("v > u") if large else both.where("v < u")
    out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionAll(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a long, b long); the component is its least id.

    Self-links, repeated links and links with a null end are ignored; no links give no rows."""
    found = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    if found.count() <= LINKS:
        return _in_one_task(found)
    edges = materialize(found.distinct(), "edges")
    discard(found)
    mark = _mark(edges)
    while mark[0]:
        bigger = materialize(_star(edges, large=True), "edges")
        new = materialize(_star(bigger, large=False), "edges")
        discard(bigger)
        now = _mark(new)
        discard(edges)
        edges = new
        if now == mark:
            break
        mark = now
    lows = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(lows)
