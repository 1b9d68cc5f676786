"""Near-duplicate groups: universal-hash minima, bands, confirmed links, star components.

Texts with one shingle set are one node. Nodes meet in buckets of equal bands. In each
bucket the least node is first compared with all others, which joins most of a group at one
comparison a node. Buckets whose other nodes are still of different components are compared in
bounded blocks: each node proposes its most similar node of another component, then the full
sets of all likely pairs across components are compared inside the blocks. No pair of a bucket that could join two components is
skipped, and pairs within one component are never made. The blocks pair the nodes outside a bucket's largest component
with each other and with that component, so their rows grow with the square of the former only. A pair must pass the length bound and
the signature estimate before its full sets are compared; the margin of the estimate is near
five standard deviations.

A band misses a pair of similarity 0.8 with 0.59; all 32 with 5e-8.

A node's number is drawn when the nodes are written and says nothing; the least doc_id of
a component's texts is taken at the end. So results do not depend on partitions or on the order of rows.

Defined results: null or empty texts and texts of white space have no shingles and stay
alone; a null doc_id stays alone, with a null component, and is kept. Different texts under one doc_id
are linked each by its own set, and not by the doc_id; repeated rows are alike. Empty tables give no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize
from millrace.llm.components import components

_KNOWN = 300_000
BLOCK = 512
#: Pairs of one node that a task confirms before another one gets a copy of its text.
PAIRS = 1000


@dataclass(frozen=True)
class Params:
    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    margin: float = 0.17
    seed: int = 11

    @property
    def minima(self) -> int:
        return self.bands * self.rows


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


@cache
def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; A-Z are lowered, words end at ASCII white space."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(_words) > _KNOWN:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    size = min(words, len(h))
    times = _odd(words, 3)
    n = len(h) - size + 1
    x = np.full(n, size, np.uint64)
    for i in range(size):
        x += h[i : i + n] * times[i]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return np.unique(x)


def minima(found: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Least value of each of ``n`` multiply-add hashes over the set."""
    times = (_odd(n, seed) >> np.uint64(20)).astype(np.uint32) | np.uint32(1)
    plus = (_odd(n, seed + 1) >> np.uint64(20)).astype(np.uint32)
    x = (found >> np.uint64(32)).astype(np.uint32)
    low = np.full(n, 2**32 - 1, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(low, (x[at : at + 2048, None] * times + plus).min(axis=0), out=low)
    return low


def _read(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``tid``, which tells apart texts under one doc_id."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tid"))


def signatures(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, tid, n_shingles, digest of the set and its minima; no digest where there is nothing to link."""
    schema = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("minima", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part, rows = batch.slice(at, 1000), []
                for doc, text, tid in zip(part.column(0), part.column(1), part.column(2), strict=True):
                    doc, found = doc.as_py(), shingles(text.as_py(), p.words)
                    linked = doc is not None and len(found) > 0
                    rows.append((doc, tid.as_py(), len(found), xxhash.xxh3_128_digest(found.tobytes()) if linked else None, minima(found, p.minima, p.seed).tobytes() if linked else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return _read(docs).mapInArrow(run, "doc_id long, tid long, n_shingles long, digest binary, minima binary")


def banded(nodes: DataFrame, p: Params) -> DataFrame:
    """(bucket, id, size of its set): one row per node and band."""
    schema = pa.schema([("bucket", pa.int64()), ("id", pa.int64()), ("size", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                raw = [x.as_py() for x in part.column(2)]
                step = 4 * p.rows
                keys = [(xxhash.xxh3_64_intdigest(m[i * step : (i + 1) * step], i) >> 7) * 64 + i - (1 << 62) for m in raw for i in range(p.bands)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(np.repeat(np.asarray(part.column(c)), p.bands)) for c in (0, 1))], schema=schema)

    return nodes.select("id", "n_shingles", "minima").mapInArrow(run, "bucket long, id long, size long")


def likely(pairs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose lengths and minima allow the similarity asked for."""
    a = nodes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("minima").alias("ma"))
    b = nodes.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("minima").alias("mb"))
    least = p.percent / 100 - p.margin

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 4000):
                part = batch.slice(at, 4000)
                x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint32).reshape(len(part), -1) for c in (part.column(2), part.column(3)))
                yield part.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= least))

    fit = 100 * F.least("na", "nb") >= p.percent * F.greatest("na", "nb")
    return pairs.join(b, "b").join(a, "a").where(fit).select("a", "b", "ma", "mb").mapInArrow(run, "a long, b long")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components: ``main`` is the label of the largest one, which has ``most`` of the ``n`` rows."""
    count = rows.groupBy("bucket", "label").agg(F.count("*").alias("k"))
    count = count.groupBy("bucket").agg(F.sum("k").alias("n"), F.max(F.struct("k", "label")).alias("top"), F.count("*").alias("labels")).where("labels > 1")
    return rows.join(count.select("bucket", "n", F.col("top.k").alias("most"), F.col("top.label").alias("main")), "bucket")


def _blocks(rows: DataFrame) -> DataFrame:
    """The rows of each bucket, dealt for comparison in blocks: (bucket, low, high) names a block.

    Rows of the main component are in pieces -1, -2, ... and the others in 0, 1, ...; two pieces meet in a block
    unless both are of the main component, and each other piece meets itself where it meets piece -1."""
    main, mains, others = F.col("label") == F.col("main"), F.ceil(F.col("most") / BLOCK), F.ceil((F.col("n") - F.col("most")) / BLOCK)
    piece = lambda n: F.pmod(F.xxhash64("id"), n)
    cut = rows.withColumn("own", F.when(main, -1 - piece(mains)).otherwise(piece(others)))
    cut = cut.select("bucket", "id", "label", "size", "minima", "own", F.explode(F.sequence(F.when(main, F.lit(0).cast("long")).otherwise(-mains), others - 1)).alias("other")).where("own <> other")
    return cut.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "id", "label", "size", "minima")


def _across(t: pa.Table, p: Params) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Positions of likely partners in another component, and how alike, for each row of a block.

    A pair belongs to the first band that it shares and to no other."""
    ids, label, size, own = (np.asarray(t.column(c)) for c in ("id", "label", "size", "own"))
    m = np.frombuffer(b"".join(t.column("minima").to_pylist()), np.uint32).reshape(len(ids), -1)
    low, high, band = t.column("low")[0].as_py(), t.column("high")[0].as_py(), t.column("bucket")[0].as_py() % 64
    for x in np.flatnonzero(own == high):
        met = (own == low) | ((ids > ids[x]) & (own == high)) if low == -1 else own == low
        y = np.flatnonzero(met & (label != label[x]) & (100 * np.minimum(size, size[x]) >= p.percent * np.maximum(size, size[x])))
        if len(y):
            same = m[y] == m[x]
            alike = same.mean(axis=1)
            first = same.reshape(len(y), p.bands, p.rows).all(axis=2).argmax(axis=1)
            good = (alike >= p.percent / 100 - p.margin) & (first == band)
            if good.any():
                yield x, y[good], alike[good]


_CUT = "bucket long, low long, high long, own long, id long, label long, size long, minima binary"
_NAMES = [f.split()[0] for f in _CUT.split(", ")]


def likely_across(rows: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """The rows of blocks that have likely partners in another component, and the ``best``, the most similar one.

    Later links only join components, so rows left out here have none later."""

    def best(t: pa.Table) -> pa.Table:
        top, other = np.full(len(t), -1.0), np.full(len(t), -1)
        for x, y, alike in _across(t, p):
            if (s := alike.max()) > top[x]:
                top[x], other[x] = s, y[alike.argmax()]
            more = alike > top[y]
            top[y[more]], other[y[more]] = alike[more], x
        found = np.flatnonzero(other >= 0)
        return t.select(_NAMES).take(found).append_column("best", pa.array(np.asarray(t.column("id"))[other[found]], pa.int64()))

    return _blocks(rows.join(nodes.select("id", "minima"), "id")).groupBy("bucket", "low", "high").applyInArrow(best, f"{_CUT}, best long")


def linked_across(wanted: DataFrame, labels: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """(a, b): links that join all components of each block that links can join.

    ``wanted`` are the rows of likely_across. Those that still have likely partners get their texts; their full sets
    are compared in the block, the most alike first, and pairs that earlier links of the block have joined are left out."""

    def needed(t: pa.Table) -> pa.Table:
        some = np.zeros(len(t), bool)
        for x, y, _ in _across(t, p):
            some[x] = True
            some[y] = True
        return t.select(_NAMES).filter(pa.array(some))

    def links(t: pa.Table) -> pa.Table:
        ids, text = t.column("id").to_pylist(), t.column("text")
        pairs = sorted(((-s, int(x), int(j)) for x, y, alike in _across(t, p) for j, s in zip(y, alike, strict=True)))
        root = {v: v for v in t.column("label").to_pylist()}
        label = t.column("label").to_pylist()
        sets: dict[int, np.ndarray] = {}

        def find(v):
            while root[v] != v:
                root[v] = v = root[root[v]]
            return v

        out = []
        for _, x, j in pairs:
            one, two = find(label[x]), find(label[j])
            if one == two:
                continue
            for k in (x, j):
                if k not in sets:
                    sets[k] = shingles(text[k].as_py(), p.words)
            both = len(np.intersect1d(sets[x], sets[j], assume_unique=True))
            if 100 * both >= p.percent * (len(sets[x]) + len(sets[j]) - both):
                root[one] = two
                out.append((ids[x], ids[j]))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    keys = ("bucket", "low", "high")
    some = materialize(_labelled(wanted.drop("label", "best"), labels).groupBy(*keys).applyInArrow(needed, _CUT), "needed")
    return some.join(texts, "id").groupBy(*keys).applyInArrow(links, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the ``label`` of their node's component, its own id where it has no links."""
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")


def confirmed(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose full shingle sets, of the ``texts`` of these nodes, are similar enough.

    The pairs of a node that is in many are dealt to several tasks, each with its own copy of that node's text."""
    pairs = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).alias("parts")), "a")
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    needed = pairs.select("a", "part").distinct()
    a = needed.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        last, left = None, None
        for batch in batches:
            keep = []
            for i, j, ta, tb in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3), strict=True):
                if last != (i := i.as_py()):
                    last, left = i, shingles(ta.as_py(), p.words)
                right = shingles(tb.as_py(), p.words)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= p.percent * (len(left) + len(right) - both):
                    keep.append((i, j.as_py()))
            if keep:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*keep, strict=True)], ["a", "b"])

    return pairs.join(b, "b").join(a, ["a", "part"]).select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, component_id (least doc_id reachable by links) and kept, one row per row of ``docs``."""
    signed = materialize(signatures(docs, p), "signatures")
    first = F.min(F.struct("doc_id", "tid", "n_shingles", "minima")).alias("x")  # equal sets have equal minima
    nodes = signed.where("digest is not null").groupBy("digest").agg(first).select("digest", "x.*", F.monotonically_increasing_id().alias("id"))
    nodes = materialize(nodes, "nodes")
    member = materialize(banded(nodes, p), "bands")
    count = member.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("centre")).where("n > 1")
    member = materialize(member.join(count, "bucket").select("bucket", "id", "centre", "size"), "buckets")
    met = nodes.select("id", "doc_id", "tid").join(member.select("id").distinct(), "id", "left_semi")
    texts = materialize(_read(docs).join(met, ["doc_id", "tid"]).select("id", "text").dropDuplicates(["id"]), "texts")
    links, wanted = None, None
    labels = docs.sparkSession.range(0).select("id", F.col("id").alias("component"))
    member = member.where("id <> centre")
    for turn in ("centre", "best", "all"):
        if turn == "centre":
            found = materialize(likely(member.select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), nodes, p), "likely")
        elif turn == "best":
            wanted = materialize(likely_across(_mixed(_labelled(member.drop("centre"), labels)), nodes, p), "wanted")
            found = materialize(wanted.select(F.least("id", "best").alias("a"), F.greatest("id", "best").alias("b")).distinct(), "likely")
        if found.isEmpty():
            continue
        good = materialize(confirmed(found, texts, p) if turn != "all" else linked_across(wanted, labels, texts, p), "links")
        if not good.isEmpty():
            links = good if links is None else links.unionAll(good)
            labels = materialize(components(links), "labels")
    named = nodes.join(labels, "id", "left").select("digest", "doc_id", "component")
    least = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    group = named.join(least, "component", "left").select("digest", F.coalesce("least", "doc_id").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(group, "digest", "left")
    label = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", label.alias("component_id"), F.coalesce(label == F.col("doc_id"), F.lit(True)).alias("kept"))


def oracle(p: Params = Params()) -> str:  # noqa: B008
    """The same result by joining shingles, for small tables."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\\t-\\\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {p.words} - 1], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {p.words} + 1, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= {p.percent} * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, here) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.here)
SELECT doc_id, coalesce(max(n.n), 0) AS n_shingles, min(here) AS component_id, doc_id = min(here) AS kept FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""
