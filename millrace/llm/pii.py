"""Personal data: pattern spans, and terms that corpus co-occurrence shows to reveal them.

Base kinds are found by pattern. A term (a run of three or more letters, lower-cased) that
shares a text with a protected entity is weighed over the whole corpus: with ``n_te`` different
texts that hold both, ``n_t`` that hold the term, ``n_e`` that hold the
entity and ``n`` in all, its confidence is ``n_te / n_t`` and it tells
``log2(n_te * n / (n_t * n_e))`` of the ``log2(n / n_e)`` bits that there are to tell about
the entity. Copies of one text count once. Terms with enough support (``n_te``), confidence and
share of the bits are marked everywhere (one text alone cannot tell a term of the entity from any other rare
word in it, so the least support is 2): generalised from ``min_share``, removed from
``remove_share``, where nothing is left to tell. An entity that many texts hold meets many terms by chance, so
the evidence (``n_t`` times the divergence of confidence from ``n_e / n``, in bits) must reach
``min_evidence``: 15 bits is the least that 3 texts, 6 bits and a confidence of a half come to. An
entity in all texts has nothing to tell. The column ``bits`` is over rows, copies included.

Term sets reach the executors in blocks of near ``BLOCK_TERMS``: one block is collected and broadcast at a time, and each
further one is one more pass over a table that holds the spans found so far. All spans are those of the original
text, and text is replaced once. Defined results: a null text counts as empty and
gives no spans (``sanitize`` keeps it null); null doc_ids are kept, and count as one document;
repeated rows are each annotated; empty tables give no rows. Other columns pass ``sanitize``
unchanged and are not read by ``annotate``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import materialize

KINDS = ("email", "ip", "card", "phone", "term")
BLOCK_TERMS = 200_000
#: Shares of the texts, as divisors, in which terms are counted before all texts are: too common a term shows
#: in few of them already (what a part of the texts holds, all texts hold), and need not be counted to the end.
PARTS = (32, 8, 1)
#: Size of the bitmaps of hashes, and of the tables of counts that a task holds.
SLOTS, HELD = 1 << 22, 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


@dataclass(frozen=True)
class Thresholds:
    min_support: int = 2
    min_confidence: float = 0.5
    min_share: float = 0.5
    remove_share: float = 1.0
    min_evidence: float = 15.0


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        at = text.find("@", found.end() if found else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start and kind."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _hash(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def _entity(text: str, span: tuple[int, int, int]) -> int:
    return _hash(f"{KINDS[span[1]]}:{text[span[0] : span[2]].lower()}")


def entity_terms(text: str, wanted: frozenset[int], alone: bool) -> set[tuple[int | None, str]]:
    """(entity, term) of the wanted entities, (None, term) too if ``alone``; text inside spans gives no terms."""
    spans = base_spans(text)
    near = {e for s in spans if (e := _entity(text, s)) in wanted}
    if not near:
        return set()
    hidden = list(text)
    for s, _, e in spans:
        hidden[s:e] = " " * (e - s)
    terms = set(map(str.lower, _TERM.findall("".join(hidden))))
    return {(e, t) for e in [*near, *[None] * alone] for t in terms}


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _frame(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _blocks(terms: DataFrame, key: str = "term") -> Iterator[list]:
    """The rows in blocks; terms are dealt by hash, so each block is near BLOCK_TERMS at most."""
    n = -(-terms.count() // BLOCK_TERMS)
    for k in range(n):
        yield terms.where(F.pmod(F.xxhash64(key), F.lit(n)) == k).collect()


def _bitmap(hashes: DataFrame) -> bytes:
    """A bit for each slot that one of the hashes falls into."""
    bits = np.zeros(SLOTS, dtype=bool)
    bits[[r[0] for r in hashes.select(F.pmod(F.col("copy"), F.lit(SLOTS))).distinct().collect()]] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _marked(bitmap: bytes, copy: int) -> int:
    return bitmap[copy % SLOTS >> 3] >> (copy % 8) & 1


def _tally(docs: DataFrame, repeated: bytes, find: Callable[[str, int], Iterable[tuple]], keys: str, most: Callable[[tuple], float] | None = None) -> DataFrame:
    """The keys with ``copy``, ``texts`` and ``rows``: how many different texts and rows ``find`` sees each key in.

    Counts are summed in each task; a text that may have copies (its slot is in ``repeated``) keeps its hash
    in ``copy``, so that the same text of other tasks is not counted again. A key that one task meets in more
    different texts than ``most`` is only known to be above it.
    """
    fields = T._parse_datatype_string(f"{keys}, copy long, rows long")
    schema = pa.schema([(f.name, pa.string() if f.dataType.simpleString() == "string" else pa.int64()) for f in fields])
    sent = docs.sparkSession.sparkContext.broadcast(repeated)

    def run(batches):
        single: Counter = Counter()
        copies: dict[int, list] = {}
        for batch in batches:
            for text, copy in zip(batch.column(0), batch.column(1), strict=True):
                copy = copy.as_py()
                if not _marked(sent.value, copy):
                    single.update(find(text.as_py(), copy))
                elif copy in copies:
                    copies[copy][1] += 1
                else:
                    copies[copy] = [find(text.as_py(), copy), 1]
                if len(single) > HELD:
                    yield _frame([(*k, None, v) for k, v in single.items()], schema)
                    single.clear()
        over = set()
        if most:
            met = single + Counter(k for found, _ in copies.values() for k in found)
            over = {k for k, v in met.items() if v > most(k)}
            single.update({k: met[k] - single[k] for k in over})
        if single:
            yield _frame([(*k, None, v) for k, v in single.items()], schema)
        for copy, (found, n) in copies.items():
            if rows := [(*k, copy, n) for k in found if k not in over]:
                yield _frame(rows, schema)

    hashed = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("copy", F.xxhash64("text"))
    found = hashed.mapInArrow(run, fields).groupBy(*fields.names[:-1]).agg(F.sum("rows").alias("rows"))
    return found.withColumn("texts", F.when(F.col("copy").isNull(), F.col("rows")).otherwise(F.lit(1)))


def _summed(tally: DataFrame, key: list[str], name: str) -> DataFrame:
    return tally.groupBy(*key).agg(F.sum("texts").alias(name), F.sum("rows").alias(f"{name}_rows"))


def _texts_with(docs: DataFrame, repeated: bytes, terms: DataFrame, part: int) -> DataFrame | None:
    """(term, n_t, n_t_rows): how many different texts, and rows, hold each term, among one ``part``-th of all texts.

    Terms found in more than ``most`` of them may be counted less, but above it; None if there are no terms."""
    some = docs.where(F.pmod(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(part)) == 0) if part > 1 else docs
    out = None
    for block in _blocks(terms):
        wanted = docs.sparkSession.sparkContext.broadcast({r.term: r.most for r in block})
        found = _tally(some, repeated, lambda text, _, wanted=wanted: [(t,) for t in wanted.value.keys() & set(map(str.lower, _TERM.findall(text)))], "term string", lambda k, wanted=wanted: wanted.value[k[0]])
        out = found if out is None else out.unionAll(found)
    return None if out is None else _summed(out, ["term"], "n_t")


def revealing_terms(docs: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:  # noqa: B008
    """(term, bits, confidence, share) of the terms that disclose an entity."""
    none = docs.sparkSession.range(0).selectExpr("cast(id AS string) AS term", *[f"cast(id AS double) AS {c}" for c in ("bits", "confidence", "share")])
    context = docs.sparkSession.sparkContext
    copies = materialize(_texts(docs).groupBy(F.xxhash64("text").alias("copy")).count(), "copies")
    n, rows = copies.agg(F.count("*"), F.sum("count")).first()
    repeated = _bitmap(copies.where("count > 1"))
    # Here every text is marked, as the texts of the entities are wanted too.
    held = materialize(_tally(docs, b"\xff" * (SLOTS // 8), lambda text, _: {(_entity(text, s),) for s in base_spans(text)}, "entity long"), "held")
    entities = materialize(_summed(held, ["entity"], "n_e").where((F.col("n_e") >= limits.min_support) & (F.col("n_e") < n)), "entities")
    pairs = None
    for k, block in enumerate(_blocks(entities.select("entity"), "entity")):
        wanted = context.broadcast(frozenset(r.entity for r in block))
        holding = context.broadcast(_bitmap(held.join(entities, "entity", "left_semi")))
        part = _tally(docs, repeated, lambda text, copy, wanted=wanted, holding=holding, alone=k == 0: entity_terms(text, wanted.value, alone) if _marked(holding.value, copy) else (), "entity long, term string")
        pairs = part if pairs is None else pairs.unionAll(part)
    if pairs is None:
        return none
    pairs = materialize(_summed(pairs, ["entity", "term"], "n_te").where(F.col("n_te") >= limits.min_support), "pairs")
    # Above n_te / min_confidence texts a term is not sure enough of any entity; those with entities tell so first.
    best, seen = (F.max(F.when(F.col("entity").isNull() == x, F.col("n_te"))) for x in (False, True))
    terms = pairs.groupBy("term").agg(best.alias("n_te"), F.coalesce(seen, F.lit(0)).alias("seen"))
    terms = materialize(terms.where(F.col("n_te") >= limits.min_confidence * F.col("seen")).select("term", (F.col("n_te") / limits.min_confidence).alias("most")), "terms")
    for part in PARTS:
        n_t = _texts_with(docs, repeated, terms, part)
        if n_t is None:
            return none
        if part > 1:
            terms = materialize(terms.join(n_t, "term", "left").where(F.col("n_t").isNull() | (F.col("n_t") <= F.col("most"))).select("term", "most"), "terms")
    weighed = pairs.join(n_t, "term").join(entities, "entity")
    sure, base = F.col("n_te") / F.col("n_t"), F.col("n_e") / F.lit(float(n))
    beside = F.when(sure < 1, (F.col("n_t") - F.col("n_te")) * F.log2((1 - sure) / (1 - base))).otherwise(0.0)
    weighed = weighed.select(
        "term",
        F.log2(F.col("n_te_rows") * F.lit(float(rows)) / (F.col("n_t_rows") * F.col("n_e_rows"))).alias("bits"),
        sure.alias("confidence"),
        (1 - F.log2(sure) / F.log2(base)).alias("share"),
        (F.col("n_te") * F.log2(sure / base) + beside).alias("evidence"),
    )
    told = weighed.where((F.col("confidence") >= limits.min_confidence) & (F.col("share") >= limits.min_share) & (F.col("evidence") >= limits.min_evidence))
    return materialize(told.groupBy("term").agg(*[F.max(c).alias(c) for c in ("bits", "confidence", "share")]), "revealing")


def term_spans(text: str, terms) -> list[tuple[int, int, int]]:
    return [(m.start(), 4, m.end()) for m in _TERM.finditer(text) if m[0].lower() in terms]


_SPAN = "array<struct<kind:string,start:long,end:long,gone:boolean>>"
_FOUND = "__spans"


def _located(docs: DataFrame, limits: Thresholds, finish: Callable[[str, list[dict]], str] | None = None) -> DataFrame:
    """``docs`` with the spans of each text in a column of their own; ``gone`` marks terms to be removed.

    The first pass finds the base spans too. Only the last pass is not written: no two blocks of terms are held at once.
    With ``finish`` that pass makes of each text and its spans the new text, and there is no column of spans: a pass
    of its own would hold a second Python worker for each task."""
    spark = docs.sparkSession
    names, at_spans = [*docs.columns, _FOUND], len(docs.columns)
    at, fields = names.index("text"), T.StructType([*docs.schema.fields, T.StructField(_FOUND, T._parse_datatype_string(_SPAN))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("gone", pa.bool_())]))

    def add(frame: DataFrame, shares: dict[str, float], first: bool) -> Callable[[Callable | None], DataFrame]:
        sent = spark.sparkContext.broadcast(shares)

        def located(finish: Callable | None) -> DataFrame:
            def run(batches):
                for batch in batches:
                    shares, spans, new = sent.value, [], []
                    for k, value in enumerate(batch.column(at)):
                        raw = value.as_py()
                        text = raw or ""
                        mine = [{"kind": KINDS[k], "start": s, "end": e, "gone": False} for s, k, e in base_spans(text)] if first else batch.column(at_spans)[k].as_py()
                        if shares:
                            mine += [{"kind": "term", "start": s, "end": e, "gone": shares[text[s:e].lower()] >= limits.remove_share} for s, _, e in term_spans(text, shares)]
                        if finish:
                            new.append(finish(text, mine) if mine else raw)
                        else:
                            spans.append(mine)
                    columns = batch.columns[:at_spans]
                    if finish:
                        columns[at] = pa.array(new, batch.schema.field(at).type)
                        yield pa.RecordBatch.from_arrays(columns, names[:-1])
                    else:
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, arrow)], names)

            return frame.mapInArrow(run, docs.schema if finish else fields)

        return located

    out, last = docs, None
    for block in _blocks(revealing_terms(docs, limits)):
        if last:
            out = materialize(last(None), "spans")
        last = add(out, {r.term: r.share for r in block}, last is None)
    return (last or add(out, {}, True))(finish)


def _sorted(spans: str = _FOUND) -> F.Column:
    """By start, then by kind as in KINDS."""
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"])
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), rank(x).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def annotate(docs: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:  # noqa: B008
    """doc_id and ``spans``: array of (kind, start, end), by start and then kind as in KINDS."""
    return _located(_texts(docs), limits).select("doc_id", _sorted().alias("spans"))


def replace_spans(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """The text with (start, kind, end, gone) replaced; of spans that overlap the first by start and kind."""
    out, at = [], 0
    for s, k, e, gone in sorted(spans):
        if s >= at:
            out += [text[at:s], "" if gone else f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def sanitize(docs: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:  # noqa: B008
    """``docs`` with ``text`` made safe: base spans become [KIND], revealing terms [TERM] or nothing."""
    rank = {k: n for n, k in enumerate(KINDS)}
    return _located(docs, limits, lambda text, spans: replace_spans(text, [(x["start"], rank[x["kind"]], x["end"], x["gone"]) for x in spans]))


def digest_spans(found: DataFrame) -> DataFrame:
    """Counts by kind, a checksum of the base spans, and all spans as text."""
    listed = lambda what: F.array_join(F.transform(what, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:4]], F.sha2(listed(F.filter("spans", lambda x: x["kind"] != "term")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
