"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Words are lower-cased and split at white space and common punctuation. At each position a
hash of the words that a mask keeps is taken, for every mask, so that a substituted word
under a gap still hits. Hits with test items give diagonals (document position less item
position); on each diagonal whole item and document are compared, and a pair counts if some
window of ``window`` words (of the whole item where that is shorter) has at least
``percent`` of its words equal. The masks for each window length are chosen so that every
placement of the words that may differ leaves one of them whole: no pair that counts is lost.
Masks begin and end with a kept word, so words beyond a document's ends count as differing.

Up to ``BLOCK_SEEDS`` item seeds are broadcast, so only hits are shuffled; more of them are joined by a shuffle of both
sides, once, in which adaptive execution splits a seed that many documents have. Hits are reduced to different diagonals in each task before they are shuffled, and
only documents with hits are read again.

Defined results: null and empty texts and null ids give no pairs. Items of any length count.
Repeated rows give one pair; of several texts with one doc_id the best counts. Empty tables give
no pairs. Only the two id columns and ``text`` are read, whatever else there is.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize

# Most words that a mask keeps, most masks of a window length, most work to enumerate them.
WEIGHT, FAMILY, ENUMERATED = 6, 6, 1_000_000
# The masks of the SQL below, which finds less than overlaps(); 1 keeps a word, 0 ignores it.
MASKS = ("11101011", "11010111", "10111101")
SPAN = 8
MARKS = ".,;:!?\"'()[]{}|\n\t\r\v\f"
BLOCK_SEEDS = 500_000
#: Positions whose seeds are made together: what a task holds of a text beside its words and their hashes.
PIECE = 1024


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), MARKS, " " * len(MARKS)), " "), "")


@cache
def masks(wide: int, differ: int) -> tuple[tuple[int, ...], ...]:
    """Kept offsets of each mask: in ``wide`` words, any ``differ`` of them leave one mask whole somewhere."""
    for weight in range(min(WEIGHT, wide - differ), 1, -1):
        if comb(wide, differ) * comb(wide - 1, weight - 1) > ENUMERATED:
            continue
        places = [set(x) for x in combinations(range(wide), differ)]
        whole = {}
        for mask in ((0, *x) for x in combinations(range(1, wide), weight - 1)):
            whole[mask] = {n for n, x in enumerate(places) if any(x.isdisjoint(p + o for o in mask) for p in range(wide - mask[-1]))}
        left, chosen = set(range(len(places))), []
        while left and len(chosen) <= FAMILY:
            best = max(whole, key=lambda m: (len(whole[m] & left), -m[-1]))
            if not whole[best] & left:
                break
            chosen.append(best)
            left -= whole[best]
        if not left and len(chosen) <= FAMILY:
            return tuple(chosen)
    return (tuple(range(wide // (differ + 1))),)


def _families(widths, percent: int) -> list[tuple[int, int, tuple[int, ...]]]:
    """(width, number, mask) for windows of the given widths."""
    return [(n, m, mask) for n in sorted(widths) for m, mask in enumerate(masks(n, n - -(-percent * n // 100)))]


def _seeds(df: DataFrame, key: str, window: int = 12, percent: int = 80, widths: list[int] | None = None) -> DataFrame:
    """(key, at, seed): hashes under each mask at every position that has its whole span.

    ``widths`` are the window widths looked for; without them each row gives seeds of its own width only.
    """
    families = _families(widths or range(1, window + 1), percent)
    span = max(mask[-1] for _, _, mask in families) + 1
    hashed = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.size("h"), F.lit(1)), F.lit(PIECE)), lambda c: F.slice(F.col("h"), c, F.lit(PIECE + span - 1)))
    cut = hashed.select(key, F.least(F.size("h"), F.lit(window)).alias("wide"), F.posexplode(pieces).alias("piece", "w"))
    spans = cut.select(key, "wide", "piece", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.least(F.size("w"), F.lit(PIECE)), F.lit(1)) - 1)).alias("i"))
    masked = []
    for n, m, mask in families:
        kept = [F.get("w", F.col("i") + o) for o in mask]
        fits = kept[-1].isNotNull()
        masked.append(F.when(fits if widths else fits & (F.col("wide") == n), F.xxhash64(F.lit(n), F.lit(m), *kept)))
    at = F.col("piece") * PIECE + F.col("i")
    return spans.select(key, at.alias("at"), F.explode(F.array(*masked)).alias("seed")).where("seed is not null")


def overlaps(docs: DataFrame, items: DataFrame, window: int = 12, percent: int = 80) -> DataFrame:
    """doc_id, item_id, item_words, equal_words (most on one diagonal) and best_window of each pair that overlaps."""
    seeds = materialize(_seeds(items, "item_id", window, percent).select("item_id", F.col("at").alias("item_at"), "seed").distinct(), "seeds")
    sizes = items.where("item_id is not null").select(F.least(F.size(words(F.col("text"))), F.lit(window)).alias("wide")).distinct()
    widths = [r.wide for r in sizes.collect() if r.wide] or [window]
    wanted = F.broadcast(seeds) if seeds.count() <= BLOCK_SEEDS else seeds.hint("merge")
    hits = _seeds(docs, "doc_id", window, percent, widths).join(wanted, "seed").select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
    hits = materialize(hits.distinct(), "hits")
    hit_docs = hits.select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(hit_docs, "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("w"))
    texts = materialize(texts, "hit-words")
    wanted = materialize(items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("g")), "item-words")
    pairs = hits.join(wanted, "item_id").join(texts, "doc_id").where(F.size("g") > 0)
    same = F.expr("transform(sequence(0, size(g) - 1), q -> if(shift + q >= 0, if(get(w, shift + q) = g[q], 1, 0), 0))")
    same = F.transform(same, lambda x: F.coalesce(x, F.lit(0)))
    pairs = materialize(pairs.select("doc_id", "item_id", F.size("g").alias("item_words"), same.alias("same")), "diagonals")
    wide = f"least({window}, item_words)"
    best = F.expr(f"array_max(transform(sequence(0, item_words - {wide}), s -> aggregate(slice(same, s + 1, {wide}), 0, (a, x) -> a + x)))")
    all_equal = F.expr("aggregate(same, 0, (a, x) -> a + x)")
    scored = pairs.select("doc_id", "item_id", "item_words", all_equal.alias("equal_words"), best.alias("best_window"), F.expr(wide).alias("wide"))
    good = scored.where(100 * F.col("best_window") >= percent * F.col("wide"))
    return good.groupBy("doc_id", "item_id").agg(*[F.max(c).cast("long").alias(c) for c in ("item_words", "equal_words", "best_window")])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 12, percent: int = 80) -> DataFrame:
    """``docs`` without the rows whose own text overlaps any item, whatever their doc_id.

    Texts are known by a 64-bit hash: a clean one is lost if it shares that of one that overlaps."""
    texts = docs.where("text is not null").select(F.xxhash64("text").alias("doc_id"), "text")
    found = overlaps(texts, items, window, percent).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(found, F.xxhash64(docs["text"]) == found["_hit"], "left_anti")


def _sql_list() -> str:
    marks = "".join(c for c in MARKS if c.isprintable()).replace("'", "''")
    controls = " || ".join(f"chr({ord(c)})" for c in MARKS if not c.isprintable())
    return f"list_filter(string_split(translate(lower(coalesce(text, '')), '{marks}' || {controls}, '{' ' * len(MARKS)}'), ' '), lambda x: x <> '')"


def oracle(window: int = 12, percent: int = 80) -> str:
    seeds = " UNION ALL ".join(f"SELECT {{key}}, i, {m} AS mask, concat_ws(' ', {', '.join(f'w[i + {j}]' for j in range(SPAN) if mask[j] == '1')}) AS seed FROM {{at}}" for m, mask in enumerate(MASKS))
    return f"""
WITH d AS (SELECT doc_id, {_sql_list()} AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, {_sql_list()} AS w FROM benchmark WHERE item_id IS NOT NULL),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) - {SPAN} + 2)) AS i FROM d),
bp AS (SELECT item_id, w, unnest(range(1, len(w) - {SPAN} + 2)) AS i FROM b),
ds AS ({seeds.format(key='doc_id', at='dp')}),
bs AS ({seeds.format(key='item_id', at='bp')}),
hits AS (SELECT DISTINCT ds.doc_id, bs.item_id, ds.i - bs.i AS shift FROM ds JOIN bs ON ds.mask = bs.mask AND ds.seed = bs.seed),
eq AS (SELECT h.doc_id, h.item_id, len(b.w) AS m, list_transform(range(1, len(b.w) + 1), lambda q: CASE WHEN h.shift + q >= 1 AND d.w[h.shift + q] = b.w[q] THEN 1 ELSE 0 END) AS same
  FROM hits h JOIN d USING (doc_id) JOIN b USING (item_id)),
scored AS (SELECT doc_id, item_id, m, list_sum(same) AS n, least({window}, m) AS wide,
  list_max(list_transform(range(0, m - least({window}, m) + 1), lambda s: list_sum(same[s + 1 : s + least({window}, m)]))) AS best FROM eq)
SELECT doc_id, item_id, CAST(max(m) AS BIGINT) AS item_words, CAST(max(n) AS BIGINT) AS equal_words, CAST(max(best) AS BIGINT) AS best_window
FROM scored WHERE 100 * best >= {percent} * wide GROUP BY doc_id, item_id"""
