"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts are sequences of lower-cased words.  A seed hashes the words that a fixed mask of ones and
zeros selects from a window; words under a zero may differ, so a seed still matches across a
substituted word.  Hashes of all windows of all documents are joined with those of the benchmark; a
shared hash gives a document, an item and the offset between them.  Around each hit the words of both are lined up
at that offset, and the overlap counts if some run of ``WINDOW`` words (or the whole item, if shorter)
agrees in ``AGREE`` of its places.

The benchmark's seeds are broadcast only while their measured number is under ``BROADCAST_SEEDS``; beyond that the same
join shuffles.  Items of fewer than ``WINDOW`` words have shorter masks as well, by their length, so that every overlap that ``AGREE``
accepts holds a seed; documents are cut by those masks that some item of the benchmark needs.

Defined cases: null and empty texts and items match nothing; null ids are kept out of hits (a hit names its
document), and items without an id match nothing; repeated rows are reported once, rows of one id as one document with the best of its overlaps; of overlaps
with equally many equal words the leftmost counts, then the longest; texts of any length are cut whole, into as many seeds as they have
windows; other columns are ignored, whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Stages

#: Fixed masks over word positions.
MASKS = ("1110111", "11010010111")
#: Further masks of short items, by number of words: some one of them fits between the substitutions that ``AGREE`` allows.
SHORT = {
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("111", "11011"), 6: ("111",), 7: ("111",), 8: ("1111",), 9: ("1111",),
    10: ("111",), 11: ("111",), 12: ("1111",),
}
#: Every mask, by the number that its seeds carry.
ALL_MASKS = (*MASKS, *sorted({m for masks in SHORT.values() for m in masks}))
WINDOW, AGREE = 13, 0.8
BROADCAST_SEEDS = 2_000_000
BROADCAST_HITS = 500_000

WORDS = r"array_remove(split(lower(text), r'[^\p{L}\p{N}]+'), '')"


def seeds(mask: str, number: int) -> str:
    """SQL over ``h``, the hashes of the words: the seed at every position, as array<bigint>."""
    picked = ", ".join(f"h[i + {k}]" for k, c in enumerate(mask) if c == "1")
    return f"case when size(h) >= {len(mask)} then transform(sequence(0, size(h) - {len(mask)}), i -> xxhash64({number}, {picked})) else cast(array() as array<bigint>) end"


def _seeded(df: DataFrame, *keep: str, places: bool, masks: tuple[str, ...], own: bool = False) -> DataFrame:
    """The seeds of some masks; with ``own``, the masks of short items are used on items of their length alone."""
    hashed = df.select(*keep, F.expr(f"transform({WORDS}, w -> xxhash64(w))").alias("h"))
    every = []
    for m in masks:
        lengths = ", ".join(str(n) for n, some in SHORT.items() if m in some)
        seed = seeds(m, ALL_MASKS.index(m))
        every.append(F.expr(f"case when size(h) in ({lengths}) then {seed} else cast(array() as array<bigint>) end" if own and m not in MASKS else seed))
    if places:
        return reduce(DataFrame.unionByName, [hashed.select(*keep, F.posexplode(s).alias("at", "seed")) for s in every])
    return hashed.select(*keep, F.explode(F.concat(*every)).alias("seed"))


def overlaps(docs: DataFrame, benchmark: DataFrame, stages: Stages, doc_id="doc_id", text="text", item_id="item_id", item_text="text") -> DataFrame:
    """(doc_id, item_id, doc_start, n_words, n_equal): verified overlaps, best offset per document and item.

    ``doc_start`` is the word of the document at which the item's first overlapping word stands;
    ``n_words`` the length of the lined-up part and ``n_equal`` its equal words.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null")
    items = stages.save(
        benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null"), "items"
    )
    lengths = {r.n for r in items.select(F.expr(f"size({WORDS})").alias("n")).where(f"n < {WINDOW}").distinct().collect()}
    masks = tuple(m for m in ALL_MASKS if m in MASKS or any(m in SHORT.get(n, ()) for n in lengths))
    seeded = stages.save(_seeded(items, "item_id", places=True, masks=masks, own=True).distinct(), "seeds")
    known = seeded.select("seed").distinct()
    small = known.count() <= BROADCAST_SEEDS
    # first every document: does any of its windows share a hash?
    hit = _seeded(docs, "doc_id", places=False, masks=masks).join(F.broadcast(known) if small else known, "seed", "left_semi").select("doc_id").distinct()
    hit = stages.save(hit, "hit")
    few = hit.count() <= BROADCAST_HITS
    some = stages.save(docs.join(F.broadcast(hit) if few else hit, "doc_id").dropDuplicates(["doc_id", "text"]), "some")
    # then only those: where, and against which item
    words = some.select("doc_id", F.expr(WORDS).alias("words"), F.xxhash64("text").alias("version"))
    places = (
        some.select("doc_id", F.xxhash64("text").alias("version"), "text")
        .transform(lambda d: _seeded(d, "doc_id", "version", places=True, masks=masks))
        .join(F.broadcast(seeded.withColumnRenamed("at", "item_at")) if small else seeded.withColumnRenamed("at", "item_at"), "seed")
        .select("doc_id", "version", "item_id", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    )
    item_words = items.select("item_id", F.expr(WORDS).alias("item"))
    item_words = F.broadcast(item_words) if small else item_words
    lined = places.join(words, ["doc_id", "version"]).join(item_words, "item_id")
    lo, hi = "greatest(0, -offset)", "least(size(item), size(words) - offset)"
    equal = f"transform(sequence({lo}, {hi} - 1), j -> case when item[j] = words[j + offset] then 1 else 0 end)"
    lined = lined.select("doc_id", "item_id", "offset", F.expr("size(item)").alias("len"), F.expr(equal).alias("eq"))
    run = f"least({WINDOW}, len)"
    good = f"size(eq) >= {run} and exists(sequence(0, size(eq) - {run}), i -> aggregate(slice(eq, i + 1, {run}), 0, (a, b) -> a + b) >= {AGREE} * {run})"
    found = lined.where(F.expr(good)).select(
        "doc_id", "item_id", F.greatest(F.col("offset"), F.lit(0)).cast("long").alias("doc_start"),
        F.expr("cast(size(eq) as bigint)").alias("n_words"), F.expr("cast(aggregate(eq, 0, (a, b) -> a + b) as bigint)").alias("n_equal"),
    )
    best = F.max(F.struct("n_equal", F.expr("-doc_start").alias("back"), "n_words")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.expr("-b.back").alias("doc_start"), "b.n_words", "b.n_equal"
    )
