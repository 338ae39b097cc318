"""Benchmark decontamination by spaced seeds, as columns: only built-in functions.

A mask names the tokens of a short span that are hashed; the others may differ. For every width of a
window the masks are chosen so that each pattern of substitutions that the threshold allows leaves one
of them whole somewhere (a greedy cover of all patterns); a window of up to three tokens allows none, so
its mask is the window. Hashes of the test items under the masks meet those of the documents, and
around each hit the two token sequences are compared on its diagonal: an overlap counts when ``least``
of ``window`` aligned tokens agree.

Only hashes and places are joined; of the documents that are hit, blocks of tokens come back
by place, so a row never carries a document.
"""

from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from listwise.llm.common import written

WINDOW = 20
LEAST = 0.75
#: Hashed tokens of a mask at most, its span, and masks of one width.
WEIGHT = 4
SPAN = 7
MASKS = 3
#: The widest window whose patterns are enumerated; wider ones are covered through the windows inside them.
ENUMERATED = 20
#: Up to so many seeds (about 50 bytes each) every task holds them all; beyond, both sides are shuffled by seed.
BROADCAST_SEEDS = 500_000
#: Up to so many documents that are hit (about 100 bytes each) every task knows them all when it reads the texts again; beyond, the texts are shuffled.
BROADCAST_DOCS = 1_000_000
#: Places of an item that are compared at once, and tokens of a document's block.
CHUNK = 20
BLOCK = 64


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for null and empty texts."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def misses(width: int, least: float = LEAST) -> int:
    """Tokens of a window that may differ."""
    return width - next((e for e in range(width + 1) if e >= least * width), width)


@lru_cache(maxsize=None)
def masks(width: int, least: float = LEAST) -> tuple[tuple[int, ...], ...]:
    """Masks, as hashed places from 0, one of which every allowed pattern of a window of ``width`` leaves whole.

    Each ignores a place inside its span, except where no token may differ. The heaviest weight that a few masks cover is taken.
    """
    miss = misses(width, least)
    if not miss:
        return (tuple(range(min(width, SPAN))),)
    if width > ENUMERATED:
        # Of the windows laid side by side one has no more than its share of the misses.
        inner = next((v for v in range(ENUMERATED, 0, -1) if miss // (width // v) <= misses(v, least)), 0)
        return masks(inner, least) if inner else ((0,),)
    patterns = np.array([sum(1 << p for p in c) for c in combinations(range(width), miss)], np.int64)
    for weight in range(min(WEIGHT, width - miss), 1, -1):
        found = _cover(patterns, width, weight)
        if found:
            return found
    return ((0,),)


def _cover(patterns: np.ndarray, width: int, weight: int) -> tuple:
    """At most MASKS masks of a weight that together survive all patterns, greedily; none if they do not."""
    hit = {}
    for span in range(weight + 1, min(SPAN, width) + 1):
        for inside in combinations(range(1, span - 1), weight - 2):
            mask = (0, *inside, span - 1)
            bits = sum(1 << p for p in mask)
            hit[mask] = np.any([(patterns & (bits << at)) == 0 for at in range(width - span + 1)], axis=0)
    chosen, left = [], np.ones(len(patterns), bool)
    while left.any() and hit and len(chosen) < MASKS:
        best = max(hit, key=lambda m: ((hit[m] & left).sum(), -m[-1]))
        chosen.append(best)
        left &= ~hit[best]
    return () if left.any() else tuple(chosen)


def seeds(words: Column, used: list[tuple[int, ...]]) -> Column:
    """Hashes under the masks at every place: those of one mask, then of the next; null where a mask does not fit."""
    places = F.sequence(F.lit(0), F.size(words) - 1)

    def of(mask):
        name = ",".join(map(str, mask))
        return F.transform(places, lambda i: F.when(i + mask[-1] < F.size(words), F.xxhash64(*(F.get(words, i + p) for p in mask), F.lit(name))))

    return F.when(F.size(words) > 0, F.concat(*(of(m) for m in used))).otherwise(F.array().cast("array<bigint>"))


def _placed(df: DataFrame, used: list, *names: str) -> DataFrame:
    """A row per seed with its place in the words and the number of its mask; one without a seed where there is none.

    The outer form matters: for the inner one Spark infers a filter on the seeds and computes all of
    them, and the words once for every place, a second time below this step.
    """
    return (df.withColumn("_seeds", seeds(F.col("words"), used))
            .select(*names, F.size("words").alias("_n"), F.posexplode_outer("_seeds").alias("_p", "seed"))
            .withColumn("place", F.col("_p") % F.col("_n")).withColumn("mask", F.floor(F.col("_p") / F.col("_n")).cast("int")).drop("_p", "_n"))


def _read(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """(name, mark, words): a row's key as a struct, so that null equals null, the hash of its text, and its tokens."""
    return df.select(F.struct(F.col(key).alias("v")).alias(name), F.xxhash64(F.col(text).cast("string")).alias(f"{name}_mark"),
                     tokens(F.col(text).cast("string")).alias("words"))


def _found(docs: DataFrame, items: DataFrame, key: str, item_key: str, text: str, window: int, least: float) -> DataFrame:
    """(key, key_mark, item, item_mark, best): the best window of every document and item that overlap."""
    bench, corpus = _read(items, item_key, text, "item"), _read(docs, key, text, "key")
    width = F.least(F.size("words"), F.lit(window))
    # The masks in use: a row for each width of item, so at most ``window`` of them.
    widths = sorted(r.width for r in bench.select(width.alias("width")).distinct().collect() if r.width)
    used = sorted({m for w in widths for m in masks(w, least)}) or [(0,)]
    per_width = F.array(*(F.array(*(F.lit(used.index(m)) for m in masks(w, least))) if w in widths else F.array().cast("array<int>") for w in range(window + 1)))
    sized = bench.withColumn("wanted", F.get(per_width, width)).withColumn("size", F.size("words"))
    needles = (_placed(sized, used, "item", "item_mark", "wanted").where(F.col("seed").isNotNull() & F.array_contains("wanted", F.col("mask")))
               .select("seed", "item", "item_mark", F.col("place").alias("item_place")).distinct())
    needles = written(needles, "needles")
    # Only the seeds are counted; where they are many, Spark shuffles by seed.
    small = needles.count() <= BROADCAST_SEEDS
    hits = _placed(corpus, used, "key", "key_mark").join(F.broadcast(needles) if small else needles, "seed")
    # Hits of one diagonal and one chunk of the item are compared at once.
    chunk = F.floor(F.col("item_place") / CHUNK).cast("int")
    hits = written(hits.select("key", "key_mark", "item", "item_mark", (F.col("place") - F.col("item_place")).alias("shift"), chunk.alias("chunk")).distinct(), "seed-hits")

    # The part of an item that windows with a seed in a chunk can touch.
    low, reach = F.greatest(F.col("chunk") * CHUNK + 1 - window, F.lit(0)), 2 * window + CHUNK
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / CHUNK).cast("int")), lambda c: F.struct(
        c.alias("chunk"), F.slice("words", F.greatest(c * CHUNK + 1 - window, F.lit(0)) + 1, reach).alias("part")))
    parts = bench.where(F.size("words") > 0).select("item", "item_mark", F.least(F.size("words"), F.lit(window)).alias("width"), F.explode(chunks).alias("c"))
    parts = parts.select("item", "item_mark", "width", "c.chunk", "c.part").distinct()
    hits = hits.withColumn("begin", F.col("shift") + low).withColumn("block", F.floor(F.greatest("begin", F.lit(0)) / BLOCK).cast("int"))

    # Blocks of the documents that are hit, by place.
    wanted = hits.select("key", "key_mark", "block").distinct()
    hit = wanted.select("key", "key_mark").distinct()
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_DOCS else hit
    raw = docs.select(F.struct(F.col(key).alias("v")).alias("key"), F.col(text).cast("string").alias("text"))
    texts = raw.withColumn("key_mark", F.xxhash64("text")).join(hit, ["key", "key_mark"], "left_semi").withColumn("words", tokens(F.col("text")))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / BLOCK).cast("int")), lambda b: F.struct(
        b.alias("block"), F.slice("words", b * BLOCK + 1, BLOCK + reach).alias("there")))
    blocks = texts.where(F.size("words") > 0).select("key", "key_mark", F.explode(cut).alias("b")).select("key", "key_mark", "b.block", "b.there")
    blocks = blocks.join(wanted, ["key", "key_mark", "block"], "left_semi").distinct()
    met = hits.join(blocks, ["key", "key_mark", "block"]).join(parts, ["item", "item_mark", "chunk"])
    # The document's token beside each of the item's, null where the document has ended or not begun.
    at = F.col("begin") - F.col("block") * BLOCK
    same = F.transform("part", lambda w, i: F.when((F.col("begin") + i >= 0) & (w == F.get("there", at + i)), 1).otherwise(0))
    met = met.select("key", "key_mark", "item", "item_mark", "width", same.alias("same"))
    # Running sums give the count of every window.
    met = met.withColumn("run", F.aggregate("same", F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.size("same") - F.col("width")),
                                   lambda i: F.get("run", i + F.col("width")) - F.get("run", i)))
    counted = met.select("key", "key_mark", "item", "item_mark", best.alias("equal"), "width")
    # The test comes after the aggregate, where Spark cannot push it into the counting.
    return (counted.groupBy("key", "key_mark", "item", "item_mark").agg(F.max(F.struct("equal", "width")).alias("best"))
            .where(F.col("best.equal") >= least * F.col("best.width")))


def overlaps(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text",
             window: int = WINDOW, least: float = LEAST) -> DataFrame:
    """Rows (key, item key, n_equal, n_compared) for every document that overlaps a test item.

    The row tells the best window of the pair. An item shorter than ``window`` must agree as a whole,
    one of a few tokens too: up to three of them have to be equal. Items and documents without a token
    match nothing. Rows of one key are one row of the result, with the best window of their texts; null
    keys stay null. Columns other than keys and texts are not read.
    """
    found = _found(docs, items, key, item_key, text, window, least).groupBy("key", "item").agg(F.max("best").alias("best"))
    return found.select(F.col("key.v").alias(key), F.col("item.v").alias(item_key), F.col("best.equal").cast("long").alias("n_equal"),
                        F.col("best.width").cast("long").alias("n_compared"))


def without_overlaps(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text overlaps a test item: of two texts under one key, or under null, each is judged by itself."""
    flagged = _found(docs, items, key, item_key, text, WINDOW, LEAST).select(F.col("key").alias("_flagged"), F.col("key_mark").alias("_mark")).distinct()
    same = (F.struct(F.col(key).alias("v")) == F.col("_flagged")) & (F.xxhash64(F.col(text).cast("string")) == F.col("_mark"))
    return docs.join(flagged, same, "left_anti")
