"""Mixing sources to target weights, with built-in functions only.

The words of a source, document after document, are cut into blocks of ``BLOCK`` words. A source's
target becomes a quota of blocks; the mix has as many slots as all quotas together, dealt to output
shards of ``SHARD`` slots. For each shard the number of slots of each source is multinomial with the quotas
as weights. Sources drawn beyond their quota then hand the surplus slots to those below it, so that
totals are exact and no source is taken more often than its cap. The j-th slot of a source takes the block
that a pseudorandom permutation of the source's blocks gives to j, with another permutation for each
time the source is gone through, and slots meet blocks by (source, block).

The permutation is a swap-or-not shuffle: a round reflects an index at a key and takes the mirror image
or not by a bit that both share. It is a permutation of any number of indices and needs no table.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from listwise.llm.common import written

BLOCK = 64
SHARD = 4096
#: Shards whose counts are summed in one group.
SPAN = 4096
CAP = 3
WEIGHTS = (5, 2, 1)
ROUNDS = 16
SEED = 20261
#: A prime modulus and odd multipliers of the arithmetic hash; its values stay below 2 ** 31.
PRIME = 2147483647
MULTIPLIERS = (48271, 69621, 16807)
_BUCKETS = 1024


class Mix(NamedTuple):
    """``sources``: rank, source (struct), size, target, blocks, quota; ``documents``: rank, key (struct), size, copies, start;
    ``slots``: shard, rank, j, block."""

    sources: DataFrame
    documents: DataFrame
    slots: DataFrame


def hashed(z: Column) -> Column:
    """An arithmetic hash of a number of up to 62 bits, from 0 to below PRIME; the tests' SQL has the same."""
    z = F.pmod(z.cast("long"), F.lit(PRIME))
    for m, shift in zip(MULTIPLIERS, (15, 13, 17)):
        z = (z * m + 12345) % PRIME
        z = z.bitwiseXOR(F.shiftright(z, shift)) % PRIME
    return z


def round_keys(rank: Column, epoch: Column, blocks: Column, seed: int = SEED) -> Column:
    """(mirror, multiplier, increment) of each round of a source's permutation in an epoch."""
    def key(r, which):
        return hashed(((rank * 8 + epoch) * ROUNDS + r) * 4 + which + seed * 65537)
    return F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda r: F.struct(
        ((key(r, 0) * PRIME + key(r, 1)) % blocks).alias("mirror"), (key(r, 2) % (PRIME - 1) + 1).alias("by"), key(r, 3).alias("plus")))


def permuted(index: Column, blocks: Column, keys: Column) -> Column:
    """The place of ``index`` in a permutation of 0 to blocks - 1."""
    def turn(x, k):
        image = F.pmod(k["mirror"] - x, blocks)
        bit = F.shiftright((F.greatest(x, image) % PRIME * k["by"] + k["plus"]) % PRIME, 7).bitwiseAND(F.lit(1))
        return F.when(bit == 1, image).otherwise(x)
    return F.aggregate(keys, index, turn)


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(source, key, size, copies): equal rows are counted, so that copies of one key never fill a task."""
    size = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    rows = docs.select(F.struct(F.col(source).alias("v")).alias("source"), F.struct(F.col(key).alias("v")).alias("key"), size.alias("size"))
    return rows.groupBy("source", "key", "size").agg(F.count("*").alias("copies"))


def targeted(sources: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """(rank, source, size, target, blocks, quota) from (source, size): one row per source.

    Sources take the weights in turn, by code point, null last. With every source at a common level times
    its weight, those above ``cap`` times their size stop there; the level is that at which the targets add up to
    all sizes.
    """
    ordered = Window.partitionBy(F.lit(0)).orderBy(F.col("source.v").asc_nulls_last())
    out = sources.withColumn("rank", F.row_number().over(ordered).cast("long"))
    out = out.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("double"))
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(F.col("size") / F.col("weight"), "rank")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = (out.withColumn("left", (F.sum("size").over(every) - cap * F.coalesce(F.sum("size").over(before), F.lit(0))).cast("double"))
           .withColumn("share", F.sum("weight").over(after)))
    out = out.withColumn("free", cap * F.col("size") / F.col("weight") >= F.col("left") / F.col("share"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("size") / F.col("weight"), "rank", "left", "share"))).over(every)
    out = out.withColumn("level", level)
    target = F.when(F.col("free"), F.col("level.left") * F.col("weight") / F.col("level.share")).otherwise(F.lit(float(cap)) * F.col("size"))
    out = out.withColumn("target", target).withColumn("blocks", F.ceil(F.col("size") / block))
    quota = F.when(F.col("size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("size") + 0.5)).otherwise(0)
    return out.select("rank", "source", "size", "target", "blocks", F.least(quota, cap * F.col("blocks")).cast("long").alias("quota"))


def placed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """(rank, key, size, copies, start): the documents of each source one after another, by key (null first) and size.

    Starts are sums over sorted ranges and, inside each, a running sum: no task holds a source. The ranges
    are written, so that their numbers stay.
    """
    rows = docs.withColumnRenamed("size", "words").join(sources.select("rank", "source"), "source").select("rank", "key", F.col("words").alias("size"), "copies")
    dealt = written(rows.repartitionByRange("rank", "key", "size").withColumn("part", F.spark_partition_id()), "sized-documents")
    total = F.col("size") * F.col("copies")
    before = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (dealt.groupBy("rank", "part").agg(F.sum(total).alias("total"))
             .select(F.col("rank").alias("r"), F.col("part").alias("p"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("rank", "part").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumn("inner", F.coalesce(F.sum(total).over(inside), F.lit(0)))
    return (rows.join(parts, (F.col("rank") == F.col("r")) & (F.col("part") == F.col("p")))
            .select("rank", "key", "size", "copies", (F.col("base") + F.col("inner")).alias("start")))


def _located(rows: DataFrame, at: str, ranges: DataFrame, total: int) -> DataFrame:
    """``rows`` with the columns of the range (low to below high) that holds ``at``; ranges tile 0 to total - 1."""
    width = -(-max(total, 1) // _BUCKETS)
    cells = ranges.where("high > low").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    return (rows.withColumn("cell", F.floor(F.col(at) / width)).join(cells, "cell")
            .where((F.col(at) >= F.col("low")) & (F.col(at) < F.col("high"))).drop("cell"))


def _tiled(sources: DataFrame, size: Column) -> DataFrame:
    """(rank, low, high): ranges of ``size`` in the order of the ranks."""
    rows = sources.select("rank", size.alias("n"))
    high = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("rank"))
    return rows.select("rank", (high - F.col("n")).alias("low"), high.alias("high"))


def drawn(sources: DataFrame, total: int, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, rank, n): slots of each source in each shard, ``total`` in all, multinomial with the quotas as weights."""
    spark = sources.sparkSession
    shards = -(-total // shard)
    slots = spark.range(0, shards, 1, max(1, min(shards, -(-total // (1 << 20))))).select(
        F.col("id").alias("shard"), F.explode(F.sequence(F.col("id") * shard, F.least((F.col("id") + 1) * shard, F.lit(total)) - 1)).alias("slot"))
    slots = slots.withColumn("at", F.pmod(F.xxhash64(F.lit(seed), F.col("slot")), F.lit(max(total, 1))))
    return _located(slots, "at", _tiled(sources, F.col("quota")), total).groupBy("shard", "rank").agg(F.count("*").alias("n"))


def settled(counts: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """(shard, rank, j): the slots of the shards, numbered from 0 in each source up to its quota.

    Numbers run on from shard to shard, summed over spans of shards and inside each. Slots beyond a source's quota are as many as those that other sources
    lack; they are laid end to end, and so are the missing numbers, and the two meet by position.
    """
    before = Window.partitionBy("rank").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("rank", "span").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("span", F.floor(F.col("shard") / SPAN))
    spans = counts.groupBy("rank", "span").agg(F.sum("n").alias("n")).select("rank", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = counts.join(spans, ["rank", "span"]).withColumn("from", F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    totals = sources.select("rank", "quota").join(counts.groupBy("rank").agg(F.sum("n").alias("got")), "rank", "left").withColumn(
        "got", F.coalesce("got", F.lit(0)))
    over = _tiled(totals, F.greatest(F.col("got") - F.col("quota"), F.lit(0))).select(F.col("rank"), F.col("low").alias("spare"))
    under = (_tiled(totals, F.greatest(F.col("quota") - F.col("got"), F.lit(0)))
             .join(totals.select("rank", "got"), "rank").withColumnRenamed("rank", "to"))
    # A count is a small row that becomes many: the number of tasks is set, or adaptive execution would merge the rows into one.
    tasks = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (1 << 20)))
    numbered = numbered.repartition(tasks, "shard", "rank")
    slots = numbered.join(totals.select("rank", "quota"), "rank").withColumn("j", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)))
    kept = slots.where("j < quota").select("shard", "rank", "j")
    surplus = slots.where("j >= quota").join(over, "rank").select("shard", (F.col("spare") + F.col("j") - F.col("quota")).alias("at"))
    lack = under.agg(F.max("high")).first()[0] or 0
    moved = _located(surplus, "at", under, lack).select("shard", F.col("to").alias("rank"), (F.col("got") + F.col("at") - F.col("low")).alias("j"))
    return kept.unionByName(moved)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, cap: int = CAP,
        block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> Mix:
    """The mix of ``docs``: sources with their targets, documents with their places, and slots with their blocks.

    A null text has no words, a null source is a source of its own, documents of one key and size in a
    source are told apart by place alone; an empty table has no slots. Columns not named are not read.
    The result depends on the rows and the seed, not on their partitioning.
    """
    counted = written(sized(docs, key, text, source), "document-sizes")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"))
    sources = written(targeted(sizes, weights, cap, block), "sources")
    documents = placed(counted, sources)
    total = sources.agg(F.sum("quota")).first()[0] or 0
    counts = written(drawn(sources, total, shard, seed), "shard-counts")
    epochs = sources.where("blocks > 0").select(F.col("rank").alias("of"), F.col("blocks").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("epoch"))
    epochs = epochs.withColumn("keys", round_keys(F.col("of"), F.col("epoch"), F.col("b"), seed))
    slots = settled(counts, sources, total).join(sources.select("rank", "blocks"), "rank").withColumn("e", F.floor(F.col("j") / F.col("blocks")))
    slots = slots.join(epochs, (F.col("rank") == F.col("of")) & (F.col("e") == F.col("epoch")))
    slots = slots.select("shard", "rank", "j", permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.col("keys")).alias("block"))
    return Mix(sources, documents, slots)


def pieces(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rank, key, size, copy, start, block, words): each document cut at the bounds of its source's blocks.

    A document without words is one row with a null block and no words.
    """
    rows = documents.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    rows = rows.select("rank", "key", "size", "copy", "start", F.explode_outer(blocks).alias("block"))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block)
    return rows.withColumn("words", F.coalesce(words, F.lit(0)))


def taken(parts: Mix, block: int = BLOCK, key: str = "doc_id") -> DataFrame:
    """One row per document: key, size, source_size, target, taken (its words in the mix, repeats counted)."""
    times = parts.slots.groupBy("rank", "block").agg(F.count("*").alias("times"))
    met = pieces(parts.documents, block).join(times, ["rank", "block"], "left")
    words = met.groupBy("rank", "key", "size", "copy").agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    sources = parts.sources.select("rank", F.col("size").alias("source_size"), "target")
    return words.join(sources, "rank").select(F.col("key.v").alias(key), "size", "source_size", "target", "taken")


def mixed_pieces(parts: Mix, block: int = BLOCK, key: str = "doc_id") -> DataFrame:
    """The mix itself: (shard, rank, j, block, key, from_word, words), each slot's pieces of documents.

    A slot's words are those of its pieces in the order of ``place``, the position in the source.
    """
    cut = pieces(parts.documents, block).where("block IS NOT NULL")
    at = F.greatest(F.col("start"), F.col("block") * block)
    return (parts.slots.join(cut, ["rank", "block"])
            .select("shard", "rank", "j", "block", F.col("key.v").alias(key), (at - F.col("start")).alias("from_word"), "words", at.alias("place")))
