"""Bottom-k sketches of word shingles, as columns: only built-in functions.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's five-word shingles, ascending; a
sketch of fewer than ``k`` hashes holds the whole set and every estimate from it is exact. Sketches
of parts merge into the sketch of the whole.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from listwise.llm.common import written

K = 64
SHINGLE = 5
SPACE = " \t\n\u000b\f\r"
_SIZE = float(2 ** 64)


def words(text: Column) -> Column:
    """Words between ASCII white space; none for null, empty and blank texts."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner != "", F.split(inner, "[ \\t\\n\\x0B\\f\\r]+")).otherwise(F.array().cast("array<string>"))


def shingles(word_array: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of ``size`` words; of a shorter text the one run it has."""
    n = F.size(word_array)
    return (F.when(n >= size, F.transform(F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))),
                                          lambda i: F.xxhash64(F.slice(word_array, i, size))))
            .when(n > 0, F.array(F.xxhash64(word_array))).otherwise(F.array().cast("array<bigint>")))


def bottom(hashes: Column, k: int = K) -> Column:
    """The sketch of a set of hashes."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketched(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of a text column; the words are split once."""
    return (df.withColumn("_words", words(F.col(text))).withColumn("_shingles", shingles(F.col("_words")))
            .withColumn(out, bottom(F.col("_shingles"), k)).drop("_words", "_shingles"))


def merged(df: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from sketches of parts: the k smallest hashes are kept, nothing is gathered.

    Every hash is a row that partial aggregation makes distinct; ranks stop at ``k``.
    """
    hashes = df.select(*keys, F.explode(sketch).alias("_hash")).distinct()
    ranked = hashes.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))).where(F.col("_rank") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both; 1 for two empty sets, 0 for one."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(F.size(F.array_intersect(both, F.array_intersect(a, b))) / F.size(both)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    share = (F.element_at(a, -1).cast("double") + _SIZE / 2) / _SIZE
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    r = resemblance(a, b, k)
    common = r / (1 + r) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_count(a, k)))


def shown(sketch: Column) -> Column:
    """A sketch as text: hexadecimal hashes, comma-joined; equal sets have equal text."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def followers(keys: DataFrame) -> DataFrame:
    """(key, next): for each distinct key, a struct, the next smaller one, and the greatest for the smallest.

    Keys are dealt by range and written, so that their partition numbers stay; each partition is
    ordered on its own, and only its greatest key meets those of the other partitions. A struct of a
    null comes after all others.
    """
    dealt = written(keys.select("key").distinct().repartitionByRange(F.desc("key")).withColumn("part", F.spark_partition_id()), "order")
    heads = dealt.groupBy("part").agg(F.max("key").alias("head"))
    all_heads = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select("part", F.coalesce(F.lead("head").over(Window.partitionBy(F.lit(0)).orderBy("part")),
                                            F.max("head").over(all_heads)).alias("beyond"))
    inner = dealt.withColumn("next", F.lead("key").over(Window.partitionBy("part").orderBy(F.desc("key"))))
    return inner.join(after, "part").select("key", F.coalesce("next", "beyond").alias("next"))


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Each document's sketch, that of an edited text, and the likeness to it and to the next document.

    The edited text has the last third of its code points replaced by as many (or all) from the start
    of the next document in descending order of the key. Null texts count as empty, rows with one key
    are one document with the greatest of their texts, a null key comes last, a document alone is its
    own next. Columns other than the two are not read.
    """
    # As a struct a null key equals itself, and grouping and joins hash it alike.
    source = df.select(F.struct(F.col(key).alias("v")).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # One shuffle of the texts by key, with their sketches; all three joins below read it.
    own = sketched(source, "text", "sketch", k).groupBy("key").agg(F.max(F.struct("text", "sketch")).alias("d"))
    own = own.select("key", F.col("d.text").alias("text"), F.col("d.sketch").alias("sketch"))
    order = followers(source.select("key"))
    asks = own.select(F.col("key").alias("asker"), F.floor(F.length("text") / 3).cast("int").alias("need"))
    asks = asks.join(order.withColumnRenamed("key", "of"), F.col("asker") == F.col("of")).select("asker", "need", "next")
    heads = own.join(asks, F.col("key") == F.col("next")).select(
        "asker", F.expr("left(text, need)").alias("head"), F.col("sketch").alias("next_sketch"))
    edited = own.join(heads, F.col("key") == F.col("asker")).withColumn("n_chars", F.length("text").cast("long"))
    edited = edited.withColumn("edited", F.concat(F.expr("left(text, CAST(n_chars - floor(n_chars / 3) AS INT))"), "head"))
    edited = sketched(edited, "edited", "edited_sketch", k)
    return edited.select(F.col("key.v").alias(key), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "edited_sketch",
                         resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                         resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
