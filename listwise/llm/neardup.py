"""Near-duplicates by an inverted join over MinHash coordinates, confirmed on whole shingle sets.

Every distinct shingle set has a signature of ``COORDINATES`` minima. A set is posted under its
(coordinate, value) pairs. Two sets that agree on at least ``MATCHES`` coordinates share a pair
within their ``m - MATCHES + 1`` rarest pairs, m being the pairs of a set that anyone else has
(prefix filter on rarity): only these are merged, the long lists of frequent pairs are skipped.
Candidates that agree on ``MATCHES`` coordinates are confirmed on the whole sets.

No list is paired with itself. In two rounds every list sends its members to one head: first the
most central set, whose pairs are the most frequent ones, then the most central set of another
component. Sets known to be linked become one component, and a list whose members are in one
component is done. Sets of the lists still open meet across components only, by their rarest
shingles and at positions that leave room for enough common ones (positional prefix filter on the
whole sets, which loses nothing), so a set with too many shingles of its own meets nobody, however
large its list.

A pair at the least similarity, 0.75, agrees on 48 of 64 coordinates on average and on fewer than 28
with a probability below 1e-8.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from listwise.llm.common import mixed, word_hashes, written

COORDINATES = 64
MATCHES = 28
SHINGLE = 5
SIMILAR = 75
ROUNDS = 2
_A = (np.random.default_rng(20).integers(1, 2 ** 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_SHIFTS = np.random.default_rng(21).integers(1, 2 ** 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)



def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a UTF-8 text.

    A-Z in lower case, words between ASCII white space; a text of fewer words than ``size`` has its
    whole sequence as one shingle, a text without words none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        out = mixed(out * _SHIFTS[k] + h[k:k + n])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper halves of the least products under each odd multiplier."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(least, (shingles[None, at:at + 4096] * _A).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, set_high, set_low, signature) per row; equal sets have equal set numbers."""
    import xxhash
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, high, low, signs = [], [], [], []
            for t in batch.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(t)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(high, pa.int64()),
                                              pa.array(low, pa.int64()), pa.array(signs, pa.binary())],
                                             names=["key", "n_shingles", "set_high", "set_low", "signature"])

    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, n_shingles long, set_high long, set_low long, signature binary")


def _postings(reps: DataFrame) -> DataFrame:
    """(rep, pair) for every coordinate of every set; a pair is its coordinate and 32-bit value."""
    def run(batches):
        place = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in batches:
            signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), COORDINATES))),
                 pa.array((signs.astype(np.int64) | place).ravel())], names=["rep", "pair"])

    kind = reps.schema["rep"].dataType.simpleString()
    return reps.select("rep", "signature").mapInArrow(run, f"rep {kind}, pair long")


def _prefixes(reps: DataFrame) -> DataFrame:
    """(rep, central, pair): the rarest pairs of each set that any match must share.

    ``central`` orders sets by how many of their pairs others have, then by how often.
    """
    postings = _postings(reps)
    shared = postings.groupBy("pair").count().where("count > 1")
    own = (postings.join(shared, "pair").groupBy("rep")
           .agg(F.sort_array(F.collect_list(F.struct("count", "pair"))).alias("pairs"), F.struct(F.count("*"), F.sum("count")).alias("central"))
           .where(F.size("pairs") >= MATCHES))
    return own.select("rep", "central", F.explode(F.slice("pairs", F.lit(1), F.size("pairs") - (MATCHES - 1))).alias("p")
                      ).select("rep", "central", F.col("p.pair").alias("pair"))


def _across(open_sets: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that may be similar, by their rarest shingles.

    Shingles are ordered by their number of open sets; those of one set come first and are not
    posted. Where two similar sets first have a shingle in common, at positions i and j, what is left
    of each must hold all their common shingles: that bounds i and j, and for the smaller set j alone.
    """
    kind = open_sets.schema["rep"].dataType.simpleString()

    def spread(batches):
        for batch in batches:
            found = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            n = np.array([len(x) for x in found], np.int64)
            at = pa.array(np.repeat(np.arange(len(found)), n))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.repeat(n, n)),
                                              pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))],
                                             names=["rep", "component", "n", "shingle"])

    posted = (open_sets.join(sets, "rep").select("rep", "component", "shingles")
              .mapInArrow(spread, f"rep {kind}, component {kind}, n long, shingle long"))
    shared = posted.groupBy("shingle").count().where("count > 1")
    own = (posted.join(shared, "shingle").groupBy("rep", "component", "n")
           .agg(F.sort_array(F.collect_list(F.struct("count", "shingle"))).alias("s")))
    own = own.withColumn("single", F.col("n") - F.size("s"))
    probe = (F.floor((100 - similar) * F.col("n") / 100) + 1 - F.col("single")).cast("int")
    lists = (own.where(probe > 0).select("rep", "component", "n", "single", F.posexplode_outer(F.slice("s", F.lit(1), probe)).alias("p", "e"))
             .select("rep", "component", "n", (F.col("single") + F.col("p")).alias("i"), F.col("e.shingle").alias("shingle")))
    lists = written(lists, "rare-shingles")
    x = lists.select("shingle", F.col("rep").alias("a"), F.col("component").alias("c_a"), F.col("n").alias("n_a"), F.col("i").alias("i_a"))
    y = (lists.where((100 + similar) * (F.col("n") - F.col("i")) >= 2 * similar * F.col("n"))
         .select("shingle", F.col("rep").alias("b"), F.col("component").alias("c_b"), F.col("n").alias("n_b"), F.col("i").alias("i_b")))
    room = similar * (F.col("n_a") + F.col("n_b"))
    pairs = x.join(y, (x["shingle"] == y["shingle"]) & (F.col("c_a") != F.col("c_b")) & (100 * F.col("n_b") >= similar * F.col("n_a"))
                   & ((F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") < F.col("a"))))
                   & ((100 + similar) * (F.col("n_a") - F.col("i_a")) >= room) & ((100 + similar) * (F.col("n_b") - F.col("i_b")) >= room))
    return pairs.select("a", "b")


def _confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) that agree on enough coordinates and whose whole sets are similar.

    A pair meets the set of its first member, then that of its second; only ids leave the comparison,
    so a frequent member costs rows, which Spark can split, never a group.
    """
    def agree(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, COORDINATES) for i in (2, 3))
                yield batch.filter(pa.array((x == y).sum(axis=1) >= MATCHES)).select(["a", "b"])

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= similar * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    kind = reps.schema["rep"].dataType.simpleString()
    schema = f"a {kind}, b {kind}"
    sign = reps.select("rep", "n_shingles", "signature")
    close = (pairs.join(sign.toDF("a", "n_a", "sign_a"), "a").join(sign.toDF("b", "n_b", "sign_b"), "b")
             .where((100 * F.col("n_a") >= similar * F.col("n_b")) & (100 * F.col("n_b") >= similar * F.col("n_a")))
             .select("a", "b", "sign_a", "sign_b").mapInArrow(agree, schema))
    return (close.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")
            .mapInArrow(compare, schema))


def components(edges: DataFrame) -> DataFrame:
    """(rep, component): the smallest member of every linked rep's component, itself included.

    Each round every node tells its neighbours the smallest label it knows and follows its label's
    label; labels halve the way to the root. Rounds are tables in the shared folder.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("rep"), "label"), "labels")
    while True:
        told = both.join(labels.toDF("b", "told"), "b").groupBy("a").agg(F.min("told").alias("told"))
        jump = labels.toDF("label", "jumped")
        after = (labels.join(told.withColumnRenamed("a", "rep"), "rep").join(jump, "label", "left")
                 .select("rep", F.col("label").alias("was"), F.least("label", "told", "jumped").alias("label")))
        after = written(after, "labels")
        if after.where(F.col("was") != F.col("label")).isEmpty():
            return after.select("rep", F.col("label").alias("component"))
        labels = after.select("rep", "label")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", similar: int = SIMILAR) -> DataFrame:
    """One row per input row: key, n_shingles, component_id (the smallest key of its component), kept.

    Rows are linked when their shingle sets have a resemblance of ``similar`` percent or more; equal
    sets are one node from the start. Rows without words are linked with nothing. A row with a null
    key stands for itself: its component is null unless it has the set of another row, and it is kept
    only if it is null. Repeated rows are linked with each other and have one component; all rows with
    the smallest key are kept. Columns other than the two are not read.
    """
    sketch = written(sketches(df, key, text), "sketches")
    full = sketch.where("n_shingles > 0")
    classes = full.groupBy("set_high", "set_low").agg(F.min("key").alias("rep"))
    members = written(classes.where("rep IS NOT NULL"), "classes")
    first = F.col("key") == F.col("rep")
    reps = written(full.join(members, ["set_high", "set_low"]).where(first)
                   .dropDuplicates(["rep", "set_high", "set_low"]).select("rep", "n_shingles", "signature"), "nodes")
    prefixes = written(_prefixes(reps), "prefixes")

    kind = df.schema[key].dataType.simpleString()

    def read(batches):
        for batch in batches:
            found = [shingle_set(t).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["rep", "shingles"])

    wanted = prefixes.select("rep").distinct()
    texts = df.select(F.col(key).alias("rep"), F.col(text).cast("string").alias("text"))
    sets = written(texts.join(wanted, "rep", "left_semi").mapInArrow(read, f"rep {kind}, shingles binary")
                   .where(F.length("shingles") > 0), "sets")

    ordered = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    heads = prefixes.groupBy("pair").agg(F.max(F.struct("central", "rep")).alias("head"))
    pairs = prefixes.join(heads, "pair").select(F.col("rep").alias("a"), F.col("head.rep").alias("b")).where("a <> b").select(*ordered).distinct()
    tried = written(pairs, "pairs")
    edges = written(_confirmed(tried, reps, sets, similar), "found")
    for turn in range(1, ROUNDS + 1):
        labels = components(edges)
        now = prefixes.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        lists = now.groupBy("pair").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                        F.max(F.struct("central", "rep", "component")).alias("one")).where("low <> high")
        now = written(now.join(lists.select("pair", "one"), "pair"), "open")
        if turn < ROUNDS:
            others = now.where(F.col("component") != F.col("one.component")).groupBy("pair").agg(F.max(F.struct("central", "rep", "component")).alias("two"))
            sent = now.join(others, "pair").select("rep", "component", F.explode(F.array("one", "two")).alias("head"))
            pairs = sent.where(F.col("component") != F.col("head.component")).select(F.col("rep").alias("a"), F.col("head.rep").alias("b"))
        else:
            pairs = _across(now.select("rep", "component").distinct(), sets, similar)
        pairs = written(pairs.select(*ordered).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        edges = edges.unionByName(written(_confirmed(pairs, reps, sets, similar), "found"))
    labels = components(edges)
    roots = members.join(labels, "rep", "left").select("set_high", "set_low", F.coalesce("component", "rep").alias("component"))
    out = sketch.join(roots, ["set_high", "set_low"], "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component", "key")).otherwise(F.col("key")))
    return out.select(F.col("key").alias(key), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
