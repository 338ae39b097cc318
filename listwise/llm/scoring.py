"""Language-model scores by deleted interpolation.

The probability of a token after another mixes the bigram's, the word's and a uniform estimate. The
weights depend on how often the context was seen (a bucket for each power of two) and are learned by
expectation-maximisation on documents kept out of the counts, the tenth class of the training rows;
the final counts have all training rows.

Counts never leave Spark. Documents are taken in bundles (batches) of about ``BUNDLE_BYTES``; a batch asks for
the counts of its distinct words and bigrams, each a 64-bit key, in slices of the key space. A task
adds up one slice over all batches and answers each; the answers meet their batch again. However
frequent a key, it is asked for once per batch. The learned table has a fixed size: what EM needs is
gathered as a histogram over bucket and the two ratios of the estimates.
"""

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from listwise.llm.common import crc_mod, mixed, word_hashes, written

BUNDLE_BYTES = 8_000_000
#: Characters of text for each slice of the key space, and so about the bytes one task adds up.
SLICE_CHARS = 64_000_000
TUNED_CLASS = 9
START, END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xC6A4A7935BD1E995)
BUCKETS = 48
#: Histogram cells by the natural logarithm of a ratio to the uniform estimate.
CELLS, CELL = 128, 0.25


def tokens_of(texts):
    """(token hashes with an end after each text, number of tokens of each text)."""
    lists = [t.lower().split() if t else () for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists)) + 1
    out = np.full(int(sizes.sum()), END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = word_hashes(chain.from_iterable(lists), len(out) - len(sizes))
    return out, sizes


def keyed(tokens, sizes):
    """Keys of each token's bigram and word; the lowest bit tells a word's key."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = START
    pairs = mixed(before * np.uint64(0x9E3779B97F4A7C15) + mixed(tokens)) & ~np.uint64(1)
    return pairs, mixed(tokens) | np.uint64(1), before


def _bundles(df: DataFrame, key: str, text: str) -> DataFrame:
    """(batch, tuned, docs): the rows in bundles, each an Arrow stream of (key, text, class).

    The class is crc32 of the key as text modulo ten, 1 for a null key; the tuned class has bundles
    of its own. The table is written: whoever reads it again finds the same bundles.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
                       F.coalesce(crc_mod(key, 10), F.lit(1)).cast("long").alias("class"))

    def run(rows):
        from pyspark import TaskContext
        base, n = TaskContext.get().partitionId() << 32, 0
        held, size = {True: [], False: []}, {True: 0, False: 0}

        def flush(tuned):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[tuned][0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in held[tuned]:
                    out.write_batch(part)
            held[tuned], size[tuned] = [], 0
            return pa.RecordBatch.from_arrays([pa.array([base + n], pa.int64()), pa.array([tuned]),
                                               pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["batch", "tuned", "docs"])

        for batch in rows:
            classes = np.array(batch.column("class").to_pylist(), dtype=np.int64)
            bytes_ = np.array([len(t) if t else 0 for t in batch.column("text").cast(pa.binary()).to_pylist()], dtype=np.int64)
            for tuned in (True, False):
                at = np.flatnonzero((classes == TUNED_CLASS) == tuned)
                start = 0
                for i, length in enumerate(bytes_[at].tolist()):
                    size[tuned] += length
                    if size[tuned] >= BUNDLE_BYTES:
                        held[tuned].append(batch.take(pa.array(at[start:i + 1])))
                        yield flush(tuned)
                        start, n = i + 1, n + 1
                if start < len(at):
                    held[tuned].append(batch.take(pa.array(at[start:])))
        for tuned in (True, False):
            if held[tuned]:
                yield flush(tuned)
                n += 1

    return written(source.mapInArrow(run, "batch long, tuned boolean, docs binary"), "bundles")


def _opened(docs: bytes) -> pa.Table:
    return pa.ipc.open_stream(docs).read_all().combine_chunks()


def _packed(a):
    import zlib
    return zlib.compress(a.astype("<u4").tobytes(), 1)


def _unpacked(b):
    import zlib
    return np.frombuffer(zlib.decompress(b), "<u4").astype(np.int64)


def _asked(bundles: DataFrame, slices: int) -> DataFrame:
    """(slice, batch, keys, train, tuned): distinct sorted keys of a bundle in a slice, with its own counts."""
    width = (1 << 64) // slices + 1

    def run(rows):
        edges_of = np.array([i * width for i in range(1, slices)], np.uint64)
        for batch in rows:
            for number, tuned, docs in zip(*(c.to_pylist() for c in batch.columns)):
                docs = _opened(docs)
                tokens, sizes = tokens_of(docs.column("text").cast(pa.binary()).to_pylist())
                pairs, words, _ = keyed(tokens, sizes)
                train = np.repeat(np.array(docs.column("class").to_pylist()) != 0, sizes)
                both = np.concatenate([pairs, words])
                every = np.unique(both)
                seen, n = np.unique(both[np.concatenate([train, train])], return_counts=True)
                count = np.zeros(len(every), np.int64)
                count[np.searchsorted(every, seen)] = n
                edges = [0, *np.searchsorted(every, edges_of).tolist(), len(every)]
                for i in range(slices):
                    low, high = edges[i], edges[i + 1]
                    if low < high:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([i], pa.int64()), pa.array([number], pa.int64()), pa.array([every[low:high].tobytes()], pa.binary()),
                             pa.array([_packed(count[low:high])], pa.binary()), pa.array([tuned])],
                            names=["slice", "batch", "keys", "train", "tuned"])

    return bundles.select("batch", "tuned", "docs").mapInArrow(run, "slice long, batch long, keys binary, train binary, tuned boolean")


def _answered(asked: DataFrame) -> DataFrame:
    """(slice, batch, train, kept, n_words, n_tokens): summed counts for each question.

    ``train`` has all training rows, ``kept`` those outside the tuned class; one row without a batch
    tells the slice's distinct words and tokens, of all training rows and of those kept.
    """
    def run(key, table):
        keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
        own = np.concatenate([_unpacked(t) for t in table.column("train").to_pylist()])
        sizes = [len(k) for k in keys]
        tuned = np.repeat(np.array(table.column("tuned").to_pylist()), sizes)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        train = np.bincount(at, own, len(distinct)).astype(np.int64)
        kept = np.bincount(at, own * ~tuned, len(distinct)).astype(np.int64)
        word = (distinct & np.uint64(1)).astype(bool)
        out_train, out_kept = [], []
        for low, n in zip(np.cumsum([0, *sizes[:-1]]).tolist(), sizes):
            out_train.append(_packed(train[at[low:low + n]]))
            out_kept.append(_packed(kept[at[low:low + n]]))
        totals = [int((train[word] > 0).sum()), int(train[word].sum()), int((kept[word] > 0).sum()), int(kept[word].sum())]
        n = len(sizes)
        columns = [pa.array([key[0].as_py()] * (n + 1), pa.int64()), pa.array(table.column("batch").to_pylist() + [None], pa.int64()),
                   pa.array(out_train + [None], pa.binary()), pa.array(out_kept + [None], pa.binary())]
        columns += [pa.array([0] * n + [t], pa.int64()) for t in totals]
        return pa.table(columns, names=["slice", "batch", "train", "kept", "words", "tokens", "kept_words", "kept_tokens"])

    return asked.groupBy("slice").applyInArrow(
        run, "slice long, batch long, train binary, kept binary, words long, tokens long, kept_words long, kept_tokens long")


def _counts(docs, answers, column):
    """Of one batch: token hashes, sizes, and the counts of each token's bigram, word and context."""
    tokens, sizes = tokens_of(docs.column("text").cast(pa.binary()).to_pylist())
    pairs, words, before = keyed(tokens, sizes)
    every, at = np.unique(np.concatenate([pairs, words]), return_inverse=True)
    parts = sorted(zip(answers.column("slice").to_pylist(), answers.column(column).to_pylist()))
    count = np.concatenate([_unpacked(part) for _, part in parts])
    pair, word = count[at[:len(pairs)]], count[at[len(pairs):]]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    first = np.cumsum(sizes) - sizes
    # A document begins as often as one ends; the count of ends stands with every last token.
    context[first] = word[np.cumsum(sizes) - 1]
    return sizes, pair, word, context


def _bucket(context):
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def _cells(ratio):
    """Histogram cell of a ratio to the uniform estimate; cell 0 is for zero."""
    with np.errstate(divide="ignore"):
        cell = np.floor(np.log(ratio) / CELL) + CELLS // 2
    return np.where(ratio > 0, np.clip(cell, 1, CELLS - 1), 0).astype(np.int64)


def _middle(cell):
    return np.where(cell > 0, np.exp((cell - CELLS // 2 + 0.5) * CELL), 0.0)


def learned(histogram, rounds: int = 60) -> np.ndarray:
    """Weights (bucket, [bigram, word, uniform]) from rows (bucket, bigram cell, word cell, n) by EM."""
    weights = np.tile(np.array([0.4, 0.4, 0.2]), (BUCKETS, 1))
    weights[0] = (0, 0.8, 0.2)
    if not len(histogram):
        return weights
    bucket, two, one, n = histogram.T
    parts = np.stack([_middle(two), _middle(one), np.ones(len(two))], axis=1)
    for _ in range(rounds):
        share = weights[bucket] * parts
        share *= (n / share.sum(axis=1))[:, None]
        total = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1)
        # One token at the starting weights keeps every share above zero.
        total += 0.1 + np.array([0.4, 0.4, 0.2])
        total[0, 0] = 0
        weights = total / total.sum(axis=1, keepdims=True)
    return weights


def score_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32 of the key as text is divisible by ten are held out, all others train; a row with
    a null key trains. A-Z count as lower case, tokens are the runs between ASCII white space and one
    end. A null or empty text is one end. ``base_score`` and ``score`` are log10 probabilities of the
    whole text under smoothed word counts and under the interpolated model. Repeated rows count and
    are answered each. Without training rows both use the uniform estimate. Other columns are not read.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    bundles = _bundles(df, key, text)
    chars = df.select(F.coalesce(F.sum(F.length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // SLICE_CHARS))
    answers = written(_answered(_asked(bundles, slices)), "counts")
    totals = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "tokens", "kept_words", "kept_tokens"))).first()
    words, tokens, kept_words, kept_tokens = (int(t) for t in totals)
    replies = answers.where("batch IS NOT NULL").select("batch", "slice", "train", "kept")

    def cells(_, docs, answer):
        if not docs.num_rows:
            return pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        _, pair, word, context = _counts(_opened(docs.column("docs")[0].as_py()), answer, "kept")
        two = np.where(context > 0, pair / np.maximum(context, 1), 0) * (kept_words + 1)
        one = word / max(kept_tokens, 1) * (kept_words + 1)
        cell, n = np.unique((_bucket(context) * CELLS + _cells(two)) * CELLS + _cells(one), return_counts=True)
        return pa.table({"cell": pa.array(cell, pa.int64()), "n": pa.array(n, pa.int64())})

    tuned = bundles.where("tuned").select("batch", "docs")
    histogram = (tuned.groupBy("batch").cogroup(replies.join(tuned.select("batch"), "batch", "left_semi").groupBy("batch"))
                 .applyInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))).collect()
    rows = np.array([(r.cell // CELLS // CELLS, r.cell // CELLS % CELLS, r.cell % CELLS, r.n) for r in histogram], np.int64)
    weights = learned(rows)

    def score(_, docs, answer):
        names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        docs = _opened(docs.column("docs")[0].as_py())
        sizes, pair, word, context = _counts(docs, answer, "train")
        first = np.cumsum(sizes) - sizes
        base = np.log10((word + 0.1) / (tokens + 0.1 * (words + 1)))
        share = weights[_bucket(context)]
        mix = (share[:, 0] * np.where(context > 0, pair / np.maximum(context, 1), 0) + share[:, 1] * word / max(tokens, 1)
               + share[:, 2] / (words + 1))
        return pa.table([docs.column("key"), pa.array(np.array(docs.column("class").to_pylist()) == 0), pa.array(sizes),
                         pa.array(np.add.reduceat((word > 0).astype(np.int64), first)), pa.array([tokens] * len(sizes), pa.int64()),
                         pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(np.log10(mix), first))], names=names)

    out = bundles.select("batch", "docs").groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
        score, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("key", key)
