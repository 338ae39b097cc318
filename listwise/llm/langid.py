"""Language of code-switched text by a linear-chain conditional random field over words.

Features of a word: prefixes and suffixes, character n-grams inside word boundaries (hashed into a
fixed table), its length, and how a lexicon counted on the fitting sample leans. Transitions and
start weights are learned. Fitting maximises the likelihood of word labels on sequences spliced from
windows of documents of one or two languages; prediction runs forward-backward over all words of a
document and adds up the posteriors.

The fit sees a bounded sample: at most ``docs_per_lang`` labelled documents of each language, drawn
by a hash of the id, and ``windows`` windows of ``WINDOW`` words from anywhere in them, as many of each
language as it has up to its share. Prediction
reads every word of every text, shuffles nothing, and holds a slice of one Arrow batch.
"""

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

WORD = regex.compile(r"\p{L}+")
BUCKETS = 1 << 15
WINDOW = 32
UNKNOWN = "und"
CACHE_WORDS = 400_000
#: Words that one forward-backward pass takes together, and its lanes.
SLICE, LANES = 300_000, 2048
#: Steps after which messages are scaled anew; scores differ by far less than 700 in so many.
SCALE_EVERY = 4
#: A longer run of letters is so many words of this length, as in scripts without spaces a run may be a whole text.
LONGEST_WORD = 64
#: A text of so many words is claimed by a language only if its words are this certain of theirs on average.
ENOUGH_WORDS, CERTAIN = 30, 0.69


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _hashed(codes, at, size, salt):
    """Table places of the strings of ``size`` characters that begin at ``at``."""
    h = np.full(len(at), salt, np.uint64)
    for k in range(size):
        h += codes[at + k] * _MIX[k]
        h ^= h >> np.uint64(29)
    return ((h * _MIX[0]) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def features(words: list[str]):
    """Table places of the features of lower-case words, ends marked.

    ``by_char``: the n-grams of 2 and 3 (which hold affixes of 1 and 2) at every character;
    ``heads``: where each word begins there; ``by_word``: affixes of 3 and 4, and the length.
    What a short word lacks is place BUCKETS, whose weight is always 0.
    """
    marked = [f"^{w}$" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(size)
    heads = ends - size
    left = np.repeat(ends, size) - np.arange(len(codes))
    by_char = np.full((len(codes), 2), BUCKETS)
    by_word = np.full((len(words), 5), BUCKETS)
    for column, n in enumerate((2, 3)):
        at = np.flatnonzero(left >= n)
        by_char[at, column] = _hashed(codes, at, n, n)
    for column, n in enumerate((4, 5)):
        long = np.flatnonzero(size > n)
        by_word[long, 2 * column] = _hashed(codes, heads[long], n, n)
        by_word[long, 2 * column + 1] = _hashed(codes, ends[long] - n, n, n)
    by_word[:, 4] = _hashed(np.minimum(size, 14).astype(np.uint64), np.arange(len(words)), 1, 77)
    return by_char, heads, by_word


def weighed(weights, places):
    """The sum of the weights of each word's features."""
    by_char, heads, by_word = places
    one = weights[by_char[:, 0]]
    one += weights[by_char[:, 1]]
    out = np.add.reduceat(one, heads, axis=0)
    for k in range(by_word.shape[1]):
        out += weights[by_word[:, k]]
    return out


class Chain:
    """Forward-backward over many documents laid end to end, in lanes that advance together."""

    def __init__(self, start, transitions):
        self.start = np.exp(start - start.max())
        self.move = np.exp(transitions - transitions.max())

    def posteriors(self, scores, first, pairs=False):
        """Label posteriors of every word; ``first`` marks the first word of each document.

        A lane's effect is the product of its step matrices; a first word's matrix has rank one,
        which makes what came before it irrelevant. With ``pairs`` also the expected transitions.
        """
        total, labels = scores.shape
        lanes = max(1, min(LANES, total // 8))
        steps = -(-total // lanes)
        pad = lanes * steps - total
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        e = np.concatenate([e, np.ones((pad, labels))]).reshape(lanes, steps, labels).transpose(1, 0, 2).copy()
        f = np.concatenate([first, np.ones(pad, bool)]).reshape(lanes, steps).T
        fresh = [np.flatnonzero(row) for row in f]
        move, back = self.move, self.move.T.copy()
        effect = np.broadcast_to(np.eye(labels), (lanes, labels, labels)).copy()
        for s in range(steps):
            after = (effect.reshape(-1, labels) @ move).reshape(effect.shape) * e[s][:, None, :]
            if len(at := fresh[s]):
                after[at] = effect[at].sum(axis=2)[:, :, None] * (self.start * e[s][at])[:, None, :]
            effect = after
            if s % SCALE_EVERY == 0:
                effect /= effect.max(axis=(1, 2))[:, None, None]
        effect /= effect.max(axis=(1, 2))[:, None, None]
        into, beyond = np.empty((lanes, labels)), np.empty((lanes, labels))
        v = np.full(labels, 1 / labels)
        for k in range(lanes):
            into[k] = v
            v = v @ effect[k]
            v /= v.sum()
        v = np.full(labels, 1 / labels)
        for k in range(lanes - 1, -1, -1):
            beyond[k] = v
            v = effect[k] @ v
            v /= v.sum()
        alpha = np.empty_like(e)
        a = into
        for s in range(steps):
            moved_on = a @ move
            if len(at := fresh[s]):
                moved_on[at] = a[at].sum(axis=1)[:, None] * self.start
            a = moved_on
            a *= e[s]
            if s % SCALE_EVERY == 0:
                a /= a.sum(axis=1)[:, None]
            alpha[s] = a
        b, moved = beyond, np.zeros((labels, labels))
        gamma = np.empty_like(e)
        for s in range(steps - 1, -1, -1):
            np.multiply(alpha[s], b, out=gamma[s])
            w = e[s] * b
            if pairs:
                inner = ~f[s]
                joint = (alpha[s - 1] if s else into)[inner][:, :, None] * move * w[inner][:, None, :]
                moved += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = w @ back
            if len(at := fresh[s]):
                b[at] = (w[at] @ self.start)[:, None]
            if s % SCALE_EVERY == 0:
                b /= b.sum(axis=1)[:, None]
        gamma /= gamma.sum(axis=2, keepdims=True)
        gamma = gamma.transpose(1, 0, 2).reshape(-1, labels)[:total]
        return (gamma, moved) if pairs else gamma


class Model:
    """Learned weights; small and of a size that the data cannot change."""

    def __init__(self, labels, weights, lexicon, lean, start, transitions):
        """``lexicon`` has a row of ``lean`` for each word it knows; the first row is for all others."""
        self.labels, self.weights, self.lexicon, self.lean = labels, weights, lexicon, lean
        self.start, self.transitions = start, transitions

    def emissions(self, words) -> np.ndarray:
        """Scores of distinct lower-case words."""
        scores = weighed(self.weights, features(words))
        known = np.fromiter((self.lexicon.get(w, 0) for w in words), np.int64, len(words))
        return scores + self.lean[known]


def fit(labels: list[str], windows: list[tuple[str, list[str]]], epochs: int = 25, seed: int = 7) -> Model:
    """A model from (label, words) windows; numpy on a bounded sample."""
    rng = np.random.default_rng(seed)
    n = len(labels)
    number = {x: i for i, x in enumerate(labels)}
    lists, truth = [], []
    order = rng.permutation(len(windows))
    for a, b in zip(order, rng.permutation(len(windows))):
        cut = int(rng.integers(1, WINDOW + 1))
        one, two = windows[a], windows[b]
        lists.append(one[1] + two[1][:cut])
        truth.append([number[one[0]]] * len(one[1]) + [number[two[0]]] * len(two[1][:cut]))
    words = sorted({w for x in lists for w in x})
    at = {w: i for i, w in enumerate(words)}
    flat = np.fromiter((at[w] for x in lists for w in x), np.int64)
    gold = np.fromiter((y for x in truth for y in x), np.int64)
    first = np.zeros(len(flat), bool)
    first[np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]])] = True
    counts = np.bincount(flat * n + gold, minlength=len(words) * n).reshape(-1, n).astype(float)
    rate = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(words))
    table = np.log(rate / rate.mean(axis=1, keepdims=True))
    known = counts.sum(axis=1) >= 3
    table[~known] = 0
    places = features(words)
    by_char, heads, by_word = places
    letters = np.diff(np.append(heads, len(by_char)))
    feature = np.concatenate([by_char[:, 0], by_char[:, 1], by_word.T.ravel()])
    owner = np.concatenate([np.tile(np.repeat(np.arange(len(words)), letters), 2), np.tile(np.arange(len(words)), by_word.shape[1])])
    weights, lean = np.zeros((BUCKETS + 1, n)), 1.0
    start, moves = np.zeros(n), np.zeros((n, n))
    gold_start = np.bincount(gold[first], minlength=n)
    inner = ~first
    gold_moves = np.bincount(gold[:-1][inner[1:]] * n + gold[1:][inner[1:]], minlength=n * n).reshape(n, n)
    past = [np.full_like(weights, 1e-8), 1e-8, np.full(n, 1e-8), np.full((n, n), 1e-8)]
    eye = np.eye(n)
    for _ in range(epochs):
        scores = weighed(weights, places) + lean * table
        gamma, moved = Chain(start, moves).posteriors(scores[flat], first, pairs=True)
        miss = eye[gold] - gamma
        d_word = np.stack([np.bincount(flat, miss[:, k], len(words)) for k in range(n)], axis=1)
        d_weights = np.stack([np.bincount(feature, d_word[owner, k], BUCKETS + 1) for k in range(n)], axis=1) - 0.05 * weights
        d_weights[BUCKETS] = 0
        slopes = [d_weights, float((d_word * table).sum()), gold_start - gamma[first].sum(axis=0) - 0.1 * start,
                  gold_moves - moved - 0.1 * moves]
        steps = []
        for k, g in enumerate(slopes):
            past[k] = past[k] + g * g
            steps.append(0.3 * g / np.sqrt(past[k]))
        weights, lean, start, moves = weights + steps[0], lean + steps[1], start + steps[2], moves + steps[3]
    kept = np.flatnonzero(known).tolist()
    lexicon = {words[i]: row for row, i in enumerate(kept, 1)}
    return Model(labels, weights, lexicon, np.concatenate([np.zeros((1, n)), lean * table[kept]]), start, moves)


#: In Latin-1: letters in lower case, all else a space.
_LETTERS = bytes(ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def raw_words(text: str | None) -> list:
    """Lower-case runs of letters, cut into pieces: Latin-1 bytes where the text allows it, which is much faster, else strings."""
    if not text:
        return []
    try:
        words = text.encode("latin-1").translate(_LETTERS).split()
    except UnicodeEncodeError:
        words = WORD.findall(text.lower())
    if words and max(map(len, words)) > LONGEST_WORD:
        words = [w[i:i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    return words


def shown(word) -> str:
    return word.decode("latin-1") if isinstance(word, bytes) else word


def words_of(text: str | None) -> list[str]:
    return [shown(w) for w in raw_words(text)]


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          docs_per_lang: int = 300, windows: int = 8000) -> Model | None:
    """Fit on a bounded sample of rows with a label; None if no labelled row has a word.

    Only narrow columns are ranked; the texts of the chosen rows come by a join on their ids.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(key).isNotNull())
    near = Window.partitionBy("lang").orderBy("draw", "key")
    chosen = (rows.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.lit(11)).alias("draw"))
              .withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= docs_per_lang).select("key").distinct())

    def cut(batches):
        for batch in batches:
            out = [(label, " ".join(w[i:i + WINDOW]), zlib.crc32(f"{k}:{i}".encode()))
                   for k, t, label in zip(*(c.to_pylist() for c in batch.columns)) for w in [words_of(t)]
                   for i in range(0, len(w), WINDOW)]
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], kind) for j, kind in
                                              enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "words", "draw"])

    source = rows.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    languages = rows.select(lang).distinct().count()
    share = Window.partitionBy("lang").orderBy("draw", "words")
    sample = (source.join(chosen, "key", "left_semi").select("key", "text", "lang").mapInArrow(cut, "lang string, words string, draw long")
              .withColumn("nth", F.row_number().over(share)).where(F.col("nth") <= max(1, windows // max(1, languages)))
              .orderBy("draw", "words", "lang").select("lang", "words").collect())
    if not sample:
        return None
    return fit(sorted({r.lang for r in sample}), [(r.lang, r.words.split(" ")) for r in sample])


class Tagger:
    """Language and score of texts, with the emissions of words seen so far."""

    def __init__(self, model: Model):
        self.model, self.chain = model, Chain(model.start, model.transitions)
        self.forget()

    def forget(self):
        self.at: dict = {}
        self.scores = np.zeros((0, len(self.model.labels)))

    def tag(self, word_lists):
        """(label, score) of each list of words; (``und``, 0) of an empty one."""
        return [found[:2] for found in self.judged(word_lists)]

    def judged(self, word_lists):
        """(label, score, claimed) of each list of words.

        Words of a known language are certain of theirs, also where a text switches languages; those
        of none are torn between all. A text of a few words is no evidence against it.
        """
        new = set().union(*word_lists).difference(self.at)
        if new and len(self.at) + len(new) > CACHE_WORDS:
            self.forget()
            new = set().union(*word_lists)
        if new:
            new = list(new)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.scores = np.concatenate([self.scores, self.model.emissions([shown(w) for w in new])])
        sizes = np.fromiter(map(len, word_lists), np.int64, len(word_lists))
        out = [(UNKNOWN, 0.0, False)] * len(word_lists)
        full = np.flatnonzero(sizes)
        if len(full):
            flat = np.fromiter(map(self.at.__getitem__, chain.from_iterable(word_lists)), np.int64, int(sizes.sum()))
            heads = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            first = np.zeros(len(flat), bool)
            first[heads] = True
            by_word = self.chain.posteriors(self.scores[flat], first)
            mass = np.add.reduceat(by_word, heads, axis=0) / sizes[full][:, None]
            certain = np.add.reduceat(by_word.max(axis=1), heads) / sizes[full]
            claimed = (certain >= CERTAIN) | (sizes[full] < ENOUGH_WORDS)
            for i, best, row, ok in zip(full.tolist(), mass.argmax(axis=1).tolist(), mass, claimed.tolist()):
                out[i] = (self.model.labels[best], min(1.0, float(row[best])), ok)
        return out

    def texts(self, texts, judged: bool = False):
        tag = self.judged if judged else self.tag
        held, size = [], 0
        for text in texts:
            words = raw_words(text)
            if held and size + len(words) > SLICE:
                yield from tag(held)
                held, size = [], 0
            held.append(words)
            size += len(words)
        if held:
            yield from tag(held)


def predict(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", keep: tuple = (), claimed: bool = False) -> DataFrame:
    """One row per input row: the key, ``keep`` columns, ``lang_pred`` and ``score`` (0 to 1).

    With ``claimed`` also whether the model takes the text for one of a language it knows, which no
    text without a letter is; without a model there is nothing against a text that has letters.

    ``lang_pred`` is ``und``, score 0, for null and empty texts, for texts without a letter, and for
    all if there is no model. Repeated rows are answered each; columns not named are not read.
    """
    types = dict(df.dtypes)
    names = list(dict.fromkeys([key, *keep]))
    inside = [f"c{i}" for i in range(len(names))]

    def run(batches):
        tagger = Tagger(model) if model else None
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            found = list(tagger.texts(texts, judged=True)) if tagger else [(UNKNOWN, 0.0, bool(raw_words(t))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())],
                names=[*inside, "lang_pred", "score", "claimed"])

    source = df.select(*(F.col(c).alias(i) for c, i in zip(names, inside)), F.col(text).cast("string").alias("text_in"))
    schema = ", ".join([f"{i} {types[c]}" for c, i in zip(names, inside)] + ["lang_pred string", "score double", "claimed boolean"])
    out = source.mapInArrow(run, schema)
    return out.select(*(F.col(i).alias(c) for c, i in zip(names, inside)), "lang_pred", "score",
                      *(["claimed"] if claimed else []))
