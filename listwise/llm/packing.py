"""Sum-of-squares packing of token streams into windows of a fixed size.

A document longer than a window fills whole windows first. Its rest goes, online, to the fill level
at which the sum of the squared counts of partly filled windows becomes smallest (Csirik et al.);
the counts stand in a level array. Documents may be cut, so of the windows still open at the end of a
partition, or whenever ``open_limit`` are open, the fullest stay as they were packed, and the emptiest are
dissolved to fill their gaps; the last tokens are cut at powers of two, which need no padding.

Each partition packs on its own: no shuffle, and memory is bounded by ``open_limit`` windows.
"""

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 2048
OPEN_LIMIT = 4096
CACHE_WORDS = 1_000_000
#: Runs that a worker process keeps from task to task, the first it saw, which are the frequent ones; all others go with the task.
KEPT_RUNS = 500_000
#: Sequence numbers of one partition start at its index times this.
PER_PARTITION = 1 << 36


class Encoder:
    """Ids of whole texts, looked up by runs without white space.

    The tokenizer drops white space and never merges over it, so the ids of a text are those of its
    runs; runs not yet seen are encoded by the tokenizer itself, many at once with a lone digit
    between them, whose id no other run can give. It lower-cases, and always cuts between a letter
    or digit and the punctuation after it: texts of Latin letters are lower-cased and cut there
    first, so that fewer runs differ.
    """

    #: Lower case within Latin-1, byte by byte.
    _LOWER = bytes(b if b in (0xAA, 0xBA) else ord(chr(b).lower()) for b in range(256))
    #: Punctuation (in Latin-1: neither letter, digit nor white space) before a comma or full stop.
    _PUNCTUATION = re.compile(b"[" + re.escape(bytes(b for b in range(256) if not chr(b).isalnum() and not chr(b).isspace())) + b"][.,]")
    #: White space to ``str.split`` but not to the tokenizer.
    _SEPARATORS = re.compile(r"[\x1c-\x1f]")
    _RUNS = re.compile(r"[^\x20\t\n\r]+")
    GROUP = 256

    def __init__(self, path: str, end_id: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.digit, = self.tokenizer.encode("0", add_special_tokens=False).ids
        self.seen: dict = {}

    def trim(self, kept_runs: int) -> None:
        if len(self.seen) > kept_runs:
            self.seen = dict(islice(self.seen.items(), kept_runs))

    def runs(self, text: str | None) -> list:
        if not text:
            return []
        try:
            latin = text.encode("latin-1").translate(self._LOWER)
        except UnicodeEncodeError:
            return self._RUNS.findall(text) if self._SEPARATORS.search(text) else text.split()
        if not self._PUNCTUATION.search(latin):
            latin = latin.replace(b",", b" ,").replace(b".", b" .")
        return latin.split()

    def learn(self, runs) -> None:
        shown = {r: r.decode("latin-1") if isinstance(r, bytes) else r for r in runs}
        plain = [r for r, text in shown.items() if "0" not in text]
        for start in range(0, len(plain), 1000):
            part = plain[start:start + 1000]
            text = " 0 ".join(shown[r] for r in part) + " 0"
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            over = 0
            for run, end in zip(part, np.flatnonzero(ids == self.digit).tolist()):
                self.seen[run] = ids[over:end].tobytes()
                over = end + 1
        other = [r for r, text in shown.items() if "0" in text]
        for run, e in zip(other, self.tokenizer.encode_batch_fast([shown[r] for r in other], add_special_tokens=False)):
            self.seen[run] = np.array(e.ids, "<u4").tobytes()

    def batch(self, texts):
        """For each text its ids as little-endian bytes, with the end id."""
        for start in range(0, len(texts), self.GROUP):
            split = [self.runs(t) for t in texts[start:start + self.GROUP]]
            needed = set().union(*split)
            missing = needed.difference(self.seen)
            if missing and len(self.seen) + len(missing) > CACHE_WORDS:
                self.seen.clear()
                missing = needed
            self.learn(missing)
            for words in split:
                yield b"".join(map(self.seen.__getitem__, words)) + self.end


_ENCODERS: dict = {}


def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of a worker process, which keeps frequent runs from task to task."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


class Levels:
    """The level array: how many windows are open at each fill, and which."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def place(self, size: int) -> list | None:
        """Put a piece of ``size`` < window; the window that it filled, if any, else None.

        Going from fill h to h + size changes the sum of squares by 2 N(h + size) + 1 and, unless the
        window is new, -2 N(h) + 1; a full window counts as nothing. Ties go to the fullest window.
        """
        n = self.count
        after = 2 * n[size:] + 1
        after[-1] = 0
        change = after.copy()
        change[1:] += 1 - 2 * n[1:self.window + 1 - size]
        change[1:][n[1:self.window + 1 - size] == 0] = np.iinfo(np.int64).max
        level = len(change) - 1 - int(np.argmin(change[::-1]))
        if level:
            pieces = self.open[level].pop()
            n[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        if level + size < self.window:
            self.open[level + size].append(pieces)
            n[level + size] += 1
            self.n_open += 1
        self.full = level + size == self.window
        return pieces

    def drain(self) -> list[tuple[int, list]]:
        """(fill, pieces) of all open windows, fullest first; afterwards none is open."""
        windows = [(fill, pieces) for fill in range(self.window - 1, 0, -1) for pieces in self.open[fill]]
        self.__init__(self.window)
        return windows


def laid_out(windows: list, window: int, last: bool):
    """Sequences without gaps from open windows (fill, pieces), fullest first, where a piece is (doc, start, ids, total).

    As many windows as the tokens fill keep what was placed in them, the fullest ones; the others are dissolved, and
    their pieces, cut where needed, fill the gaps. What is left over is cut at powers of two if ``last``, else returned.
    """
    total = sum(fill for fill, _ in windows)
    kept = windows[:total // window]
    queue = [p for _, pieces in reversed(windows[len(kept):]) for p in reversed(pieces)]

    def cut(need):
        out = []
        while need:
            doc, start, ids, size = queue.pop()
            take = min(need, len(ids) // 4)
            out.append((doc, start, ids[:4 * take], size))
            if 4 * take < len(ids):
                queue.append((doc, start + take, ids[4 * take:], size))
            need -= take
        return out

    sequences = [pieces + cut(window - fill) for fill, pieces in kept]
    left = total % window
    while last and left:
        size = 1 << (left.bit_length() - 1)
        sequences.append(cut(size))
        left -= size
    return sequences, queue[::-1]


def packed(docs, window: int, open_limit: int):
    """Rows (doc, start, ids, total, sequence, offset) of one partition of (doc, ids)."""
    levels, number = Levels(window), 0

    def rows(sequence, number):
        offset = 0
        for doc, start, ids, total in sequence:
            yield doc, start, ids, total, number, offset
            offset += len(ids) // 4

    for doc, ids in docs:
        total = len(ids) // 4
        whole = total - total % window
        for start in range(0, whole, window):
            yield doc, start, ids[4 * start:4 * (start + window)], total, number, 0
            number += 1
        if total > whole:
            pieces = levels.place(total - whole)
            pieces.append((doc, whole, ids[4 * whole:], total))
            if levels.full:
                yield from rows(pieces, number)
                number += 1
            elif levels.n_open > open_limit:
                sequences, left = laid_out(levels.drain(), window, False)
                for s in sequences:
                    yield from rows(s, number)
                    number += 1
                if left:
                    levels.place(sum(len(p[2]) for p in left) // 4).extend(left)
    for s in laid_out(levels.drain(), window, True)[0]:
        yield from rows(s, number)
        number += 1


def pack(df: DataFrame, tokenizer_path: str, end_id: int = 1, key: str = "doc_id", text: str = "text",
         window: int = WINDOW, open_limit: int = OPEN_LIMIT,
         kept_runs: int = KEPT_RUNS) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone. Repeated rows are packed each, a null key stays null,
    no other column is read, an empty table gives no rows. ``tokenizer_path`` must exist on every
    executor. A run again over the same partition gives the same rows. A worker keeps ``kept_runs``
    encoded runs for its next task; with 0 it keeps nothing, not even the tokenizer.
    """
    kind = df.schema[key].dataType.simpleString()
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
              ("sequence_id", pa.int64()), ("offset", pa.int64())]

    def run(batches):
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() * PER_PARTITION
        ids_of, kinds = encoder(tokenizer_path, end_id), []

        def docs():
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type]
                yield from zip(batch.column(0).to_pylist(), ids_of.batch(batch.column(1).to_pylist()))

        def out(rows):
            doc, start, ids, total, number, offset = zip(*rows)
            arrays = [pa.array(doc, kinds[0]), pa.array(start, pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                      pa.array(ids, pa.binary()), pa.array(total, pa.int64()),
                      pa.array([base + n for n in number], pa.int64()), pa.array(offset, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["key"] + [f[0] for f in fields])

        held = []
        for row in packed(docs(), window, open_limit):
            held.append(row)
            if len(held) == 2000:
                yield out(held)
                held = []
        if held:
            yield out(held)
        ids_of.trim(kept_runs)
        if not kept_runs:
            _ENCODERS.clear()
            pa.default_memory_pool().release_unused()

    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)
