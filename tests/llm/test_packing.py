import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from listwise.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["aZ0'sé́ \t\x1c\x1f\u2003İΣ<|endoftext|>\u3000日本०²🙂\x0b\x85-", "aZ0's é.,,._!µªº²¼ß\xa0ÀÿÖ×÷"]


def test_ids_are_the_tokenizers():
    rng = random.Random(3)
    texts = ["".join(rng.choice(a) for _ in range(60)) for a in ODD for _ in range(500)] + ["", " ", "0", "0 0", "a.b , c", None, "<|endoftext|>x"]
    tokenizer = Tokenizer.from_file(PATH)
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.Encoder(PATH, 1).batch(texts)]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_level_is_that_of_least_squares():
    rng = random.Random(5)
    levels = packing.Levels(16)
    for _ in range(400):
        size, n = rng.randint(1, 15), levels.count.copy()

        def squares(h):
            m = n.copy()
            m[h] -= h > 0
            m[h + size] += h + size < 16
            return int((m[1:16] ** 2).sum())

        choices = [h for h in range(0, 17 - size) if h == 0 or n[h]]
        best = min(choices, key=lambda h: (squares(h), -h))
        levels.place(size)
        after = n.copy()
        after[best] -= best > 0
        after[best + size] += best + size < 16
        assert (levels.count[1:16] == after[1:16]).all()


def check(pieces, docs, window):
    by_doc, by_sequence = {}, {}
    for doc, start, ids, total, number, offset in pieces:
        by_doc.setdefault(doc, []).append((start, ids, total))
        by_sequence.setdefault(number, []).append((offset, len(ids) // 4))
    assert {d: b"".join(i for _, i, _ in sorted(p)) for d, p in by_doc.items()} == docs
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == window or at & (at - 1) == 0
    for p in by_doc.values():
        at = 0
        for start, ids, total in sorted(p):
            assert start == at
            at += len(ids) // 4
        assert at == total


def test_every_id_once_without_gaps():
    rng = random.Random(7)
    docs = {i: np.arange(rng.choice([1, 5, 63, 64, 65, 200, rng.randint(1, 300)]), dtype="<u4").tobytes() for i in range(600)}
    for limit in (3, 1000):
        check(list(packing.packed(docs.items(), 64, limit)), docs, 64)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b", 0), (3, "word " * 5000, 0), (3, "word " * 5000, 0)],
                               "doc_id long, text string, start int")
    rows = packing.pack(df, PATH).collect()
    assert sum(r.length for r in rows) == 1 + 1 + 3 + 2 * 5001
    assert all(len(r.ids) == 4 * r.length for r in rows)
    assert {r.doc_tokens for r in rows if r.doc_id == 1} == {1}
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_most_tokens_stay_where_they_were_placed(spark):
    """Of the tokens that the level array placed, those of dissolved windows move: the share over the documents of sf0.1 in two partitions."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    sizes = [len(ids) // 4 % packing.WINDOW for ids in packing.Encoder(PATH, 1).batch(texts)]
    for part in (sizes[::2], sizes[1::2]):
        levels, placed = packing.Levels(packing.WINDOW), 0
        for size in part:
            if size:
                levels.place(size).append((0, 0, b"\0" * 4 * size, size))
                placed += size
        windows = levels.drain()
        left = sum(fill for fill, _ in windows)
        moved = sum(fill for fill, _ in windows[left // packing.WINDOW:])
        assert moved < 0.15 * placed, (moved, placed)
        # The kept windows begin with the pieces that were placed in them.
        sequences, _ = packing.laid_out(windows, packing.WINDOW, True)
        assert all(s[:len(pieces)] == pieces for s, (_, pieces) in zip(sequences, windows[:left // packing.WINDOW]))


def test_runs_kept_from_task_to_task_change_no_row(spark):
    docs = spark.createDataFrame([(i, f"word{i} and word{i % 7}, again.") for i in range(300)], "doc_id long, text string").repartition(5, "doc_id")
    kept, fresh = (sorted(map(tuple, packing.pack(docs, PATH, kept_runs=n).collect())) for n in (500_000, 0))
    assert len(kept) >= 300 and kept == fresh
    known = packing.Encoder(PATH, 1)
    known.learn(["a", "b", "c"])
    known.trim(2)
    assert list(known.seen) == ["a", "b"]
