import random
import re
from itertools import combinations

from listwise.llm import decontaminate as dec


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def best(doc, item):
    """Most equal tokens of an item's window on any diagonal."""
    d, t = tokens(doc), tokens(item)
    width = min(len(t), dec.WINDOW)
    most = 0
    for shift in range(-len(t), len(d) + 1):
        same = [0 <= j + shift < len(d) and d[j + shift] == w for j, w in enumerate(t)]
        most = max([most, *(sum(same[s:s + width]) for s in range(len(t) - width + 1))])
    return (most, width) if width and most >= dec.LEAST * width else None


def test_against_all_diagonals(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + rng.choice("pq")
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((5, 7, 9, 15, 30, 60, 61))]
    items += [(8, items[4][1]), (9, None), (10, "")]
    docs = []
    for k in range(80):
        body = [word() for _ in range(rng.randint(0, 60))]
        if k % 2:
            part = tokens(items[rng.randrange(1, 7)][1])
            for _ in range(rng.randint(0, len(part) // 3)):
                part[rng.randrange(len(part))] = "other"
            at = rng.randint(0, len(body))
            body[at:at] = part[rng.randint(0, len(part) // 3):]
        docs.append((k, (", " if k % 3 else " ").join(body).upper()))
    docs += [(100, None), (101, ""), (102, items[3][1]), (102, items[3][1])]
    got = dec.overlaps(spark.createDataFrame([d + ("c", "c") for d in docs], "doc_id long, text string, item string, seed string"),
                       spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(d, i): b for d, text in docs for i, t in items if (b := best(text, t))}
    assert {(r.doc_id, r.item_id): (r.n_equal, r.n_compared) for r in got} == want and len(got) == len(want)
    assert len(want) > 20


def test_shuffled_way_and_filter(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "nothing of the kind is here at all"), (None, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Alpha, beta gamma XXX epsilon zeta eta theta")], "item_id long, text string")
    assert [r.doc_id for r in dec.without_overlaps(docs, items).orderBy("doc_id").collect()] == [None, 2]
    monkeypatch.setattr(dec, "BROADCAST_SEEDS", 0)
    assert [r.doc_id for r in dec.overlaps(docs, items).collect()] == [1]
    assert dec.overlaps(docs, items.limit(0)).count() == 0 and dec.overlaps(docs.limit(0), items).count() == 0


def test_every_pattern_leaves_a_mask():
    """Of each width all patterns of as many substitutions as the threshold allows; fewer are parts of these."""
    for width in range(1, dec.WINDOW + 1):
        miss, masks = dec.misses(width), dec.masks(width)
        assert 1 <= len(masks) <= dec.MASKS and width - miss >= dec.LEAST * width > width - miss - 1
        # A mask ignores a place wherever a token may differ.
        assert all((len(m) < m[-1] + 1) == bool(miss) for m in masks)
        places = [sum(1 << (p + at) for p in m) for m in masks for at in range(width - m[-1])]
        for gone in combinations(range(width), miss):
            pattern = sum(1 << p for p in gone)
            assert any(not pattern & bits for bits in places), (width, gone)


def test_wider_windows_are_covered():
    rng = random.Random(2)
    for width in (23, 32, 50):
        masks, miss = dec.masks(width), dec.misses(width)
        for _ in range(300):
            gone = set(rng.sample(range(width), miss)) if rng.random() < .5 else set(range(rng.randint(0, 3), width, 4))
            assert any(all(p + at not in gone for p in m) for m in masks for at in range(width - m[-1])) or len(gone) > miss


def test_long_texts_and_texts_of_one_key(spark, monkeypatch):
    """A document of 100,000 words, with few and with many seeds; two texts under one key and under none are judged each by itself."""
    item = "one swift brown fox jumps over some lazy dog near that old river bank while seven gulls watch from above"
    words = [f"w{k % 977}x{k % 89}" for k in range(100000)]
    part = item.split()
    part[4] = part[9] = "other"
    words[70000:70000] = part
    rows = [(1, " ".join(words)), (2, "clean text of the second key"), (2, "so it is said: " + item), (None, item), (None, "clean"), (3, None)]
    docs = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], "doc_id long, text string, shift int, key string, item string")
    items = spark.createDataFrame([(1, item), (1, None), (2, " ".join(f"w{k % 977}x{k % 89}" for k in range(500, 560)))], "item_id long, text string")
    for limit in (dec.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(dec, "BROADCAST_SEEDS", limit)
        monkeypatch.setattr(dec, "BROADCAST_DOCS", limit)
        got = {(r.doc_id, r.item_id): (r.n_equal, r.n_compared) for r in dec.overlaps(docs, items).collect()}
        assert got == {(1, 1): (len(part) - 2, len(part)), (1, 2): (20, 20), (2, 1): (len(part), len(part)), (None, 1): (len(part), len(part))}
        left = dec.without_overlaps(docs, items)
        assert left.columns == docs.columns
        assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, "clean"), (2, "clean text of the second key"), (3, "")]


def test_against_all_diagonals_without_seeds(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    sizes = (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 16, 20, 21, 45, 60)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate(sizes)] + [(50, ""), (51, None), (52, "...")]
    docs = []
    for k, (i, text) in enumerate(items[:len(sizes)] * 6):
        part = text.split()
        width = min(len(part), dec.WINDOW)
        if k < 2 * len(sizes):  # every 4th token is another
            for j in range(1 + k // len(sizes), len(part), 4):
                part[j] = "other"
        else:  # as many others as the threshold allows, and one more
            for j in rng.sample(range(len(part)), min(len(part), width // 4 + k % 2)):
                part[j] = "other"
        docs.append((k, " ".join([word() for _ in range(rng.randint(0, 8))] + part + [word() for _ in range(rng.randint(0, 8))])))
    got = dec.overlaps(spark.createDataFrame(docs + [(200, None), (201, "")], "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(d, i): b for d, text in docs for i, t in items if (b := best(text, t))}
    assert {(r.doc_id, r.item_id): (r.n_equal, r.n_compared) for r in got} == want and len(got) == len(want)
    assert {sizes[i] for _, i in want} == set(sizes)
