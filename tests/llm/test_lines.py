from collections import Counter, defaultdict

from listwise.llm import lines as ln


def brute(rows):
    """The rule on one machine: rows (key, text) with distinct keys."""
    occurrences = [(k, n, tuple(ln.masked(x))) for k, t in rows if t for n, x in enumerate(t.split("\n")) if x.split()]
    leaf = lambda x: (len(x), x[:ln.DEPTH])
    docs_of, support = defaultdict(set), Counter()
    for k, _, x in occurrences:
        docs_of[x].add(k)
    leaves = Counter()
    for x, d in docs_of.items():
        leaves[leaf(x)] += len(d)
        for p, token in enumerate(x):
            support[leaf(x), p, token] += len(d)
    template = {}
    for x in docs_of:
        if leaves[leaf(x)] >= ln.MIN_DOCS:
            rare = [support[leaf(x), p, token] < ln.MIN_DOCS for p, token in enumerate(x)]
            if sum(rare) <= ln.VARIABLE * len(x):
                template[x] = (leaf(x), tuple(ln.ANY if r else token for r, token in zip(rare, x)))
    first, docs = {}, defaultdict(set)
    for k, n, x in sorted(occurrences):
        if x in template:
            first.setdefault(template[x], (k, n))
            docs[template[x]].add(k)
    dropped = defaultdict(set)
    for k, n, x in occurrences:
        if x in template and len(docs[template[x]]) >= ln.MIN_DOCS and first[template[x]] != (k, n):
            dropped[k].add(n)
    return {k: (sum(bool(x.split()) for x in t.split("\n")) if t else 0, len(dropped[k]),
                None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in dropped[k])) for k, t in rows}


def corpus():
    rows = []
    for k in range(40):
        own = [f"{'abcdefghijklmnopqrstuvwxyz'[k % 26] * (k + 1)} has its own words in this document"]
        own.append(f"Posted on {k} May by user u{k}")
        own.append("Shared by our reader " + "xyzw"[k % 4] * (k + 1) + " with all of our friends")
        if k < 4:
            own.append("seen in four documents only")
        if k % 2:
            own.append("All rights reserved.")
        if k % 5 == 0:
            own += ["", "All rights  reserved. ", "All rights reserved."]
        rows.append((k, "\n".join(own)))
    return rows + [(50, None), (51, ""), (52, "\n \n"), (53, "All rights reserved."), (54, "All rights reserved.\n" * 5000)]


def test_against_the_rule(spark):
    rows = corpus()
    df = spark.createDataFrame([r + (1, 2) for r in rows], "doc_id long, text string, line long, mark int").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in ln.dedup_lines(df).collect()}
    assert got == brute(rows)
    assert sum(g[1] for g in got.values()) > 5000


def test_variable_fields_are_generalised(spark):
    got = {r.doc_id: r.text for r in ln.dedup_lines(spark.createDataFrame(corpus(), "doc_id long, text string")).collect()}
    assert "Posted on 0 May" in got[0] and "Posted" not in got[7]
    assert "Shared" in got[0] and "Shared" not in got[9] and "own words" in got[9]
    assert "four documents" in got[3]


def test_odd_rows(spark):
    text = "the very same line\nand another one"
    df = spark.createDataFrame([(None, text)] * 3 + [(k, text) for k in range(6)] + [(3, text), (3, "other text")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped) for r in ln.dedup_lines(df, keep=("doc_id",)).collect())
    assert got == sorted([("None", 0, 0)] * 3 + [("0", 2, 0)] + [(str(k), 2, 2) for k in (1, 2, 3, 3, 4, 5)] + [("3", 1, 0)])
    assert ln.dedup_lines(df.limit(0)).count() == 0


def test_passages_inside_lines(spark):
    shared = "It was a long and quiet day by the sea. Nobody came to see the boats go out that morning. We sat there until the evening and then went home."
    own = [f"This is what document {'abcdefghij'[k] * 4} has to say of itself." for k in range(8)]
    rows = [(k, f"{own[k]} {shared} And {own[k]}\nThe end {'abcdefghij'[k]}") for k in range(6)]
    rows += [(6, f"{own[6]} {shared.split('. ')[0]}. And more.\nlast"), (7, f"{own[7]} half {shared.replace('. ', '.' + chr(10), 1)} And so on"),
             (None, shared), (9, None), (10, ""), (11, "A line of its own.")]
    got = {r.doc_id: (r.n_dropped, r.text, r.x) for r in ln.dedup_passages(
        spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, x int"), keep=("x",)).collect()}
    want = {k: (0, t, 1) for k, t in rows}
    for k in range(1, 6):
        want[k] = (3, f"{own[k]} And {own[k]}\nThe end {'abcdefghij'[k]}", 1)
    assert got == want
    few = spark.createDataFrame(rows[:4], "doc_id long, text string")
    assert {r.n_dropped for r in ln.dedup_passages(few).collect()} == {0}
