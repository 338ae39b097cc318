"""Very long texts, empty tables, and two texts under one id, for the operators whose own tests lack them."""

import hashlib
import random

import corpus_pipeline as pipeline
from listwise.llm import fingerprints, langid, lines, neardup, scoring, warc
from listwise.llm.common import own_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def words(n, seed=1):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_long_text_loses_its_recurring_lines(spark):
    body = "\n".join(f"own line {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)} of this text alone" for k in range(17000))
    common = "this very line stands in all of them"
    rows = [(1, common)] + [(k, f"{common}\nother {chr(97 + k)} text") for k in range(2, 7)] + [(9, body + "\n" + common)]
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9].text == body and got[9].n_dropped == 1 and got[1].n_dropped == 0 and got[9].n_lines == 17001


def test_passages_of_long_and_empty(spark):
    shared = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)) + ". "
    rows = [(k, f"Here begins text {chr(97 + k)}. " + shared + f"And here ends {chr(97 + k)}.") for k in range(6)]
    rows.append((50, " ".join(words(100000)) + ". " + shared + "The end of the long one."))
    got = {r.doc_id: r for r in lines.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_dropped == 0 and shared.strip() not in got[50].text and got[50].text.endswith("The end of the long one.")
    assert all(got[k].n_dropped == 1 for k in range(1, 6))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedup_passages(empty).count() == 0 == lines.dedup_lines(empty).count()


def test_long_page_in_an_archive(spark):
    html = "<p>" + "é0" * 2_000_000
    pages = spark.createDataFrame([(1, "http://a.b/c", html), (2, "http://a.b/d", html), (3, None, None)], "page_id long, url string, html string")
    folder = own_dir(spark, "warc")
    shards = warc.index(warc.write(pages, folder), folder)
    got = {r.page: r for r in warc.read(warc.lookup(warc.surts(pages), shards, folder), folder).collect()}
    digest = hashlib.sha256(html.encode()).hexdigest()
    assert bytes(got["1"].payload).decode() == html and got["2"].refers_to == "1" and got["1"].payload_digest == got["2"].payload_digest == digest


def test_long_text_is_scored_whole(spark):
    long = " ".join(words(300000))
    got = {r.doc_id: r for r in scoring.score_texts(spark.createDataFrame([(1, long), (2, "w1 w2"), (3, None)], "doc_id long, text string")).collect()}
    assert got[1].n_tokens == 300001 and got[1].n_known == 300001 and got[1].score < got[2].score < 0


def test_long_near_copies_and_sketches(spark):
    one = words(100000)
    other = list(one)
    for k in range(0, len(other), 40):
        other[k] = "changed"
    rows = [(5, " ".join(one)), (6, " ".join(other)), (7, " ".join(words(100000, 2))), (8, " ".join(one[:3]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    assert got == {5: (5, True), 6: (5, False), 7: (7, True), 8: (8, True)}
    sketched = {r.doc_id: r for r in fingerprints.compare_edited(df).collect()}
    assert sketched[6].n_chars == len(" ".join(other)) and sketched[6].near_next > 0.5


def test_two_texts_under_one_id(spark):
    text, near = words(200, 3), words(200, 3)
    near[100] = "changed"
    other = words(200, 4)
    rows = [(1, " ".join(text)), (2, " ".join(other)), (2, " ".join(near)), (3, " ".join(other)), (None, " ".join(text)), (None, "alone here with these words"), (2, " ".join(other))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    left = sorted(((r.doc_id or 0, r.text) for r in pipeline.near_dedup(spark, docs, SF).collect()))
    assert len(left) == 3 and [t for _, t in left].count(" ".join(other)) == 1 and (0, "alone here with these words") in left
    assert sum(t in (" ".join(text), " ".join(near)) for _, t in left) == 1
    kept = neardup.near_duplicates(docs).collect()
    # By id alone both texts of id 2 are one document, which links 3 to 1.
    assert len(kept) == len(rows) and {r.component_id for r in kept if r.doc_id == 3} == {1}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    model = langid.learn(spark.createDataFrame([(1, "the thing with that", "en", "s", 1), (2, "que para los", "es", "s", 1)], DOCS))
    assert langid.predict(empty, model).count() == 0
    docs = empty
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name
