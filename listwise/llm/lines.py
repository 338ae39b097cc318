"""Line deduplication by a log-template tree.

A line's path in the tree is its number of tokens and its first ``DEPTH`` tokens; tokens with a digit
are variable from the start. In a leaf, a token that fewer than ``MIN_DOCS`` documents have at its
position is variable too, and a line whose tokens are at most ``VARIABLE`` variable falls under the
template of its other tokens. A template of ``MIN_DOCS`` documents or more recurs: its line in the
smallest document stays, all its others are dropped.

Leaves are counted, never gathered: the tree is a key, positions are rows, and lines that share a
template meet by its hash. Only lines of leaves that ``MIN_DOCS`` documents share are read a second
time, one for each distinct line.

A passage inside a line, or across lines that also hold a document's own words, is no line of the
tree. ``dedup_passages`` finds it by another method, hashes of sentences: stretches of whole sentences with ``PASSAGE`` tokens or
more that ``MIN_DOCS`` documents share stay in the smallest document and are dropped from all others.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from listwise.llm.common import discard, written

DEPTH = 4
MIN_DOCS = 5
VARIABLE = 0.3
#: Tokens of a stretch of sentences that counts as a passage.
PASSAGE = 25
#: Where sentences end: after a line, and after a mark and a space. Java and Python read it alike.
SENTENCE = "(?<=\n)|(?<=[.!?] )"
ANY = "<*>"
_DIGITS = re.compile(r"\S*[0-9]\S*")
_HAS_DIGIT = re.compile(r"[0-9]")


def masked(line: str) -> list[str]:
    """Tokens of a line, those with a digit as the variable mark."""
    if _HAS_DIGIT.search(line):
        line = _DIGITS.sub(ANY, line)
    return line.split()


def _hash(text: str) -> int:
    import xxhash
    return int.from_bytes(xxhash.xxh3_64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)


def _lines(docs: DataFrame) -> DataFrame:
    """(key, mark, line_no, leaf, line) of every line that is not blank."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows, numbers, leaves, lines = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for number, line in enumerate(text.split("\n") if text else ()):
                    tokens = masked(line)
                    if tokens:
                        rows.append(i)
                        numbers.append(number)
                        leaves.append(_hash(f"{len(tokens)} " + " ".join(tokens[:DEPTH])))
                        lines.append(_hash(" ".join(tokens)))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int32()),
                                              pa.array(leaves, pa.int64()), pa.array(lines, pa.int64())],
                                             names=["key", "mark", "line_no", "leaf", "line"])

    return docs.select("key", "mark", "text").mapInArrow(run, f"key {kind}, mark long, line_no int, leaf long, line long")


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple = (), min_docs: int = MIN_DOCS,
                variable: float = VARIABLE) -> DataFrame:
    """One row per input row: key, ``keep`` columns, n_lines, n_dropped, and the text without dropped lines.

    ``n_lines`` counts lines that are not blank; blank lines stay. A null text stays null with no
    lines. Rows of one key and text are one document and lose the same lines; rows of one key with
    other texts are other documents; the smallest document is that with the smallest key, then hash. A
    row with a null key keeps its lines, which count for no other. Columns not named are not read.
    """
    names = list(dict.fromkeys(c for c in keep if c not in (key, text)))
    docs = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text).cast("string")).alias("mark"), F.col(text).cast("string").alias("text"),
                     *(F.col(c).alias(f"_{i}") for i, c in enumerate(names)))
    lines = written(_lines(docs).where("key IS NOT NULL"), "lines")
    per_doc = lines.groupBy("leaf", "line", "key", "mark").agg(F.min("line_no").alias("line_no"))
    per_line = per_doc.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.min(F.struct("key", "mark", "line_no")).alias("first"))
    shared = per_line.groupBy("leaf").agg(F.sum("n").alias("support")).where(F.col("support") >= min_docs).select("leaf")
    open_lines = written(per_line.join(shared, "leaf").select("leaf", "line", "n", "first.key", "first.mark", "first.line_no"), "open-lines")

    # The tokens of one line for each distinct masked line of a shared leaf.
    needed = open_lines.groupBy("key", "mark").agg(F.collect_list(F.struct("line_no", "leaf", "line", "n")).alias("wanted"))
    texts = docs.select("key", "mark", "text").dropDuplicates(["key", "mark"]).join(needed, ["key", "mark"])

    def cut(batches):
        for batch in batches:
            out = []
            for body, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                parts = body.split("\n")
                out += [(w["leaf"], w["line"], w["n"], masked(parts[w["line_no"]])) for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())))], names=["leaf", "line", "n", "tokens"])

    tokens = written(texts.select("text", "wanted").mapInArrow(cut, "leaf long, line long, n long, tokens array<string>"), "line-tokens")
    at = tokens.select("leaf", "line", "n", F.posexplode("tokens").alias("position", "token"))
    rare = at.groupBy("leaf", "position", "token").agg(F.sum("n").alias("support")).select(
        "leaf", "position", "token", (F.col("support") < min_docs).alias("rare"))
    shown = F.when(F.col("rare"), F.lit(ANY)).otherwise(F.col("token"))
    templates = (at.join(rare, ["leaf", "position", "token"]).groupBy("leaf", "line")
                 .agg(F.sort_array(F.collect_list(F.struct("position", shown.alias("token")))).alias("t"),
                      F.sum(F.col("rare").cast("int")).alias("n_rare"), F.count("*").alias("n_tokens"))
                 .where(F.col("n_rare") <= variable * F.col("n_tokens"))
                 .select("leaf", "line", F.xxhash64("leaf", F.array_join(F.col("t.token"), " ")).alias("template")))
    templates = written(templates, "templates")
    discard(open_lines, tokens)
    recurring = (per_doc.join(templates, ["leaf", "line"]).groupBy("template", "key", "mark").agg(F.min("line_no").alias("line_no"))
                 .groupBy("template").agg(F.count("*").alias("n"), F.min(F.struct("key", "mark", "line_no")).alias("first"))
                 .where(F.col("n") >= min_docs).select("template", "first"))
    dropped = templates.join(recurring, "template").select("leaf", "line", "first")
    dropped = (lines.join(dropped, ["leaf", "line"]).where(F.struct("key", "mark", "line_no") != F.col("first"))
               .select("key", "mark", "line_no").distinct().groupBy("key", "mark").agg(F.collect_list("line_no").alias("dropped")))
    counts = lines.groupBy("key", "mark", "line_no").count().groupBy("key", "mark").agg(F.count("*").alias("n_lines"))
    # The documents' drop lists are all that the texts need.
    facts = written(counts.join(dropped, ["key", "mark"], "left"), "line-facts")
    discard(lines, templates)
    body = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(body) - 1), F.col("dropped"))
    out = docs.join(facts, ["key", "mark"], "left")
    out = out.withColumn("_body", body).withColumn("_left", left)
    return out.select(F.col("key").alias(key), *(F.col(f"_{i}").alias(c) for i, c in enumerate(names)),
                      F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
                          F.array_join(F.transform("_left", lambda i: F.get("_body", i)), "\n")).alias(text))


def _stretches(docs: DataFrame, passage: int) -> DataFrame:
    """(key, mark, first, last, stretch): from each sentence on, the fewest whole sentences of ``passage`` tokens."""
    kind = docs.schema["key"].dataType.simpleString()
    ends = re.compile(SENTENCE)

    def run(batches):
        for batch in batches:
            rows, firsts, lasts, found = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                units = [(n, tokens) for n, unit in enumerate(ends.split(text) if text else ()) if (tokens := masked(unit))]
                until, size = 0, 0
                for at, (number, tokens) in enumerate(units):
                    while size < passage and until < len(units):
                        size += len(units[until][1])
                        until += 1
                    if size < passage:
                        break
                    rows.append(i)
                    firsts.append(number)
                    lasts.append(units[until - 1][0])
                    found.append(_hash(" ".join(t for _, unit in units[at:until] for t in unit)))
                    size -= len(tokens)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(firsts, pa.int32()),
                                              pa.array(lasts, pa.int32()), pa.array(found, pa.int64())],
                                             names=["key", "mark", "first", "last", "stretch"])

    return docs.select("key", "mark", "text").mapInArrow(run, f"key {kind}, mark long, first int, last int, stretch long")


def dedup_passages(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple = (), min_docs: int = MIN_DOCS,
                   passage: int = PASSAGE) -> DataFrame:
    """One row per input row: key, ``keep`` columns, n_dropped (sentences), and the text without recurring passages.

    Keys, nulls and repeated rows are as in ``dedup_lines``. Line ends stay. A sentence is dropped only
    if the same stretch stands in a smaller place, so one copy of it always stays.
    """
    names = list(dict.fromkeys(c for c in keep if c not in (key, text)))
    docs = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text).cast("string")).alias("mark"), F.col(text).cast("string").alias("text"),
                     *(F.col(c).alias(f"_{i}") for i, c in enumerate(names)))
    found = written(_stretches(docs.where("key IS NOT NULL"), passage), "stretches")
    # Most stretches occur once: only those that occur often enough in all are looked at by place.
    frequent = found.groupBy("stretch").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("stretch")
    stretches = written(found.join(frequent, "stretch", "left_semi"), "frequent-stretches")
    discard(found)
    place = F.struct("key", "mark", "first")
    recurring = (stretches.groupBy("stretch", "key", "mark").agg(F.min("first").alias("first"))
                 .groupBy("stretch").agg(F.count("*").alias("n"), F.min(place).alias("smallest"))
                 .where(F.col("n") >= min_docs).select("stretch", "smallest"))
    dropped = (stretches.join(recurring, "stretch").where(place != F.col("smallest"))
               .select("key", "mark", F.explode(F.sequence("first", "last")).alias("unit"))
               .distinct().groupBy("key", "mark").agg(F.collect_list("unit").alias("dropped")))
    dropped = written(dropped, "dropped-sentences")
    discard(stretches)
    # Only texts that lose something are cut into sentences again.
    out = docs.join(dropped, ["key", "mark"], "left").withColumn("_units", F.when(F.col("dropped").isNotNull(), F.split("text", SENTENCE)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_units") - 1), F.col("dropped")), lambda i: F.struct(i.alias("i"), F.get("_units", i).alias("u")))
    ends = F.transform("dropped", lambda i: F.struct(i.alias("i"), F.when(F.get("_units", i).endswith("\n"), F.lit("\n")).otherwise(F.lit("")).alias("u")))
    left = F.transform(F.sort_array(F.concat(kept, ends)), lambda x: x["u"])
    return out.select(
        F.col("key").alias(key), *(F.col(f"_{i}").alias(c) for i, c in enumerate(names)),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(left, "")).alias(text))
