"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from listwise.llm import decontaminate, langid, lines, neardup, packing
from listwise.llm.common import discard, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model takes for a language it knows, and all with letters if there is none to learn from."""
    model = langid.learn(docs)
    return langid.predict(docs, model, keep=COLUMNS, claimed=True).where("claimed").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates and without recurring passages; one left without a word goes."""
    out = lines.dedup_lines(docs, keep=COLUMNS)
    out = (out.where((F.col("n_dropped") == 0) | (F.col("n_dropped") < F.col("n_lines")))
           .withColumn("n_chars", F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS))
    out = lines.dedup_passages(written(out, "without-lines"), keep=COLUMNS)
    return (out.where((F.col("n_dropped") == 0) | F.col("text").rlike("\\S"))
            .withColumn("n_chars", F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates; two texts under one id are two documents, a row repeated is one."""
    docs = docs.withColumn("_row", F.struct("doc_id", F.xxhash64("text").alias("mark")))
    kept = neardup.near_duplicates(docs, key="_row").where("kept").select(F.col("_row").alias("_kept")).distinct()
    return docs.join(kept, F.col("_row") == F.col("_kept"), "left_semi").dropDuplicates(["_row"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.without_overlaps(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with a checksum of the ids of each."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), kept_runs=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", pack)]

#: The stages need models and components that SQL cannot express; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents of ``sf_dir``; a stage's table goes when the next one's is written."""
    docs = before = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
