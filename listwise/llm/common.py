"""What the operators of this subpackage share: tables, the shared folder, written tables."""

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master, where every task runs on this machine, may go without the setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="listwise-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def own_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Frees the shuffle files of a statement when it ends; what is written needs them no longer.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it cuts lineage and outlives any executor."""
    spark, path = df.sparkSession, own_dir(df.sparkSession, name)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for table in tables:
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        spark = table.sparkSession
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(column, n: int):
    """crc32 of the value as text, modulo ``n``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def word_hashes(words, n: int) -> np.ndarray:
    """64-bit hashes of ``n`` words given as bytes."""
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def mixed(h):
    """64-bit numbers spread over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))
