"""Session defaults and the one way this library cuts lineage."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# The JVM compiles no method above 8000 bytes of bytecode. A wide title projection fused
# into one stage exceeds that and would run interpreted; below this limit Spark keeps
# such a projection in smaller methods.
RUNTIME = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options this library relies on; safe on any session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "listwise") -> SparkSession:
    """A session for tests and for the local bench; clusters bring their own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("LISTWISE_DRIVER_MEMORY", "12g"))
               .config("spark.ui.enabled", "false"))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Without the setting only a local
    master, whose tasks all run on this machine, gets a scratch folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="listwise-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def own_dir(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return os.path.join(shared_dir(spark), f"run-{uuid.uuid4().hex}")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt to three tasks a core: a file of a few megabytes is one task, however much work its rows are."""
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)


def spread_few(df: DataFrame) -> DataFrame:
    """``spread`` for a table that comes in fewer pieces than that; one in more pieces stays as it is and is not shuffled."""
    return spread(df) if df.rdd.getNumPartitions() < 3 * df.sparkSession.sparkContext.defaultParallelism else df


#: Frees the shuffle files of a statement when it ends; what is settled needs them no longer.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """The rows as a compressed Parquet table in the shared folder, read again: lineage ends there, and it survives executor loss.

    A checkpoint would hold the rows as they lie in memory, several times as large, and every column for every reader.
    """
    spark, path = df.sparkSession, own_dir(df.sparkSession)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
