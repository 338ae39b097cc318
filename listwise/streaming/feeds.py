"""Listing feeds as Structured Streaming jobs."""

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from listwise.operators.sequences import state_changes
from listwise.sources.listings import newest_per_key


def upsert_stream(feed: DataFrame, store: str, checkpoint: str, keys: list[str], order: list[str],
                  trigger: dict | None = None) -> StreamingQuery:
    """Each micro-batch leaves its newest row per key in a partition of its own.

    Only the batch's own rows are written, never the whole table again. A batch that is
    run twice after a failure overwrites its own partition, so the result is the same.
    ``current_listings`` reads the newest row per key of all batches, and ``compact``
    folds them into one.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        newest_per_key(batch, keys, order).write.mode("overwrite").parquet(os.path.join(store, f"batch={batch_id}"))

    return (feed.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def current_listings(spark: SparkSession, store: str, keys: list[str], order: list[str]) -> DataFrame:
    return newest_per_key(spark.read.parquet(store).drop("batch"), keys, order)


def compact(spark: SparkSession, store: str, target: str, keys: list[str], order: list[str]) -> None:
    """Fold all batches into one partition of a new store."""
    current_listings(spark, store, keys, order).write.mode("overwrite").parquet(os.path.join(target, "batch=0"))


def first_sales(feed: DataFrame, key: str, event_time: str, horizon: str = "7 days") -> DataFrame:
    """A sale seen again within the horizon is dropped; state older than it is forgotten."""
    return feed.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])


def _versions(spark: SparkSession, store: str, batch_id: int) -> tuple[dict[int, int], object]:
    """The version of each bucket's held state after a batch, and the feed's clock then: at most one row per bucket."""
    if batch_id < 0:
        return {}, None
    rows = spark.read.schema("bucket int, version long, clock timestamp").parquet(os.path.join(store, "manifest", f"version={batch_id}")).collect()
    return {r.bucket: r.version for r in rows if r.bucket is not None}, next((r.clock for r in rows if r.bucket is None), None)


def _drop_versions(spark: SparkSession, store: str, kept: set[tuple[int, int]], batch_id: int) -> None:
    """Delete what neither this batch's manifest nor the one before it names; a batch that is run again needs that one."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(store).getFileSystem(conf)
    for found in fs.globStatus(path(os.path.join(store, "held", "version=*", "bucket=*"))) or []:
        at = found.getPath()
        name = (int(at.getParent().getName().split("=")[1]), int(at.getName().split("=")[1]))
        if name not in kept and name[0] < batch_id:
            fs.delete(at, True)
    for found in fs.globStatus(path(os.path.join(store, "manifest", "version=*"))) or []:
        if int(found.getPath().getName().split("=")[1]) < batch_id - 1:
            fs.delete(found.getPath(), True)


def alert_stream(feed: DataFrame, store: str, checkpoint: str, chunk: Column, trigger: dict | None = None, buckets: int = 256) -> StreamingQuery:
    """One alert per item per state change, with the previous observation, in ``store/alerts``.

    The feed carries item_id, observed_at, seq, state, bid_count and end_time. A batch is
    compared with the last observation of each item, held in ``buckets`` of items until the item's
    end has passed in the feed. It reads and rewrites only the buckets that its items fall into, as
    ``store/held/version=<batch>``; a manifest of at most one row per bucket names the current version
    of each. Ended items of other buckets are passed over when read and go with the next rewriting. A
    row that is not after the held one is late: it neither alerts nor replaces it, and goes to
    ``store/late``. An unknown count is a state of its own. A batch that is run again reads the
    versions from before it and overwrites its own.
    """
    values = ["observed_at", "seq", "state", "bid_count", "end_time"]

    def write(df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(store, name, f"batch={batch_id}"))

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Kept for this batch: its buckets, its late rows, its alerts and the new state all read it.
        rows = batch.select("item_id", *values, F.pmod(F.xxhash64("item_id"), F.lit(buckets)).cast("int").alias("bucket")).persist()
        try:
            versions, clock = _versions(spark, store, batch_id - 1)
            touched = rows.groupBy("bucket").agg(F.max("observed_at").alias("now")).collect()
            paths = [os.path.join(store, "held", f"version={versions[t.bucket]}", f"bucket={t.bucket}") for t in touched if t.bucket in versions]
            schema = rows.drop("bucket").schema
            held = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
            if clock is not None:
                held = held.where(F.col("end_time").isNull() | (F.col("end_time") > F.lit(clock)))
            last = held.select("item_id", F.struct("observed_at", "seq").alias("__last"))
            known = rows.drop("bucket").join(last, "item_id", "left")
            on_time = F.col("__last").isNull() | (F.struct("observed_at", "seq") > F.col("__last"))
            new = known.where(on_time).drop("__last")
            both = new.withColumn("__new", F.lit(True)).unionByName(held.withColumn("__new", F.lit(False)))
            changed = state_changes(both, "item_id", ["observed_at", "seq"], ["state", "bid_count"], chunk).where("__new")
            write(known.where(~on_time).drop("__last"), "late", batch_id)
            write(changed.select("item_id", "observed_at", "state", "bid_count", F.col("previous.state").alias("previous_state"),
                                 F.col("previous.observed_at").alias("previous_at"), F.col("previous.bid_count").alias("previous_count")),
                  "alerts", batch_id)
            clock = max((t for t in (clock, *(t.now for t in touched)) if t is not None), default=None)
            newest = newest_per_key(new.unionByName(held), ["item_id"], ["observed_at", "seq"]).select("item_id", *values)
            if clock is not None:
                newest = newest.where(F.col("end_time").isNull() | (F.col("end_time") > F.lit(clock)))
            home = os.path.join(store, "held", f"version={batch_id}")
            newest.withColumn("bucket", F.pmod(F.xxhash64("item_id"), F.lit(buckets)).cast("int")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(home)
            full = {r.bucket for r in spark.read.schema("item_id string, bucket int").parquet(home).select("bucket").distinct().collect()}
            now = {b: v for b, v in versions.items() if b not in {t.bucket for t in touched}} | dict.fromkeys(full, batch_id)
            manifest = [(None, None, clock), *((b, v, None) for b, v in sorted(now.items()))]
            spark.createDataFrame(manifest, "bucket int, version long, clock timestamp").coalesce(1).write.mode("overwrite").parquet(
                os.path.join(store, "manifest", f"version={batch_id}"))
            _drop_versions(spark, store, {(v, b) for kept in (versions, now) for b, v in kept.items()}, batch_id)
        finally:
            rows.unpersist()

    return (feed.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_alerts(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(os.path.join(store, "alerts")).drop("batch")
