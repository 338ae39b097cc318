"""The previous row of a key, for keys of any size, and neighbours in the order of a whole table."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F


def with_previous(df: DataFrame, key: str, order: list[str], values: list[str], chunk: Column) -> DataFrame:
    """Adds ``previous`` (a struct of ``values``) from the preceding row of the same key.

    ``chunk`` splits a key's rows into consecutive stretches (say, days), so a hot key is
    ordered stretch by stretch in parallel. The last row of each stretch is kept aside
    and handed to the first row of the next one.
    """
    row = F.struct(*values)
    df = df.withColumn("__chunk", chunk)
    inside = Window.partitionBy(key, "__chunk").orderBy(*order)
    df = df.withColumns({"__prev": F.lag(row).over(inside), "__first": F.row_number().over(inside) == 1})
    ends = df.groupBy(key, "__chunk").agg(F.max_by(row, F.struct(*order)).alias("__end"))
    handed = ends.withColumn("__handed", F.lag("__end").over(Window.partitionBy(key).orderBy("__chunk")))
    out = df.join(handed.select(key, "__chunk", "__handed"), [key, "__chunk"])
    return out.withColumn("previous", F.when(F.col("__first"), F.col("__handed")).otherwise(F.col("__prev"))).drop(
        "__chunk", "__prev", "__first", "__handed")


def state_changes(df: DataFrame, key: str, order: list[str], state: list[str], chunk: Column) -> DataFrame:
    """Rows whose state differs from the key's previous row, with that row beside them.

    The first observation of a key is not a change.
    """
    values = list(dict.fromkeys([*order, *state]))
    out = with_previous(df, key, order, values, chunk)
    same = F.lit(True)
    for s in state:
        same = same & F.col(s).eqNullSafe(F.col(f"previous.{s}"))
    return out.where(F.col("previous").isNotNull() & ~same)


def falls_in_order(df: DataFrame, order: str, value: str) -> DataFrame:
    """One row (groups, steps_down): rows in ``order``, and how often ``value`` falls from one group to the next.

    Rows equal in ``order`` are one group, which falls if its least value is below the greatest of the
    group before. Both columns are numbers; rows without either are left out. Groups are counted out by partial
    aggregation, dealt by range, and each range is read once in its own order; a range hands its last
    group to the next one that has any, so neighbours meet without a rank or a sort in one task.
    """
    given = df.select(F.col(order).cast("double").alias("o"), F.col(value).cast("double").alias("v")).where(
        "o IS NOT NULL AND v IS NOT NULL AND NOT isnan(o) AND NOT isnan(v)")
    groups = given.groupBy("o").agg(F.min("v").alias("low"), F.max("v").alias("high"))

    def run(batches):
        first = last = None
        count = steps = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            low, high = (batch.column(i).to_numpy() for i in (1, 2))
            first = low[0] if first is None else first
            before = np.concatenate(([-np.inf if last is None else last], high[:-1]))
            steps += int((before > low).sum())
            count, last = count + len(low), high[-1]
        if count:
            row = [TaskContext.get().partitionId(), float(first), float(last), count, steps]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "first", "last", "groups", "steps"])

    ranges = groups.repartitionByRange("o").sortWithinPartitions("o").mapInArrow(run, "part long, first double, last double, groups long, steps long")
    handed = ranges.withColumn("before", F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("part")))
    return handed.agg(F.coalesce(F.sum("groups"), F.lit(0)).alias("groups"),
                      F.coalesce(F.sum(F.col("steps") + F.coalesce((F.col("before") > F.col("first")).cast("long"), F.lit(0))), F.lit(0)).alias("steps_down"))
