"""Joins on named keys, including keys that may be NULL on both sides."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join where NULL equals NULL; the key columns appear once.

    ``<=>`` stays a hash-partitioned join in Spark, so skew handling applies.
    """
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def fenced(df: DataFrame, kept, outputs: dict) -> DataFrame:
    """The columns ``kept`` and the computed ``outputs``, above which later filters and join conditions stay.

    Pushed into a chain of projections, a filter would repeat every expression it depends on. No filter passes a generator that
    is not deterministic, while an output that nobody reads is left out beneath it as beneath any other step.
    """
    df = df.withColumns({f"__out_{name}": value for name, value in outputs.items()})
    df = df.select("*", F.explode(F.array(F.spark_partition_id())).alias("__fence"))
    return df.select(*kept, *[F.col(f"__out_{name}").alias(name) for name in outputs])
