"""Dense surrogate ids without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.tables import Scratch


def dense_ids(df: DataFrame, order: list[Column], name: str, start: int = 1, partitions: int | None = None) -> DataFrame:
    """``df`` with a gapless number from ``start`` on, in the given total order.

    Range partitioning, a sort within partitions and one offset a partition:
    what reaches the driver is a count a partition. The ranged table is written
    once, so the numbers hold if a task runs again. Rows equal in ``order`` get
    numbers in no defined order, so callers pass a key. An empty frame stays empty.
    """
    ordered = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = Scratch(df.sparkSession).put(ordered.sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")))
    sizes = sorted((r["_pid"], r["n"], r["low"]) for r in placed.groupBy("_pid").agg(F.count("*").alias("n"), F.min("_mid").alias("low")).collect())
    rows, at = [], start
    for pid, n, low in sizes:
        rows.append((pid, at - low))
        at += n
    schema = T.StructType([T.StructField("_pid", T.IntegerType()), T.StructField("_shift", T.LongType())])
    offsets = F.broadcast(df.sparkSession.createDataFrame(rows, schema))  # one row a partition
    return placed.join(offsets, "_pid").select(*df.columns, (F.col("_mid") + F.col("_shift")).alias(name))


def next_id(df: DataFrame, id_col: str) -> int:
    """One more than the greatest id, 1 for an empty table."""
    return (df.agg(F.max(id_col)).first()[0] or 0) + 1
