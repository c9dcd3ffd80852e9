"""Reading input tables and cutting lineage.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``; it is
shared by all executors, so a lost executor costs a re-read and nothing else.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only the columns a plan uses are read from its files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where there is none, a temporary one is set in local mode; on a cluster, whose machines share no such folder, that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tagloom-"))
    return sc.getCheckpointDir()


_ROOTS: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    """Intermediate tables live as long as the application that wrote them."""
    for spark, root in _ROOTS:
        try:
            _delete(spark, root)
        except Exception:  # the JVM is gone, and with it the application
            pass


class Scratch:
    """Tables written to the shared folder during an iterative plan.

    ``put`` writes a frame and reads it back, which cuts the lineage;
    ``drop`` deletes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tagloom-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        _ROOTS.append((spark, self.root))

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def close(self) -> None:
        """Deletes all tables, once nothing reads them any more."""
        self.paths.clear()
        _delete(self.spark, self.root)

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := self.paths.pop(id(df), None):
                _delete(self.spark, path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over all cores, for steps that cost far more a byte than a shuffle; adaptive execution leaves them apart."""
    sc = df.sparkSession.sparkContext
    return df.repartition(max(sc.defaultParallelism * 2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after a check: past ``max_rows`` or ``max_bytes`` the frame is left to a shuffled join.

    A frame that is read straight from files is judged by the optimiser's size
    of them where that is below the session's own limit, which it broadcasts by
    itself; else rows and the bytes of their text are counted, stopped one row
    past the bound.
    """
    limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    if 0 < int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit:
        return df
    size = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if size["n"] <= max_rows and size["size"] <= max_bytes else df
