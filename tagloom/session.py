"""A session for tests and local runs; on a cluster the caller's session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g", name: str = "tagloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
