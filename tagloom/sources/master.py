"""Master data: formats and the types each knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.plans.views import TYPE_NAMES

# Formats by id, and the type name of each type of a format.
FORMATS = (
    "unknown danbooru e621 derpibooru safebooru allthefallen sankaku gelbooru rule34 xbooru hypnohub konachan konachan-net "
    "lolibooru anime-pictures wallhaven yandere zerochan pixiv"
).split()
BASE = {0: 1, 1: 2, 3: 3, 4: 4, 5: 7}
TYPES = {
    **dict.fromkeys((1, 4, 5, 8, 9, 10), BASE),
    2: {0: 1, 1: 2, 2: 17, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8},
    3: {0: 1, 1: 15, 2: 1, 3: 5, 4: 9, 5: 10, 6: 11, 7: 7, 8: 12, 9: 13, 10: 14, 11: 16},
    6: {0: 1, 1: 2, 2: 18, 3: 3, 4: 4, 8: 7, 9: 7},
    7: BASE | {6: 19},
    11: BASE | {6: 18},
    12: BASE | {6: 18},
    13: {0: 1, 1: 2, 3: 3, 4: 4, 5: 18, 6: 7},
    14: {0: 7, 1: 4, 2: 1, 3: 3, 4: 2, 5: 3, 6: 3, 7: 1},
    16: BASE | {6: 7},
}


def formats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, "") for i, n in enumerate(FORMATS)], "format_id long, format_name string, description string")


def type_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, "") for i, n in enumerate(TYPE_NAMES)], "type_name_id long, type_name string, description string")


def mappings(spark: SparkSession) -> DataFrame:
    rows = [(f, t, n, TYPE_NAMES[n]) for f, types in sorted(TYPES.items()) for t, n in types.items()]
    return spark.createDataFrame(rows, "format_id long, type_id long, type_name_id long, description string")


def seed(existing: DataFrame, master: DataFrame, key: list[str]) -> DataFrame:
    """``existing`` with the master rows whose key it lacks; seeding again changes nothing."""
    return existing.unionByName(master.join(existing.select(*key), key, "left_anti").select(*existing.columns))
