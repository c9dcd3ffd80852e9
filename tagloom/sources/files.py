"""CSV, JSON, Parquet and translation files, and the policy for their tag columns."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.text import canonicalize_source_tag, split_translations
from tagloom.plans.views import classify_column, prune_null_columns


class NormalizedSourceSkipError(ValueError):
    """A tag column that holds normalised names, or cannot be told, and is not overridden."""

    def __init__(self, path: str, decision: str):
        super().__init__(f"{path}: the tag column is {decision}")
        self.path, self.decision = path, decision


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Short rows are filled with nulls, long ones cut; all columns are text."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """An array of objects, or one object."""
    return spark.read.option("multiLine", True).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


REPAIRS = {
    "derpibooru": lambda df: df if "format_id" in df.columns else df.withColumn("format_id", F.lit(3).cast("long")),
    "dataset_rising_v2": prune_null_columns,
    "english_dict": lambda df: df.withColumnRenamed("fomat_id", "format_id"),
}


def validate(df: DataFrame) -> bool:
    return "source_tag" in df.columns and not df.isEmpty()


class ColumnOverrides:
    """Path and column to ``normalized``, ``source`` or ``unknown``; an exact path goes before its POSIX form."""

    KINDS = ("normalized", "source", "unknown")

    def __init__(self, table: dict):
        if not isinstance(table, dict):
            raise ValueError("overrides must be an object")
        for path, columns in table.items():
            if not isinstance(columns, dict) or any(k not in self.KINDS for k in columns.values()):
                raise ValueError(f"bad override for {path}")
        self.table = table

    @classmethod
    def load(cls, path: str) -> ColumnOverrides:
        try:
            return cls(json.load(open(path, encoding="utf-8")))
        except json.JSONDecodeError as e:
            raise ValueError(f"{path}: {e}") from e

    def get(self, path: str, column: str) -> str | None:
        for p in (path, path.replace(os.sep, "/").replace("\\", "/")):
            if column in self.table.get(p, {}):
                return self.table[p][column]
        return None


def source_column(df: DataFrame, path: str, overrides: ColumnOverrides | None = None, repair: str | None = None) -> DataFrame:
    """``df`` with a canonical ``source_tag``, after repair and a look at its ``tag`` column.

    An override decides; else the column must look like source forms. Packed
    lists of the second release of one data set are taken in normalised form.
    """
    if repair:
        df = REPAIRS[repair](df)
    if "source_tag" not in df.columns and "tag" in df.columns:
        kind = overrides.get(path, "tag") if overrides else None
        if kind is None:
            kind = classify_column(df, "tag").first()["decision"]
            kind = "unknown" if kind == "empty" else kind
        allowed = kind == "source" or (kind == "normalized" and repair == "dataset_rising_v2" and "deprecated_tags" in df.columns)
        if not allowed:
            raise NormalizedSourceSkipError(path, kind)
        df = df.withColumnRenamed("tag", "source_tag")
    return df.withColumn("source_tag", canonicalize_source_tag(F.col("source_tag"))) if "source_tag" in df.columns else df


def pick(df: DataFrame, *names: str) -> str | None:
    """The first of the names that is a column, in any case."""
    lower = {c.lower(): c for c in df.columns}
    return next((lower[n.lower()] for n in names if n.lower() in lower), None)


def translation_pairs(df: DataFrame, language: str = "ja") -> DataFrame:
    """``source_tag, language, translation`` of a translation data set in either layout, one row a name; deleted rows are left out."""
    tag, told = pick(df, "tag", "title"), pick(df, "japanese", "other_names")
    if tag is None or told is None:
        raise ValueError(f"no translation columns among {df.columns}")
    gone = pick(df, "is_deleted")
    rows = df.where(~F.coalesce(F.col(gone).cast("boolean"), F.lit(False))) if gone else df
    is_list = dict(df.dtypes)[told].startswith("array")
    names = F.flatten(F.transform(told, split_translations)) if is_list else split_translations(F.col(told))
    out = rows.select(F.col(tag).alias("source_tag"), F.lit(language).alias("language"), F.explode(names).alias("translation"))
    return out.where(F.trim("source_tag") != "")


def read_translations(spark: SparkSession, path: str, split: str = "train", revision: str | None = None) -> DataFrame:
    """A translation data set from a folder of Parquet files: its revision and its split if it has such folders, or files named for the split."""
    at = os.path.join(path, revision) if revision else path
    for folder in (os.path.join(at, split), os.path.join(at, "data", split)):
        if os.path.isdir(folder):
            return spark.read.parquet(folder)
    named = sorted(os.path.join(d, f) for d, _, files in os.walk(at) for f in files if f.endswith(".parquet") and f.startswith(f"{split}-"))
    return spark.read.parquet(*named) if named else spark.read.option("recursiveFileLookup", "true").parquet(at)


def unpivot_translations(rows: DataFrame, languages: list[str], key: str = "source_tag") -> DataFrame:
    """``source_tag, language, translation``: one row a name of every language column."""
    long = rows.select(key, *(F.col(f"`{c}`").cast("string").alias(c) for c in languages)).unpivot([key], languages, "language", "packed")
    return long.select(key, "language", F.explode(split_translations(F.col("packed"))).alias("translation"))
