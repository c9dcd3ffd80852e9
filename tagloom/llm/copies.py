"""Duplicates hidden by formatting differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import strip
from tagloom.tables import Scratch


def is_blank(c: Column) -> Column:
    """True for null and for white space only."""
    return F.coalesce(strip(c) == "", F.lit(True))


def record_text(tag: str = "tag", source_tag: str = "source_tag") -> Column:
    """The text a record stands for: its tag, or its source form where the tag is null or blank."""
    return F.when(is_blank(F.col(tag)), F.col(source_tag)).otherwise(F.col(tag))


def canonical_words(c: Column) -> Column:
    """The words of a text without regard to case and order, sorted and joined; null for a text without words."""
    words = F.array_sort(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), 0))
    return F.when(F.size(words) > 0, F.array_join(words, " "))


def distinct_texts(records: DataFrame, id_col: str, text: Column) -> DataFrame:
    """``text, low, n, canon`` of every distinct text with words: its smallest id, how often it occurs, and its words in order."""
    raw = records.select(F.col(id_col).alias("id"), text.alias("text")).where("text is not null")
    exact = raw.groupBy("text").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    return exact.withColumn("canon", canonical_words(F.col("text"))).where("canon is not null")


def collapse(records: DataFrame, id_col: str, text: Column) -> DataFrame:
    """Canonical groups in two stages: ``text, canon, first_id, copies`` for every distinct raw text.

    Byte-identical texts collapse first, with their counts, so that a text held
    by a third of all rows is one row a partition before anything is shuffled.
    Only the distinct survivors are canonicalised, and their counts are summed
    over the full canonical text. ``first_id`` and ``copies`` are those of the
    whole group. Texts without words, null ones included, are left out.
    """
    survivors = Scratch(records.sparkSession).put(distinct_texts(records, id_col, text))  # read twice
    groups = survivors.groupBy("canon").agg(F.min("low").alias("first_id"), F.sum("n").alias("copies"))
    return survivors.join(groups, "canon").select("text", "canon", "first_id", "copies")


def copy_groups(records: DataFrame, id_col: str = "tag_id", text: Column | None = None) -> DataFrame:
    """One record a group: ``first_id, canon, copies``, groups of one included.

    Null and wordless records have no group; an empty table gives an empty one;
    repeated rows count each.
    """
    text = record_text() if text is None else text
    survivors = distinct_texts(records, id_col, text)
    return survivors.groupBy("canon").agg(F.min("low").alias("first_id"), F.sum("n").alias("copies")).select("first_id", "canon", "copies")


def copies(records: DataFrame, id_col: str = "tag_id", text: Column | None = None) -> DataFrame:
    """``first_tag_id, copy_tag_id``: every record of a group but the one with the smallest id.

    Members of a hot group are never gathered: each row meets its text's one
    entry in the table of distinct texts. That join may be skewed on the side
    of the rows, which adaptive execution splits. Ids that repeat give one row.
    """
    text = record_text() if text is None else text
    first = collapse(records, id_col, text).where("copies > 1").select("text", "first_id")
    rows = records.select(F.col(id_col).alias("id"), text.alias("text")).where("text is not null")
    pairs = rows.join(first, "text").where("id <> first_id")
    return pairs.select(F.col("first_id").alias("first_tag_id"), F.col("id").alias("copy_tag_id")).distinct()
