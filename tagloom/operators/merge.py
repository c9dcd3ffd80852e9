"""Order-aware merges of state and change tables.

Every merge is one aggregation on the key; the order of changes is an explicit
column, never the order of rows in a file. Change counts follow each key through
time; a key's history is cut into days first, so a key with a third of all
rows is spread over as many tasks as it has days.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(changes: DataFrame, key: list[str], order: list[str], attributes: list[str]) -> DataFrame:
    """The last change of each key. Nulls in ``order`` come first; the attributes break ties."""
    best = F.max(F.struct(*dict.fromkeys([*order, *attributes]))).alias("_best")
    return changes.groupBy(*key).agg(best).select(*key, *(F.col(f"_best.{c}").alias(c) for c in attributes))


def greatest_wins(changes: DataFrame, key: list[str], value: str, order: list[str], carried: list[str]) -> DataFrame:
    """The greatest value of each key with the columns of the first change that had it; null values change nothing."""
    entry = F.struct((-F.col(value)).alias("_neg"), *dict.fromkeys([*order, *carried]))
    best = F.min(entry).alias("_best")
    return changes.where(F.col(value).isNotNull()).groupBy(*key).agg(best).select(*key, (-F.col("_best._neg")).alias(value), *(F.col(f"_best.{c}").alias(c) for c in carried))


def _day(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("0000-00-00"))


def effective_raises(changes: DataFrame, key: list[str], value: str, time: str, order: list[str]) -> DataFrame:
    """``changes``: how many rows of the log raised their key's value, a key's first value included.

    Within a day by a window, between days by the greatest value of the days
    before, which is one row a key and day.
    """
    rows = changes.where(F.col(value).isNotNull()).withColumn("_d", _day(F.col(time)))
    by_day = rows.groupBy(*key, "_d").agg(F.max(value).alias("_top"))
    before = by_day.withColumn("_before", F.max("_top").over(Window.partitionBy(*key).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1))).drop("_top")
    within = Window.partitionBy(*key, "_d").orderBy(*(F.col(c).asc_nulls_first() for c in [time, *order])).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("_run", F.max(value).over(within)).join(before, [*key, "_d"])
    top = F.greatest("_run", "_before")
    return seen.agg(F.count_if(top.isNull() | (F.col(value) > top)).alias("changes"))


def effective_updates(changes: DataFrame, key: list[str], attributes: list[str], time: str, order: list[str]) -> DataFrame:
    """``changes``: how many rows of the log changed their key's attributes, a key's first row included."""
    attrs = F.struct(*attributes)
    rows = changes.withColumn("_d", _day(F.col(time))).withColumn("_a", attrs)
    by_day = rows.groupBy(*key, "_d").agg(F.max(F.struct(time, *order, "_a")).alias("_last"))
    before = by_day.withColumn("_before", F.lag("_last._a").over(Window.partitionBy(*key).orderBy("_d"))).drop("_last")
    within = Window.partitionBy(*key, "_d").orderBy(*(F.col(c).asc_nulls_first() for c in [time, *order]))
    seen = rows.withColumn("_prev", F.lag("_a").over(within)).join(before, [*key, "_d"])
    was = F.coalesce("_prev", "_before")
    return seen.agg(F.count_if(was.isNull() | ~F.col("_a").eqNullSafe(was)).alias("changes"))


def state_conflicts(state: DataFrame, changes: DataFrame, key: list[str], attributes: list[str]) -> DataFrame:
    """Changes that differ from the stored row of their key, with what is stored as ``stored_*``. Nulls are values."""
    stored = state.select(*key, *(F.col(c).alias(f"stored_{c}") for c in attributes))
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"stored_{c}")) for c in attributes))
    return changes.select(*key, *attributes).join(stored, key).where(differs)


def insert_status(state: DataFrame, changes: DataFrame, key: list[str], order: list[str], attributes: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Status rows into a stored table: duplicates among the changes are folded, keys that are stored stay.

    Returns the new table, the conflicts among the changes and those with the stored rows.
    """
    folded = fold_duplicates(changes, key, order, attributes)
    new = insert_or_ignore(state.select(*key), folded.select(*key, *attributes), key, [])
    return state.select(*key, *attributes).unionByName(new), fold_conflicts(changes, key, order, attributes), state_conflicts(state, folded, key, attributes)


def insert_or_ignore(state: DataFrame, changes: DataFrame, key: list[str], first: list[str]) -> DataFrame:
    """``changes`` reduced to the first row of each key that ``state`` lacks. Nulls in a key are equal to each other."""
    rest = [c for c in changes.columns if c not in key]
    new = changes.groupBy(*key).agg(F.min(F.struct(*dict.fromkeys([*first, *rest]))).alias("_row")).select(*key, *(F.col(f"_row.{c}").alias(c) for c in rest))
    same = reduce(lambda a, b: a & b, (new[k].eqNullSafe(state[k]) for k in key))
    return new.join(state, same, "left_anti").select(*changes.columns)


def replace_snapshot(state: DataFrame, snapshot: DataFrame, where: Column) -> DataFrame:
    """``state`` without the rows that ``where`` selects, and the snapshot in their place."""
    return state.where(~F.coalesce(where, F.lit(False))).unionByName(snapshot)


def max_merge(state: DataFrame, changes: DataFrame, key: list[str], value: str) -> DataFrame:
    """Both tables' greatest value of each key."""
    both = state.select(*key, value).unionByName(changes.select(*key, value))
    return both.groupBy(*key).agg(F.max(value).alias(value))


def fold_duplicates(rows: DataFrame, key: list[str], order: list[str], attributes: list[str]) -> DataFrame:
    """One status row a key: the first canonical one, else the alias with the smallest target, the earliest on ties."""
    rank = F.struct(F.col("alias").alias("_a"), F.when(F.col("alias") == 1, F.col("preferred_tag_id")).otherwise(F.lit(0)).alias("_p"), *dict.fromkeys([*order, *attributes]))
    return rows.groupBy(*key).agg(F.min(rank).alias("_b")).select(*key, *(F.col(f"_b.{c}").alias(c) for c in attributes))


def fold_conflicts(rows: DataFrame, key: list[str], order: list[str], attributes: list[str]) -> DataFrame:
    """Rows that differ from the winner of the rows before them, with that winner's attributes as ``kept_*``.

    The running winner is that of ``fold_duplicates``. A key is a (tag, format)
    or a tag, so its rows are few.
    """
    rank = F.struct(F.col("alias").alias("_a"), F.when(F.col("alias") == 1, F.col("preferred_tag_id")).otherwise(F.lit(0)).alias("_p"), *dict.fromkeys([*order, *attributes]))
    before = Window.partitionBy(*key).orderBy(*order, *attributes).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("_kept", F.min(rank).over(before)).where(F.col("_kept").isNotNull())
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_kept.{c}")) for c in attributes))
    return seen.where(differs).select(*key, *order, *attributes, *(F.col(f"_kept.{c}").alias(f"kept_{c}") for c in attributes))
