"""References to records that do not exist, per table, field and month."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.tables import Scratch

#: A month before all others: for keys that exist without a date.
ALWAYS = "0000-00"
#: A month after all others: for references without a date, which any record satisfies.
UNKNOWN = "unknown"


def month(c: Column) -> Column:
    """``yyyy-MM`` of a timestamp; null stays null."""
    return F.date_format(c, "yyyy-MM")


@dataclass
class Reference:
    """One referring field: its rows, the key each refers to (null: refers to nothing), and its date."""

    table: str
    field: str
    rows: DataFrame
    row_id: str
    key: Column
    when: Column


def reference_rows(ref: Reference) -> DataFrame:
    """``ref_table, ref_field, period, row_id, key`` of one field, repeated rows counted in ``refs``."""
    rows = ref.rows.select(
        F.lit(ref.table).alias("ref_table"),
        F.lit(ref.field).alias("ref_field"),
        F.coalesce(month(ref.when), F.lit(UNKNOWN)).alias("period"),
        F.col(ref.row_id).alias("row_id"),
        ref.key.alias("key"),
    )
    return rows.where(F.col("key").isNotNull())


def orphan_keys(references: DataFrame, existence: DataFrame) -> DataFrame:
    """The current orphan report: ``ref_table, ref_field, key, period, refs``.

    ``references`` are deltas (``ref_table, ref_field, key, period, n``) and
    ``existence`` are deltas (``key, period, n``); n is +1 for a row that came
    and -1 for one that went. Both are summed per key and month before anything
    is shuffled further, so a hot key is a handful of rows. Per key the
    existence count of a month is the sum up to that month; a month with
    positive references and no existence is an orphan. References of period
    ``unknown`` see all months.
    """
    refs = references.groupBy("key", "period", "ref_table", "ref_field").agg(F.sum("n").alias("refs")).where("refs > 0")
    have = existence.groupBy("key", "period").agg(F.sum("n").alias("n")).where("n <> 0")
    both = refs.select("key", F.struct("period", "ref_table", "ref_field", "refs").alias("r"), F.lit(None).cast("struct<period:string,n:bigint>").alias("e")).unionByName(
        have.select("key", F.lit(None).cast("struct<period:string,ref_table:string,ref_field:string,refs:bigint>").alias("r"), F.struct("period", "n").alias("e"))
    )
    # at most (months x fields) entries a key, as both sides are summed already
    per_key = both.groupBy("key").agg(F.collect_list("r").alias("rs"), F.collect_list("e").alias("es")).where(F.size("rs") > 0)
    seen = per_key.select("key", F.explode("rs").alias("r"), "es").withColumn(
        "there",
        F.aggregate("es", F.lit(0).cast("bigint"), lambda acc, e: acc + F.when((F.col("r.period") == UNKNOWN) | (e["period"] <= F.col("r.period")), e["n"]).otherwise(F.lit(0))),
    )
    return seen.where("there <= 0").select("r.ref_table", "r.ref_field", "key", "r.period", "r.refs")


REFERENCE_COUNTS = "ref_table string, ref_field string, key string, period string, n long"
EXISTENCE_COUNTS = "key string, period string, n long"


class OrphanCounts:
    """Signed reference and existence counts kept in a folder between runs.

    ``apply`` adds the deltas of one change set, +1 for a row that came and -1
    for one that went, to the counts so far and writes them as a new version;
    only keys with a count other than zero stay. A change set has a number, and
    one that was applied already changes nothing, so a run or micro-batch that
    is repeated after a failure is safe. ``report`` is the current orphan
    report. Two versions are kept, so a reader of the last one is not disturbed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._path = path
        self._fs = path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The finished versions: those whose second table was written to its end."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        return sorted(int(n) for n in names if n.lstrip("-").isdigit() and self._fs.exists(self._path(f"{self.folder}/{n}/existence/_SUCCESS")))

    def counts(self) -> tuple[DataFrame, DataFrame]:
        """References (``ref_table, ref_field, key, period, n``) and existence (``key, period, n``) as they stand."""
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], REFERENCE_COUNTS), self.spark.createDataFrame([], EXISTENCE_COUNTS)
        at = f"{self.folder}/{versions[-1]}"
        return self.spark.read.schema(REFERENCE_COUNTS).parquet(f"{at}/references"), self.spark.read.schema(EXISTENCE_COUNTS).parquet(f"{at}/existence")

    def apply(self, number: int, references: DataFrame, existence: DataFrame) -> None:
        versions = self.versions()
        if versions and number <= versions[-1]:
            return
        for name, old, delta in zip(("references", "existence"), self.counts(), (references, existence)):
            keys = [c for c in old.columns if c != "n"]
            both = old.unionByName(delta.select(*keys, F.col("n").cast("long").alias("n")))
            both.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0").write.mode("overwrite").parquet(f"{self.folder}/{number}/{name}")
        for v in versions[:-1]:
            self._fs.delete(self._path(f"{self.folder}/{v}"), True)

    def report(self) -> DataFrame:
        """``ref_table, ref_field, key, period, refs`` of the keys that are referred to and do not exist."""
        return orphan_keys(*self.counts())


def reference_deltas(rows: DataFrame, sign: int = 1, spaces: tuple[str, ...] = ("type_id",)) -> DataFrame:
    """The counts that rows of ``reference_rows`` add, or take away, in the key space of their field."""
    space = F.when(F.col("ref_field").isin(*spaces), F.col("ref_field")).otherwise(F.lit("*"))
    return rows.select("ref_table", "ref_field", F.concat_ws("\x1f", space, "key").alias("key"), "period", F.lit(sign).cast("long").alias("n"))


def existence_deltas(records: DataFrame, id_col: str = "tag_id", when: str = "created_at", sign: int = 1, space: str = "*") -> DataFrame:
    """The counts that records of a referred table add, or take away; null keys exist nowhere."""
    key = F.concat_ws("\x1f", F.lit(space), F.col(id_col).cast("string"))
    return records.where(F.col(id_col).isNotNull()).select(key.alias("key"), F.coalesce(month(F.col(when)), F.lit(ALWAYS)).alias("period"), F.lit(sign).cast("long").alias("n"))


def find_orphans(references: list[Reference], existence: dict[str, DataFrame]) -> DataFrame:
    """Referring rows without target: ``ref_table, ref_field, period, tag_id, missing_key``, distinct.

    ``existence`` maps a reference's field (or ``*``) to the deltas of the keys
    that exist (``key, period, n``). Rows with a null key refer to nothing and
    are no case; an empty target table makes every reference a case; repeated
    rows give one; equal keys of different fields do not mix. Only orphan keys,
    which are few, meet the referring rows again; that join is on key and
    period, and skewed keys among them are split by adaptive execution.
    """
    rows = reduce(DataFrame.unionByName, map(reference_rows, references))
    deltas = rows.select("ref_table", "ref_field", F.concat_ws("\x1f", _space(existence), "key").alias("key"), "period", F.lit(1).cast("bigint").alias("n"))
    have = reduce(
        DataFrame.unionByName,
        (df.select(F.concat_ws("\x1f", F.lit(field), F.col("key")).alias("key"), "period", F.col("n").cast("bigint").alias("n")) for field, df in existence.items()),
    )
    # written once: the optimiser would else compute them anew for every referring table
    orphans = Scratch(rows.sparkSession).put(orphan_keys(deltas, have).select("ref_table", "ref_field", F.substring_index("key", "\x1f", -1).alias("key"), "period"))
    hits = rows.join(orphans, ["ref_table", "ref_field", "key", "period"], "left_semi")
    return hits.select("ref_table", "ref_field", "period", F.col("row_id").alias("tag_id"), F.col("key").alias("missing_key")).distinct()


def _space(existence: dict[str, DataFrame]) -> Column:
    named = [f for f in existence if f != "*"]
    return F.when(F.col("ref_field").isin(named), F.col("ref_field")).otherwise(F.lit("*")) if named else F.lit("*")


def tag_orphans(status: DataFrame, usage: DataFrame, translations: DataFrame, tags: DataFrame, mapping: DataFrame) -> DataFrame:
    """The orphan report of the tag database; see ``find_orphans`` for columns and edge cases."""
    text = lambda c: F.col(c).cast("string")
    pair = F.concat_ws(":", text("format_id"), text("type_id"))
    references = [
        Reference("tag_status", "preferred_tag_id", status, "tag_id", text("preferred_tag_id"), F.col("created_at")),
        Reference("tag_status", "type_id", status, "tag_id", F.when((F.col("type_id") != -1) & F.col("format_id").isNotNull(), pair), F.col("created_at")),
        Reference("tag_usage_counts", "tag_id", usage, "tag_id", text("tag_id"), F.col("created_at")),
        Reference("tag_translations", "tag_id", translations, "tag_id", text("tag_id"), F.col("created_at")),
    ]
    one = F.lit(1).alias("n")
    existence = {
        "*": tags.where("tag_id is not null").select(text("tag_id").alias("key"), F.coalesce(month(F.col("created_at")), F.lit(ALWAYS)).alias("period"), one),
        "type_id": mapping.where("format_id is not null and type_id is not null").select(pair.alias("key"), F.lit(ALWAYS).alias("period"), one),
    }
    return find_orphans(references, existence)
