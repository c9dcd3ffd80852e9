import datetime as dt

from pyspark.sql import functions as F

from tagloom.operators.orphans import EXISTENCE_COUNTS, OrphanCounts, Reference, existence_deltas, orphan_keys, reference_deltas, reference_rows, tag_orphans
from tagloom.streaming.incremental import maintain_orphans

T = dt.datetime
STATUS = "tag_id long, format_id long, type_id long, preferred_tag_id long, created_at timestamp, missing_key string"
USAGE = "tag_id long, format_id long, created_at timestamp"


def run(spark, status, usage, told, tags, mapping):
    frames = (
        spark.createDataFrame(status, STATUS),
        spark.createDataFrame(usage, USAGE),
        spark.createDataFrame(told, "translation_id long, tag_id long, created_at timestamp, key string, period string"),
        spark.createDataFrame(tags, "tag_id long, created_at timestamp"),
        spark.createDataFrame(mapping, "format_id long, type_id long"),
    )
    return sorted(tuple(r) for r in tag_orphans(*frames).collect())


def test_cases(spark):
    tags = [(1, T(2020, 5, 9)), (2, None), (3, T(2021, 1, 31)), (None, None)]
    status = [
        (1, 1, 0, 1, T(2020, 5, 1), "x"),  # created the same month: no case
        (9, 1, 7, 3, T(2020, 12, 31), "x"),  # target comes later, type unknown
        (9, 1, 7, 3, T(2020, 12, 31), "x"),
        (5, 1, -1, 3, None, None),  # undated: any record will do
        (6, 1, None, None, T(2020, 1, 1), None),
        (7, 1, 0, 99, None, None),
    ]
    usage = [(2, 1, T(1999, 1, 1)), (1, 1, T(2020, 4, 30)), (None, 1, T(2020, 1, 1))]
    out = run(spark, status, usage, [(1, 77, None, "k", "p")], tags, [(1, 0), (None, 7)])
    assert out == [
        ("tag_status", "preferred_tag_id", "2020-12", 9, "3"),
        ("tag_status", "preferred_tag_id", "unknown", 7, "99"),
        ("tag_status", "type_id", "2020-12", 9, "1:7"),
        ("tag_translations", "tag_id", "unknown", 77, "77"),
        ("tag_usage_counts", "tag_id", "2020-04", 1, "1"),
    ]


def test_empty(spark):
    assert run(spark, [], [], [], [], []) == []
    assert run(spark, [], [(1, 1, None)], [], [], []) == [("tag_usage_counts", "tag_id", "unknown", 1, "1")]


def test_hot_key(spark):
    usage = spark.range(20_000).select((F.col("id") % 3).alias("tag_id"), F.lit(1).cast("long").alias("format_id"), F.lit(T(2020, 1, 1)).alias("created_at"))
    empty = spark.createDataFrame([], STATUS)
    told = spark.createDataFrame([], "translation_id long, tag_id long, created_at timestamp")
    tags = spark.createDataFrame([(1, None)], "tag_id long, created_at timestamp")
    out = tag_orphans(empty, usage, told, tags, spark.createDataFrame([], "format_id long, type_id long"))
    assert sorted(r["missing_key"] for r in out.collect()) == ["0", "2"]


def test_signed_counts(spark):
    refs = spark.createDataFrame([("t", "f", "a", "2020-01", 1), ("t", "f", "a", "2020-03", 1), ("t", "f", "b", "2020-03", 1), ("t", "f", "b", "2020-03", -1)], "ref_table string, ref_field string, key string, period string, n long")
    have = spark.createDataFrame([("a", "2019-12", 1), ("a", "2020-02", -1)], "key string, period string, n long")
    assert [tuple(r) for r in orphan_keys(refs, have).collect()] == [("t", "f", "a", "2020-03", 1)]


def _references(usage):
    return reference_rows(Reference("tag_usage_counts", "tag_id", usage, "tag_id", F.col("tag_id").cast("string"), F.col("created_at")))


def test_maintained_counts_equal_the_full_report(spark, tmp_path):
    rows = [(1, 1, T(2020, 1, 5)), (2, 1, T(2020, 1, 5)), (2, 1, T(2020, 2, 1)), (3, 1, None), (3, 1, None), (None, 1, None)]
    tags = [(1, T(2020, 1, 1)), (2, T(2020, 2, 9)), (3, None)]
    usage, have = spark.createDataFrame(rows, USAGE), spark.createDataFrame(tags, "tag_id long, created_at timestamp")
    first, rest = usage.where("tag_id < 3"), usage.where("tag_id = 3 or tag_id is null")
    counts = OrphanCounts(spark, str(tmp_path / "counts"))
    assert counts.report().count() == 0 and counts.versions() == []
    counts.apply(0, reference_deltas(_references(first)), existence_deltas(have.where("tag_id <> 3")))
    counts.apply(1, reference_deltas(_references(rest)), existence_deltas(have.where("tag_id = 3")))
    full = orphan_keys(reference_deltas(_references(usage)), existence_deltas(have))
    shown = lambda df: sorted(tuple(r) for r in df.collect())
    assert shown(counts.report()) == shown(full) == [("tag_usage_counts", "tag_id", "*\x1f2", "2020-01", 1)]
    # a tag goes and a referring row with it; the same change set again changes nothing
    for _ in range(2):
        counts.apply(2, reference_deltas(_references(usage.where("created_at = timestamp'2020-01-05 00:00:00'")), -1), existence_deltas(have.where("tag_id = 3"), sign=-1))
    assert shown(counts.report()) == [("tag_usage_counts", "tag_id", "*\x1f3", "unknown", 2)]
    assert counts.versions() == [1, 2]
    counts.apply(3, reference_deltas(_references(usage.limit(0))), spark.createDataFrame([], EXISTENCE_COUNTS))
    assert len(shown(counts.report())) == 1


def test_maintained_counts_of_a_stream(spark, tmp_path):
    changes = "ref_table string, ref_field string, key string, period string, n long"
    spark.createDataFrame([("t", "f", "a", "2020-01", 1), (None, None, "b", "2020-01", 1)], changes).write.parquet(str(tmp_path / "in"))
    counts = OrphanCounts(spark, str(tmp_path / "counts"))
    for rows in ([], [(None, None, "a", "2019-01", 1), ("t", "f", "b", "2019-06", 1)]):
        if rows:
            spark.createDataFrame(rows, changes).write.mode("append").parquet(str(tmp_path / "in"))
        maintain_orphans(spark.readStream.schema(changes).parquet(str(tmp_path / "in")), counts, str(tmp_path / "checkpoint")).awaitTermination()
    assert [tuple(r) for r in counts.report().collect()] == [("t", "f", "b", "2019-06", 1)]
