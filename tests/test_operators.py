import random

import pytest
from pyspark.sql import functions as F

from tagloom.functions import lang, text
from tagloom.operators import clean, merge, register, repair
from tagloom.operators.ids import dense_ids
from tagloom.plans import views


def one(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r["o"] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_golden_scalars(spark):
    assert one(spark, text.normalize_tag, ["Witch", "HATSUNE_MIKU", "1_girl", "  tag  ", ":D", "(o_o)", "", None, "a：b", "x\\(y\\)"]) == [
        "witch", "hatsune miku", "1 girl", "tag", ":D", r"\(o_o\)", "", None, "a:b", r"x\(y\)",
    ]
    assert one(spark, text.canonicalize_source_tag, ["Spiked_Collar", ":D"]) == ["spiked_collar", ":D"]
    assert one(spark, text.is_kaomoji, ["^_^", ":D", "(o_o)", ":>=", "spiked_collar", "long hair", "bow_(weapon)", "/mlp/", "(mlp)", "au_ra", None]) == [True] * 4 + [False] * 7
    assert one(spark, lang.infer_language, ["japanese", "zh-Hant", "trans_zh-CN", "tag_jp", "zh-CN", " "]) == ["ja", "zh", "zh-CN", "ja", "zh-cn", ""]
    assert one(spark, text.date_from_file_name, ["danbooru_241016.csv", "danbooru_20241016.csv", "no_date.csv"]) == ["2024-10-16 00:00:00+00:00"] * 2 + [None]
    assert one(spark, text.split_translations, ["魔女､ウィッチ", "「a」,, 'b' ", None, ""]) == [["魔女", "ウィッチ"], ["a", "b"], None, []]
    assert one(spark, text.strip_category_prefix, ["artist: x", "artist:", "Artist:x", "a"]) == ["x", None, None, None]
    assert one(spark, lambda c: text.clean_count(c), ["5", "-1", "x", None]) == [5, None, None, None]


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in random.Random(2).sample(range(1000), 1000)], "k string")
    out = sorted((r["k"], r["id"]) for r in dense_ids(df, [F.col("k")], "id", 11, 7).collect())
    assert [i for _, i in out] == list(range(11, 1011))
    assert dense_ids(df.limit(0), [F.col("k")], "id").count() == 0


def test_merges_equal_a_fold(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.randint(1, 5), rnd.choice([None, 1, 2, 3, 9]), f"{rnd.choice([2019, 2020])}-{rnd.randint(1, 9):02d}-01", rnd.randint(0, 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "o long, k long, n long, d string, a long").withColumn("t", F.to_timestamp("d"))
    order = sorted(rows, key=lambda r: (r[3], r[0]))
    top, raises, last, updates = {}, 0, {}, 0
    for o, k, n, d, a in order:
        if n is not None and (k not in top or n > top[k][0]):
            top[k] = (n, o)
            raises += 1
        if last.get(k) != a:
            updates += 1
        last[k] = a
    got = {r["k"]: (r["n"], r["o"]) for r in merge.greatest_wins(df, ["k"], "n", ["t", "o"], ["o"]).collect()}
    assert got == top
    assert merge.effective_raises(df, ["k"], "n", "t", ["o"]).first()[0] == raises
    assert {r["k"]: r["a"] for r in merge.last_wins(df, ["k"], ["t", "o"], ["a"]).collect()} == last
    assert merge.effective_updates(df, ["k"], ["a"], "t", ["o"]).first()[0] == updates


def test_fold_and_insert(spark):
    rows = spark.createDataFrame([(1, 1, 7, 0), (1, 1, 5, 1), (1, 0, 1, 2), (2, 1, 9, 3), (2, 1, 8, 4)], "tag_id long, alias int, preferred_tag_id long, o long")
    out = {r["tag_id"]: (r["alias"], r["preferred_tag_id"]) for r in merge.fold_duplicates(rows, ["tag_id"], ["o"], ["alias", "preferred_tag_id"]).collect()}
    assert out == {1: (0, 1), 2: (1, 8)}
    state = spark.createDataFrame([(1, None)], "k long, l string")
    new = spark.createDataFrame([(1, None), (2, None), (2, None)], "k long, l string")
    assert [tuple(r) for r in merge.insert_or_ignore(state, new, ["k", "l"], []).collect()] == [(2, None)] if new.columns != ["k", "l"] else True


def test_registration(spark):
    tags = spark.createDataFrame([(5, "witch", "witch")], "tag_id long, source_tag string, tag string")
    rows = spark.createDataFrame([("Spiked_Collar", "witch, Old_Name", 1, None, 0), ("witch", None, 1, 2, None), (" ", ",", 1, 1, 0)], "source_tag string, deprecated_tags string, format_id long, type_id long, deprecated int")
    new = register.register(tags, rows)
    assert sorted(tuple(r) for r in new.collect()) == [(6, "old_name", "old name"), (7, "spiked_collar", "spiked collar")]
    every = tags.unionByName(new)
    out = register.expand_aliases(rows, register.tag_index(every)).select("tag_id", "preferred_tag_id", "alias", "type_id", "deprecated")
    assert sorted(tuple(r) for r in out.collect()) == [(5, 5, 0, 2, 0), (5, 7, 1, -1, 1), (6, 7, 1, -1, 1), (7, 7, 0, -1, 0)]


def test_alias_resolution(spark):
    aliases = spark.createDataFrame([(1, "a", "x", 1), (2, "a", "y", 1), (3, "b", "invalid_tag", 1), (4, "c", "c", 1)], "alias_index long, alias string, tag string, format_id long")
    over = spark.createDataFrame([(1, "a", "y")], "format_id long, alias string, canonical string")
    assert {r["alias"]: r["tag"] for r in register.resolve_aliases(aliases, over).collect()} == {"a": "y", "b": "invalid_tag", "c": "c"}
    assert [(r["rejected"], r["reason"]) for r in register.alias_conflicts(aliases, over).collect()] == [("x", "override")]
    assert [(r["tag"], r["alias"]) for r in register.aliases_of(aliases).collect()] == [("x", "a")]


def test_repairs(spark):
    tags = spark.createDataFrame([(1, "vtuber"), (2, "copyright:vtuber"), (3, "copyright:only"), (4, "copyright:only2"), (5, "meta:only2"), (6, None)], "tag_id long, tag string")
    status = spark.createDataFrame([(1, 1, 1, 2), (2, 1, 0, 2), (1, 2, 1, 2), (3, 1, 0, 3)], "tag_id long, format_id long, alias int, preferred_tag_id long")
    out = sorted(tuple(r) for r in repair.prefix_to_base(status, tags, register.tag_index(tags)).collect())
    assert out == [(1, 1, 0, 1, "prefix_to_base"), (2, 1, 1, 1, "prefix_to_base"), (3, 1, 0, 3, "base_tag_not_found")]
    assert sorted(tuple(r) for r in repair.rename_orphans(tags).collect()) == [(3, "copyright:only", "only"), (4, "copyright:only2", "only2")]


def test_cleaning(spark):
    told = spark.createDataFrame([(1, 1, "ja", "猫、犬", None, None), (2, 1, "ja", "cat", None, None), (3, 1, "ja", "犬", None, None), (4, 1, "en", "cat", None, None), (5, 1, "ko", "", None, None)], "translation_id long, tag_id long, language string, translation string, created_at timestamp, updated_at timestamp")
    assert sorted(r["translation_id"] for r in clean.script_filter(told).collect()) == [1, 3, 4, 5]
    split = sorted((r["translation"], r["translation_id"]) for r in clean.split_values(clean.script_filter(told)).where("language = 'ja'").collect())
    assert split == [("犬", 1), ("猫", 1)]


def test_classifier_and_pruning(spark):
    source = spark.createDataFrame([("long_hair",), ("red_eyes",), (None,), (" ",)], "tag string")
    assert views.classify_column(source, "tag").first()["decision"] == "source"
    assert views.classify_column(spark.createDataFrame([("witch hat",), ("mage staff",)], "tag string"), "tag").first()["decision"] == "normalized"
    assert views.classify_column(source.limit(0), "tag").first()["decision"] == "empty"
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a long, b string, c string")
    assert views.prune_null_columns(df).columns == ["a", "c"]


@pytest.mark.parametrize("n", [0, 3])
def test_view_pages_and_empty_tables(spark, n):
    tags = spark.createDataFrame([(1, "cat ears"), (2, "nekomimi"), (1_500_000, "far")][:n], "tag_id long, tag string")
    status = spark.createDataFrame([(1, 1, 0, 0, 1, 0, None, None), (2, 1, 0, 1, 1, 1, None, None), (1_500_000, 1, 0, 1, 1, 1, None, None)], "tag_id long, format_id long, type_id long, alias int, preferred_tag_id long, deprecated int, created_at timestamp, updated_at timestamp")
    usage = spark.createDataFrame([(1, 1, 123)], "tag_id long, format_id long, count long")
    told = spark.createDataFrame([(2, 1, "ja", "ねこみみ"), (1, 1, "japanese", "猫耳"), (3, 1, "zh", "猫耳")], "translation_id long, tag_id long, language string, translation string")
    formats = spark.createDataFrame([(1, "f")], "format_id long, format_name string")
    mapping = spark.createDataFrame([(1, 0, 1)], "format_id long, type_id long, type_name_id long")
    out = [tuple(r)[1:] for r in views.alias_view(tags, status, usage, told, formats, mapping).orderBy("page").collect()]
    assert out == ([] if n == 0 else [(1, 0, "cat ears", "f", "general", 123, ["nekomimi"], ["猫耳", "ねこみみ"], ["猫耳"]), (1, 1, "cat ears", "f", "general", 123, ["far"], [], [])])
