import json
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from tagloom.control import cli, filters
from tagloom.control import sources as control
from tagloom.functions.text import unicode_escape
from tagloom.plans import pipeline
from tagloom.plans.pipeline import build
from tagloom.sources import files, master, sinks
from tagloom.sources.sqlite import detect_shape, format_site, migrate_status, probe_site, read_legacy, read_site, read_table, site_format, unify


def database(path, tables):
    path.parent.mkdir(parents=True, exist_ok=True)
    with sqlite3.connect(path) as con:
        for name, (columns, rows) in tables.items():
            con.execute(f"CREATE TABLE {name} ({columns})")
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return str(path)


def test_row_ranges_and_quoting(spark, tmp_path):
    path = database(tmp_path / "t.sqlite", {"tags": ('name TEXT, "trans_zh-CN" TEXT, n INTEGER', [(f"n{i}", None if i % 7 else "猫", i) for i in range(1000)])})
    df = read_table(spark, path, "tags", ["name", "trans_zh-CN"])
    assert df.columns == ["row_id", "name", "trans_zh-CN"] and df.count() == 1000
    small = spark.read.format("tagloom_sqlite").option("path", path).option("table", "tags").option("rowsPerTask", 100).load()
    assert small.rdd.getNumPartitions() == 10 and [r["row_id"] for r in small.orderBy("row_id").limit(2).collect()] == [1, 2]


def test_shapes():
    kinds = {
        "pools": "name post_count pool_count series_count type trans_en", "categories_deprecated": "name post_count category is_deprecated", "categories": "name post_count category created_at", "pointers": "tag num type alias tag_jp",
        "posts": "name posts updated_at wiki_url trans_ja", "walls": "name posts category_id category_name", "totals": "tag type total", "tag_types": "name post_count tag_type",
    }
    for kind, columns in kinds.items():
        assert detect_shape(dict.fromkeys(columns.split(), "TEXT")).kind == kind
    for declared, kind in (("TEXT", "named_types"), ("INTEGER", "integer_types"), ("REAL", "other_types")):
        assert detect_shape({"name": "TEXT", "count": "INTEGER", "type": declared}).kind == kind
    with pytest.raises(ValueError):
        detect_shape({"x": "TEXT"})
    assert site_format("yande.re") == 16 and site_format("x") == 0


def test_site_rows(spark, tmp_path):
    tags = ("name TEXT, post_count INTEGER, category INTEGER, is_deprecated INTEGER", [("cat_girl", 10, 0, 0), ("neko_girl", 1, 0, 1), ("neg", -10, None, 0), (")", 1, 0, 0), ("Abigail", 1, 4, 0), ("Abigail_(Gate)", 2, 4, 0)])
    alias = ("alias TEXT, tag TEXT", [("neko_girl", "cat_girl"), (")", "invalid_tag"), ("abigail", "Abigail"), ("abigail", "Abigail_(Gate)")])
    rows, rivals = read_site(spark, database(tmp_path / "s.sqlite", {"tags": tags, "tag_aliases": alias}), 2)
    out = {(r["source_tag"], r["ord"] > 1000): r for r in rows.collect()}
    assert ("neko_girl", False) not in out and out["cat_girl", False]["aliases"] == ["neko_girl"]
    assert out["neg", False]["count"] is None and out["neg", False]["type_id"] == -1
    assert out[")", True]["type_id"] == 6 and out[")", True]["deprecated"] == 1
    assert [(r["alias"], r["selected"], r["rejected"]) for r in rivals.collect()] == [("abigail", "Abigail", "Abigail_(Gate)")]


def test_build(spark, tmp_path):
    rows = [(1, "witch", 10, 0, None, "魔女､まじょ"), (2, "sorceress", 5, 0, 1, None)]
    database(tmp_path / "anime-pictures.net" / "tags.sqlite", {"tags": ("id INTEGER PRIMARY KEY, tag TEXT, num INTEGER, type INTEGER, alias INTEGER, tag_jp TEXT", rows)})
    database(tmp_path / "unheard.of" / "tags.sqlite", {"tags": ("name TEXT", [("x",)])})
    database(tmp_path / "yande.re" / "tags.sqlite", {"tags": ("name TEXT, count INTEGER, type INTEGER", [("Witch", 3, 0), ("broom_(tool)", 2, 0)])})
    out = build(spark, str(tmp_path))
    tags = {r["tag"]: r["tag_id"] for r in out["tags"].collect()}
    assert tags == {"sorceress": 1, "witch": 2, r"broom \(tool\)": 3}
    status = {(r["tag_id"], r["format_id"]): (r["alias"], r["preferred_tag_id"]) for r in out["tag_status"].collect()}
    assert status == {(2, 14): (0, 2), (1, 14): (1, 2), (2, 16): (0, 2), (3, 16): (0, 3)}
    assert {r["translation"] for r in out["tag_translations"].collect()} == {"魔女", "まじょ"}
    assert [(r["source"], r["reason"]) for r in out["skipped_sources"].collect()] == [("unheard.of", "unknown_site_format")]
    again = build(spark, str(tmp_path), base={"tags": out["tags"]})
    assert again["tags"].count() == 3
    sinks.write_sqlite({"TAGS": out["tags"]}, str(tmp_path / "out.db"))
    with sqlite3.connect(tmp_path / "out.db") as con:
        assert con.execute("SELECT count(*) FROM TAGS").fetchone() == (3,)


def test_files(spark, tmp_path):
    p = str(tmp_path / "a.csv")
    open(p, "w").write("tag,type_id\nlong_hair,1\nRed_Eyes,2,9\nx_y\n")
    out = files.source_column(files.read_csv(spark, p), p)
    assert sorted((r["source_tag"], r["type_id"]) for r in out.collect()) == [("long_hair", "1"), ("red_eyes", "2"), ("x_y", None)]
    open(p, "w").write("tag,type_id\nwitch hat,1\nmage staff,1\n")
    with pytest.raises(files.NormalizedSourceSkipError):
        files.source_column(files.read_csv(spark, p), p)
    assert files.validate(files.source_column(files.read_csv(spark, p), p, files.ColumnOverrides({p: {"tag": "source"}})))
    with pytest.raises(ValueError):
        files.ColumnOverrides({"x": {"tag": "SOURCE"}})
    j = str(tmp_path / "a.json")
    json.dump({"tag": "a", "n": 1}, open(j, "w"))
    assert files.read_json(spark, j).count() == 1
    pairs = spark.createDataFrame([(1, "T", ["a,b", "c"], False), (2, "U", ["d"], True), (3, " ", ["e"], None)], "id int, Title string, other_names array<string>, is_deleted boolean")
    assert sorted(r["translation"] for r in files.translation_pairs(pairs).collect()) == ["a", "b", "c"]
    assert files.REPAIRS["english_dict"](spark.createDataFrame([(1,)], "fomat_id int")).columns == ["format_id"]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb"), (2, None)], "i long, s string")
    path = sinks.write_small_report(df, str(tmp_path / "r.tsv"))
    assert open(path, newline="").read() == "i\ts\r\n1\ta b\r\n2\t\r\n"
    assert sinks.write_small_report(df.limit(0), str(tmp_path / "n.tsv")) is None
    sinks.write_view(df, str(tmp_path / "v"), "i", 1)
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2


def test_control(tmp_path):
    rules = filters.parse_filter("a.csv # x\n\n# y\nsites/*\n")
    assert filters.included("sites/x/y.db", rules, None) and not filters.included("b.csv", rules, None)
    assert filters.included("b.csv", (set(), []), None) and not filters.included("a.csv", rules, ({"a.csv"}, []))
    p = tmp_path / "o.yml"
    p.write_text("alias_resolution:\n  site:\n    a: b\n    c: ''\n    d: 3\n")
    assert filters.load_alias_overrides(str(p)) == [("site", "a", "b")]
    p.write_text("- x")
    with pytest.raises(ValueError):
        filters.load_alias_overrides(str(p))
    assert filters.file_hash(str(tmp_path / "none")) == "absent" and filters.file_hash(str(p)).startswith("sha256:")
    old = {"sources": [{"id": "a", "revision": "1"}, {"id": "b", "revision": "1"}], "build_info": {}}
    new = {"sources": [{"id": "a", "revision": "1"}], "build_info": {}}
    assert not filters.needs_rebuild(old, new) and filters.needs_rebuild(new, old) and filters.needs_rebuild(None, new)


def test_stream(spark, tmp_path):
    from tagloom.streaming.incremental import merge_usage

    schema = "tag_id long, format_id long, count long, created_at timestamp, updated_at timestamp"
    folder, state = str(tmp_path / "in"), {}
    spark.createDataFrame([(1, 1, 5, None, None), (1, 1, 3, None, None), (2, 1, None, None, None)], schema).write.parquet(folder)

    def keep(df, number):
        state["df"] = spark.createDataFrame(df.collect(), df.schema)

    def run():
        q = merge_usage(spark.readStream.schema(schema).parquet(folder), lambda: state.get("df"), keep, str(tmp_path / "cp"))
        q.awaitTermination()

    run()
    spark.createDataFrame([(1, 1, 9, None, None), (3, 1, 1, None, None)], schema).write.mode("append").parquet(folder)
    run()
    assert sorted((r["tag_id"], r["count"]) for r in state["df"].collect()) == [(1, 9), (3, 1)]


def test_master_data(spark):
    from tagloom.sources import master

    assert master.formats(spark).count() == 19 and master.mappings(spark).count() == 96
    once = master.seed(master.formats(spark).limit(3), master.formats(spark), ["format_id"])
    assert master.seed(once, master.formats(spark), ["format_id"]).count() == 19


def test_command(spark, tmp_path):
    from tagloom.control.cli import arguments, run_build

    database(tmp_path / "in" / "yande.re" / "tags.sqlite", {"tags": ("name TEXT, count INTEGER, type INTEGER", [("Witch", 3, 0), ("broom", 2, 4)])})
    args = arguments().parse_args(["build", "--root", str(tmp_path / "in"), "--out", str(tmp_path / "out")])
    assert run_build(spark, args) == 0
    view = {r["tag"]: (r["type_name"], r["count"]) for r in spark.read.parquet(str(tmp_path / "out" / "view.parquet")).collect()}
    assert view == {"witch": ("general", 3), "broom": ("character", 2)}
    assert json.load(open(tmp_path / "out" / "health.json"))["total_tags"] == 2
    (tmp_path / "none").mkdir()
    assert run_build(spark, arguments().parse_args(["build", "--root", str(tmp_path / "none"), "--out", str(tmp_path / "o2")])) == 1


def test_build_on_base(spark, tmp_path):
    from tagloom.control.cli import arguments, run_build

    def table(folder, name):
        return spark.read.parquet(str(tmp_path / folder / f"{name}.parquet"))

    def command(root, out, *more):
        return run_build(spark, arguments().parse_args(["build", "--root", str(tmp_path / root), "--out", str(tmp_path / out), *more]))

    pixiv = ("id INTEGER PRIMARY KEY, tag TEXT, num INTEGER, type INTEGER, alias INTEGER, tag_jp TEXT", [(1, "witch", 10, 0, None, "魔女､まじょ"), (2, "sorceress", 5, 0, 1, None)])
    database(tmp_path / "one" / "anime-pictures.net" / "tags.sqlite", {"tags": pixiv})
    again = ("id INTEGER PRIMARY KEY, tag TEXT, num INTEGER, type INTEGER, alias INTEGER, tag_jp TEXT", [(1, "witch", 7, 1, None, "魔女､ウィッチ")])
    database(tmp_path / "two" / "anime-pictures.net" / "tags.sqlite", {"tags": again})
    database(tmp_path / "two" / "yande.re" / "tags.sqlite", {"tags": ("name TEXT, count INTEGER, type INTEGER", [("Witch", 3, 0), ("broom", 2, 4)])})
    (tmp_path / "none").mkdir()
    assert command("one", "a") == 0
    assert command("two", "b", "--base", str(tmp_path / "a")) == 0
    assert command("none", "c", "--base", str(tmp_path / "b")) == 0
    ids = {r["tag"]: r["tag_id"] for r in table("b", "tags").collect()}
    assert ids == {"sorceress": 1, "witch": 2, "broom": 3}
    for folder in ("b", "c"):
        status = {(r["tag_id"], r["format_id"]): (r["type_id"], r["alias"], r["preferred_tag_id"]) for r in table(folder, "tag_status").collect()}
        assert status == {(1, 14): (0, 1, 2), (2, 14): (1, 0, 2), (2, 16): (0, 0, 2), (3, 16): (4, 0, 3)}
        assert {(r["tag_id"], r["format_id"], r["count"]) for r in table(folder, "tag_usage_counts").collect()} == {(2, 14, 10), (2, 16, 3), (3, 16, 2)}
        told = {r["translation"]: r["translation_id"] for r in table(folder, "tag_translations").collect()}
        assert told.keys() == {"魔女", "まじょ", "ウィッチ"} and told["ウィッチ"] == 3
        assert json.load(open(tmp_path / folder / "health.json"))["total_tags"] == 3
    assert spark.read.parquet(str(tmp_path / "c" / "view.parquet")).count() == spark.read.parquet(str(tmp_path / "b" / "view.parquet")).count() > 0
    # onto itself
    assert command("none", "c", "--base", str(tmp_path / "c")) == 0 and table("c", "tag_status").count() == 4


def test_build_repairs(spark, tmp_path):
    database(tmp_path / "yande.re" / "tags.sqlite", {"tags": ("name TEXT, count INTEGER, type INTEGER", [("artist:ann", 3, 1), ("ann", 2, 1), ("copyright:only", 4, 3), ("odd", 1, 5), ("lost", 1, 99)])})
    tags = [(1, "p1", "__missing_tag_id_1__"), (2, "p2", "__missing_tag_id_2__"), (3, "p3", "__missing_tag_id_3__"), (4, "p4", "__missing_tag_id_4__"), (5, "good", "good"), (6, "best", "best"), (7, "p7", "__missing_tag_id_7__"), (8, "p8", "__missing_tag_id_8__")]
    status = [(1, 1, 0, 1, 5, 0, None), (2, 1, 0, 1, 6, 0, None), (6, 1, 0, 0, 6, 0, None), (3, 1, 0, 1, 3, 0, None), (7, 1, 0, 1, 6, 0, None), (8, 3, 0, 1, 8, 0, None), (5, 4, 0, 1, 8, 1, None)]
    usage = [(1, 1, 9, None, None), (2, 1, 8, None, None), (6, 1, 5, "a", "b"), (3, 1, 7, None, None)]
    told = [(1, 7, "ja", "猫", None, None)]
    base = {
        "tags": spark.createDataFrame(tags, pipeline.TAGS), "tag_status": spark.createDataFrame(status, pipeline.STATUS), "tag_usage_counts": spark.createDataFrame(usage, pipeline.USAGE),
        "tag_translations": spark.createDataFrame(told, pipeline.TRANSLATIONS),
    }
    out = build(spark, str(tmp_path), base)
    ids = {r["tag"]: r["tag_id"] for r in out["tags"].collect()}
    # 8 is still preferred by another tag, 7 has a translation
    assert set(ids) == {"artist:ann", "ann", "only", "odd", "lost", "good", "best", "__missing_tag_id_7__", "__missing_tag_id_8__"}
    rows = {(r["tag_id"], r["format_id"]): (r["alias"], r["preferred_tag_id"]) for r in out["tag_status"].collect()}
    named = {n: rows[ids[n], 16] for n in ("artist:ann", "ann", "only")}
    assert named == {"artist:ann": (1, ids["ann"]), "ann": (0, ids["ann"]), "only": (0, ids["only"])}
    assert {k: v for k, v in rows.items() if k[1] != 16} == {(5, 1): (0, 5), (6, 1): (0, 6), (5, 4): (1, 8)}
    assert {(r["tag_id"], r["count"]) for r in out["tag_usage_counts"].where("format_id = 1").collect()} == {(5, 9), (6, 8)}
    assert {(r["format_id"], r["type_id"], r["type_name_id"], r["reason"]) for r in out["missing_type_format_mapping_repairs"].collect()} == {(16, 99, 0, "fallback_unknown")}
    assert out["tag_type_format_mapping"].count() == 97
    assert {(r["tag"], r["new_preferred_tag"], r["reason"]) for r in out["non_e621_prefix_repairs"].collect()} == {("artist:ann", "ann", "prefix_to_base"), ("copyright:only", None, "base_tag_not_found")}
    assert [(r["old_tag"], r["new_tag"]) for r in out["prefix_tag_renames"].collect()] == [("copyright:only", "only")]
    assert sorted((r["tag_id"], r["action"]) for r in out["placeholder_repairs"].collect()) == [
        (1, "delete_placeholder_after_repair"), (1, "move_usage_count_to_preferred"), (1, "reassign_status_to_preferred"), (2, "delete_placeholder_after_repair"), (2, "delete_redundant_status"), (2, "move_usage_count_to_preferred"),
        (3, "delete_invalid_self_preferred"), (3, "delete_placeholder_after_repair"), (3, "delete_usage_count_unmappable"), (4, "delete_placeholder_only"), (7, "delete_redundant_status"), (7, "has_extra_rows_needs_manual"), (8, "delete_invalid_self_preferred"),
    ]


def test_translations_and_effects(spark, tmp_path):
    database(tmp_path / "s" / "yande.re" / "tags.sqlite", {"tags": ("name TEXT, count REAL, type REAL", [("Witch", 3.0, 0.0), ("broom", 2.5, 1.0)])})
    first = build(spark, str(tmp_path / "s"))
    usage = {r["tag_id"]: r["count"] for r in first["tag_usage_counts"].collect()}
    assert 3 in usage.values()  # whole numbers of a REAL column are counts
    assert {r["type_id"] for r in first["tag_status"].collect()} == {0, 1}
    rows = spark.createDataFrame([("witch", "魔女,まじょ", False), ("nobody", "だれ", False), ("witch", "abc", False)], "tag string, japanese string, is_deleted boolean")
    rows.write.parquet(str(tmp_path / "told" / "train"))

    def broken():
        raise OSError("no such data set")

    told = {"hf://datasets/x/told": lambda: files.read_translations(spark, str(tmp_path / "told")), "hf://datasets/x/broken": broken}
    out = build(spark, str(tmp_path / "s"), base=first, translations_of=told)
    assert {r["translation"] for r in out["tag_translations"].collect()} == {"魔女", "まじょ"}
    effects = {(r["source"], r["action"]): (r["rows_read"], r["db_changes"]) for r in out["source_effects"].collect()}
    assert effects["hf://datasets/x/told", "imported"] == (3, 3) and effects["hf://datasets/x/broken", "read_failed"] == (0, 0)
    assert effects["external_sources/site_tags/yande.re/tags.sqlite", "imported"] == (2, 0)
    assert effects["TAG_TRANSLATIONS", "cleanup_deleted"] == (0, 1) and effects["base", "loaded"] == (2, 0)
    assert {(r["source"], r["db_changes"]) for r in first["source_effects"].collect()} == {("external_sources/site_tags/yande.re/tags.sqlite", 5)}


def test_legacy_database(spark, tmp_path):
    stamps = "created_at TEXT, updated_at TEXT"
    path = database(tmp_path / "old.db", {
        "TAGS": (f"tag_id INTEGER, tag TEXT, source_tag TEXT, {stamps}", [(1, "a", "A", "x", "y"), (2, "b", "b", None, None), (3, "a", "a", None, None)]),
        "TAG_STATUS": (f"tag_id INTEGER, format_id INTEGER, type_id INTEGER, alias INTEGER, preferred_tag_id INTEGER, {stamps}", [(3, 1, 0, 0, 3, None, None), (2, 1, 0, 1, 3, None, None)]),
        "TAG_TRANSLATIONS": (f"translation_id INTEGER, tag_id INTEGER, language TEXT, translation TEXT, {stamps}", [(1, 3, "ja", "あ", None, None)]),
        "TAG_USAGE_COUNTS": (f"tag_id INTEGER, format_id INTEGER, count INTEGER, {stamps}", [(3, 1, 7, None, None)]),
    })
    old = read_legacy(spark, path)
    assert sorted(r["source_tag"] for r in old["tags"].collect()) == ["a", "a", "b"]
    one = unify(old)
    assert sorted((r["tag_id"], r["tag"]) for r in one["tags"].collect()) == [(1, "a"), (2, "b")]
    assert sorted((r["tag_id"], r["preferred_tag_id"]) for r in one["tag_status"].collect()) == [(1, 1), (2, 1)]
    assert one["tag_translations"].first()["tag_id"] == one["tag_usage_counts"].first()["tag_id"] == 1
    new = migrate_status(one["tag_status"])
    assert [r["deprecated"] for r in new.collect()] == [0, 0] and migrate_status(new).columns == new.columns
    with pytest.raises(ValueError):
        read_legacy(spark, database(tmp_path / "bad.db", {"TAGS": ("tag_id INTEGER", [(1,)])}))
    assert probe_site(path) == {"name_column": "tag", "has_aliases": False} and format_site(16) == "yande.re" and format_site(99) is None


def test_finished_database(spark, tmp_path):
    path = str(tmp_path / "out.db")
    tables = {"TAG_FORMATS": master.formats(spark), "TAG_TYPE_NAME": master.type_names(spark), "TAGS": spark.createDataFrame([(1, "a", "a", "not there")], "tag_id long, source_tag string, tag string, more string")}
    sinks.write_database(tables, path, "v1")
    sinks.set_version(path, "v2")
    assert not sinks.create_database(path)
    with sqlite3.connect(path) as con:
        assert con.execute("SELECT value FROM DATABASE_METADATA WHERE key = 'version'").fetchall() == [("v2",)]
        assert con.execute("SELECT count(*) FROM TAG_TYPE_NAME WHERE description = ''").fetchone() == (20,)
        assert con.execute("SELECT created_at IS NOT NULL FROM TAGS").fetchone() == (1,)
        assert {r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'index' AND name LIKE 'idx%'")} == set(sinks.SQLITE_INDEXES)
        con.execute("PRAGMA foreign_keys = ON")
        with pytest.raises(sqlite3.IntegrityError):
            con.execute("INSERT INTO TAGS (tag_id, source_tag, tag) VALUES (2, 'x', 'a')")
        con.execute("INSERT INTO TAG_TYPE_FORMAT_MAPPING VALUES (1, 0, 1, '')")
        with pytest.raises(sqlite3.IntegrityError):
            con.execute("INSERT INTO TAG_STATUS (tag_id, format_id, type_id, alias, preferred_tag_id) VALUES (1, 1, 0, 1, 1)")
        with pytest.raises(ValueError):
            sinks.apply_profile(con, "other")
    assert [r["description"] for r in master.mappings(spark).where("format_id = 2 and type_id = 2").collect()] == ["contributor"]


def test_more_reports(spark, tmp_path):
    conflicts = spark.createDataFrame([("a", 1, "type_id", 0, 1)], "tag string, format_id long, kind string, old_value long, new_value long")
    out = sinks.export_conflicts(conflicts, str(tmp_path / "c"))
    assert out["alias_changes"] is None and open(out["type_id_conflicts"]).read().splitlines() == ["tag,format_id,old_value,new_value", "a,1,0,1"]
    p = sinks.write_unknown_column({"decision": "unknown", "underscore": 0.5, "confidence": "low\tx"}, "/data/f.csv", "tag", str(tmp_path / "u"))
    assert p.endswith("f__unknown_tag.tsv") and open(p).read().splitlines()[1].split("\t")[:5] == ["/data/f.csv", "tag", "unknown", "low x", "0.5"]
    view = spark.createDataFrame([(i, i % 3) for i in range(1, 200)], "tag_id long, v long")
    sinks.write_view_shards(view, str(tmp_path / "v"), ids_per_shard=50)
    assert sorted(x for x in os.listdir(tmp_path / "v") if x.startswith("shard")) == ["shard=0", "shard=1", "shard=2", "shard=3"]
    assert sorted(r["tag_id"] for r in sinks.read_view_range(spark, str(tmp_path / "v"), 40, 60, ids_per_shard=50).collect()) == list(range(40, 61))
    sinks.write_report(view, str(tmp_path / "r"), order=[F.desc("v"), "tag_id"])
    assert [r["tag_id"] for r in spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "r")).limit(2).collect()] == ["2", "5"]
    meta = sinks.write_metadata(spark.createDataFrame([("m", 1)], "metric string, value long"), str(tmp_path / "m.json"), {"v": view}, None, str(tmp_path / "m"))
    assert meta["schema"] == {"v": [{"name": "tag_id", "type": "bigint"}, {"name": "v", "type": "bigint"}]} and meta["generated_at"].endswith("+00:00")
    values = ["a\\b", "é日", "\x00\n\t\x7f", "😀", ""]
    got = spark.createDataFrame([(x,) for x in values], "s string").select("s", unicode_escape(F.col("s")).alias("e")).collect()
    assert {r["s"]: r["e"] for r in got} == {s: s.encode("unicode_escape").decode() for s in values}


def test_source_control(spark, tmp_path):
    p = tmp_path / "sources.yml"
    p.write_text("sources:\n - {id: a, applies_to: [x, y]}\n - {id: b, enabled: false, applies_to: [x]}\n - {id: c, repo_id: o/c}\n")
    listed = control.load_sources(str(p))
    assert [s["id"] for s in listed] == ["a", "c"] and [s["id"] for s in control.for_target(listed, "x")] == ["a"]
    e = tmp_path / "e.tsv"
    e.write_text("external_sources/a/t.csv\timported\t5\t2\tn\nhf://datasets/o/c\timported\t5\t0\tn\nshort\trow\n")
    rows = control.read_effects(str(e))
    assert len(rows) == 2 and [(r["source"], s["id"]) for r, s in control.effective(rows, listed)] == [("external_sources/a/t.csv", "a")]
    e.write_text("source\taction\trows_read\tdb_changes\tnote\nhf://datasets/o/c\timported\t5\t1\tn\n")
    assert [s["id"] for _, s in control.effective(control.read_effects(str(e)), listed)] == ["c"] and control.matching_source("else", listed) is None
    e.write_text("metric\tvalue\na\t1\nb\n")
    assert control.read_summary(str(e)) == {"a": "1"} and control.read_summary("none") == {} == dict(control.read_effects("none"))
    assert control.is_snapshot("/x/Danbooru_241016.csv") and not control.is_snapshot("danbooru_24.csv") and not control.is_snapshot("danbooru_241016.csv.bak")
    assert control.latest(str(tmp_path), "*.none") is None and control.latest(str(tmp_path), "*.yml") == str(p)
    assert control.join_filters(["b # x\na\n", "# y\na\nc"]) == ["b", "a", "c"]
    m = control.create_manifest("1", "x", listed, "now", base_db={"revision": "r"}, statistics={})
    filters.write_manifest(str(tmp_path / "m.json"), m["sources"], m["build_info"])
    assert control.load_manifest(str(tmp_path / "m.json"))["build_info"]["base_db"] == {"revision": "r"} and control.load_manifest("none") is None
    q = tmp_path / "f.csv"
    q.write_text("tag\nwitch hat\nred_eyes\nx_y\nmage staff\n")
    source = control.FileSource(spark, str(q), report_folder=str(tmp_path / "u"))
    with pytest.raises(files.NormalizedSourceSkipError):
        source.read()
    assert os.listdir(tmp_path / "u") == ["f__unknown_tag.tsv"] and source.repair(1) == 1
    with pytest.raises(ValueError):
        control.FileSource(spark, "x.doc").read()


def test_commands(spark, tmp_path):
    database(tmp_path / "s" / "yande.re" / "tags.sqlite", {"tags": ("name TEXT, count INTEGER, type INTEGER", [("Witch", 3, 0), ("meta:x", 2, 1)])})
    a = cli.arguments().parse_args(["build", "--root", str(tmp_path / "s"), "--out", str(tmp_path / "o"), "--sqlite", str(tmp_path / "o.db"), "--version", "7"])
    assert cli.run_build(spark, a) == 0
    assert json.load(open(tmp_path / "o" / "health.json"))["total_tags"] == 2
    with sqlite3.connect(tmp_path / "o.db") as con:
        assert con.execute("SELECT count(*) FROM TAG_STATUS").fetchone() == (2,)
    status = spark.read.parquet(str(tmp_path / "o" / "tag_status.parquet"))
    for name, report in (("health", "health_details"), ("inversions", "prefix_inversions"), ("unicode", "bad_unicode")):
        assert cli.run_report(spark, cli.arguments().parse_args([name, "--tables", str(tmp_path / "o"), "--out", str(tmp_path / "r")])) == 0
        assert os.path.isdir(tmp_path / "r" / report)
    assert status.count() == 2


def test_status_keeps_its_stamps(spark, tmp_path):
    import datetime as dt

    database(tmp_path / "s" / "yande.re" / "tags.sqlite", {"tags": ("name TEXT, count INTEGER, type INTEGER", [("a", 3, 0), ("b", 2, 1), ("c", 1, 0)])})
    t = dt.datetime(2020, 1, 1)
    base = {
        "tags": spark.createDataFrame([(1, "a", "a"), (2, "b", "b"), (3, "z", "z")], "tag_id long, source_tag string, tag string"),
        "tag_status": spark.createDataFrame([(1, 16, 0, 0, 1, 0, None, t, t), (2, 16, 5, 0, 2, 0, None, t, t), (3, 1, 0, 0, 3, 1, "then", t, t)], "tag_id long, format_id long, type_id long, alias int, preferred_tag_id long, deprecated int, deprecated_at string, created_at timestamp, updated_at timestamp"),
    }
    out = {r["tag_id"]: r for r in build(spark, str(tmp_path / "s"), base)["tag_status"].collect()}
    assert (out[1]["created_at"], out[1]["updated_at"]) == (t, t)  # nothing changed
    assert out[2]["created_at"] == t and out[2]["updated_at"] > t and out[2]["type_id"] == 1
    assert (out[3]["deprecated_at"], out[3]["updated_at"]) == ("then", t) and out[4]["created_at"] > t
