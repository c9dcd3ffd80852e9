import datetime as dt
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.llm import queries
from tagloom.llm.copies import copies, copy_groups
from tagloom.llm.groups import components, tag_groups
from tagloom.llm.survivor import COPY_PRIOR, COPY_RATE, FALSE_VALUES, SETTLED, START_ACCURACY, claims, fuse, survivors
from tests.oracle import compare

TAGS = "tag_id long, source_tag string, tag string, created_at timestamp, updated_at timestamp, canon string, text string"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.SQL[name], "/root/testdata/sf0.001")


def tags(spark, rows):
    return spark.createDataFrame([(*(list(r) + [None] * (5 - len(r))), "clash", "clash") for r in rows], TAGS)


def words(s):
    return " ".join(sorted(re.findall(r"[^\W_]+", s.lower())))


def test_copies_against_brute_force(spark):
    random.seed(5)
    rows = [(i, random.choice([None, "", "A_b", "b (a)", "x"]), random.choice([None, " ", "a b", "B-A", "a a b", "!!", "Ünï 1", "1 ünï"])) for i in range(1, 400)]
    groups = defaultdict(list)
    for i, s, t in rows:
        text = s if t is None or not t.strip() else t
        if text and words(text):
            groups[words(text)].append(i)
    want = {(min(g), i) for g in groups.values() for i in g if i != min(g)}
    df = tags(spark, rows)
    assert {tuple(r) for r in copies(df).collect()} == want
    assert {r["first_id"]: r["copies"] for r in copy_groups(df).collect()} == {min(g): len(g) for g in groups.values()}


def test_copies_edges(spark):
    df = tags(spark, [(1, None, None), (2, " ", "　"), (3, "…", ""), (4, "long " * 50_000, None), (5, None, "LONG-" * 50_000), (5, None, "LONG-" * 50_000)])
    assert [tuple(r) for r in copies(df).collect()] == [(4, 5)]
    assert copies(df.limit(0)).count() == 0 and copy_groups(df.limit(0)).count() == 0


def test_hot_text(spark):
    df = spark.range(30_000).select((F.col("id") + 1).alias("tag_id"), F.lit("Hot_tag").alias("source_tag"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id"))).alias("tag"))
    assert copies(df).count() == 9_999


def test_survivors(spark):
    t = dt.datetime
    df = tags(spark, [(1, "a_b", "a b", None, None), (2, " ", "b a", t(2020, 1, 1), t(2021, 1, 1)), (3, "B_A", None, t(2019, 1, 1), t(2020, 1, 1)), (4, "b_a", "a-b", t(2020, 1, 1), t(2020, 1, 1)), (5, None, "q", None, None), (6, None, "Q", None, None)])
    assert sorted(tuple(r) for r in survivors(df).collect()) == [(1, 3, 2), (5, None, 5)]
    assert survivors(df.limit(0)).count() == 0


def test_fusion_discounts_copied_votes(spark):
    """Sources 4 to 8 copy one another, false values included, and outvote 1 to 3, which err now and then but each for itself."""
    random.seed(2)
    n, rows, plain = 40, [], Counter()
    own = lambda g, s: (g, s, f"t{g}" if random.random() < 0.85 else f"x{s}{g}", 1)
    copied = lambda g, s: (g, s, f"f{g}" if int(g[1:]) % 2 else f"t{g}", 1)
    for g in range(n):
        rows += [own(f"g{g}", s) for s in (1, 2, 3)] + [copied(f"g{g}", s) for s in (4, 5, 6, 7, 8)]
    for g, _, v, _ in rows:
        plain[g, v] += 1
    naive = sum(max((k, v) for (h, v), k in plain.items() if h == f"g{g}")[1] == f"tg{g}" for g in range(n))
    for g in range(300):  # where the copiers are outvoted
        rows += [own(f"s{g}", s) for s in (1, 2, 3, 9, 10, 11, 12, 13, 14)] + [copied(f"s{g}", s) for s in (4, 5, 6, 7, 8)]
    claimed = spark.createDataFrame(rows, "canon string, source long, value string, n long")
    got = {r["canon"]: r["value"] for r in fuse(claimed).collect()}
    right = sum(got[f"g{g}"] == f"tg{g}" for g in range(n))
    assert right > naive + n // 4, (right, naive)
    assert fuse(claimed.limit(0)).count() == 0


def test_copied_votes_only_are_discounted(spark):
    from tagloom.llm.survivor import COPY_RATE, _votes

    rows = [("same", 1, "x"), ("same", 2, "x"), ("same", 3, "y"), ("other", 1, "z"), ("other", 2, "x"), ("alone", 2, "x")]
    claimed = spark.createDataFrame([(c, s, v, 1) for c, s, v in rows], "canon string, source long, value string, n long")
    out = {(r["canon"], r["value"]): r["score"] for r in _votes(claimed, {1: 3.0, 2: 2.0, 3: 2.0}, {2: {1: 0.9, 3: 0.5}}).collect()}
    assert out == pytest.approx({("same", "x"): 3.0 + 2.0 * (1 - COPY_RATE * 0.9), ("same", "y"): 2.0, ("other", "z"): 3.0, ("other", "x"): 2.0, ("alone", "x"): 2.0})


def sequential_fusion(rows):
    """The same estimates one claim after another."""
    groups = defaultdict(lambda: defaultdict(dict))
    for canon, source, value, n in rows:
        groups[canon][value][source] = n
    sources = sorted({s for _, s, _, _ in rows})
    accuracy, copies_of = dict.fromkeys(sources, START_ACCURACY), {}
    for _ in range(20):
        p, total, count = {}, Counter(), Counter()
        for canon, values in groups.items():
            score = {}
            for value, told in values.items():
                score[value] = sum(
                    math.log(FALSE_VALUES * accuracy[s] / (1 - accuracy[s])) * math.prod(1 - COPY_RATE * copies_of.get(s, {}).get(o, 0.0) for o in told if o != s) for s in told
                )
            top = max(score.values())
            mass = sum(math.exp(x - top) for x in score.values())
            for value, told in values.items():
                p[canon, value] = math.exp(score[value] - top) / mass
                for s, n in told.items():
                    total[s] += p[canon, value] * n
                    count[s] += n
        before, accuracy = accuracy, {s: max(0.05, min(0.95, total[s] / count[s])) for s in sources}
        if max(abs(accuracy[s] - before[s]) for s in sources) < SETTLED:
            break
        copies_of = {}
        for i, a in enumerate(sources):
            for b in sources[i + 1 :]:
                kinds = Counter()
                for canon, values in groups.items():
                    lead = {x: max((told[x], p[canon, v], v) for v, told in values.items() if x in told) for x in (a, b) if any(x in told for told in values.values())}
                    if len(lead) == 2:
                        kinds["differ" if lead[a][2] != lead[b][2] else "true" if lead[a][1] >= 0.5 else "false"] += 1
                if not kinds:
                    continue
                x, y, c = accuracy[a], accuracy[b], COPY_RATE
                true, false, origin = x * y, (1 - x) * (1 - y) / FALSE_VALUES, max(x, y)
                ratio = kinds["true"] * math.log((origin * c + true * (1 - c)) / true) + kinds["false"] * math.log(((1 - origin) * c + false * (1 - c)) / false) + kinds["differ"] * math.log(1 - c)
                odds = math.exp(max(-50, min(50, ratio))) * COPY_PRIOR / (1 - COPY_PRIOR)
                copier, original = (a, b) if x < y else (b, a)
                copies_of.setdefault(copier, {})[original] = odds / (1 + odds)
    return {canon: max((p[canon, v], v) for v in values) for canon, values in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_fusion_against_a_sequential_one(spark, seed):
    random.seed(seed)
    rows = {}
    for g in range(60):
        for source in range(5):
            for _ in range(random.randint(0, 2)):
                rows[f"g{g}", source, random.choice(["x", "y", "z"] if g % 3 else ["x"])] = random.randint(1, 3)
    rows = [(*k, n) for k, n in rows.items()]
    want = sequential_fusion(rows)
    got = {r["canon"]: (r["probability"], r["value"]) for r in fuse(spark.createDataFrame(rows, "canon string, source long, value string, n long")).collect()}
    assert got.keys() == want.keys()
    for canon, (p, value) in want.items():
        assert got[canon][1] == value and got[canon][0] == pytest.approx(p, abs=1e-6), canon


def test_both_fields_are_fused(spark):
    out = queries.p3_fused(spark, "/root/testdata/sf0.001")
    fields = {r["field_name"]: r["n"] for r in out.groupBy("field_name").agg(F.count("*").alias("n")).collect()}
    assert fields.keys() == {"source_tag", "tag"} and min(fields.values()) > 0


def test_claims(spark):
    df = tags(spark, [(1, None, "a b"), (2, None, "B A"), (3, "x", " ")])
    status = spark.createDataFrame([(1, 7), (1, 8), (1, 8)], "tag_id long, format_id long")
    out = sorted(tuple(r) for r in claims(df, status, "tag").collect())
    assert out == [("a b", -1, "B A", 1), ("a b", 7, "a b", 1), ("a b", 8, "a b", 1)]


def union_find(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    random.seed(seed)
    edges = [(0, i) for i in range(1, 60)]  # a star
    edges += [(1000 + i, 1001 + i) for i in range(40)]  # a chain
    edges += [(59, 2000), (2000, 2001), (2001, 2002), (2002, 2003), (2003, -5)]  # a tail on the star
    edges += [(random.randint(3000, 3300), random.randint(3000, 3300)) for _ in range(150)] + [(5000, 5000), (1003, 1001), (1000, 1040)]
    random.shuffle(edges)
    df = spark.createDataFrame([(a, b, 1) for a, b in edges + edges[:50]] + [(None, 1, 1)], "a long, b long, component int")
    assert {r["node"]: r["component"] for r in components(df).collect()} == union_find(edges)


def test_components_edges(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert components(none).count() == 0
    assert [tuple(r) for r in components(spark.createDataFrame([(4, 4)], "a long, b long")).collect()] == [(4, 4)]


def test_tag_groups(spark):
    df = tags(spark, [(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, None), (6, "z"), (7, "y")])
    status = spark.createDataFrame([(4, 1, 5), (6, 1, 99), (7, 0, 7)], "tag_id long, alias int, preferred_tag_id long")
    alias = spark.createDataFrame([("a", "nowhere"), ("nowhere", "b"), ("y", "y"), (None, "z")], "alias string, tag string")
    assert sorted(tuple(r) for r in tag_groups(df, status, alias).collect()) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    assert tag_groups(df.limit(0), status.limit(0), alias.limit(0)).count() == 0
