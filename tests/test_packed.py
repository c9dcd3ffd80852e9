import random
import unicodedata

from pyspark.sql import functions as F

from tagloom.operators.packed import explode_packed, split_packed

DELIMITERS = set(",，、､﹐﹑،;；﹔؛|｜¦￨") | {chr(0x2028), chr(0x2029)}
PAIRS = dict(["“”", "‘’", "「」", "『』", "„“", "«»", "｢｣", "〝〟"])


def delimiter(s, i):
    c = s[i]
    if c in DELIMITERS or unicodedata.category(c) == "Cc":
        return True
    return c == "/" and i > 0 and s[i - 1].isspace() and i + 1 < len(s) and s[i + 1].isspace()


def brute(s):
    """A plain scanner: values in order."""
    if s is None:
        return []
    out, i, n = [], 0, len(s)
    while i <= n:
        j = i
        while j < n and s[j].isspace():
            j += 1
        done = False
        if j < n and (s[j] in "\"'" or s[j] in PAIRS):
            q = s[j]
            k, inner, closed = j + 1, "", False
            while k < n:
                if q in PAIRS:
                    if s[k] == PAIRS[q]:
                        closed = True
                        break
                elif s[k] == q:
                    if k + 1 < n and s[k + 1] == q:
                        inner += q
                        k += 2
                        continue
                    closed = True
                    break
                inner += s[k]
                k += 1
            if closed:
                e = k + 1
                while e < n and s[e].isspace() and not delimiter(s, e):
                    e += 1
                if e >= n or delimiter(s, e):
                    out.append(inner.strip())
                    i, done = e + 1, True
        if not done:
            e = i
            while e < n and not delimiter(s, e):
                e += 1
            out.append(s[i:e].strip())
            i = e + 1
    return [v for v in out if v]


def test_against_a_scanner(spark):
    random.seed(3)
    alphabet = ["a", "b", "c d", '"', '""', "'", ",", "，", "、", ";", "|", "\t", "\n", "\x1f", " / ", "/", " ", "　", "「", "」", "“", "”", "・", chr(0xF8FF), "x", "0q"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 14))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, s string")
    got = {r["i"]: r["v"] for r in df.select("i", split_packed(F.col("s")).alias("v")).collect()}
    bad = [(t, got[i], brute(t)) for i, t in enumerate(texts) if got[i] != brute(t)]
    assert not bad, ascii(bad[:5])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "  "), (4, "one"), (5, '"a,b"'), (6, "a,a"), (6, "a,a"), (7, ",,;"), (8, '"the ""x"" y" / z')]
    df = spark.createDataFrame([(i, s, "clash", 9) for i, s in rows], "k long, f string, row_id string, pos int")
    out = sorted(tuple(r) for r in explode_packed(df, "k", "f", 2).collect())
    assert out == [(6, 1, "a"), (6, 1, "a"), (6, 2, "a"), (6, 2, "a"), (8, 1, 'the "x" y'), (8, 2, "z")]
    assert explode_packed(df.limit(0), "k", "f").count() == 0


def test_very_long(spark):
    long = "x," * 50_000 + '"' + "y,z" * 300_000 + '",' + '"' + 'a""' * 2000 + '"'
    out = spark.createDataFrame([(1, long)], "k long, f string").select(split_packed(F.col("f")).alias("v")).first()["v"]
    assert len(out) == 50_002 and out[-2] == "y,z" * 300_000 and out[-1] == 'a"' * 2000
