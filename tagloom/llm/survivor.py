"""Best representative of each duplicate group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.copies import canonical_words, is_blank, record_text
from tagloom.tables import Scratch


def survivors(records: DataFrame) -> DataFrame:
    """``tag_id, source_tag_from, tag_from``: one row a group of two or more copies.

    The field values come from members chosen by fixed rules: source_tag from
    the latest updated_at, tag from the earliest created_at, among members whose
    field is not blank; ties go to the smaller tag_id; null where no member
    qualifies. Partial aggregation holds one candidate a group and partition, so
    a group with a third of all rows costs no more than any other. The grouping
    key is the canonical text, computed on distinct raw rows only where that
    saves work: fields and dates make the rows of a group differ, so here each
    row is canonicalised once and nothing is joined back.
    """
    rows = records.select("tag_id", "source_tag", "tag", "created_at", "updated_at", canonical_words(record_text()).alias("canon")).where("canon is not null")
    # null sorts first: as the earliest for the one, behind a flag as the latest for the other
    late = F.struct("updated_at", (-F.col("tag_id")).alias("i"))
    early = F.struct(F.col("created_at").isNull().alias("none"), "created_at", F.col("tag_id").alias("i"))
    groups = rows.groupBy("canon").agg(
        F.min("tag_id").alias("tag_id"),
        F.count("*").alias("members"),
        (-F.max(F.when(~is_blank(F.col("source_tag")), late))["i"]).alias("source_tag_from"),
        F.min(F.when(~is_blank(F.col("tag")), early))["i"].alias("tag_from"),
    )
    return groups.where("members > 1").select("tag_id", "source_tag_from", "tag_from")


#: Values a source could give by mistake, as the fusion model assumes.
FALSE_VALUES = 10.0
START_ACCURACY = 0.8
COPY_PRIOR = 0.2
COPY_RATE = 0.8


def claims(records: DataFrame, status: DataFrame, *fields: str) -> DataFrame:
    """``canon, source, value, n``: what each source says of each group's field, equal claims counted.

    A record's sources are the formats under which tag_status lists it; records
    without a status row speak for source -1. Of several fields, ``canon`` and
    ``source`` are those of the field ``k``: its number stands before the
    canonical text, and the source is ``source * fields + k``, so that each field
    has accuracies and copying of its own in one fusion.
    """
    own = records.select("tag_id", *fields, canonical_words(record_text()).alias("canon")).where("canon is not null")
    sources = status.select("tag_id", F.col("format_id").alias("source")).distinct()
    told = own.join(sources, "tag_id", "left").withColumn("source", F.coalesce("source", F.lit(-1)).cast("long"))
    if len(fields) > 1:
        each = [F.struct(F.concat(F.lit(f"{k} "), "canon").alias("canon"), (F.col("source") * len(fields) + k).alias("source"), F.col(f).alias("value")) for k, f in enumerate(fields)]
        told = told.select(F.inline(F.array(*each)))
    else:
        told = told.withColumnRenamed(fields[0], "value")
    return told.where(~is_blank(F.col("value"))).groupBy("canon", "source", "value").agg(F.count("*").alias("n"))


_PAIRS = "a long, b long, same_true long, same_false long, differ long"


def _count_pairs(batches):
    """Counted in small arrays over the sources met; what is shuffled is one row a pair of sources and partition."""
    import numpy as np
    import pandas as pd

    for pdf in batches:
        known = np.unique([x["source"] for group in pdf["s"] for x in group]) if len(pdf) else np.zeros(0, np.int64)
        total = np.zeros((3, len(known), len(known)), np.int64)
        for group in pdf["s"]:
            at = np.searchsorted(known, [x["source"] for x in group])
            order = np.argsort(at)
            at, value = at[order], np.array([group[k]["value"] for k in order], object)
            true = np.array([group[k]["true"] for k in order], bool)
            kind = np.where(value[:, None] != value[None, :], 2, np.where(true, 0, 1)[:, None])
            a, b = np.triu_indices(len(at), 1)
            np.add.at(total, (kind[a, b], at[a], at[b]), 1)
        a, b = np.nonzero(total.sum(axis=0))
        yield pd.DataFrame({"a": known[a], "b": known[b], **{c: total[k][a, b] for k, c in enumerate(("same_true", "same_false", "differ"))}})


def _pair_counts(voted: DataFrame) -> DataFrame:
    """``a, b, same_true, same_false, differ`` of each two sources, over all groups both speak of.

    Groups come in as one array of (source, value, truth), which holds each
    source's leading claim only and is thus no longer than the number of sources.
    """
    lead = voted.groupBy("canon", "source").agg(F.max(F.struct("n", "p", "value")).alias("best"))
    per_group = lead.groupBy("canon").agg(F.collect_list(F.struct("source", F.col("best.value").alias("value"), (F.col("best.p") >= 0.5).alias("true"))).alias("s")).where(F.size("s") > 1)
    return per_group.select("s").mapInPandas(_count_pairs, _PAIRS)


def _votes(claimed: DataFrame, weight: dict[int, float], originals: dict[int, dict[int, float]]) -> DataFrame:
    """``canon, value, score``: the sum of the weights of the sources that claim a value.

    ``originals`` has, for each source, the better ones it may have copied from
    and how probably. A vote is discounted for each of them that makes the same
    claim, and for no other. Each combination of sources is worked out once.
    """
    per_value = claimed.groupBy("canon", "value").agg(F.array_sort(F.collect_set("source")).alias("s"))
    return _scored(per_value, weight, originals)


def _scored(per_value: DataFrame, weight: dict[int, float], originals: dict[int, dict[int, float]]) -> DataFrame:
    sent = per_value.sparkSession.sparkContext.broadcast((weight, originals))

    def score(batches):
        weights, of = sent.value
        known: dict[tuple[int, ...], float] = {}
        for pdf in batches:
            out = []
            for key in map(tuple, pdf["s"]):
                if key not in known:
                    known[key] = sum(weights[x] * math.prod(1 - COPY_RATE * of.get(x, {}).get(y, 0.0) for y in key if y != x) for x in key)
                out.append(known[key])
            yield pdf[["canon", "value"]].assign(score=out)

    return per_value.select("canon", "value", "s").mapInPandas(score, "canon string, value string, score double")


def _dependence(pairs: DataFrame, accuracy: dict[int, float]) -> dict[int, dict[int, float]]:
    """For each source the better ones, and the probability that it copies from them, from shared true, shared false and differing values."""
    originals: dict[int, dict[int, float]] = {}
    for r in pairs.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("same_true", "same_false", "differ"))).collect():  # one row a pair of sources
        acc_a, acc_b, c = accuracy[r["a"]], accuracy[r["b"]], COPY_RATE
        origin, both_true, both_false = max(acc_a, acc_b), acc_a * acc_b, (1 - acc_a) * (1 - acc_b) / FALSE_VALUES
        ratio = (
            r["same_true"] * math.log((origin * c + both_true * (1 - c)) / both_true)
            + r["same_false"] * math.log(((1 - origin) * c + both_false * (1 - c)) / both_false)
            + r["differ"] * math.log(1 - c)
        )
        odds = math.exp(max(-50.0, min(50.0, ratio))) * COPY_PRIOR / (1 - COPY_PRIOR)
        copier, original = (r["a"], r["b"]) if acc_a < acc_b else (r["b"], r["a"])
        originals.setdefault(copier, {})[original] = odds / (1 + odds)
    return originals


#: Accuracies that move by less than this have settled.
SETTLED = 0.002


def fuse(claimed: DataFrame, rounds: int = 20, max_sources: int = 1000) -> DataFrame:
    """``canon, value, probability``: the value of greatest posterior for each group.

    Bayesian fusion with copy detection. Each round scores a value by the sum of
    its sources' log-odds weights, a copied vote discounted by the probability
    that its source copied from a more accurate one that says the same; turns scores into
    probabilities within the group; re-estimates each source's accuracy as the
    mean probability of its claims; and re-estimates the dependence of each two
    sources from how often they share false values, which independent sources
    seldom do. It ends when no accuracy moves by ``SETTLED``, or after ``rounds``.
    Groups with one value are sure from the start: they count in accuracies and
    dependence once, and only contested ones go through the rounds. More than
    ``max_sources`` sources are an error that names the parameter to raise, for
    tables of them and of their pairs are held in memory. Ties go to the greater
    text. Values without a claim do not arise; an empty table gives an empty one.
    """
    scratch = Scratch(claimed.sparkSession)
    source_ids = [r["source"] for r in claimed.select("source").distinct().limit(max_sources + 1).collect()]  # one row a source
    if len(source_ids) > max_sources:
        raise ValueError(f"more than {max_sources} sources: raise max_sources")
    values = scratch.put(claimed.groupBy("canon", "value").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("told")).select("*", F.col("told.source").alias("s")))
    several = values.groupBy("canon").agg(F.count("*").alias("n")).where("n > 1").select("canon")
    contested = scratch.put(values.join(several, "canon", "left_semi"))
    alone = values.join(several, "canon", "left_anti")
    sure = {r["source"]: r["m"] for r in alone.select(F.inline("told")).groupBy("source").agg(F.sum("n").alias("m")).collect()}  # one row a source
    sure_pairs = alone.where(F.size("s") > 1).select(F.transform("s", lambda x: F.struct(x.alias("source"), F.lit("").alias("value"), F.lit(True).alias("true"))).alias("s")).mapInPandas(_count_pairs, _PAIRS)
    sure_pairs = scratch.put(sure_pairs.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("same_true", "same_false", "differ"))))
    accuracy = dict.fromkeys(source_ids, START_ACCURACY)
    originals: dict[int, dict[int, float]] = {}
    last: tuple[DataFrame, ...] = ()
    for _ in range(rounds):
        weight = {x: math.log(FALSE_VALUES * acc / (1 - acc)) for x, acc in accuracy.items()}
        votes = scratch.put(_scored(contested, weight, originals))
        top = votes.groupBy("canon").agg(F.max("score").alias("top"))
        mass = votes.join(top, "canon").withColumn("e", F.exp(F.col("score") - F.col("top")))
        norm = mass.groupBy("canon").agg(F.sum("e").alias("total"))
        posterior = scratch.put(mass.join(norm, "canon").select("canon", "value", (F.col("e") / F.col("total")).alias("p")))
        scratch.drop(votes, *last)
        voted = scratch.put(contested.select("canon", "value", F.inline("told")).join(posterior, ["canon", "value"]))
        last = (posterior, voted)
        means = {r["source"]: (r["s"], r["m"]) for r in voted.groupBy("source").agg(F.sum(F.col("p") * F.col("n")).alias("s"), F.sum("n").alias("m")).collect()}  # one row a source
        before, accuracy = accuracy, {}
        for x in source_ids:
            s, m = means.get(x, (0.0, 0))
            accuracy[x] = max(0.05, min(0.95, (s + sure.get(x, 0)) / (m + sure.get(x, 0))))
        if max((abs(accuracy[x] - before[x]) for x in source_ids), default=0.0) < SETTLED:
            break
        originals = _dependence(sure_pairs.unionByName(_pair_counts(voted)), accuracy)
    best = posterior.groupBy("canon").agg(F.max(F.struct("p", "value")).alias("b")).select("canon", "b.value", F.col("b.p").alias("probability"))
    return alone.select("canon", "value", F.lit(1.0).alias("probability")).unionByName(best)
