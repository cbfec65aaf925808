"""Phrase removal, seeded degradation, samples by threshold and to a target distribution."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from promptmill.operators import distribution, ranking, rewriting, sampling


def removed(spark, texts, phrases=rewriting.BOOSTERS):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = rows.select("i", rewriting.without_phrases("t", phrases).alias("o")).collect()
    return [r.o for r in sorted(out, key=lambda r: r.i)]


def test_boosters_go(spark):
    assert removed(spark, [
        "a cat, masterpiece", "Masterpiece, best  quality, a cat", "a cat, 8k, on a mat",
        "best quality high quality 8K cat", "a masterpieces shop", "18k gold", "8k", None, "",
        "high quality,ultra detailed,  award winning ,a dog", "cat (masterpiece) dog",
        "émasterpiece", "masterpiece\n8k\nlake"]) == [
        "a cat", "a cat", "a cat, on a mat", "cat", "a masterpieces shop", "18k gold", "", "", "",
        "a dog", "cat () dog", "émasterpiece", "lake"]


def test_longest_phrase_goes(spark):
    phrases = ["detailed", "ultra detailed", "ultra detailed lake", "lake house"]
    assert removed(spark, ["an ultra detailed lake house", "detailed ultra lake", "ultra detailed sea",
                           "ultra  detailed", "Detailed detailed, x"], phrases) == [
        "an house", "ultra lake", "sea", "", "x"]


KEYWORDS = [("blur", "mild", ["soft", "hazy", "blurry", "dim"]), ("blur", "severe", ["black"])]


def test_degradation(spark):
    rows = [(i, "a cat, masterpiece", "blur", "mild") for i in range(4000)]
    rows += [(5000, "8k", "blur", "mild"), (5001, None, "blur", "severe"),
             (5002, "a cat, 8k", "text_error", "mild"), (5003, "a dog", None, None)]
    df = spark.createDataFrame(rows, "record_id long, prompt string, dimension string, severity string")
    got = {r.record_id: r for r in rewriting.degraded(df, KEYWORDS, 3).collect()}
    counts, behind = Counter(), 0
    for i in range(4000):
        parts = got[i].degraded.split(", ")
        assert parts[0] == "a cat" or parts[-1] == "a cat"
        behind += parts[0] == "a cat"
        words = [p for p in parts if p != "a cat"]
        assert len(set(words)) == len(words) == got[i].n_keywords <= 3
        assert set(words) <= {"soft", "hazy", "blurry", "dim"}
        counts[len(words)] += 1
    assert abs(counts[1] / 4000 - 0.5) < 0.03 and abs(counts[2] / 4000 - 0.25) < 0.03
    assert abs(behind / 4000 - 0.7) < 0.03
    assert got[5000].degraded and "8k" not in got[5000].degraded
    assert (got[5001].degraded, got[5001].n_keywords) == ("black", 1)
    assert (got[5002].degraded, got[5002].n_keywords) == ("a cat", 0)
    assert got[5003].degraded == "a dog"
    again = rewriting.degraded(df.repartition(7), KEYWORDS, 3).collect()
    assert {r.record_id: r.degraded for r in again} == {i: r.degraded for i, r in got.items()}


def first_by_hash(rows, k_of):
    """Sorts every group."""
    groups, out = defaultdict(list), {}
    for g, i in rows:
        groups[g].append((hashlib.md5(f"{g}|{i}".encode()).hexdigest(), i))
    for g, own in groups.items():
        for n, (_, i) in enumerate(sorted(own)[:k_of(g)]):
            out[g, i] = n + 1
    return out


@pytest.mark.parametrize("digits", [1, 4])
def test_top_k_by_hash(spark, monkeypatch, digits):
    monkeypatch.setattr(ranking, "HASH_DIGITS", digits)
    rng = random.Random(digits)
    rows = [(rng.choice("aaaaabc"), i) for i in range(3000)] + [("d", 5000 + i) for i in range(7)]
    want = {"a": 500, "b": 1, "c": 0, "d": 9}
    df = spark.createDataFrame(rows, "g string, i long").repartition(5)
    df = df.withColumn("h", F.md5(F.concat_ws("|", "g", "i"))).withColumn(
        "k", F.when(F.col("g") == "a", 500).when(F.col("g") == "b", 1).when(
            F.col("g") == "c", 0).otherwise(9))
    got = {(r.g, r.i): r.rank for r in ranking.top_k_by_hash(df, ["g"], "h", "i", "k").collect()}
    assert got == first_by_hash(rows, want.get)
    nulls = df.withColumn("g", F.when(F.col("g") != "a", F.col("g")))
    top = ranking.top_k_by_hash(nulls, ["g"], "h", "i", 3).collect()
    assert Counter(r.g for r in top) == {None: 3, "b": 3, "c": 3, "d": 3}
    assert ranking.top_k_by_hash(df.limit(0), ["g"], "h", "i", 3).count() == 0


def test_large_sample_equals_the_sorted_one(spark):
    """23,000 of a hot group of 40,000 rows; only one bin of the group is sorted to cut it."""
    df = spark.range(60_000).select(
        F.col("id").alias("record_id"),
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.lit("cold")).alias("g"))
    got = {(r.g, r.record_id): r.sample_rank
           for r in sampling.reservoir_sample(df, "g", 23_000, 5).collect()}
    rows = [(g, i) for i in range(60_000) for g in ["hot" if i % 3 else "cold"]]
    groups = defaultdict(list)
    for g, i in rows:
        groups[g].append((hashlib.md5(f"5|{g}|{i}".encode()).hexdigest(), i))
    want = {(g, i): n + 1 for g, own in groups.items()
            for n, (_, i) in enumerate(sorted(own)[:23_000])}
    assert got == want


def shared_out(supply, total):
    """Round by round, with fractions."""
    have = {c: a for c, (a, _) in supply.items()}
    weight = {c: w for c, (_, w) in supply.items()}
    total = min(total, sum(have.values()))
    short = set()
    while True:
        rest = total - sum(have[c] for c in short)
        open_ = sum(w for c, w in weight.items() if c not in short)
        share = {c: Fraction(rest * w, open_) for c, w in weight.items() if c not in short}
        more = {c for c, s in share.items() if s >= have[c]}
        if not more:
            break
        short |= more
        if len(short) == len(have):
            return have
    take = {c: have[c] if c in short else int(share[c]) for c in have}
    left = total - sum(take.values())
    for c in sorted(share, key=lambda c: (-(share[c] - int(share[c])), c))[:left]:
        take[c] += 1
    return take


def test_apportionment(spark):
    rng = random.Random(3)
    for _ in range(12):
        supply = {f"c{i}": (rng.choice([0, 1, 5, 40, 300]), rng.choice([1, 2, 8, 15]))
                  for i in range(rng.randint(1, 9))}
        total = rng.choice([0, 1, 7, 50, 200, 5000])
        df = spark.createDataFrame([(c, a, w) for c, (a, w) in supply.items()],
                                   "category string, available long, weight long")
        got = {r.category: r.take for r in distribution.apportioned(df, total).collect()}
        assert got == shared_out(supply, total), (supply, total)


def test_distributed_sample(spark):
    shares = {"a": 3, "b": 1, "c": 1}
    rows = [(i, "a" if i % 2 else "b" if i % 4 else "z") for i in range(400)] + [(900, "c")]
    df = spark.createDataFrame(rows, "record_id long, category string")
    got = distribution.distributed_sample(df, 101, 5, shares=shares).collect()
    assert Counter(r.category for r in got) == {"a": 75, "b": 25, "c": 1}
    again = distribution.distributed_sample(df.repartition(6), 101, 5, shares=shares).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert distribution.distributed_sample(df.limit(0), 101, 5, shares=shares).count() == 0


def test_subject_rule(spark):
    df = spark.createDataFrame([("a woman and her dog",), ("sky over a house",), ("a spoon",),
                                ("",)], "p string")
    got = [r[0] for r in df.select(distribution.subject_category(F.lower("p"))).collect()]
    assert got == ["People", "Nature", "Objects", "Objects"]


def test_signature_flags(spark):
    from promptmill.operators import tagging
    rows = [(1, "A woman holding a cup next to two dogs"), (2, "a sign saying 'open'"),
            (3, "it reads 'hello'"), (4, None), (5, "handsome mannequin"), (6, "Close-up of a DOG")]
    df = spark.createDataFrame(rows, "i int, prompt string")
    got = {r.i: {k for k, v in r.asDict().items() if v is True}
           for r in tagging.with_signature_flags(df).collect()}
    assert got == {1: {"contains_hands_visible", "contains_human_subject",
                       "contains_count_constraint", "contains_multiple_distinct_objects"},
                   2: {"contains_explicit_text_literal"}, 3: {"contains_explicit_text_literal"},
                   4: set(), 5: set(), 6: {"contains_closeup_face", "contains_animal_subject"}}


def test_scores(spark):
    from promptmill.operators import runs
    rows = [("a", 0.9, 0.2), ("a", 0.8, 0.5), ("a", None, 0.1), ("b", 0.7, None), ("c", 1.0, 0.5)]
    df = spark.createDataFrame(rows, "severity string, positive_score double, negative_score double")
    assert {tuple(r) for r in runs.score_statistics(df, ["severity"]).collect()} == {
        ("a", 2, 0.85, 0.35, 0.5), ("c", 1, 1.0, 0.5, 0.5)}
    assert sorted(r.severity for r in runs.score_gap_pairs(df).collect()) == ["a", "c"]
    none = runs.score_statistics(df.limit(0)).collect()[0]
    assert none.total_pairs == 0 and none.average_score_difference is None
