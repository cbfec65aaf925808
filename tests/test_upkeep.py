"""Bucketed tables, shard merges, the prompt registry and fed-back success rates."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from promptmill.operators import compat, feedback, prompt_registry, shards, tagging
from promptmill.sources.bucketed import BucketedTable

WORDS = "man hand finger nose dog stone tin ring lea inn seat board 'sign' poster table river".split()
LEXICON = {"has_person": ["man"], "has_hand": ["hand", "finger"], "has_face": ["nose"],
           "has_animal": ["dog"], "has_text": ["board"], "has_logo_or_symbol": ["ring"]}


def table_of(spark, tmp_path, **options):
    return BucketedTable(spark, str(tmp_path / "table"), "id long, value string", ["id"], **options)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "id long, value string")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_changes_touch_their_buckets_only(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=16)
    assert table.version() == 0 and table.read().count() == 0
    table.change(rows_of(spark, [(i, "a") for i in range(200)]))
    first = table.manifest(1)
    assert set(first.values()) == {1}
    assert table.change(rows_of(spark, [(5, "b"), (900, "b")]),
                        rows_of(spark, [(6, None)])) == 2
    second = table.manifest(2)
    moved = {b for b in second if second[b] != first.get(b)}
    assert len(moved) <= 3 and set(second[b] for b in moved) == {2}
    want = {i: "a" for i in range(200)} | {5: "b", 900: "b"}
    del want[6]
    assert dict(content(table.read())) == want
    assert dict(content(table.read(version=1))) == {i: "a" for i in range(200)}


def test_repeated_rows_null_keys_and_emptied_buckets(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=4)
    table.change(rows_of(spark, [(1, "a"), (1, "a"), (None, "n"), (2, None)]))
    assert content(table.read()) == sorted([(1, "a"), (1, "a"), (None, "n"), (2, None)], key=str)
    table.change(rows_of(spark, [(None, "m")]), rows_of(spark, [(2, "x"), (77, "x")]))
    assert content(table.read()) == sorted([(1, "a"), (1, "a"), (None, "m")], key=str)
    table.change(rows_of(spark, []), rows_of(spark, [(1, ""), (None, "")]))
    assert table.read().count() == 0 and table.manifest(table.version()) == {}
    table.change(rows_of(spark, []))
    assert table.read().count() == 0


def test_a_change_that_failed_midway_does_not_count(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=4)
    table.change(rows_of(spark, [(i, "a") for i in range(9)]))
    # what a change leaves that ends before its manifest
    rows_of(spark, [(1, "torn")]).withColumn("bucket", F.lit(0)).write.partitionBy(
        "bucket").parquet(str(tmp_path / "table" / "data" / "version=2"))
    assert {v for _, v in content(table.read())} == {"a"}
    table.change(rows_of(spark, [(1, "b")]))
    assert dict(content(table.read())) == {i: "a" for i in range(9)} | {1: "b"}


def test_spread_keys(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "run string, prompt string, n long", ["run"],
                          buckets=32, spread=8, spread_by=["prompt"])

    def counts(run, n, times):
        return spark.createDataFrame([(run, f"p{i}", times) for i in range(n)],
                                     "run string, prompt string, n long")
    table.change(counts("hot", 300, 1).unionByName(counts("small", 2, 1)))
    used = table.manifest(1)
    assert len(used) >= 8
    # the run comes again with fewer prompts, which lie in fewer buckets
    table.change(counts("hot", 1, 5))
    assert content(table.read()) == [("hot", "p0", 5), ("small", "p0", 1), ("small", "p1", 1)]
    with pytest.raises(ValueError):
        BucketedTable(spark, "x", "a long", ["a"], buckets=10, spread=4)


def test_range_overlaps(spark):
    rng = random.Random(1)
    ranges = []
    for i in range(120):
        low = rng.randrange(0, 20_000)
        ranges.append((i, low, low + rng.choice([0, 1, 7, 64, 100, 3000]) - rng.choice([0, 0, 1])))
    ranges += [(200, None, 5), (201, 5, None), (202, -50, -40), (203, -45, 3), (204, 1 << 40, 1 << 41)]
    df = spark.createDataFrame(ranges, "shard long, first long, last long")
    want = set()
    full = [r for r in ranges if None not in r and r[1] <= r[2]]
    for a, la, ha in full:
        for b, lb, hb in full:
            if a < b and la <= hb and lb <= ha:
                want.add((a, b, min(ha, hb) - max(la, lb) + 1))
    got = [tuple(r) for r in shards.range_overlaps(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert shards.range_overlaps(df.limit(0)).count() == 0


def test_merge_of_shards(spark, monkeypatch):
    """Gaps, an empty shard, a shard that is not listed, a large one, small blocks."""
    monkeypatch.setattr(shards, "BLOCK_BITS", 3)
    rng = random.Random(2)
    listed = [(s, s * 40) for s in (1, 2, 3, 5, 8, 30)]
    rows = [(s, i, "x") for s, n in ((1, 50), (2, 3), (3, 60), (8, 200), (9, 5), (30, 1))
            for i in rng.sample(range(5_000), n)]
    rows += [(None, 4, "x"), (1, None, "x")]
    df = spark.createDataFrame(rows, "shard long, local_id long, merged_by string").repartition(4)
    got = {(r.shard, r.local_id): (r.merged_id, r.seed)
           for r in shards.merged_shards(df, spark.createDataFrame(
               listed, "shard long, base_seed long")).collect()}
    base, want, place = dict(listed), {}, Counter()
    kept = sorted((s, i) for s, i, _ in rows if s in base and i is not None)
    for n, (s, i) in enumerate(kept):
        want[s, i] = (n + 1, base[s] + place[s])
        place[s] += 1
    assert got == want
    report = {r.shard: r for r in shards.shard_report(df, spark.createDataFrame(
        listed, "shard long, base_seed long")).collect()}
    assert {s: r.rows for s, r in report.items()} == {s: place[s] for s in base}
    assert report[5].first_merged_id is None and report[5].rows == 0
    assert report[1].gaps == max(i for s, i in kept if s == 1) - min(
        i for s, i in kept if s == 1) + 1 - 50
    ends = {s: (b, b + place[s] - 1) for s, b in listed if place[s]}
    hits = {s: sum(t != s and ends[t][0] <= ends[s][1] and ends[s][0] <= ends[t][1] for t in ends)
            for s in ends}
    assert {s: r.collisions for s, r in report.items()} == {s: hits.get(s, 0) for s in base}
    assert sum(hits.values()) > 0


def prompts_of(spark, n, seed=0):
    rng = random.Random(seed)
    rows = [(i, f"s{i % 3}", " ".join(rng.choices(WORDS, k=4))) for i in range(n)]
    rows += [(n, "s0", None), (n + 1, None, "")]
    return spark.createDataFrame(rows, "record_id long, source string, prompt string")


def test_registry_equals_a_rebuild(spark, tmp_path):
    registry = prompt_registry.open_registry(spark, str(tmp_path / "r"), buckets=8)
    old, new = prompts_of(spark, 60), prompts_of(spark, 80, seed=5)
    tag = lambda df: tagging.tag_candidates(df, LEXICON)
    prompt_registry.apply_delta(registry, tag(old))
    prompt_registry.apply_delta(registry, tag(new.where("record_id >= 40")))
    prompt_registry.apply_delta(registry, tag(new.where("record_id < 40")),
                                spark.createDataFrame([(3,), (60,)], "record_id long"))
    want = prompt_registry.registry_rows(tag(new)).where("record_id != 60")
    assert content(registry.read()) == content(want)


def test_removed_prompts(spark, tmp_path):
    registry = prompt_registry.open_registry(spark, str(tmp_path / "r"), buckets=8)
    prompt_registry.apply_delta(registry, tagging.tag_candidates(prompts_of(spark, 20), LEXICON))
    gone = spark.createDataFrame([(1,), (2,), (99,)], "record_id long")
    prompt_registry.apply_delta(registry, None, gone)
    assert {r.record_id for r in registry.read().collect()} == set(range(22)) - {1, 2}


def test_registry_is_the_inverse_of_the_subpools(spark):
    tagged = tagging.tag_candidates(prompts_of(spark, 80, seed=9), LEXICON)
    rows = prompt_registry.registry_rows(tagged)
    dims = sorted(compat.tx.REQUIREMENTS)
    want = {(r.record_id, r.dimension) for r in
            compat.dimension_subpools(tagged, dims).select("record_id", "dimension").collect()}
    got = rows.collect()
    assert {(r.record_id, d) for r in got for d in r.compatible} == want
    for r in got:
        assert set(r.compatible) | set(r.excluded) == set(dims)
        assert not set(r.compatible) & set(r.excluded)
        assert set(r.preferred) <= set(r.compatible)
    pool = prompt_registry.prompts_of(rows, "hand_malformation").collect()
    assert {r.record_id for r in pool} == {i for i, d in want if d == "hand_malformation"}
    assert {r.is_preferred for r in pool} == {True, False}


def test_registry_runs_equal_text_rules_once(spark):
    tagged = tagging.tag_candidates(prompts_of(spark, 5), LEXICON)
    rows = prompt_registry.registry_rows(tagged, ["extra_limbs", "face_asymmetry", "text_error"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("missing_face_or_human") == plan.count("missing_quote_or_visual_text") == 1


def log_of(spark, rows):
    return spark.createDataFrame(rows, "run_dir string, positive_prompt string, dimension string, "
                                       "model_id string, success boolean, failure string")


def random_log(seed, runs, n=200):
    rng = random.Random(seed)
    return [(rng.choice(runs), f"p{rng.randrange(6)}", rng.choice(["blur", "count_error"]),
             rng.choice(["m", "n"]), *rng.choice(
                 [(True, None), (False, "positive_content_mismatch"), (False, "style_drift"),
                  (None, None)])) for _ in range(n)]


def test_runs_that_arrive_twice_count_once(spark, tmp_path):
    counts = feedback.open_counts(spark, str(tmp_path / "c"), buckets=16, spread=4)
    first = random_log(1, ["a", "b"])
    again = random_log(2, ["b", "c"], 120) + [(None, "p0", "blur", "m", True, None)]
    feedback.arrive(counts, log_of(spark, first))
    feedback.arrive(counts, log_of(spark, again))
    feedback.arrive(counts, log_of(spark, again))
    whole = [r for r in first if r[0] == "a"] + again
    want = feedback.success_rates(feedback.run_counts(log_of(spark, whole)))
    assert content(feedback.success_rates(counts.read())) == content(want)
    sums = Counter()
    for _, p, d, m, ok, _ in whole:
        sums[p, d, m] += bool(ok)
    assert {(r.positive_prompt, r.dimension, r.model_id): r.valid_pairs
            for r in want.collect()} == dict(sums)


def test_triggers(spark):
    log = log_of(spark, [("a", f"p{i}", "blur", "m", i < 2, None if i < 2 else
                          "positive_content_mismatch") for i in range(6)]
                 + [("a", "p5", "blur", "n", False, "positive_content_mismatch")]
                 + [("a", "q", "count_error", "m", True, None)] * 3)
    rates = feedback.success_rates(feedback.run_counts(log))
    assert [tuple(r) for r in feedback.mismatch_blacklist(rates).collect()] == [("p5", "blur", 2, 2)]
    coverage = spark.createDataFrame(
        [("blur", 30), ("count_error", 30), ("text_error", 90)], "dimension string, available long")
    got = {r.dimension: r for r in feedback.pool_triggers(rates, coverage, low_pool=50).collect()}
    assert {d: r.trigger for d, r in got.items()} == {
        "blur": "backfill", "count_error": "watch", "text_error": "none"}
    assert got["blur"].requested == 20 and got["blur"].blacklisted == 1
    assert got["text_error"].success_rate is None and got["text_error"].pairs == 0
