import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from promptmill.operators import quotas, sampling, tagging
from promptmill.operators.ranking import top_k_per_group, unique_rank
from promptmill.params import requests as rq
from promptmill.params import taxonomy as tx
from promptmill.plans.sampling_queries import MIX, MIX_SCHEMA


def md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def skewed(spark, n=4000):
    """Groups 0..4; group 0 holds more than half of the rows. Ids have gaps."""
    r = random.Random(3)
    data = [(i * 7 + r.randrange(5), 0 if r.random() < 0.55 else r.randrange(1, 5))
            for i in range(n)]
    return data, spark.createDataFrame(data, "id long, g int").repartition(7)


@pytest.mark.parametrize("k", [5, 1500])
def test_top_k_equals_brute_force(spark, k):
    data, df = skewed(spark)
    got = top_k_per_group(df, ["g"], [F.md5(F.col("id").cast("string")), "id"], k).collect()
    want = set()
    for g in range(5):
        ids = sorted((i for i, h in data if h == g), key=lambda i: (md5(i), i))[:k]
        want |= {(i, g, n) for n, i in enumerate(ids, 1)}
    assert {tuple(r) for r in got} == want


def test_top_k_trims_before_the_shuffle(spark):
    _, df = skewed(spark)
    small = top_k_per_group(df, ["g"], ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in small
    large = top_k_per_group(df, ["g"], ["id"], 5000)._jdf.queryExecution().executedPlan().toString()
    assert large.count("Window ") >= 2  # parts of a group, then groups


def test_top_k_with_a_limit_per_group(spark):
    _, df = skewed(spark)
    limited = df.withColumn("k", F.col("g") + 1)
    got = Counter(r["g"] for r in top_k_per_group(limited, ["g"], ["id"], 10, "k").collect())
    assert got == {0: 1, 1: 2, 2: 3, 3: 4, 4: 5}


def test_unique_rank_with_gaps_clusters_and_negative_numbers(spark):
    ids = ([*range(-5, 300)] + [2 ** 16 - 1, 2 ** 16, 2 ** 40 - 1, 2 ** 40, 2 ** 40 + 3 * 2 ** 16,
                                -2 ** 63, 2 ** 63 - 1] + [10 ** 12 + i for i in range(200)])
    random.Random(4).shuffle(ids)
    df = spark.createDataFrame([(i, f"text {i}") for i in [*ids, None]], "id long, text string")
    got = sorted(map(tuple, unique_rank(df, "id").select("id", "rank", "text").collect()))
    assert got == [(i, n, f"text {i}") for n, i in enumerate(sorted(ids), 1)]
    assert unique_rank(df.where("id = 0 and id = 1"), "id").count() == 0


POOL = [
    ("diffusiondb", 1, "a portrait of a woman holding a sign", ["has_person", "has_hand", "has_text"]),
    ("diffusiondb", 2, "three apples on a table", ["has_countable_objects", "has_multiple_objects"]),
    ("diffusiondb", 3, "a scenic mountain lake reflection", ["has_reflective_surface"]),
    ("diffusiondb", 4, "a cat in a living room", ["has_animal", "has_indoor_scene"]),
    ("diffusiondb", 5, "a city street at sunset", []),
    ("pick_a_pic_v2", 6, "two people dancing happily", ["has_person", "has_multiple_objects"]),
    ("pick_a_pic_v2", 7, "a surreal floating castle above a forest", ["has_background"]),
    ("t2i_compbench", 8, "two apples and one orange", ["has_countable_objects"]),
]
PLAN = {
    "target_final_pool_size": 7, "planned_top_up_size": 1, "top_up_source": "diffusiondb",
    "sources": [
        {"name": "diffusiondb", "final_selected_size": 4, "buckets": [
            {"name": b, "final_selected_size": 1} for b in
            ("people_face_hands", "count_constraints", "reflection_optics", "general_scenes")]},
        {"name": "pick_a_pic_v2", "final_selected_size": 2, "buckets": [
            {"name": b, "final_selected_size": 1} for b in
            ("people_and_activities", "creative_but_structured")]},
        {"name": "t2i_compbench", "final_selected_size": 0}],
}


def test_stratified_sample_golden(spark):
    df = spark.createDataFrame(
        POOL, "source string, record_id long, prompt string, semantic_tags array<string>")
    bucketed = df.withColumn("bucket", tagging.assign_bucket(
        "source", "semantic_tags", F.lower("prompt")))
    got = sampling.stratified_sample(bucketed, PLAN, 7).collect()
    assert len(got) == 7
    assert Counter(r["source"] for r in got) == {"diffusiondb": 5, "pick_a_pic_v2": 2}
    buckets = Counter(r["assigned_bucket"] for r in got)
    assert buckets["people_face_hands"] == buckets["people_and_activities"] == 1
    assert buckets["top_up"] == 1
    assert sorted(r["pool_rank"] for r in got) == list(range(1, 8))
    again = sampling.stratified_sample(bucketed.repartition(5), PLAN, 7).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in again}


@pytest.mark.parametrize("top_up, target", [(0, 10_000), (300, 10_000), (300, 900)])
def test_stratified_sample_equals_brute_force(spark, top_up, target):
    """Step by step in plain Python, with quotas beyond the group limit threshold."""
    r = random.Random(5)
    names = ["x", "y", "z"]
    data = [(i, r.choices(names, [6, 3, 1])[0], r.choice(["p", "q", None])) for i in range(5000)]
    plan = {"target_final_pool_size": target, "planned_top_up_size": top_up, "top_up_source": "x",
            "sources": [
                {"name": "x", "final_selected_size": 1600, "buckets": [
                    {"name": "q", "final_selected_size": 1200},
                    {"name": "p", "final_selected_size": 100}]},
                {"name": "y", "final_selected_size": 400},
                {"name": "z", "final_selected_size": 9000, "buckets": [
                    {"name": "p", "final_selected_size": 9000}]}]}
    want, used = [], set()
    for n, s in enumerate(plan["sources"]):
        mine = sorted((d for d in data if d[1] == s["name"]),
                      key=lambda d: (md5(11 + n, d[1], d[0]), d[0]))
        chosen = []
        for b in s.get("buckets", []):
            chosen += [(d[0], b["name"]) for d in mine if d[2] == b["name"]][
                :b["final_selected_size"]]
        taken = {c[0] for c in chosen}
        fill = "source_fill" if s.get("buckets") else None
        rest = [(d[0], fill) for d in mine if d[0] not in taken]
        chosen += rest[:max(0, s["final_selected_size"] - len(chosen))]
        used |= {c[0] for c in chosen}
        want += [(i, s["name"], b) for i, b in chosen]
    spare = sorted((d for d in data if d[1] == "x" and d[0] not in used),
                   key=lambda d: (md5(11 + 999, d[1], d[0]), d[0]))
    want += [(d[0], "x", "top_up") for d in spare[:top_up]]
    want = [(*w, n) for n, w in enumerate(want[:target], 1)]
    df = spark.createDataFrame(data, "record_id long, source string, bucket string").repartition(6)
    got = sampling.stratified_sample(df, plan, 11).collect()
    assert sorted(tuple(g) for g in got) == sorted(want)


def test_shards_golden(spark):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(1, 6)], "rank long, sample_id string")
    parts = [sorted(r["sample_id"] for r in sampling.select_shard(df, 2, i).collect())
             for i in range(2)]
    assert parts == [["s1", "s3", "s5"], ["s2", "s4"]]
    with pytest.raises(ValueError):
        sampling.select_shard(df, 2, 2)
    with pytest.raises(ValueError):
        sampling.select_shard(df, 0, 0)


def test_dimension_samples_are_distinct_and_named(spark):
    df = spark.createDataFrame(
        [("blur", 1, " a "), ("blur", 2, "a"), ("blur", 3, "b"), ("blur", 4, " "), ("tint", 5, "a")],
        "dimension string, record_id long, prompt string")
    got = sampling.sample_dimension_prompts(df, 10, 1).collect()
    assert sorted((r["dimension"], r["prompt"]) for r in got) == [
        ("blur", "a"), ("blur", "b"), ("tint", "a")]
    for r in got:
        sha = hashlib.sha1(r["prompt"].encode()).hexdigest()[:16]
        assert r["sample_id"] == f"{r['dimension']}-{r['rank']:05d}-{sha}"


def test_degradation_draws(spark):
    df = spark.range(200).withColumnRenamed("id", "record_id")
    types = ["a", "b", "c"]
    balanced = sampling.degradation_draws(df, types, 3, 1).collect()
    assert len(balanced) == 600
    per = {}
    for r in balanced:
        per.setdefault(r["record_id"], set()).add(r["degradation_type"])
    assert all(v == set(types) for v in per.values())
    repeated = sampling.degradation_draws(df, types, 5, 1).collect()
    assert len(repeated) == 1000 and {r["degradation_type"] for r in repeated} == set(types)
    keyed = spark.range(4000).select(sampling.severity(key=F.col("id").cast("string")).alias("s"))
    shares = {r["s"]: r["count"] / 4000 for r in keyed.groupBy("s").count().collect()}
    assert abs(shares["mild"] - 0.2) < 0.03 and abs(shares["severe"] - 0.4) < 0.03


def test_resume_skips_successful_keys_only(spark):
    # a success of another prompt with the same first 100 characters finishes nothing
    work = spark.createDataFrame([("p" * 120, "blur", "mild"), ("q", "blur", "mild"),
                                  ("p" * 100 + "other", "blur", "mild")],
                                 "prompt string, dimension string, severity string")
    log = spark.createDataFrame([("p" * 100 + "other", "blur", "mild", True),
                                 ("q", "blur", "mild", False)],
                                "positive_prompt string, dimension string, severity string, "
                                "success boolean")
    left = sorted(r["prompt"] for r in sampling.without_completed(work, log).collect())
    assert left == ["p" * 120, "q"]


def test_pool_sizes_golden(spark):
    df = spark.createDataFrame([("hand_malformation", 0.2, True), ("blur", 0.8, False)],
                               "dimension string, weight double, constrained boolean")
    got = {r["dimension"]: r for r in quotas.pool_sizes(df, 1000, 5).collect()}
    assert got["blur"]["estimated_pairs"] == 800
    assert got["blur"]["required_positive_prompts"] == 160
    assert got["hand_malformation"]["required_positive_prompts"] == 60
    assert got["blur"]["target_positive_pool_size"] == 200
    zero = spark.createDataFrame([("a", -1.0), ("b", 0.0)], "dimension string, weight double")
    assert {r["weight"] for r in quotas.normalize_weights(zero).collect()} == {0.5}
    with pytest.raises(ValueError):
        quotas.pool_sizes(df, 0, 5)


def test_source_ranking(spark):
    sources = spark.createDataFrame([("tiny", 10), ("small", 100), ("large", 10000)],
                                    "name string, prompt_count long")
    coverage = spark.createDataFrame(
        [(n, d, c) for n, c in [("tiny", 0.9), ("small", 0.8), ("large", 0.5)] for d in "ab"],
        "name string, dimension string, coverage double")
    ranked = quotas.rank_sources(sources, coverage, ["a", "b"]).collect()
    assert [r["name"] for r in ranked] == ["large", "small", "tiny"]


def backfill(spark):
    plans = spark.createDataFrame(
        [("d1", 100, 1, "A", "m1", "hands_visible_template"), ("d2", 7, 1, "B", "m2", "unlisted"),
         ("d3", 300, 2, "A", "m1", "portrait_face_template"), ("d4", 5, 3, "C", "m1", "unlisted")],
        "dimension string, target_new_prompts long, priority int, tier string, "
        "coverage_mode string, template_family string")
    mix = spark.createDataFrame(MIX, MIX_SCHEMA)
    override = spark.createDataFrame([("d4", 0, "food_tabletop", 2), ("d4", 1, "human_portrait", 3)],
                                     "dimension string, ord int, macro_bucket string, "
                                     "bucket_prompts long")
    return plans, quotas.scene_mix(plans, mix, override)


def test_scene_mix_adds_up_and_requests_cover_it(spark):
    plans, mixed = backfill(spark)
    parts = {}
    for r in mixed.collect():
        parts.setdefault(r["dimension"], []).append((r["ord"], r["macro_bucket"],
                                                     r["bucket_prompts"]))
    assert sorted(parts["d1"]) == [(0, "human_activity_interaction", 35), (1, "food_tabletop", 25),
                                   (2, "objects_products_tools", 40)]
    assert parts["d2"] == [(0, rq.DEFAULT_SCENE_BUCKET, 7)]
    assert sorted(parts["d4"]) == [(0, "food_tabletop", 2), (1, "human_portrait", 3)]
    jobs = quotas.request_plan(plans, mixed, 5).orderBy("request_id").collect()
    assert [j["request_id"] for j in jobs] == list(range(1, len(jobs) + 1))
    assert sum(j["requested_prompts"] for j in jobs) == 412
    assert list(dict.fromkeys(j["dimension"] for j in jobs)) == ["d1", "d2", "d3", "d4"]
    assert [j["requested_prompts"] for j in jobs if j["dimension"] == "d2"] == [5, 2]
    capped = quotas.request_plan(plans, mixed, 5, max_requests=3)
    assert sorted(j["request_id"] for j in capped.collect()) == [1, 2, 3]
    queue = quotas.priority_queue(plans, 2).collect()
    assert [r["dimension"] for r in queue] == ["d1", "d2"]


def test_batches_and_their_status(spark):
    plans, mixed = backfill(spark)
    batches = quotas.batch_plan(quotas.request_plan(plans, mixed, 5), 10)
    n = batches.count()
    results = spark.createDataFrame([(1, True, True), (2, True, False)],
                                    "batch_index long, generated_exists boolean, "
                                    "summary_exists boolean")
    status = quotas.batch_status(batches, results)
    got = {r["batch_index"]: (r["status"], r["is_next"]) for r in status.collect()}
    assert got[1] == ("completed", False) and got[2] == ("pending", True) and got[3][1] is False
    assert quotas.batch_totals(status).head().asDict() == {
        "batch_count": n, "completed_batches": 1, "pending_batches": n - 1,
        "next_pending_batch_index": 2}


def test_request_text(spark):
    jobs = spark.createDataFrame(
        [("unlisted", "global_balanced", "simple", "food_tabletop", 3, "a, b", "")],
        "template_family string, coverage_mode string, complexity_mode string, "
        "macro_bucket string, requested_prompts int, core string, optional string")
    row = quotas.request_text(jobs, 10, 40).head()
    assert row["user_prompt"].startswith("Generate 3 high-quality positive prompts for the macro "
                                         "bucket 'food_tabletop' that support")
    assert rq.DEFAULT_INSTRUCTION in row["user_prompt"]
    assert "Use these core macro buckets: a, b." in row["system_prompt"]
    assert "Use these optional macro buckets: none." in row["system_prompt"]
    assert "forbidden" not in row["system_prompt"] and "10-40 words" in row["system_prompt"]


def test_backfill_summary_levels(spark):
    plans, _ = backfill(spark)
    got = {(r["level"], r["name"]): r["target_new_prompts"]
           for r in quotas.backfill_summary(plans).collect()}
    assert got == {("tier", "A"): 400, ("tier", "B"): 7, ("tier", "C"): 5,
                   ("coverage_mode", "m1"): 405, ("coverage_mode", "m2"): 7, ("total", "all"): 412}


def test_public_source_sizes_are_consistent(spark):
    """The public catalog: five sources, two of them sampled by bucket."""
    catalog = spark.createDataFrame(
        [("diffusiondb", 60000, 14000), ("pick_a_pic_v2", 30000, 9000)],
        "source string, candidate_pool_size int, final_selected_size int")
    parts = spark.createDataFrame(
        [("diffusiondb", b, 2000) for b in tx.BUCKETS["diffusiondb"]]
        + [("pick_a_pic_v2", b, 2250) for b in tx.BUCKETS["pick_a_pic_v2"]],
        "source string, name string, final_selected_size int")
    assert quotas.plan_violations(catalog, catalog, parts).count() == 0
    broken = parts.where("name <> 'animals'")
    assert [r["violation"] for r in quotas.plan_violations(catalog, catalog, broken).collect()] == [
        "bucket_total_mismatch"]
