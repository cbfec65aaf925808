import itertools
import json
import random

from pyspark.sql import functions as F

from promptmill.operators import attempts as at
from promptmill.operators import quotas, runs
from promptmill.sources.readers import RunArtifacts


def write_run(root, name, log, meta, report, dataset=()):
    folder = root / name
    folder.mkdir(parents=True)
    (folder / "dataset.json").write_text(json.dumps({"metadata": meta, "pairs": list(dataset)}))
    (folder / "full_log.json").write_text(json.dumps(log))
    (folder / "validation_report.json").write_text(json.dumps({"summary": report}))


LOG = [
    {"pair_id": "p1", "expected_attribute": "extra_limbs", "positive_prompt": "woman standing",
     "judge_result": {"valid": False, "failure": "insufficient_effect"}},
    {"pair_id": "p2", "expected_attribute": "extra_limbs", "positive_prompt": "woman standing",
     "judge_result": {"valid": False, "failure": "insufficient_effect"}},
    {"pair_id": "p3", "expected_attribute": "object_structure_error",
     "judge_result": {"valid": True, "failure": None}},
    {"pair_id": "p4", "positive_prompt": "dog beside a bicycle",
     "judge_result": {"valid": False, "failure": "content_drift"}},
]
DATASET = [
    {"id": "p3", "positive": {"prompt": "red mug"}, "degradation": {"severity": "mild"}},
    {"id": "p4", "positive": {"prompt": "ignored"},
     "degradation": {"attribute": "penetration_overlap", "severity": "moderate"}},
]


def test_curation_from_run_files(spark, rows, tmp_path):
    write_run(tmp_path, "a/run1", LOG, {"model_id": "flux-schnell"},
              {"total_pairs": 4, "valid_pairs": 1}, DATASET)
    (tmp_path / "incomplete").mkdir()
    (tmp_path / "incomplete" / "dataset.json").write_text('{"metadata": {}, "pairs": []}')
    artifacts = RunArtifacts(spark, str(tmp_path))
    assert artifacts.runs.count() == 1
    pairs = runs.pair_records(artifacts.log, artifacts.dataset_pairs, artifacts.runs)
    by_id = {r["pair_id"]: r for r in rows(pairs)}
    assert by_id["p3"]["positive_prompt"] == "red mug" and by_id["p3"]["severity"] == "mild"
    assert by_id["p4"]["dimension"] == "penetration_overlap"
    assert by_id["p4"]["positive_prompt"] == "dog beside a bicycle"
    assert {r["model_id"] for r in by_id.values()} == {"flux-schnell"}
    listed = rows(runs.blacklist(pairs, 2))
    assert [(r["dimension"], r["failure_count"], r["failure_types"]) for r in listed] == [
        ("extra_limbs", 2, "insufficient_effect:2")]
    decisions = {r["pair_id"]: (r["decision"], r["reason"])
                 for r in rows(runs.curation_decisions(pairs, 2))}
    assert decisions == {
        "p1": ("blacklist_candidate", "prompt_repeatedly_failed_in_same_model_dimension"),
        "p2": ("blacklist_candidate", "prompt_repeatedly_failed_in_same_model_dimension"),
        "p3": ("keep", "pair_valid"), "p4": ("review", "content_drift")}
    assert rows(runs.memory_stats(pairs, 2))[0] == {
        "runs": 1, "pairs": 4, "invalid_pairs": 3, "blacklist_candidates": 1,
        "decided_blacklist": 2, "decided_keep": 1, "decided_review": 1}
    patterns = {(r["model_id"], r["dimension"], r["failure"]): r["pairs"]
                for r in rows(runs.failure_patterns(pairs))}
    assert patterns[("*", "*", "insufficient_effect")] == 2
    assert patterns[("flux-schnell", "penetration_overlap", "content_drift")] == 1


def test_run_statistics_and_speed_golden(spark, rows, tmp_path):
    log = [{"dimension": "blur", "severity": "moderate", "success": True, "total_attempts": 1,
            "final_validation": {"failure": None}},
           {"dimension": "blur", "severity": "severe", "success": False, "total_attempts": 2,
            "final_validation": {"failure": "insufficient_effect"}},
           {"dimension": "blur", "success": True}]
    write_run(tmp_path, "run", log, {"model_id": "flux-schnell",
                                     "created_at": "2026-03-14T12:00:00",
                                     "completed_at": "2026-03-14T12:01:40"},
              {"total_pairs": 2, "valid_pairs": 1})
    write_run(tmp_path, "later", [], {"model_id": "sdxl", "created_at": "x",
                                      "completed_at": "2026-03-15T00:00:00"}, {"total_pairs": 5})
    artifacts = RunArtifacts(spark, str(tmp_path))
    joined = artifacts.log.drop("model_id").join(artifacts.runs.select("run_dir", "model_id"),
                                                 "run_dir")
    flat = joined.withColumn("failure", F.col("final_validation.failure"))
    stats = {r["severity"]: r for r in rows(runs.run_statistics(flat))}
    assert stats["moderate"]["valid_pairs"] == 1 and stats["severe"]["invalid_pairs"] == 1
    assert stats["severe"]["avg_attempts"] == 2.0 and len(stats) == 2
    histogram = rows(runs.failure_histogram(flat))
    assert [(r["failure"], r["pairs"]) for r in histogram] == [("insufficient_effect", 1)]
    speed = rows(runs.generation_speed(artifacts.runs))
    assert speed == [{"model_id": "flux-schnell", "avg_pair_seconds": 50.0,
                      "avg_success_pair_seconds": 100.0, "avg_image_seconds": 25.0,
                      "run_count": 1}]
    newest = rows(runs.recent_runs(artifacts.runs, 1))
    assert newest[0]["model_id"] == "sdxl"


ATTEMPT = "pair_id long, attempt int, status string, failure string, style_type string"


def simulate(attempts, max_retries):
    """The rule as a loop over the attempts of one pair."""
    anchored_positive = anchored_negative = False
    for n, (status, failure, style) in enumerate(attempts):
        if status == "success":
            yield "done"
        elif status == "skipped":
            yield "stop_skipped"
        elif status == "failed" and failure == "positive_content_mismatch":
            yield "stop_content_mismatch"
        elif status == "failed" and failure == "positive_incompatible" and anchored_positive:
            yield "stop_still_incompatible"
        else:
            is_incompatible = status == "failed" and failure == "positive_incompatible"
            is_drift = status == "failed" and failure == "style_drift" and bool(style)
            if n >= max_retries:
                yield "stop_exhausted"
            elif is_incompatible:
                yield "anchor_positive"
            elif is_drift and not anchored_negative:
                yield "anchor_negative"
            else:
                yield "rewrite"
            anchored_positive |= is_incompatible
            anchored_negative |= is_drift


def random_attempts(seed):
    r = random.Random(seed)
    failures = ["positive_incompatible", "style_drift", "content_drift",
                "positive_content_mismatch"]
    data = {}
    for pair in range(150):
        data[pair] = [(r.choice(["failed"] * 6 + ["error", "success", "skipped"]),
                       r.choice(failures), r.choice(["realistic", None, ""]))
                      for _ in range(r.randrange(1, 7))]
        data[pair] = [(s, f if s == "failed" else None, t if s == "failed" else None)
                      for s, f, t in data[pair]]
    return data


def test_next_actions_follow_the_loop(spark):
    data = random_attempts(2)
    table = [(p, n, *a) for p, attempts in data.items() for n, a in enumerate(attempts)]
    random.Random(1).shuffle(table)
    df = spark.createDataFrame(table, ATTEMPT)
    got = {(r["pair_id"], r["attempt"]): r["next_action"]
           for r in at.next_actions(df, 4).collect()}
    want = {(p, n): a for p, attempts in data.items()
            for n, a in enumerate(simulate(attempts, 4))}
    assert got == want


def test_pair_outcomes_and_missing_pairs(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, "failed", "x", "n0"), (1, 1, "success", None, "n1"), (2, 0, "failed", "y", "m0")],
        "pair_id long, attempt int, status string, failure string, negative_prompt string")
    outcomes = at.pair_outcomes(df)
    planned = spark.createDataFrame([(1,), (2,), (3,)], "pair_id long")
    got = {r["pair_id"]: r for r in rows(at.with_error_pairs(planned, outcomes))}
    assert (got[1]["success"], got[1]["total_attempts"], got[1]["final_negative_prompt"]) == (
        True, 2, "n1")
    assert (got[2]["success"], got[2]["final_failure"]) == (False, "y")
    assert (got[3]["success"], got[3]["total_attempts"], got[3]["final_failure"]) == (
        False, 0, "error")
    pairs = at.with_error_pairs(planned, outcomes).withColumn("dimension", F.lit("blur"))
    summary = rows(runs.validation_summary(pairs))[0]
    assert (summary["total_pairs"], summary["retry_success"], summary["first_try_success"],
            summary["all_retries_failed"]) == (3, 1, 0, 1)
    assert rows(runs.validation_by_dimension(pairs))[0] == {
        "dimension": "blur", "valid": 1, "invalid": 1, "attempts": 3}
    types = {r["failure"]: r["pairs"] for r in rows(runs.validation_failure_types(df, pairs))}
    assert types == {"x": 1, "y": 1, "error": 1}


def test_positive_anchor_defaults_to_realistic(spark):
    df = spark.createDataFrame([("p", "painting"), ("p", None)], "p string, s string").coalesce(1)
    assert [r[0] for r in df.select(at.anchored_prompt("p", "s")).collect()] == [
        "painting style, p", "realistic style, photorealistic, p"]


def test_reuse_and_timing(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", True, 4.0), (1, "a", True, 6.0), (2, "c", False, 1.0)],
        "seed int, pair_id string, success boolean, seconds double").withColumn(
        "positive_image_path", F.concat(F.lit("i-"), "pair_id"))
    got = {r["seed"]: (r["positive_image_path"], r["negatives"])
           for r in rows(at.positive_reuse(df))}
    assert got == {1: ("i-a", 2), 2: ("i-c", 1)}
    assert rows(at.reuse_totals(df))[0] == {"total_positive_images": 2, "total_negative_images": 3}
    timing = rows(runs.timing_summary(df))[0]
    assert (timing["success_rate"], timing["avg_time_per_image"]) == (66.7, 2.75)


def test_allocation_tables(spark, rows):
    stats = spark.createDataFrame(
        [(m, f"d{i}", "mild", 10, v) for m in ("m1", "m2") for i, v in enumerate(range(8))],
        "model_id string, dimension string, severity string, pairs long, valid_pairs long")
    ranked = rows(quotas.allocation_rankings(stats, 2))
    m1 = [r for r in ranked if r["model_id"] == "m1"]
    assert {r["dimension"] for r in m1 if r["best_rank"] <= 2} == {"d7", "d6"}
    assert {r["dimension"] for r in m1 if r["worst_rank"] <= 2} == {"d0", "d1"}
    dims = spark.createDataFrame([("d0",), ("d7",), ("none",)], "dimension string")
    pool = spark.createDataFrame([("m1", "d7", 12)], "model_id string, dimension string, count long")
    template = {r["dimension"]: r for r in rows(
        quotas.allocation_template(dims, ["m1", "m2"], pool, stats))}
    assert template["d7"]["m1_pool_size"] == 12 and template["d7"]["m2_pool_size"] is None
    assert template["d7"]["m1_historical_success"] == 0.7
    assert template["none"]["m1_historical_success"] is None


def test_every_rule_is_reached():
    seen = set(itertools.chain.from_iterable(
        simulate(a, 4) for s in range(5) for a in random_attempts(s).values()))
    assert len(seen) == 8


def test_missing_fields_of_a_run_log(spark, rows):
    log = spark.createDataFrame(
        [("r", "a", "m", "blur", "mild", True, 2, None), ("r", "b", "m", "blur", "mild", None, None, [1, 2, 3]),
         ("r", "c", "m", "blur", "mild", None, None, None)],
        "run_dir string, pair_id string, model_id string, dimension string, severity string, "
        "success boolean, total_attempts long, attempts array<int>")
    (got,) = rows(runs.run_statistics(log))
    assert (got["pairs"], got["valid_pairs"], got["invalid_pairs"], got["total_attempts"]) == (3, 1, 2, 5)
    (got,) = rows(runs.failure_histogram(log.withColumn("failure", F.lit(None).cast("string"))))
    assert (got["failure"], got["pairs"]) == ("unknown", 2)
    (got,) = rows(runs.validation_summary(log))
    assert (got["valid_pairs"], got["invalid_pairs"], got["all_retries_failed"]) == (1, 2, 1)


def test_an_empty_verdict_is_no_verdict(spark, rows):
    verdict = "struct<valid:boolean,failure:string>"
    log = spark.createDataFrame(
        [("r", "a", "blur", None, "mild", "p", True, (None, None), (True, None)),
         ("r", "b", "blur", None, "mild", "p", True, (False, "weak"), (True, None))],
        "run_dir string, pair_id string, dimension string, expected_attribute string, severity string, "
        f"positive_prompt string, success boolean, final_validation {verdict}, judge_result {verdict}")
    pairs = spark.createDataFrame([], "run_dir string, pair_id string, d_prompt string, "
                                      "d_attribute string, d_severity string")
    known = spark.createDataFrame([("r", "m")], "run_dir string, model_id string")
    got = {r["pair_id"]: (r["valid"], r["failure"]) for r in rows(runs.pair_records(log, pairs, known))}
    assert got == {"a": (True, None), "b": (False, "weak")}
