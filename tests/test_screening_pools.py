import json
import random

import pytest
from pyspark.sql import functions as F

from promptmill.functions import answers
from promptmill.operators import families, pools, screening
from promptmill.params import taxonomy as tx

RECORD = ("record_id long, prompt string, semantic_tags array<string>, "
          "signature map<string,boolean>")


def parsed(spark, raw, recover=False):
    df = spark.createDataFrame([(1, raw)], "request_id int, raw string")
    row = answers.with_result_items(df, "raw", recover=recover).head()
    return row if recover else row["items"]


ITEM = '{"sample_id": "a", "label": "pass", "confidence": 0.5, "reason": "r"}'


@pytest.mark.parametrize("raw, labels", [
    ('{"results": [%s]}' % ITEM, ["pass"]),
    ('```json\n{"results": [%s]}\n```' % ITEM, ["pass"]),
    ('Sure! [%s] done' % ITEM, ["pass"]),
    ('Sure! {"results": []} done', []),
    ('{"other": 1}', []),
    ('[%s]' % ITEM, None),
    ('{"results": [%s' % ITEM, None),
    ('no json at all', None), ('', None),
])
def test_result_items(spark, raw, labels):
    got = parsed(spark, raw)
    assert (got if got is None else [i["label"] for i in got]) == labels


BROKEN = """```json
{"family_name":"family_a","results":[
{"sample_id":"s-1","label":"pass","reason":"one thing stands out"},
{"sample_id":"s-2","label":"fail","reason":"somebody is in front"},
{"sample_id":"s-2","label":"pass","reason":"repeated"},
{"sample_id":"s-3","label":"pass","reason":"a "mark" inside"}
]}
```"""


def test_broken_answer_gives_its_readable_items(spark, rows):
    df = spark.createDataFrame([(1, BROKEN), (2, '{"results": [%s, %s]}' % (ITEM, ITEM))],
                               "request_id int, raw_content string")
    got = rows(screening.parse_family_answers(df).orderBy("request_id", "sample_id"))
    assert [(r["request_id"], r["sample_id"], r["label"]) for r in got] == [
        (1, "s-1", "pass"), (1, "s-2", "fail"), (2, "a", "pass"), (2, "a", "pass")]


def test_answers_meet_their_samples(spark, rows):
    samples = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")],
                                    "request_id int, sample_id string")
    raw = spark.createDataFrame(
        [(1, json.dumps({"results": [
            {"sample_id": " a ", "label": "OK", "confidence": "1.5", "reason": " fine "},
            {"sample_id": "zz", "label": "pass"}]})), (2, "garbage")],
        "request_id int, raw_content string")
    answered = screening.parse_answers(raw)
    got = rows(screening.screened_rows(samples, answered, "strict").orderBy(
        "request_id", "sample_id"))
    assert [(r["label"], r["confidence"], r["reason"], r["keep_by_policy"]) for r in got] == [
        ("pass", 1.0, "fine", True), ("uncertain", 0.0, "missing_in_model_output", False),
        ("uncertain", 0.0, "missing_in_model_output", False)]
    binary = rows(screening.family_screened_rows(samples, answered).orderBy(
        "request_id", "sample_id"))
    assert [r["label"] for r in binary] == ["fail", "fail", "fail"]
    lenient = screening.screened_rows(samples.withColumn("dimension", F.lit("d")), answered)
    summary = rows(screening.screening_summary(lenient))[0]
    assert (summary["pass_count"], summary["uncertain_count"], summary["keep_count"],
            summary["pass_rate"]) == (1, 2, 3, 0.3333)


def test_usage_sums_skip_missing_values(spark, rows):
    raw = spark.createDataFrame([((1, None, 3),), ((2, 5, None),), (None,)],
                                "usage struct<prompt_tokens:int,completion_tokens:int,"
                                "total_tokens:int>")
    assert rows(screening.usage_totals(raw)) == [{
        "request_count": 3, "prompt_tokens": 3, "completion_tokens": 5, "total_tokens": 3}]


@pytest.mark.parametrize("raw, expected, want", [
    ('Here is the JSON array:\n\n```json\n["prompt a", "prompt b", "prompt c"]\n```', 2,
     ["prompt a", "prompt b"]),
    ('["x", 3, " "]', 5, ["x", "3"]),
    ("```\n- one\n\n10. two\n1. three\n---four\n```", 9, ["one", "two", "1. three", "four"]),
    ("", 3, []),
])
def test_prompt_lists(spark, raw, expected, want):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert answers.with_prompt_list(df, "raw", expected).head()["prompts"] == want


JUDGED = '{"valid": false, "style_type": "painting", "failure": %s, "notes": "%s"}'


@pytest.mark.parametrize("raw, valid, style, failure, notes", [
    ('{"valid": true, "scores": {"dimension_accuracy": 0.75}}', True, "realistic", None, ""),
    (JUDGED % ("null", "Style moved"), False, "painting", "style_drift", "Style moved"),
    (JUDGED % ("null", "主体不同"), False, "painting", "content_drift", "主体不同"),
    (JUDGED % ("null", "too faint"), False, "painting", "insufficient_effect", "too faint"),
    (JUDGED % ('"content_drift"', ""), False, "painting", "content_drift", ""),
    ('```json\n{"valid": true, "style_type": "illustration"}\n```', True, "illustration", None, ""),
    ('Result: {"valid": true, "notes": "n",\n}', True, "realistic", None, "n"),
    ('{"valid": true, "notes": "n", "recommended_st', True, "realistic", None, "n"),
    ('{"valid": TRUE "notes": "n"}', True, "realistic", "unknown", "n"),
    ("nothing here", None, None, None, None),
])
def test_judge_answers(spark, raw, valid, style, failure, notes):
    df = spark.createDataFrame([(1, raw)], "i int, raw string")
    row = answers.with_judge_verdict(df, "raw").head()
    assert (row["valid"], row["style_type"], row["failure"], row["notes"]) == (
        valid, style, failure, notes)


PEOPLE = [
    ("full-body photo of a smiling woman standing on a studio floor", ["has_person"], True),
    ("a realistic man standing in a hallway, full length portrait", ["has_person"], False),
    ("portrait close-up of a woman smiling softly", ["has_person", "has_face"], False),
    ("an armored knight in heavy armor standing in battle", ["has_person"], True),
    ("two women standing together in a crowd", ["has_person"], True),
    ("a sensual woman lying in bed, full body view", ["has_person"], True),
    ("a superhero woman flying across the sky", ["has_person"], True),
    ("a dog running in the park", ["has_animal"], False),
]


def people(spark):
    return spark.createDataFrame(
        [(i, p, t, {"has_person": "has_person" in t, "has_full_body": body})
         for i, (p, t, body) in enumerate(PEOPLE)], RECORD)


def test_people_family_golden(spark, rows):
    name = "human_full_body_realistic"
    kept = rows(families.family_candidates(people(spark), name, signature="signature").orderBy(
        "rank"))
    assert [r["prompt"] for r in kept] == [PEOPLE[0][0], PEOPLE[1][0]]
    assert kept[1]["sample_id"].startswith(f"{name}-00002-")
    assert len(kept[1]["sample_id"].rsplit("-", 1)[1]) == 12
    reasons = {r["reason"]: r["prompts"] for r in rows(families.excluded_reasons(
        people(spark), name, signature="signature"))}
    assert reasons == {
        "insufficient_body_readability": 1,
        "contains_non_natural_or_identity_obscuring_human_presentation": 2,
        "contains_multi_person_signal": 1, "contains_bed_or_adult_pose_signal": 1,
        "missing_base_tags": 1}
    assert rows(families.family_summary(people(spark), name, signature="signature"))[0] == {
        "base_rule_recall_count": 7, "candidate_count": 2, "has_full_body_signal": 1,
        "keyword_body_readable": 2}


def test_object_family_golden(spark, rows):
    data = [("a ceramic mug on a wooden desk beside a notebook", ["has_structured_object"]),
            ("a closed silver laptop on an office desk", ["has_structured_object"]),
            ("a woman holding a mug in a cafe", ["has_person", "has_structured_object"]),
            ("a cat beside a food bowl on the floor", ["has_animal", "has_structured_object"]),
            ("portrait of a smiling woman", ["has_person"])]
    df = spark.createDataFrame([(i, p, t, {}) for i, (p, t) in enumerate(data)], RECORD)
    kept = families.family_candidates(df, "structured_object_primary").orderBy("rank")
    assert [r["prompt"] for r in rows(kept)] == [data[0][0], data[1][0]]
    reasons = {r["reason"]: r["prompts"] for r in rows(families.excluded_reasons(
        df, "structured_object_primary"))}
    assert reasons == {"contains_biological_primary_signal": 2, "missing_base_tags": 1}


def test_relation_hints_by_word_and_by_substring(spark, rows):
    data = [("a box nearby", ["has_person"]), ("a box near a door", ["has_person"]),
            ("a field", ["has_multiple_objects"]), ("a box near a door", [])]
    df = spark.createDataFrame([(i, p, t, {}) for i, (p, t) in enumerate(data)], RECORD)
    name = "multi_object_reference"
    by_word = [r["record_id"] for r in rows(families.family_candidates(df, name))]
    by_text = [r["record_id"] for r in rows(families.prefiltered_candidates(df, name))]
    assert sorted(by_word) == [1, 2] and sorted(by_text) == [0, 1, 2]


def test_screened_subpools_golden(spark, rows):
    def sig(face, body):
        return {"has_person": True, "has_face": face, "has_full_body": body}

    source = spark.createDataFrame([
        (1, "body-pass", ["has_person"], sig(True, True)),
        (2, "body-uncertain", ["has_person"], sig(True, True)),
        (3, "face-delta", ["has_face"], sig(True, False)),
        (4, "hand-delta", ["has_hand"], sig(False, False)),
        (5, "animal-pass", ["has_animal"], None), (6, "animal-uncertain", ["has_animal"], None)],
        RECORD)
    kinds = {"body_proportion_error": "body", "face_asymmetry": "face",
             "hand_malformation": "hand", "animal_anatomy_error": "animal"}
    results = [(1, "body_proportion_error", "body-pass", "pass"),
               (2, "body_proportion_error", "body-uncertain", "uncertain"),
               (3, "face_asymmetry", "face-delta", "pass"),
               (4, "hand_malformation", "hand-delta", "uncertain"),
               (5, "animal_anatomy_error", "animal-pass", "pass"),
               (6, "animal_anatomy_error", "animal-uncertain", "uncertain")]
    results += [(10 + i, d, f"{k}-fail", "fail") for i, (d, k) in enumerate(kinds.items())]
    df = spark.createDataFrame(results,
                               "record_id long, dimension string, prompt string, label string")
    pool = rows(pools.screened_subpools(source, df).orderBy("dimension", "part", "result_ord"))
    by_dimension = {}
    for r in pool:
        by_dimension.setdefault(r["dimension"], []).append(r["prompt"])
    assert {d: len(p) for d, p in by_dimension.items()} == {
        "body_proportion_error": 2, "impossible_pose": 2, "extra_limbs": 2,
        "expression_mismatch": 2, "face_asymmetry": 3, "hand_malformation": 3,
        "animal_anatomy_error": 2}
    assert by_dimension["face_asymmetry"] == ["body-pass", "body-uncertain", "face-delta"]
    assert by_dimension["hand_malformation"] == ["body-pass", "body-uncertain", "hand-delta"]


def test_final_index_counts_empty_families(spark, rows):
    results = spark.createDataFrame(
        [(1, "f1", " a", "pass"), (2, "f1", "a ", "PASS"), (3, "f1", "b", "fail")],
        "record_id long, family_name string, prompt string, label string")
    source = spark.createDataFrame([(1, "x", ["has_person"], {}), (2, "x ", ["has_animal"], {}),
                                    (3, "y", [], {})], RECORD)
    fan = spark.createDataFrame([("f1", "d1"), ("f1", "d2"), ("f2", "d3")],
                                "family_name string, dimension string")
    index = {r["dimension"]: (r["count"], r["source_family"])
             for r in rows(pools.finalize_index(results, source, fan))}
    assert index == {"d1": (1, "f1"), "d2": (1, "f1"), "d3": (0, "f2"),
                     "floating_objects": (1, "rule_recall_only")}
    assert rows(pools.family_index(results))[0] == {
        "family_name": "f1", "total_results": 3, "pass_count": 2, "fail_count": 1, "pool_count": 1}


def test_token_budget(spark, rows):
    words = [("blur", "word " * 45), ("color_cast", "word " * 45), ("blur", "word " * 60)]
    df = spark.createDataFrame(words, "dimension string, prompt string")
    got = {(r["dimension"], r["max_tokens"]): (r["kept"], r["dropped_too_long"])
           for r in rows(pools.token_filter_summary(df))}
    assert got == {("blur", 50): (1, 1), ("color_cast", 40): (0, 1)}
    kept = pools.within_token_budget(df, F.lit(300), measure=F.length)
    assert kept.count() == 3


def test_routing_defaults_and_overrides(spark, rows):
    dims = spark.createDataFrame([(d,) for d in tx.DIMENSIONS], "dimension string")
    routing = spark.createDataFrame([r for r in tx.routing_rows() if r[0] != "blur"],
                                    tx.ROUTING_SCHEMA)
    routes = pools.routing_table(dims, routing)
    blur = rows(routes.where("dimension = 'blur'"))[0]
    assert blur["strategy"] == tx.GLOBAL_POOL and blur["base_tags"] == []
    overrides = spark.createDataFrame(tx.SCREENING_OVERRIDES, tx.SCREENING_OVERRIDES_SCHEMA)
    spec = {r["dimension"]: r for r in rows(pools.screening_spec(routes, overrides))}
    assert spec["blur"]["builder_mode"] == tx.RULE_ONLY
    assert spec["penetration_overlap"]["builder_mode"] == tx.RULE_THEN_SCREEN
    assert spec["penetration_overlap"]["base_tags"] == ["has_multiple_objects",
                                                        "has_structured_object"]
    assert spec["floating_objects"]["shared_pool_family"] is None
    warnings = {r["dimension"]: r["warning"] for r in rows(pools.routing_warnings(dims, routing))}
    assert warnings == {"blur": "missing_in_config"}
