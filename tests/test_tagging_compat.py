import pytest
from pyspark.sql import functions as F

from promptmill.operators import compat, tagging
from promptmill.params import taxonomy as tx
from promptmill.params.taxonomy import Requirement

LEX = {"has_person": ["woman"], "has_hand": ["holding"], "has_text": ["saying"],
       "has_reflective_surface": ["reflection"]}
TAGGED = "record_id long, source string, prompt string, semantic_tags array<string>"


def test_keyword_tags(spark, rows):
    df = spark.createDataFrame([
        (1, 's', 'a woman holding a sign saying "OPEN"'), (2, 's', "a lake reflection at sunset"),
        (3, 's', None)], "record_id long, source string, prompt string")
    got = rows(tagging.tag_candidates(df, LEX).orderBy("record_id"))
    assert {"has_person", "has_hand", "has_text", "has_quoted_text"} <= set(got[0]["semantic_tags"])
    assert "has_reflective_surface" in got[1]["semantic_tags"]
    assert got[2]["semantic_tags"] == []
    for r in got:
        assert r["semantic_tags"] == sorted(set(r["semantic_tags"]))
    counts = {r["tag"]: r["prompts"] for r in rows(tagging.tag_counts(tagging.tag_candidates(df, LEX)))}
    assert counts["has_hand"] == 1


def test_keyword_variant_finds_quoted_text_by_pattern_only(spark):
    lex = {"has_quoted_text": ["quoted"], "has_dog": ["dog"]}
    df = spark.createDataFrame([("quoted dog", ["old"])], "prompt string, old array<string>")
    got = df.select(tagging.keyword_tags("prompt", F.lower("prompt"), lex, "old")).head()[0]
    assert sorted(got) == ["has_dog", "old"]


def test_tag_answers(spark):
    answers = [" Has_Dog,  has_cat", "none", "", "has_dog has_dog x"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, a string")
    got = [r[0] for r in df.orderBy("i").select(
        tagging.parse_tag_answer("a", ["has_dog", "has_cat"])).collect()]
    assert got == [["has_dog", "has_cat"], [], [], ["has_dog"]]


@pytest.mark.parametrize("source, prompt, tags, bucket", [
    ("diffusiondb", "a portrait of a woman holding a sign", ["has_person", "has_hand"],
     "people_face_hands"),
    ("diffusiondb", "three apples on a table", ["has_countable_objects", "has_multiple_objects"],
     "count_constraints"),
    ("diffusiondb", "a scenic mountain lake reflection", ["has_reflective_surface"],
     "reflection_optics"),
    ("diffusiondb", "a cat in a room", ["has_animal"], "animals"),
    ("diffusiondb", "a city street at sunset", [], "general_scenes"),
    ("pick_a_pic_v2", "two people dancing happily", ["has_person", "has_multiple_objects"],
     "people_and_activities"),
    ("pick_a_pic_v2", "a surreal castle", ["has_background"], "creative_but_structured"),
    ("parti_prompts", "anything", [], None),
])
def test_buckets(spark, source, prompt, tags, bucket):
    df = spark.createDataFrame([(1, source, prompt, tags)], TAGGED)
    assert df.select(tagging.assign_bucket("source", "semantic_tags", F.lower("prompt"))
                     ).head()[0] == bucket


MACRO = [
    (1, "s", 'a storefront sign saying "OPEN" above a cafe entrance',
     ["has_text", "has_quoted_text", "has_logo_or_symbol"]),
    (2, "s", "a close-up portrait of a smiling woman in studio lighting",
     ["has_person", "has_face"]),
    (3, "s", "two people dancing on a city street at night",
     ["has_person", "has_multiple_objects"]),
    (4, "s", "a calm lake reflection with mountains", ["has_reflective_surface"]),
]


def test_macro_categories_and_matrix(spark, rows):
    df = tagging.with_macro_category(spark.createDataFrame(MACRO, TAGGED))
    got = [r["macro_taxonomy"] for r in rows(df.orderBy("record_id"))]
    assert got == ["commercial_text_media", "human_portrait", "human_activity_interaction",
                   "natural_landscape"]
    sushi = spark.createDataFrame([(1, "s", "a plate of sushi on a wooden dining table", [])],
                                  TAGGED)
    assert tagging.with_macro_category(sushi).head()["macro_taxonomy"] == "food_tabletop"
    shares = {r["macro_taxonomy"]: (r["prompts"], r["coverage"])
              for r in rows(tagging.macro_distribution(df))}
    assert shares["human_portrait"] == (1, 25.0) and shares["food_tabletop"] == (0, 0.0)
    reqs = {"text_error": Requirement(("has_text",)), "face_asymmetry": Requirement(("has_face",)),
            "reflection_error": Requirement(("has_reflective_surface",))}
    matrix = {r["dimension"]: r for r in rows(
        compat.macro_dimension_matrix(df, list(reqs), reqs))}
    assert matrix["text_error"]["commercial_text_media"] == 1
    assert matrix["face_asymmetry"]["human_portrait"] == 1
    assert matrix["reflection_error"]["natural_landscape"] == 1
    assert matrix["reflection_error"]["total_available"] == 1


def test_coverage_golden(spark, rows):
    df = spark.createDataFrame([
        (1, "s", 'a woman holding a sign saying "OPEN"',
         ["has_person", "has_hand", "has_text", "has_quoted_text"]),
        (2, "s", "a smiling portrait of a man", ["has_person", "has_face"]),
        (3, "s", "a lake reflection at sunset", ["has_reflective_surface"])], TAGGED)
    reqs = {"hand_malformation": Requirement(("has_hand",)),
            "face_asymmetry": Requirement(("has_face",)),
            "reflection_error": Requirement(("has_reflective_surface",)),
            "text_error": Requirement(("has_text",))}
    report = rows(compat.coverage_report(df, list(reqs), reqs).orderBy("scarcity_rank"))
    assert [(r["dimension"], r["available"], r["total"]) for r in report] == [
        (d, 1, 3) for d in sorted(reqs)]
    assert {r["gap_level"] for r in report} == {"scarce"}
    assert {r["coverage"] for r in report} == {33.33}


def special(spark, dimension, prompt):
    df = spark.createDataFrame([(prompt,)], "prompt string")
    return df.select(compat.special_rule_reason(dimension, "prompt", F.lower("prompt"))).head()[0]


def test_special_rules(spark):
    assert special(spark, "text_error", 'a sign "OPEN"') is None
    assert special(spark, "text_error", 'a design "OPEN"') == "missing_quote_or_visual_text"
    assert special(spark, "text_error", "a sign") == "missing_quote_or_visual_text"
    assert special(spark, "extra_limbs", "portrait of a man") is None
    assert special(spark, "extra_limbs", "portrait of a man, back view") == "back_view"
    assert special(spark, "face_asymmetry", "portrait of a man and a dog") == "non_human"
    assert special(spark, "face_asymmetry", "a man in a hat") == "missing_face_or_human"
    assert special(spark, "blur", "anything") is None


@pytest.mark.parametrize("req, tags, every, anyone", [
    (Requirement(("a", "b")), ["a"], False, True), (Requirement(("a", "b")), ["b", "a"], True, True),
    (Requirement(("a",), ("c",)), ["c"], True, True), (Requirement(None, ("c",)), [], True, True),
    (Requirement((), ("c",)), [], True, True), (Requirement(("a",)), [], False, False),
    (None, [], True, True),
])
def test_tag_rules(spark, req, tags, every, anyone):
    df = spark.createDataFrame([(tags,)], "t array<string>")
    got = df.select(compat.tags_satisfied(req, "t", "all"), compat.tags_satisfied(req, "t", "any"))
    assert tuple(got.head()) == (every, anyone)


def test_batch_filter_differs_from_row_filter(spark):
    reqs = {"text_error": Requirement(()), "extra_limbs": Requirement(("has_person",))}
    df = spark.createDataFrame([("no quotes", None)], "prompt string, tags array<string>")
    low = F.lower("prompt")
    verdict = df.select(
        compat.batch_verdict("text_error", "prompt", low, "tags", reqs),
        compat.is_compatible("text_error", "prompt", low, "tags", reqs),
        compat.batch_verdict("extra_limbs", "prompt", low, "tags", reqs),
        compat.batch_verdict("face_asymmetry", "prompt", low, "tags", reqs),
        compat.batch_verdict("face_asymmetry", "prompt", low, "tags", reqs, False)).head()
    assert tuple(verdict) == ("ok", False, "untagged", "special", "ok")


def test_router_and_runtime_rules(spark):
    df = spark.createDataFrame([("a furry toy", ["has_text", "has_animal"]), ("a rock", [])],
                               "prompt string, tags array<string>").coalesce(1)
    low = F.lower("prompt")
    got = [tuple(r) for r in df.select(
        compat.router_reason("logo_symbol_error", "tags"), compat.router_reason("blur", "tags"),
        compat.router_reason("count_error", "tags"), compat.has_preferred("count_error", "tags"),
        compat.runtime_reason("animal_anatomy_error", low, "tags")).collect()]
    assert got == [
        ("ok", "no_requirements", "preferred_only", False, "ok"),
        ("missing_required:has_logo_or_symbol,has_text", "no_requirements", "preferred_only",
         False, "missing_required_tags:has_animal")]


def test_subpools_and_index_agree(spark, rows):
    df = spark.createDataFrame(MACRO, TAGGED)
    pools = {}
    for r in rows(compat.dimension_subpools(df)):
        pools[r["dimension"]] = pools.get(r["dimension"], 0) + 1
    index = {r["dimension"]: r["count"] for r in rows(compat.subpool_index(df))}
    assert set(index) == set(tx.REQUIREMENTS)
    assert {d: n for d, n in index.items() if n} == pools


def test_report_is_one_scan_without_row_explosion(spark):
    df = tagging.tag_candidates(spark.createDataFrame(MACRO, TAGGED).drop("semantic_tags"), LEX)
    plan = compat.coverage_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("partial_count") >= 1


def test_dimension_selection(spark, rows):
    got = [r["dimension"] for r in rows(compat.select_dimensions(
        spark, ["semantic_text", "blur", "text_error", "nope"]).orderBy("ord"))]
    assert got == ["text_error", "logo_symbol_error", "blur"]
    assert compat.select_dimensions(spark).count() == 32


def test_template_guardrails_and_lookup(spark, rows):
    df = spark.createDataFrame([("blur", "BLUR and out of focus"), ("blur", "sharp blur out of focus"),
                                ("dull_palette", "anything")], "d string, t string").coalesce(1)
    assert [r[0] for r in df.select(compat.guardrail_ok("d", "t")).collect()] == [True, False, True]
    requests = spark.createDataFrame([("blur", "mild"), ("blur", "severe"), ("x", "mild")],
                                     "dimension string, severity string")
    member = spark.createDataFrame([("blur", "tech")], "dimension string, subcategory string")
    templates = spark.createDataFrame(
        [("tech", "blur", "mild", "own"), ("tech", None, "mild", "group"),
         ("tech", None, "severe", "group")],
        "subcategory string, attribute string, severity string, template string")
    got = {(r["dimension"], r["severity"]): r["template"] for r in rows(
        tagging.select_template(requests, templates, member))}
    assert got == {("blur", "mild"): "own", ("blur", "severe"): "group", ("x", "mild"): None}


def test_taxonomy_counts():
    assert [len(d) for d in tx.TAXONOMY.values()] == [7, 7, 18] and len(tx.DIMENSIONS) == 32
    assert [r[0] for r in tx.routing_rows()] == tx.DIMENSIONS
