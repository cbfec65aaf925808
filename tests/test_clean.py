import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptmill.functions import text
from promptmill.operators import clean
from promptmill.params import lexicon as lx
from promptmill.sources import readers

RAW = [
    (1, "diffusiondb", "  a   cat  on the mat  "), (2, "pick_a_pic_v2", "a cat on the mat"),
    (3, "parti_prompts", "ok"), (4, "longbench_t2i", ""), (5, "t2i_compbench", "a dog in the park"),
]
SCHEMA = "record_id long, source string, prompt string"


def test_exact_dedup_keeps_the_first_and_counts_every_kind(spark, rows):
    df = spark.createDataFrame(RAW, SCHEMA)
    kept = rows(clean.clean_and_dedup(df).orderBy("record_id"))
    assert [r["prompt"] for r in kept] == ["a cat on the mat", "a dog in the park"]
    assert rows(clean.dedup_summary(df)) == [{
        "input_count": 5, "filtered_empty_count": 1, "filtered_short_count": 1,
        "exact_duplicate_count": 1, "output_count": 2}]
    counts = {r["source"]: r["output_count"] for r in rows(clean.dedup_source_counts(df))}
    assert counts == {"diffusiondb": 1, "t2i_compbench": 1}


def test_short_prompts_of_one_source_are_allowed(spark, rows):
    df = spark.createDataFrame([(1, "t2i_compbench", "two apples"),
                                (2, "diffusiondb", "two apples")], SCHEMA)
    assert [r["source"] for r in rows(clean.clean_and_dedup(df))] == ["t2i_compbench"]


def test_length_classes(spark, rows):
    prompts = ["clean full body woman walking in studio light", "cute dragon Disney",
               "the end the end the end the end the end the end the end", "word " * 130,
               "https://example.com image prompt ref",
               "see the picture at https://example.com for more of it"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "i int, prompt string")
    got = [r["drop_reason"] for r in rows(clean.with_length_class(df).orderBy("i"))]
    assert got == ["keep", "short", "noise", "long", "short", "noise"]
    summary = rows(clean.cleaning_summary(df.where("i < 5")))[0]
    assert summary == {"kept": 1, "short": 2, "long": 1, "noise": 1}
    kept, dropped = clean.clean_records(df)
    assert kept.count() == 1 and dropped.count() == 5


def test_flagged_dimensions_are_cleaned_and_others_pass(spark, rows):
    pools = spark.createDataFrame(
        [("a", "too short"), ("b", "too short"), ("c", "too short")],
        "dimension string, prompt string")
    index = spark.createDataFrame([("a", True), ("b", False)],
                                  "dimension string, skip_runtime_compat_filter boolean")
    kept = rows(clean.clean_flagged_subpools(pools, index).orderBy("dimension"))
    assert [r["dimension"] for r in kept] == ["b", "c"]


def test_new_versus_base(spark, rows):
    base = spark.createDataFrame([(1, "old prompt ")], "record_id long, prompt string")
    new = spark.createDataFrame(
        [(10, "old prompt"), (11, "fresh"), (12, " fresh "), (13, " "), (14, "other")],
        "record_id long, prompt string")
    assert sorted(r["record_id"] for r in rows(clean.new_versus_base(new, base))) == [11, 14]


def test_merge_backfill_golden(spark, rows):
    base = spark.createDataFrame([(1, "base", "a red mug")],
                                 "record_id long, source string, prompt string")
    generated = spark.createDataFrame(
        [(2, "a red mug", "blur", "food_tabletop", 1, 1, "m", "global_balanced"),
         (3, "a blue mug", None, "food_tabletop", 1, 2, "m", "global_balanced")],
        "record_id long, prompt string, dimension string, macro_bucket string, request_id int, "
        "prompt_index_in_request int, model string, coverage_mode string")
    merged, summary = clean.merge_backfill(base, generated)
    assert rows(summary)[0] == {
        "base_prompt_count": 1, "generated_prompt_count": 2,
        "normalized_generated_prompt_count": 2, "deduped_new_prompt_count": 1,
        "merged_prompt_count": 2}
    added = rows(merged.where("source = 'llm_backfill'"))[0]
    assert added["assigned_bucket"] == "llm_backfill::unknown"


def test_union_and_index_merge(spark, rows):
    core = spark.createDataFrame([(5, "x"), (6, "y")], "record_id long, prompt string")
    delta = spark.createDataFrame([(1, "y"), (2, "z")], "record_id long, prompt string")
    union = rows(clean.union_first_wins([core, delta]).orderBy("record_id"))
    assert [(r["record_id"], r["priority"]) for r in union] == [(2, 1), (5, 0), (6, 0)]
    old = spark.createDataFrame([("a", 1), ("b", 2)], "dimension string, count int")
    new = spark.createDataFrame([("b", 9)], "dimension string, count int")
    assert {r["dimension"]: r["count"] for r in rows(clean.merge_index(old, new))} == {
        "a": 1, "b": 9}


def test_tag_snapshot_diff_compares_old_prompts_only(spark, rows):
    schema = "prompt string, semantic_tags array<string>"
    old = spark.createDataFrame([("a", ["t"]), ("b", []), ("c", ["t"])], schema)
    new = spark.createDataFrame([("a", []), ("b", ["t"]), ("d", ["t"])], schema)
    assert rows(clean.compare_tag_snapshots(old, new, "t"))[0] == {
        "old_count": 2, "new_count": 2, "removed": 2, "added": 1}


def test_hot_text_needs_no_hot_task(spark):
    """A text that fills a third of the table is combined before the shuffle."""
    df = spark.range(3000).select(
        F.col("id").alias("record_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(
            F.concat(F.lit("text "), F.col("id").cast("string"))).alias("prompt"))
    kept = clean.first_wins(df, "prompt", "record_id")
    assert kept.count() == 2001
    assert kept.where("prompt = 'hot text'").head()["record_id"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_text_rules_are_not_repeated_by_pushed_filters(spark, tmp_path):
    spark.createDataFrame(RAW, SCHEMA).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    kept, _ = clean.clean_records(df.where("source <> 'x'"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(coalesce(prompt") == 1
    executed = kept._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(source,x))" in executed  # plain filters still reach the scan


# --- scalar functions against their definition in Python -------------------------------------

TEXTS = st.lists(st.text(
    alphabet=st.sampled_from(list("abAB12é,'\"-. \t\n  　\u0085\u001f\u001cİß")),
    max_size=40), min_size=1, max_size=25)


def by_definition(p):
    normal = re.sub(r"\s+", " ", p).strip()
    tokens = [t for t in (re.sub(r"[^a-z0-9]+", "", w.lower()) for w in normal.split(" ")) if t]
    ratio = (len(tokens) - len(set(tokens))) / len(tokens) if tokens else 0.0
    return (normal, len(normal.split()), ratio, p.count(","), p.strip(), len(p),
            bool(re.search(r"['\"][^'\"]{2,}['\"]", p)),
            bool(re.search(r"\bab\b", p.lower())), bool(re.search(r"\ba\s+b\b", p.lower())))


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_scalar_functions_follow_their_definition(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, p string").withColumn(
        "n", text.normalize_prompt("p")).orderBy("i")
    lowered = F.lower("p")
    got = df.select("n", text.word_count("n"), text.repeat_ratio("n"), text.comma_count("p"),
                    text.strip("p"), F.length("p"), text.has_quoted_text("p"),
                    text.contains_word(lowered, ["ab"]),
                    text.contains_phrase(lowered, "a b")).collect()
    assert [tuple(r) for r in got] == [by_definition(p) for p in texts]


def test_null_prompts(spark):
    df = spark.createDataFrame([(None,)], "p string")
    row = df.select(text.normalize_prompt("p"), text.strip("p"),
                    text.normalize_label("p"), text.confidence("p")).head()
    assert tuple(row) == ("", "", "uncertain", 0.0)


def test_labels_and_policies(spark):
    labels = [" Pass", "OK", "yes", "fail", "No", "reject ", "perhaps", ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, l string").orderBy("i")
    got = [tuple(r) for r in df.select(
        text.normalize_label("l"), text.normalize_label("l", binary=True)).collect()]
    assert got == [("pass", "pass"), ("pass", "fail"), ("pass", "fail"), ("fail", "fail"),
                   ("fail", "fail"), ("fail", "fail"), ("uncertain", "fail"),
                   ("uncertain", "fail")]


def test_cleanup_of_generated_prompts(spark):
    raw = ['**Negative Prompt**: "a *blurry*  cat"', "Corrected output: x y", "输出：模糊", '"quoted"',
           "result without colon", '""']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, r string").orderBy("i")
    got = [r[0] for r in df.select(text.cleanup_generated("r")).collect()]
    assert got == ["a blurry cat", "x y", "模糊", "quoted", "result without colon", ""]


def test_feedback_and_anchors(spark):
    df = spark.createDataFrame(
        [(0, "style_drift", "n"), (1, "odd", None), (2, None, None), (3, None, "n")],
        "i int, f string, n string").orderBy("i")
    got = [r[0] for r in df.select(text.feedback("f", "n")).collect()]
    assert got[0].startswith("The negative image changed rendering style.")
    assert got[0].endswith(" | VLM notes: n")
    assert got[1:] == ["Failure type: odd",
                       "Previous attempt was rejected. Please try a different approach.",
                       "VLM notes: n"]
    styled = spark.createDataFrame([("p", "painting"), ("p", "cubist")], "p string, s string")
    assert [r[0] for r in styled.select(text.style_anchor("p", "s")).collect()] == [
        "painting style, artistic, p", "p"]


def test_iso_times(spark):
    df = spark.createDataFrame([("2026-03-14T12:00:00", "2026-03-14T12:01:40"), ("x", "")],
                               "a string, b string")
    got = df.select(text.elapsed_seconds(text.iso_timestamp("a"), text.iso_timestamp("b")))
    assert [r[0] for r in got.collect()] == [100.0, None]


def test_item_formats_and_drop_counts(spark, rows):
    items = spark.createDataFrame([
        (1, '{"prompt": " a cat ", "semantic_tags": ["x"], "model": "sdxl-1"}'),
        (2, '{"text": "b", "tags": ["y", null], "model": "other"}'), (3, '"quoted \\"text\\""'),
        (4, "plain text"), (5, '{"prompt": "  "}'),
        (6, '{"prompt": "c", "signature": {"has_person": true}}')], "id int, item string")
    got = rows(readers.normalize_items(items, "sdxl").orderBy("id"))
    assert [r["prompt"] for r in got] == ["a cat", "b", 'quoted "text"', "plain text", "", "c"]
    assert [r["drop_reason"] for r in got] == [None, "model", None, None, "invalid", None]
    assert got[1]["semantic_tags"] == ["y"] and got[5]["prompt_signature"] == {"has_person": True}
    assert rows(readers.drop_counts(readers.normalize_items(items, "sdxl")))[0] == {
        "kept": 4, "dropped_by_model_filter": 1, "dropped_invalid": 1}


def test_lexicon_has_no_repeats():
    for name in dir(lx):
        words = getattr(lx, name)
        if isinstance(words, list):
            assert len(words) == len(set(words)), name


def test_repeat_ratio_cuts_a_text_once(spark):
    df = spark.createDataFrame([("a b a",), ("",), ("!!",), (None,)], "n string")
    got = df.select(text.repeat_ratio("n").alias("r"))
    assert [r.r for r in got.collect()] == [1 / 3, 0.0, 0.0, None]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_remove(") == 1
