"""Keyword tags, sampling buckets and macro scene categories."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions import text
from promptmill.functions.plan import computed
from promptmill.functions.text import col, contains_any
from promptmill.params import lexicon as lx


def tag_array(prompt, lowered, lex) -> Column:
    """Sorted array of the tags whose keywords (``lex``: tag -> words) occur in the prompt."""
    tests = {tag: contains_any(lowered, words) for tag, words in lex.items()}
    quoted = text.has_quoted_text(prompt)
    tests[lx.QUOTED_TEXT_TAG] = (tests[lx.QUOTED_TEXT_TAG] | quoted
                                 if lx.QUOTED_TEXT_TAG in tests else quoted)
    return F.array_compact(F.array(*[F.when(tests[t], F.lit(t)) for t in sorted(tests)]))


def tag_candidates(df: DataFrame, lex, prompt="prompt") -> DataFrame:
    """Add ``semantic_tags``; the boolean signature follows from it (:func:`signature`)."""
    lowered = df.withColumn("_lower", F.lower(F.coalesce(col(prompt), F.lit(""))))
    return lowered.withColumn("semantic_tags", tag_array(prompt, "_lower", lex)).drop("_lower")


def signature(tags, lex) -> Column:
    """Tag -> boolean map over the whole vocabulary."""
    names = sorted({*lex, lx.QUOTED_TEXT_TAG})
    entries = [c for n in names for c in (F.lit(n), F.array_contains(col(tags), n))]
    return F.create_map(*entries)


def keyword_tags(prompt, lowered, lex, extra_tags=None) -> Column:
    """Keyword tags where quoted text is found by pattern only, united with other tags."""
    lex = {t: w for t, w in lex.items() if t != lx.QUOTED_TEXT_TAG}
    tags = tag_array(prompt, lowered, lex)
    return tags if extra_tags is None else F.array_union(col(extra_tags), tags)


def parse_tag_answer(answer, valid_tags) -> Column:
    """Tags named in a free-text answer: split on commas and spaces, keep the valid ones."""
    lowered = F.lower(text.strip(answer))
    tokens = F.split(lowered, f"(?U)(?:,|{text.ANY_SPACE})+")
    valid = F.array(*[F.lit(t) for t in sorted(valid_tags)])
    empty = F.array().cast("array<string>")
    return F.when((lowered == "none") | (lowered == ""), empty).otherwise(
        F.array_intersect(tokens, valid))


def tag_counts(df: DataFrame, tags="semantic_tags") -> DataFrame:
    # The outer form brings no size test that would be pushed below the tagging and repeat it.
    return (df.select(F.explode_outer(tags).alias("tag")).where(F.col("tag").isNotNull())
            .groupBy("tag").agg(F.count(F.lit(1)).alias("prompts")))


def tag_statistics(df: DataFrame, vocabulary, tags="semantic_tags") -> DataFrame:
    """Prompts and percentage per tag of the vocabulary, zero tags included, in one pass."""
    names = sorted(vocabulary)
    counted = df.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.array_contains(col(tags), n)).alias(n) for n in names])
    rows = F.array(*[F.struct(F.lit(n).alias("tag"), F.col(n).alias("prompts")) for n in names])
    return (counted.select("total", F.inline(rows))
            .select("tag", "prompts", text.percent("prompts", "total").alias("percentage")))


def assign_bucket(source, tags, lowered) -> Column:
    """First matching sampling bucket of the record's source; null for sources without rules."""
    def has(*names):
        return text.any_of(F.array_contains(col(tags), n) for n in names)

    def said(*lists):
        return contains_any(lowered, [w for words in lists for w in words])

    crowd = (F.when(has("has_person") & (has("has_face", "has_hand")
                                         | said(lx.BUCKET_ACTION, ["portrait"])),
                    F.lit("people_face_hands"))
             .when(has("has_animal"), F.lit("animals"))
             .when(has("has_multiple_objects") & said(lx.BUCKET_SPATIAL),
                   F.lit("multi_object_spatial"))
             .when(has("has_countable_objects") & said(lx.BUCKET_COUNT),
                   F.lit("count_constraints"))
             .when(has("has_text", "has_logo_or_symbol") & said(lx.BUCKET_TEXT),
                   F.lit("text_sign_logo"))
             .when(has("has_reflective_surface") & said(lx.BUCKET_REFLECTION),
                   F.lit("reflection_optics"))
             .otherwise(F.lit("general_scenes")))
    picked = (F.when(has("has_person") & said(lx.BUCKET_ACTION), F.lit("people_and_activities"))
              .when(has("has_multiple_objects")
                    | (has("has_person") & said(lx.BUCKET_INTERACTION)),
                    F.lit("multi_subject_interaction"))
              .when(said(lx.BUCKET_ACTION) & said(lx.BUCKET_EXPRESSION),
                    F.lit("explicit_action_expression"))
              .otherwise(F.lit("creative_but_structured")))
    return (F.when(col(source) == "diffusiondb", crowd)
            .when(col(source) == "pick_a_pic_v2", picked))


def macro_category(tags, lowered) -> Column:
    """First matching macro scene category."""
    def has(*names):
        return text.any_of(F.array_contains(col(tags), n) for n in names)

    def said(words):
        return contains_any(lowered, words)

    rules = [
        ("commercial_text_media",
         has("has_text", "has_logo_or_symbol") | said(lx.MACRO_TEXT_MEDIA)),
        ("food_tabletop", said(lx.MACRO_FOOD)),
        ("human_portrait", has("has_face") | said(lx.MACRO_PORTRAIT)),
        ("human_activity_interaction",
         has("has_person") & (has("has_multiple_objects") | said(lx.MACRO_ACTION))),
        ("animals_creatures", has("has_animal") | said(lx.MACRO_ANIMAL)),
        ("indoor_structured_space", said(lx.MACRO_INDOOR)),
        ("urban_built_outdoor", said(lx.MACRO_URBAN)),
        ("natural_landscape", has("has_reflective_surface") | said(lx.MACRO_NATURE)),
        ("events_performance_culture", said(lx.MACRO_EVENT)),
    ]
    category = F.when(rules[0][1], F.lit(rules[0][0]))
    for name, test in rules[1:]:
        category = category.when(test, F.lit(name))
    return category.otherwise(F.lit(lx.DEFAULT_MACRO))


# Words of the finer signature flags; all are parameters.
SIGNATURE_WORDS = {
    "contains_hands_visible": ["hand", "hands", "finger", "fingers", "holding"],
    "contains_full_body": ["full body", "standing", "walking", "running"],
    "contains_closeup_face": ["close-up", "headshot", "portrait"],
    "contains_explicit_text_literal": ["text", "sign", "saying", "written"],
    "contains_reflection_surface": ["mirror", "reflection", "water surface", "glass"],
    "contains_count_constraint": ["two", "three", "four", "five", "several"],
    "contains_multiple_distinct_objects": ["next to", "beside", "and a"],
    "contains_indoor_layout": ["room", "kitchen", "office", "indoor"],
    "contains_action_pose": ["jumping", "dancing", "playing", "riding"],
    "contains_human_subject": ["person", "man", "woman", "child", "people"],
    "contains_animal_subject": ["dog", "cat", "bird", "horse", "animal"],
}


def with_signature_flags(df: DataFrame, words=None, prompt="prompt") -> DataFrame:
    """Adds one boolean for each flag: a whole word or phrase of it occurs in any case. A text in
    quotes alone makes an explicit text literal. Null prompts have no flag."""
    raw = F.coalesce(col(prompt), F.lit(""))
    lowered = df.withColumn("_low", F.lower(raw))
    flags = {name: text.contains_word("_low", some)
             for name, some in (words or SIGNATURE_WORDS).items()}
    literal = "contains_explicit_text_literal"
    if literal in flags:
        flags[literal] = flags[literal] | text.has_quoted_text(raw)
    return computed(lowered, **flags).drop("_low")


def with_macro_category(df: DataFrame, prompt="prompt", tags="semantic_tags") -> DataFrame:
    lowered = df.withColumn("_lower", F.lower(F.coalesce(col(prompt), F.lit(""))))
    return lowered.withColumn("macro_taxonomy", macro_category(tags, "_lower")).drop("_lower")


def macro_distribution(df: DataFrame) -> DataFrame:
    """Prompts and coverage per macro category, zero categories included, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.col("macro_taxonomy") == c).alias(c) for c in lx.MACRO_CATEGORIES])
    rows = F.array(*[F.struct(F.lit(c).alias("macro_taxonomy"), F.col(c).alias("prompts"))
                     for c in lx.MACRO_CATEGORIES])
    return (counted.select("total", F.inline(rows))
            .select("macro_taxonomy", "prompts",
                    text.percent("prompts", "total").alias("coverage")))


def select_template(requests: DataFrame, templates: DataFrame, membership: DataFrame) -> DataFrame:
    """Template of a (dimension, severity) request: the attribute's own, else its sub-category's.

    ``templates``: ``subcategory, attribute, severity, template`` with a null attribute for the
    sub-category level; ``membership``: ``dimension, subcategory``.
    """
    own = templates.where(F.col("attribute").isNotNull()).select(
        "subcategory", F.col("attribute").alias("dimension"), "severity",
        F.col("template").alias("_own"))
    group = templates.where(F.col("attribute").isNull()).select(
        "subcategory", "severity", F.col("template").alias("_group"))
    return (requests.join(membership, "dimension", "left")
            .join(own, ["subcategory", "dimension", "severity"], "left")
            .join(group, ["subcategory", "severity"], "left")
            .withColumn("template", F.coalesce("_own", "_group")).drop("_own", "_group"))
