"""Queries over scalar text functions, keys and tags."""

from pyspark.sql import functions as F

from promptmill.functions import keys, text
from promptmill.operators import tagging
from promptmill.params import lexicon as lx
from promptmill.params import taxonomy as tx
from promptmill.plans.registry import query
from promptmill.plans.views import (LEXICON, SQL_ATTEMPTS, SQL_MACRO, SQL_PAIRS,
                                    SQL_PROMPTS, SQL_TAGGED, q, sql_any, sql_has, sql_norm,
                                    sql_phrase, sql_pick, sql_strip, sql_word, sql_words)


@query("normalized_prompts", "FN1 FN2 FN4", f"""
WITH {SQL_PROMPTS}, n AS (SELECT *, {sql_norm('prompt')} AS norm FROM prompts)
SELECT record_id, md5(norm) AS norm_md5, {sql_words('norm')} AS words, length(prompt) AS chars,
       length(prompt) - length(replace(prompt, ',', '')) AS commas FROM n""", ints="words chars commas")
def normalized_prompts(v):
    return v.prompts().withColumn("norm", text.normalize_prompt("prompt")).select(
        "record_id", F.md5("norm").alias("norm_md5"), text.word_count("norm").alias("words"),
        F.length("prompt").alias("chars"), text.comma_count("prompt").alias("commas"))


@query("repeat_ratios", "FN3", f"""
WITH {SQL_PROMPTS}, t AS (SELECT record_id, list_filter(string_split(regexp_replace(
  lower({sql_norm('prompt')}), '[^a-z0-9 ]+', '', 'g'), ' '), lambda w: w <> '') AS w FROM prompts)
SELECT record_id, CASE WHEN len(w) = 0 THEN 0.0::DOUBLE
  ELSE (len(w) - len(list_distinct(w))) / len(w) END AS repeat_ratio FROM t""")
def repeat_ratios(v):
    return v.prompts().withColumn("norm", text.normalize_prompt("prompt")).select(
        "record_id", text.repeat_ratio("norm").alias("repeat_ratio"))


PHRASES = ["with", "the near", "of the", "in the", "is a"]


@query("phrase_matches", "FN5 FN6 FN7 FN8", f"""
WITH {SQL_PROMPTS}, l AS (SELECT *, lower(prompt) AS low FROM prompts)
SELECT record_id, {sql_any('low', lx.BUCKET_SPATIAL)} AS spatial_substring,
       {sql_phrase('low', PHRASES)} AS phrase_any, {sql_phrase('low', ['of the'])} AS phrase_one,
       {sql_word('low', lx.WORDS_HUMAN)} AS human_word,
       {sql_word('low', ['one', 'hand', 'dog', 'with'])} AS corpus_word,
       regexp_matches(prompt, '[''"][^''"]{{2,}}[''"]') AS quoted FROM l""")
def phrase_matches(v):
    low = F.col("low")
    return v.prompts().withColumn("low", F.lower("prompt")).select(
        "record_id", text.contains_any(low, lx.BUCKET_SPATIAL).alias("spatial_substring"),
        text.contains_phrase(low, PHRASES).alias("phrase_any"),
        text.contains_phrase(low, "of the").alias("phrase_one"),
        text.contains_word(low, lx.WORDS_HUMAN).alias("human_word"),
        text.contains_word(low, ["one", "hand", "dog", "with"]).alias("corpus_word"),
        text.has_quoted_text("prompt").alias("quoted"))


@query("stable_ids", "FN10 FN11 FN12", f"""
WITH {SQL_PROMPTS}
SELECT record_id, source || '-' || lpad(CAST(record_id + 1 AS VARCHAR), 5, '0') || '-' ||
         substr(sha1({sql_strip('prompt')}), 1, 16) AS sample_id,
       substr(md5('blur::' || prompt || '::mild'), 1, 12) AS pair_id,
       CAST('0x' || substr(md5(prompt), 1, 8) AS BIGINT) AS u32,
       substr(prompt, 1, 100) || '|' || 'blur' || '|' || lang AS pair_key FROM prompts""")
def stable_ids(v):
    return v.prompts().select(
        "record_id",
        keys.sample_id("source", F.col("record_id") + 1, "prompt").alias("sample_id"),
        keys.pair_id(F.concat(F.lit("blur::"), "prompt", F.lit("::mild"))).alias("pair_id"),
        keys.stable_u32("prompt").alias("u32"),
        keys.pair_key("prompt", F.lit("blur"), "lang").alias("pair_key"))


@query("cleaned_generations", "FN13", f"""
WITH {SQL_PROMPTS}, raw AS (SELECT record_id, prompt, CASE record_id % 4
    WHEN 0 THEN '**Negative Prompt**: "' || prompt || '"' WHEN 1 THEN 'output: ' || prompt
    WHEN 2 THEN '"*' || prompt || '*"' ELSE '"' || '"' END AS answer FROM prompts),
cleaned AS (SELECT record_id, prompt, {sql_norm('''replace(regexp_replace(regexp_replace(answer,
    '(?i)^([*]{0,2}(negative prompt|output)[*]{0,2}):[ \\t\\n\\r]*', ''),
    '^["'']+|["'']+$', '', 'g'), '*', '')''')} AS cleaned FROM raw)
SELECT record_id, md5(cleaned) AS cleaned_md5, cleaned = '' AS is_empty,
       {sql_words('cleaned')} < 10 OR {sql_words('cleaned')} > 200 AS unusual_length,
       lower(cleaned) = lower(prompt) AS unchanged FROM cleaned""")
def cleaned_generations(v):
    kind, prompt = F.col("record_id") % 4, F.col("prompt")
    answer = (F.when(kind == 0, F.concat(F.lit('**Negative Prompt**: "'), prompt, F.lit('"')))
              .when(kind == 1, F.concat(F.lit("output: "), prompt))
              .when(kind == 2, F.concat(F.lit('"*'), prompt, F.lit('*"')))
              .otherwise(F.lit('""')))
    words = text.word_count("cleaned")
    return (v.prompts().withColumn("answer", answer)
            .withColumn("cleaned", text.cleanup_generated("answer"))
            .select("record_id", F.md5("cleaned").alias("cleaned_md5"),
                    (F.col("cleaned") == "").alias("is_empty"),
                    ((words < 10) | (words > 200)).alias("unusual_length"),
                    (F.lower("cleaned") == F.lower("prompt")).alias("unchanged")))


LABEL_TEXTS = [" Pass ", "ok", "YES", "fail", "no", "Reject", "maybe", ""]
CONFIDENCES = ["0.5", "1.7", "-2", "high", "1e-1"]


@query("label_policies", "FN14 FN15 FN16", f"""
WITH raw AS (SELECT event_id, lower(trim({sql_pick(LABEL_TEXTS, 'event_id')})) AS label,
  {sql_pick(CONFIDENCES, 'event_id')} AS confidence FROM events),
labels3 AS (SELECT *, CASE WHEN label IN ('pass','ok','yes') THEN 'pass'
  WHEN label IN ('fail','no','reject') THEN 'fail' ELSE 'uncertain' END AS l3 FROM raw)
SELECT l3 AS label, CASE WHEN label = 'pass' THEN 'pass' ELSE 'fail' END AS binary_label,
  l3 IN ('pass','uncertain') AS keep_lenient, l3 = 'pass' AS keep_strict,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    coalesce(TRY_CAST(confidence AS DOUBLE), 0.0::DOUBLE))) AS confidence,
  count(*) AS n FROM labels3 GROUP BY ALL""")
def label_policies(v):
    from promptmill.plans.views import pick
    event = F.col("event_id")
    raw = v.table("events").select(pick(LABEL_TEXTS, event).alias("raw"),
                                   pick(CONFIDENCES, event).alias("conf"))
    three = raw.withColumn("label", text.normalize_label("raw"))
    return three.groupBy(
        "label", text.normalize_label("raw", binary=True).alias("binary_label"),
        text.keep_by_policy("label", "lenient").alias("keep_lenient"),
        text.keep_by_policy("label", "strict").alias("keep_strict"),
        text.confidence("conf").alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


STYLE_CASE = "CASE style_type " + " ".join(
    f"WHEN {q(s)} THEN {q(a + ' ')} || negative_prompt"
    for s, a in tx.STYLE_ANCHORS.items()) + " ELSE negative_prompt END"
FEEDBACK_CASE = "CASE " + " ".join(
    f"WHEN failure = {q(f)} THEN {q(m)}" for f, m in tx.FEEDBACK.items()) + " END"


@query("retry_texts", "FN17 FN18", f"""
WITH {SQL_ATTEMPTS}
SELECT pair_id, attempt, {STYLE_CASE} AS anchored, CASE WHEN failure IS NULL
    AND coalesce(style_type, '') = '' THEN {q(tx.FEEDBACK_DEFAULT)} ELSE
  concat_ws(' | ', {FEEDBACK_CASE}, 'VLM notes: ' || style_type) END AS feedback FROM attempts""")
def retry_texts(v):
    return v.attempts().select(
        "pair_id", "attempt", text.style_anchor("negative_prompt", "style_type").alias("anchored"),
        text.feedback("failure", "style_type").alias("feedback"))


@query("prompt_tags", "TAG1 TAG2 FN9", f"""
WITH {SQL_TAGGED} SELECT record_id, source, array_to_string(tags, ',') AS tags,
  {sql_has('has_person')} AS has_person, {sql_has('has_quoted_text')} AS has_quoted_text
FROM tagged""")
def prompt_tags(v):
    signed = v.tagged().withColumn("signature", tagging.signature("semantic_tags", LEXICON))
    return signed.select("record_id", "source", F.array_join("semantic_tags", ",").alias("tags"),
                         F.col("signature")["has_person"].alias("has_person"),
                         F.col("signature")["has_quoted_text"].alias("has_quoted_text"))


@query("tag_counts", "TAG1", f"""
WITH {SQL_TAGGED} SELECT tag, count(*) AS prompts FROM (SELECT unnest(tags) AS tag FROM tagged)
GROUP BY tag""")
def tag_counts(v):
    return tagging.tag_counts(v.tagged())


ANSWERS = ["has_dog, has_hand", "none", "HAS_TEXT has_person", ""]
VALID = sorted(LEXICON)


@query("merged_tags", "TAG3 TAG4", f"""
WITH {SQL_TAGGED}, a AS (SELECT *, string_split_regex(lower(trim({sql_pick(ANSWERS, 'record_id')})),
  '[, ]+') AS answer FROM tagged)
SELECT record_id, array_to_string(list_sort(list_distinct(list_concat(tags,
  list_filter(answer, lambda t: t IN ({', '.join(q(t) for t in VALID)}))))), ',') AS tags FROM a""")
def merged_tags(v):
    from promptmill.plans.views import pick
    df = v.prompts().withColumn("low", F.lower("prompt")).withColumn(
        "answer", tagging.parse_tag_answer(pick(ANSWERS, F.col("record_id")), VALID))
    merged = tagging.keyword_tags("prompt", "low", LEXICON, "answer")
    return df.select("record_id", F.array_join(F.array_sort(merged), ",").alias("tags"))


def _said(*lists):
    return sql_any("low", [w for words in lists for w in words])


BUCKET_CASE = f"""CASE WHEN source = 'diffusiondb' THEN CASE
  WHEN {sql_has('has_person')} AND ({sql_has('has_face')} OR {sql_has('has_hand')} OR
       {_said(lx.BUCKET_ACTION, ['portrait'])}) THEN 'people_face_hands'
  WHEN {sql_has('has_animal')} THEN 'animals'
  WHEN {sql_has('has_multiple_objects')} AND {_said(lx.BUCKET_SPATIAL)}
    THEN 'multi_object_spatial'
  WHEN {sql_has('has_countable_objects')} AND {_said(lx.BUCKET_COUNT)} THEN 'count_constraints'
  WHEN ({sql_has('has_text')} OR {sql_has('has_logo_or_symbol')}) AND {_said(lx.BUCKET_TEXT)}
    THEN 'text_sign_logo'
  WHEN {sql_has('has_reflective_surface')} AND {_said(lx.BUCKET_REFLECTION)}
    THEN 'reflection_optics'
  ELSE 'general_scenes' END
 WHEN source = 'pick_a_pic_v2' THEN CASE
  WHEN {sql_has('has_person')} AND {_said(lx.BUCKET_ACTION)} THEN 'people_and_activities'
  WHEN {sql_has('has_multiple_objects')} OR ({sql_has('has_person')} AND
       {_said(lx.BUCKET_INTERACTION)}) THEN 'multi_subject_interaction'
  WHEN {_said(lx.BUCKET_ACTION)} AND {_said(lx.BUCKET_EXPRESSION)}
    THEN 'explicit_action_expression'
  ELSE 'creative_but_structured' END END"""


def bucketed(v):
    """Tagged prompts with their sampling bucket."""
    return v.tagged().withColumn("low", F.lower("prompt")).withColumn(
        "bucket", tagging.assign_bucket("source", "semantic_tags", "low")).drop("low")


@query("sampling_buckets", "TAG5", f"""
WITH {SQL_TAGGED} SELECT record_id, source, {BUCKET_CASE} AS bucket FROM tagged""")
def sampling_buckets(v):
    return bucketed(v).select("record_id", "source", "bucket")


@query("macro_categories", "TAG6", f"""
WITH {SQL_MACRO} SELECT record_id, macro_taxonomy FROM macro""")
def macro_categories(v):
    return v.macro_tagged().select("record_id", "macro_taxonomy")


@query("macro_distribution", "AGG5", f"""
WITH {SQL_MACRO}, c AS (SELECT unnest([{', '.join(q(c) for c in lx.MACRO_CATEGORIES)}])
  AS macro_taxonomy)
SELECT c.macro_taxonomy, count(m.record_id) AS prompts,
  round_even(count(m.record_id) / (SELECT count(*) FROM macro) * 100, 2) AS coverage
FROM c LEFT JOIN macro m ON c.macro_taxonomy = m.macro_taxonomy GROUP BY 1""")
def macro_distribution(v):
    return tagging.macro_distribution(v.macro_tagged())


VOCABULARY = sorted({*LEXICON, lx.QUOTED_TEXT_TAG, "has_deformable_object"})


@query("tag_distribution", "AGG4", f"""
WITH {SQL_TAGGED}, names AS (SELECT unnest([{', '.join(q(t) for t in VOCABULARY)}]) AS tag),
hits AS (SELECT unnest(tags) AS tag FROM tagged)
SELECT names.tag, count(hits.tag) AS prompts,
  round_even(count(hits.tag) / (SELECT count(*) FROM tagged) * 100, 2) AS percentage
FROM names LEFT JOIN hits ON names.tag = hits.tag GROUP BY 1""")
def tag_distribution(v):
    return tagging.tag_statistics(v.tagged(), VOCABULARY)


SUBGROUP_OF = sorted((d, g) for g, ds in tx.SEMANTIC_SUBGROUPS.items() for d in ds)
SUBGROUP_VALUES = ", ".join(f"({q(d)}, {q(g)})" for d, g in SUBGROUP_OF)


@query("template_lookup", "TAG8", f"""
WITH {SQL_PAIRS}, member(dimension, subcategory) AS (VALUES {SUBGROUP_VALUES}),
own AS (SELECT dimension, severity, max(positive_prompt) AS template FROM pairs
        WHERE success AND severity <> 'mild' GROUP BY 1, 2),
grp AS (SELECT subcategory, severity, min(positive_prompt) AS template
        FROM pairs JOIN member USING (dimension) WHERE severity <> 'severe' GROUP BY 1, 2)
SELECT p.pair_id, p.dimension, p.severity, CASE WHEN m.subcategory IS NULL THEN NULL
  ELSE coalesce(own.template, grp.template) END AS template
FROM pairs p LEFT JOIN member m USING (dimension)
LEFT JOIN own ON own.dimension = p.dimension AND own.severity = p.severity
LEFT JOIN grp ON grp.subcategory = m.subcategory AND grp.severity = p.severity""")
def template_lookup(v):
    from promptmill.session import param_table
    member = param_table(v.spark, SUBGROUP_OF, "dimension string, subcategory string")
    pairs = v.pairs()
    own = (pairs.where(F.col("success") & (F.col("severity") != "mild"))
           .groupBy("dimension", "severity").agg(F.max("positive_prompt").alias("template"))
           .join(member, "dimension").withColumnRenamed("dimension", "attribute"))
    group = (pairs.where(F.col("severity") != "severe").join(member, "dimension")
             .groupBy("subcategory", "severity").agg(F.min("positive_prompt").alias("template"))
             .withColumn("attribute", F.lit(None).cast("string")))
    templates = own.unionByName(group)
    return tagging.select_template(pairs.select("pair_id", "dimension", "severity"), templates,
                                   member).select("pair_id", "dimension", "severity", "template")
