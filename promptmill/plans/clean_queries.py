"""Queries over length filters, deduplication and set operations."""

from pyspark.sql import functions as F

from promptmill.functions.plan import held
from promptmill.operators import clean, neardup
from promptmill.params import taxonomy as tx
from promptmill.plans.registry import query
from promptmill.plans.views import (SQL_PROMPTS, SQL_TAGGED, q, sql_has, sql_norm, sql_strip,
                                    sql_subpools, sql_words)
from promptmill.session import param_table

CLASS_SQL = f"""normed AS (SELECT *, {sql_norm('prompt')} AS norm FROM base),
worded AS (SELECT *, {sql_words('norm')} AS words, list_filter(string_split(regexp_replace(
  lower(norm), '[^a-z0-9 ]+', '', 'g'), ' '), lambda w: w <> '') AS w FROM normed),
classed AS (SELECT *, CASE WHEN words < 5 OR length(prompt) < 25 THEN 'short'
  WHEN words > 120 OR length(prompt) > 800 THEN 'long'
  WHEN length(prompt) - length(replace(prompt, ',', '')) >= 20
    OR (CASE WHEN len(w) = 0 THEN 0 ELSE (len(w) - len(list_distinct(w))) / len(w) END) >= 0.35
    OR contains(lower(prompt), 'http://') OR contains(lower(prompt), 'https://') THEN 'noise'
  ELSE 'keep' END AS class FROM worded)"""
CLASS_COUNTS = """count(*) FILTER (WHERE class = 'keep') AS kept,
  count(*) FILTER (WHERE class = 'short') AS short, count(*) FILTER (WHERE class = 'long') AS long,
  count(*) FILTER (WHERE class = 'noise') AS noise"""


@query("length_classes", "FLT1", f"""
WITH {SQL_PROMPTS}, base AS (SELECT * FROM prompts), {CLASS_SQL}
SELECT record_id, class AS drop_reason FROM classed""")
def length_classes(v):
    return clean.with_length_class(v.prompts()).select("record_id", "drop_reason")


@query("cleaning_summary", "FLT2", f"""
WITH {SQL_PROMPTS}, base AS (SELECT * FROM prompts), {CLASS_SQL}
SELECT source, {CLASS_COUNTS} FROM classed GROUP BY source""")
def cleaning_summary(v):
    return clean.cleaning_summary(v.prompts(), by=["source"])


@query("conversation_cleaning", "FLT1 FLT2", f"""
WITH base AS (SELECT conv_id, turn, role, text AS prompt FROM conversations), {CLASS_SQL}
SELECT role, {CLASS_COUNTS} FROM classed GROUP BY role""")
def conversation_cleaning(v):
    turns = v.table("conversations").withColumnRenamed("text", "prompt")
    return clean.cleaning_summary(turns, by=["role"])


@query("dropped_prompts", "FLT2", f"""
WITH {SQL_PROMPTS}, base AS (SELECT * FROM prompts), {CLASS_SQL}
SELECT record_id, class AS _drop_reason FROM classed WHERE class <> 'keep'""")
def dropped_prompts(v):
    return clean.clean_records(v.prompts())[1].select("record_id", "_drop_reason")


@query("subpool_cleaning", "FLT3", f"""
WITH {sql_subpools()}, base AS (SELECT * FROM subpools), {CLASS_SQL}
SELECT dimension, {CLASS_COUNTS} FROM classed GROUP BY dimension""")
def subpool_cleaning(v):
    # Classify each prompt once, then fan the class out to the dimensions it fits.
    classed = clean.with_length_class(v.tagged(), name="class")
    from promptmill.operators import compat
    fanned = compat.dimension_subpools(classed)
    return fanned.groupBy("dimension").agg(*[
        F.count_if(F.col("class") == c).alias(n) for c, n in
        [("keep", "kept"), ("short", "short"), ("long", "long"), ("noise", "noise")]])


FLAGGED = ["hand_malformation", "expression_mismatch", "animal_anatomy_error"]


@query("flagged_subpool_cleaning", "FLT4", f"""
WITH {sql_subpools()}, base AS (SELECT * FROM subpools), {CLASS_SQL}
SELECT dimension, count(*) AS prompts FROM classed
WHERE dimension NOT IN ({', '.join(q(d) for d in FLAGGED)}) OR class = 'keep' GROUP BY 1""")
def flagged_subpool_cleaning(v):
    index = param_table(v.spark, [(d, d in FLAGGED) for d in tx.REQUIREMENTS if d != "text_error"],
                        "dimension string, skip_runtime_compat_filter boolean")
    kept = clean.clean_flagged_subpools(v.subpools(), index)
    return kept.groupBy("dimension").agg(F.count(F.lit(1)).alias("prompts"))


STATUS_SQL = f"""{SQL_PROMPTS}, n AS (SELECT *, {sql_norm('prompt')} AS norm FROM prompts),
s AS (SELECT *, CASE WHEN norm = '' THEN 'empty' WHEN {sql_words('norm')} <
  (CASE WHEN source = 't2i_compbench' THEN 2 ELSE 3 END) THEN 'short'
  ELSE 'candidate' END AS status FROM n),
firsts AS (SELECT * FROM s WHERE status = 'candidate'
  QUALIFY row_number() OVER (PARTITION BY norm ORDER BY record_id) = 1)"""


@query("candidate_status", "FLT5", f"""
WITH {STATUS_SQL} SELECT source, status, count(*) AS prompts FROM s GROUP BY 1, 2""")
def candidate_status(v):
    return clean.candidate_status(v.prompts()).groupBy("source", "status").agg(
        F.count(F.lit(1)).alias("prompts"))


@query("exact_dedup", "DUP1", f"""
WITH {STATUS_SQL} SELECT record_id, source, lang, md5(norm) AS prompt_md5 FROM firsts""")
def exact_dedup(v):
    return clean.clean_and_dedup(v.prompts()).select("record_id", "source", "lang",
                                                     F.md5("prompt").alias("prompt_md5"))


@query("dedup_summary", "DUP1", f"""
WITH {STATUS_SQL} SELECT count(*) AS input_count,
  count(*) FILTER (WHERE status = 'empty') AS filtered_empty_count,
  count(*) FILTER (WHERE status = 'short') AS filtered_short_count,
  count(*) FILTER (WHERE status = 'candidate') - (SELECT count(*) FROM firsts)
    AS exact_duplicate_count, (SELECT count(*) FROM firsts) AS output_count FROM s""")
def dedup_summary(v):
    return clean.dedup_summary(v.prompts())


@query("dedup_source_counts", "DUP1", f"""
WITH {STATUS_SQL} SELECT source, count(*) AS output_count FROM firsts GROUP BY 1""")
def dedup_source_counts(v):
    return clean.dedup_source_counts(v.prompts())


@query("dedup_by_stripped_prompt", "DUP2", f"""
WITH {SQL_PROMPTS}, t AS (SELECT *, {sql_strip('prompt')} AS p FROM prompts)
SELECT record_id, source FROM t WHERE p <> ''
QUALIFY row_number() OVER (PARTITION BY p ORDER BY record_id) = 1""")
def dedup_by_stripped_prompt(v):
    return clean.dedup_stripped(v.prompts()).select("record_id", "source")


NEW = "source IN ('pick_a_pic_v2', 't2i_compbench')"


@query("new_versus_base", "DUP3", f"""
WITH {SQL_PROMPTS}, t AS (SELECT *, {sql_strip('prompt')} AS p FROM prompts)
SELECT record_id, source FROM t WHERE {NEW} AND p <> '' AND p NOT IN
  (SELECT p FROM t WHERE NOT ({NEW}))
QUALIFY row_number() OVER (PARTITION BY p ORDER BY record_id) = 1""")
def new_versus_base(v):
    prompts = v.prompts()
    return clean.new_versus_base(prompts.where(NEW), prompts.where(f"not ({NEW})")).select(
        "record_id", "source")


@query("core_then_delta_union", "SET1", f"""
WITH {SQL_TAGGED}, parts AS (
  SELECT record_id, prompt, 0 AS priority FROM tagged WHERE {sql_has('has_person')}
  UNION ALL SELECT record_id, prompt, 1 FROM tagged WHERE {sql_has('has_face')})
SELECT record_id, priority FROM parts
QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY priority, record_id) = 1""")
def core_then_delta_union(v):
    tagged = held(v.tagged(), "semantic_tags")
    core = tagged.where(F.array_contains("semantic_tags", "has_person"))
    delta = tagged.where(F.array_contains("semantic_tags", "has_face"))
    return clean.union_first_wins([core, delta]).select("record_id", "priority")


def generated(v):
    """Every fourth-language prompt as a generated one, with request lineage."""
    r = F.col("record_id")
    from promptmill.plans.views import pick
    return v.prompts().where("lang <> 'en'").select(
        "record_id", "prompt", pick(tx.DIMENSIONS, r).alias("dimension"),
        F.lit("food_tabletop").alias("macro_bucket"),
        F.floor(r / 5).alias("request_id"), (r % 5 + 1).alias("prompt_index_in_request"),
        F.lit("writer").alias("model"), F.lit("global_balanced").alias("coverage_mode"))


GENERATED_SQL = f"""{SQL_PROMPTS}, gen AS (SELECT record_id, {sql_strip('prompt')} AS p,
  list_extract([{', '.join(q(d) for d in tx.DIMENSIONS)}], CAST(record_id % 32 AS INT) + 1)
    AS dimension, CAST(floor(record_id / 5) AS BIGINT) AS request_id,
  record_id % 5 + 1 AS idx FROM prompts WHERE lang <> 'en'),
base AS (SELECT *, {sql_strip('prompt')} AS p FROM prompts WHERE lang = 'en'),
fresh AS (SELECT * FROM gen WHERE p <> '' AND p NOT IN (SELECT p FROM base)
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY record_id) = 1)"""


@query("normalized_backfill", "PL9", f"""
WITH {GENERATED_SQL} SELECT record_id, md5(p) AS prompt_md5, 'llm_backfill' AS source,
  'llm_backfill::' || dimension AS assigned_bucket, dimension AS backfill_dimension,
  request_id AS backfill_request_id, idx AS backfill_prompt_index FROM gen WHERE p <> ''""")
def normalized_backfill(v):
    return clean.normalize_backfill(generated(v)).select(
        "record_id", F.md5("prompt").alias("prompt_md5"), "source", "assigned_bucket",
        "backfill_dimension", "backfill_request_id", "backfill_prompt_index")


@query("merged_pool", "SET2", f"""
WITH {GENERATED_SQL}
SELECT record_id, source, CAST(NULL AS VARCHAR) AS assigned_bucket FROM base UNION ALL
SELECT record_id, 'llm_backfill', 'llm_backfill::' || dimension FROM fresh""")
def merged_pool(v):
    base = v.prompts().where("lang = 'en'")
    return clean.merge_backfill(base, generated(v))[0].select("record_id", "source",
                                                              "assigned_bucket")


@query("merge_summary", "AGG19", f"""
WITH {GENERATED_SQL} SELECT (SELECT count(*) FROM base) AS base_prompt_count,
  (SELECT count(*) FROM gen) AS generated_prompt_count,
  (SELECT count(*) FROM gen WHERE p <> '') AS normalized_generated_prompt_count,
  (SELECT count(*) FROM fresh) AS deduped_new_prompt_count,
  (SELECT count(*) FROM base) + (SELECT count(*) FROM fresh) AS merged_prompt_count""")
def merge_summary(v):
    base = v.prompts().where("lang = 'en'")
    return clean.merge_backfill(base, generated(v))[1]


@query("merged_index", "SET3", f"""
WITH {SQL_PROMPTS}, a AS (SELECT source AS dimension, count(*) AS count FROM prompts GROUP BY 1),
b AS (SELECT source AS dimension, count(*) AS count FROM prompts WHERE lang = 'en'
  AND source <> 'diffusiondb' GROUP BY 1)
SELECT * FROM b UNION ALL SELECT * FROM a WHERE dimension NOT IN (SELECT dimension FROM b)""")
def merged_index(v):
    def index(df):
        return df.groupBy(F.col("source").alias("dimension")).agg(
            F.count(F.lit(1)).alias("count"))
    prompts = v.prompts()
    return clean.merge_index(index(prompts), index(
        prompts.where("lang = 'en' and source <> 'diffusiondb'")))


@query("tag_snapshot_diff", "SET5", f"""
WITH {SQL_TAGGED}, o AS (SELECT record_id, contains(low, 'hand') AS was FROM tagged),
n AS (SELECT record_id, {sql_has('has_hand')} OR {sql_has('has_person')} AS now FROM tagged),
j AS (SELECT o.record_id AS old_id, coalesce(was, FALSE) AS was, coalesce(now, FALSE) AS now
  FROM o FULL JOIN n ON o.record_id = n.record_id)
SELECT count(*) FILTER (WHERE was) AS old_count, count(*) FILTER (WHERE now) AS new_count,
  count(*) FILTER (WHERE was AND NOT now) AS removed,
  count(*) FILTER (WHERE old_id IS NOT NULL AND NOT was AND now) AS added FROM j""")
def tag_snapshot_diff(v):
    tag = F.array(F.lit("has_hand"))
    none = F.array().cast("array<string>")
    old = v.prompts().select("record_id", F.when(
        F.lower("prompt").contains("hand"), tag).otherwise(none).alias("semantic_tags"))
    new = v.tagged().select("record_id", F.when(
        F.arrays_overlap("semantic_tags", F.array(F.lit("has_hand"), F.lit("has_person"))),
        tag).otherwise(none).alias("semantic_tags"))
    return clean.compare_tag_snapshots(old, new, "has_hand", key="record_id")


@query("tag_snapshot_changes", "SET5", f"""
WITH {SQL_TAGGED}, o AS (SELECT record_id, contains(low, 'hand') AS was FROM tagged
  UNION ALL SELECT -1 - item_id, contains(lower(text), 'hand') FROM benchmark),
n AS (SELECT record_id, {sql_has('has_hand')} AND {sql_has('has_person')}
  OR {sql_has('has_face')} AS now FROM tagged
  UNION ALL SELECT -1000 * (1000000 + conv_id) - turn, contains(lower(text), 'hand')
  FROM conversations),
j AS (SELECT o.record_id AS old_id, coalesce(was, FALSE) AS was, coalesce(now, FALSE) AS now
  FROM o FULL JOIN n ON o.record_id = n.record_id)
SELECT count(*) FILTER (WHERE was) AS old_count, count(*) FILTER (WHERE now) AS new_count,
  count(*) FILTER (WHERE was AND NOT now) AS removed,
  count(*) FILTER (WHERE old_id IS NOT NULL AND NOT was AND now) AS added FROM j""")
def tag_snapshot_changes(v):
    """Snapshots of different rules and rows: benchmark items have gone, turns have come."""
    tag = F.array(F.lit("has_hand"))
    none = F.array().cast("array<string>")

    def snapshot(rows, found):
        return rows.select("record_id", F.when(found, tag).otherwise(none).alias("semantic_tags"))

    def has(name):
        return F.array_contains("semantic_tags", name)

    hand = F.lower("prompt").contains("hand")
    gone = v.table("benchmark").select((-1 - F.col("item_id")).alias("record_id"),
                                       F.col("text").alias("prompt"))
    come = v.table("conversations").select(
        (-1000 * (1000000 + F.col("conv_id")) - F.col("turn")).alias("record_id"),
        F.col("text").alias("prompt"))
    old = snapshot(v.prompts().select("record_id", "prompt").unionByName(gone), hand)
    new = snapshot(v.tagged(), (has("has_hand") & has("has_person")) | has("has_face")
                   ).unionByName(snapshot(come, hand))
    return clean.compare_tag_snapshots(old, new, "has_hand", key="record_id")


@query("near_duplicate_classes", "SET6", f"""
WITH RECURSIVE {SQL_PROMPTS}, low AS (SELECT record_id, lower({sql_norm('prompt')}) AS low FROM prompts),
firsts AS (SELECT low, min(record_id) AS id FROM low WHERE low <> '' GROUP BY 1),
words AS (SELECT id, string_split(low, ' ') AS w FROM firsts),
grams AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
  lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM words),
sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY 1),
met AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM grams x JOIN grams y
  ON x.g = y.g AND x.id < y.id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(id, other) AS (SELECT id, id FROM firsts UNION
  SELECT r.id, s.b FROM reached r JOIN sides s ON s.a = r.other),
classes AS (SELECT id, min(other) AS class_id FROM reached GROUP BY 1),
facts AS (SELECT f.low, c.class_id, s.n, t.n AS first_n,
  CASE WHEN c.class_id = c.id THEN s.n ELSE coalesce(m.shared, 0) END AS shared
  FROM firsts f JOIN classes c ON c.id = f.id JOIN sizes s ON s.id = c.id
  JOIN sizes t ON t.id = c.class_id LEFT JOIN met m ON m.a = c.class_id AND m.b = c.id)
SELECT l.record_id, coalesce(f.class_id, l.record_id) AS class_id,
  coalesce(f.class_id, l.record_id) = l.record_id AS kept, coalesce(f.n, 0) AS n_shingles,
  coalesce(f.first_n, 0) AS first_shingles, coalesce(f.shared, 0) AS shared
FROM low l LEFT JOIN facts f ON f.low = l.low""")
def near_duplicate_classes(v):
    return neardup.near_classes(v.prompts())
