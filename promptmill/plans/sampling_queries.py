"""Queries over samples, quotas, sizing and request plans."""

from pyspark.sql import functions as F

from promptmill.functions.plan import held
from promptmill.operators import quotas, sampling
from promptmill.params import requests as rq
from promptmill.params import taxonomy as tx
from promptmill.plans.clean_queries import STATUS_SQL
from promptmill.plans.registry import query
from promptmill.plans.text_queries import BUCKET_CASE, bucketed
from promptmill.plans.views import (SQL_PAIRS, SQL_PROMPTS, SQL_TAGGED, pick,
                                    q, sql_has, sql_list, sql_pick, sql_strip, sql_subpools)
from promptmill.session import param_table

SEED = 20260304
PLAN = {
    "target_final_pool_size": 330, "planned_top_up_size": 40, "top_up_source": "diffusiondb",
    "sources": [
        {"name": "diffusiondb", "final_selected_size": 150, "buckets": [
            {"name": "people_face_hands", "final_selected_size": 60},
            {"name": "animals", "final_selected_size": 30},
            {"name": "count_constraints", "final_selected_size": 40},
            {"name": "general_scenes", "final_selected_size": 20}]},
        {"name": "pick_a_pic_v2", "final_selected_size": 80, "buckets": [
            {"name": "people_and_activities", "final_selected_size": 20},
            {"name": "creative_but_structured", "final_selected_size": 30}]},
        {"name": "t2i_compbench", "final_selected_size": 40},
        {"name": "parti_prompts", "final_selected_size": 30},
    ],
}


def sql_stratified(plan, seed) -> str:
    slots = [(s["name"], i, b["name"], j, b["final_selected_size"])
             for i, s in enumerate(plan["sources"]) for j, b in enumerate(s.get("buckets") or [])]
    slot_values = ", ".join(f"({q(s)}, {q(b)}, {j}, {n})" for s, _, b, j, n in slots)
    source_values = ", ".join(
        f"({q(s['name'])}, {i}, {s['final_selected_size']}, {str(bool(s.get('buckets'))).upper()})"
        for i, s in enumerate(plan["sources"]))
    extra, target = plan["planned_top_up_size"], plan["target_final_pool_size"]
    return f"""bucketed AS (SELECT record_id, source, {BUCKET_CASE} AS bucket FROM tagged),
slots(source, bucket, slot_ord, slot_quota) AS (VALUES {slot_values}),
plan(source, src_ord, quota, is_bucketed) AS (VALUES {source_values}),
shuffled AS (SELECT b.record_id, b.source, b.bucket, p.src_ord, p.quota, p.is_bucketed,
    s.slot_ord, coalesce(s.slot_quota, 0) AS slot_quota,
    md5(CAST({seed} + p.src_ord AS VARCHAR) || '|' || b.source || '|' || b.record_id) AS h
  FROM bucketed b JOIN plan p ON p.source = b.source
  LEFT JOIN slots s ON s.source = b.source AND s.bucket = b.bucket),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, bucket ORDER BY h, record_id) AS r
  FROM shuffled),
marked AS (SELECT *, is_bucketed AND r <= slot_quota AS picked FROM ranked),
counted AS (SELECT *, count(*) FILTER (WHERE picked) OVER (PARTITION BY source) AS n_picked,
  row_number() OVER (PARTITION BY source, picked ORDER BY h, record_id) AS rest FROM marked),
selected AS (SELECT record_id, source, CASE WHEN picked THEN bucket WHEN is_bucketed THEN
    'source_fill' END AS assigned_bucket, src_ord, CASE WHEN picked THEN slot_ord ELSE 1000 END
    AS phase, h FROM counted WHERE picked OR rest <= quota - n_picked),
extra AS (SELECT record_id, source, 'top_up' AS assigned_bucket, 1000 AS src_ord, 0 AS phase,
    md5('{seed + 999}|' || source || '|' || record_id) AS h FROM bucketed
  WHERE source = {q(plan['top_up_source'])} AND record_id NOT IN (SELECT record_id FROM selected)
  QUALIFY row_number() OVER (ORDER BY h, record_id) <= {extra}),
pool AS (SELECT record_id, source, assigned_bucket, row_number() OVER (ORDER BY src_ord, phase, h,
    record_id) AS pool_rank FROM (SELECT * FROM selected UNION ALL SELECT * FROM extra)
  QUALIFY pool_rank <= {target})"""


@query("stratified_sample", "SMP1 SMP2", f"""
WITH {SQL_TAGGED}, {sql_stratified(PLAN, SEED)}
SELECT record_id, source, assigned_bucket, pool_rank FROM pool""", ints="pool_rank")
def stratified_sample(v):
    return sampling.stratified_sample(bucketed(v), PLAN, SEED)


@query("stratified_sample_counts", "SMP2", f"""
WITH {SQL_TAGGED}, {sql_stratified(PLAN, SEED)}
SELECT source, assigned_bucket, count(*) AS prompts FROM pool GROUP BY 1, 2""")
def stratified_sample_counts(v):
    pool = sampling.stratified_sample(bucketed(v), PLAN, SEED)
    return pool.groupBy("source", "assigned_bucket").agg(F.count(F.lit(1)).alias("prompts"))


@query("reservoir_sample", "SMP3", f"""
WITH {sql_subpools()}
SELECT dimension, record_id, row_number() OVER (PARTITION BY dimension ORDER BY
  md5('7|' || dimension || '|' || record_id), record_id) AS sample_rank FROM subpools
QUALIFY sample_rank <= 25""", ints="sample_rank")
def reservoir_sample(v):
    return sampling.reservoir_sample(v.subpools().select("dimension", "record_id"), "dimension",
                                     25, 7)


@query("large_reservoir_sample", "SMP3", f"""
WITH {SQL_PAIRS} SELECT model_id, ord, row_number() OVER (PARTITION BY model_id ORDER BY
  md5('11|' || model_id || '|' || ord), ord) AS sample_rank FROM pairs
QUALIFY sample_rank <= 1500""", ints="sample_rank")
def large_reservoir_sample(v):
    return sampling.reservoir_sample(v.pairs().select("model_id", "ord"), "model_id", 1500, 11,
                                     key="ord")


SAMPLES_SQL = f"""{sql_subpools()}, stripped AS (SELECT dimension, record_id,
  {sql_strip('prompt')} AS prompt FROM subpools),
firsts AS (SELECT * FROM stripped WHERE prompt <> ''
  QUALIFY row_number() OVER (PARTITION BY dimension, prompt ORDER BY record_id) = 1),
samples AS (SELECT dimension, record_id, prompt, row_number() OVER (PARTITION BY dimension ORDER BY
  md5('20260305|' || dimension || '|' || prompt)) AS rank FROM firsts QUALIFY rank <= 45),
named AS (SELECT *, dimension || '-' || lpad(CAST(rank AS VARCHAR), 5, '0') || '-' ||
  substr(sha1(prompt), 1, 16) AS sample_id FROM samples)"""


def samples(v):
    return sampling.sample_dimension_prompts(v.subpools(), 45, 20260305)


@query("dimension_samples", "SMP4 FN10", f"""
WITH {SAMPLES_SQL} SELECT dimension, record_id, rank, sample_id FROM named""", ints="rank")
def dimension_samples(v):
    return samples(v).select("dimension", "record_id", "rank", "sample_id")


@query("unique_prompt_sample", "DUP4", f"""
WITH {SQL_PROMPTS}, u AS (SELECT record_id, prompt FROM prompts WHERE prompt <> ''
  QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY record_id) = 1)
SELECT record_id FROM u ORDER BY md5('3|' || prompt), record_id LIMIT 120""")
def unique_prompt_sample(v):
    return sampling.sample_unique(v.prompts(), 120, 3).select("record_id")


@query("top_prompts_by_score", "SMP5", """
SELECT o_orderkey AS record_id, o_totalprice AS score FROM orders
WHERE contains(lower(o_orderpriority), 'urgent') AND length(trim(o_orderpriority)) >= 5
ORDER BY o_totalprice DESC, o_orderkey LIMIT 500""")
def top_prompts_by_score(v):
    orders = v.table("orders").select(
        F.col("o_orderkey").alias("record_id"), F.col("o_totalprice").alias("score"),
        F.col("o_orderpriority").alias("prompt"), F.col("o_orderpriority").alias("model"))
    return sampling.top_k_by_score(orders, "score", 500, min_len=5, model="Urgent").select(
        "record_id", "score")


@query("candidate_shards", "SMP6", f"""
WITH {SQL_TAGGED}, c AS (SELECT record_id, row_number() OVER (ORDER BY record_id) AS rank
  FROM tagged WHERE {sql_has('has_person')})
SELECT record_id, rank, CAST((rank - 1) % 3 AS INT) AS shard FROM c""")
def candidate_shards(v):
    people = held(v.tagged(), "semantic_tags").where(
        F.array_contains("semantic_tags", "has_person"))
    return sampling.candidate_shards(people.select("record_id"), 3)


TYPES = tx.SEMANTIC_SUBGROUPS["semantic_object"]


@query("balanced_degradation_draws", "SMP7 SMP8", f"""
WITH {SQL_PROMPTS}, d AS (SELECT record_id, t, row_number() OVER (PARTITION BY record_id ORDER BY
    md5('5|' || record_id || '|' || t), t) - 1 AS neg_idx
  FROM prompts, (SELECT unnest({sql_list(TYPES)}) AS t))
SELECT record_id, neg_idx, t AS degradation_type, {sql_pick(tx.SEVERITIES, 'neg_idx')} AS severity
FROM d WHERE neg_idx < 3""", ints="neg_idx")
def balanced_degradation_draws(v):
    drawn = sampling.degradation_draws(v.prompts().select("record_id"), TYPES, 3, 5)
    return drawn.withColumn("severity", sampling.severity("round_robin", neg_idx="neg_idx"))


U32 = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"


@query("repeated_degradation_draws", "SMP7 SMP8", f"""
WITH {SQL_PROMPTS}, d AS (SELECT record_id, unnest(range(7)) AS neg_idx FROM prompts)
SELECT record_id, neg_idx,
  {sql_pick(TYPES, U32.format("'5|' || record_id || '|' || neg_idx"))} AS degradation_type,
  CASE WHEN {U32.format("record_id || '#' || neg_idx")} / 4294967296.0::DOUBLE < 0.2 THEN 'mild'
       WHEN {U32.format("record_id || '#' || neg_idx")} / 4294967296.0::DOUBLE < 0.6
       THEN 'moderate' ELSE 'severe' END AS severity FROM d""", ints="neg_idx")
def repeated_degradation_draws(v):
    drawn = sampling.degradation_draws(v.prompts().select("record_id"), TYPES, 7, 5)
    key = F.concat_ws("#", F.col("record_id").cast("string"), F.col("neg_idx").cast("string"))
    return drawn.withColumn("severity", sampling.severity("weighted", key=key))


@query("tag_spot_check", "FLT24", f"""
WITH {SQL_TAGGED} SELECT record_id, array_to_string(tags, ',') AS tags FROM tagged
WHERE {sql_has('has_hand')} ORDER BY md5('1|' || record_id), record_id LIMIT 20""")
def tag_spot_check(v):
    return sampling.tag_spot_check(v.tagged(), "has_hand", 20, 1).select(
        "record_id", F.array_join("semantic_tags", ",").alias("tags"))


GRID_DIMS = tx.SEMANTIC_SUBGROUPS["semantic_anatomy"]


@query("systematic_work_grid", "QTA13", f"""
WITH {sql_subpools()}, s AS (SELECT dimension, record_id, row_number() OVER (PARTITION BY dimension
    ORDER BY md5('9|' || dimension || '|' || record_id), record_id) AS sample_rank FROM subpools
  QUALIFY sample_rank <= 10),
o(ord, dimension) AS (VALUES {', '.join(f"({i}, {q(d)})" for i, d in enumerate(GRID_DIMS))}),
n AS (SELECT s.*, 41 + row_number() OVER (ORDER BY ord, sample_rank) AS seed
  FROM s JOIN o USING (dimension))
SELECT dimension, record_id, sample_rank, seed, unnest(['moderate', 'severe']) AS severity FROM n""", ints="sample_rank seed")
def systematic_work_grid(v):
    dims = param_table(v.spark, list(enumerate(GRID_DIMS)), "ord int, dimension string")
    return sampling.systematic_grid(v.subpools().select("dimension", "record_id"), dims, 10,
                                    ["moderate", "severe"], 42, 9)


@query("random_work_grid", "QTA14", f"""
WITH {SQL_PROMPTS}, r AS (SELECT record_id, row_number() OVER (ORDER BY record_id) AS rank
  FROM prompts), d AS (SELECT record_id, rank, unnest(range(4)) AS i FROM r)
SELECT record_id, i AS pair_idx,
  {sql_pick(tx.DIMENSIONS, U32.format("'8|dimension|' || record_id || '|' || i"))} AS dimension,
  {sql_pick(tx.SEVERITIES, U32.format("'8|severity|' || record_id || '|' || i"))} AS severity,
  42 + (rank - 1) * 4 + i AS seed FROM d""", ints="pair_idx")
def random_work_grid(v):
    return sampling.random_grid(v.prompts().select("record_id"), tx.DIMENSIONS, tx.SEVERITIES, 4,
                                42, 8)


@query("remaining_work", "JN7 ST3", f"""
WITH {SQL_PAIRS}, users AS (SELECT DISTINCT positive_prompt FROM pairs),
w AS (SELECT positive_prompt AS prompt, d AS dimension, s AS severity FROM users,
  (SELECT unnest({sql_list(tx.DIMENSIONS)}) AS d), (SELECT unnest({sql_list(tx.SEVERITIES)}) AS s))
SELECT prompt, dimension, severity FROM w WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.success
  AND p.positive_prompt = w.prompt AND p.dimension = w.dimension AND p.severity = w.severity)""")
def remaining_work(v):
    pairs = v.pairs()
    grid = pairs.select(F.col("positive_prompt").alias("prompt")).distinct().withColumn(
        "dimension", F.explode(F.array(*[F.lit(d) for d in tx.DIMENSIONS]))).withColumn(
        "severity", F.explode(F.array(*[F.lit(s) for s in tx.SEVERITIES])))
    return sampling.without_completed(grid, pairs)


# --- sizing and plans: the weights and counts come from the pair log ---------------------------

def weights(v):
    return v.pairs().groupBy("dimension").agg(
        (F.count_if(~F.col("success")) - 40).cast("double").alias("weight"),
        (F.avg(F.col("success").cast("int")) < 0.5).alias("constrained"))


WEIGHTS_SQL = f"""{SQL_PAIRS}, w AS (SELECT dimension,
  CAST(count(*) FILTER (WHERE NOT success) - 40 AS DOUBLE) AS weight,
  avg(CAST(success AS INT)) < 0.5 AS constrained FROM pairs GROUP BY 1),
t AS (SELECT sum(greatest(weight, 0)) AS total, count(*) AS n FROM w),
nw AS (SELECT dimension, constrained, CASE WHEN total <= 0 THEN 1.0::DOUBLE / n
  ELSE greatest(weight, 0) / total END AS weight FROM w, t)"""


@query("normalized_weights", "QTA1",
       f"WITH {WEIGHTS_SQL} SELECT dimension, constrained, round(weight, 9) AS weight FROM nw")
def normalized_weights(v):
    return quotas.normalize_weights(weights(v)).withColumn("weight", F.round("weight", 9))


@query("pool_sizes", "QTA2", f"""
WITH {WEIGHTS_SQL}, e AS (SELECT *, CAST(round_even(1000 * weight, 0) AS BIGINT) AS estimated_pairs
  FROM nw), b AS (SELECT *, CAST(ceil(estimated_pairs / 3) AS BIGINT) AS base FROM e)
SELECT dimension, constrained, estimated_pairs, greatest(CASE WHEN constrained THEN
    CAST(ceil(base * 1.5) AS BIGINT) ELSE base END, 10) AS required_positive_prompts,
  334 AS target_positive_pool_size FROM b""")
def pool_sizes(v):
    return quotas.pool_sizes(weights(v), 1000, 3).drop("weight")


@query("ranked_sources", "QTA3", f"""
WITH {SQL_TAGGED}, s AS (SELECT source AS name, count(*) AS prompt_count,
  count(*) FILTER (WHERE {sql_has('has_person')}) / count(*) AS p,
  count(*) FILTER (WHERE {sql_has('has_hand')}) / count(*) AS h FROM tagged GROUP BY 1)
SELECT name, prompt_count, round((p + h) / 3.0, 9) AS avg_target_coverage,
  round((p + h) / 3.0 * sqrt(prompt_count), 9) AS selection_score FROM s""")
def ranked_sources(v):
    per_source = v.tagged().groupBy(F.col("source").alias("name")).agg(
        F.count(F.lit(1)).alias("prompt_count"),
        F.avg(F.array_contains("semantic_tags", "has_person").cast("int")).alias("p"),
        F.avg(F.array_contains("semantic_tags", "has_hand").cast("int")).alias("h"))
    coverage = per_source.select("name", F.inline(F.array(
        F.struct(F.lit("body_proportion_error").alias("dimension"), F.col("p").alias("coverage")),
        F.struct(F.lit("hand_malformation").alias("dimension"), F.col("h").alias("coverage")))))
    ranked = quotas.rank_sources(per_source.select("name", "prompt_count"), coverage,
                                 ["body_proportion_error", "hand_malformation", "blur"])
    return ranked.withColumn("avg_target_coverage", F.round("avg_target_coverage", 9)).withColumn(
        "selection_score", F.round("selection_score", 9))


FAMILY_NAMES = ["hands_visible_template", "portrait_face_template", "relation_count_template",
                "unlisted_template"]
MIX = [("hands_visible_template", 0, "human_activity_interaction", 0.35),
       ("hands_visible_template", 1, "food_tabletop", 0.25),
       ("hands_visible_template", 2, "objects_products_tools", 0.4),
       ("portrait_face_template", 0, "human_portrait", 0.75),
       ("portrait_face_template", 1, "events_performance_culture", 0.25),
       ("relation_count_template", 0, "food_tabletop", 0.5),
       ("relation_count_template", 1, "animals_creatures", 0.15),
       ("relation_count_template", 2, "urban_built_outdoor", 0.15),
       ("relation_count_template", 3, "natural_landscape", 0.2)]
TIERS, MODES = ["A", "B", "C"], ["global_balanced", "dimension_specific"]


def plans(v):
    """Backfill plan: a dimension asks for as many prompts as it had failed pairs."""
    number = F.element_at(F.create_map(*[x for i, d in enumerate(tx.DIMENSIONS)
                                         for x in (F.lit(d), F.lit(i))]), F.col("dimension"))
    return v.pairs().where(~F.col("success")).groupBy("dimension").agg(
        F.count(F.lit(1)).alias("target_new_prompts")).withColumn("_i", number).select(
        "dimension", "target_new_prompts", (F.col("_i") % 3 + 1).alias("priority"),
        pick(TIERS, F.col("_i")).alias("tier"), pick(MODES, F.col("_i")).alias("coverage_mode"),
        pick(FAMILY_NAMES, F.col("_i")).alias("template_family"))


OVERRIDES = [("blur", 0, "food_tabletop", 7), ("blur", 1, "human_portrait", 4)]
MIX_SCHEMA = "template_family string, ord int, macro_bucket string, ratio double"
DIM_NUMBER = f"(list_position({sql_list(tx.DIMENSIONS)}, dimension) - 1)"
PLANS_SQL = f"""{SQL_PAIRS}, numbered AS (SELECT dimension, count(*) AS target_new_prompts,
  {DIM_NUMBER} AS i FROM pairs WHERE NOT success GROUP BY dimension),
plans AS (SELECT dimension, target_new_prompts, i % 3 + 1 AS priority, {sql_pick(TIERS, 'i')} AS tier,
  {sql_pick(MODES, 'i')} AS coverage_mode, {sql_pick(FAMILY_NAMES, 'i')} AS template_family
  FROM numbered),
mix(template_family, ord, macro_bucket, ratio) AS (VALUES {', '.join(
    f"({q(f)}, {o}, {q(b)}, {r}::DOUBLE)" for f, o, b, r in MIX)}),
mixed AS (SELECT p.dimension, coalesce(m.ord, 0) AS ord, coalesce(m.macro_bucket,
    {q(rq.DEFAULT_SCENE_BUCKET)}) AS macro_bucket, target_new_prompts,
    CAST(round_even(target_new_prompts * ratio, 0) AS BIGINT) AS part,
    max(coalesce(m.ord, 0)) OVER (PARTITION BY p.dimension) AS last
  FROM plans p LEFT JOIN mix m USING (template_family) WHERE p.dimension <> 'blur'),
buckets AS (SELECT dimension, ord, macro_bucket, CAST(CASE WHEN ord = last THEN target_new_prompts
    - coalesce(sum(part) OVER (PARTITION BY dimension ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) ELSE part END AS BIGINT) AS bucket_prompts FROM mixed
  UNION ALL SELECT * FROM (VALUES {', '.join(
      f"({q(d)}, {o}, {q(b)}, {n})" for d, o, b, n in OVERRIDES)}))"""


def buckets(v, planned):
    return quotas.scene_mix(
        planned, param_table(v.spark, MIX, MIX_SCHEMA),
        param_table(v.spark, OVERRIDES, "dimension string, ord int, macro_bucket string, "
                                        "bucket_prompts long"))


@query("scene_mix", "QTA4",
       f"WITH {PLANS_SQL} SELECT dimension, ord, macro_bucket, bucket_prompts FROM buckets")
def scene_mix(v):
    return buckets(v, plans(v))


@query("priority_queue", "QTA5", f"""
WITH {PLANS_SQL} SELECT dimension, priority, target_new_prompts FROM plans
ORDER BY priority, target_new_prompts DESC, dimension LIMIT 12""")
def priority_queue(v):
    return quotas.priority_queue(plans(v), 12).select("dimension", "priority",
                                                      "target_new_prompts")


JOBS_SQL = f"""{PLANS_SQL}, sized AS (SELECT b.dimension, b.ord, b.macro_bucket, b.bucket_prompts,
    p.priority, p.tier, p.coverage_mode, p.template_family,
    CAST(ceil(b.bucket_prompts / 5) AS BIGINT) AS chunks, CAST(coalesce(sum(ceil(b.bucket_prompts / 5))
      OVER (ORDER BY priority, target_new_prompts DESC, b.dimension, b.ord ROWS BETWEEN UNBOUNDED
      PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM buckets b JOIN plans p USING (dimension) WHERE bucket_prompts > 0),
chunked AS (SELECT *, unnest(range(1, chunks + 1)) AS chunk_index FROM sized),
jobs AS (SELECT dimension, macro_bucket, priority, tier, coverage_mode, template_family,
    chunk_index, before + chunk_index AS request_id,
    least(5, bucket_prompts - (chunk_index - 1) * 5) AS requested_prompts FROM chunked)"""


def jobs(v):
    planned = plans(v)
    return quotas.request_plan(planned, buckets(v, planned), 5)


@query("request_plan", "QTA6", f"""
WITH {JOBS_SQL} SELECT request_id, dimension, macro_bucket, priority, tier, coverage_mode,
  chunk_index, requested_prompts FROM jobs""")
def request_plan(v):
    return jobs(v).select("request_id", "dimension", "macro_bucket", "priority", "tier",
                          "coverage_mode", "chunk_index", "requested_prompts")


BATCHES_SQL = f"""{JOBS_SQL}, batches AS (SELECT CAST((request_id - 1) // 10 + 1 AS BIGINT)
    AS batch_index, count(*) AS request_count, min(request_id) AS first_request_id,
    max(request_id) AS last_request_id, CAST(sum(requested_prompts) AS BIGINT)
    AS total_target_prompts, array_to_string(list_sort(list_distinct(list(dimension))), ',')
    AS dimensions FROM jobs GROUP BY 1)"""


@query("request_batches", "QTA7", f"WITH {BATCHES_SQL} SELECT * FROM batches")
def request_batches(v):
    return quotas.batch_plan(jobs(v), 10)


def outputs(v, batches):
    """Outputs so far, from the event log: event n reports on batch n."""
    return v.table("events").groupBy(F.col("event_id").alias("batch_index")).agg(
        F.max(F.col("event_type") != "error").alias("generated_exists"),
        F.max(F.col("event_type") != "view").alias("summary_exists"))


STATUS = f"""{BATCHES_SQL}, out AS (SELECT event_id AS batch_index, event_type <> 'error' AS g,
  event_type <> 'view' AS s FROM events),
status AS (SELECT b.batch_index, b.request_count, CASE WHEN coalesce(g AND s, FALSE)
  THEN 'completed' ELSE 'pending' END AS status FROM batches b LEFT JOIN out USING (batch_index))"""


@query("batch_status", "QTA8", f"""
WITH {STATUS} SELECT batch_index, request_count, status, status = 'pending' AND batch_index =
  (SELECT min(batch_index) FROM status WHERE status = 'pending') AS is_next FROM status""")
def batch_status(v):
    planned = quotas.batch_plan(jobs(v), 10)
    return quotas.batch_status(planned, outputs(v, planned)).select(
        "batch_index", "request_count", "status", "is_next")


@query("batch_totals", "QTA8", f"""
WITH {STATUS} SELECT count(*) AS batch_count,
  count(*) FILTER (WHERE status = 'completed') AS completed_batches,
  count(*) FILTER (WHERE status = 'pending') AS pending_batches,
  min(batch_index) FILTER (WHERE status = 'pending') AS next_pending_batch_index FROM status""")
def batch_totals(v):
    planned = quotas.batch_plan(jobs(v), 10)
    return quotas.batch_totals(quotas.batch_status(planned, outputs(v, planned)))


INSTRUCTION = "CASE template_family " + " ".join(
    f"WHEN {q(n)} THEN {q(t)}" for n, t in rq.TEMPLATE_INSTRUCTIONS.items()) + \
    f" ELSE {q(rq.DEFAULT_INSTRUCTION)} END"


@query("request_texts", "QTA9", f"""
WITH {JOBS_SQL} SELECT request_id, md5('Generate ' || requested_prompts || ' high-quality positive '
  || 'prompts for the macro bucket ''' || macro_bucket || ''' that support the assigned downstream '
  || 'contrastive check. Template family: ' || template_family || '. ' ||
  {q(rq.ANCHOR_INSTRUCTION)} || ' ' || {INSTRUCTION} || ' Return only a JSON array of prompt '
  || 'strings. Keep prompts semantically natural, varied, and usable as positive anchors.')
  AS user_md5, md5('You are generating high-quality positive prompts for a text-to-image model. '
  || 'Support the assigned downstream contrastive check without mentioning internal degradation '
  || 'labels. Template family: ' || template_family || '. Coverage mode: ' || coverage_mode ||
  '. Complexity mode: ' || tier || '. This request is only for the macro bucket: ' || macro_bucket
  || '. Follow the configured macro taxonomy and micro-structure constraints. Do not use quality '
  || 'booster tokens such as masterpiece, best quality, 8k, or ultra detailed. Keep the prompt '
  || 'length within 20-60 words. ' || CASE coverage_mode WHEN 'global_balanced' THEN 'Use the '
  || 'current macro bucket only, while preserving globally balanced style diversity overall.'
  ELSE 'Respect the dimension-specific macro coverage policy within this single macro bucket.' END
  || ' This request target: - ' || macro_bucket || ': ' || requested_prompts || ' Output only the '
  || 'generated prompts, without explanations or numbering unless explicitly requested.')
  AS system_md5 FROM jobs""")
def request_texts(v):
    rendered = quotas.request_text(jobs(v).withColumn("complexity_mode", F.col("tier")), 20, 60)
    return rendered.select("request_id", F.md5("user_prompt").alias("user_md5"),
                           F.md5("system_prompt").alias("system_md5"))


@query("backfill_summary", "AGG18", f"""
WITH {PLANS_SQL} SELECT CASE WHEN grouping(tier) = 0 THEN 'tier' WHEN grouping(coverage_mode) = 0
  THEN 'coverage_mode' ELSE 'total' END AS level, coalesce(tier, coverage_mode, 'all') AS name,
  count(*) AS dimensions, CAST(sum(target_new_prompts) AS BIGINT) AS target_new_prompts
FROM plans GROUP BY GROUPING SETS ((tier), (coverage_mode), ())""")
def backfill_summary(v):
    return quotas.backfill_summary(plans(v))


CATALOG_SQL = f"""{STATUS_SQL}, spec AS (SELECT source, count(*) AS candidate_pool_size,
    count(*) // 3 AS final_selected_size FROM s GROUP BY 1),
catalog AS (SELECT source, count(*) + CASE WHEN source = 'parti_prompts' THEN 1 ELSE 0 END
    AS candidate_pool_size, count(*) // 3 + CASE WHEN source = 'pick_a_pic_v2' THEN 1 ELSE 0 END
    AS final_selected_size FROM s WHERE source <> 'longbench_t2i' GROUP BY 1),
parts AS (SELECT source, lang AS name, CASE WHEN source = 't2i_compbench' THEN 0 WHEN lang = 'en'
    THEN (SELECT count(*) // 3 FROM s x WHERE x.source = s.source) ELSE 0 END
    AS final_selected_size FROM s GROUP BY 1, 2)"""


def catalog_tables(v):
    """Catalog, sampling specification and bucket plan, with one mistake of each kind."""
    sized = v.prompts().groupBy("source").agg(F.count(F.lit(1)).alias("candidate_pool_size"))
    spec = sized.withColumn("final_selected_size", F.floor(F.col("candidate_pool_size") / 3))
    catalog = spec.where("source <> 'longbench_t2i'").withColumn(
        "candidate_pool_size", F.col("candidate_pool_size")
        + (F.col("source") == "parti_prompts").cast("int")).withColumn(
        "final_selected_size", F.col("final_selected_size")
        + (F.col("source") == "pick_a_pic_v2").cast("int"))
    names = v.prompts().select("source", F.col("lang").alias("name")).distinct()
    parts = names.join(spec, "source").select(
        "source", "name", F.when((F.col("source") != "t2i_compbench") & (F.col("name") == "en"),
                                 F.col("final_selected_size")).otherwise(F.lit(0)).alias(
            "final_selected_size"))
    return catalog, spec, parts


@query("source_plan_violations", "SRC11", f"""
WITH {CATALOG_SQL}, b AS (SELECT source, sum(final_selected_size) AS total FROM parts GROUP BY 1),
j AS (SELECT spec.source, CASE WHEN c.source IS NULL THEN 'unknown_source'
  WHEN spec.candidate_pool_size <> c.candidate_pool_size THEN 'candidate_pool_mismatch'
  WHEN spec.final_selected_size <> c.final_selected_size THEN 'final_selected_mismatch'
  WHEN coalesce(b.total, 0) <> spec.final_selected_size THEN 'bucket_total_mismatch' END
  AS violation FROM spec LEFT JOIN catalog c ON c.source = spec.source
  LEFT JOIN b ON b.source = spec.source)
SELECT source, violation FROM j WHERE violation IS NOT NULL""")
def source_plan_violations(v):
    return quotas.plan_violations(*catalog_tables(v))


@query("download_manifest", "SRC12", f"""
WITH {CATALOG_SQL} SELECT *, source IN (SELECT source FROM parts WHERE final_selected_size > 0)
  AS has_bucket_plan FROM catalog""")
def download_manifest(v):
    catalog, _, parts = catalog_tables(v)
    return quotas.download_manifest(catalog, parts.where("final_selected_size > 0"))
