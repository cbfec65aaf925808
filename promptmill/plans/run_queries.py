"""Queries over run logs, attempts and allocation tables."""

from pyspark.sql import functions as F

from promptmill.operators import attempts as at
from promptmill.operators import quotas, runs
from promptmill.plans.compat_queries import INDEX_SQL
from promptmill.plans.registry import query
from promptmill.plans.views import MODELS, SQL_ATTEMPTS, SQL_PAIRS, SQL_RUNS, q


def raw_log(v):
    """Pair log as the runs write it: fields missing here and there, verdict under two names."""
    pairs = v.pairs()
    order = F.col("ord")
    verdict = F.struct("valid", "failure")
    return pairs.select(
        "run_dir", "pair_id", F.when(order % 4 != 0, F.col("dimension")).alias("dimension"),
        F.when(order % 8 == 0, F.col("dimension")).alias("expected_attribute"),
        F.when(order % 3 != 0, F.col("severity")).otherwise(F.lit("")).alias("severity"),
        F.when(order % 5 != 0, F.col("positive_prompt")).alias("positive_prompt"), "success",
        F.when(order % 2 == 0, verdict).alias("final_validation"),
        F.when(order % 2 == 1, verdict).alias("judge_result"))


def dataset_pairs(v):
    return v.pairs().where("success").select(
        "run_dir", "pair_id", F.col("positive_prompt").alias("d_prompt"),
        F.col("dimension").alias("d_attribute"), F.col("severity").alias("d_severity"))


def run_table(v):
    return v.pairs().groupBy("run_dir").agg(F.when(
        F.min("ord") % 5 != 0, F.lit("sdxl")).alias("model_id"))


RECORDS_SQL = f"""{SQL_PAIRS}, run AS (SELECT run_dir, CASE WHEN min(ord) % 5 <> 0 THEN 'sdxl'
    ELSE 'unknown' END AS model_id FROM pairs GROUP BY 1),
records AS (SELECT p.run_dir, p.pair_id, r.model_id, CASE WHEN ord % 4 <> 0 OR ord % 8 = 0 OR success
    THEN dimension ELSE 'unknown' END AS dimension, CASE WHEN ord % 3 <> 0 OR success THEN severity
    END AS severity, CASE WHEN ord % 5 <> 0 OR success THEN positive_prompt ELSE '' END
    AS positive_prompt, valid, failure, success FROM pairs p JOIN run r USING (run_dir))"""


def records(v):
    return runs.pair_records(raw_log(v), dataset_pairs(v), run_table(v))


@query("pair_records", "JN2", f"WITH {RECORDS_SQL} SELECT * FROM records")
def pair_records(v):
    return records(v)


@query("run_statistics", "AGG8", f"""
WITH {SQL_PAIRS}, g AS (SELECT model_id, dimension, severity, count(*) AS pairs,
  count(*) FILTER (WHERE success) AS valid_pairs, count(*) FILTER (WHERE NOT success)
  AS invalid_pairs, CAST(sum(total_attempts) AS BIGINT) AS total_attempts FROM pairs GROUP BY 1, 2, 3)
SELECT *, round_even(total_attempts / pairs, 2) AS avg_attempts,
  round_even(valid_pairs / pairs, 4) AS validation_rate FROM g""")
def run_statistics(v):
    return runs.run_statistics(v.pairs())


@query("filtered_run_statistics", "AGG8", f"""
WITH {SQL_PAIRS} SELECT model_id, dimension, severity, count(*) AS pairs,
  count(*) FILTER (WHERE success) AS valid_pairs FROM pairs
WHERE model_id IN ('flux-schnell') AND dimension IN ('blur', 'text_error') GROUP BY 1, 2, 3""")
def filtered_run_statistics(v):
    return runs.run_statistics(v.pairs(), ["flux-schnell"], ["blur", "text_error"]).select(
        "model_id", "dimension", "severity", "pairs", "valid_pairs")


@query("run_failure_histogram", "AGG8", f"""
WITH {SQL_PAIRS} SELECT model_id, dimension, severity, coalesce(failure, 'unknown') AS failure,
  count(*) AS pairs FROM pairs WHERE NOT success GROUP BY 1, 2, 3, 4""")
def run_failure_histogram(v):
    return runs.failure_histogram(v.pairs())


@query("generation_speed", "AGG9 FN20", f"""
WITH {SQL_RUNS}, u AS (SELECT *, epoch_us(completed_at) / 1e6 - epoch_us(created_at) / 1e6 AS s
  FROM runs WHERE completed_at > created_at AND total_pairs > 0)
SELECT model_id, round_even(sum(s) / sum(total_pairs), 2) AS avg_pair_seconds,
  round_even(sum(s) / nullif(sum(valid_pairs), 0), 2) AS avg_success_pair_seconds,
  round_even(sum(s) / (sum(total_pairs) * 2), 2) AS avg_image_seconds, count(*) AS run_count
FROM u GROUP BY 1""")
def generation_speed(v):
    return runs.generation_speed(v.runs())


@query("recent_runs", "SRC8", f"""
WITH {SQL_RUNS} SELECT run_dir, model_id, total_pairs, valid_pairs FROM runs
ORDER BY completed_at DESC, run_dir LIMIT 50""")
def recent_runs(v):
    return runs.recent_runs(v.runs(), 50).select("run_dir", "model_id", "total_pairs",
                                                 "valid_pairs")


@query("failure_patterns", "AGG10", f"""
WITH {SQL_PAIRS} SELECT coalesce(model_id, '*') AS model_id, coalesce(dimension, '*') AS dimension,
  failure, count(*) AS pairs FROM pairs WHERE failure IS NOT NULL
GROUP BY GROUPING SETS ((failure), (model_id, dimension, failure))""")
def failure_patterns(v):
    return runs.failure_patterns(v.pairs())


FAILS_SQL = f"""{SQL_PAIRS}, types AS (SELECT positive_prompt, model_id, dimension, failure,
  count(*) AS n FROM pairs WHERE failure IS NOT NULL GROUP BY 1, 2, 3, 4),
fails AS (SELECT positive_prompt, model_id, dimension, CAST(sum(n) AS BIGINT) AS failure_count,
  string_agg(failure || ':' || n, ',' ORDER BY failure || ':' || n) AS failure_types
  FROM types GROUP BY 1, 2, 3)"""


@query("failures_by_prompt", "AGG11", f"WITH {FAILS_SQL} SELECT * FROM fails")
def failures_by_prompt(v):
    return runs.ordered_failures(runs.failures_by_prompt(v.pairs()))


@query("blacklist", "AGG12", f"""
WITH {FAILS_SQL} SELECT *, 'repeated_failures_for_same_prompt_model_dimension' AS candidate_reason
FROM fails WHERE failure_count >= 2""")
def blacklist(v):
    return runs.ordered_failures(runs.blacklist(v.pairs(), 2))


DECISIONS_SQL = f"""{FAILS_SQL}, decided AS (SELECT p.*, CASE WHEN f.failure_count >= 2 THEN
  'blacklist_candidate' WHEN p.valid THEN 'keep' ELSE 'review' END AS decision
  FROM pairs p LEFT JOIN fails f ON f.positive_prompt = p.positive_prompt
  AND f.model_id = p.model_id AND f.dimension = p.dimension)"""


@query("curation_decisions", "AGG13", f"""
WITH {DECISIONS_SQL} SELECT pair_id, model_id, dimension, positive_prompt, decision,
  CASE decision WHEN 'blacklist_candidate' THEN 'prompt_repeatedly_failed_in_same_model_dimension'
  WHEN 'keep' THEN 'pair_valid' ELSE coalesce(failure, 'pair_invalid') END AS reason FROM decided""")
def curation_decisions(v):
    return runs.curation_decisions(v.pairs(), 2)


@query("decision_counts", "AGG14",
       f"WITH {DECISIONS_SQL} SELECT decision, count(*) AS pairs FROM decided GROUP BY 1")
def decision_counts(v):
    return runs.decision_counts(runs.curation_decisions(v.pairs(), 2))


@query("memory_stats", "AGG14", f"""
WITH {DECISIONS_SQL} SELECT count(DISTINCT run_dir) AS runs, count(*) AS pairs,
  count(*) FILTER (WHERE NOT valid) AS invalid_pairs,
  (SELECT count(*) FROM fails WHERE failure_count >= 2) AS blacklist_candidates,
  count(*) FILTER (WHERE decision = 'blacklist_candidate') AS decided_blacklist,
  count(*) FILTER (WHERE decision = 'keep') AS decided_keep,
  count(*) FILTER (WHERE decision = 'review') AS decided_review FROM decided""")
def memory_stats(v):
    return runs.memory_stats(v.pairs(), 2)


@query("validation_summary", "AGG15", f"""
WITH {SQL_PAIRS} SELECT count(*) AS total_pairs, count(*) FILTER (WHERE success) AS valid_pairs,
  count(*) FILTER (WHERE NOT success) AS invalid_pairs,
  CAST(sum(total_attempts) AS BIGINT) AS total_attempts,
  count(*) FILTER (WHERE success AND total_attempts = 1) AS first_try_success,
  count(*) FILTER (WHERE success AND total_attempts <> 1) AS retry_success,
  count(*) FILTER (WHERE NOT success AND total_attempts > 0) AS all_retries_failed,
  round_even(count(*) FILTER (WHERE success) / count(*), 4) AS validation_rate,
  round_even(sum(total_attempts) / count(*), 2) AS avg_attempts_per_pair FROM pairs""")
def validation_summary(v):
    return runs.validation_summary(v.pairs())


@query("validation_by_dimension", "AGG15", f"""
WITH {SQL_PAIRS} SELECT dimension, count(*) FILTER (WHERE success) AS valid,
  count(*) FILTER (WHERE NOT success) AS invalid, CAST(sum(total_attempts) AS BIGINT) AS attempts
FROM pairs GROUP BY 1""")
def validation_by_dimension(v):
    return runs.validation_by_dimension(v.pairs())


OUTCOMES_SQL = f"""{SQL_ATTEMPTS}, lasts AS (SELECT pair_id, count(*) OVER (PARTITION BY pair_id)
    AS total_attempts, status, negative_prompt, failure FROM attempts
  QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY attempt DESC) = 1)"""


@query("pair_outcomes", "ST1", f"""
WITH {OUTCOMES_SQL} SELECT pair_id, total_attempts, status = 'success' AS success,
  status AS final_status, negative_prompt AS final_negative_prompt, failure AS final_failure
FROM lasts""")
def pair_outcomes(v):
    return at.pair_outcomes(v.attempts())


@query("planned_pair_outcomes", "ST4", f"""
WITH {OUTCOMES_SQL} SELECT u.user_id AS pair_id, coalesce(l.total_attempts, 0) AS total_attempts,
  coalesce(l.status = 'success', FALSE) AS success, CASE WHEN l.pair_id IS NULL THEN 'error'
  ELSE l.failure END AS final_failure
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN lasts l ON l.pair_id = u.user_id""")
def planned_pair_outcomes(v):
    planned = v.table("events").select(F.col("user_id").alias("pair_id")).distinct()
    return at.with_error_pairs(planned, at.pair_outcomes(v.attempts())).select(
        "pair_id", "total_attempts", "success", "final_failure")


ACTIONS_SQL = f"""{SQL_ATTEMPTS}, w AS (SELECT *, count(*) FILTER (WHERE failure =
    'positive_incompatible') OVER earlier AS incompatible_before, count(*) FILTER (WHERE failure =
    'style_drift' AND style_type IS NOT NULL) OVER earlier AS drift_before FROM attempts
  WINDOW earlier AS (PARTITION BY pair_id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1
  PRECEDING))"""


@query("next_actions", "ST2", f"""
WITH {ACTIONS_SQL} SELECT pair_id, attempt, status, failure, CASE WHEN status = 'success' THEN 'done'
  WHEN status = 'skipped' THEN 'stop_skipped'
  WHEN failure = 'positive_content_mismatch' THEN 'stop_content_mismatch'
  WHEN failure = 'positive_incompatible' AND incompatible_before > 0 THEN 'stop_still_incompatible'
  WHEN attempt >= 6 THEN 'stop_exhausted'
  WHEN failure = 'positive_incompatible' THEN 'anchor_positive'
  WHEN failure = 'style_drift' AND style_type IS NOT NULL AND drift_before = 0
    THEN 'anchor_negative' ELSE 'rewrite' END AS next_action FROM w""")
def next_actions(v):
    return at.next_actions(v.attempts(), 6).select("pair_id", "attempt", "status", "failure",
                                                   "next_action")


@query("validation_failure_types", "AGG15 ST4", f"""
WITH {OUTCOMES_SQL}, f AS (SELECT failure FROM attempts WHERE status = 'failed' UNION ALL
  SELECT 'error' FROM (SELECT DISTINCT user_id FROM events)
  WHERE user_id NOT IN (SELECT pair_id FROM lasts))
SELECT failure, count(*) AS pairs FROM f GROUP BY 1""")
def validation_failure_types(v):
    planned = v.table("events").select(F.col("user_id").alias("pair_id")).distinct()
    pairs = at.with_error_pairs(planned, at.pair_outcomes(v.attempts()))
    return runs.validation_failure_types(v.attempts(), pairs)


@query("positive_reuse", "ST5", f"""
WITH {SQL_PAIRS} SELECT seed, 'img-' || arg_min(pair_id, ord) AS positive_image_path,
  count(*) AS negatives FROM pairs GROUP BY 1""")
def positive_reuse(v):
    imaged = v.pairs().withColumn("path", F.concat(F.lit("img-"), "pair_id"))
    return at.positive_reuse(imaged, "seed", "path", "ord")


@query("reuse_totals", "ST5", f"""
WITH {SQL_PAIRS} SELECT count(DISTINCT seed) AS total_positive_images,
  count(*) AS total_negative_images FROM pairs""")
def reuse_totals(v):
    return at.reuse_totals(v.pairs())


@query("severity_totals", "AGG22", f"""
WITH {SQL_PAIRS} SELECT severity, count(*) AS pairs, count(*) FILTER (WHERE success)
  AS success_count, count(*) FILTER (WHERE NOT success) AS fail_count FROM pairs GROUP BY 1""")
def severity_totals(v):
    return runs.severity_totals(v.pairs())


@query("timing_summary", "AGG25", f"""
WITH {SQL_PAIRS}, g AS (SELECT count(*) AS total_pairs, count(*) FILTER (WHERE success)
  AS success_count, count(*) FILTER (WHERE NOT success) AS fail_count,
  round_even(sum(seconds), 2) AS total_generation_time FROM pairs)
SELECT *, round_even(success_count / total_pairs * 100, 1) AS success_rate,
  round_even(total_generation_time / (success_count * 2), 2) AS avg_time_per_image FROM g""")
def timing_summary(v):
    # The decimal sum does not depend on the order rows arrive in.
    return runs.timing_summary(v.pairs().withColumn(
        "seconds", F.col("seconds").cast("decimal(18,4)"))).withColumn(
        "total_generation_time", F.col("total_generation_time").cast("double")).withColumn(
        "avg_time_per_image", F.col("avg_time_per_image").cast("double"))


@query("successful_pairs", "FLT21", f"""
WITH {SQL_ATTEMPTS} SELECT pair_id, attempt FROM attempts WHERE coalesce(negative_prompt, '') <> ''""")
def successful_pairs(v):
    return runs.successful_pairs(v.attempts()).select("pair_id", "attempt")


def _template_columns():
    return ", ".join(
        f"max(i.count) FILTER (WHERE i.model_id = {q(m)}) AS \"{m}_pool_size\", "
        f"max(h.rate) FILTER (WHERE h.model_id = {q(m)}) AS \"{m}_historical_success\""
        for m in MODELS)


@query("allocation_template", "QTA11 JN9", f"""
WITH {INDEX_SQL}, h AS (SELECT model_id, dimension, round_even(count(*) FILTER (WHERE success) /
  count(*), 4) AS rate FROM pairs GROUP BY 1, 2)
SELECT d.dimension, {_template_columns()} FROM dims d CROSS JOIN models m
LEFT JOIN idx i ON i.dimension = d.dimension AND i.model_id = m.model_id
LEFT JOIN h ON h.dimension = d.dimension AND h.model_id = m.model_id GROUP BY 1""")
def allocation_template(v):
    stats = runs.run_statistics(v.pairs())
    return quotas.allocation_template(v.dimension_table().select("dimension"), MODELS,
                                      v.model_index(), stats)


@query("allocation_rankings", "QTA12", f"""
WITH {SQL_PAIRS}, g AS (SELECT model_id, dimension, count(*) AS pairs, count(*) FILTER
  (WHERE success) AS valid_pairs FROM pairs GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY model_id ORDER BY valid_pairs / pairs DESC,
    dimension) AS INT) AS best_rank, CAST(row_number() OVER (PARTITION BY model_id ORDER BY
    valid_pairs / pairs, dimension DESC) AS INT) AS worst_rank FROM g)
SELECT model_id, dimension, pairs, valid_pairs, round_even(valid_pairs / pairs, 4) AS success_rate,
  best_rank, worst_rank FROM r WHERE best_rank <= 5 OR worst_rank <= 5""")
def allocation_rankings(v):
    return quotas.allocation_rankings(runs.run_statistics(v.pairs()))
