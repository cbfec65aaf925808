"""Queries over families and pool assembly."""

from pyspark.sql import functions as F

from promptmill.operators import families, pools, tagging
from promptmill.params import lexicon as lx
from promptmill.params import taxonomy as tx
from promptmill.plans.compat_queries import INDEX_SQL
from promptmill.plans.registry import query
from promptmill.plans.views import (FAMILIES, LEXICON, SQL_RESULTS, SQL_TAGGED, q, sql_any,
                                    sql_has, sql_list, sql_phrase, sql_strip, sql_subpools)
from promptmill.session import param_table

PEOPLE, OBJECTS, MULTI = FAMILIES
ENTITY = " OR ".join(sql_has(t) for t in tx.FAMILY_PREFILTER_ANY)
REASON_SQL = {
    PEOPLE: f"""CASE WHEN NOT {sql_has('has_person')} THEN 'missing_base_tags'
      WHEN {sql_phrase('low', lx.FAMILY_NON_NATURAL)} THEN
        'contains_non_natural_or_identity_obscuring_human_presentation'
      WHEN {sql_phrase('low', lx.FAMILY_MULTI_PERSON)} THEN 'contains_multi_person_signal'
      WHEN {sql_phrase('low', lx.FAMILY_BED_OR_ADULT)} THEN 'contains_bed_or_adult_pose_signal'
      WHEN NOT ({sql_has('has_full_body')} OR {sql_phrase('low', lx.FAMILY_FULL_BODY)})
        THEN 'insufficient_body_readability' END""",
    OBJECTS: f"""CASE WHEN NOT {sql_has('has_structured_object')} THEN 'missing_base_tags'
      WHEN {sql_has('has_person')} OR {sql_has('has_animal')}
        THEN 'contains_biological_primary_signal' END""",
    MULTI: f"""CASE WHEN NOT ({ENTITY}) THEN 'missing_entity_signal'
      WHEN NOT ({sql_has('has_multiple_objects')} OR {sql_phrase('low', lx.FAMILY_RELATION)})
        THEN 'insufficient_relation_or_reference_signal' END""",
}
UNIQUE_SQL = f"""{SQL_TAGGED}, stripped AS (SELECT record_id, tags, {sql_strip('prompt')} AS prompt
  FROM tagged), firsts AS (SELECT *, lower(prompt) AS low FROM stripped WHERE prompt <> ''
  QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY record_id) = 1)"""


def _family_queries(label, family, covers):
    reason = REASON_SQL[family]
    base = " AND ".join(sql_has(t) for t in tx.FAMILY_BASE_TAGS[family])
    body = "reason IS NULL" if family == PEOPLE else "FALSE"

    @query(f"{label}_exclusions", covers, f"""
WITH {UNIQUE_SQL}, e AS (SELECT {reason} AS reason FROM firsts)
SELECT reason, count(*) AS prompts FROM e WHERE reason IS NOT NULL GROUP BY 1""")
    def exclusions(v):
        return families.excluded_reasons(v.tagged(), family)

    @query(f"{label}_summary", "AGG17", f"""
WITH {UNIQUE_SQL}, e AS (SELECT *, {reason} AS reason FROM firsts)
SELECT count(*) FILTER (WHERE {base}) AS base_rule_recall_count,
  count(*) FILTER (WHERE reason IS NULL) AS candidate_count,
  count(*) FILTER (WHERE {body} AND {sql_has('has_full_body')}) AS has_full_body_signal,
  count(*) FILTER (WHERE {body} AND {sql_phrase('low', lx.FAMILY_FULL_BODY)})
    AS keyword_body_readable FROM e""")
    def summary(v):
        return families.family_summary(v.tagged(), family)

    @query(f"{label}_candidates", f"PL4 FN10 {covers}", ints="prompt_length", sql=f"""
WITH {UNIQUE_SQL}, e AS (SELECT *, {reason} AS reason FROM firsts),
c AS (SELECT record_id, prompt, row_number() OVER (ORDER BY record_id) AS rank FROM e
  WHERE reason IS NULL)
SELECT record_id, rank, '{family}-' || lpad(CAST(rank AS VARCHAR), 5, '0') || '-' ||
  substr(sha1(prompt), 1, 12) AS sample_id, length(prompt) AS prompt_length FROM c""")
    def candidates(v):
        return families.family_candidates(v.tagged(), family).select(
            "record_id", "rank", "sample_id", "prompt_length")


_family_queries("people_family", PEOPLE, "FLT12 FLT14 FLT17")
_family_queries("object_family", OBJECTS, "FLT12 FLT15 FLT17")
_family_queries("multi_object_family", MULTI, "FLT16 FLT17")


@query("prefiltered_candidates", "FLT18 FLT13 PL4", f"""
WITH {UNIQUE_SQL}, c AS (SELECT record_id, prompt, row_number() OVER (ORDER BY record_id) AS rank
  FROM firsts WHERE ({ENTITY}) AND ({sql_has('has_multiple_objects')} OR
  {sql_any('low', lx.FAMILY_RELATION)}))
SELECT record_id, rank, '{MULTI}-' || lpad(CAST(rank AS VARCHAR), 5, '0') || '-' ||
  substr(sha1(prompt), 1, 16) AS sample_id FROM c""")
def prefiltered_candidates(v):
    return families.prefiltered_candidates(v.tagged(), MULTI).select("record_id", "rank",
                                                                     "sample_id")


def signed(v):
    """Tagged prompts with the signature map."""
    return v.tagged().withColumn("signature", tagging.signature("semantic_tags", LEXICON))


SCREENED_SQL = f"""{SQL_TAGGED}, {SQL_RESULTS},
src AS (SELECT * FROM tagged WHERE prompt <> ''
  QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY record_id) = 1),
res AS (SELECT dimension, prompt, min(record_id) AS result_ord FROM results
  WHERE label IN ('pass', 'uncertain') AND prompt <> '' GROUP BY 1, 2),
core AS (SELECT s.*, r.result_ord FROM res r JOIN src s ON s.prompt = r.prompt
  WHERE r.dimension = 'body_proportion_error'),
deltas AS (SELECT r.dimension, s.record_id, s.prompt, r.result_ord FROM res r JOIN src s
  ON s.prompt = r.prompt WHERE r.dimension IN ('face_asymmetry', 'hand_malformation')),
pool AS (
  SELECT d AS dimension, 0 AS part, result_ord, record_id FROM core,
    (SELECT unnest(['body_proportion_error', 'impossible_pose', 'extra_limbs']) AS d)
    WHERE {sql_has('has_person')} AND {sql_has('has_full_body')}
  UNION ALL SELECT 'expression_mismatch', 0, result_ord, record_id FROM core
    WHERE {sql_has('has_person')} AND {sql_has('has_face')}
  UNION ALL SELECT d, 0, result_ord, record_id FROM core,
    (SELECT unnest(['face_asymmetry', 'hand_malformation']) AS d)
  UNION ALL SELECT dimension, 1, result_ord, record_id FROM deltas
    WHERE prompt NOT IN (SELECT prompt FROM core)
  UNION ALL SELECT 'animal_anatomy_error', 0, r.result_ord, s.record_id FROM res r JOIN src s
    ON s.prompt = r.prompt WHERE r.dimension = 'animal_anatomy_error')"""


@query("screened_subpools", "PL2 SET1 JN1 FLT20", f"""
WITH {SCREENED_SQL} SELECT dimension, part, result_ord, record_id FROM pool""")
def screened_subpools(v):
    return pools.screened_subpools(signed(v), v.results()).select(
        "dimension", "part", "result_ord", "record_id")


SCREENED_DIMS = [*pools.CORE_DIMENSIONS, *pools.DELTA_DIMENSIONS, pools.ANIMAL_DIMENSION, "blur"]


@query("screened_index", "PL2", f"""
WITH {SCREENED_SQL}, d AS (SELECT unnest({sql_list(SCREENED_DIMS)}) AS dimension)
SELECT d.dimension, count(p.record_id) AS count, TRUE AS skip_runtime_compat_filter
FROM d LEFT JOIN pool p ON p.dimension = d.dimension GROUP BY 1""")
def screened_index(v):
    dims = param_table(v.spark, [(d,) for d in SCREENED_DIMS], "dimension string")
    return pools.index_of(pools.screened_subpools(signed(v), v.results()), dims)


@query("matched_sources", "JN1", f"""
WITH {SQL_TAGGED}, {SQL_RESULTS}, src AS (SELECT * FROM tagged WHERE prompt <> ''
  QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY record_id) = 1)
SELECT r.dimension, r.label, s.record_id, s.source FROM results r JOIN src s
  ON s.prompt = r.prompt""")
def matched_sources(v):
    return pools.match_source(v.results(), v.tagged()).select(
        "dimension", "label", "record_id", "source")


@query("matched_answers", "JN1", f"""
WITH {SQL_TAGGED}, {SQL_RESULTS}, src AS (SELECT * FROM tagged WHERE prompt <> ''
  QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY record_id) = 1),
answers AS (SELECT label, prompt FROM results UNION ALL SELECT 'benchmark', text FROM benchmark)
SELECT a.label, count(*) AS answers, count(s.record_id) AS matched FROM answers a
LEFT JOIN src s ON s.prompt = a.prompt GROUP BY 1""")
def matched_answers(v):
    """How many answers have a source prompt; benchmark items as a whole are no prompts."""
    items = v.table("benchmark").select(
        (-1 - F.col("item_id")).alias("record_id"), F.lit("benchmark").alias("label"),
        F.col("text").alias("prompt"))
    answers = v.results().select("record_id", "label", "prompt").unionByName(items)
    found = pools.match_source(answers, v.tagged()).groupBy("label").agg(
        F.count(F.lit(1)).alias("matched"))
    return (answers.groupBy("label").agg(F.count(F.lit(1)).alias("answers"))
            .join(found, "label", "left").fillna(0, ["matched"]))


@query("targeted_subpools", "PL3 DUP2", f"""
WITH {sql_subpools(['object_structure_error'])}, u AS (SELECT record_id FROM subpools
  WHERE prompt <> '' QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY record_id) = 1)
SELECT d AS dimension, record_id FROM u,
  (SELECT unnest(['object_structure_error', 'material_mismatch']) AS d)""")
def targeted_subpools(v):
    from promptmill.operators import compat
    pool = compat.dimension_subpools(v.tagged(), ["object_structure_error"])
    return pools.targeted_subpools(pool).select("dimension", "record_id")


FAMILY_DIMS = [(f, d) for f, dims in tx.FAMILY_DIMENSIONS.items() for d in dims] + [
    ("family_without_results", "context_mismatch")]
FAMILY_DIMS_SQL = ", ".join(f"({q(f)}, {q(d)})" for f, d in FAMILY_DIMS)


def family_dimensions(v):
    return param_table(v.spark, FAMILY_DIMS, "family_name string, dimension string")


PASS_SQL = f"""{SQL_RESULTS}, passed AS (SELECT * FROM (SELECT *, {sql_strip('prompt')} AS p
    FROM results WHERE label = 'pass') WHERE p <> ''
  QUALIFY row_number() OVER (PARTITION BY family_name, p ORDER BY record_id) = 1)"""


@query("family_index", "AGG20 PL5 SRC9", f"""
WITH {PASS_SQL} SELECT r.family_name, count(*) AS total_results,
  count(*) FILTER (WHERE label = 'pass') AS pass_count,
  count(*) FILTER (WHERE label <> 'pass') AS fail_count,
  (SELECT count(*) FROM passed p WHERE p.family_name = r.family_name) AS pool_count
FROM results r GROUP BY r.family_name""")
def family_index(v):
    return pools.family_index(v.results())


@query("finalized_dimensions", "PL5 JN5 DUP2", f"""
WITH {PASS_SQL}, f(family_name, dimension) AS (VALUES {FAMILY_DIMS_SQL})
SELECT f.dimension, f.family_name, p.record_id FROM passed p JOIN f USING (family_name)""")
def finalized_dimensions(v):
    return pools.finalize_dimensions(v.results(), family_dimensions(v)).select(
        "dimension", "family_name", "record_id")


RULE_TAGS = " OR ".join(sql_has(t) for t in tx.RULE_ONLY_TAGS)


@query("finalized_index", "PL5 JN5 FLT13", f"""
WITH {SQL_TAGGED}, {PASS_SQL}, f(family_name, dimension) AS (VALUES {FAMILY_DIMS_SQL})
SELECT f.dimension, count(p.record_id) AS count, f.family_name AS source_family
FROM f LEFT JOIN passed p ON p.family_name = f.family_name GROUP BY 1, 3
UNION ALL SELECT 'floating_objects', count(DISTINCT {sql_strip('prompt')}), 'rule_recall_only'
FROM tagged WHERE ({RULE_TAGS}) AND {sql_strip('prompt')} <> ''""")
def finalized_index(v):
    return pools.finalize_index(v.results(), v.tagged(), family_dimensions(v))


@query("rule_only_pool", "PL5 FLT13", f"""
WITH {SQL_TAGGED} SELECT record_id, 'floating_objects' AS dimension, 'rule_recall_only'
  AS source_pool_mode FROM (SELECT *, {sql_strip('prompt')} AS p FROM tagged WHERE {RULE_TAGS})
WHERE p <> '' QUALIFY row_number() OVER (PARTITION BY p ORDER BY record_id) = 1""")
def rule_only_pool(v):
    return pools.rule_only_pool(v.tagged(), tx.RULE_ONLY_TAGS, tx.RULE_ONLY_DIMENSION).select(
        "record_id", "dimension", "source_pool_mode")


TOKENS = r"len(regexp_extract_all(prompt, '[A-Za-z]+|[0-9]|[^\t\n\x0b\f\r A-Za-z0-9]+')) + 2"
LIMIT = (f"CASE WHEN dimension IN ({', '.join(q(d) for d in tx.STRICT_DIMENSIONS)}) "
         f"THEN 140 ELSE 250 END")


@query("token_limited_subpools", "FLT19 PL6", f"""
WITH {sql_subpools()}, t AS (SELECT dimension, record_id, {TOKENS} AS tokens, {LIMIT} AS max_tokens
  FROM subpools) SELECT dimension, max_tokens, count(*) FILTER (WHERE tokens <= max_tokens) AS kept,
  count(*) FILTER (WHERE tokens > max_tokens) AS dropped_too_long FROM t GROUP BY 1, 2""")
def token_limited_subpools(v):
    # Tokens are measured once per prompt, before the prompt is fanned out to its dimensions.
    from promptmill.operators import compat
    measured = v.tagged().withColumn("tokens", pools.word_piece_estimate("prompt"))
    fanned = compat.dimension_subpools(measured).select("dimension", "tokens")
    return pools.token_filter_summary(fanned, limit=pools.token_limit(
        "dimension", 250, 140), measure=F.col, prompt="tokens")


@query("token_counts_by_udf", "FLT19")
def token_counts_by_udf(v):
    """The same filter with a Python token counter, as a caller would plug a tokenizer in."""
    import pandas as pd

    @F.pandas_udf("int")
    def pieces(prompts: pd.Series) -> pd.Series:
        return prompts.str.count(r"[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+") + 2

    kept = pools.within_token_budget(v.tagged(), F.lit(250), measure=lambda c: pieces(F.col(c)))
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("kept"))


# --- routing: settings joined to the observed pool sizes ---------------------------------------

def routing(v, drop=("blur",), extra=("noise_grain",)):
    rows = [r for r in tx.routing_rows() if r[0] not in drop]
    rows += [(d, tx.GLOBAL_POOL, [], None, False, None) for d in extra]
    return param_table(v.spark, rows, tx.ROUTING_SCHEMA)


def routes(v):
    return pools.routing_table(v.dimension_table(), routing(v))


def _text(value):
    return "NULL" if value is None else q(value)


ROUTE_ROWS = [("blur", tx.GLOBAL_POOL, [], None, False, None)] + [
    r for r in tx.routing_rows() if r[0] != "blur"]
ROUTES_SQL = "routes(dimension, strategy, base_tags, family, screen, turbo) AS (VALUES " + ", ".join(
    f"({q(d)}, {q(s)}, {q(','.join(t))}, {_text(f)}, {str(b).upper()}, {_text(u)})"
    for d, s, t, f, b, u in ROUTE_ROWS) + ")"


@query("routing_status", "PL7 AGG7", f"""
WITH {INDEX_SQL}, {ROUTES_SQL}
SELECT r.dimension, m.model_id, r.strategy, r.base_tags, r.family AS shared_pool_family,
  r.screen AS llm_screening_required, i.count AS pool_count, CASE WHEN i.count IS NULL THEN
  'fallback_runtime_filter' ELSE 'active_index_subpool' END AS current_mode
FROM routes r CROSS JOIN models m LEFT JOIN idx i ON i.model_id = m.model_id
  AND i.dimension = r.dimension""")
def routing_status(v):
    return pools.routing_status(routes(v), v.model_table(), v.model_index()).select(
        "dimension", "model_id", "strategy", F.array_join("base_tags", ",").alias("base_tags"),
        "shared_pool_family", "llm_screening_required", "pool_count", "current_mode")


# Dimensions that succeed more often than they fail.
OBSERVED = """SELECT dimension FROM pairs GROUP BY dimension
  HAVING count(*) FILTER (WHERE success) > count(*) FILTER (WHERE NOT success)"""


@query("routing_warnings", "SET4", f"""
WITH {INDEX_SQL}, o AS ({OBSERVED}), {ROUTES_SQL}, c AS (SELECT dimension FROM routes
  WHERE dimension <> 'blur' UNION ALL SELECT 'noise_grain')
SELECT dimension, 'missing_in_config' AS warning FROM o WHERE dimension NOT IN
  (SELECT dimension FROM c)
UNION ALL SELECT dimension, 'extra_in_config' FROM c WHERE dimension NOT IN
  (SELECT dimension FROM o)""")
def routing_warnings(v):
    ok = F.col("success")
    observed = v.pairs().groupBy("dimension").agg(
        F.count_if(ok).alias("s"), F.count_if(~ok).alias("f")).where("s > f").select("dimension")
    return pools.routing_warnings(observed, routing(v))


def _with_pool(v, table, *columns):
    """Settings next to the number of successful pairs observed for the dimension."""
    counts = v.pairs().where("success").groupBy("dimension").agg(
        F.count(F.lit(1)).alias("pairs"))
    return table.join(counts, "dimension", "left").select(
        *columns, F.coalesce("pairs", F.lit(0)).alias("pairs"))


SPEC_ROWS = {d: (f, tx.RULE_THEN_SCREEN if s == tx.RULE_THEN_SCREEN else tx.RULE_ONLY, b,
                 ",".join(t), u) for d, s, t, f, b, u in ROUTE_ROWS}
SPEC_SQL = "spec(dimension, family, mode, screen, base_tags, turbo) AS (VALUES " + ", ".join(
    f"({q(d)}, {_text(f)}, {q(m)}, {str(b).upper()}, {q(t)}, {_text(u)})"
    for d, (f, m, b, t, u) in SPEC_ROWS.items()) + ")"


@query("screening_spec", "PL8 JN10", f"""
WITH {INDEX_SQL}, {SPEC_SQL} SELECT s.dimension, s.family AS shared_pool_family, s.mode
  AS builder_mode, s.screen AS requires_llm_screen, s.base_tags, s.turbo AS turbo_pool_strategy,
  count(p.pair_id) AS pairs FROM spec s LEFT JOIN pairs p ON p.dimension = s.dimension AND p.success
GROUP BY ALL""")
def screening_spec(v):
    overrides = param_table(v.spark, tx.SCREENING_OVERRIDES, tx.SCREENING_OVERRIDES_SCHEMA)
    spec = pools.screening_spec(routes(v), overrides)
    return _with_pool(v, spec, "dimension", "shared_pool_family", "builder_mode",
                      "requires_llm_screen", F.array_join("base_tags", ",").alias("base_tags"),
                      "turbo_pool_strategy")


@query("build_targets", "PL8", f"""
WITH {INDEX_SQL}, {SPEC_SQL} SELECT s.dimension, s.mode AS build_mode, s.dimension || '.jsonl'
  AS filename, count(p.pair_id) AS pairs FROM spec s LEFT JOIN pairs p
  ON p.dimension = s.dimension AND p.success GROUP BY ALL""")
def build_targets(v):
    overrides = param_table(v.spark, tx.SCREENING_OVERRIDES, tx.SCREENING_OVERRIDES_SCHEMA)
    targets = pools.build_targets(pools.screening_spec(routes(v), overrides))
    return _with_pool(v, targets, "dimension", "build_mode", "filename")


PLAN_ROWS = []
for _family in tx.FAMILY_BASE_TAGS:
    _rows = [(d, t) for d, s, t, f, _, _ in ROUTE_ROWS if f == _family]
    _union = list(dict.fromkeys(t for _, tags in _rows for t in tags))
    PLAN_ROWS.append((_family, ",".join(d for d, _ in _rows), ",".join(_union)))


@query("family_screening_plan", "AGG21", f"""
WITH {SQL_RESULTS}, plan(family, dimensions, tags) AS (VALUES {', '.join(
    f"({q(f)}, {q(d)}, {q(t)})" for f, d, t in PLAN_ROWS)})
SELECT plan.family AS shared_pool_family, dimensions, tags AS union_rule_recall_tags,
  count(r.record_id) AS results FROM plan LEFT JOIN results r ON r.family_name = plan.family
GROUP BY ALL""")
def family_screening_plan(v):
    ordered = routes(v).join(v.dimension_table(), "dimension")
    plan = pools.screening_plan(ordered)
    seen = v.results().groupBy(F.col("family_name").alias("shared_pool_family")).agg(
        F.count(F.lit(1)).alias("results"))
    return plan.join(seen, "shared_pool_family", "left").withColumn(
        "results", F.coalesce("results", F.lit(0)))
