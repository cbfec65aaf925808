"""Queries over prompt x dimension compatibility and its reports."""

from pyspark.sql import functions as F

from promptmill.operators import compat, pools
from promptmill.functions import keys
from promptmill.params import lexicon as lx
from promptmill.params import taxonomy as tx
from promptmill.params.taxonomy import Requirement
from promptmill.plans.registry import query
from promptmill.plans.views import (SQL_MACRO, SQL_PAIRS, SQL_TAGGED, MODELS, q,
                                    sql_compatible, sql_has, sql_list, sql_pick, sql_special,
                                    sql_subpools, sql_tags_ok, sql_word)

GAP = """CASE WHEN available < 100 THEN 'scarce' WHEN available < 500 THEN 'limited'
  WHEN available < 2000 THEN 'healthy' ELSE 'strong' END"""


def sql_counts(dimensions, test) -> str:
    """``dimension, available, total`` over the table ``tagged``."""
    return " UNION ALL ".join(
        f"SELECT {q(d)} AS dimension, count(*) FILTER (WHERE {test(d)}) AS available, "
        f"count(*) AS total FROM tagged" for d in dimensions)


def sql_coverage(mode) -> str:
    return f"""WITH {SQL_TAGGED}, c AS ({sql_counts(tx.DIMENSIONS, lambda d: sql_compatible(d, mode=mode))})
SELECT dimension, available, total, round_even(available / total * 100, 2) AS coverage,
  {GAP} AS gap_level, row_number() OVER (ORDER BY available, dimension) AS scarcity_rank FROM c"""


@query("dimension_coverage", "AGG1 JN6 FLT7", sql_coverage("all"), ints="scarcity_rank")
def dimension_coverage(v):
    return compat.coverage_report(v.tagged())


@query("dimension_coverage_any_tag", "AGG1 FLT7", sql_coverage("any"), ints="scarcity_rank")
def dimension_coverage_any_tag(v):
    return compat.coverage_report(v.tagged(), mode="any")


# Text rules with words that occur in the corpus are covered by the older filter below.
ROW_DIMENSIONS = ["text_error", "extra_limbs", "hand_malformation", "logo_symbol_error", "blur"]


@query("special_rule_reasons", "FLT6", " UNION ALL ".join(
    f"(WITH p AS (SELECT text AS prompt, lower(text) AS low FROM documents) SELECT {q(d)} AS "
    f"dimension, {sql_special(d)} AS reason, count(*) AS prompts FROM p GROUP BY 1, 2)"
    for d in ["text_error", "extra_limbs", "face_asymmetry"]))
def special_rule_reasons(v):
    rules = F.array(*[F.struct(F.lit(d).alias("dimension"), compat.special_rule_reason(
        d, "prompt", "_lower").alias("reason"))
        for d in ["text_error", "extra_limbs", "face_asymmetry"]])
    return compat.with_lower(v.prompts()).select(F.inline(rules)).groupBy(
        "dimension", "reason").agg(F.count(F.lit(1)).alias("prompts"))


# Words that occur in the corpus, so that every branch of the rules has rows on both sides.
OCCURRING = {"visual_text": ["license", "mit", "the"], "back_view": ["idiot", "scum", "keit"],
             "animal": ["moron", "stupid", "ung"], "strong_face": ["the", "der", "en"],
             "human": ["and", "die", "la"]}
RULE_DIMENSIONS = ["text_error", "extra_limbs", "face_asymmetry"]
_RULE_COUNTS = " UNION ALL ".join(
    f"SELECT {q(d)} AS dimension, {sql_special(d, words=OCCURRING)} AS reason, count(*) AS prompts "
    "FROM p GROUP BY 1, 2" for d in RULE_DIMENSIONS)


@query("special_rule_branches", "FLT6", f"""
WITH p AS (SELECT prompt, lower(prompt) AS low FROM (SELECT text || CASE WHEN doc_id % 2 = 0
  THEN {q(" 'sign'")} ELSE '' END AS prompt FROM documents))
{_RULE_COUNTS}""")
def special_rule_branches(v):
    """The rules under words of the corpus; every second prompt has a quoted word behind it."""
    quoted = F.concat("prompt", F.when(F.col("record_id") % 2 == 0, F.lit(" 'sign'")).otherwise(
        F.lit("")))
    rules = F.array(*[F.struct(F.lit(d).alias("dimension"), compat.special_rule_reason(
        d, "prompt", "_lower", OCCURRING).alias("reason")) for d in RULE_DIMENSIONS])
    return compat.with_lower(v.prompts().withColumn("prompt", quoted)).select(
        F.inline(rules)).groupBy("dimension", "reason").agg(F.count(F.lit(1)).alias("prompts"))


@query("row_compatibility", "FLT7", f"""
WITH {SQL_TAGGED} SELECT record_id, {', '.join(
    f'{sql_compatible(d)} AS {d}' for d in ROW_DIMENSIONS)} FROM tagged""")
def row_compatibility(v):
    return compat.with_lower(v.tagged()).select("record_id", *[
        compat.is_compatible(d, "prompt", "_lower", "semantic_tags").alias(d)
        for d in ROW_DIMENSIONS])


def tag_map(tagged):
    """Tags of the prompts, one row per prompt text."""
    from promptmill.operators.clean import first_wins
    return first_wins(tagged, "prompt", "record_id").select(
        keys.digest("prompt").alias("_digest"), "semantic_tags")


def tag_map_sql(where="TRUE") -> str:
    return f"""{SQL_TAGGED}, tag_map AS (SELECT prompt, tags FROM tagged WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY prompt ORDER BY record_id) = 1),
looked AS (SELECT t.record_id, t.prompt, t.low, m.tags FROM tagged t
  LEFT JOIN tag_map m ON t.prompt = m.prompt)"""


BATCH_DIMENSIONS = ["hand_malformation", "text_error", "extra_limbs", "logo_symbol_error",
                    "count_error", "any_pool"]
BATCH_REQUIREMENTS = {**tx.REQUIREMENTS, "any_pool": Requirement(())}


def sql_verdict(d, older=False) -> str:
    req = BATCH_REQUIREMENTS.get(d)
    special = sql_special(d)
    if req is None or req.required is None:
        return "'ok'" if older else f"CASE WHEN {special} IS NULL THEN 'ok' ELSE 'special' END"
    if not (req.required or req.alternative):
        return "'ok'"
    return (f"CASE WHEN tags IS NULL THEN 'untagged' WHEN NOT {sql_tags_ok(req)} THEN 'tags' "
            f"WHEN {special} IS NOT NULL THEN 'special' ELSE 'ok' END")


def sql_batch(older, where="TRUE") -> str:
    body = " UNION ALL ".join(
        f"SELECT {q(d)} AS dimension, {sql_verdict(d, older)} AS verdict FROM looked"
        for d in BATCH_DIMENSIONS)
    return (f"WITH {tag_map_sql(where)}, r AS ({body}) SELECT dimension, verdict, count(*) AS prompts "
            f"FROM r GROUP BY 1, 2")


def _batch_counts(v, special_without_requirement, tagged=None):
    keyed = compat.with_lower(v.prompts()).withColumn("_digest", keys.digest("prompt"))
    looked = keyed.join(tag_map(v.tagged() if tagged is None else tagged), "_digest", "left")
    rows = F.array(*[F.struct(F.lit(d).alias("dimension"), compat.batch_verdict(
        d, "prompt", "_lower", "semantic_tags", BATCH_REQUIREMENTS,
        special_without_requirement).alias("verdict")) for d in BATCH_DIMENSIONS])
    return looked.select(F.inline(rows)).groupBy("dimension", "verdict").agg(
        F.count(F.lit(1)).alias("prompts"))


@query("batch_filter_verdicts", "FLT8 JN3", sql_batch(False))
def batch_filter_verdicts(v):
    return _batch_counts(v, True)


@query("older_batch_filter_verdicts", "FLT8", sql_batch(True))
def older_batch_filter_verdicts(v):
    return _batch_counts(v, False)


@query("batch_verdicts_of_labelled_tags", "FLT8 JN3", sql_batch(
    False, "record_id IN (SELECT doc_id FROM labels)"))
def batch_verdicts_of_labelled_tags(v):
    """Only labelled prompts have been tagged; the others are in no tag map."""
    labelled = v.table("labels").select(F.col("doc_id").alias("record_id"))
    return _batch_counts(v, True, v.tagged().join(labelled, "record_id", "left_semi"))


def sql_router(d) -> str:
    req = tx.REQUIREMENTS.get(d)
    if req is None:
        return "'no_requirements'"
    if not req.required:
        return "'preferred_only'"
    anyone = " OR ".join(sql_has(t) for t in req.required)
    return f"CASE WHEN {anyone} THEN 'ok' ELSE {q('missing_required:' + ','.join(req.required))} END"


ROUTER_DIMENSIONS = ["blur", "count_error", "logo_symbol_error", "hand_malformation"]


@query("router_reasons", "FLT9 FLT10", f"""
WITH {SQL_TAGGED}, r AS ({' UNION ALL '.join(
    f"SELECT {q(d)} AS dimension, {sql_router(d)} AS reason, " + (" OR ".join(
        sql_has(t) for t in tx.REQUIREMENTS[d].preferred)
        if d in tx.REQUIREMENTS and tx.REQUIREMENTS[d].preferred else "TRUE")
    + " AS preferred FROM tagged" for d in ROUTER_DIMENSIONS)})
SELECT dimension, reason, preferred, count(*) AS prompts FROM r GROUP BY ALL""")
def router_reasons(v):
    rows = F.array(*[F.struct(
        F.lit(d).alias("dimension"), compat.router_reason(d, "semantic_tags").alias("reason"),
        compat.has_preferred(d, "semantic_tags").alias("preferred")) for d in ROUTER_DIMENSIONS])
    return v.tagged().select(F.inline(rows)).groupBy("dimension", "reason", "preferred").agg(
        F.count(F.lit(1)).alias("prompts"))


@query("router_coverage", "AGG2", f"""
WITH {SQL_TAGGED}, c AS ({sql_counts(tx.REQUIREMENTS, lambda d: f"({sql_router(d)}) NOT LIKE 'missing%'")})
SELECT dimension, available, total, round_even(available / total * 100, 2) AS coverage FROM c""")
def router_coverage(v):
    return compat.router_coverage(v.tagged())


def sql_runtime(d) -> str:
    tags = tx.RUNTIME_REQUIRED_TAGS.get(d, [])
    cases = []
    if tags:
        cases.append(f"WHEN NOT ({' OR '.join(sql_has(t) for t in tags)}) THEN "
                     + q("missing_required_tags:" + ",".join(tags)))
    if d == "animal_anatomy_error":
        cases.append(f"WHEN NOT {sql_word('low', lx.WORDS_ANIMAL_SUBJECT)} THEN "
                     "'missing_explicit_animal_subject'")
    return f"CASE {' '.join(cases)} ELSE 'ok' END" if cases else "'ok'"


RUNTIME_DIMENSIONS = [*tx.RUNTIME_REQUIRED_TAGS, "blur"]


@query("runtime_filter_reasons", "FLT11", f"""
WITH {SQL_TAGGED}, r AS ({' UNION ALL '.join(
    f"SELECT {q(d)} AS dimension, {sql_runtime(d)} AS reason FROM tagged"
    for d in RUNTIME_DIMENSIONS)})
SELECT dimension, reason, count(*) AS prompts FROM r GROUP BY 1, 2""")
def runtime_filter_reasons(v):
    rows = F.array(*[F.struct(F.lit(d).alias("dimension"), compat.runtime_reason(
        d, "_lower", "semantic_tags").alias("reason")) for d in RUNTIME_DIMENSIONS])
    return compat.with_lower(v.tagged()).select(F.inline(rows)).groupBy(
        "dimension", "reason").agg(F.count(F.lit(1)).alias("prompts"))


BY_PERSPECTIVE = {
    "anatomy": {"hand": Requirement(("has_hand", "has_person"), ("has_full_body",)),
                "face": Requirement(("has_face",)), "pose": None},
    "scene": {"layout": Requirement(None, (), ("has_indoor_scene",)),
              "text": Requirement(("has_text",), ("has_logo_or_symbol",))},
}


def _perspective_rows():
    for p, dims in BY_PERSPECTIVE.items():
        for d, req in dims.items():
            kind = "none" if req is None else "required" if req.required else "preferred_only"
            test = sql_tags_ok(req, "any") if kind == "required" else "TRUE"
            share = ("round_even(count(*) FILTER (WHERE " + test + ") / count(*) * 100, 2)"
                     if kind == "required" else "100.0::DOUBLE")
            yield (f"SELECT {q(p)} AS perspective, {q(d)} AS dimension, count(*) FILTER (WHERE "
                   f"{test}) AS available, {q(kind)} AS requirement, {share} AS percentage "
                   f"FROM tagged")


@query("perspective_coverage", "AGG3",
       f"WITH {SQL_TAGGED} {' UNION ALL '.join(_perspective_rows())}")
def perspective_coverage(v):
    return compat.perspective_coverage(v.tagged(), BY_PERSPECTIVE)


@query("macro_dimension_matrix", "AGG6", f"""
WITH {SQL_MACRO}, hits AS ({' UNION ALL '.join(
    f"SELECT {q(d)} AS dimension, macro_taxonomy, {sql_compatible(d)} AS ok FROM macro"
    for d in tx.DIMENSIONS)})
SELECT dimension, count(*) FILTER (WHERE ok) AS total_available, {', '.join(
    f"count(*) FILTER (WHERE ok AND macro_taxonomy = {q(c)}) AS {c}"
    for c in lx.MACRO_CATEGORIES)} FROM hits GROUP BY 1""")
def macro_dimension_matrix(v):
    return compat.macro_dimension_matrix(v.macro_tagged())


@query("dimension_subpools", "PL1 JN6", f"""
WITH {sql_subpools()} SELECT dimension, record_id, source FROM subpools""")
def dimension_subpools(v):
    return v.subpools().select("dimension", "record_id", "source")


@query("subpool_index", "PL1 SNK2", f"""
WITH {SQL_TAGGED}, c AS ({sql_counts(tx.REQUIREMENTS, sql_compatible)})
SELECT dimension, available AS count FROM c""")
def subpool_index(v):
    return compat.subpool_index(v.tagged())


INDEX_SQL = f"""{SQL_PAIRS}, idx AS (SELECT model_id, dimension, count(*) AS count FROM pairs
  WHERE success GROUP BY 1, 2),
dims AS (SELECT unnest({sql_list(tx.DIMENSIONS)}) AS dimension),
models AS (SELECT unnest({sql_list(MODELS)}) AS model_id)"""


@query("pool_coverage_by_model", "AGG7", f"""
WITH {INDEX_SQL} SELECT m.model_id, d.dimension, i.count AS pool_count,
  CASE WHEN i.count IS NULL THEN 'missing' WHEN i.count < 60 THEN 'low_pool' ELSE 'ok' END
    AS warning
FROM models m CROSS JOIN dims d LEFT JOIN idx i
  ON i.model_id = m.model_id AND i.dimension = d.dimension""")
def pool_coverage_by_model(v):
    return compat.pool_coverage(v.model_index(), v.model_table(),
                                v.dimension_table().select("dimension"), low_pool_threshold=60)


TEMPLATES = ["Blur and out of focus", "bright overexposed dark", "hand finger crystal", "tint"]


def _guardrail_case():
    cases = []
    for d, (keep, avoid) in tx.GUARDRAILS.items():
        ok = " AND ".join([f"contains(low, {q(k)})" for k in keep]
                          + [f"NOT contains(low, {q(a)})" for a in avoid])
        cases.append(f"WHEN dimension = {q(d)} THEN {ok}")
    return "CASE " + " ".join(cases) + " ELSE TRUE END"


@query("template_guardrails", "FLT22", f"""
WITH {SQL_PAIRS}, t AS (SELECT *, lower({sql_pick(TEMPLATES, 'ord')}) AS low FROM pairs)
SELECT dimension, {_guardrail_case()} AS allowed, count(*) AS templates FROM t GROUP BY 1, 2""")
def template_guardrails(v):
    from promptmill.plans.views import pick
    return v.pairs().groupBy("dimension", compat.guardrail_ok(
        "dimension", pick(TEMPLATES, F.col("ord"))).alias("allowed")).agg(
        F.count(F.lit(1)).alias("templates"))


@query("compatible_models", "FLT23", f"""
WITH {SQL_PAIRS}, w AS (SELECT *, CASE WHEN seed % 2 = 0 THEN 'sdxl' ELSE model_id END AS m
  FROM pairs)
SELECT m AS model_id, dimension, count(*) AS pairs FROM w WHERE NOT (m = 'sdxl' AND dimension IN
  ({', '.join(q(d) for _, d in tx.INCOMPATIBLE_MODELS)})) GROUP BY 1, 2""")
def compatible_models(v):
    work = v.pairs().withColumn("model_id", F.when(F.col("seed") % 2 == 0, F.lit("sdxl"))
                                .otherwise(F.col("model_id")))
    return pools.without_incompatible_models(work).groupBy("model_id", "dimension").agg(
        F.count(F.lit(1)).alias("pairs"))


SELECTED = ["semantic_text", "technical_quality", "blur", "count_error", "unknown"]
SELECTED_DIMS = ["text_error", "logo_symbol_error",
                 *[d for d, _ in tx.TAXONOMY["technical_quality"]], "count_error"]


@query("selected_dimension_pairs", "FLT25", f"""
WITH {SQL_PAIRS}, s AS (SELECT unnest({sql_list(SELECTED_DIMS)}) AS dimension,
  unnest(range({len(SELECTED_DIMS)})) AS ord)
SELECT CAST(s.ord AS INT) AS ord, s.dimension, count(p.pair_id) AS pairs FROM s LEFT JOIN pairs p
  ON p.dimension = s.dimension GROUP BY 1, 2""")
def selected_dimension_pairs(v):
    chosen = compat.select_dimensions(v.spark, SELECTED).select("ord", "dimension")
    counts = v.pairs().groupBy("dimension").agg(F.count(F.lit(1)).alias("n"))
    return chosen.join(counts, "dimension", "left").select(
        "ord", "dimension", F.coalesce("n", F.lit(0)).alias("pairs"))
