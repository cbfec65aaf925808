"""Queries over shard merges, the prompt registry and fed-back success rates."""

from pyspark.sql import functions as F

from promptmill.operators import compat, feedback, prompt_registry, shards, tagging
from promptmill.params import taxonomy as tx
from promptmill.plans.compat_queries import sql_counts
from promptmill.plans.registry import query
from promptmill.plans.views import (LEXICON, SQL_PAIRS, SQL_TAGGED, q, sql_compatible, sql_has,
                                    sql_special, sql_tags_ok)
from promptmill.session import work_folder, written

# ---- shards: every customer's orders are one, the seeds of customers begin 12 apart --------------

SEEDS_APART = 12
SHARDS_SQL = f"""shards AS (SELECT c_custkey AS shard, c_custkey * {SEEDS_APART} AS base_seed
  FROM customer),
items AS (SELECT o_custkey AS shard, o_orderkey AS local_id FROM orders),
placed AS (SELECT i.shard, i.local_id, s.base_seed, row_number() OVER (ORDER BY i.shard, i.local_id)
  AS merged_id, row_number() OVER (PARTITION BY i.shard ORDER BY i.local_id) AS place
  FROM items i JOIN shards s ON s.shard = i.shard),
counted AS (SELECT s.shard, s.base_seed, count(p.local_id) AS n, min(p.merged_id) AS first_id,
  coalesce(max(p.local_id) - min(p.local_id) + 1 - count(p.local_id), 0) AS gaps
  FROM shards s LEFT JOIN placed p ON p.shard = s.shard GROUP BY 1, 2),
crossing AS (SELECT a.shard AS a, b.shard AS b, least(a.base_seed + a.n, b.base_seed + b.n)
  - greatest(a.base_seed, b.base_seed) AS shared FROM counted a JOIN counted b
  ON a.shard < b.shard AND a.n > 0 AND b.n > 0 AND a.base_seed < b.base_seed + b.n
  AND b.base_seed < a.base_seed + a.n)"""


def shard_tables(v):
    listed = v.table("customer").select(
        F.col("c_custkey").alias("shard"),
        (F.col("c_custkey") * SEEDS_APART).alias("base_seed"))
    rows = v.table("orders").select(F.col("o_custkey").alias("shard"),
                                    F.col("o_orderkey").alias("local_id"))
    return rows, listed


@query("merged_shards", "SET7", f"""
WITH {SHARDS_SQL} SELECT shard, local_id, merged_id, base_seed + place - 1 AS seed FROM placed""")
def merged_shards(v):
    return shards.merged_shards(*shard_tables(v)).select("shard", "local_id", "merged_id", "seed")


@query("shard_merge_report", "SET7", f"""
WITH {SHARDS_SQL}, hits AS (SELECT shard, count(*) AS n FROM (SELECT a AS shard FROM crossing
  UNION ALL SELECT b FROM crossing) GROUP BY 1)
SELECT c.shard, c.n AS rows, c.first_id AS first_merged_id, c.gaps, coalesce(h.n, 0) AS collisions
FROM counted c LEFT JOIN hits h ON h.shard = c.shard""")
def shard_merge_report(v):
    return shards.shard_report(*shard_tables(v))


@query("shard_seed_overlaps", "SET7", f"""
WITH {SHARDS_SQL} SELECT a, b, shared FROM crossing""")
def shard_seed_overlaps(v):
    rows, listed = shard_tables(v)
    used = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    ranges = listed.join(used, "shard").select(
        "shard", F.col("base_seed").alias("first"),
        (F.col("base_seed") + F.col("n") - 1).alias("last"))
    return shards.range_overlaps(ranges)


# ---- prompt registry -----------------------------------------------------------------------------

REGISTRY_DIMS = sorted(tx.REQUIREMENTS)


def _sql_preferred(d) -> str:
    tags = " OR ".join(sql_has(t) for t in tx.REQUIREMENTS[d].preferred)
    return f"CASE WHEN {sql_compatible(d)} AND ({tags}) THEN {q(d)} END"


def _sql_excluded(d) -> str:
    return (f"CASE WHEN NOT {sql_tags_ok(tx.REQUIREMENTS[d])} THEN {q(d + ':tags')} "
            f"WHEN {sql_special(d)} IS NOT NULL THEN {q(d + ':')} || {sql_special(d)} END")


def _sql_joined(entries) -> str:
    return (f"array_to_string(list_filter([{', '.join(entries)}], lambda d: d IS NOT NULL), ',')")


SQL_REGISTRY = f"""registry AS (SELECT record_id, source,
  {_sql_joined([f"CASE WHEN {sql_compatible(d)} THEN {q(d)} END" for d in REGISTRY_DIMS])}
    AS compatible,
  {_sql_joined([_sql_preferred(d) for d in REGISTRY_DIMS if tx.REQUIREMENTS[d].preferred])}
    AS preferred,
  {_sql_joined([_sql_excluded(d) for d in REGISTRY_DIMS])} AS excluded FROM tagged)"""


def registry_after_deltas(v):
    """Three deltas: everything under an older lexicon and the benchmark items, the labelled
    prompts under the present one, then the others; the benchmark items go."""
    older = {tag: words[:1] for tag, words in LEXICON.items()}
    items = v.table("benchmark").select((-1 - F.col("item_id")).alias("record_id"),
                                        F.lit("benchmark").alias("source"),
                                        F.col("text").alias("prompt"))
    labelled = v.table("labels").select(F.col("doc_id").alias("record_id"))
    everything = v.prompts().select("record_id", "source", "prompt")
    registry = prompt_registry.open_registry(v.spark, work_folder(v.spark, "prompt-registry"))
    prompt_registry.apply_delta(registry, tagging.tag_candidates(
        everything.unionByName(items), older))
    # Both deltas take their rows from one run of the rules; no prompt text passes the joins.
    rows = written(prompt_registry.registry_rows(v.tagged()), "registry-rows")
    registry.change(rows.join(labelled, "record_id", "left_semi"))
    registry.change(rows.join(labelled, "record_id", "left_anti"), items)
    return registry.read()


@query("prompt_registry", "PL10", f"""
WITH {SQL_TAGGED}, {SQL_REGISTRY} SELECT * FROM registry""")
def registry_of_prompts(v):
    reasons = F.transform(F.array_sort(F.map_entries("excluded")), lambda e: F.concat_ws(
        ":", e["key"], e["value"]))
    return registry_after_deltas(v).select(
        "record_id", "source", F.array_join("compatible", ",").alias("compatible"),
        F.array_join("preferred", ",").alias("preferred"),
        F.array_join(reasons, ",").alias("excluded"))


@query("registry_exclusions", "PL10", f"""
WITH {SQL_TAGGED}, {SQL_REGISTRY}, r AS (SELECT unnest(string_split(excluded, ',')) AS e
  FROM registry WHERE excluded <> '')
SELECT string_split(e, ':')[1] AS dimension, string_split(e, ':')[2] AS reason, count(*) AS prompts
FROM r GROUP BY 1, 2""")
def registry_exclusions(v):
    return registry_after_deltas(v).select(F.explode("excluded").alias("dimension", "reason")) \
        .groupBy("dimension", "reason").agg(F.count(F.lit(1)).alias("prompts"))


# ---- success rates fed back ------------------------------------------------------------------------

MISMATCH = ("content_drift",)
RATES_SQL = f"""{SQL_PAIRS}, rates AS (SELECT positive_prompt, dimension, model_id,
  count(*) AS pairs, count(*) FILTER (WHERE success) AS valid_pairs,
  count(*) FILTER (WHERE NOT success AND failure = 'content_drift') AS mismatches,
  round_even(count(*) FILTER (WHERE success) / count(*), 4) AS success_rate
  FROM pairs GROUP BY 1, 2, 3)"""


def counts_after_arrivals(v):
    """The log of every run arrives while it is still under way, then whole: the runs of one half
    of the days first, and some of them once more with the others."""
    pairs = v.pairs()
    day = F.substring("run_dir", -2, 2).cast("int")
    counts = feedback.open_counts(v.spark, work_folder(v.spark, "run-counts"))
    feedback.arrive(counts, pairs.where("total_attempts < 3"), MISMATCH)
    feedback.arrive(counts, pairs.where(day % 2 == 0), MISMATCH)
    feedback.arrive(counts, pairs.where((day % 2 == 1) | (day % 4 == 0)), MISMATCH)
    return counts.read()


@query("fed_back_success_rates", "AGG24", f"WITH {RATES_SQL} SELECT * FROM rates")
def fed_back_success_rates(v):
    return feedback.success_rates(counts_after_arrivals(v))


@query("fed_back_blacklist", "AGG24", f"""
WITH {RATES_SQL} SELECT positive_prompt, dimension, CAST(sum(mismatches) AS BIGINT) AS mismatches,
  count(*) AS models FROM rates GROUP BY 1, 2 HAVING sum(mismatches) >= 1""")
def fed_back_blacklist(v):
    return feedback.mismatch_blacklist(feedback.success_rates(counts_after_arrivals(v)), 1)


@query("pool_triggers", "AGG24", f"""
WITH {SQL_TAGGED}, {RATES_SQL}, c AS ({sql_counts(tx.DIMENSIONS, sql_compatible)}),
d AS (SELECT dimension, CAST(sum(pairs) AS BIGINT) AS pairs, CAST(sum(valid_pairs) AS BIGINT)
  AS valid_pairs FROM rates GROUP BY 1),
b AS (SELECT dimension, count(*) AS n FROM (SELECT positive_prompt, dimension FROM rates
  GROUP BY 1, 2 HAVING sum(mismatches) >= 1) GROUP BY 1),
j AS (SELECT c.dimension, available, coalesce(pairs, 0) AS pairs, coalesce(valid_pairs, 0)
  AS valid_pairs, coalesce(b.n, 0) AS blacklisted, round_even(valid_pairs / pairs, 4)
  AS success_rate FROM c LEFT JOIN d ON d.dimension = c.dimension
  LEFT JOIN b ON b.dimension = c.dimension),
t AS (SELECT *, available < total_n * 0.5 AS few, coalesce(success_rate < 0.52, FALSE) AS poor
  FROM j, (SELECT count(*) AS total_n FROM tagged))
SELECT dimension, available, pairs, valid_pairs, blacklisted, success_rate,
  CASE WHEN few AND poor THEN 'backfill' WHEN few OR poor THEN 'watch' ELSE 'none' END AS trigger,
  CASE WHEN few AND poor THEN CAST(ceil(total_n * 0.5) AS BIGINT) - available ELSE 0 END
  AS requested FROM t""")
def pool_triggers(v):
    """A pool is low with under half of the prompts."""
    coverage = compat.coverage_report(v.tagged())
    low = v.prompts().agg(F.ceil(F.count(F.lit(1)) * F.lit(0.5)).cast("long")).first()[0]
    return feedback.pool_triggers(feedback.success_rates(counts_after_arrivals(v)), coverage,
                                  threshold=1, low_pool=low, low_rate=0.52)
