"""Queries over sources and sinks; files are written below the shared work folder and read back."""

from pyspark.sql import functions as F

from promptmill.operators import screening
from promptmill.plans.registry import query
from promptmill.plans.views import (SQL_PAIRS, SQL_PROMPTS, SQL_RESULTS, SQL_TAGGED, pick,
                                    sql_pick, sql_strip, sql_subpools)
from promptmill.session import work_folder
from promptmill.sources import readers, writers


def raw_items(v):
    """Documents as prompt items in every accepted shape."""
    r = F.col("record_id")
    model = pick(["sdxl-base", "flux", ""], r)
    tagged = v.tagged()
    tags = F.col("semantic_tags")
    as_prompt = F.to_json(F.struct("prompt", F.col("semantic_tags"), model.alias("model")))
    as_text = F.to_json(F.struct(F.col("prompt").alias("text"), tags.alias("tags"),
                                 model.alias("model")))
    blank = F.to_json(F.struct(F.lit("  ").alias("prompt")))
    quoted = F.substring(F.to_json(F.array("prompt")), 2, 2_000_000_000)
    quoted = F.substr(quoted, F.lit(1), F.length(quoted) - 1)
    item = (F.when(r % 5 == 0, as_prompt).when(r % 5 == 1, as_text).when(r % 5 == 2, quoted)
            .when(r % 5 == 3, F.col("prompt")).otherwise(
        F.when(r % 2 == 0, blank).otherwise(as_prompt)))
    return tagged.select("record_id", item.alias("item"))


NORMAL_SQL = f"""{SQL_TAGGED}, n AS (SELECT record_id, record_id % 5 AS k, {sql_strip('prompt')}
    AS p, tags, {sql_pick(['sdxl-base', 'flux', ''], 'record_id')} AS m FROM tagged),
normal AS (SELECT record_id, CASE WHEN k = 4 AND record_id % 2 = 0 THEN '' ELSE p END AS prompt,
  CASE WHEN k IN (0, 1) OR (k = 4 AND record_id % 2 = 1) THEN array_to_string(tags, ',') ELSE '' END
    AS tags, CASE WHEN k IN (0, 1) OR (k = 4 AND record_id % 2 = 1) THEN m ELSE '' END AS model
  FROM n), reasoned AS (SELECT *, CASE WHEN model <> '' AND NOT contains(model, 'sdxl') THEN 'model'
  WHEN prompt = '' THEN 'invalid' END AS drop_reason FROM normal)"""


@query("normalized_records", "SRC2 SRC3 FN9", f"""
WITH {NORMAL_SQL} SELECT record_id, md5(prompt) AS prompt_md5, tags, model, drop_reason
FROM reasoned""")
def normalized_records(v):
    return readers.normalize_items(raw_items(v), "sdxl").select(
        "record_id", F.md5("prompt").alias("prompt_md5"),
        F.array_join("semantic_tags", ",").alias("tags"), "model", "drop_reason")


@query("record_drop_counts", "SRC3", f"""
WITH {NORMAL_SQL} SELECT count(*) FILTER (WHERE drop_reason IS NULL) AS kept,
  count(*) FILTER (WHERE drop_reason = 'model') AS dropped_by_model_filter,
  count(*) FILTER (WHERE drop_reason = 'invalid') AS dropped_invalid FROM reasoned""")
def record_drop_counts(v):
    return readers.drop_counts(readers.normalize_items(raw_items(v), "sdxl"))


@query("prompt_texts", "SRC4", f"""
WITH {SQL_PROMPTS} SELECT record_id, md5(CASE WHEN record_id % 10 = 4 THEN '  ' ELSE prompt END)
  AS prompt_md5 FROM prompts WHERE prompt <> ''""")
def prompt_texts(v):
    return readers.prompt_texts(raw_items(v)).where("prompt <> ''").select(
        "record_id", F.md5("prompt").alias("prompt_md5"))


@query("tagged_map", "SRC5", f"""
WITH {SQL_TAGGED}, s AS (SELECT record_id, tags, {sql_strip('prompt')} AS p FROM tagged)
SELECT md5(p) AS prompt_md5, array_to_string(tags, ',') AS tags FROM s WHERE p <> ''
QUALIFY row_number() OVER (PARTITION BY p ORDER BY record_id DESC) = 1""")
def tagged_map(v):
    return readers.tagged_map(v.tagged()).select(
        F.md5("prompt").alias("prompt_md5"), F.array_join("semantic_tags", ",").alias("tags"))


@query("tag_requirement_rows", "SRC6", """
WITH g AS (SELECT lang, source, min(doc_id) AS lo, max(doc_id) AS hi, count(*) AS n FROM documents
  GROUP BY 1, 2)
SELECT CASE WHEN lang = 'de' THEN 'deutsch' ELSE lang END AS category, source AS dimension,
  CASE WHEN n % 3 = 0 THEN NULL ELSE 'has_' || lo || ',has_' || n END AS required,
  CASE WHEN n % 3 = 0 THEN NULL ELSE 'has_' || hi END AS alternative
FROM g WHERE lang <> 'es'""")
def tag_requirement_rows(v):
    """Requirement documents rendered from the observed languages and sources."""
    counts = v.table("documents").groupBy("lang", "source").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))

    def tag(name):
        return F.concat(F.lit("has_"), F.col(name).cast("string"))

    body = F.when(F.col("n") % 3 != 0, F.to_json(F.struct(
        F.array(tag("lo"), tag("n")).alias("required"), F.array(tag("hi")).alias("alternative"))))
    category = F.when(F.col("lang") == "es", F.lit("_note")).when(
        F.col("lang") == "de", F.lit("deutsch")).otherwise(F.col("lang"))
    document = F.concat(F.lit('{"'), category, F.lit('": {"'), "source", F.lit('": '),
                        F.coalesce(body, F.lit("null")), F.lit("}}"))
    rows = counts.select(F.inline(readers.tag_requirements(document)))
    return rows.select("category", "dimension", F.array_join("required", ",").alias("required"),
                       F.array_join("alternative", ",").alias("alternative"))


@query("jsonl_round_trip", "SRC1 SNK1", f"""
WITH {SQL_TAGGED} SELECT record_id, source, md5(prompt) AS prompt_md5, array_to_string(tags, ',')
  AS tags FROM tagged""")
def jsonl_round_trip(v):
    path = work_folder(v.spark, "tagged-jsonl")
    writers.write_jsonl(v.tagged(), path)
    return readers.read_jsonl(v.spark, path, readers.PROMPT_SCHEMA).select(
        "record_id", "source", F.md5("prompt").alias("prompt_md5"),
        F.array_join("semantic_tags", ",").alias("tags"))


@query("collected_generated_files", "SRC7 SNK3", f"""
WITH {SQL_PROMPTS} SELECT source, count(*) AS prompts FROM prompts GROUP BY 1""")
def collected_generated_files(v):
    root = work_folder(v.spark, "generated")
    rows = v.prompts().select("record_id", "source", "prompt")
    files = []
    for part in range(4):  # every row falls into one part, whatever its other columns hold
        files.append(f"{root}/{part}/generated_positive_prompts.jsonl")
        writers.append_jsonl(rows.where(F.pmod(F.xxhash64("record_id"), F.lit(4)) == part),
                             files[-1])
    found = readers.collect_generated(v.spark, [*files, files[0]],
                                      "record_id long, source string, prompt string")
    return found.groupBy("source").agg(F.count(F.lit(1)).alias("prompts"))


@query("sharded_result_stats", "SRC9 AGG20", f"""
WITH {SQL_RESULTS} SELECT count(*) AS total_results, count(*) FILTER (WHERE label = 'pass')
  AS pass_count, count(*) FILTER (WHERE label <> 'pass') AS fail_count FROM results""")
def sharded_result_stats(v):
    root = work_folder(v.spark, "family-run")
    for shard in range(2):
        part = v.results().where(F.col("record_id") % 2 == shard)
        writers.append_jsonl(part, f"{root}/shard_{shard}/family_screening_results.jsonl")
    rows = readers.read_result_shards(
        v.spark, root, "record_id long, family_name string, prompt string, label string")
    return screening.pass_stats(rows)


@query("written_subpools", "SRC10 SNK2", f"""
WITH {sql_subpools()} SELECT dimension, count(*) AS count, 'dimension=' || dimension AS filename
FROM subpools GROUP BY 1""")
def written_subpools(v):
    return writers.write_subpools(v.subpools(), work_folder(v.spark, "subpools"))


@query("one_written_subpool", "SRC10", f"""
WITH {sql_subpools(['hand_malformation'])} SELECT record_id, source FROM subpools""")
def one_written_subpool(v):
    root = work_folder(v.spark, "subpools")
    writers.write_subpools(v.subpools(), root)
    return readers.read_subpool(v.spark, f"{root}/dimension_subpools", "hand_malformation").select(
        "record_id", "source")


@query("written_run", "SNK4", f"""
WITH {SQL_PAIRS} SELECT severity, count(*) AS pairs FROM pairs WHERE success GROUP BY 1""")
def written_run(v):
    root = work_folder(v.spark, "run")
    writers.write_run(v.pairs(), root)
    return v.spark.read.parquet(f"{root}/dataset").groupBy("severity").agg(
        F.count(F.lit(1)).alias("pairs"))


BREAKDOWN = "total_pairs long, valid long, invalid long, attempts long, first_try_success long"


def _sql_breakdown(part, name) -> str:
    return f"""SELECT {part} AS part, {name} AS name, count(*) AS total_pairs, count(*) FILTER
  (WHERE success) AS valid, count(*) FILTER (WHERE NOT success) AS invalid,
  CAST(sum(total_attempts) AS BIGINT) AS attempts, count(*) FILTER (WHERE success AND
  total_attempts = 1) AS first_try_success, round_even(count(*) FILTER (WHERE success) / count(*), 4)
  AS validation_rate FROM pairs"""


@query("written_run_breakdown", "SNK4 AGG15", f"""
WITH {SQL_PAIRS} {_sql_breakdown("'dimension'", "dimension")} GROUP BY dimension
UNION ALL {_sql_breakdown("'severity'", "severity")} GROUP BY severity
UNION ALL {_sql_breakdown("'all'", "NULL")}""")
def written_run_breakdown(v):
    root = work_folder(v.spark, "run")
    writers.write_run(v.pairs(), root)
    return v.spark.read.schema(f"part string, name string, {BREAKDOWN}, validation_rate double").json(
        f"{root}/validation_breakdown")


@query("written_run_failures", "SNK4 AGG15", f"""
WITH {SQL_PAIRS} SELECT failure, count(*) AS pairs FROM pairs WHERE coalesce(failure, '') <> ''
GROUP BY 1""")
def written_run_failures(v):
    root = work_folder(v.spark, "run")
    writers.write_run(v.pairs(), root)
    return v.spark.read.schema("failure string, pairs long").json(f"{root}/failure_types")
