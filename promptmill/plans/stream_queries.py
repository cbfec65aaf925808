"""Streaming queries: run over everything available, then read what they wrote."""

from pyspark.sql import functions as F

from promptmill.plans.clean_queries import STATUS_SQL
from promptmill.plans.registry import query
from promptmill.plans.run_queries import ACTIONS_SQL
from promptmill.plans.views import SQL_PAIRS, Views, attempts_of
from promptmill.session import work_folder
from promptmill.streaming import incremental


class StreamViews(Views):
    """The same views over a streaming read of the tables, each one file or a folder of files."""

    def table(self, name):
        schema = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").schema
        # a pattern, as a stream takes a plain path for a folder only
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(
            f"{self.sf_dir}/{{{name}}}.parquet")


def streaming(v) -> StreamViews:
    return StreamViews(v.spark, v.sf_dir)


@query("streamed_new_prompts", "DUP3 SNK3 ST3", f"""
WITH {STATUS_SQL} SELECT record_id, source, md5(norm) AS prompt_md5 FROM firsts""")
def streamed_new_prompts(v):
    pool, checkpoint = work_folder(v.spark, "pool"), work_folder(v.spark, "pool-checkpoint")
    incremental.append_new_prompts(streaming(v).prompts(), pool, checkpoint).awaitTermination()
    return incremental.existing_pool(v.spark, pool).select(
        "record_id", "source", F.md5("prompt").alias("prompt_md5"))


@query("streamed_run_report", "AGG15 ST3", f"""
WITH {SQL_PAIRS}, g AS (SELECT date_trunc('day', ts) AS window_start, model_id,
  count(*) AS total_pairs, count(*) FILTER (WHERE success) AS valid_pairs, count(*) FILTER
  (WHERE NOT success) AS invalid_pairs, CAST(sum(total_attempts) AS BIGINT) AS total_attempts
  FROM pairs GROUP BY 1, 2)
SELECT CAST(window_start AS VARCHAR) AS window_start, model_id, total_pairs, valid_pairs,
  invalid_pairs, total_attempts, round_even(valid_pairs / total_pairs, 4) AS validation_rate
FROM g""")
def streamed_run_report(v):
    table = incremental.complete_report(
        streaming(v).pairs(), work_folder(v.spark, "run-report"),
        work_folder(v.spark, "run-report-checkpoint"))
    return table.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("streamed_next_actions", "ST2", f"""
WITH {ACTIONS_SQL} SELECT pair_id, attempt, status, failure, CASE WHEN status = 'success' THEN 'done'
  WHEN status = 'skipped' THEN 'stop_skipped'
  WHEN failure = 'positive_content_mismatch' THEN 'stop_content_mismatch'
  WHEN failure = 'positive_incompatible' AND incompatible_before > 0 THEN 'stop_still_incompatible'
  WHEN attempt >= 6 THEN 'stop_exhausted'
  WHEN failure = 'positive_incompatible' THEN 'anchor_positive'
  WHEN failure = 'style_drift' AND style_type IS NOT NULL AND drift_before = 0
    THEN 'anchor_negative' ELSE 'rewrite' END AS next_action FROM w""")
def streamed_next_actions(v):
    attempts = attempts_of(streaming(v).table("conversations"))
    return incremental.newest_actions(incremental.run_to_table(
        incremental.stream_corrected_actions(attempts, 6), "next-actions"))
