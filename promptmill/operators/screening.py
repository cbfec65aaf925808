"""Screening tables: requests from samples, answers back onto samples, summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.functions import answers, keys, text
from promptmill.params import requests as rq
from promptmill.session import param_table


def number_batches(samples: DataFrame, batch_size=20, group="dimension") -> DataFrame:
    """Batch number of a ranked sample: ``batch_size`` consecutive ranks make one request."""
    return samples.withColumn("batch_no", F.floor(
        (F.col("rank") - 1) / batch_size).cast("int") + 1)


def screening_requests(samples: DataFrame, batch_size=20, policy="lenient") -> DataFrame:
    """One request text per dimension and batch; a batch never exceeds ``batch_size`` rows."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "sample_id", "prompt"))),
        lambda s: F.concat(F.lit('- sample_id="'), s["sample_id"], F.lit('" prompt="'),
                           s["prompt"], F.lit('"')))
    head = [F.concat(F.lit("Target dimension: "), F.col("dimension"))] + [
        F.lit(line) for line in rq.screening_lines(policy)]
    return (number_batches(samples, batch_size).groupBy("dimension", "batch_no")
            .agg(F.count(F.lit(1)).alias("batch_size"), lines.alias("_lines"))
            .select("dimension", "batch_no", "batch_size",
                    F.concat_ws("\n", *head, F.col("_lines")).alias("user_prompt")))


def family_requests(samples: DataFrame, family: str, goal: str, focus, dimensions,
                    batch_size=20) -> DataFrame:
    """Request texts of a shared family; same batching."""
    head = rq.family_lines(family, goal, focus, dimensions)
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "sample_id", "prompt"))),
        lambda s: F.concat(F.lit('- sample_id="'), s["sample_id"], F.lit('" prompt="'),
                           s["prompt"], F.lit('"')))
    return (number_batches(samples, batch_size).groupBy("batch_no")
            .agg(F.count(F.lit(1)).alias("batch_size"), lines.alias("_lines"))
            .select("batch_no", "batch_size",
                    F.concat_ws("\n", *[F.lit(h) for h in head],
                                F.col("_lines")).alias("user_prompt")))


def shared_family_requests(samples: DataFrame, dimensions: dict, batch_size=20) -> DataFrame:
    """Request texts of all shared families in one pass.

    ``samples``: ``family_name, rank`` (from 1 in each family), ``sample_id, prompt``;
    ``dimensions`` names the target dimensions of each family. Goals and focus cues are those of the
    screening spec; samples of other families are left out.
    """
    heads = param_table(samples.sparkSession, [
        (family, "\n".join(rq.family_lines(family, *rq.FAMILY_GOALS[family], dims)))
        for family, dims in dimensions.items()], "family_name string, _head string")
    numbered = samples.withColumn("batch_no", F.floor((F.col("rank") - 1) / batch_size).cast(
        "int") + 1)
    line = F.concat(F.lit('- sample_id="'), "sample_id", F.lit('" prompt="'), "prompt", F.lit('"'))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))),
                        lambda s: s["line"])
    return (numbered.join(heads, "family_name").groupBy("family_name", "batch_no")
            .agg(F.count(F.lit(1)).alias("batch_size"), F.first("_head").alias("_head"),
                 lines.alias("_lines"))
            .select("family_name", "batch_no", "batch_size",
                    F.concat_ws("\n", "_head", "_lines").alias("user_prompt")))


def parse_answers(raw: DataFrame, raw_col="raw_content") -> DataFrame:
    """One row per answered item: ``sample_id, label, confidence, reason`` as text."""
    items = answers.with_result_items(raw, raw_col, "_items")
    # The outer form keeps the optimizer from pushing a size test below the parsing steps, which
    # would parse every answer a second time.
    return (items.select(*raw.drop(raw_col).columns, F.explode_outer("_items").alias("_i"))
            .where(F.col("_i").isNotNull()).select(*raw.drop(raw_col).columns,
                    text.strip("_i.sample_id").alias("sample_id"),
                    F.col("_i.label").alias("label"), F.col("_i.confidence").alias("confidence"),
                    text.strip("_i.reason").alias("reason")))


def parse_family_answers(raw: DataFrame, raw_col="raw_content") -> DataFrame:
    """Family answers; a broken one gives the items that can be read on their own."""
    listed = answers.with_result_items(raw, raw_col, "_items", recover=True)
    kept = raw.drop(raw_col).columns
    rows = listed.select(*kept, F.explode_outer(F.coalesce("_items", "recovered")).alias("_i"))
    return rows.where(F.col("_i").isNotNull()).select(
        *kept, text.strip("_i.sample_id").alias("sample_id"),
        F.lower(text.strip(F.coalesce("_i.label", F.lit("fail")))).alias("label"),
        text.strip("_i.reason").alias("reason"))


def parse_prompt_answers(raw: DataFrame, expected, raw_col="raw_content") -> DataFrame:
    """One row per prompt of a generation answer, with its position from 0."""
    listed = answers.with_prompt_list(raw, raw_col, expected, "_prompts").drop(raw_col)
    kept = [c for c in listed.columns if c != "_prompts"]
    return listed.select(*kept, F.posexplode_outer("_prompts").alias("position", "prompt")).where(
        F.col("prompt").isNotNull())


def screened_rows(samples: DataFrame, answered: DataFrame, policy="lenient",
                  batch=("request_id",)) -> DataFrame:
    """Every sample with its label; ids missing from the answer become ``uncertain``.

    Answers for unknown ids are ignored, an id answered twice gives two rows.
    """
    found = answered.select(
        *batch, "sample_id", F.lit(True).alias("_found"),
        text.normalize_label(F.coalesce("label", F.lit("uncertain"))).alias("label"),
        text.confidence("confidence").alias("confidence"), "reason")
    joined = samples.join(found, [*batch, "sample_id"], "left")
    missing = F.col("_found").isNull()
    return (joined
            .withColumn("label", F.coalesce("label", F.lit("uncertain")))
            .withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
            .withColumn("reason", F.when(missing, F.lit("missing_in_model_output"))
                        .otherwise(F.col("reason")))
            .withColumn("keep_by_policy", text.keep_by_policy("label", policy))
            .drop("_found"))


def family_screened_rows(samples: DataFrame, answered: DataFrame, batch=("request_id",)):
    """Binary variant: everything but pass, missing ids included, is ``fail``."""
    found = answered.select(*batch, "sample_id", F.lit(True).alias("_found"),
                            text.normalize_label("label", binary=True).alias("label"), "reason")
    joined = samples.join(found, [*batch, "sample_id"], "left")
    return (joined
            .withColumn("reason", F.when(F.col("_found").isNull(),
                                         F.lit("missing_in_model_output"))
                        .otherwise(F.col("reason")))
            .withColumn("label", F.coalesce("label", F.lit("fail")))
            .withColumn("keep_by_policy", F.col("label") == "pass").drop("_found"))


def screening_summary(rows: DataFrame, by="dimension") -> DataFrame:
    """Label counts and rates per dimension."""
    counts = [F.count_if(F.col("label") == name).alias(f"{name}_count")
              for name in ("pass", "fail", "uncertain")]
    grouped = rows.groupBy(by).agg(
        *counts, F.count_if("keep_by_policy").alias("keep_count"),
        F.count(F.lit(1)).alias("total_count"))
    return grouped.select("*", *[
        text.rate(f"{name}_count", "total_count").alias(f"{name}_rate")
        for name in ("keep", "pass", "fail", "uncertain")])


def usage_totals(raw: DataFrame) -> DataFrame:
    """Request count and token sums of the raw answers; missing usage counts as zero."""
    return raw.agg(F.count(F.lit(1)).alias("request_count"), *[
        F.coalesce(F.sum(f"usage.{n}"), F.lit(0)).alias(n)
        for n in ("prompt_tokens", "completion_tokens", "total_tokens")])


def unfinished(samples: DataFrame, results: DataFrame) -> DataFrame:
    """Samples without a result row yet."""
    done = results.where(F.coalesce("sample_id", F.lit("")) != "").select("sample_id")
    return samples.join(done, "sample_id", "left_anti")


def reuse_cached(tasks: DataFrame, cache: DataFrame) -> DataFrame:
    """Tasks with the cached answer of the same (prompt, severity); the last cache row counts.

    ``cache``: ``ord, positive_prompt, severity, negative_prompt``. ``needs_call`` marks tasks
    without a usable cached answer.
    """
    usable = cache.where(F.col("negative_prompt").isNotNull()).groupBy(
        keys.digest("positive_prompt").alias("_digest"), "severity").agg(
        F.max_by("negative_prompt", "ord").alias("cached_negative"))
    joined = tasks.withColumn("_digest", keys.digest("positive_prompt")).join(
        usable, ["_digest", "severity"], "left").drop("_digest")
    return joined.withColumn(
        "needs_call", text.strip("cached_negative") == "")


def pass_stats(results: DataFrame, by=()) -> DataFrame:
    passed = F.lower(text.strip("label")) == "pass"
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_results"), F.count_if(passed).alias("pass_count"),
        F.count_if(~passed).alias("fail_count"))
