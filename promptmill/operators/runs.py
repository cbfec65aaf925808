"""Run-log analytics: pair tables, statistics, failure patterns, blacklists, decisions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions import keys, text


def _given(*columns) -> Column:
    """First text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))
                        for c in columns])


def pair_records(log: DataFrame, dataset_pairs: DataFrame, runs: DataFrame) -> DataFrame:
    """Pair log joined to the dataset pairs of its run, with fallbacks for missing fields.

    ``log``: ``run_dir, pair_id, dimension, expected_attribute, severity, positive_prompt,
    success`` and the structs ``final_validation`` and ``judge_result`` (``valid, failure``);
    ``dataset_pairs``: ``run_dir, pair_id, d_prompt, d_attribute, d_severity``; ``runs``:
    ``run_dir, model_id``. Unmatched log rows are kept; a verdict without any field is no verdict.
    """
    given = F.col("final_validation.valid").isNotNull() | F.col(
        "final_validation.failure").isNotNull()
    verdict = F.when(given, F.col("final_validation")).otherwise(F.col("judge_result"))
    joined = log.drop("model_id").join(dataset_pairs, ["run_dir", "pair_id"], "left").join(
        runs.select("run_dir", "model_id"), "run_dir", "left")
    return joined.select(
        "run_dir", "pair_id", F.coalesce(_given("model_id"), F.lit("unknown")).alias("model_id"),
        F.coalesce(_given("dimension", "expected_attribute", "d_attribute"),
                   F.lit("unknown")).alias("dimension"),
        _given("severity", "d_severity").alias("severity"),
        F.coalesce(_given("positive_prompt", "d_prompt"), F.lit("")).alias("positive_prompt"),
        F.coalesce(verdict["valid"], F.lit(False)).alias("valid"),
        F.nullif(verdict["failure"], F.lit("")).alias("failure"),
        F.coalesce("success", F.lit(False)).alias("success"))


def _success() -> Column:
    """A missing success is none."""
    return F.coalesce("success", F.lit(False))


def _attempts(pairs: DataFrame) -> Column:
    """Attempts of a pair: their stated number, else the length of their list, else none."""
    listed = [F.array_size("attempts")] if "attempts" in pairs.columns else []
    return F.coalesce("total_attempts", *listed, F.lit(0)).cast("long")


def _usable(pairs: DataFrame, models, dimensions) -> DataFrame:
    rows = pairs.where((F.coalesce("dimension", F.lit("")) != "")
                       & (F.coalesce("severity", F.lit("")) != ""))
    if models:
        rows = rows.where(F.col("model_id").isin(*models))
    return rows.where(F.col("dimension").isin(*dimensions)) if dimensions else rows


def run_statistics(pairs: DataFrame, models=None, dimensions=None) -> DataFrame:
    """Pairs, outcomes and attempts by model, dimension and severity."""
    grouped = _usable(pairs, models, dimensions).groupBy("model_id", "dimension", "severity").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(_success()).alias("valid_pairs"),
        F.count_if(~_success()).alias("invalid_pairs"),
        F.sum(_attempts(pairs)).alias("total_attempts"))
    return grouped.withColumn("avg_attempts", text.rate("total_attempts", "pairs", 2)).withColumn(
        "validation_rate", text.rate("valid_pairs", "pairs"))


def failure_histogram(pairs: DataFrame, models=None, dimensions=None) -> DataFrame:
    """Failure types of unsuccessful pairs; a missing failure counts as ``unknown``."""
    failed = _usable(pairs, models, dimensions).where(~_success())
    return failed.groupBy("model_id", "dimension", "severity", F.coalesce(
        F.nullif("failure", F.lit("")), F.lit("unknown")).alias("failure")).agg(
        F.count(F.lit(1)).alias("pairs"))


def generation_speed(runs: DataFrame, models=None) -> DataFrame:
    """Seconds per pair, per valid pair and per image by model: sums over runs, then ratios.

    ``runs``: ``model_id, created_at, completed_at`` (ISO text or timestamps), ``total_pairs,
    valid_pairs``. Runs with unusable times or without pairs are left out.
    """
    def moment(name):
        is_text = dict(runs.dtypes)[name] == "string"
        return text.iso_timestamp(name) if is_text else F.col(name)

    timed = runs.withColumn("_from", moment("created_at")).withColumn(
        "_to", moment("completed_at"))
    usable = timed.where((F.col("_to") > F.col("_from")) & (F.col("total_pairs") > 0))
    if models:
        usable = usable.where(F.col("model_id").isin(*models))
    elapsed = F.sum(text.elapsed_seconds("_from", "_to"))
    sums = usable.groupBy(F.coalesce("model_id", F.lit("unknown")).alias("model_id")).agg(
        elapsed.alias("_s"), F.sum("total_pairs").alias("_p"), F.sum("valid_pairs").alias("_v"),
        F.count(F.lit(1)).alias("run_count"))
    return sums.select(
        "model_id", F.bround(F.col("_s") / F.col("_p"), 2).alias("avg_pair_seconds"),
        F.bround(F.col("_s") / F.nullif("_v", F.lit(0)), 2).alias("avg_success_pair_seconds"),
        F.bround(F.col("_s") / (F.col("_p") * 2), 2).alias("avg_image_seconds"), "run_count")


def recent_runs(runs: DataFrame, limit: int = None) -> DataFrame:
    """Newest runs by completion time, else by file time."""
    ordered = runs.orderBy(F.coalesce(text.iso_timestamp("completed_at"),
                                      F.col("file_time")).desc(), "run_dir")
    return ordered if limit is None else ordered.limit(limit)


def failure_patterns(pairs: DataFrame) -> DataFrame:
    """Failures in total and by model and dimension: one pass with grouping sets."""
    failed = pairs.where(F.coalesce("failure", F.lit("")) != "")
    model, dim, failure = F.col("model_id"), F.col("dimension"), F.col("failure")
    return (failed.groupingSets([[failure], [model, dim, failure]], model, dim, failure)
            .agg(F.count(F.lit(1)).alias("pairs"))
            .select(F.coalesce("model_id", F.lit("*")).alias("model_id"),
                    F.coalesce("dimension", F.lit("*")).alias("dimension"), "failure", "pairs"))


def failure_types_by_prompt(pairs: DataFrame) -> DataFrame:
    """Failures by prompt, model, dimension and type: the histogram rows."""
    failed = pairs.where(F.coalesce("failure", F.lit("")) != "")
    return failed.groupBy("positive_prompt", "model_id", "dimension", "failure").agg(
        F.count(F.lit(1)).alias("pairs"))


def failures_by_prompt(pairs: DataFrame) -> DataFrame:
    """Failure count and histogram by prompt, model and dimension.

    The histogram is folded from per-type counts, so a prompt with very many failures never
    collects more entries than there are failure types.
    """
    return failure_types_by_prompt(pairs).groupBy("positive_prompt", "model_id", "dimension").agg(
        F.sum("pairs").alias("failure_count"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(
            ":", "failure", F.col("pairs").cast("string")))), ",").alias("failure_types"))


def ordered_failures(failures: DataFrame) -> DataFrame:
    return failures.orderBy(F.desc("failure_count"), "model_id", "dimension", "positive_prompt")


def blacklist(pairs: DataFrame, threshold=2) -> DataFrame:
    """Prompts that failed at least ``threshold`` times in one model and dimension."""
    return failures_by_prompt(pairs).where(F.col("failure_count") >= threshold).withColumn(
        "candidate_reason", F.lit("repeated_failures_for_same_prompt_model_dimension"))


def curation_decisions(pairs: DataFrame, threshold=2) -> DataFrame:
    """Decision and reason of every pair.

    The blacklist has one row per key while a key may cover a large part of the pairs, so its rows
    are copied over a few salts.
    """
    key = ["_digest", "model_id", "dimension"]
    failed = F.coalesce("failure", F.lit("")) != ""
    keyed = pairs.withColumn("_digest", keys.digest("positive_prompt"))
    listed = (keyed.where(failed).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") >= threshold).select(*key, F.lit(True).alias("_listed")))
    joined = keyed.join(listed, key, "left")
    decision = (F.when(F.col("_listed"), F.lit("blacklist_candidate"))
                .when(F.col("valid"), F.lit("keep")).otherwise(F.lit("review")))
    reason = (F.when(F.col("_listed"),
                     F.lit("prompt_repeatedly_failed_in_same_model_dimension"))
              .when(F.col("valid"), F.lit("pair_valid"))
              .otherwise(F.coalesce(_given("failure"), F.lit("pair_invalid"))))
    return joined.select("pair_id", "model_id", "dimension", decision.alias("decision"),
                         reason.alias("reason"), "positive_prompt")


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(F.count(F.lit(1)).alias("pairs"))


def memory_stats(pairs: DataFrame, threshold=2) -> DataFrame:
    """Runs, pairs, invalid pairs, blacklist size and decision counts from per-key counts.

    Everything follows from one aggregation by (prompt, model, dimension): a key on the blacklist
    turns all of its pairs into blacklist candidates.
    """
    failed = F.coalesce("failure", F.lit("")) != ""
    per_key = (pairs.groupBy(keys.digest("positive_prompt").alias("_d"), "model_id", "dimension")
               .agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("v"),
                    F.count_if(failed).alias("f")))
    listed = F.col("f") >= threshold
    totals = per_key.agg(
        F.sum("n").alias("pairs"), F.sum(F.col("n") - F.col("v")).alias("invalid_pairs"),
        F.count_if(listed).alias("blacklist_candidates"),
        F.sum(F.when(listed, F.col("n")).otherwise(0)).alias("decided_blacklist"),
        F.sum(F.when(~listed, F.col("v")).otherwise(0)).alias("decided_keep"),
        F.sum(F.when(~listed, F.col("n") - F.col("v")).otherwise(0)).alias("decided_review"))
    runs = pairs.select("run_dir").distinct().agg(F.count(F.lit(1)).alias("runs"))
    return runs.crossJoin(totals)


def validation_summary(pairs: DataFrame) -> DataFrame:
    """Totals, rates and the first-try / retry / failed split."""
    ok, tries = _success(), _attempts(pairs)
    totals = pairs.agg(
        F.count(F.lit(1)).alias("total_pairs"), F.count_if(ok).alias("valid_pairs"),
        F.count_if(~ok).alias("invalid_pairs"),
        F.coalesce(F.sum(tries), F.lit(0)).alias("total_attempts"),
        F.count_if(ok & (tries == 1)).alias("first_try_success"),
        F.count_if(ok & (tries != 1)).alias("retry_success"),
        # Pairs that never got to an attempt are invalid but exhausted no retries.
        F.count_if(~ok & (tries > 0)).alias("all_retries_failed"))
    return totals.withColumn("validation_rate", text.rate("valid_pairs", "total_pairs")).withColumn(
        "avg_attempts_per_pair", text.rate("total_attempts", "total_pairs", 2))


def validation_by_dimension(pairs: DataFrame) -> DataFrame:
    """Outcomes and attempts per dimension; pairs without any attempt are left out."""
    ok, tries = _success(), _attempts(pairs)
    return pairs.where(tries > 0).groupBy("dimension").agg(
        F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"),
        F.sum(tries).alias("attempts"))


def validation_breakdown(pairs: DataFrame) -> DataFrame:
    """The report by dimension, by degradation level and in all, in one pass: ``part`` names the
    split and ``name`` its value; pairs without any attempt are left out of the splits."""
    ok, tries = _success(), _attempts(pairs)
    tried = pairs.where(tries > 0)
    dimension, severity = F.col("dimension"), F.col("severity")
    sums = tried.groupingSets([[dimension], [severity], []], dimension, severity).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("total_pairs"),
        F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"),
        F.coalesce(F.sum(tries), F.lit(0)).alias("attempts"),
        F.count_if(ok & (tries == 1)).alias("first_try_success"))
    part = F.when(F.col("_set") == 1, "dimension").when(F.col("_set") == 2, "severity")
    return sums.select(
        F.coalesce(part, F.lit("all")).alias("part"),
        F.when(F.col("_set") == 1, F.col("dimension")).when(
            F.col("_set") == 2, F.col("severity")).alias("name"),
        "total_pairs", "valid", "invalid", "attempts", "first_try_success",
        text.rate("valid", "total_pairs").alias("validation_rate"))


def validation_failure_types(attempts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Failure types per failed attempt, plus one ``error`` for every pair without attempts."""
    failed = attempts.where(F.col("status") == "failed").select(
        F.coalesce("failure", F.lit("unknown")).alias("failure"))
    lost = pairs.where(_attempts(pairs) == 0).select(F.lit("error").alias("failure"))
    return failed.unionByName(lost).groupBy("failure").agg(F.count(F.lit(1)).alias("pairs"))


def severity_totals(pairs: DataFrame) -> DataFrame:
    """Severity counts of a batch with its successes and failures."""
    return pairs.groupBy("severity").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(_success()).alias("success_count"),
        F.count_if(~_success()).alias("fail_count"))


def timing_summary(pairs: DataFrame, seconds="seconds") -> DataFrame:
    """Success rate and seconds per image; a successful pair has two images."""
    totals = pairs.agg(
        F.count(F.lit(1)).alias("total_pairs"), F.count_if(_success()).alias("success_count"),
        F.count_if(~_success()).alias("fail_count"),
        F.bround(F.sum(seconds), 2).alias("total_generation_time"))
    return totals.withColumn("success_rate", text.percent("success_count", "total_pairs", 1)
                             ).withColumn("avg_time_per_image", text.rate(
                                 "total_generation_time", F.col("success_count") * 2, 2))


LEAST_GAP = 0.5


def score_gap_pairs(pairs: DataFrame, least_gap=LEAST_GAP) -> DataFrame:
    """Pairs whose positive score lies so far above the negative one; unscored pairs go."""
    gap = F.col("positive_score") - F.col("negative_score")
    return pairs.withColumn("score_gap", gap).where(gap >= least_gap)


def score_statistics(pairs: DataFrame, by=()) -> DataFrame:
    """Pairs with both scores, their average scores and average difference, to four digits.

    Scores are best given as decimals, whose sums do not depend on the order of rows.
    """
    scored = pairs.where(F.col("positive_score").isNotNull() & F.col("negative_score").isNotNull())
    sums = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("total_pairs"),
                                   F.sum("positive_score").cast("double").alias("_p"),
                                   F.sum("negative_score").cast("double").alias("_n"))
    return sums.select(*by, "total_pairs", *[
        F.when(F.col("total_pairs") > 0, F.bround(total / F.col("total_pairs"), 4)).alias(name)
        for name, total in (("average_positive_score", F.col("_p")),
                            ("average_negative_score", F.col("_n")),
                            ("average_score_difference", F.col("_p") - F.col("_n")))])


def successful_pairs(pairs: DataFrame, negative="negative_prompt") -> DataFrame:
    """Rows that have a negative prompt."""
    return pairs.where(F.coalesce(negative, F.lit("")) != "")
