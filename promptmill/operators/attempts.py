"""Ordered logic over the attempts of a pair, without putting a pair's attempts into one task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.params import taxonomy as tx


def pair_outcomes(attempts: DataFrame, pair="pair_id") -> DataFrame:
    """Outcome of every pair: the last attempt decides. Combined on the map side."""
    last = F.max_by(F.struct("status", "negative_prompt", "failure"), "attempt")
    return attempts.groupBy(pair).agg(
        F.count(F.lit(1)).alias("total_attempts"), last.alias("_last")).select(
        pair, "total_attempts", (F.col("_last.status") == "success").alias("success"),
        F.col("_last.status").alias("final_status"),
        F.col("_last.negative_prompt").alias("final_negative_prompt"),
        F.col("_last.failure").alias("final_failure"))


def with_error_pairs(pairs: DataFrame, outcomes: DataFrame, pair="pair_id") -> DataFrame:
    """Every planned pair; one without attempts failed with ``error`` and counts zero attempts."""
    joined = pairs.join(outcomes, pair, "left")
    missing = F.col("total_attempts").isNull()
    return (joined.withColumn("final_failure", F.when(missing, F.lit("error"))
                              .otherwise(F.col("final_failure")))
            .withColumn("success", F.coalesce("success", F.lit(False)))
            .withColumn("total_attempts", F.coalesce("total_attempts", F.lit(0))))


def next_actions(attempts: DataFrame, max_retries: int, pair="pair_id") -> DataFrame:
    """What follows each attempt.

    ``attempts``: ``pair_id, attempt`` (from 0), ``status`` (success, failed, error, skipped),
    ``failure, style_type``. The rules only ask whether an event happened earlier in the pair, so
    the first attempt of each event is aggregated and joined back, for pairs that have one. A pair
    with very many attempts is combined on the map side and its rows are spread over salts.
    """
    def first_when(test):
        return F.min(F.when(test, F.col("attempt")))

    incompatible = F.col("failure") == "positive_incompatible"
    drifted = (F.col("failure") == "style_drift") & (F.coalesce("style_type", F.lit("")) != "")
    failed = F.col("status") == "failed"
    firsts = attempts.groupBy(pair).agg(
        first_when(failed & incompatible).alias("_incompatible"),
        first_when(failed & drifted).alias("_drifted")).where(
        F.col("_incompatible").isNotNull() | F.col("_drifted").isNotNull())
    last_allowed = F.col("attempt") >= max_retries
    action = (
        F.when(F.col("status") == "success", F.lit("done"))
        .when(F.col("status") == "skipped", F.lit("stop_skipped"))
        .when(failed & (F.col("failure") == "positive_content_mismatch"),
              F.lit("stop_content_mismatch"))
        .when(failed & incompatible & (F.col("attempt") > F.col("_incompatible")),
              F.lit("stop_still_incompatible"))
        .when(last_allowed, F.lit("stop_exhausted"))
        .when(failed & incompatible, F.lit("anchor_positive"))
        .when(failed & drifted & (F.col("attempt") == F.col("_drifted")),
              F.lit("anchor_negative"))
        .otherwise(F.lit("rewrite")))
    return attempts.join(firsts, pair, "left").withColumn("next_action", action).drop(
        "_incompatible", "_drifted")


def anchored_prompt(prompt, style):
    """Positive prompt after style anchoring; an unknown or missing style counts as realistic."""
    result = None
    for name, anchor in tx.POSITIVE_ANCHORS.items():
        value = F.concat(F.lit(anchor), F.col(prompt))
        result = (F.when(F.col(style) == name, value) if result is None
                  else result.when(F.col(style) == name, value))
    return result.otherwise(F.concat(F.lit(tx.POSITIVE_ANCHORS["realistic"]), F.col(prompt)))


def positive_reuse(pairs: DataFrame, seed="seed", path="positive_image_path",
                   order_col="pair_id") -> DataFrame:
    """One positive per seed: its first image, and the negatives that use it."""
    return pairs.groupBy(seed).agg(
        F.min_by(path, order_col).alias("positive_image_path"),
        F.count(F.lit(1)).alias("negatives"))


def reuse_totals(pairs: DataFrame, seed="seed") -> DataFrame:
    """Distinct positives and negatives of a pair table."""
    return pairs.groupBy(seed).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count(F.lit(1)).alias("total_positive_images"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_negative_images"))
