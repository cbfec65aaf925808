"""Success rates by prompt, dimension and model, fed back into pool decisions.

Each run leaves partial counts. They add up to the rates, and a run that arrives again, complete or
corrected, replaces its own counts, so nothing is counted twice. Counts of a run are spread over
several buckets by prompt, as one run may hold a large part of the log.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions import text
from promptmill.sources.bucketed import BucketedTable

SCHEMA = ("run_dir string, positive_prompt string, dimension string, model_id string, pairs long, "
          "valid_pairs long, mismatches long")
MISMATCH = ("positive_content_mismatch",)


def run_counts(pairs: DataFrame, mismatch=MISMATCH) -> DataFrame:
    """Partial counts of the runs in a pair log."""
    ok = F.coalesce("success", F.lit(False))
    return pairs.groupBy("run_dir", "positive_prompt", "dimension", "model_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(ok).alias("valid_pairs"),
        F.count_if(~ok & F.col("failure").isin(*mismatch)).alias("mismatches"))


def open_counts(spark: SparkSession, root: str, buckets=64, spread=8) -> BucketedTable:
    return BucketedTable(spark, root, SCHEMA, ["run_dir"], buckets, spread, ["positive_prompt"])


def arrive(counts: BucketedTable, pairs: DataFrame, mismatch=MISMATCH) -> int:
    """Take in the logs of some runs; logs of the same runs that came before are replaced."""
    return counts.change(run_counts(pairs, mismatch))


def success_rates(counts: DataFrame) -> DataFrame:
    """Sums over runs, and the share of valid pairs."""
    sums = counts.groupBy("positive_prompt", "dimension", "model_id").agg(
        *[F.sum(c).alias(c) for c in ("pairs", "valid_pairs", "mismatches")])
    return sums.withColumn("success_rate", text.rate("valid_pairs", "pairs"))


def mismatch_blacklist(rates: DataFrame, threshold=2) -> DataFrame:
    """Prompts that do not fit a dimension: so many mismatches over all models."""
    sums = rates.groupBy("positive_prompt", "dimension").agg(
        F.sum("mismatches").alias("mismatches"), F.count(F.lit(1)).alias("models"))
    return sums.where(F.col("mismatches") >= threshold)


def pool_triggers(rates: DataFrame, coverage: DataFrame, threshold=2, low_pool=2000,
                  low_rate=0.5) -> DataFrame:
    """Per dimension of the coverage report: its success, its blacklist, and whether prompts are to
    be generated (``backfill``: few usable prompts and a low success rate; ``watch``: one of both).
    """
    by_dimension = rates.groupBy("dimension").agg(
        F.sum("pairs").alias("pairs"), F.sum("valid_pairs").alias("valid_pairs"))
    listed = mismatch_blacklist(rates, threshold).groupBy("dimension").agg(
        F.count(F.lit(1)).alias("blacklisted"))
    rows = coverage.select("dimension", "available").join(by_dimension, "dimension", "left").join(
        listed, "dimension", "left").fillna(0, ["pairs", "valid_pairs", "blacklisted"])
    rate = F.when(F.col("pairs") > 0, text.rate("valid_pairs", "pairs"))
    few, poor = F.col("available") < low_pool, F.coalesce(rate < low_rate, F.lit(False))
    return rows.select(
        "dimension", "available", "pairs", "valid_pairs", "blacklisted",
        rate.alias("success_rate"), F.when(few & poor, F.lit("backfill")).when(
            few | poor, F.lit("watch")).otherwise(F.lit("none")).alias("trigger"),
        F.when(few & poor, low_pool - F.col("available")).otherwise(0).cast("long").alias(
            "requested"))
