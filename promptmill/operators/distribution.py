"""Samples to a target distribution over subject categories."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions import keys, text
from promptmill.operators.ranking import top_k_by_hash
from promptmill.session import param_table

# Subject categories and their shares of the pool in percent.
SUBJECT_SHARES = {
    "People": 15, "Nature": 15, "Objects": 15, "Everyday Life": 15, "Animals": 8, "Architecture": 8,
    "Events": 8, "Technology": 8, "Fantasy/Sci-Fi": 2, "Vehicles": 2, "Abstract": 2, "Space": 2,
    "Historical": 2}
# Keywords of the categories that have them; the others get words by a parameter.
SUBJECT_WORDS = {
    "People": ["person", "woman", "man", "portrait", "face"],
    "Nature": ["landscape", "mountain", "forest", "ocean", "sky"],
    "Animals": ["dog", "cat", "bird", "wildlife"],
    "Architecture": ["building", "house", "bridge", "tower"]}
DEFAULT_SUBJECT = "Objects"


def subject_category(lowered, words=None, default=DEFAULT_SUBJECT) -> Column:
    """The first category, in the order given, one of whose keywords occurs in the text."""
    rule = F.lit(default)
    for name, some in reversed((words or SUBJECT_WORDS).items()):
        rule = F.when(text.any_of([text.col(lowered).contains(w.lower()) for w in some]),
                      F.lit(name)).otherwise(rule)
    return rule


def apportioned(supply: DataFrame, total: int, category="category", available="available",
                weight="weight") -> DataFrame:
    """Adds ``take``: whole numbers that sum up to ``total``, or to all there is if that is less.

    Shares follow the weights. A category whose share exceeds its supply gives all it has, and the
    rest is shared again by the weights of the others, until no share exceeds its supply; what is
    left after rounding down goes to the largest remainders, then by name. ``supply`` has one row
    per category (weights positive whole numbers; a null supply counts as none).
    """
    rows = supply.withColumn("_have", F.coalesce(available, F.lit(0)).cast("long")).withColumn(
        "_w", F.col(weight).cast("long"))
    # categories by supply for each unit of weight: those that run short come first
    ratio = F.col("_have") / F.col("_w")
    order = Window.orderBy(ratio, category)      # one row per category
    rows = rows.withColumn("_weights", F.sum("_w").over(order.rowsBetween(
        0, Window.unboundedFollowing))).withColumn("_before", F.coalesce(F.sum("_have").over(
            order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    short = F.col("_have") * F.col("_weights") <= F.col("_w") * (F.lit(total) - F.col("_before"))
    rows = rows.withColumn("_short", short)
    everywhere = Window.partitionBy()
    rows = rows.withColumn("_left", F.lit(total) - F.coalesce(F.sum(F.when(
        F.col("_short"), F.col("_have"))).over(everywhere), F.lit(0))).withColumn(
        "_open", F.sum(F.when(~F.col("_short"), F.col("_w"))).over(everywhere))
    share = F.col("_w") * F.col("_left")
    rows = rows.withColumn("_floor", F.when(F.col("_short"), F.col("_have")).otherwise(
        F.expr("_w * _left div _open"))).withColumn(
        "_part", F.when(F.col("_short"), -1).otherwise(share % F.col("_open")))
    spare = F.col("_left") - F.sum(F.when(~F.col("_short"), F.col("_floor"))).over(everywhere)
    by_part = F.row_number().over(Window.orderBy(F.desc("_part"), category))
    rows = rows.withColumn("_spare", spare).withColumn("_rank", by_part)
    more = ~F.col("_short") & (F.col("_rank") <= F.col("_spare"))
    return rows.withColumn("take", F.col("_floor") + more.cast("long")).select(
        *supply.columns, "take")


def distributed_sample(df: DataFrame, total: int, seed, category="category", id_col="record_id",
                       shares=None) -> DataFrame:
    """A seeded sample of ``total`` rows whose categories follow the shares, with ``sample_rank``
    inside each category. Categories without a share give nothing; identifiers are unique."""
    weights = param_table(df.sparkSession, list((shares or SUBJECT_SHARES).items()),
                          f"{category} string, weight long")
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("available"))
    takes = apportioned(weights.join(counts, category, "left"), total, category)
    # one row per category with a share
    rows = df.join(F.broadcast(takes.select(category, F.col("take").alias("_take"))), category)
    rows = rows.withColumn("_h", keys.sample_order(seed, category, id_col))
    return top_k_by_hash(rows, [category], "_h", id_col, "_take", "sample_rank").drop("_h", "_take")
