"""The prompt registry: for every prompt the dimensions it fits, prefers, or is kept out of.

The inverse of the subpools. It is kept in buckets of identifiers, and a delta of new, changed and
removed prompts rewrites only the buckets it touches.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions.plan import computed
from promptmill.functions.text import any_of
from promptmill.operators import compat
from promptmill.params import taxonomy as tx
from promptmill.sources.bucketed import BucketedTable

SCHEMA = ("record_id long, source string, compatible array<string>, preferred array<string>, "
          "excluded map<string,string>")


def _names(tests) -> F.Column:
    return F.filter(F.array(*[F.when(test, F.lit(d)) for d, test in tests]),
                    lambda d: d.isNotNull())


def registry_rows(tagged: DataFrame, dimensions=None, requirements=None) -> DataFrame:
    """Registry rows of tagged prompts, dimensions in alphabetical order.

    ``excluded`` maps a dimension to the rule that keeps the prompt out: ``tags``, or the reason of
    the text rules. A dimension is preferred if the prompt fits it and has one of its preferred
    tags; dimensions that name none are preferred by nobody. Dimensions with the same text rules
    share one run of them, which prompts that the tags keep out of all of them are spared.
    """
    reqs = tx.REQUIREMENTS if requirements is None else requirements
    dims = sorted(dimensions or reqs)
    lowered = compat.with_lower(tagged)
    tagged_so = {d: compat.tags_satisfied(reqs.get(d), "semantic_tags") for d in dims}
    kinds = {"text_error": [d for d in dims if d == "text_error"],
             "face": [d for d in dims if d in compat.FACE_RULE_DIMENSIONS]}
    special = {f"_special_{kind}": F.when(any_of(tagged_so[d] for d in own), compat.special_rule_reason(
        own[0], "prompt", "_lower")) for kind, own in kinds.items() if own}
    lowered = computed(lowered, **special) if special else lowered
    rule_of = {d: F.col(f"_special_{kind}") for kind, own in kinds.items() for d in own}
    rows = [(d, tagged_so[d], rule_of.get(d, F.lit(None).cast("string"))) for d in dims]
    preferred = [(d, fits & text.isNull() & compat.has_preferred(d, "semantic_tags", reqs))
                 for d, fits, text in rows if reqs.get(d) and reqs[d].preferred]
    reasons = F.array(*[F.struct(F.lit(d).alias("key"), F.when(~fits, F.lit("tags")).otherwise(
        text).alias("value")) for d, fits, text in rows])
    return lowered.select(
        F.col("record_id").cast("long").alias("record_id"), "source",
        _names([(d, fits & text.isNull()) for d, fits, text in rows]).alias("compatible"),
        (_names(preferred) if preferred else F.array().cast("array<string>")).alias("preferred"),
        F.map_from_entries(F.filter(reasons, lambda r: r["value"].isNotNull())).alias("excluded"))


def open_registry(spark: SparkSession, root: str, buckets=64) -> BucketedTable:
    return BucketedTable(spark, root, SCHEMA, ["record_id"], buckets)


def apply_delta(registry: BucketedTable, tagged: DataFrame | None, removed: DataFrame | None = None,
                **rules) -> int:
    """Put in new and changed prompts and take out removed ones (``record_id``); the new version."""
    if tagged is None:
        rows = registry.spark.createDataFrame([], registry.schema)
    else:
        rows = registry_rows(tagged, **rules)
    return registry.change(rows, removed)


def prompts_of(registry: DataFrame, dimension: str) -> DataFrame:
    """The subpool of a dimension, the preferred prompts marked."""
    return registry.where(F.array_contains("compatible", dimension)).select(
        "record_id", "source", F.array_contains("preferred", dimension).alias("is_preferred"))
