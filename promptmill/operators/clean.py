"""Length, noise and source filters; exact deduplication; set operations on prompt tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions import keys, text
from promptmill.functions.plan import computed
from promptmill.functions.text import col
from promptmill.params import lexicon

FLT1_DEFAULTS = dict(min_words=5, min_chars=25, max_words=120, max_chars=800, max_commas=20,
                     max_repeat_ratio=0.35)


def classify_prompt(prompt, normalized=None, **limits) -> Column:
    """``short``, ``long``, ``noise`` or ``keep``, in that priority."""
    p = {**FLT1_DEFAULTS, **limits}
    raw = F.coalesce(col(prompt), F.lit(""))
    norm = col(normalized) if normalized is not None else text.normalize_prompt(raw)
    words, chars, lowered = text.word_count(norm), F.length(raw), F.lower(raw)
    noisy = ((text.comma_count(raw) >= p["max_commas"])
             | lowered.contains("http://") | lowered.contains("https://")
             | (text.repeat_ratio(norm) >= p["max_repeat_ratio"]))
    return (F.when((chars < p["min_chars"]) | (words < p["min_words"]), F.lit("short"))
            .when((chars > p["max_chars"]) | (words > p["max_words"]), F.lit("long"))
            .when(noisy, F.lit("noise"))
            .otherwise(F.lit("keep")))


def with_length_class(df: DataFrame, prompt="prompt", name="drop_reason", **limits) -> DataFrame:
    normalized = df.withColumn("_norm", text.normalize_prompt(prompt))
    return computed(normalized, **{name: classify_prompt(prompt, "_norm", **limits)}).drop("_norm")


def clean_records(df: DataFrame, prompt="prompt", **limits):
    """Kept rows and dropped rows (with ``_drop_reason``) of a pool."""
    classed = with_length_class(df, prompt, "_drop_reason", **limits)
    kept = classed.where(F.col("_drop_reason") == "keep").drop("_drop_reason")
    return kept, classed.where(F.col("_drop_reason") != "keep")


def cleaning_summary(df: DataFrame, by=(), prompt="prompt", **limits) -> DataFrame:
    """Counts per class in one pass: kept, short, long, noise."""
    classed = with_length_class(df, prompt, "_class", **limits)
    counts = [F.count_if(F.col("_class") == c).alias(name) for c, name in
              [("keep", "kept"), ("short", "short"), ("long", "long"), ("noise", "noise")]]
    return classed.groupBy(*by).agg(*counts)


LIBRARY_WORDS, SYNTHETIC_WORDS = (10, 100), (20, 80)


def word_ranges(df: DataFrame, by="source", prompt="prompt") -> DataFrame:
    """Prompts per source inside the word ranges for library and for generated prompts, both ends
    included, and below and above the first."""
    counted = computed(df.withColumn("_norm", text.normalize_prompt(prompt)),
                       _n=text.word_count("_norm"))
    n = F.col("_n")
    return counted.groupBy(by).agg(
        F.count_if(n < LIBRARY_WORDS[0]).alias("too_short"),
        F.count_if(n.between(*LIBRARY_WORDS)).alias("library_range"),
        F.count_if(n.between(*SYNTHETIC_WORDS)).alias("synthetic_range"),
        F.count_if(n > LIBRARY_WORDS[1]).alias("too_long"))


def clean_flagged_subpools(subpools: DataFrame, index: DataFrame, prompt="prompt", **limits):
    """Length-clean only the dimensions whose index row says ``skip_runtime_compat_filter``.

    Dimensions missing from the index, or not flagged, pass through unchanged.
    """
    flags = index.select("dimension", "skip_runtime_compat_filter")
    classed = with_length_class(subpools, prompt, "_class", **limits).join(
        flags, "dimension", "left")
    flagged = F.coalesce(F.col("skip_runtime_compat_filter"), F.lit(False))
    return (classed.where(~flagged | (F.col("_class") == "keep"))
            .drop("_class", "skip_runtime_compat_filter"))


def candidate_status(df: DataFrame, min_words=lexicon.DEFAULT_MIN_WORDS, prompt="prompt",
                     source="source") -> DataFrame:
    """Normalize prompts and mark them ``empty``, ``short`` (per source) or ``candidate``."""
    limit = F.lit(min_words)
    for name, words in lexicon.SOURCE_MIN_WORDS.items():
        limit = F.when(col(source) == name, F.lit(words)).otherwise(limit)
    norm = df.withColumn("normalized", text.normalize_prompt(prompt)).withColumn(
        source, F.coalesce(col(source), F.lit("unknown")))
    return computed(norm, status=(
        F.when(F.col("normalized") == "", F.lit("empty"))
        .when(text.word_count("normalized") < limit, F.lit("short"))
        .otherwise(F.lit("candidate"))))


def first_wins(df: DataFrame, text_col: str, order_col: str) -> DataFrame:
    """One row per text: the one with the smallest ``order_col`` (a unique, non-null id).

    Only a 32-byte digest and the id take part in the aggregation, which combines on the map side;
    a text copied millions of times is therefore no hot task. The wide rows move once, in the semi
    join on the id, whose keys are unique.
    """
    winners = (df.groupBy(keys.digest(text_col).alias("_digest"))
               .agg(F.min(order_col).alias(order_col)).select(order_col))
    return df.join(winners, order_col, "left_semi")


def clean_and_dedup(df: DataFrame, min_words=lexicon.DEFAULT_MIN_WORDS, order_col="record_id",
                    source="source") -> DataFrame:
    """Normalized prompts that are long enough, first occurrence only."""
    long_enough = candidate_status(df, min_words, source=source).where(
        F.col("status") == "candidate")
    winners = (long_enough.groupBy(keys.digest("normalized").alias("_digest"))
               .agg(F.min(order_col).alias(order_col)).select(order_col))
    # Only winners are normalized again on the way out.
    return (df.join(winners, order_col, "left_semi")
            .withColumn("prompt", text.normalize_prompt("prompt"))
            .withColumn(source, F.coalesce(col(source), F.lit("unknown"))))


def _dedup_groups(df, min_words, order_col, source):
    status = candidate_status(df, min_words, source=source)
    key = F.when(F.col("status") == "candidate", keys.digest("normalized"))
    return (status.select("status", key.alias("k"), order_col, source)
            .groupBy("status", "k")
            .agg(F.count(F.lit(1)).alias("n"), F.min_by(source, order_col).alias(source)))


def dedup_summary(df: DataFrame, min_words=lexicon.DEFAULT_MIN_WORDS, order_col="record_id",
                  source="source") -> DataFrame:
    """Input, empty, short, duplicate and output counts in one pass over the prompts."""
    n = F.col("n")

    def total(status):
        return F.coalesce(F.sum(F.when(F.col("status") == status, n)), F.lit(0))

    distinct = F.count_if(F.col("status") == "candidate")
    return _dedup_groups(df, min_words, order_col, source).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("input_count"),
        total("empty").alias("filtered_empty_count"),
        total("short").alias("filtered_short_count"),
        (total("candidate") - distinct).alias("exact_duplicate_count"),
        distinct.alias("output_count"))


def dedup_source_counts(df: DataFrame, min_words=lexicon.DEFAULT_MIN_WORDS,
                        order_col="record_id", source="source") -> DataFrame:
    """Rows per source after deduplication."""
    return (_dedup_groups(df, min_words, order_col, source)
            .where(F.col("status") == "candidate")
            .groupBy(source).agg(F.count(F.lit(1)).alias("output_count")))


def dedup_stripped(df: DataFrame, prompt="prompt", order_col="record_id", strip=True) -> DataFrame:
    """First row per prompt, compared after stripping (or as is); empty prompts dropped."""
    value = text.strip(prompt) if strip else F.coalesce(col(prompt), F.lit(""))
    keyed = df.withColumn("_text", value).where(F.col("_text") != "")
    return first_wins(keyed, "_text", order_col).drop("_text")


def new_versus_base(new: DataFrame, base: DataFrame, prompt="prompt",
                    order_col="record_id") -> DataFrame:
    """New rows whose stripped prompt is neither in the base nor earlier among the new rows."""
    def keyed(df):
        stripped = df.withColumn("_text", text.strip(prompt)).where(F.col("_text") != "")
        return stripped.withColumn("_digest", keys.digest("_text"))

    winners = (keyed(new).groupBy("_digest").agg(F.min(order_col).alias(order_col))
               .join(keyed(base).select("_digest").distinct(), "_digest", "left_anti")
               .select(order_col))
    return new.join(winners, order_col, "left_semi")


def union_first_wins(tables, prompt="prompt", order_col="record_id") -> DataFrame:
    """Union of tables in the given priority, one row per prompt; adds ``priority``."""
    merged = None
    for i, table in enumerate(tables):
        part = table.withColumn("priority", F.lit(i))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    keyed = merged.withColumn("_digest", keys.digest(prompt))
    rank = F.struct("priority", order_col)
    winners = keyed.groupBy("_digest").agg(F.min(rank).alias("_w")).select("_w.*")
    return merged.join(winners, ["priority", order_col], "left_semi")


def merge_index(base: DataFrame, override: DataFrame, key="dimension") -> DataFrame:
    """Index rows of ``override`` replace those of ``base`` with the same key."""
    kept = base.join(override.select(key), key, "left_anti")
    return kept.unionByName(override, allowMissingColumns=True)


def compare_tag_snapshots(old: DataFrame, new: DataFrame, tag: str, key="prompt") -> DataFrame:
    """Counts of a tag before and after, and of prompts that lost or gained it.

    Only prompts of the old snapshot are compared; the new count covers the whole new snapshot.
    Both snapshots hold one row per ``key``.
    """
    def flagged(df, name):
        return df.select(key, F.array_contains("semantic_tags", tag).alias(name))

    pairs = flagged(old, "in_old").join(flagged(new, "in_new"), key, "full_outer")
    was = F.coalesce("in_old", F.lit(False))
    now = F.coalesce("in_new", F.lit(False))
    return pairs.agg(F.count_if(was).alias("old_count"), F.count_if(now).alias("new_count"),
                     F.count_if(was & ~now).alias("removed"),
                     F.count_if(F.col("in_old").isNotNull() & ~was & now).alias("added"))


def normalize_backfill(df: DataFrame) -> DataFrame:
    """Generated prompts as pool records: constant source, lineage columns, empty dropped."""
    dimension = F.coalesce("dimension", F.lit("unknown"))
    return (df.withColumn("prompt", text.strip("prompt")).where(F.col("prompt") != "")
            .select("record_id", "prompt", F.lit("llm_backfill").alias("source"),
                    F.concat(F.lit("llm_backfill::"), dimension).alias("assigned_bucket"),
                    dimension.alias("backfill_dimension"),
                    F.col("macro_bucket").alias("backfill_macro_bucket"),
                    F.col("request_id").alias("backfill_request_id"),
                    F.col("prompt_index_in_request").alias("backfill_prompt_index"),
                    F.col("model").alias("backfill_model"),
                    F.col("coverage_mode").alias("backfill_coverage_mode")))


def merge_backfill(base: DataFrame, generated: DataFrame):
    """Merged pool and its summary: base rows plus generated prompts new to the base."""
    normalized = normalize_backfill(generated)
    fresh = new_versus_base(normalized, base)
    merged = base.unionByName(fresh, allowMissingColumns=True)

    def n(df, name):
        return df.agg(F.count(F.lit(1)).alias(name))

    summary = (n(base, "base_prompt_count").crossJoin(n(generated, "generated_prompt_count"))
               .crossJoin(n(normalized, "normalized_generated_prompt_count"))
               .crossJoin(n(fresh, "deduped_new_prompt_count"))
               .withColumn("merged_prompt_count",
                           F.col("base_prompt_count") + F.col("deduped_new_prompt_count")))
    return merged, summary
