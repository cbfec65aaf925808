"""Pool sizing, scene mixes, request plans and allocation tables.

Tables here hold one row per dimension, bucket or request; they come from parameters or from
counts over the prompt tables.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions import text
from promptmill.params import requests as rq

BLOCK_OF_REQUESTS = 10_000


def normalize_weights(df: DataFrame, weight="weight") -> DataFrame:
    """Weights clipped at zero and scaled to one; equal weights when nothing is left."""
    clipped = F.greatest(F.col(weight), F.lit(0.0))
    totals = F.broadcast(df.agg(F.sum(clipped).alias("_total"), F.count(F.lit(1)).alias("_n")))
    share = F.when(F.col("_total") <= 0, F.lit(1.0) / F.col("_n")).otherwise(
        clipped / F.col("_total"))
    return df.crossJoin(totals).withColumn(weight, share).drop("_total", "_n")


def pool_sizes(weights: DataFrame, total_pairs: int, negatives: int, multiplier=1.5,
               minimum=10) -> DataFrame:
    """Required prompts per dimension from ``dimension, weight, constrained``."""
    if total_pairs <= 0 or negatives <= 0:
        raise ValueError("total_pairs and negatives must be positive")
    pairs = F.bround(F.lit(float(total_pairs)) * F.col("weight"), 0).cast("long")
    base = F.ceil(F.col("estimated_pairs") / negatives)
    required = F.when(F.col("constrained"), F.ceil(base * multiplier)).otherwise(base)
    return (normalize_weights(weights).withColumn("estimated_pairs", pairs)
            .withColumn("required_positive_prompts", F.greatest(required, F.lit(minimum)))
            .withColumn("target_positive_pool_size", F.lit(-(-total_pairs // negatives))))


def rank_sources(sources: DataFrame, coverage: DataFrame, targets) -> DataFrame:
    """Sources by mean coverage of the target dimensions times the root of their size.

    ``sources``: ``name, prompt_count``; ``coverage``: ``name, dimension, coverage``.
    """
    targets = list(targets)
    summed = coverage.where(F.col("dimension").isin(*targets)).groupBy("name").agg(
        F.sum("coverage").alias("_sum"))
    mean = F.coalesce("_sum", F.lit(0.0)) / F.lit(float(len(targets))) if targets else F.lit(0.0)
    return (sources.join(summed, "name", "left").withColumn("avg_target_coverage", mean)
            .withColumn("selection_score", F.col("avg_target_coverage")
                        * F.sqrt(F.greatest(F.col("prompt_count"), F.lit(0))))
            .drop("_sum").orderBy(F.desc("selection_score"), "name"))


def scene_mix(plans: DataFrame, mix: DataFrame, overrides: DataFrame = None) -> DataFrame:
    """Prompts per (dimension, macro bucket): ``dimension, ord, macro_bucket, bucket_prompts``.

    ``plans``: ``dimension, target_new_prompts, template_family``; ``mix``: ``template_family,
    ord, macro_bucket, ratio``. Every bucket but the last is rounded half to even and the last one
    takes the rest, so the parts always add up. A family without a mix uses one default bucket; an
    override (``dimension, ord, macro_bucket, bucket_prompts``) replaces the mix.
    """
    parts = Window.partitionBy("dimension").orderBy("ord")
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    last = F.max("ord").over(Window.partitionBy("dimension"))
    rounded = F.bround(F.col("target_new_prompts") * F.col("ratio"), 0).cast("long")
    plain = plans if overrides is None else plans.join(
        overrides.select("dimension").distinct(), "dimension", "left_anti")
    mixed = (plain.join(mix, "template_family", "left")
             .withColumn("ord", F.coalesce("ord", F.lit(0)))
             .withColumn("macro_bucket", F.coalesce("macro_bucket",
                                                    F.lit(rq.DEFAULT_SCENE_BUCKET)))
             .withColumn("_part", rounded).withColumn("_last", last)
             .withColumn("_before", F.coalesce(F.sum("_part").over(before), F.lit(0)))
             .withColumn("bucket_prompts", F.when(
                 F.col("ord") == F.col("_last"), F.col("target_new_prompts") - F.col("_before"))
                 .otherwise(F.col("_part"))))
    result = mixed.select("dimension", "ord", "macro_bucket", "bucket_prompts")
    return result if overrides is None else result.unionByName(overrides)


def priority_queue(plans: DataFrame, limit=None) -> DataFrame:
    ordered = plans.orderBy("priority", F.desc("target_new_prompts"), "dimension")
    return ordered if limit is None else ordered.limit(limit)


def request_plan(plans: DataFrame, buckets: DataFrame, chunk=5, max_requests=None) -> DataFrame:
    """Requests of at most ``chunk`` prompts with a running id in priority order.

    The id of a request is the number of requests of all earlier buckets plus its place in its own
    bucket; only the bucket table is ordered as a whole, the requests are generated in parallel.
    """
    if chunk <= 0:
        raise ValueError("chunk must be positive")
    order = Window.partitionBy("_one").orderBy(
        "priority", F.desc("target_new_prompts"), "dimension", "ord").rowsBetween(
        Window.unboundedPreceding, -1)
    sized = (buckets.where(F.col("bucket_prompts") > 0).join(plans, "dimension")
             .withColumn("_one", F.lit(0))
             .withColumn("_chunks", F.ceil(F.col("bucket_prompts") / chunk).cast("long"))
             .withColumn("_before", F.coalesce(F.sum("_chunks").over(order), F.lit(0)))
             .drop("_one"))
    # in blocks, so that no row ever holds all requests of a large bucket
    blocks = F.sequence(F.lit(0), F.expr(f"(_chunks - 1) div {BLOCK_OF_REQUESTS}"))
    first = F.col("_block") * BLOCK_OF_REQUESTS
    inside = F.sequence(first + 1, F.least(first + BLOCK_OF_REQUESTS, F.col("_chunks")))
    jobs = (sized.withColumn("_block", F.explode(blocks))
            .withColumn("chunk_index", F.explode(inside)).drop("_block")
            .withColumn("request_id", F.col("_before") + F.col("chunk_index"))
            .withColumn("requested_prompts", F.least(
                F.lit(chunk), F.col("bucket_prompts") - (F.col("chunk_index") - 1) * chunk))
            .drop("_chunks", "_before"))
    return jobs if max_requests is None else jobs.where(F.col("request_id") <= max_requests)


def batch_plan(jobs: DataFrame, requests_per_batch=10) -> DataFrame:
    """Batches of consecutive requests with their dimensions and prompt totals."""
    if requests_per_batch <= 0:
        raise ValueError("requests_per_batch must be positive")
    batch = (F.floor((F.col("request_id") - 1) / requests_per_batch) + 1).cast("long")
    return jobs.groupBy(batch.alias("batch_index")).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.min("request_id").alias("first_request_id"),
        F.max("request_id").alias("last_request_id"),
        F.sum("requested_prompts").alias("total_target_prompts"),
        F.array_join(F.array_sort(F.collect_set("dimension")), ",").alias("dimensions"))


def batch_status(batches: DataFrame, results: DataFrame) -> DataFrame:
    """Completed batches have both outputs; the first pending one is next.

    ``results``: ``batch_index, generated_exists, summary_exists``.
    """
    done = F.coalesce("generated_exists", F.lit(False)) & F.coalesce("summary_exists",
                                                                     F.lit(False))
    joined = batches.join(results, "batch_index", "left").withColumn(
        "status", F.when(done, F.lit("completed")).otherwise(F.lit("pending")))
    first = F.broadcast(joined.where(F.col("status") == "pending").agg(
        F.min("batch_index").alias("_next")))
    return joined.crossJoin(first).withColumn(
        "is_next", F.coalesce(F.col("batch_index") == F.col("_next"), F.lit(False))).drop("_next")


def batch_totals(status: DataFrame) -> DataFrame:
    pending = F.col("status") == "pending"
    return status.agg(F.count(F.lit(1)).alias("batch_count"),
                      F.count_if(~pending).alias("completed_batches"),
                      F.count_if(pending).alias("pending_batches"),
                      F.min(F.when(pending, F.col("batch_index"))).alias(
                          "next_pending_batch_index"))


def backfill_summary(plans: DataFrame) -> DataFrame:
    """Target prompts in total, by tier and by coverage mode: one pass with grouping sets."""
    level = F.when(F.grouping("tier") == 0, F.lit("tier")).when(
        F.grouping("coverage_mode") == 0, F.lit("coverage_mode")).otherwise(F.lit("total"))
    tier, mode = F.col("tier"), F.col("coverage_mode")
    return (plans.groupingSets([[tier], [mode], []], tier, mode)
            .agg(level.alias("level"), F.coalesce("tier", "coverage_mode", F.lit("all")).alias(
                "name"), F.count(F.lit(1)).alias("dimensions"),
                F.sum("target_new_prompts").alias("target_new_prompts"))
            .select("level", "name", "dimensions", "target_new_prompts"))


def request_text(jobs: DataFrame, min_words: int, max_words: int) -> DataFrame:
    """System and user text of every request.

    ``jobs`` has the request columns plus ``template_family, coverage_mode, complexity_mode`` and
    optionally the comma-joined policy lists ``core, optional, forbidden``.
    """
    instruction = None
    for name, sentence in rq.TEMPLATE_INSTRUCTIONS.items():
        test = F.col("template_family") == name
        instruction = (F.when(test, F.lit(sentence)) if instruction is None
                       else instruction.when(test, F.lit(sentence)))
    instruction = instruction.otherwise(F.lit(rq.DEFAULT_INSTRUCTION))
    user = F.concat(
        F.lit("Generate "), F.col("requested_prompts").cast("string"),
        F.lit(" high-quality positive prompts for the macro bucket '"), "macro_bucket",
        F.lit("' that support the assigned downstream contrastive check. Template family: "),
        "template_family", F.lit(". " + rq.ANCHOR_INSTRUCTION + " "), instruction,
        F.lit(" Return only a JSON array of prompt strings. Keep prompts semantically natural, "
              "varied, and usable as positive anchors."))

    def policy(label, name):
        if name not in jobs.columns:
            return F.lit(None).cast("string")
        listed = F.when(F.col(name) == "", F.lit("none")).otherwise(F.col(name))
        return F.concat(F.lit(label), listed, F.lit("."))

    balanced = F.when(
        F.col("coverage_mode") == "global_balanced",
        F.lit("Use the current macro bucket only, while preserving globally balanced style "
              "diversity overall.")).otherwise(
        F.lit("Respect the dimension-specific macro coverage policy within this single macro "
              "bucket."))
    system = F.concat_ws(
        " ",
        F.lit("You are generating high-quality positive prompts for a text-to-image model."),
        F.lit("Support the assigned downstream contrastive check without mentioning internal "
              "degradation labels."),
        F.concat(F.lit("Template family: "), "template_family", F.lit(".")),
        F.concat(F.lit("Coverage mode: "), "coverage_mode", F.lit(".")),
        F.concat(F.lit("Complexity mode: "), "complexity_mode", F.lit(".")),
        F.concat(F.lit("This request is only for the macro bucket: "), "macro_bucket",
                 F.lit(".")),
        F.lit("Follow the configured macro taxonomy and micro-structure constraints."),
        F.lit("Do not use quality booster tokens such as masterpiece, best quality, 8k, or ultra "
              "detailed."),
        F.lit(f"Keep the prompt length within {min_words}-{max_words} words."),
        balanced,
        policy("Use these core macro buckets: ", "core"),
        policy("Use these optional macro buckets: ", "optional"),
        policy("Avoid these forbidden macro buckets: ", "forbidden"),
        F.lit("This request target:"),
        F.concat(F.lit("- "), "macro_bucket", F.lit(": "),
                 F.col("requested_prompts").cast("string")),
        F.lit("Output only the generated prompts, without explanations or numbering unless "
              "explicitly requested."))
    return jobs.withColumn("system_prompt", system).withColumn("user_prompt", user)


def allocation_template(dimensions: DataFrame, models, coverage: DataFrame,
                        stats: DataFrame) -> DataFrame:
    """Pool size and historical success per dimension, one pair of columns per model.

    ``coverage``: ``model_id, dimension, count``; ``stats``: ``model_id, dimension, severity,
    pairs, valid_pairs``.
    """
    history = stats.groupBy("model_id", "dimension").agg(
        F.sum("pairs").alias("_p"), F.sum("valid_pairs").alias("_v"))
    success = F.bround(F.col("_v") / F.nullif(F.col("_p"), F.lit(0)), 4)
    facts = (coverage.select("model_id", "dimension", F.col("count").alias("pool_size"))
             .join(history, ["model_id", "dimension"], "full_outer")
             .withColumn("success", success))
    wide = facts.groupBy("dimension").pivot("model_id", list(models)).agg(
        F.first("pool_size", True).alias("pool_size"),
        F.first("success", True).alias("historical_success"))
    return dimensions.join(wide, "dimension", "left")


def allocation_rankings(stats: DataFrame, top=5) -> DataFrame:
    """Best and worst dimensions per model by success rate; ties by name."""
    rates = stats.groupBy("model_id", "dimension").agg(
        F.sum("pairs").alias("pairs"), F.sum("valid_pairs").alias("valid_pairs")).where(
        F.col("pairs") > 0).withColumn("success_rate", F.col("valid_pairs") / F.col("pairs"))
    best = Window.partitionBy("model_id").orderBy(F.desc("success_rate"), "dimension")
    worst = Window.partitionBy("model_id").orderBy("success_rate", F.desc("dimension"))
    ranked = rates.withColumn("best_rank", F.row_number().over(best)).withColumn(
        "worst_rank", F.row_number().over(worst))
    return ranked.where((F.col("best_rank") <= top) | (F.col("worst_rank") <= top)).withColumn(
        "success_rate", text.rate("valid_pairs", "pairs"))


def plan_violations(catalog: DataFrame, spec: DataFrame, buckets: DataFrame) -> DataFrame:
    """Integrity problems between the source catalog and the sampling specification.

    ``catalog`` and ``spec``: ``source, candidate_pool_size, final_selected_size``; ``buckets``:
    ``source, name, final_selected_size``.
    """
    sums = buckets.groupBy("source").agg(F.sum("final_selected_size").alias("_buckets"))
    joined = (spec.join(catalog.select(
        "source", F.col("candidate_pool_size").alias("_candidates"),
        F.col("final_selected_size").alias("_selected"), F.lit(True).alias("_known")),
        "source", "left").join(sums, "source", "left"))
    violation = (
        F.when(F.col("_known").isNull(), F.lit("unknown_source"))
        .when(F.col("candidate_pool_size") != F.col("_candidates"),
              F.lit("candidate_pool_mismatch"))
        .when(F.col("final_selected_size") != F.col("_selected"),
              F.lit("final_selected_mismatch"))
        .when(F.coalesce("_buckets", F.lit(0)) != F.col("final_selected_size"),
              F.lit("bucket_total_mismatch")))
    return joined.select("source", violation.alias("violation")).where("violation is not null")


def download_manifest(catalog: DataFrame, buckets: DataFrame) -> DataFrame:
    """Catalog rows with the flag whether the source is sampled by bucket."""
    planned = buckets.select("source").distinct().withColumn("_b", F.lit(True))
    return catalog.join(planned, "source", "left").withColumn(
        "has_bucket_plan", F.coalesce("_b", F.lit(False))).drop("_b")
