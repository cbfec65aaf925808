"""Assembly of screened, targeted, final and token-limited pools; routing and build settings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions import keys, text
from promptmill.functions.plan import held
from promptmill.operators import clean, families, screening
from promptmill.params import taxonomy as tx
from promptmill.session import param_table

SCREENED_LABELS = ["pass", "uncertain"]
BODY_CORE = "body_proportion_error"
# Dimensions that share the screened body core, and those that add their own screened prompts.
CORE_DIMENSIONS = [BODY_CORE, "impossible_pose", "extra_limbs", "expression_mismatch"]
DELTA_DIMENSIONS = ["face_asymmetry", "hand_malformation"]
ANIMAL_DIMENSION = "animal_anatomy_error"


def match_source(results: DataFrame, source: DataFrame, order_col="record_id") -> DataFrame:
    """Result prompts with the first source record of the same prompt; unmatched ones dropped."""
    first = clean.first_wins(source.where(F.coalesce("prompt", F.lit("")) != ""), "prompt",
                             order_col)
    wanted = results.withColumn("_digest", keys.digest("prompt")).withColumn(
        "_result", F.col(order_col)).drop("prompt", order_col)
    # One record per prompt, only for prompts that have results; the results of a very frequent
    # prompt are split by adaptive skew handling.
    keyed = first.withColumn("_digest", keys.digest("prompt")).join(
        wanted.select("_digest").distinct(), "_digest", "left_semi")
    return wanted.join(keyed, "_digest", "left").where(
        F.col(order_col).isNotNull()).drop("_digest", "_result")


def screened_subpools(source: DataFrame, results: DataFrame) -> DataFrame:
    """Long table ``dimension, part, record...`` of the anatomy dimensions.

    ``results``: ``record_id`` (result order), ``dimension, prompt, label``. The core prompts
    serve four dimensions under a signature test and come first in the face and hand pools.
    """
    names = [BODY_CORE, *DELTA_DIMENSIONS, ANIMAL_DIMENSION]
    usable = results.where(F.col("dimension").isin(*names) & F.col("label").isin(*SCREENED_LABELS)
                           & (F.coalesce("prompt", F.lit("")) != ""))
    firsts = usable.withColumn("_digest", keys.digest("prompt")).groupBy(
        "dimension", "_digest").agg(F.min("record_id").alias("result_ord"))
    source_first = clean.first_wins(source.where(F.coalesce("prompt", F.lit("")) != ""), "prompt",
                                    "record_id").withColumn("_digest", keys.digest("prompt"))
    # Per prompt: which results it has, and where; one row, so no self join is needed.
    per_prompt = firsts.groupBy("_digest").agg(*[
        F.min(F.when(F.col("dimension") == n, F.col("result_ord"))).alias(f"o_{n}")
        for n in names])
    record = source_first.join(per_prompt, "_digest").drop("_digest")

    def flag(tag):
        return F.coalesce(F.element_at("signature", tag), F.lit(False))

    core = F.col(f"o_{BODY_CORE}")
    person, face, body = flag("has_person"), flag("has_face"), flag("has_full_body")
    entries = [F.when(core.isNotNull() & person & (face if d == "expression_mismatch" else body),
                      F.struct(F.lit(d).alias("dimension"), F.lit(0).alias("part"),
                               core.alias("result_ord"))) for d in CORE_DIMENSIONS]
    for d in DELTA_DIMENSIONS:
        own = F.col(f"o_{d}")
        entries.append(F.when(core.isNotNull() | own.isNotNull(), F.struct(
            F.lit(d).alias("dimension"), F.when(core.isNotNull(), 0).otherwise(1).alias("part"),
            F.coalesce(core, own).alias("result_ord"))))
    animal = F.col(f"o_{ANIMAL_DIMENSION}")
    entries.append(F.when(animal.isNotNull(), F.struct(
        F.lit(ANIMAL_DIMENSION).alias("dimension"), F.lit(0).alias("part"),
        animal.alias("result_ord"))))
    exploded = record.select(*source.columns,
                             F.explode(F.array_compact(F.array(*entries))).alias("_e"))
    return exploded.select("_e.dimension", "_e.part", "_e.result_ord", *source.columns)


def targeted_subpools(object_pool: DataFrame,
                      dimensions=("object_structure_error", "material_mismatch")) -> DataFrame:
    """Targeted pools derived from an existing pool: unique prompts, one copy per dimension."""
    unique = clean.dedup_stripped(object_pool, "prompt", "record_id", strip=False)
    return unique.drop("dimension").withColumn(
        "dimension", F.explode(F.array(*[F.lit(d) for d in dimensions])))


def index_of(subpools: DataFrame, dimensions: DataFrame, skip_filter=True) -> DataFrame:
    """Index of a long subpool table; dimensions without rows have count 0."""
    counts = subpools.groupBy("dimension").agg(F.count(F.lit(1)).alias("_n"))
    return dimensions.join(counts, "dimension", "left").select(
        "dimension", F.coalesce("_n", F.lit(0)).alias("count"),
        F.lit(skip_filter).alias("skip_runtime_compat_filter"))


def family_index(results: DataFrame) -> DataFrame:
    """Per family: results, passes, fails and distinct passed prompts."""
    stats = screening.pass_stats(results, ["family_name"])
    distinct = (results.where(F.lower(text.strip("label")) == "pass")
                .withColumn("prompt", text.strip("prompt")).where(F.col("prompt") != "")
                .select("family_name", keys.digest("prompt").alias("_d")).distinct()
                .groupBy("family_name").agg(F.count(F.lit(1)).alias("pool_count")))
    return stats.join(distinct, "family_name", "left").withColumn(
        "pool_count", F.coalesce("pool_count", F.lit(0)))


def family_pass_pool(results: DataFrame, order_col="record_id") -> DataFrame:
    """Passed rows per family, first one per prompt inside the family."""
    passed = results.where(F.lower(text.strip("label")) == "pass").withColumn(
        "_text", text.strip("prompt")).where(F.col("_text") != "")
    winners = passed.groupBy("family_name", keys.digest("_text").alias("_d")).agg(
        F.min(order_col).alias(order_col)).select("family_name", order_col)
    return passed.join(winners, ["family_name", order_col], "left_semi").drop("_text")


def finalize_dimensions(results: DataFrame, family_dimensions: DataFrame) -> DataFrame:
    """Fan passed rows of a family out to its dimensions (a parameter table)."""
    passed = family_pass_pool(results)
    return passed.drop("dimension").join(family_dimensions, "family_name")


def rule_only_pool(source: DataFrame, base_tags, dimension, order_col="record_id",
                   signature=None) -> DataFrame:
    """Pool of a dimension that needs any base tag and no screening."""
    recalled = held(source, "semantic_tags").where(
        families.has_base_tags(base_tags, signature=signature, every=False))
    return clean.dedup_stripped(recalled, "prompt", order_col).withColumn(
        "dimension", F.lit(dimension)).withColumn("source_pool_mode", F.lit("rule_recall_only"))


def finalize_index(results: DataFrame, source: DataFrame, family_dimensions: DataFrame,
                   rule_tags=tuple(tx.RULE_ONLY_TAGS), rule_dimension=tx.RULE_ONLY_DIMENSION):
    """Final index: dimensions of every family (0 without passes) plus the rule-only one."""
    per_family = family_index(results).select("family_name", "pool_count")
    screened = family_dimensions.join(per_family, "family_name", "left").select(
        "dimension", F.coalesce("pool_count", F.lit(0)).alias("count"),
        F.col("family_name").alias("source_family"))
    recalled = held(source, "semantic_tags").where(
        families.has_base_tags(list(rule_tags), every=False))
    stripped = recalled.withColumn("prompt", text.strip("prompt")).where(F.col("prompt") != "")
    ruled = stripped.select(keys.digest("prompt").alias("_d")).distinct().agg(
        F.count(F.lit(1)).alias("count")).select(
        F.lit(rule_dimension).alias("dimension"), "count",
        F.lit("rule_recall_only").alias("source_family"))
    return screened.unionByName(ruled)


def word_piece_estimate(prompt) -> Column:
    """Token estimate without a tokenizer: word and punctuation pieces plus two end marks."""
    return F.size(F.regexp_extract_all(F.col(prompt), F.lit(r"[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+"),
                                       F.lit(0))) + 2


def token_limit(dimension="dimension", global_max=tx.GLOBAL_MAX_TOKENS,
                strict_max=tx.STRICT_MAX_TOKENS) -> Column:
    return F.when(F.col(dimension).isin(*tx.STRICT_DIMENSIONS), F.lit(strict_max)).otherwise(
        F.lit(global_max))


def within_token_budget(df: DataFrame, limit, measure=word_piece_estimate,
                        prompt="prompt") -> DataFrame:
    """Rows whose token count is within the limit; ``measure`` is any column function, for
    example a pandas UDF around a tokenizer."""
    return df.where(measure(prompt) <= limit)


def token_filter_summary(df: DataFrame, by=("dimension",), limit=None,
                         measure=word_piece_estimate, prompt="prompt") -> DataFrame:
    """Kept and dropped rows per dimension under its token limit, in one pass."""
    limit = token_limit() if limit is None else limit
    fits = df.withColumn("_fits", measure(prompt) <= limit).withColumn("max_tokens", limit)
    return fits.groupBy(*by, "max_tokens").agg(
        F.count_if("_fits").alias("kept"), F.count_if(~F.col("_fits")).alias("dropped_too_long"))


def routing_table(dimensions: DataFrame, routing: DataFrame) -> DataFrame:
    """Route of every dimension; the global pool where none is configured."""
    joined = dimensions.join(routing, "dimension", "left")
    empty = F.array().cast("array<string>")
    return joined.select(
        "dimension", F.coalesce("strategy", F.lit(tx.GLOBAL_POOL)).alias("strategy"),
        F.coalesce("base_tags", empty).alias("base_tags"), "shared_pool_family",
        F.coalesce("llm_screening_required", F.lit(False)).alias("llm_screening_required"),
        "turbo_pool_strategy")


def routing_status(routes: DataFrame, models: DataFrame, index: DataFrame) -> DataFrame:
    """Route of every (dimension, model) with the pool it would read from today."""
    return (routes.crossJoin(models).join(index, ["model_id", "dimension"], "left")
            .withColumn("pool_count", F.col("count"))
            .withColumn("current_mode", F.when(F.col("count").isNotNull(),
                                               F.lit("active_index_subpool"))
                        .otherwise(F.lit("fallback_runtime_filter"))).drop("count"))


def routing_warnings(dimensions: DataFrame, routing: DataFrame) -> DataFrame:
    """Dimensions missing in the configuration, and configured ones unknown to the taxonomy."""
    missing = dimensions.select("dimension").join(routing.select("dimension"), "dimension",
                                                  "left_anti")
    extra = routing.select("dimension").join(dimensions.select("dimension"), "dimension",
                                             "left_anti")
    return missing.select("dimension", F.lit("missing_in_config").alias("warning")).unionByName(
        extra.select("dimension", F.lit("extra_in_config").alias("warning")))


def screening_plan(routes: DataFrame) -> DataFrame:
    """Per family: its dimensions and the union of their recall tags, in first-seen order.

    ``routes`` carries ``ord``; the routing of dimensions is a parameter table.
    """
    listed = F.array_sort(F.collect_list(F.struct("ord", "dimension", "base_tags")))
    return (routes.where((F.col("strategy") == tx.RULE_THEN_SCREEN)
                         & F.col("shared_pool_family").isNotNull())
            .groupBy("shared_pool_family").agg(listed.alias("_l"))
            .select("shared_pool_family",
                    F.array_join(F.transform("_l", lambda s: s["dimension"]), ",").alias(
                        "dimensions"),
                    F.array_join(F.array_distinct(F.flatten(F.transform(
                        "_l", lambda s: s["base_tags"]))), ",").alias("union_rule_recall_tags")))


def screening_spec(routes: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per dimension: override where given, else the route, else the default of its strategy."""
    default_mode = F.when(F.col("strategy") == tx.RULE_THEN_SCREEN,
                          F.lit(tx.RULE_THEN_SCREEN)).otherwise(F.lit(tx.RULE_ONLY))
    # A named override decides the family even when it sets none.
    family = F.when(F.col("_named"), F.col("o_family")).otherwise(F.col("shared_pool_family"))
    return (routes.join(overrides.withColumn("_named", F.lit(True)), "dimension", "left")
            .withColumn("_named", F.coalesce("_named", F.lit(False)))
            .select("dimension", family.alias("shared_pool_family"),
                    F.coalesce("o_builder_mode", default_mode).alias("builder_mode"),
                    F.coalesce("o_screen", "llm_screening_required").alias("requires_llm_screen"),
                    F.coalesce("o_base_tags", "base_tags").alias("base_tags"),
                    F.coalesce("o_turbo", "turbo_pool_strategy").alias("turbo_pool_strategy")))


def build_targets(spec: DataFrame) -> DataFrame:
    return spec.select("dimension", F.col("builder_mode").alias("build_mode"),
                       "shared_pool_family", "turbo_pool_strategy",
                       F.concat("dimension", F.lit(".jsonl")).alias("filename"))


def without_incompatible_models(work: DataFrame) -> DataFrame:
    """Work items without the (model, dimension) combinations declared unusable."""
    banned = param_table(work.sparkSession, tx.INCOMPATIBLE_MODELS,
                         "model_id string, dimension string")
    return work.join(banned, ["model_id", "dimension"], "left_anti")


