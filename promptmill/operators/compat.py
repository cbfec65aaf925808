"""Prompt x dimension compatibility: predicates, coverage reports, matrices, subpools.

The dimensions are a few dozen parameters, so the product of prompts and dimensions is never
materialized: reports are one scan with one conditional count per dimension, and subpools explode
only the dimensions a prompt fits.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions import text
from promptmill.functions.text import col, contains_word
from promptmill.params import lexicon as lx
from promptmill.params import taxonomy as tx
from promptmill.params.taxonomy import Requirement

FACE_RULE_DIMENSIONS = ("face_asymmetry", "extra_limbs")


# Word lists of the text rules, by what they stand for.
RULE_WORDS = {"visual_text": lx.WORDS_VISUAL_TEXT, "back_view": lx.WORDS_BACK_VIEW,
              "animal": lx.WORDS_ANIMAL, "strong_face": lx.WORDS_STRONG_FACE,
              "human": lx.WORDS_HUMAN}


def special_rule_reason(dimension: str, prompt, lowered, words=None) -> Column:
    """Reason a prompt breaks the dimension's text rules; null when it passes."""
    prompt, lowered = col(prompt), col(lowered)
    words = {**RULE_WORDS, **(words or {})}

    def says(name):
        return contains_word(lowered, words[name])

    if dimension == "text_error":
        fits = text.has_quote_character(prompt) & says("visual_text")
        return F.when(~fits, F.lit("missing_quote_or_visual_text"))
    if dimension in FACE_RULE_DIMENSIONS:
        return (F.when(says("back_view"), F.lit("back_view"))
                .when(says("animal"), F.lit("non_human"))
                .when(~(says("strong_face") & says("human")), F.lit("missing_face_or_human")))
    return F.lit(None).cast("string")


def _has(tags, names, every: bool) -> Column:
    if names and isinstance(tags, str):
        glue = " AND " if every else " OR "
        return F.expr(glue.join(f"array_contains(`{tags}`, {text.literal(n)})" for n in names))
    tests = [F.array_contains(col(tags), n) for n in names]
    if not every:
        return text.any_of(tests)
    result = F.lit(True)
    for t in tests:
        result = result & t
    return result


def tags_satisfied(req: Requirement | None, tags, mode="all") -> Column:
    """Tag part of the compatibility rule.

    ``mode="all"`` asks for every required tag, ``mode="any"`` for one of them; one alternative
    tag is enough in either. Without required tags (null) alternatives are not looked at.
    """
    if req is None or req.required is None or not (req.required or req.alternative):
        return F.lit(True)
    required = _has(tags, req.required, mode == "all") if req.required else F.lit(True)
    return required | _has(tags, req.alternative, False)


def is_compatible(dimension, prompt, lowered, tags, requirements=None, mode="all") -> Column:
    """Row compatibility: tag rule first, then the text rules of the dimension."""
    reqs = tx.REQUIREMENTS if requirements is None else requirements
    fits = tags_satisfied(reqs.get(dimension), tags, mode)
    if dimension not in ("text_error", *FACE_RULE_DIMENSIONS):
        return fits
    return fits & special_rule_reason(dimension, prompt, lowered).isNull()


def batch_verdict(dimension, prompt, lowered, tags, requirements=None,
                  special_without_requirement=True) -> Column:
    """Verdict of the batch filter: ``ok``, ``untagged``, ``tags`` or ``special``.

    ``tags`` is null where the prompt is missing from the tag table. An empty requirement accepts
    everything; a null one runs the text rules only (or nothing in the older form).
    """
    reqs = tx.REQUIREMENTS if requirements is None else requirements
    req = reqs.get(dimension)
    special = special_rule_reason(dimension, prompt, lowered).isNotNull()
    if req is None or req.required is None:
        if not special_without_requirement:
            return F.lit("ok")
        return F.when(special, F.lit("special")).otherwise(F.lit("ok"))
    if not (req.required or req.alternative):
        return F.lit("ok")
    return (F.when(col(tags).isNull(), F.lit("untagged"))
            .when(~tags_satisfied(req, tags), F.lit("tags"))
            .when(special, F.lit("special"))
            .otherwise(F.lit("ok")))


def router_reason(dimension, tags, requirements=None) -> Column:
    """Router verdict: any required tag admits the prompt."""
    reqs = tx.REQUIREMENTS if requirements is None else requirements
    req = reqs.get(dimension)
    if req is None:
        return F.lit("no_requirements")
    if not req.required:
        return F.lit("preferred_only")
    return F.when(_has(tags, req.required, False), F.lit("ok")).otherwise(
        F.lit("missing_required:" + ",".join(req.required)))


def has_preferred(dimension, tags, requirements=None) -> Column:
    """True when a preferred tag is present or none is named; used for ranking."""
    reqs = tx.REQUIREMENTS if requirements is None else requirements
    req = reqs.get(dimension)
    if req is None or not req.preferred:
        return F.lit(True)
    return _has(tags, req.preferred, False)


def runtime_reason(dimension, lowered, tags) -> Column:
    """Run-time filter: any required tag, and an explicit animal for animal anatomy."""
    names = tx.RUNTIME_REQUIRED_TAGS.get(dimension, [])
    reason = F.when(F.lit(False), F.lit(""))
    if names:
        reason = reason.when(~_has(tags, names, False),
                             F.lit("missing_required_tags:" + ",".join(names)))
    if dimension == "animal_anatomy_error":
        reason = reason.when(~contains_word(lowered, lx.WORDS_ANIMAL_SUBJECT),
                             F.lit("missing_explicit_animal_subject"))
    return reason.otherwise(F.lit("ok"))


def with_lower(df: DataFrame, prompt="prompt") -> DataFrame:
    return df.withColumn("_lower", F.lower(F.coalesce(col(prompt), F.lit(""))))


def _one_row_to_dimensions(counted: DataFrame, dimensions, *extra) -> DataFrame:
    rows = ", ".join(f"struct({text.literal(d)} AS dimension, `n_{d}` AS available)"
                     for d in dimensions)
    return counted.select(*extra, F.expr(f"inline(array({rows}))"))


def count_per_dimension(df: DataFrame, dimensions, test) -> DataFrame:
    """``dimension, available, total`` from one scan; ``test(dimension)`` is the row predicate."""
    counted = df.agg(F.count(F.lit(1)).alias("total"),
                     *[F.count_if(test(d)).alias(f"n_{d}") for d in dimensions])
    return _one_row_to_dimensions(counted, dimensions, "total")


def gap_level(available) -> Column:
    a = col(available)
    return (F.when(a < 100, F.lit("scarce")).when(a < 500, F.lit("limited"))
            .when(a < 2000, F.lit("healthy")).otherwise(F.lit("strong")))


def coverage_report(df: DataFrame, dimensions=None, requirements=None, mode="all") -> DataFrame:
    """Compatible prompts per dimension with coverage, gap level and scarcity rank."""
    dims = list(dimensions or tx.DIMENSIONS)
    counts = count_per_dimension(with_lower(df), dims, lambda d: is_compatible(
        d, "prompt", "_lower", "semantic_tags", requirements, mode))
    rank = Window.orderBy("available", "dimension")  # one row per dimension
    return counts.select(
        "dimension", "available", "total", text.percent("available", "total").alias("coverage"),
        gap_level("available").alias("gap_level"),
        F.row_number().over(rank).alias("scarcity_rank"))


def router_coverage(df: DataFrame, dimensions=None, requirements=None) -> DataFrame:
    """Coverage under the router's any-required rule."""
    reqs = tx.REQUIREMENTS if requirements is None else requirements
    dims = list(dimensions or reqs)
    counts = count_per_dimension(df, dims, lambda d: router_reason(
        d, "semantic_tags", reqs).isin("ok", "no_requirements", "preferred_only"))
    return counts.select("dimension", "available", "total",
                         text.percent("available", "total").alias("coverage"))


def perspective_coverage(df: DataFrame, by_perspective) -> DataFrame:
    """Coverage per perspective and dimension: any required tag, else any alternative.

    ``by_perspective`` maps perspective -> dimension -> Requirement or None.
    """
    def kind(req):
        if req is None:
            return "none"
        return "required" if req.required else "preferred_only"

    rows, counts = [], [F.count(F.lit(1)).alias("total")]
    for p, dims in by_perspective.items():
        for d, req in dims.items():
            test = (tags_satisfied(req, "semantic_tags", "any") if kind(req) == "required"
                    else F.lit(True))
            counts.append(F.count_if(test).alias(f"{p}.{d}"))
            rows.append(F.struct(F.lit(p).alias("perspective"), F.lit(d).alias("dimension"),
                                 F.lit(kind(req)).alias("requirement"),
                                 F.col(f"`{p}.{d}`").alias("available")))
    percentage = F.when(F.col("requirement") == "required", text.percent("available", "total"))
    return (df.agg(*counts).select("total", F.inline(F.array(*rows)))
            .select("perspective", "dimension", "available", "requirement",
                    percentage.otherwise(F.lit(100.0)).alias("percentage")))


def macro_dimension_counts(df: DataFrame, dimensions=None, requirements=None,
                           mode="all") -> DataFrame:
    """``dimension, macro_taxonomy, available``: one partial count row per macro category."""
    dims = list(dimensions or tx.DIMENSIONS)
    counted = with_lower(df).groupBy("macro_taxonomy").agg(*[
        F.count_if(is_compatible(d, "prompt", "_lower", "semantic_tags", requirements, mode))
        .alias(f"n_{d}") for d in dims])
    return _one_row_to_dimensions(counted, dims, "macro_taxonomy")


def macro_dimension_matrix(df: DataFrame, dimensions=None, requirements=None,
                           mode="all") -> DataFrame:
    """Dimensions as rows, macro categories as columns, compatible prompts as cells."""
    long = macro_dimension_counts(df, dimensions, requirements, mode)
    wide = long.groupBy("dimension").pivot("macro_taxonomy", lx.MACRO_CATEGORIES).agg(
        F.sum("available"))
    cells = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in lx.MACRO_CATEGORIES]
    total = cells[0]
    for c in lx.MACRO_CATEGORIES[1:]:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return wide.select("dimension", total.alias("total_available"), *cells)


def fitting_dimensions(dimensions, requirements=None, mode="all", prompt="prompt",
                       lowered="_lower", tags="semantic_tags") -> Column:
    """Array of the dimensions a prompt fits."""
    return F.array_compact(F.array(*[
        F.when(is_compatible(d, prompt, lowered, tags, requirements, mode), F.lit(d))
        for d in dimensions]))


def dimension_subpools(df: DataFrame, dimensions=None, requirements=None,
                       mode="all") -> DataFrame:
    """Long table of (dimension, record): the input columns once per fitting dimension."""
    dims = list(dimensions or tx.REQUIREMENTS)
    return (with_lower(df)
            .withColumn("dimension", F.explode(fitting_dimensions(dims, requirements, mode)))
            .drop("_lower"))


def subpool_index(df: DataFrame, dimensions=None, requirements=None, mode="all") -> DataFrame:
    """Count per dimension without building the subpools; empty dimensions included."""
    dims = list(dimensions or tx.REQUIREMENTS)
    counts = count_per_dimension(with_lower(df), dims, lambda d: is_compatible(
        d, "prompt", "_lower", "semantic_tags", requirements, mode))
    return counts.select("dimension", F.col("available").alias("count"))


def pool_coverage(index: DataFrame, models: DataFrame, dimensions: DataFrame,
                  low_pool_threshold=2000) -> DataFrame:
    """Pool size per model and dimension with the warnings ``low_pool`` and ``missing``.

    ``index``: ``model_id, dimension, count``; the model x dimension grid is a parameter table.
    """
    grid = models.crossJoin(dimensions)
    joined = grid.join(index, ["model_id", "dimension"], "left")
    return joined.select(
        "model_id", "dimension", F.col("count").alias("pool_count"),
        F.when(F.col("count").isNull(), F.lit("missing"))
        .when(F.col("count") < low_pool_threshold, F.lit("low_pool"))
        .otherwise(F.lit("ok")).alias("warning"))


def guardrail_ok(dimension, template) -> Column:
    """Template holds every must-keep phrase and no must-avoid phrase of its dimension."""
    lowered = F.lower(col(template))
    result = F.when(F.lit(False), F.lit(True))
    for d, (keep, avoid) in tx.GUARDRAILS.items():
        ok = ~text.contains_any(lowered, avoid)
        for phrase in keep:
            ok = ok & lowered.contains(phrase)
        result = result.when(col(dimension) == d, ok)
    return result.otherwise(F.lit(True))


def select_dimensions(spark, filters=None) -> DataFrame:
    """Dimensions picked by perspective, sub-group or name, in order and without repeats."""
    from promptmill.session import param_table

    def resolve(name):
        if name in tx.TAXONOMY:
            return [d for d, level in tx.TAXONOMY[name] if level in ("L1", "L2")]
        if name in tx.SEMANTIC_SUBGROUPS:
            return [d for d in tx.SEMANTIC_SUBGROUPS[name] if d in tx.PERSPECTIVE_OF]
        return [name] if name in tx.PERSPECTIVE_OF else []

    names = dict.fromkeys(d for f in (filters or list(tx.TAXONOMY)) for d in resolve(f))
    return param_table(spark, [(i, d, tx.PERSPECTIVE_OF[d]) for i, d in enumerate(names)],
                       "ord int, dimension string, perspective string")
