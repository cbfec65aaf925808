"""Shared prompt-pool families: rule recall, candidates, light prefilter."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions import keys, text
from promptmill.functions.plan import computed
from promptmill.functions.text import col, contains_phrase
from promptmill.operators import clean
from promptmill.operators.ranking import unique_rank
from promptmill.params import lexicon as lx
from promptmill.params import taxonomy as tx
from promptmill.session import written


def has_flag(tag, tags="semantic_tags", signature=None) -> Column:
    """Tag present in the array or set in the signature map."""
    present = F.array_contains(col(tags), tag)
    if signature is None:
        return present
    return present | F.coalesce(F.element_at(col(signature), tag), F.lit(False))


def has_base_tags(names, tags="semantic_tags", signature=None, every=True) -> Column:
    tests = [has_flag(n, tags, signature) for n in names]
    if not every:
        return text.any_of(tests)
    result = F.lit(True)
    for t in tests:
        result = result & t
    return result


def family_reason(family, lowered, base_tags=None, tags="semantic_tags",
                  signature=None) -> Column:
    """First reason to keep a prompt out of the family; null for a candidate."""
    def flag(name):
        return has_flag(name, tags, signature)

    base = has_base_tags(tx.FAMILY_BASE_TAGS.get(family, []) if base_tags is None else base_tags,
                         tags, signature)
    if family == "human_full_body_realistic":
        readable = flag("has_full_body") | contains_phrase(lowered, lx.FAMILY_FULL_BODY)
        return (F.when(~base, F.lit("missing_base_tags"))
                .when(contains_phrase(lowered, lx.FAMILY_NON_NATURAL),
                      F.lit("contains_non_natural_or_identity_obscuring_human_presentation"))
                .when(contains_phrase(lowered, lx.FAMILY_MULTI_PERSON),
                      F.lit("contains_multi_person_signal"))
                .when(contains_phrase(lowered, lx.FAMILY_BED_OR_ADULT),
                      F.lit("contains_bed_or_adult_pose_signal"))
                .when(~readable, F.lit("insufficient_body_readability")))
    if family == "structured_object_primary":
        return (F.when(~base, F.lit("missing_base_tags"))
                .when(flag("has_person") | flag("has_animal"),
                      F.lit("contains_biological_primary_signal")))
    if family == "multi_object_reference":
        entity = text.any_of(flag(n) for n in tx.FAMILY_PREFILTER_ANY)
        related = flag("has_multiple_objects") | contains_phrase(lowered, lx.FAMILY_RELATION)
        return (F.when(~entity, F.lit("missing_entity_signal"))
                .when(~related, F.lit("insufficient_relation_or_reference_signal")))
    return F.when(~base, F.lit("missing_base_tags"))


def passes_prefilter(family, lowered, base_tags=None, tags="semantic_tags",
                     signature=None) -> Column:
    """Light prefilter before screening; relation hints count as substrings here."""
    if family != "multi_object_reference":
        names = tx.FAMILY_BASE_TAGS.get(family, []) if base_tags is None else base_tags
        return has_base_tags(names, tags, signature)
    entity = text.any_of(has_flag(n, tags, signature) for n in tx.FAMILY_PREFILTER_ANY)
    related = (has_flag("has_multiple_objects", tags, signature)
               | text.contains_any(lowered, lx.FAMILY_RELATION))
    return entity & related


def evaluated(df: DataFrame, family, base_tags=None, signature=None,
              order_col="record_id") -> DataFrame:
    """Distinct stripped prompts with ``reason`` (null for candidates) and the signals."""
    stripped = df.withColumn("prompt", text.strip("prompt"))
    unique = clean.dedup_stripped(stripped, "prompt", order_col, strip=False).withColumn(
        "_lower", F.lower("prompt"))
    names = tx.FAMILY_BASE_TAGS.get(family, []) if base_tags is None else base_tags
    base = has_base_tags(names, signature=signature)
    # Body signals belong to the people family and to rows that pass its base tags.
    body = F.lit(family == "human_full_body_realistic") & base
    return computed(
        unique, base_recall=base,
        reason=family_reason(family, "_lower", base_tags, signature=signature),
        has_full_body_signal=body & has_flag("has_full_body", signature=signature),
        keyword_body_readable=body & contains_phrase("_lower", lx.FAMILY_FULL_BODY),
        prompt_length=F.length("prompt")).drop("_lower")


def family_summary(df: DataFrame, family, base_tags=None, signature=None) -> DataFrame:
    """Base recall, candidates and body signals among the candidates."""
    kept = F.col("reason").isNull()
    return evaluated(df, family, base_tags, signature).agg(
        F.count_if("base_recall").alias("base_rule_recall_count"),
        F.count_if(kept).alias("candidate_count"),
        F.count_if(kept & F.col("has_full_body_signal")).alias("has_full_body_signal"),
        F.count_if(kept & F.col("keyword_body_readable")).alias("keyword_body_readable"))


def excluded_reasons(df: DataFrame, family, base_tags=None, signature=None) -> DataFrame:
    return (evaluated(df, family, base_tags, signature).where(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("prompts")))


def _ranked(candidates: DataFrame, family, digits, order_col):
    # Ranking reads its input three times (ids, counts, rows): the rules run once, into a file.
    candidates = written(candidates, f"{family}-candidates")
    ranked = unique_rank(candidates, order_col)
    return ranked.withColumn("family_name", F.lit(family)).withColumn(
        "sample_id", keys.sample_id("family_name", "rank", "prompt", digits))


def family_candidates(df: DataFrame, family, base_tags=None, signature=None,
                      order_col="record_id") -> DataFrame:
    """Candidates of the family rule in source order, with ranked sample ids."""
    kept = evaluated(df, family, base_tags, signature, order_col).where(
        F.col("reason").isNull()).drop("reason", "base_recall")
    return _ranked(kept, family, 12, order_col)


def prefiltered_candidates(df: DataFrame, family, base_tags=None, signature=None,
                           order_col="record_id") -> DataFrame:
    """Candidates of the light prefilter in source order, with ranked sample ids."""
    stripped = df.withColumn("prompt", text.strip("prompt"))
    unique = clean.dedup_stripped(stripped, "prompt", order_col, strip=False)
    lowered = unique.withColumn("_lower", F.lower("prompt"))
    kept = computed(lowered, _keep=passes_prefilter(
        family, F.col("_lower"), base_tags, signature=signature)).where("_keep").drop(
        "_lower", "_keep")
    return _ranked(kept, family, 16, order_col)
