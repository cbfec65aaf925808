"""Queries over booster removal, rule-based degradation, samples to a target distribution, finer
signature flags and score statistics."""

from pyspark.sql import functions as F

from promptmill.functions.text import SPACE_CHARS
from promptmill.operators import clean, compat, distribution, rewriting, runs, tagging
from promptmill.params import taxonomy as tx
from promptmill.plans.registry import query
from promptmill.plans.views import (QUOTED_SQL, SQL_PROMPTS, pick, q, sql_any, sql_list, sql_norm,
                                    sql_pick, sql_word, sql_words)

# Phrases that occur in the corpus; some hold shorter ones, and some follow each other.
PHRASES = ["of the", "the", "and the", "to", "on the", "in the", "the is", "der", "und die", "die",
           "de la", "la", "que", "el"]
SEED = 417


def sql_without(column: str, phrases) -> str:
    """The same steps as ``without_phrases``."""
    spaces = q("".join(c for c in SPACE_CHARS + ","))
    text = f"regexp_replace(coalesce({column}, ''), {q(rewriting.phrase_pattern(phrases))}, '\\1\\2', 'g')"
    for pattern, by in ((" *,(?: *,)+", ","), (" +,", ","), (" +", " ")):
        text = f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"
    return f"trim({text}, {spaces})"


@query("booster_free_prompts", "FN19", f"""
WITH {SQL_PROMPTS}, c AS (SELECT record_id, {sql_without('prompt', PHRASES)} AS clean,
  length(coalesce(prompt, '')) AS n FROM prompts)
SELECT record_id, md5(clean) AS prompt_md5, n - length(clean) AS removed_chars FROM c""")
def booster_free_prompts(v):
    rows = v.prompts().withColumn("clean", rewriting.without_phrases("prompt", PHRASES))
    return rows.select("record_id", F.md5("clean").alias("prompt_md5"),
                       (F.length(F.coalesce("prompt", F.lit(""))) - F.length("clean")).cast(
                           "long").alias("removed_chars"))


# ---- rule-based degradation ----------------------------------------------------------------------

KEYWORDS = [(d, s, words) for d, by_severity in {
    "blur": {"mild": ["slightly blurry", "soft focus"],
             "moderate": ["blurry", "out of focus", "soft", "hazy"],
             "severe": ["extremely blurry", "completely out of focus", "motion blur"]},
    "overexposure": {"mild": ["bright"], "moderate": ["overexposed", "washed out", "blown highlights"],
                     "severe": ["heavily overexposed", "pure white", "no detail", "glaring"]},
    "count_error": {"mild": ["one too many", "one missing"],
                    "moderate": ["wrong number", "extra copies", "duplicates"],
                    "severe": ["far too many", "uncountable", "crowded copies"]},
}.items() for s, words in by_severity.items()]
DEGRADED_DIMS = ["blur", "overexposure", "count_error", "text_error"]    # the last has no keywords


def _sql_fraction(name: str) -> str:
    return (f"CAST('0x' || substr(md5('{SEED}|' || record_id || '|{name}'), 1, 8) AS BIGINT) "
            "/ 4294967296.0")


_CASES = " ".join(f"WHEN dimension = {q(d)} AND severity = {q(s)} THEN {sql_list(sorted(set(w)))}"
                  for d, s, w in KEYWORDS)
SQL_DEGRADED = f"""named AS (SELECT record_id, prompt, {sql_pick(DEGRADED_DIMS, 'record_id')}
    AS dimension, {sql_pick(tx.SEVERITIES, 'record_id // 4')} AS severity FROM prompts),
listed AS (SELECT *, CASE {_CASES} END AS words, {sql_without('prompt', PHRASES)} AS clean,
  CASE WHEN {_sql_fraction('single')} < 0.5 THEN 1 WHEN {_sql_fraction('pair')} < 0.5 THEN 2
    ELSE 3 END AS n, {_sql_fraction('place')} < 0.7 AS behind FROM named),
drawn AS (SELECT *, coalesce(array_to_string(list_transform(list_sort(list_transform(words,
  lambda w: {{'h': md5('{SEED}|' || record_id || '|keyword|' || w), 'k': w}}))[1:n],
  lambda s: s.k), ', '), '') AS extra FROM listed),
degraded AS (SELECT record_id, dimension, severity, behind, least(n, coalesce(len(words), 0))
  AS n_keywords, CASE WHEN clean = '' THEN extra WHEN extra = '' THEN clean
  WHEN behind THEN clean || ', ' || extra ELSE extra || ', ' || clean END AS degraded FROM drawn)"""


def degraded_rows(v):
    rows = v.prompts().select(
        "record_id", "prompt", pick(DEGRADED_DIMS, F.col("record_id")).alias("dimension"),
        pick(tx.SEVERITIES, F.expr("record_id div 4")).alias("severity"))
    return rewriting.degraded(rows, KEYWORDS, SEED, boosters=PHRASES)


@query("degraded_prompts", "REW1", f"""
WITH {SQL_PROMPTS}, {SQL_DEGRADED} SELECT record_id, dimension, severity,
  CAST(n_keywords AS INTEGER) AS n_keywords, md5(degraded) AS prompt_md5 FROM degraded""")
def degraded_prompts(v):
    return degraded_rows(v).select("record_id", "dimension", "severity", "n_keywords",
                                   F.md5("degraded").alias("prompt_md5"))


@query("degradation_draws", "REW1", f"""
WITH {SQL_PROMPTS}, {SQL_DEGRADED} SELECT dimension, severity, CAST(n_keywords AS INTEGER)
  AS n_keywords, count(*) AS prompts FROM degraded GROUP BY 1, 2, 3""")
def degradation_draws(v):
    return degraded_rows(v).groupBy("dimension", "severity", "n_keywords").agg(
        F.count(F.lit(1)).alias("prompts"))


# ---- target distribution -------------------------------------------------------------------------

# Words that occur in the corpus, in the order of the rule; the last categories run short.
SUBJECT_WORDS = {
    "Space": ["worthless"], "Historical": ["apache"], "Vehicles": ["license"],
    "People": ["menschen", "mit der"], "Animals": ["dog", "hund"], "Nature": ["stone", "tree"],
    "Architecture": ["tower", "ciones"], "Events": ["ellement"], "Technology": ["&&&"],
    "Everyday Life": ["inn", "east"]}
SAMPLE_SIZE = 700


def _subject_case() -> str:
    rules = " ".join(f"WHEN {sql_any('low', words)} THEN {q(name)}"
                     for name, words in SUBJECT_WORDS.items())
    return f"CASE {rules} ELSE {q(distribution.DEFAULT_SUBJECT)} END"


_SHARES = ", ".join(f"({q(c)}, {w})" for c, w in distribution.SUBJECT_SHARES.items())
SQL_TAKES = f"""subjects AS (SELECT record_id, {_subject_case()} AS category
  FROM (SELECT record_id, lower(coalesce(prompt, '')) AS low FROM prompts)),
supply AS (SELECT s.category, s.weight, count(j.record_id) AS have
  FROM (VALUES {_SHARES}) s(category, weight) LEFT JOIN subjects j ON j.category = s.category
  GROUP BY 1, 2),
marked AS (SELECT *, sum(weight) OVER (ORDER BY have / weight, category ROWS BETWEEN CURRENT ROW AND
    UNBOUNDED FOLLOWING) AS weights, coalesce(sum(have) OVER (ORDER BY have / weight, category ROWS
    BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM supply),
judged AS (SELECT *, have * weights <= weight * ({SAMPLE_SIZE} - before) AS short FROM marked),
rest AS (SELECT {SAMPLE_SIZE} - coalesce(sum(have) FILTER (WHERE short), 0) AS remaining,
  sum(weight) FILTER (WHERE NOT short) AS open FROM judged),
parts AS (SELECT category, weight, have, short, CASE WHEN short THEN have
  ELSE weight * remaining // open END AS low, CASE WHEN short THEN -1
  ELSE weight * remaining % open END AS part, remaining FROM judged, rest),
ranked AS (SELECT *, remaining - sum(CASE WHEN short THEN 0 ELSE low END) OVER () AS spare,
  row_number() OVER (ORDER BY part DESC, category) AS place FROM parts),
takes AS (SELECT category, CAST(weight AS BIGINT) AS weight, CAST(have AS BIGINT) AS available,
  CAST(low + CASE WHEN NOT short AND place <= spare THEN 1 ELSE 0 END AS BIGINT) AS take
  FROM ranked)"""


def subjects(v):
    return compat.with_lower(v.prompts()).select(
        "record_id", distribution.subject_category("_lower", SUBJECT_WORDS).alias("category"))


@query("subject_apportionment", "SMP9 TAG7", f"""
WITH {SQL_PROMPTS}, {SQL_TAKES} SELECT * FROM takes""")
def subject_apportionment(v):
    from promptmill.session import param_table
    weights = param_table(v.spark, list(distribution.SUBJECT_SHARES.items()),
                          "category string, weight long")
    counts = subjects(v).groupBy("category").agg(F.count(F.lit(1)).alias("available"))
    rows = weights.join(counts, "category", "left").fillna(0, ["available"])
    return distribution.apportioned(rows, SAMPLE_SIZE)


@query("subject_sample", "SMP9 TAG7", f"""
WITH {SQL_PROMPTS}, {SQL_TAKES}, r AS (SELECT j.record_id, j.category, t.take, CAST(row_number()
  OVER (PARTITION BY j.category ORDER BY md5('{SEED}|' || j.category || '|' || j.record_id),
  j.record_id) AS INTEGER) AS sample_rank FROM subjects j JOIN takes t ON t.category = j.category)
SELECT record_id, category, sample_rank FROM r WHERE sample_rank <= take""")
def subject_sample(v):
    return distribution.distributed_sample(subjects(v), SAMPLE_SIZE, SEED)


# ---- word range of another library -----------------------------------------------------------------

@query("word_range_classes", "FLT27", f"""
WITH {SQL_PROMPTS}, w AS (SELECT source, {sql_words(sql_norm('prompt'))} AS n FROM prompts)
SELECT source, count(*) FILTER (WHERE n < 10) AS too_short, count(*) FILTER (WHERE n BETWEEN 10
  AND 100) AS library_range, count(*) FILTER (WHERE n BETWEEN 20 AND 80) AS synthetic_range,
  count(*) FILTER (WHERE n > 100) AS too_long FROM w GROUP BY 1""")
def word_range_classes(v):
    return clean.word_ranges(v.prompts())


# ---- finer flags and scores ------------------------------------------------------------------------

# Words of the corpus, one list for each flag.
FLAG_WORDS = {name: words for name, words in zip(tagging.SIGNATURE_WORDS, [
    ["hand", "mit"], ["license", "licensed"], ["idiot", "moron"], ["apache", "version"], ["lake"],
    ["one", "eine", "une"], ["and", "und"], ["in", "dans"], ["was", "is"], ["the", "der"],
    ["trash", "clown"]])}


def _sql_flag(name: str) -> str:
    test = sql_word("low", FLAG_WORDS[name])
    if name == "contains_explicit_text_literal":
        test = f"({test} OR regexp_matches(prompt, {QUOTED_SQL}))"
    return test


@query("signature_flags", "TAG9", f"""
WITH {SQL_PROMPTS}, l AS (SELECT source, coalesce(prompt, '') AS prompt,
  lower(coalesce(prompt, '')) AS low FROM prompts)
SELECT source, {', '.join(f'count(*) FILTER (WHERE {_sql_flag(n)}) AS {n}' for n in FLAG_WORDS)}
FROM l GROUP BY 1""")
def signature_flags(v):
    flagged = tagging.with_signature_flags(v.prompts(), FLAG_WORDS)
    return flagged.groupBy("source").agg(*[F.count_if(F.col(n)).alias(n) for n in FLAG_WORDS])


SQL_SCORED = """scored AS (SELECT l_returnflag AS severity, CAST(l_quantity / 50 AS DECIMAL(18, 4))
  AS positive_score, CAST(CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE l_discount * 8 END
  AS DECIMAL(18, 4)) AS negative_score FROM lineitem)"""


def scored_pairs(v):
    """Line items as pairs of scored images; some have no negative score."""
    return v.table("lineitem").select(
        F.col("l_returnflag").alias("severity"),
        (F.col("l_quantity") / 50).cast("decimal(18,4)").alias("positive_score"),
        F.when(F.col("l_linenumber") % 7 != 0, F.col("l_discount") * 8).cast(
            "decimal(18,4)").alias("negative_score"))


def _sql_scores(where: str) -> str:
    return f"""WITH {SQL_SCORED}, g AS (SELECT severity, count(*) AS total_pairs,
  CAST(sum(positive_score) AS DOUBLE) AS p, CAST(sum(negative_score) AS DOUBLE) AS n FROM scored
  WHERE negative_score IS NOT NULL AND {where} GROUP BY 1)
SELECT severity, total_pairs, round_even(p / total_pairs, 4) AS average_positive_score,
  round_even(n / total_pairs, 4) AS average_negative_score,
  round_even((p - n) / total_pairs, 4) AS average_score_difference FROM g"""


@query("score_statistics", "AGG23", _sql_scores("TRUE"))
def score_statistics(v):
    return runs.score_statistics(scored_pairs(v), ["severity"])


@query("score_gap_statistics", "FLT26 AGG23", _sql_scores("positive_score - negative_score >= 0.5"))
def score_gap_statistics(v):
    return runs.score_statistics(runs.score_gap_pairs(scored_pairs(v)), ["severity"])
