"""Queries over screening requests, raw answers and screening results.

The raw answers are rendered from the labelled documents: twenty documents make one request, and
the text of a request takes one of the shapes answers really have (plain, fenced, prefixed,
broken).
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from promptmill.functions import answers
from promptmill.operators import screening
from promptmill.params import requests as rq
from promptmill.params import taxonomy as tx
from promptmill.plans.registry import query
from promptmill.plans.sampling_queries import SAMPLES_SQL, samples
from promptmill.plans.views import SQL_PAIRS, pick, q, sql_list, sql_pick

DIMS = ["hand_malformation", "text_error", "blur"]
ANSWER_LABELS = ["Pass", "uncertain", "REJECT"]


def screening_samples(v):
    """All documents as screening samples, twenty to a request."""
    doc = F.col("doc_id")
    return v.table("documents").select(
        F.floor(doc / 20).alias("request_id"), F.concat(F.lit("s"), doc.cast("string")).alias(
            "sample_id"), doc.alias("record_id"), pick(DIMS, F.floor(doc / 20)).alias("dimension"))


def raw_answers(v):
    """One answer per request over the labelled documents, in four shapes."""
    label = F.when(F.col("quality") == 0, F.lit(ANSWER_LABELS[2])).when(
        F.col("toxic") == 1, F.lit(ANSWER_LABELS[1])).otherwise(F.lit(ANSWER_LABELS[0]))
    doc = F.col("doc_id")
    item = F.struct(F.concat(F.lit("s"), doc.cast("string")).alias("sample_id"),
                    label.alias("label"), ((doc % 13) / 10).alias("confidence"),
                    F.concat(F.lit(" note "), doc.cast("string")).alias("reason"))
    # At most twenty items per request.
    grouped = v.table("labels").groupBy(F.floor(doc / 20).alias("request_id")).agg(
        F.array_sort(F.collect_list(item)).alias("items"))
    whole = F.to_json(F.struct(F.lit("x").alias("dimension"), F.col("items").alias("results")))
    kind = F.col("request_id") % 4
    shaped = (F.when(kind == 0, whole)
              .when(kind == 1, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
              .when(kind == 2, F.concat(F.lit("Here you go: "), F.to_json("items")))
              .otherwise(F.concat(F.substr(whole, F.lit(1), F.length(whole) - 2),
                                  F.lit(', {"sample_id": "s0", "label": "pa'))))
    usage = F.struct((F.size("items") * 7).cast("long").alias("prompt_tokens"),
                     F.when(kind != 3, F.col("request_id")).alias("completion_tokens"),
                     F.size("items").cast("long").alias("total_tokens"))
    return grouped.select("request_id", shaped.alias("raw_content"), usage.alias("usage"))


ANSWERED_SQL = f"""samples AS (SELECT doc_id // 20 AS request_id, 's' || doc_id AS sample_id,
  doc_id, {sql_pick(DIMS, 'doc_id // 20')} AS dimension FROM documents),
items AS (SELECT doc_id // 20 AS request_id, 's' || doc_id AS sample_id, CASE WHEN quality = 0 THEN
    'fail' WHEN toxic = 1 THEN 'uncertain' ELSE 'pass' END AS label,
  least(1.0::DOUBLE, (doc_id % 13) / 10) AS confidence, 'note ' || doc_id AS reason FROM labels),
rows AS (SELECT s.dimension, s.request_id, s.sample_id, coalesce(i.label, 'uncertain') AS label,
  coalesce(i.confidence, 0.0::DOUBLE) AS confidence,
  coalesce(i.reason, 'missing_in_model_output') AS reason FROM samples s LEFT JOIN items i
  ON i.request_id = s.request_id AND i.sample_id = s.sample_id AND s.request_id % 4 <> 3)"""


def screened(v):
    return screening.screened_rows(screening_samples(v), screening.parse_answers(
        raw_answers(v).drop("usage")))


@query("screened_samples", "PRS1 JN4 FN14 FN15 FN16", f"""
WITH {ANSWERED_SQL} SELECT *, label IN ('pass', 'uncertain') AS keep_by_policy FROM rows""")
def screened_samples(v):
    return screened(v).select("dimension", "request_id", "sample_id", "label", "confidence",
                              "reason", "keep_by_policy")


@query("screening_summary", "AGG16", f"""
WITH {ANSWERED_SQL}, g AS (SELECT dimension, count(*) FILTER (WHERE label = 'pass') AS pass_count,
  count(*) FILTER (WHERE label = 'fail') AS fail_count, count(*) FILTER (WHERE label = 'uncertain')
    AS uncertain_count, count(*) FILTER (WHERE label <> 'fail') AS keep_count,
  count(*) AS total_count FROM rows GROUP BY 1)
SELECT *, {', '.join(f"round_even({n}_count / total_count, 4) AS {n}_rate"
                     for n in ('keep', 'pass', 'fail', 'uncertain'))} FROM g""")
def screening_summary(v):
    return screening.screening_summary(screened(v))


@query("usage_totals", "AGG16", """
WITH r AS (SELECT doc_id // 20 AS request_id, count(*) AS n FROM labels GROUP BY 1)
SELECT count(*) AS request_count, CAST(sum(n * 7) AS BIGINT) AS prompt_tokens,
  CAST(sum(request_id) FILTER (WHERE request_id % 4 <> 3) AS BIGINT) AS completion_tokens,
  CAST(sum(n) AS BIGINT) AS total_tokens FROM r""")
def usage_totals(v):
    return screening.usage_totals(raw_answers(v))


@query("family_screened_samples", "PRS2 JN4", f"""
WITH {ANSWERED_SQL} SELECT s.request_id, s.sample_id, CASE WHEN i.label = 'pass' THEN 'pass'
  ELSE 'fail' END AS label, coalesce(i.reason, 'missing_in_model_output') AS reason,
  coalesce(i.label, '') = 'pass' AS keep_by_policy
FROM samples s LEFT JOIN items i ON i.request_id = s.request_id AND i.sample_id = s.sample_id""")
def family_screened_samples(v):
    answered = screening.parse_family_answers(raw_answers(v).drop("usage"))
    return screening.family_screened_rows(screening_samples(v), answered).select(
        "request_id", "sample_id", "label", "reason", "keep_by_policy")


@query("unfinished_samples", "JN8", f"""
WITH {ANSWERED_SQL} SELECT sample_id, dimension FROM samples WHERE sample_id NOT IN
  (SELECT sample_id FROM items WHERE label = 'pass')""")
def unfinished_samples(v):
    done = v.table("labels").where("quality <> 0 and toxic <> 1").select(
        F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("sample_id"))
    return screening.unfinished(screening_samples(v), done).select("sample_id", "dimension")


@query("reused_answers", "JN8", f"""
WITH {SQL_PAIRS}, cache AS (SELECT positive_prompt, severity, arg_max(CASE WHEN ord % 10 = 0 THEN
    ' ' ELSE pair_id END, ord) AS cached_negative FROM pairs WHERE success GROUP BY 1, 2)
SELECT p.pair_id, c.cached_negative, trim(coalesce(c.cached_negative, '')) = '' AS needs_call
FROM pairs p LEFT JOIN cache c ON c.positive_prompt = p.positive_prompt
  AND c.severity = p.severity""")
def reused_answers(v):
    pairs = v.pairs()
    cache = pairs.where("success").select(
        "ord", "positive_prompt", "severity",
        F.when(F.col("ord") % 10 == 0, F.lit(" ")).otherwise(F.col("pair_id")).alias(
            "negative_prompt"))
    tasks = pairs.select("pair_id", "positive_prompt", "severity")
    return screening.reuse_cached(tasks, cache).select("pair_id", "cached_negative", "needs_call")


@query("screening_requests", "QTA10", f"""
WITH {SAMPLES_SQL}, b AS (SELECT dimension, CAST((rank - 1) // 20 + 1 AS INT) AS batch_no, rank,
  '- sample_id="' || sample_id || '" prompt="' || prompt || '"' AS line FROM named)
SELECT dimension, batch_no, count(*) AS batch_size, md5('Target dimension: ' || dimension || chr(10)
  || {q(chr(10).join(rq.screening_lines('lenient')))} || chr(10) ||
  string_agg(line, chr(10) ORDER BY rank)) AS request_md5 FROM b GROUP BY 1, 2""")
def screening_requests(v):
    return screening.screening_requests(samples(v)).select(
        "dimension", "batch_no", "batch_size", F.md5("user_prompt").alias("request_md5"))


FAMILY_OF = {d: f for f, dims in tx.FAMILY_DIMENSIONS.items() for d in dims}
FAMILY_HEADS = ", ".join(
    f"({q(f)}, {q(chr(10).join(rq.family_lines(f, *rq.FAMILY_GOALS[f], dims)))})"
    for f, dims in tx.FAMILY_DIMENSIONS.items())


@query("family_requests", "QTA10", f"""
WITH {SAMPLES_SQL}, heads(family_name, head) AS (VALUES {FAMILY_HEADS}),
of(dimension, family_name) AS (VALUES {", ".join(f"({q(d)}, {q(f)})" for d, f in FAMILY_OF.items())}),
placed AS (SELECT of.family_name, n.sample_id, n.prompt, row_number() OVER (PARTITION BY
  of.family_name ORDER BY n.dimension, n.rank) AS place FROM named n JOIN of
  ON of.dimension = n.dimension),
b AS (SELECT family_name, CAST((place - 1) // 20 + 1 AS INT) AS batch_no, place,
  '- sample_id="' || sample_id || '" prompt="' || prompt || '"' AS line FROM placed)
SELECT b.family_name, batch_no, count(*) AS batch_size, md5(any_value(head) || chr(10) ||
  string_agg(line, chr(10) ORDER BY place)) AS request_md5
FROM b JOIN heads h ON h.family_name = b.family_name GROUP BY 1, 2""")
def family_requests(v):
    """The samples of all dimensions that share a family are screened together."""
    family = F.create_map(*[F.lit(x) for pair in FAMILY_OF.items() for x in pair])
    rows = samples(v).withColumn("family_name", F.element_at(family, F.col("dimension"))).where(
        "family_name IS NOT NULL")
    # at most 45 samples of each dimension
    place = F.row_number().over(Window.partitionBy("family_name").orderBy("dimension", "rank"))
    return screening.shared_family_requests(
        rows.withColumn("rank", place), tx.FAMILY_DIMENSIONS).select(
        "family_name", "batch_no", "batch_size", F.md5("user_prompt").alias("request_md5"))


@query("parsed_prompt_lists", "PRS3", """
WITH r AS (SELECT l_orderkey, list('item ' || l_partkey ORDER BY l_partkey, l_linenumber) AS items
  FROM lineitem GROUP BY 1)
SELECT l_orderkey AS request_id, unnest(items) AS prompt, unnest(range(len(items))) AS position
FROM r""", ints="position")
def parsed_prompt_lists(v):
    """Generation answers rendered from the line items of an order, in four shapes; every fifth
    answer holds one prompt more than its request asked for."""
    parts = v.table("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(
        F.struct("l_partkey", "l_linenumber"))).alias("p"))  # a handful of lines per order
    items = F.transform("p", lambda s: F.concat(F.lit("item "), s["l_partkey"].cast("string")))
    more = F.when(F.col("l_orderkey") % 5 == 0, F.array(F.lit("one more"))).otherwise(
        F.array().cast("array<string>"))
    named = parts.select(F.col("l_orderkey").alias("request_id"), F.size("p").alias("asked"),
                         F.concat(items, more).alias("items"))
    array = F.to_json("items")
    kind = F.col("request_id") % 4
    numbered = F.transform("items", lambda x, i: F.concat(
        F.when(i % 2 == 0, F.lit("- ")).otherwise(
            F.concat((i + 10).cast("string"), F.lit(". "))), x))
    raw = (F.when(kind == 0, array)
           .when(kind == 1, F.concat(F.lit("```json\n"), array, F.lit("\n```")))
           .when(kind == 2, F.concat(F.lit("Prompts:\n"), array, F.lit(" done")))
           .otherwise(F.concat(F.lit("```\n"), F.array_join(numbered, "\n\n"), F.lit("\n```"))))
    return screening.parse_prompt_answers(
        named.select("request_id", "asked", raw.alias("raw_content")), "asked").drop("asked")


@query("judge_answers", "PRS4 PRS5", f"""
WITH {SQL_PAIRS}, k AS (SELECT *, ord % 5 AS kind, seconds AS score,
  {sql_list(['style moved', 'content moved', '风格', 'faint'])}[ord % 4 + 1] AS notes FROM pairs)
SELECT pair_id, CASE WHEN kind = 4 THEN FALSE ELSE valid END AS valid,
  'painting' AS style_type, CASE WHEN kind <> 4 AND valid THEN NULL
  WHEN kind = 4 THEN 'unknown' WHEN contains(notes, 'style') OR contains(notes, '风格')
    THEN 'style_drift' WHEN contains(notes, 'content') THEN 'content_drift'
  ELSE 'insufficient_effect' END AS failure, notes,
  CASE WHEN kind = 2 THEN 0.0::DOUBLE ELSE score END AS content_preservation,
  0.0::DOUBLE AS style_consistency FROM k""")
def judge_answers(v):
    """Judge answers rendered from the pair log: intact, fenced, truncated, untidy, unreadable."""
    kind = F.col("ord") % 5
    notes = pick(["style moved", "content moved", "风格", "faint"], F.col("ord"))
    score = F.col("seconds")
    fields = F.concat(F.lit('"valid": '), F.col("valid").cast("string"),
                      F.lit(', "style_type": "painting", "notes": "'), notes, F.lit('"'))
    scores = F.concat(F.lit('"scores": {"content_preservation": '), score.cast("string"),
                      F.lit("}"))
    whole = F.concat(F.lit("{"), fields, F.lit(", "), scores, F.lit("}"))
    raw = (F.when(kind == 0, whole)
           .when(kind == 1, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
           .when(kind == 2, F.concat(F.lit("{"), fields, F.lit(', "recommended_st')))
           .when(kind == 3, F.concat(F.lit("Verdict: {"), fields, F.lit(", "), scores,
                                     F.lit(",\n}")))
           .otherwise(F.concat(F.lit('{"style_type": "painting" "notes": "'), notes,
                               F.lit('" '), scores, F.lit("}"))))
    rendered = v.pairs().select("pair_id", raw.alias("raw"))
    return answers.with_judge_verdict(rendered, "raw").select(
        "pair_id", "valid", "style_type", "failure", "notes", "content_preservation",
        "style_consistency")
