"""Views that present the driver's tables as prompt pools, screening results and run logs.

Every view exists twice: as a DataFrame (:class:`Views`) and as a SQL common table expression
(``SQL_*``), so that a query and its SQL twin start from the same rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions.text import SPACE
from promptmill.operators import compat, tagging
from promptmill.params import lexicon as lx
from promptmill.params import taxonomy as tx
from promptmill.session import param_table

# The corpus is invented prose: this lexicon uses words that occur in it as substrings.
LEXICON = {
    "has_person": ["there", "man"],
    "has_face": ["nose", "nest"],
    "has_hand": ["hand", "finger"],
    "has_full_body": ["stone", "tree"],
    "has_animal": ["dog", "sea"],
    "has_multiple_objects": ["near", "seat", "north"],
    "has_countable_objects": ["nine", "one"],
    "has_indoor_scene": ["inn"],
    "has_background": ["east"],
    "has_text": ["these", "board"],
    "has_reflective_surface": ["lea"],
    "has_logo_or_symbol": ["ring"],
    "has_structured_object": ["tin", "worth"],
}
MODELS = ["flux-schnell", "qwen-image-lightning", "sd3.5-large-turbo"]
RESULT_DIMENSIONS = ["body_proportion_error", "face_asymmetry", "hand_malformation",
                     "animal_anatomy_error"]
FAMILIES = list(tx.FAMILY_BASE_TAGS)
FAILURES = ["insufficient_effect", "style_drift", "content_drift"]


def pick(values, index):
    """Element of a fixed list by a non-negative number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def documents(self) -> DataFrame:
        return self.table("documents")

    def prompts(self) -> DataFrame:
        """Documents as prompts of five public sources, one of which holds almost half."""
        doc = F.col("doc_id")
        source = F.when(doc % 3 == 0, F.lit(tx.SOURCES[0])).otherwise(pick(tx.SOURCES, doc))
        return self.documents().select(
            doc.alias("record_id"), source.alias("source"), F.col("text").alias("prompt"), "lang")

    def tagged(self) -> DataFrame:
        return tagging.tag_candidates(self.prompts(), LEXICON)

    def macro_tagged(self) -> DataFrame:
        return tagging.with_macro_category(self.tagged())

    def subpools(self) -> DataFrame:
        return compat.dimension_subpools(self.tagged())

    def results(self) -> DataFrame:
        """Screening results of the labelled documents."""
        label = (F.when(F.col("quality") == 0, F.lit("fail"))
                 .when(F.col("toxic") == 1, F.lit("uncertain")).otherwise(F.lit("pass")))
        doc = F.col("doc_id")
        return self.table("documents").select("doc_id", "text").join(
            self.table("labels"), "doc_id").select(
            doc.alias("record_id"), pick(RESULT_DIMENSIONS, doc).alias("dimension"),
            pick(FAMILIES, doc).alias("family_name"), F.col("text").alias("prompt"),
            label.alias("label"))

    def pairs(self) -> DataFrame:
        """Pair log of the generation runs, one pair per event."""
        event, kind = F.col("event_id"), F.col("event_type")
        number = F.get_json_object("props", "$.k").cast("long")
        valid = ~kind.isin("error", "view")
        failure = (F.when(kind == "error", F.lit(FAILURES[0]))
                   .when((kind == "view") & (event % 5 != 0), pick(FAILURES, event)))
        return self.table("events").select(
            F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_dir"),
            F.concat(F.lit("pair-"), event.cast("string")).alias("pair_id"), event.alias("ord"),
            F.col("ts").cast("timestamp").alias("ts"),
            pick(MODELS, F.col("user_id")).alias("model_id"),
            pick(tx.DIMENSIONS, number).alias("dimension"),
            pick(tx.SEVERITIES, event).alias("severity"),
            F.concat(F.lit("prompt "), F.col("user_id").cast("string")).alias("positive_prompt"),
            F.col("user_id").alias("seed"), valid.alias("valid"), failure.alias("failure"),
            (valid & (event % 7 != 0)).alias("success"),
            (event % 3 + 1).alias("total_attempts"), F.col("value").alias("seconds"))

    def attempts(self) -> DataFrame:
        """Ordered attempts of a pair, one per conversation turn."""
        return attempts_of(self.table("conversations"))

    def runs(self) -> DataFrame:
        """Generation runs, one per order; its pairs are the order's line items."""
        lines = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.max("l_shipdate").alias("_end"), F.count(F.lit(1)).alias("total_pairs"),
            F.count_if(F.col("l_returnflag") != "R").alias("valid_pairs"))
        stamp = "yyyy-MM-dd'T'HH:mm:ss"
        return self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate").join(
            lines, "o_orderkey").select(
            F.col("o_orderkey").alias("run_dir"), pick(MODELS, F.col("o_custkey")).alias("model_id"),
            F.date_format("o_orderdate", stamp).alias("created_at"),
            F.date_format("_end", stamp).alias("completed_at"), "total_pairs", "valid_pairs",
            F.col("o_orderdate").cast("timestamp").alias("file_time"))

    def dimension_table(self) -> DataFrame:
        return param_table(self.spark, list(enumerate(tx.DIMENSIONS)),
                           "ord int, dimension string")

    def model_table(self) -> DataFrame:
        return param_table(self.spark, [(m,) for m in MODELS], "model_id string")

    def model_index(self) -> DataFrame:
        """Pool sizes per model and dimension: successful prompts of the pair log so far."""
        return self.pairs().where("success").groupBy("model_id", "dimension").agg(
            F.count(F.lit(1)).alias("count"))


def attempts_of(conversations: DataFrame) -> DataFrame:
    size, turn = F.length("text"), F.col("turn")
    kind = F.pmod(size + turn, F.lit(7))
    status = (F.when(size % 23 == 0, F.lit("skipped")).when(kind == 0, F.lit("success"))
              .when(kind == 1, F.lit("error")).otherwise(F.lit("failed")))
    failure = (F.when(size % 11 == 0, F.lit("positive_content_mismatch"))
               .when(kind == 2, F.lit("positive_incompatible"))
               .when(kind.isin(3, 6), F.lit("style_drift"))
               .when(kind == 4, F.lit("content_drift")).otherwise(F.lit("insufficient_effect")))
    style = F.when(size % 3 == 0, F.lit("realistic")).when(size % 3 == 1, F.lit("illustration"))
    return conversations.select(
        F.col("conv_id").alias("pair_id"), turn.cast("int").alias("attempt"),
        status.alias("status"), F.when(status == "failed", failure).alias("failure"),
        F.when(status == "failed", style).alias("style_type"),
        F.col("text").alias("negative_prompt"))


# --- the same views as SQL -------------------------------------------------------------------

def q(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def sql_pick(values, index: str) -> str:
    return f"list_extract({sql_list(values)}, CAST(({index}) % {len(values)} AS INT) + 1)"


def sql_norm(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{SPACE}+', ' ', 'g'))"


def sql_strip(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_words(norm: str) -> str:
    return f"(CASE WHEN {norm} = '' THEN 0 ELSE len(string_split({norm}, ' ')) END)"


def sql_any(low: str, words) -> str:
    return "(" + " OR ".join(f"contains({low}, {q(w.lower())})" for w in words) + ")"


def sql_word(low: str, words) -> str:
    """Whole-word test with letters of any script as word characters."""
    alternatives = "|".join(words)
    pattern = r"(^|[^\p{L}\p{M}\p{N}_])(" + alternatives + r")($|[^\p{L}\p{M}\p{N}_])"
    return f"regexp_matches({low}, {q(pattern)})"


def sql_phrase(low: str, phrases) -> str:
    return sql_word(low, [p.replace(" ", SPACE + "+") for p in phrases])


def sql_has(tag: str, tags="tags") -> str:
    return f"list_contains({tags}, {q(tag)})"


QUOTED_SQL = q("['\"][^'\"]{2,}['\"]")


def sql_tags(prompt: str, low: str, lex) -> str:
    tests = {t: sql_any(low, w) for t, w in lex.items()}
    tests[lx.QUOTED_TEXT_TAG] = f"regexp_matches({prompt}, {QUOTED_SQL})"
    entries = ", ".join(f"CASE WHEN {tests[t]} THEN {q(t)} END" for t in sorted(tests))
    return f"list_filter([{entries}], lambda t: t IS NOT NULL)"


SQL_PROMPTS = f"""prompts AS (
  SELECT doc_id AS record_id, CASE WHEN doc_id % 3 = 0 THEN {q(tx.SOURCES[0])}
         ELSE {sql_pick(tx.SOURCES, 'doc_id')} END AS source, text AS prompt, lang
  FROM documents)"""
SQL_TAGGED = f"""{SQL_PROMPTS}, lowered AS (SELECT *, lower(prompt) AS low FROM prompts),
tagged AS (SELECT *, {sql_tags('prompt', 'low', LEXICON)} AS tags FROM lowered)"""
SQL_RESULTS = f"""results AS (
  SELECT d.doc_id AS record_id, {sql_pick(RESULT_DIMENSIONS, 'd.doc_id')} AS dimension,
         {sql_pick(FAMILIES, 'd.doc_id')} AS family_name, d.text AS prompt,
         CASE WHEN quality = 0 THEN 'fail' WHEN toxic = 1 THEN 'uncertain' ELSE 'pass' END AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
SQL_PAIRS = f"""pairs AS (
  SELECT 'run-' || strftime(ts, '%Y-%m-%d') AS run_dir, 'pair-' || event_id AS pair_id,
    event_id AS ord, ts, {sql_pick(MODELS, 'user_id')} AS model_id,
    {sql_pick(tx.DIMENSIONS, "CAST(json_extract_string(props, '$.k') AS BIGINT)")} AS dimension,
    {sql_pick(tx.SEVERITIES, 'event_id')} AS severity, 'prompt ' || user_id AS positive_prompt,
    user_id AS seed, event_type NOT IN ('error', 'view') AS valid,
    CASE WHEN event_type = 'error' THEN {q(FAILURES[0])}
         WHEN event_type = 'view' AND event_id % 5 <> 0 THEN {sql_pick(FAILURES, 'event_id')}
         END AS failure,
    event_type NOT IN ('error', 'view') AND event_id % 7 <> 0 AS success,
    event_id % 3 + 1 AS total_attempts, value AS seconds
  FROM events)"""
SQL_ATTEMPTS = """sized AS (SELECT *, length(text) AS n, (length(text) + turn) % 7 AS kind
  FROM conversations),
judged AS (SELECT *, CASE WHEN n % 23 = 0 THEN 'skipped' WHEN kind = 0 THEN 'success'
  WHEN kind = 1 THEN 'error' ELSE 'failed' END AS status FROM sized),
attempts AS (SELECT conv_id AS pair_id, CAST(turn AS INT) AS attempt, status,
  CASE WHEN status <> 'failed' THEN NULL WHEN n % 11 = 0 THEN 'positive_content_mismatch'
       WHEN kind = 2 THEN 'positive_incompatible' WHEN kind IN (3, 6) THEN 'style_drift'
       WHEN kind = 4 THEN 'content_drift' ELSE 'insufficient_effect' END AS failure,
  CASE WHEN status <> 'failed' THEN NULL WHEN n % 3 = 0 THEN 'realistic'
       WHEN n % 3 = 1 THEN 'illustration' END AS style_type,
  text AS negative_prompt FROM judged)"""
SQL_RUNS = f"""runs AS (
  SELECT o_orderkey AS run_dir, {sql_pick(MODELS, 'o_custkey')} AS model_id,
         o_orderdate AS created_at, l.ended AS completed_at, total_pairs, valid_pairs
  FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS ended, count(*) AS total_pairs,
    count(*) FILTER (WHERE l_returnflag <> 'R') AS valid_pairs FROM lineitem GROUP BY 1) l
  ON o_orderkey = l_orderkey)"""


def sql_special(dimension: str, prompt="prompt", low="low", words=None) -> str:
    """Reason of the text rules, NULL when the prompt passes."""
    words = {**compat.RULE_WORDS, **(words or {})}
    if dimension == "text_error":
        return (f"(CASE WHEN NOT ((contains({prompt}, '''') OR contains({prompt}, '\"')) AND "
                f"{sql_word(low, words['visual_text'])}) THEN 'missing_quote_or_visual_text' END)")
    if dimension in compat.FACE_RULE_DIMENSIONS:
        return (f"(CASE WHEN {sql_word(low, words['back_view'])} THEN 'back_view' "
                f"WHEN {sql_word(low, words['animal'])} THEN 'non_human' "
                f"WHEN NOT ({sql_word(low, words['strong_face'])} AND "
                f"{sql_word(low, words['human'])}) THEN 'missing_face_or_human' END)")
    return "CAST(NULL AS VARCHAR)"


def sql_tags_ok(req, mode="all", tags="tags") -> str:
    if req is None or req.required is None or not (req.required or req.alternative):
        return "TRUE"
    glue = " AND " if mode == "all" else " OR "
    parts = [f"({glue.join(sql_has(t, tags) for t in req.required)})"] if req.required else ["TRUE"]
    parts += [sql_has(t, tags) for t in req.alternative]
    return "(" + " OR ".join(parts) + ")"


def sql_compatible(dimension: str, reqs=None, mode="all") -> str:
    req = (tx.REQUIREMENTS if reqs is None else reqs).get(dimension)
    return f"({sql_tags_ok(req, mode)} AND {sql_special(dimension)} IS NULL)"


def sql_subpools(dimensions=None) -> str:
    dims = list(dimensions or tx.REQUIREMENTS)
    parts = " UNION ALL ".join(
        f"SELECT record_id, source, prompt, low, tags, {q(d)} AS dimension FROM tagged "
        f"WHERE {sql_compatible(d)}" for d in dims)
    return f"{SQL_TAGGED}, subpools AS ({parts})"


MACRO_CASE = f"""CASE
  WHEN {sql_has('has_text')} OR {sql_has('has_logo_or_symbol')} OR
       {sql_any('low', lx.MACRO_TEXT_MEDIA)} THEN 'commercial_text_media'
  WHEN {sql_any('low', lx.MACRO_FOOD)} THEN 'food_tabletop'
  WHEN {sql_has('has_face')} OR {sql_any('low', lx.MACRO_PORTRAIT)} THEN 'human_portrait'
  WHEN {sql_has('has_person')} AND ({sql_any('low', lx.MACRO_ACTION)} OR
       {sql_has('has_multiple_objects')}) THEN 'human_activity_interaction'
  WHEN {sql_has('has_animal')} OR {sql_any('low', lx.MACRO_ANIMAL)} THEN 'animals_creatures'
  WHEN {sql_any('low', lx.MACRO_INDOOR)} THEN 'indoor_structured_space'
  WHEN {sql_any('low', lx.MACRO_URBAN)} THEN 'urban_built_outdoor'
  WHEN {sql_any('low', lx.MACRO_NATURE)} OR {sql_has('has_reflective_surface')}
    THEN 'natural_landscape'
  WHEN {sql_any('low', lx.MACRO_EVENT)} THEN 'events_performance_culture'
  ELSE 'objects_products_tools' END"""
SQL_MACRO = f"{SQL_TAGGED}, macro AS (SELECT *, {MACRO_CASE} AS macro_taxonomy FROM tagged)"
