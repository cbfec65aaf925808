"""Readers: JSONL and JSON prompt files, tag tables, requirements, run logs, subpools."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions import keys, text
from promptmill.functions.plan import computed

PROMPT_SCHEMA = ("record_id long, source string, prompt string, text string, model string, "
                 "semantic_tags array<string>, tags array<string>, "
                 "signature map<string,boolean>, prompt_signature map<string,boolean>")


def read_jsonl(spark: SparkSession, path, schema: str) -> DataFrame:
    """Rows of JSON-lines files; blank lines are skipped and a broken line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_prompt_file(spark: SparkSession, path: str) -> DataFrame:
    """Raw items (one JSON text each) of a prompt file.

    A ``.jsonl`` file has one item per line. A ``.json`` file holds a list, or an object with a
    ``prompts`` list; such a document cannot be split, so it is a format for small files.
    """
    if path.rstrip("/").endswith(".jsonl"):
        lines = spark.read.text(path)
        return lines.where(text.strip("value") != "").select(text.strip("value").alias("item"))
    document = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", "array<string>")
    wrapped = F.from_json("value", "prompts array<string>")["prompts"]
    is_list = text.strip("value").startswith("[")
    return document.select(F.explode(F.when(is_list, listed).otherwise(wrapped)).alias("item"))


def item_fields(item) -> Column:
    """Fields of a prompt item that is an object; null for a plain string."""
    item = text.col(item)
    return F.when(text.strip(item).startswith("{"), F.from_json(item, PROMPT_SCHEMA))


def _plain_text(item) -> Column:
    """Text of a plain string item, with or without its JSON quotes."""
    unquoted = F.from_json(F.concat(F.lit("["), item, F.lit("]")), "array<string>")
    return F.when(item.startswith('"'), F.get(unquoted, F.lit(0))).otherwise(item)


def normalize_items(items: DataFrame, model_filter=None, item="item") -> DataFrame:
    """Fixed records from raw items, with ``drop_reason`` (null, ``model`` or ``invalid``).

    Fallbacks: ``text`` for ``prompt``, ``tags`` for ``semantic_tags``, ``signature`` for
    ``prompt_signature``. The model filter applies only to items that name a model.
    """
    fields = items.withColumn("_f", item_fields(item))
    model = text.strip("_f.model")
    prompt = F.when(F.col("_f").isNotNull(),
                    text.strip(F.coalesce("_f.prompt", "_f.text"))).otherwise(
        text.strip(_plain_text(F.col(item))))
    records = fields.select(
        *[c for c in items.columns if c != item], prompt.alias("prompt"),
        text.normalize_tags("_f.semantic_tags", "_f.tags").alias("semantic_tags"),
        F.coalesce("_f.prompt_signature", "_f.signature").alias("prompt_signature"),
        model.alias("model"))
    wrong_model = F.lit(False)
    if model_filter:
        wrong_model = (F.col("model") != "") & ~F.col("model").contains(model_filter)
    return computed(records, drop_reason=F.when(wrong_model, F.lit("model")).when(
        F.col("prompt") == "", F.lit("invalid")))


def drop_counts(normalized: DataFrame) -> DataFrame:
    reason = F.col("drop_reason")
    return normalized.agg(F.count_if(reason.isNull()).alias("kept"),
                          F.count_if(reason == "model").alias("dropped_by_model_filter"),
                          F.count_if(reason == "invalid").alias("dropped_invalid"))


def prompt_texts(items: DataFrame, item="item") -> DataFrame:
    """Prompt texts of items in any of the four accepted formats; texts are not stripped."""
    fields = items.withColumn("_f", item_fields(item))
    value = F.when(F.col("_f").isNotNull(), F.nullif(F.coalesce("_f.prompt", "_f.text"), F.lit(""))
                   ).otherwise(_plain_text(F.col(item)))
    return computed(fields, prompt=value).where(F.col("prompt").isNotNull()).drop("_f")


def tagged_map(df: DataFrame, order_col="record_id") -> DataFrame:
    """Tags per stripped prompt; the last row of a prompt counts."""
    stripped = df.withColumn("prompt", text.strip(F.coalesce("prompt", F.lit("")))).where(
        F.col("prompt") != "")
    last = stripped.groupBy(keys.digest("prompt").alias("_d")).agg(
        F.max(order_col).alias(order_col)).select(order_col)
    return stripped.join(last, order_col, "left_semi").select(
        "prompt", F.coalesce("semantic_tags", F.array().cast("array<string>")).alias(
            "semantic_tags"))


def tag_requirements(document) -> Column:
    """Rows of a two-level requirement document ``{category: {dimension: requirement}}``.

    Categories that start with an underscore are skipped; a requirement that is null or not an
    object asks for nothing.
    """
    levels = F.from_json(text.col(document), "map<string,map<string,string>>")
    body = "required array<string>, alternative array<string>, preferred array<string>"
    named = F.filter(F.map_entries(levels), lambda e: ~e["key"].startswith("_"))
    flat = F.flatten(F.transform(named, lambda c: F.transform(
        F.map_entries(c["value"]), lambda d: F.struct(
            c["key"].alias("category"), d["key"].alias("dimension"),
            F.from_json(d["value"], body).alias("req")))))
    return F.transform(flat, lambda r: F.struct(
        r["category"].alias("category"), r["dimension"].alias("dimension"),
        r["req"]["required"].alias("required"), r["req"]["alternative"].alias("alternative"),
        r["req"]["preferred"].alias("preferred")))


def read_requirements(spark: SparkSession, path: str) -> DataFrame:
    """Requirement file as ``category, dimension, required, alternative, preferred``.

    Spark reads it as one text; ``dimension_requirements`` may wrap the categories.
    """
    document = spark.read.text(path, wholetext=True)
    inner = F.coalesce(F.get_json_object("value", "$.dimension_requirements"), "value")
    return document.select(F.inline(tag_requirements(inner)))


def collect_generated(spark: SparkSession, paths, schema: str,
                      name="generated_positive_prompts.jsonl") -> DataFrame:
    """Generated prompt files below the given folders or files, each file once.

    Raises when nothing is found. ``file`` is the path a row came from.
    """
    paths = list(dict.fromkeys([paths] if isinstance(paths, str) else paths))
    folders = [p for p in paths if not p.endswith(".jsonl")]
    files = [p for p in paths if p.endswith(".jsonl")]
    parts = []
    if folders:
        parts.append(spark.read.schema(schema).option("mode", "FAILFAST")
                     .option("recursiveFileLookup", "true").option("pathGlobFilter", name)
                     .json(folders).withColumn("file", F.col("_metadata.file_path")))
    if files:
        direct = read_jsonl(spark, files, schema).withColumn("file", F.col("_metadata.file_path"))
        # A file below one of the folders was read already.
        if parts:
            direct = direct.join(parts[0].select("file").distinct(), "file", "left_anti")
        parts.append(direct)
    found = [f for part in parts for f in part.inputFiles()]
    if not found:
        raise FileNotFoundError(f"no {name} files found in {paths}")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def read_result_shards(spark: SparkSession, run_dir: str, schema: str,
                       name="family_screening_results.jsonl") -> DataFrame:
    """Result rows of a run: its single file, else all ``shard_*`` parts."""
    import os
    from py4j.protocol import Py4JError
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def glob(pattern):
        path = hadoop(os.path.join(run_dir, pattern))
        try:
            fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            found = fs.globStatus(path)
        except Py4JError as error:
            raise FileNotFoundError(run_dir) from error
        return [str(s.getPath()) for s in found or []]

    files = glob(name) or glob(f"shard_*/{name}")
    if not files:
        raise FileNotFoundError(f"no {name} found under {run_dir}")
    return read_jsonl(spark, files, schema)


PAIR_LOG_SCHEMA = (
    "pair_id string, model_id string, dimension string, expected_attribute string, "
    "severity string, positive_prompt string, seed long, success boolean, total_attempts long, "
    "attempts array<struct<attempt:int,status:string,failure_type:string,"
    "negative_prompt:string>>, final_validation struct<valid:boolean,failure:string>, "
    "judge_result struct<valid:boolean,failure:string>")
DATASET_SCHEMA = (
    "metadata struct<model_id:string,created_at:string,completed_at:string,total_pairs:long>, "
    "pairs array<struct<id:string,positive:struct<prompt:string>,negative:struct<prompt:string>,"
    "degradation:struct<attribute:string,severity:string>,"
    "validation:struct<valid:boolean,failure:string>>>")
REPORT_SCHEMA = "summary struct<total_pairs:long,valid_pairs:long,invalid_pairs:long>"


def _run_files(spark, root, name, schema):
    return (spark.read.schema(schema).option("multiLine", "true")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", name).json(root)
            .withColumn("run_dir", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))
            .withColumn("file_time", F.col("_metadata.file_modification_time")))


class RunArtifacts:
    """Tables over every run folder below a root that has all three artifacts."""

    def __init__(self, spark: SparkSession, root: str):
        dataset = _run_files(spark, root, "dataset.json", DATASET_SCHEMA)
        log = _run_files(spark, root, "full_log.json", PAIR_LOG_SCHEMA)
        report = _run_files(spark, root, "validation_report.json", REPORT_SCHEMA)
        # An empty log still is an artifact: its file is found by path, not by its rows.
        logged = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                  .option("pathGlobFilter", "full_log.json").load(root)
                  .select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias(
                      "run_dir")))
        self.runs = (dataset.drop("file_time").join(
            report.select("run_dir", "file_time", F.col("summary.total_pairs").alias(
                "total_pairs"), F.col("summary.valid_pairs").alias("valid_pairs")), "run_dir")
            .join(logged, "run_dir", "left_semi")
            .select("run_dir", F.col("metadata.model_id").alias("model_id"),
                    F.col("metadata.created_at").alias("created_at"),
                    F.col("metadata.completed_at").alias("completed_at"), "file_time",
                    F.coalesce("total_pairs", F.lit(0)).alias("total_pairs"),
                    F.coalesce("valid_pairs", F.lit(0)).alias("valid_pairs")))
        complete = self.runs.select("run_dir")
        self.log = log.drop("file_time").join(complete, "run_dir", "left_semi")
        pair = F.explode("pairs").alias("p")
        self.dataset_pairs = (dataset.join(complete, "run_dir", "left_semi")
                              .select("run_dir", pair).select(
            "run_dir", F.col("p.id").alias("pair_id"),
            F.col("p.positive.prompt").alias("d_prompt"),
            F.col("p.degradation.attribute").alias("d_attribute"),
            F.col("p.degradation.severity").alias("d_severity")).where("pair_id is not null"))


def read_subpool(spark: SparkSession, root: str, dimension: str = None) -> DataFrame:
    """Subpools written by :func:`write_subpools`; one dimension reads only its own folder."""
    pools = spark.read.parquet(root)
    return pools if dimension is None else pools.where(F.col("dimension") == dimension)
