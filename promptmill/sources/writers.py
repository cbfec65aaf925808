"""Writers: JSON lines, append sinks, partitioned subpools with their index, run datasets."""

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, mode="errorifexists") -> None:
    """JSON-lines folder with null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, mode="append")


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_files(spark, count: int):
    """A task keeps up to ``count`` folders open while it writes, instead of sorting its rows by
    folder first; a session's own number stays."""
    before = spark.conf.get(OPEN_FILES)
    if before == "0":
        spark.conf.set(OPEN_FILES, str(count))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def write_subpools(subpools: DataFrame, root: str, rows_per_file=2_000_000) -> DataFrame:
    """Long subpool table as one folder per dimension, and the index of counts.

    Every task writes into the folders of the dimensions it holds, so a dimension with a third of
    all rows is written by many tasks. A prompt comes once for every dimension it fits, so the rows
    are not sorted (they would spill) and lie in small row groups.
    """
    pools = os.path.join(root, "dimension_subpools")
    with open_files(subpools.sparkSession, 64):
        (subpools.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
         .option("compression", "zstd").option("parquet.block.size", str(16 << 20))
         .partitionBy("dimension").parquet(pools))
    written = subpools.sparkSession.read.parquet(pools)
    index = written.groupBy("dimension").agg(F.count(F.lit(1)).alias("count")).withColumn(
        "filename", F.concat(F.lit("dimension="), "dimension"))
    index.write.mode("overwrite").json(os.path.join(root, "index"))
    return subpools.sparkSession.read.schema("dimension string, count long, filename string").json(
        os.path.join(root, "index"))


def write_run(log: DataFrame, root: str) -> None:
    """Pair log, the dataset of its successful pairs, and the validation report of a run: totals,
    the splits by dimension and degradation level, and the failures by type."""
    from promptmill.operators.runs import (failure_patterns, validation_breakdown,
                                           validation_summary)
    log.write.mode("overwrite").parquet(os.path.join(root, "full_log"))
    saved = log.sparkSession.read.parquet(os.path.join(root, "full_log"))
    saved.where("success").write.mode("overwrite").parquet(os.path.join(root, "dataset"))
    validation_summary(saved).write.mode("overwrite").json(os.path.join(root, "validation_report"))
    # a log may lack columns of the splits
    for name in ("dimension", "severity", "model_id", "failure"):
        if name not in saved.columns:
            saved = saved.withColumn(name, F.lit(None).cast("string"))
    validation_breakdown(saved).write.mode("overwrite").option("ignoreNullFields", "false").json(
        os.path.join(root, "validation_breakdown"))
    failure_patterns(saved).where("model_id = '*'").select("failure", "pairs").write.mode(
        "overwrite").json(os.path.join(root, "failure_types"))
