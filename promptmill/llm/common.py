"""Helpers shared by the operators of this subpackage."""

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word of most contracts: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach.

    ``spark.checkpoint.dir`` as the session names it, else the context's checkpoint folder. Without
    either, a local session gets a temporary folder that goes with the process; a cluster session
    uses the warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    root = root or context.getCheckpointDir()
    if not root and context.master.startswith("local") and "cluster" not in context.master:
        root = tempfile.mkdtemp(prefix="promptmill-llm-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
    return root or spark.conf.get("spark.sql.warehouse.dir")


def new_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "promptmill-llm", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read back: a cut of the lineage that
    survives the loss of executors."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents_only(df: DataFrame) -> DataFrame:
    """The columns of documents, others dropped."""
    return df.select(*[c for c in DOCUMENT_COLUMNS if c in df.columns])
