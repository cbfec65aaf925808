"""Session helpers: defaults for a new session, parameter tables, shared work folders."""

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A parameter table of up to so many rows is marked for broadcast.
MAX_PARAM_ROWS = 20_000


def build_session(app="promptmill", master=None, **conf) -> SparkSession:
    """A session with the settings the operators assume; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def param_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A table of parameters as a local relation, marked for broadcast while it is small."""
    rows = [tuple(r) for r in rows]
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [[r[i] for r in rows] for i in range(len(struct))]
    arrow_schema = to_arrow_schema(struct)
    table = pa.table([pa.array(c, type=f.type) for c, f in zip(columns, arrow_schema)],
                     schema=arrow_schema)
    params = spark.createDataFrame(table, schema=struct)
    return F.broadcast(params) if len(rows) <= MAX_PARAM_ROWS else params


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Where no checkpoint folder is set and the master is local (tests, laptops) a temporary one is
    set once.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="promptmill-"))
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path for a written table below the shared folder."""
    return os.path.join(shared_root(spark), "promptmill", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Used where several outputs hang on one costly table: the lineage is cut at a file that
    survives the loss of an executor.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
