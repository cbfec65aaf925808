"""A keyed table kept in buckets: a change rewrites only the buckets it touches.

Every change is a version. Its bucket folders hold the whole buckets it touched, and its manifest
says for every bucket which version holds it; a version counts once its manifest is there, so a
change that fails midway leaves the table as it was, and one that is run again replaces its own
folders. Earlier versions stay readable.
"""

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.session import written

MANIFEST = "bucket int, held_by long"


class BucketedTable:
    """``key`` columns say which rows a change replaces, and with a hash the bucket.

    ``spread`` (with the columns that spread rows) gives every key so many buckets, for keys that
    may hold a large part of the table. ``buckets`` is fixed with the first version.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, key, buckets=64, spread=1,
                 spread_by=()):
        if buckets % spread:
            raise ValueError("buckets must be a multiple of spread")
        self.spark, self.root, self.key = spark, root, list(key)
        self.schema = T.StructType.fromDDL(schema)
        self.buckets, self.spread, self.spread_by = buckets, spread, list(spread_by)

    def _first_bucket(self):
        """The first of the buckets of a key."""
        groups = F.lit(self.buckets // self.spread)
        return (F.pmod(F.xxhash64(*self.key), groups) * self.spread).cast("int")

    def _bucket(self):
        if self.spread == 1:
            return self._first_bucket()
        part = F.pmod(F.xxhash64(*self.spread_by, F.lit(1)), F.lit(self.spread))
        return (self._first_bucket() + part).cast("int")

    def _path(self, *parts) -> str:
        return os.path.join(self.root, *parts)

    def version(self) -> int:
        """The newest version, 0 before the first change."""
        try:
            found = self.spark.read.schema(f"{MANIFEST}, version long").parquet(
                self._path("manifest")).agg(F.max("version")).first()[0]
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            found = None
        return found or 0

    def manifest(self, version: int) -> dict:
        """bucket -> version that holds it; empty buckets are left out."""
        if not version:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(
            self._path("manifest", f"version={version}")).collect()
        return {r["bucket"]: r["held_by"] for r in rows if r["held_by"] is not None}

    def read(self, version: int | None = None, only=None) -> DataFrame:
        """The table as of a version (default: the newest); ``only`` names buckets."""
        held = self.manifest(self.version() if version is None else version)
        paths = [self._path("data", f"version={v}", f"bucket={b}") for b, v in held.items()
                 if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return (self.spark.read.schema(self.schema).option("basePath", self._path("data"))
                .parquet(*paths).select(*self.schema.names))

    def _touched(self, changed: DataFrame) -> set:
        """All buckets of the keys that occur."""
        first = {r[0] for r in changed.select(self._first_bucket()).distinct().collect()}
        return {b + i for b in first for i in range(self.spread)}

    def _same_key(self):
        return [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.key]

    def matching(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of the table whose key occurs in ``rows``; only their buckets are read."""
        changed = rows.select(*self.key).distinct()
        held = self.read(version, self._touched(changed))
        return held.alias("o").join(changed.alias("c"), self._same_key(), "left_semi")

    def change(self, rows: DataFrame, gone: DataFrame | None = None,
               after: int | None = None) -> int:
        """Rows of the table whose key occurs in ``rows`` or ``gone`` give way to ``rows``.

        Returns the new version. Repeated rows of one key are all kept, as given. ``after`` names
        the version to change (default: the newest); the same change made again after the same
        version replaces the version it made.
        """
        rows = written(rows.select(*self.schema.names), "changed-rows")
        changed = rows.select(*self.key)
        if gone is not None:
            changed = changed.unionByName(gone.select(*self.key))
        changed = changed.distinct()
        touched = self._touched(changed)
        before = self.version() if after is None else after
        held, now = self.manifest(before), before + 1
        old = self.read(before, touched).alias("o").join(
            changed.alias("c"), self._same_key(), "left_anti")
        path = self._path("data", f"version={now}")
        (old.unionByName(rows).withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(path))
        whole = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        filled = {r[0] for r in self.spark.read.schema(whole).parquet(path)
                  .select("bucket").distinct().collect()}
        held = {b: v for b, v in held.items() if b not in touched} | {b: now for b in filled}
        listed = [(b, held.get(b)) for b in range(self.buckets)]
        (self.spark.createDataFrame(listed, MANIFEST).coalesce(1).write.mode("overwrite")
         .parquet(self._path("manifest", f"version={now}")))
        return now
