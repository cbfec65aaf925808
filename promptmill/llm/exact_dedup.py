"""Exact dedup by content sort.

Rows are range-partitioned by the head of their normalised bytes and a hash of all of them (Spark
samples the splitters, which stay short however long the texts are), sorted externally, and each
row is compared in full with its neighbour: a run of equal texts is a window partition over the
whole text. The smallest (or largest) identifier of a run stays.

A text with very many copies would fill one range. Its copies are counted by hash before the sort;
a hash with more than a 4096th of all rows is salted by identifier, so its run is cut into several
parts of that size, and the parts' representatives, a bounded number, are compared once more.

Defined results: a null text counts as the empty text; a null identifier loses against any other;
of rows that share text and identifier one stays; extra columns are carried along; an empty table
gives an empty table.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole, written

HEAD = 32          # code points of a splitter
HOT_SHARE = 4096   # a text is hot from this part of all rows on


def unchanged(text: Column) -> Column:
    return text


def _order(key: str, keep: str):
    column = F.col(key)
    return column.asc_nulls_last() if keep == "smallest" else column.desc_nulls_last()


def sorted_runs(docs: DataFrame, key: str, text: str, normalise=unchanged,
                keep: str = "smallest") -> DataFrame:
    """The rows in content order with private columns: whole text ``_t``, hash ``_h``, part
    ``_salt`` (null unless hot), place in the run ``_place`` and identifier that stays ``_keep``.
    """
    rows = docs.withColumn("_t", whole(normalise(F.col(text))))
    rows = rows.withColumn("_h", F.xxhash64("_t")).withColumn("_head", F.substring("_t", 1, HEAD))
    share = max(64, docs.count() // HOT_SHARE)
    hot = (docs.select(F.xxhash64(whole(normalise(F.col(text)))).alias("_h"))
           .groupBy("_h").count().where(F.col("count") > share)
           .select("_h", F.ceil(F.col("count") / share).cast("int").alias("_parts")))
    # at most HOT_SHARE hashes can be hot
    rows = rows.join(F.broadcast(hot), "_h", "left")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(key, "_h"), F.col("_parts")).cast("int"))
    rows = rows.drop("_parts").repartitionByRange("_head", "_h", "_salt")
    run = Window.partitionBy("_head", "_h", "_salt", "_t").orderBy(_order(key, keep))
    return rows.withColumns({"_place": F.row_number().over(run),
                             "_keep": F.first(key).over(run)})


def mark_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    normalise=unchanged, keep: str = "smallest") -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256 of the normalised text."""
    runs = sorted_runs(docs.select(key, text), key, text, normalise, keep)
    marks = written(runs.select(
        F.col(key), F.sha2("_t", 256).alias("text_sha256"), "_salt", "_place", "_keep",
        F.when(F.col("_salt").isNotNull() & (F.col("_place") == 1), F.col("_t")).alias("_t")),
        "content-runs")
    # equal texts have been found by comparison; from here on the digest names them
    name = ["text_sha256", F.coalesce("_salt", F.lit(-1)).alias("_part")]
    marks = marks.select("*", name[1])
    parts = marks.groupBy("text_sha256", "_part").agg(
        F.max("_place").cast("long").alias("_rows"), F.first("_keep", True).alias("_keep"))
    same = Window.partitionBy("_t")
    best = F.max if keep == "largest" else F.min
    merged = (marks.where("_t IS NOT NULL").select("text_sha256", "_part", "_t")
              .join(parts, ["text_sha256", "_part"])
              .select("text_sha256", "_part", best("_keep").over(same).alias("_all_keep"),
                      F.sum("_rows").over(same).alias("_all_rows"),
                      F.row_number().over(same.orderBy(_order("_keep", keep), "_part"))
                      .alias("_rank")))
    groups = parts.join(merged, ["text_sha256", "_part"], "left").select(
        "text_sha256", "_part",
        F.coalesce("_all_keep", "_keep").alias("keep_id"),
        F.coalesce("_all_rows", "_rows").alias("group_size"),
        (F.coalesce("_rank", F.lit(1)) == 1).alias("_wins"))
    return marks.drop("_keep", "_t").join(groups, ["text_sha256", "_part"]).select(
        key, "keep_id", "group_size",
        (F.col("_wins") & (F.col("_place") == 1)).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 normalise=unchanged, keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns; the texts move once."""
    firsts = sorted_runs(docs, key, text, normalise, keep).where("_place = 1")
    again = Window.partitionBy("_t").orderBy(_order(key, keep), "_salt")
    hot = (firsts.where("_salt IS NOT NULL").withColumn("_place", F.row_number().over(again))
           .where("_place = 1"))
    return firsts.where("_salt IS NULL").unionByName(hot).select(*docs.columns)
