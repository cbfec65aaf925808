"""Merging shards that were generated apart: new identifiers, and shards whose seeds collide."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16      # local identifiers, or shards, of one sort at most


def _earlier(n, window):
    return F.coalesce(F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _with_offsets(counts: DataFrame, shard: str, rows: str, name: str) -> DataFrame:
    """Adds the rows of all shards with a smaller number: sums of blocks of shards first, then the
    shards inside each block."""
    counts = counts.withColumn("_block", F.shiftright(F.col(shard).cast("long"), BLOCK_BITS))
    blocks = counts.groupBy("_block").agg(F.sum(rows).alias("_all"))
    blocks = blocks.select("_block", _earlier("_all", Window.orderBy("_block")).alias("_before"))
    inside = _earlier(rows, Window.partitionBy("_block").orderBy(shard))
    return counts.join(blocks, "_block").withColumn(
        name, F.col("_before") + inside).drop("_block", "_before")


def merged_shards(rows: DataFrame, shards: DataFrame, shard="shard", local="local_id",
                  base="base_seed") -> DataFrame:
    """Rows of all shards with ``merged_id`` (from 1, by shard and local identifier, without gaps)
    and ``seed`` (the shard's base and the place in the shard).

    A shard of any size is ranked in blocks of local identifiers; only identifiers are sorted.
    Local identifiers are whole numbers, unique in their shard; rows of shards that are not listed,
    and rows without a shard or local identifier, are left out.
    """
    ids = rows.select(shard, local).join(shards.select(shard), shard, "left_semi").where(
        F.col(local).isNotNull()).withColumn(
        "_block", F.shiftright(F.col(local).cast("long"), BLOCK_BITS))
    blocks = ids.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_n"))
    totals = _with_offsets(blocks.groupBy(shard).agg(F.sum("_n").alias("_n")), shard, "_n",
                           "_offset").drop("_n")
    blocks = blocks.withColumn("_in_shard", _earlier("_n", Window.partitionBy(shard).orderBy(
        "_block"))).join(totals, shard)
    place = F.row_number().over(Window.partitionBy(shard, "_block").orderBy(local))
    placed = ids.withColumn("_place", place).join(
        blocks.select(shard, "_block", "_in_shard", "_offset"), [shard, "_block"]).join(
        shards.select(shard, base), shard)
    first = F.col("_in_shard") + F.col("_place")
    new = placed.select(shard, local, (F.col("_offset") + first).alias("merged_id"),
                        (F.col(base) + first - 1).alias("seed"))
    return rows.join(new, [shard, local])


def range_overlaps(ranges: DataFrame, key="shard", start="first", end="last") -> DataFrame:
    """Pairs (a, b) of ranges of whole numbers, both ends included, that share a number.

    A range lives on the level of its length (the next power of two), where it touches at most two
    cells; it visits the cells of all longer levels that occur. Ranges are compared only in cells,
    by an equi join, and a pair counts in the cell that holds the larger of both starts. Empty
    ranges (end before start, or null) overlap with nothing.
    """
    full = ranges.select(F.col(key).alias("key"), F.col(start).cast("long").alias("low"),
                         F.col(end).cast("long").alias("high")).where("low <= high")
    length = F.col("high") - F.col("low") + 1
    full = full.withColumn("level", F.ceil(F.log2(length.cast("double"))).cast("int"))
    levels = full.select(F.col("level").alias("at")).distinct()     # at most 64

    def cells(rows, level):
        cell = F.explode(F.sequence(F.expr(f"shiftright(low, {level})"),
                                    F.expr(f"shiftright(high, {level})")))
        return rows.withColumn("cell", cell)

    homes = cells(full, "level").select("cell", F.col("level").alias("at"), *[
        F.col(c).alias(f"home_{c}") for c in ("key", "low", "high")])
    visits = cells(full.join(F.broadcast(levels), F.col("level") <= F.col("at")), "at")
    met = visits.join(homes, ["at", "cell"]).where(
        (F.col("low") <= F.col("home_high")) & (F.col("home_low") <= F.col("high"))
        & (F.expr("shiftright(greatest(low, home_low), at)") == F.col("cell"))
        & ((F.col("level") < F.col("at")) | (F.col("key") < F.col("home_key"))))
    return met.select(F.least("key", "home_key").alias("a"), F.greatest("key", "home_key").alias("b"),
                      (F.least("high", "home_high") - F.greatest("low", "home_low") + 1)
                      .alias("shared"))


def shard_report(rows: DataFrame, shards: DataFrame, shard="shard", local="local_id",
                 base="base_seed") -> DataFrame:
    """Per listed shard: rows, first merged identifier, gaps in its local identifiers, and with how
    many shards its seeds collide. Empty shards have no first identifier."""
    found = rows.where(F.col(local).isNotNull()).groupBy(shard).agg(
        F.count(F.lit(1)).alias("rows"), F.min(local).alias("_low"), F.max(local).alias("_high"))
    counts = shards.select(shard, base).join(found, shard, "left").withColumn(
        "rows", F.coalesce("rows", F.lit(0)))
    counts = _with_offsets(counts, shard, "rows", "_offset")
    seeds = counts.select(F.col(shard).alias("shard"), F.col(base).alias("first"),
                          (F.col(base) + F.col("rows") - 1).alias("last"))
    pairs = range_overlaps(seeds)
    hits = pairs.select(F.col("a").alias(shard)).unionByName(
        pairs.select(F.col("b").alias(shard))).groupBy(shard).agg(
        F.count(F.lit(1)).alias("collisions"))
    return counts.join(hits, shard, "left").select(
        shard, "rows", F.when(F.col("rows") > 0, F.col("_offset") + 1).alias("first_merged_id"),
        F.coalesce(F.col("_high") - F.col("_low") + 1 - F.col("rows"), F.lit(0)).alias("gaps"),
        F.coalesce("collisions", F.lit(0)).alias("collisions"))
