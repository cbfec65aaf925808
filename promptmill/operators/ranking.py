"""Exact ranks and top-k that do not put a whole group into one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.text import col
from promptmill.session import MAX_PARAM_ROWS, written

SALTS = 128
BIN_BITS = 16     # rows of one sort at most
HASH_DIGITS = 4   # of a hash that name its bin: 65,536 bins of a group
SPAN_BITS = 40    # at most 2 ** 24 bins in a span, and as many spans


def top_k_per_group(df: DataFrame, groups, order, max_k: int, k=None, rank="rank") -> DataFrame:
    """The first ``k`` rows of every group in a total order, with their rank.

    ``max_k`` bounds ``k`` (a column or a number; default ``max_k``). Each group is first cut down
    inside parts made of whole input partitions, so that no task sorts more than its part of a hot
    group; small bounds are applied to every input partition even before that shuffle (window group
    limit). The second pass sees at most ``SALTS * max_k`` rows per group. Which part a row falls
    into does not matter for the result, so a part may well be the number of its task.
    """
    order = [col(o) for o in order]
    groups = [col(g) for g in groups]
    limit = col(k) if k is not None and not isinstance(k, int) else F.lit(k or max_k)
    part = Window.partitionBy(*groups, "_part").orderBy(*order)
    df = (df.withColumn("_part", F.spark_partition_id() % SALTS)
          .withColumn("_part_rank", F.row_number().over(part))
          .where(F.col("_part_rank") <= max_k).drop("_part_rank", "_part"))
    window = Window.partitionBy(*groups).orderBy(*order)
    return (df.withColumn(rank, F.row_number().over(window))
            .where(F.col(rank) <= F.lit(max_k)).where(F.col(rank) <= limit))


def top_k_by_hash(df: DataFrame, groups, order: str, tie: str, k, rank="rank") -> DataFrame:
    """The first ``k`` rows of every group in the order of a hash, for ``k`` of any size.

    ``order`` is a column of hexadecimal hashes (as md5 gives), ``tie`` a unique column, ``k`` a
    number or a column that is the same all over a group. The rows of each group are counted by
    the first digits of their hash, which tells the bin that holds the k-th one: rows of earlier
    bins are in, and only that one bin is sorted to trim it. The final rank sorts k rows of a group,
    never the group. Groups are told apart null-safe; rows without a hash are left out.
    """
    limit = col(k) if not isinstance(k, int) else F.lit(k)
    bins = F.conv(F.substring(order, 1, HASH_DIGITS), 16, 10).cast("int")
    rows = written(df.where(F.col(order).isNotNull()).withColumn("_limit", limit.cast("long"))
                   .withColumn("_bin", bins), "hashed-rows")
    names = [f"_g{i}" for i in range(len(groups))]
    counts = rows.groupBy(*[F.col(g).alias(n) for g, n in zip(groups, names)],
                          F.col("_bin").alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_limit").alias("_most"))
    running = Window.partitionBy(*names).orderBy("_at")
    before = F.sum("_n").over(running) - F.col("_n")
    edges = counts.withColumn("_before", before).where(
        (F.col("_before") < F.col("_most")) & (F.col("_before") + F.col("_n") >= F.col("_most")))
    edges = written(edges.select(*names, F.col("_at").alias("_edge"), "_before"), "edge-bins")
    if edges.count() <= MAX_PARAM_ROWS:
        edges = F.broadcast(edges)
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(groups, names)]
    condition = same[0] if same else F.lit(True)
    for one in same[1:]:
        condition = condition & one
    placed = rows.join(edges, condition, "left")
    # a group without an edge has no more than k rows
    inside = placed.where((F.col("_limit") > 0) & (F.col("_edge").isNull()
                                                   | (F.col("_bin") < F.col("_edge"))))
    in_edge = Window.partitionBy(*groups).orderBy(order, tie)
    trimmed = placed.where((F.col("_limit") > 0) & (F.col("_bin") == F.col("_edge"))).withColumn(
        "_place", F.row_number().over(in_edge)).where(
        F.col("_place") + F.col("_before") <= F.col("_limit")).drop("_place")
    kept = inside.unionByName(trimmed).drop("_bin", "_limit", "_edge", "_before", *names)
    return kept.withColumn(rank, F.row_number().over(in_edge))


def unique_rank(df: DataFrame, id_col: str, rank="rank") -> DataFrame:
    """Exact 1-based rank of every row by a unique whole number.

    A bin is a fixed span of numbers, so it holds at most ``2 ** BIN_BITS`` rows whatever gaps or
    clusters the numbers have, and there are as many bins as the data fill. The rows of earlier
    bins are summed inside a wide span, then over the spans. Only the numbers are sorted; the other
    columns come back by a join on the number. Rows without a number are left out.
    """
    def earlier(n, window):
        return F.coalesce(F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1)),
                          F.lit(0))

    ids = df.select(id_col).where(F.col(id_col).isNotNull()).withColumn(
        "_bin", F.shiftright(F.col(id_col).cast("long"), BIN_BITS))
    counts = ids.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_span", F.shiftright("_bin", SPAN_BITS - BIN_BITS))
    spans = counts.groupBy("_span").agg(F.sum("_n").alias("_all")).select(
        "_span", earlier("_all", Window.orderBy("_span")).alias("_before"))
    offsets = counts.join(spans, "_span").select("_bin", (F.col("_before") + earlier(
        "_n", Window.partitionBy("_span").orderBy("_bin"))).alias("_offset"))
    inside = Window.partitionBy("_bin").orderBy(id_col)
    ranks = ids.withColumn("_local", F.row_number().over(inside)).join(offsets, "_bin").select(
        id_col, (F.col("_local") + F.col("_offset")).alias(rank))
    return df.join(ranks, id_col)
