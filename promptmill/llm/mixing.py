"""Mixing sources to target weights by exponential-key sampling.

Each document draws an exponential key divided by its quality weight: sorted by key, documents of
a source come in the order of a weighted sample without replacement. A source whose target is more
than its size is taken whole once or twice (complete epochs) and the rest of the target is filled
by the documents with the smallest keys, up to the prefix whose size comes nearest.

Prefix sums do not pass through one task per source. Keys are cut into bins, as many as the source
has tens of thousands of documents; sums per bin give each bin's offset, and only inside a bin are
documents sorted.

Defined results: a null text has size 0, a null source is a source of its own and the last one;
ties of the key are ordered by identifier and text hash, equal rows count as separate documents; a
source without words gets target 0; an empty table gives an empty table; extra columns are carried.
The table of sources is as long as there are sources.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole, word_count, written

SYMBOLS = "#*$%&|<>"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BIN_ROWS = 50_000
SEED = 20


def symbol_quality(text: str = "text") -> Column:
    """Quality weight of a text from 0.05 to 1: less with more symbols."""
    chars = F.char_length(whole(text))
    symbols = chars - F.char_length(F.translate(whole(text), SYMBOLS, ""))
    share = F.when(chars > 0, symbols / chars).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.05), 1 - 4 * share)


def draw(key: str, seed: int = SEED) -> Column:
    """A uniform number between 0 and 1 from the identifier, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("-"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(2 ** 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """From (source, size): source, sid, source_size, rows, target. Targets share the total by
    weight; where a target is above the cap its excess goes to the others by weight, until none is
    above: target = least(cap * size, level * weight) with one level for all."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count(F.lit(1)).alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    values = F.array(*[F.lit(float(w)) for w in weights])
    sums = sums.withColumn("sid", F.row_number().over(by_name) - 1)
    sums = sums.withColumn("weight", F.get(values, F.col("sid") % len(weights)))
    sums = sums.withColumn("ceiling", cap * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    filled = (Window.orderBy(F.col("ceiling") / F.col("weight"), "sid")
              .rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn(
        "level", (F.sum("source_size").over(everything)
                  - F.coalesce(F.sum("ceiling").over(filled), F.lit(0.0)))
        / (F.sum("weight").over(everything)
           - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))))
    sums = sums.withColumn("fits", F.col("level") * F.col("weight") <= F.col("ceiling"))
    sums = sums.withColumn("level", F.min_by(
        F.when(F.col("fits"), F.col("level")),
        F.when(F.col("fits"), F.struct(F.col("ceiling") / F.col("weight"), "sid"))
    ).over(everything))
    target = F.least("ceiling", F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    return sums.select("source", "sid", "source_size", "rows", target.alias("target"))


def _keyed(docs: DataFrame, quality: Column, key: str, text: str, seed: int) -> DataFrame:
    return docs.withColumns({
        "_size": word_count(text), "_tie": F.xxhash64(whole(text)),
        "_key": -F.log(draw(key, seed)) / quality})


def _copies(rows: DataFrame, narrow: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """``rows`` with their source's columns and ``_copies``, how often the mix holds them."""
    sources = sources.withColumns({
        "_epochs": F.when(F.col("source_size") > 0,
                          F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
        "_bins": F.ceil(F.col("rows") / BIN_ROWS)}).withColumnRenamed("source", "_source")

    def binned(df):
        joined = df.join(sources, df["source"].eqNullSafe(sources["_source"])).drop("_source")
        return joined.withColumn(
            "_bin", F.floor(F.col("_key") / (F.col("_key") + 1) * F.col("_bins")))

    before = (Window.partitionBy("sid").orderBy("_bin")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (binned(narrow).groupBy("sid", "_bin").agg(F.sum("_size").alias("_in_bin"))
               .select("sid", "_bin", F.coalesce(F.sum("_in_bin").over(before), F.lit(0))
                       .alias("_offset")))
    inside = (Window.partitionBy("sid", "_bin").orderBy("_key", key, "_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = binned(rows).join(offsets, ["sid", "_bin"])
    ranked = ranked.withColumn(
        "_before", F.col("_offset") + F.sum("_size").over(inside) - F.col("_size"))
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    chosen = 2 * F.col("_before") + F.col("_size") <= 2 * rest
    return ranked.withColumn(
        "_copies", F.col("_epochs") + F.when(chosen & (rest > 0), 1).otherwise(0))


def mix_plan(docs: DataFrame, quality: Column | None = None, key: str = "doc_id",
             text: str = "text", weights=WEIGHTS, cap: int = MAX_EPOCHS,
             seed: int = SEED) -> DataFrame:
    """One row per document: key, size, source_size, target of its source, taken (words of it in
    the mix, repeats counted), copies."""
    quality = symbol_quality(text) if quality is None else quality
    narrow = written(_keyed(docs, quality, key, text, seed)
                     .select(key, "source", "_size", "_tie", "_key"), "mix-keys")
    sources = source_targets(narrow.select("source", F.col("_size").alias("size")), weights, cap)
    out = _copies(narrow, narrow, sources, key)
    return out.select(key, F.col("_size").alias("size"), "source_size", "target",
                      (F.col("_size") * F.col("_copies")).cast("long").alias("taken"),
                      F.col("_copies").cast("int").alias("copies"))


def mixed(docs: DataFrame, quality: Column | None = None, key: str = "doc_id",
          text: str = "text", weights=WEIGHTS, cap: int = MAX_EPOCHS,
          seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as the plan holds it, all columns kept."""
    quality = symbol_quality(text) if quality is None else quality
    keyed = _keyed(docs, quality, key, text, seed)
    narrow = written(keyed.select(key, "source", "_size", "_tie", "_key"), "mix-keys")
    sources = source_targets(narrow.select("source", F.col("_size").alias("size")), weights, cap)
    clash = [c for c in ("sid", "source_size", "rows", "target") if c in docs.columns]
    rows = _keyed(docs.withColumnsRenamed({c: f"_own_{c}" for c in clash}),
                  quality, key, text, seed)
    out = _copies(rows, narrow, sources, key).where("_copies > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select(*[F.col(f"_own_{c}" if c in clash else c).alias(c) for c in docs.columns])
