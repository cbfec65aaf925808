"""Seeded samples: stratified quotas, reservoirs, top-k, shards, degradation and severity draws."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions import keys
from promptmill.functions.plan import held
from promptmill.functions.text import col
from promptmill.operators import clean
from promptmill.operators.ranking import top_k_by_hash, top_k_per_group, unique_rank
from promptmill.params import taxonomy as tx
from promptmill.session import written


LARGE_K = 1000      # beyond it a window cannot cut groups down before they are shuffled


def _lookup(pairs: dict, key, default=0) -> Column:
    if not pairs:
        return F.lit(default)
    flat = [F.lit(x) for kv in pairs.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*flat), col(key)), F.lit(default))


def stratified_sample(df: DataFrame, plan: dict, seed=20260304, id_col="record_id") -> DataFrame:
    """Working pool: bucket quotas, source fill, plain source quotas, top-up, truncation.

    ``df`` has ``source``, ``bucket`` (null where the source has no bucket rule) and a unique id.
    ``plan``: ``target_final_pool_size``, ``planned_top_up_size``, ``top_up_source`` and
    ``sources`` (``name``, ``final_selected_size``, optional ``buckets``). Returns id, source,
    ``assigned_bucket`` and ``pool_rank``.

    No pick of a bucket or of the source fill can lie beyond the first bucket quota + source quota
    rows of its bucket, and no top-up pick beyond the first source quota + top-up rows of its
    source, so the table is cut to the size of the plan first and every later step is small.
    """
    sources = plan["sources"]
    ords = {s["name"]: i for i, s in enumerate(sources)}
    quota = {s["name"]: s["final_selected_size"] for s in sources}
    buckets = {(s["name"], b["name"]): (i, b["final_selected_size"])
               for s in sources for i, b in enumerate(s.get("buckets") or [])}
    bucketed = [s["name"] for s in sources if s.get("buckets")]
    slot_quota = {f"{s}|{b}": n for (s, b), (_, n) in buckets.items()}
    slot_ord = {f"{s}|{b}": i for (s, b), (i, _) in buckets.items()}

    base = (df.where(F.col("source").isin(*ords)).select(id_col, "source", "bucket")
            .withColumn("_ord", _lookup(ords, "source"))
            .withColumn("_slot", F.concat_ws("|", "source", F.coalesce("bucket", F.lit("")))))
    shuffled = base.withColumn("_h", F.md5(F.concat_ws(
        "|", (F.lit(seed) + F.col("_ord")).cast("string"), "source",
        F.col(id_col).cast("string"))))
    shuffled = shuffled.withColumn("_quota", _lookup(quota, "source")).withColumn(
        "_slot_quota", _lookup(slot_quota, "_slot"))
    bound = max(quota.values(), default=0) + max(slot_quota.values(), default=0)
    shuffled = shuffled.withColumn("_k", F.col("_quota") + F.col("_slot_quota"))
    if bound > LARGE_K:
        near = top_k_by_hash(shuffled, ["_slot"], "_h", id_col, "_k", "_slot_rank")
    else:
        near = top_k_per_group(shuffled, ["_slot"], ["_h", id_col], bound, "_k", "_slot_rank")
    near = near.withColumnRenamed("source", "src")

    extra, top_source = plan.get("planned_top_up_size", 0), plan.get("top_up_source")
    if extra and top_source:
        pool = df.where(F.col("source") == top_source).select(
            id_col, F.col("source").alias("src"),
            F.md5(F.concat_ws("|", F.lit(str(seed + 999)), "source",
                              F.col(id_col).cast("string"))).alias("_h2"))
        pool = top_k_per_group(pool, ["src"], ["_h2", id_col], quota.get(top_source, 0) + extra,
                               rank="_r").drop("_r")
        near = near.join(pool, [id_col, "src"], "full_outer")
    else:
        near = near.withColumn("_h2", F.lit(None).cast("string"))

    # From here on there are only as many rows as the plan allows for.
    picked = (F.col("src").isin(*bucketed) & F.coalesce(
        F.col("_slot_rank") <= F.col("_slot_quota"), F.lit(False)))
    by_source = Window.partitionBy("src")
    fill = Window.partitionBy("src", "_open").orderBy("_h", id_col)
    top_up = Window.partitionBy("src", "_spare").orderBy("_h2", id_col)
    selected = (
        near.withColumn("_picked", picked)
        .withColumn("_chosen", F.count_if("_picked").over(by_source))
        .withColumn("_open", F.col("_h").isNotNull() & ~F.col("_picked"))
        .withColumn("_filled", F.col("_open") & (
            F.row_number().over(fill) <= F.col("_quota") - F.col("_chosen")))
        .withColumn("_spare", F.col("_h2").isNotNull() & ~F.col("_picked") & ~F.col("_filled"))
        .withColumn("_topped", F.col("_spare") & (F.row_number().over(top_up) <= extra))
        .where(F.col("_picked") | F.col("_filled") | F.col("_topped")))
    placed = selected.select(
        id_col, "src",
        F.when(F.col("_picked"), F.col("bucket"))
        .when(F.col("_filled"), F.when(F.col("src").isin(*bucketed), F.lit("source_fill")))
        .otherwise(F.lit("top_up")).alias("assigned_bucket"),
        F.when(F.col("_topped"), F.lit(len(sources))).otherwise(F.col("_ord")).alias("_o"),
        F.when(F.col("_picked"), _lookup(slot_ord, "_slot"))
        .when(F.col("_filled"), F.lit(len(slot_ord))).otherwise(F.lit(0)).alias("_phase"),
        F.when(F.col("_topped"), F.col("_h2")).otherwise(F.col("_h")).alias("_key"),
        F.lit(0).alias("_one"))
    return top_k_per_group(placed, ["_one"], ["_o", "_phase", "_key", id_col],
                           plan["target_final_pool_size"], rank="pool_rank").select(
        id_col, F.col("src").alias("source"), "assigned_bucket", "pool_rank")


def reservoir_sample(df: DataFrame, group: str, k: int, seed, key="record_id") -> DataFrame:
    """A seeded uniform sample of ``k`` rows per group."""
    ordered = df.withColumn("_h", keys.sample_order(seed, group, key))
    if k > LARGE_K:
        return top_k_by_hash(ordered, [group], "_h", key, k, "sample_rank").drop("_h")
    return top_k_per_group(ordered, [group], ["_h", key], k, rank="sample_rank").drop("_h")


def sample_dimension_prompts(subpools: DataFrame, k: int, seed) -> DataFrame:
    """Distinct-prompt sample per dimension with rank-based sample ids.

    ``subpools``: ``dimension, record_id, prompt``. Prompts are compared after stripping; the
    sampling order depends on the prompt text only.
    """
    from promptmill.functions.text import strip
    prompts = subpools.select("dimension", "record_id", strip("prompt").alias("prompt")).where(
        F.col("prompt") != "")
    firsts = (prompts.groupBy("dimension", keys.digest("prompt").alias("_digest"))
              .agg(F.min("record_id").alias("record_id")).drop("_digest"))
    ordered = (prompts.join(firsts, ["dimension", "record_id"], "left_semi")
               .withColumn("_h", keys.sample_order(seed, "dimension", "prompt")))
    ranked = top_k_per_group(ordered, ["dimension"], ["_h"], k, rank="rank")
    return ranked.select("dimension", "rank", "record_id", "prompt",
                         keys.sample_id("dimension", "rank", "prompt").alias("sample_id"))


def sample_unique(df: DataFrame, k: int, seed, key="prompt", order_col="record_id") -> DataFrame:
    """A seeded sample of ``k`` distinct prompts over the whole table."""
    distinct = clean.first_wins(df.where(F.coalesce(col(key), F.lit("")) != ""), key, order_col)
    return distinct.orderBy(keys.sample_order(seed, key), order_col).limit(k)


def top_k_by_score(df: DataFrame, score: str, k: int, min_len=10, model=None,
                   model_col="model", prompt="prompt", tie="record_id") -> DataFrame:
    """Best ``k`` rows by score with a long enough prompt and a matching model name."""
    from promptmill.functions.text import strip
    rows = df.withColumn(prompt, strip(prompt)).where(
        (F.length(prompt) >= min_len) & (F.col(prompt) != "") & F.col(score).isNotNull())
    if model:
        rows = rows.where(F.lower(F.coalesce(model_col, F.lit(""))).contains(model.lower()))
    return rows.orderBy(F.desc(score), tie).limit(k)


def select_shard(ranked: DataFrame, num_shards: int, shard_index: int, rank="rank") -> DataFrame:
    """Rows whose zero-based position falls on the shard."""
    if num_shards < 1:
        raise ValueError("num_shards must be at least 1")
    if not 0 <= shard_index < num_shards:
        raise ValueError("shard_index must lie in [0, num_shards)")
    return ranked.where(F.pmod(F.col(rank) - 1, F.lit(num_shards)) == shard_index)


def candidate_shards(df: DataFrame, num_shards: int, id_col="record_id") -> DataFrame:
    """Rank candidates by id and add the shard each one belongs to."""
    # Ranking reads its input three times; the rules that chose the candidates run once.
    candidates = written(df, "shard-candidates")
    ranked = unique_rank(candidates, id_col)
    return ranked.withColumn("shard", F.pmod(F.col("rank") - 1, F.lit(num_shards)).cast("int"))


def degradation_draws(df: DataFrame, types, n: int, seed, balanced=True,
                      id_col="record_id") -> DataFrame:
    """``n`` degradation types per prompt, numbered from 0.

    Without replacement when ``balanced`` and ``n`` does not exceed the number of types: the types
    are ordered by a hash inside the row. With replacement otherwise: one hash per draw.
    """
    types = list(types)
    key = F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string"))
    names = F.array(*[F.lit(t) for t in types])
    if balanced and n <= len(types):
        entries = F.array(*[F.struct(F.md5(F.concat_ws("|", key, F.lit(t))).alias("h"),
                                     F.lit(t).alias("degradation_type")) for t in types])
        drawn = F.slice(F.array_sort(entries), 1, n)
        return df.select("*", F.posexplode(drawn).alias("neg_idx", "_e")).withColumn(
            "degradation_type", F.col("_e.degradation_type")).drop("_e")
    drawn = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("neg_idx"))
    u32 = keys.stable_u32(F.concat_ws("|", key, F.col("neg_idx").cast("string")))
    return drawn.withColumn("degradation_type", F.element_at(
        names, (F.pmod(u32, F.lit(len(types))) + 1).cast("int")))


def severity(mode="weighted", key=None, neg_idx=None, fixed=None) -> Column:
    """Severity of a work item: fixed, round-robin by draw number, or weighted by a hash."""
    if mode == "fixed":
        return F.lit(fixed)
    if mode == "round_robin":
        names = F.array(*[F.lit(s) for s in tx.SEVERITIES])
        return F.element_at(names, (F.pmod(col(neg_idx), F.lit(len(tx.SEVERITIES))) + 1)
                            .cast("int"))
    u = keys.hash_fraction(F.md5(col(key)))
    first, second, third = tx.SEVERITY_SHARES
    return (F.when(u < first[1], F.lit(first[0])).when(u < second[1], F.lit(second[0]))
            .otherwise(F.lit(third[0])))


def tag_spot_check(df: DataFrame, tag: str, n: int, seed, key="record_id") -> DataFrame:
    """A seeded sample of prompts carrying a tag."""
    return (held(df, "semantic_tags").where(F.array_contains("semantic_tags", tag))
            .orderBy(keys.sample_order(seed, key), key).limit(n))


def systematic_grid(subpools: DataFrame, dimensions: DataFrame, k: int, severities, base_seed: int,
                    seed) -> DataFrame:
    """Dimension x prompt x severity work items; the severities of a prompt share one seed.

    ``dimensions``: ``ord, dimension`` (a parameter table). The seed runs over dimensions in order
    and over the sample rank inside each.
    """
    order = Window.partitionBy("_one").orderBy("ord", "sample_rank")  # dimensions x k rows
    seeded = (reservoir_sample(subpools, "dimension", k, seed).join(dimensions, "dimension")
              .withColumn("_one", F.lit(0))
              .withColumn("seed", F.lit(base_seed) + F.row_number().over(order) - 1))
    levels = F.array(*[F.lit(s) for s in severities])
    return seeded.withColumn("severity", F.explode(levels)).drop("_one", "ord")


def random_grid(prompts: DataFrame, dimensions, severities, k: int, base_seed: int, seed,
                id_col="record_id") -> DataFrame:
    """``k`` draws of (dimension, severity) per prompt; the seed counts all draws in id order."""
    ranked = unique_rank(prompts, id_col)
    drawn = ranked.withColumn("pair_idx", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))

    def pick(names, label):
        u32 = keys.stable_u32(F.concat_ws("|", F.lit(f"{seed}|{label}"),
                                          F.col(id_col).cast("string"),
                                          F.col("pair_idx").cast("string")))
        return F.element_at(F.array(*[F.lit(n) for n in names]),
                            (F.pmod(u32, F.lit(len(names))) + 1).cast("int"))

    return (drawn.withColumn("dimension", pick(list(dimensions), "dimension"))
            .withColumn("severity", pick(list(severities), "severity"))
            .withColumn("seed", F.lit(base_seed) + (F.col("rank") - 1) * k + F.col("pair_idx"))
            .drop("rank"))


def without_completed(work: DataFrame, log: DataFrame) -> DataFrame:
    """Work items whose (prompt, dimension, severity) has no success in the log yet; the whole
    prompt counts, not only the part that the short pair key shows."""
    def keyed(df, prompt):
        return df.withColumn("_key", keys.digest(F.concat(
            F.col(prompt), F.lit("|"), F.col("dimension"), F.lit("|"), F.col("severity"))))

    done = keyed(log.where("success"), "positive_prompt").select("_key").distinct().withColumn(
        "_done", F.lit(True))
    return keyed(work, "prompt").join(done, "_key", "left").where(
        F.col("_done").isNull()).drop("_key", "_done")
