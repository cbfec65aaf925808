"""Streaming forms of the append, resume and run-report operators."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions import keys, text
from promptmill.operators import clean
from promptmill.session import work_folder
from promptmill.sources.bucketed import BucketedTable


DIGEST_BYTES, DIGEST_GROUPS = 32, 4096     # a checkpoint holds for one number of groups


def append_new_prompts(stream: DataFrame, pool_path: str, checkpoint: str, order_col="record_id",
                       available_now=True):
    """Append prompts of a stream that are not in the pool yet; inside a batch the row with the
    smallest ``order_col`` (not null) wins.

    Which prompts have come is keyed state in the state store beside the checkpoint: the digests,
    one after the other, in ``DIGEST_GROUPS`` groups, so a batch calls Python once for each group
    and not for each prompt, and opens no file of the pool. Each micro-batch is written to a folder of its own number, so a batch that is run again
    after a failure starts from the state before it and replaces its own output. Wide columns pass
    the state step as one packed text.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    rows = clean.candidate_status(stream).where(F.col("status") == "candidate")
    rows = rows.drop("status", "prompt").withColumnRenamed("normalized", "prompt").withColumn(
        "digest", keys.digest("prompt"))
    packed = rows.select(F.pmod(F.crc32("digest"), F.lit(DIGEST_GROUPS)).alias("digests"), "digest",
                         F.col(order_col).alias("place"),
                         F.to_json(F.struct(*rows.columns)).alias("packed"))
    place = packed.schema["place"].dataType.simpleString()

    def first_of_digests(key, frames, state):
        held = bytes(state.get[0]) if state.exists else b""
        seen = {held[i:i + DIGEST_BYTES] for i in range(0, len(held), DIGEST_BYTES)}
        best = {}
        for frame in frames:
            for digest, at, row in zip(map(bytes, frame["digest"]), frame["place"],
                                       frame["packed"]):
                if digest not in seen and (digest not in best or at < best[digest][0]):
                    best[digest] = at, row
        if best:
            state.update((held + b"".join(best),))
            yield pd.DataFrame(list(best.values()), columns=["place", "packed"])

    fresh = packed.groupBy("digests").applyInPandasWithState(
        first_of_digests, f"place {place}, packed string", "seen binary", "append",
        GroupStateTimeout.NoTimeout)
    fresh = fresh.select(F.from_json("packed", rows.schema).alias("row")).select("row.*")

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{pool_path}/batch={batch_id}")

    writer = fresh.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def existing_pool(spark: SparkSession, path: str, schema=None):
    """Pool written so far, or None before the first batch."""
    from pyspark.errors import AnalysisException
    try:
        reader = spark.read.option("basePath", path)
        return reader.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def running_report(stream: DataFrame, time_col="ts", delay="1 hour", window="1 day") -> DataFrame:
    """Validation report of an arriving pair log per time window and model.

    The watermark bounds the state: a window is emitted once and forgotten when the log has moved
    ``delay`` past its end.
    """
    return _report(stream.withWatermark(time_col, delay), time_col, window)


_SUMS = ("window_start timestamp, model_id string, total_pairs long, valid_pairs long, "
         "invalid_pairs long, total_attempts long")


def complete_report(stream: DataFrame, path: str, checkpoint: str, time_col="ts",
                    window="1 day", buckets=16) -> DataFrame:
    """The report of everything that has arrived, the last windows and late rows too.

    No window is held in streaming state. The sums of windows lie in a bucketed table; a micro-batch
    sums its own rows and adds them to the windows they fall into, late or not, and only buckets of
    such windows are written. Batch n makes version n + 1 from version n, so a batch that is run
    again after a failure adds nothing twice. Run again with the same path and checkpoint, the
    report goes on.
    """
    spark = stream.sparkSession
    table = BucketedTable(spark, path, _SUMS, ["window_start", "model_id"], buckets)
    sums = [c.split()[0] for c in _SUMS.split(", ")][2:]

    def process(batch: DataFrame, batch_id: int) -> None:
        found = _report(batch, time_col, window).select("window_start", "model_id", *sums)
        found = table.matching(found, batch_id).unionByName(found).groupBy(
            "window_start", "model_id").agg(*[F.sum(c).alias(c) for c in sums])
        table.change(found, after=batch_id)

    (stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return table.read().withColumn("validation_rate", text.rate("valid_pairs", "total_pairs"))


def _report(pairs: DataFrame, time_col: str, window: str) -> DataFrame:
    ok = F.col("success")
    return (pairs.groupBy(F.window(time_col, window), "model_id")
            .agg(F.count(F.lit(1)).alias("total_pairs"), F.count_if(ok).alias("valid_pairs"),
                 F.count_if(~ok).alias("invalid_pairs"),
                 F.sum("total_attempts").alias("total_attempts"))
            .select(F.col("window.start").alias("window_start"), "model_id", "total_pairs",
                    "valid_pairs", "invalid_pairs", "total_attempts",
                    text.rate("valid_pairs", "total_pairs").alias("validation_rate")))


_STATE = "incompatible int, drifted int"
_ACTIONS = "pair_id long, attempt int, status string, failure string, next_action string"


def stream_next_actions(stream: DataFrame, max_retries: int) -> DataFrame:
    """Streaming form of the next-action rule, keyed by pair.

    The state of a pair is two small numbers: its first incompatible and first drifted attempt.
    Attempts of a pair arrive in order, as the generation loop appends them.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, frames, state):
        incompatible, drifted = state.get if state.exists else (-1, -1)
        for frame in frames:
            rows = frame.sort_values("attempt")
            actions = []
            for attempt, status, failure, style in zip(
                    rows["attempt"], rows["status"], rows["failure"], rows["style_type"]):
                action = "rewrite"
                if status == "success":
                    action = "done"
                elif status == "skipped":
                    action = "stop_skipped"
                elif status == "failed" and failure == "positive_content_mismatch":
                    action = "stop_content_mismatch"
                elif status == "failed" and failure == "positive_incompatible":
                    if incompatible >= 0:
                        action = "stop_still_incompatible"
                    else:
                        incompatible = int(attempt)
                        action = "stop_exhausted" if attempt >= max_retries else "anchor_positive"
                elif attempt >= max_retries:
                    action = "stop_exhausted"
                elif status == "failed" and failure == "style_drift" and style and drifted < 0:
                    drifted = int(attempt)
                    action = "anchor_negative"
                actions.append(action)
            yield pd.DataFrame({"pair_id": rows["pair_id"], "attempt": rows["attempt"],
                                "status": rows["status"], "failure": rows["failure"],
                                "next_action": actions})
        state.update((incompatible, drifted))

    return stream.groupBy("pair_id").applyInPandasWithState(
        step, _ACTIONS, _STATE, "append", GroupStateTimeout.NoTimeout)


_CORRECTED = f"{_ACTIONS}, version int"


def stream_corrected_actions(stream: DataFrame, max_retries: int) -> DataFrame:
    """Next actions of attempts that arrive in any order, over any number of batches.

    What an attempt leads to depends on earlier ones only by which incompatible and which drifted
    attempt of the pair was the first. These two are the state of a pair, whatever it has seen.
    A late attempt that turns out to be first takes that place, and the one that had it is given
    out again with its new action and a higher ``version``; :func:`newest_actions` keeps the last
    word. Attempts are numbered without repetition inside a pair.
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    none = 2 ** 31 - 1

    def first(attempts, held):
        return min(held, int(attempts.min())) if len(attempts) else held

    def step(key, frames, state):
        incompatible, drifted, version = state.get if state.exists else (none, none, 0)
        for frame in frames:
            version += 1
            attempt = frame["attempt"].to_numpy()
            status, failure = frame["status"], frame["failure"]
            failed = (status == "failed").to_numpy()
            odd = failed & (failure == "positive_incompatible").to_numpy()
            drift = (failed & (failure == "style_drift").to_numpy() & (attempt < max_retries)
                     & frame["style_type"].fillna("").ne("").to_numpy())
            before = incompatible, drifted
            incompatible, drifted = first(attempt[odd], incompatible), first(attempt[drift], drifted)
            out = pd.DataFrame({"attempt": attempt, "status": status, "failure": failure,
                                "next_action": np.select(
                [(status == "success").to_numpy(), (status == "skipped").to_numpy(),
                 failed & (failure == "positive_content_mismatch").to_numpy(),
                 odd & (attempt > incompatible), attempt >= max_retries, odd,
                 drift & (attempt == drifted)],
                ["done", "stop_skipped", "stop_content_mismatch", "stop_still_incompatible",
                 "stop_exhausted", "anchor_positive", "anchor_negative"], "rewrite")})
            again = [(old, "failed", name, action) for old, new, name, action in (
                (before[0], incompatible, "positive_incompatible", "stop_still_incompatible"),
                (before[1], drifted, "style_drift", "rewrite")) if new < old < none]
            if again:
                out = pd.concat([out, pd.DataFrame(again, columns=list(out.columns))])
            yield out.assign(pair_id=key[0], version=version)[
                ["pair_id", "attempt", "status", "failure", "next_action", "version"]]
        state.update((incompatible, drifted, version))

    return stream.groupBy("pair_id").applyInPandasWithState(
        step, _CORRECTED, "incompatible int, drifted int, version int", "append",
        GroupStateTimeout.NoTimeout)


def newest_actions(given: DataFrame) -> DataFrame:
    """The action of every attempt as last given out."""
    return given.groupBy("pair_id", "attempt").agg(F.max_by(F.struct(
        "status", "failure", "next_action"), "version").alias("last")).select(
        "pair_id", "attempt", "last.*")


def run_to_table(result: DataFrame, name: str, mode="append") -> DataFrame:
    """Run a streaming query over everything available now and read its written output."""
    spark = result.sparkSession
    path, checkpoint = work_folder(spark, name), work_folder(spark, f"{name}-checkpoint")
    query = (result.writeStream.format("parquet").outputMode(mode).option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(path)
