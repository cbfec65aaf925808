"""Streams whose cost per batch does not grow with what came before."""

import json

import random

from pyspark.sql import functions as F

from promptmill.operators import attempts as at
from promptmill.streaming import incremental


def arrive(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def append(spark, tmp_path):
    stream = spark.readStream.schema(
        "record_id long, source string, prompt string, score double, tags array<string>").option(
        "maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = incremental.append_new_prompts(stream, str(tmp_path / "pool"), str(tmp_path / "c"))
    query.awaitTermination()
    return query


def test_append_does_not_read_the_pool(spark, tmp_path):
    """The state knows what has come: the pool's files may be gone."""
    arrive(tmp_path / "in", "1.json", [
        {"record_id": 9, "source": "s", "prompt": "one two three", "score": 0.25, "tags": ["a"]},
        {"record_id": 4, "source": None, "prompt": " one two  three", "tags": None},
        {"record_id": 5, "source": "s", "prompt": None}, {"record_id": 6, "prompt": "x"}])
    append(spark, tmp_path)
    first = incremental.existing_pool(spark, str(tmp_path / "pool")).collect()
    assert [(r.record_id, r.source, r.prompt, r.score, r.tags) for r in first] == [
        (4, "unknown", "one two three", None, None)]
    (tmp_path / "pool").rename(tmp_path / "elsewhere")
    arrive(tmp_path / "in", "2.json", [
        {"record_id": 1, "source": "s", "prompt": "one two three"},
        {"record_id": 2, "source": "t", "prompt": "four five six", "score": 1.5, "tags": ["b", "c"]}])
    append(spark, tmp_path)
    second = incremental.existing_pool(spark, str(tmp_path / "pool")).collect()
    assert [(r.record_id, r.score, r.tags, r.batch) for r in second] == [(2, 1.5, ["b", "c"], 1)]


def test_appended_prompt_of_many_copies(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", [
        {"record_id": 30_000 - i, "source": "s", "prompt": "the same long prompt"}
        for i in range(25_000)])
    append(spark, tmp_path)
    pool = incremental.existing_pool(spark, str(tmp_path / "pool")).collect()
    assert [r.record_id for r in pool] == [5_001]


PAIRS = "t string, model_id string, success boolean, total_attempts long"


def report(spark, tmp_path, again=False):
    stream = spark.readStream.schema(PAIRS).option("maxFilesPerTrigger", 1).json(
        str(tmp_path / "in")).withColumn("ts", F.to_timestamp("t"))
    table = incremental.complete_report(stream, str(tmp_path / "report"), str(tmp_path / "c"))
    return {(str(r.window_start)[:10], r.model_id): (r.total_pairs, r.valid_pairs, r.total_attempts)
            for r in table.collect()}


def pair(day, model, ok, attempts=1):
    return {"t": f"2024-01-{day:02} 03:00:00", "model_id": model, "success": ok,
            "total_attempts": attempts}


def test_report_writes_touched_windows_only(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", [pair(d, m, d % 2 == 0) for d in range(1, 29) for m in "mn"])
    want = {(f"2024-01-{d:02}", m): (1, int(d % 2 == 0), 1) for d in range(1, 29) for m in "mn"}
    assert report(spark, tmp_path) == want
    # far behind everything else
    arrive(tmp_path / "in", "2.json", [pair(1, "m", True, 5), pair(1, "m", True, 2)])
    want["2024-01-01", "m"] = (3, 2, 8)
    assert report(spark, tmp_path) == want
    rewritten = list((tmp_path / "report" / "data" / "version=2").glob("bucket=*"))
    assert len(rewritten) == 1
    # no window is in streaming state
    assert not list((tmp_path / "c").glob("state/*"))


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", [pair(1, "m", True), pair(2, "m", False)])
    first = report(spark, tmp_path)
    # the driver was lost after the table had changed, before the batch was committed
    (tmp_path / "c" / "commits" / "0").unlink()
    (tmp_path / "c" / "commits" / ".0.crc").unlink(missing_ok=True)
    assert report(spark, tmp_path) == first
    assert report(spark, tmp_path) == first


ATTEMPT = "pair_id long, attempt int, status string, failure string, style_type string"


def random_attempts(seed, pairs, longest):
    rng = random.Random(seed)
    return [(p, n, *rng.choice([
        ("failed", "positive_incompatible", None), ("failed", "style_drift", "realistic"),
        ("failed", "style_drift", None), ("failed", "content_drift", "realistic"),
        ("failed", "positive_content_mismatch", None), ("success", None, None),
        ("skipped", None, None), ("error", None, None)]))
        for p in range(pairs) for n in range(rng.randint(1, longest))]


def actions_of(spark, folder):
    stream = spark.readStream.schema(ATTEMPT).option("maxFilesPerTrigger", 1).parquet(folder)
    got = incremental.run_to_table(incremental.stream_corrected_actions(stream, 4), "corrected")
    return incremental.newest_actions(got)


def test_attempts_in_any_order_over_batches(spark, tmp_path):
    rows = random_attempts(4, 60, 9)
    shuffled = random.Random(1).sample(rows, len(rows))
    folder = str(tmp_path / "attempts")
    for part in range(3):
        spark.createDataFrame(shuffled[part::3], ATTEMPT).coalesce(1).write.mode("append").parquet(
            folder)
    got = actions_of(spark, folder)
    want = at.next_actions(spark.createDataFrame(rows, ATTEMPT), 4).select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_pair_of_many_attempts(spark, tmp_path):
    """The latest attempts arrive first; the state of the pair stays three numbers."""
    n = 30_000
    rows = [(1, i, "failed", ("positive_incompatible", "style_drift")[i % 2], "realistic")
            for i in range(n)]
    folder = str(tmp_path / "attempts")
    for part in (rows[n // 2:], rows[:n // 2]):
        spark.createDataFrame(part[::-1], ATTEMPT).coalesce(1).write.mode("append").parquet(folder)
    got = {r.attempt: r.next_action for r in actions_of(spark, folder).collect()}
    assert len(got) == n
    assert got[0] == "anchor_positive" and got[1] == "anchor_negative" and got[3] == "rewrite"
    assert all(got[i] == ("stop_still_incompatible", "stop_exhausted")[i % 2] for i in range(4, n))


def test_stream_views_over_files_and_folders(spark, tmp_path):
    from promptmill.plans.stream_queries import StreamViews
    df = spark.range(40).withColumnRenamed("id", "event_id")
    df.repartition(3).write.parquet(str(tmp_path / "folder" / "events.parquet"))
    df.repartition(2).write.parquet(str(tmp_path / "folder" / "other_events.parquet"))
    (tmp_path / "file").mkdir()
    df.toPandas().to_parquet(tmp_path / "file" / "events.parquet")
    for kind in ("folder", "file"):
        stream = StreamViews(spark, str(tmp_path / kind)).table("events")
        assert incremental.run_to_table(stream, f"copy-{kind}").count() == 40
