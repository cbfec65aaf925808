import json

import pytest
from pyspark.sql import functions as F

from promptmill.operators import attempts as at
from promptmill.session import param_table, shared_root, work_folder, written
from promptmill.sources import readers, writers
from promptmill.streaming import incremental
from test_runs_attempts import ATTEMPT, random_attempts


def test_jsonl_skips_blank_lines_and_fails_on_bad_ones(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"prompt": "a"}\n\n{"prompt": "b"}\n')
    assert readers.read_jsonl(spark, str(good), "prompt string").count() == 2
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"prompt": "a"}\n{oops\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        readers.read_jsonl(spark, str(bad), "prompt string").collect()


@pytest.mark.parametrize("name, content", [
    ("list.json", '["a", {"text": "b"}, {"prompt": "c", "semantic_tags": ["t"]}]'),
    ("object.json", '{"prompts": ["a", {"text": "b"}, {"prompt": "c"}]}'),
    ("lines.jsonl", '"a"\n\n{"text": "b"}\n{"prompt": "c"}\n')])
def test_prompt_file_formats(spark, tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content)
    items = readers.read_prompt_file(spark, str(path))
    assert sorted(r["prompt"] for r in readers.prompt_texts(items).collect()) == ["a", "b", "c"]
    assert sorted(r["prompt"] for r in readers.normalize_items(items).collect()) == ["a", "b", "c"]


def test_tag_map_takes_the_last_row(spark):
    df = spark.createDataFrame([(1, "a", ["x"]), (2, " a ", ["y"]), (3, "b", None), (4, " ", [])],
                               "record_id long, prompt string, semantic_tags array<string>")
    got = {r["prompt"]: r["semantic_tags"] for r in readers.tagged_map(df).collect()}
    assert got == {"a": ["y"], "b": []}


def test_requirements_file(spark, tmp_path):
    path = tmp_path / "requirements.json"
    path.write_text(json.dumps({"tags": {"x": {}}, "dimension_requirements": {
        "_note": {"d0": None}, "anatomy": {"d1": {"required": ["a", "b"], "preferred": ["c"]},
                                           "d2": None}}}))
    got = {r["dimension"]: (r["required"], r["alternative"], r["preferred"])
           for r in readers.read_requirements(spark, str(path)).collect()}
    assert got == {"d1": (["a", "b"], None, ["c"]), "d2": (None, None, None)}


def test_generated_files_are_read_once(spark, tmp_path):
    for sub in ("a", "a/deep", "b"):
        (tmp_path / sub).mkdir(parents=True, exist_ok=True)
        (tmp_path / sub / "generated_positive_prompts.jsonl").write_text('{"prompt": "p"}\n')
    (tmp_path / "a" / "other.jsonl").write_text('{"prompt": "q"}\n')
    single = str(tmp_path / "a" / "generated_positive_prompts.jsonl")
    found = readers.collect_generated(spark, [str(tmp_path / "a"), str(tmp_path / "b"), single],
                                      "prompt string")
    assert found.count() == 3 and found.select("file").distinct().count() == 3
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.collect_generated(spark, [str(tmp_path / "empty")], "prompt string")


def test_result_shards(spark, tmp_path):
    name = "family_screening_results.jsonl"
    for shard in range(2):
        (tmp_path / f"shard_{shard}").mkdir()
        (tmp_path / f"shard_{shard}" / name).write_text('{"label": "pass"}\n' * (shard + 1))
    assert readers.read_result_shards(spark, str(tmp_path), "label string").count() == 3
    (tmp_path / name).write_text('{"label": "fail"}\n')
    assert readers.read_result_shards(spark, str(tmp_path), "label string").count() == 1
    with pytest.raises(FileNotFoundError):
        readers.read_result_shards(spark, str(tmp_path / "shard_9"), "label string")


def test_subpools_are_partitioned_and_pruned(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "dimension string, record_id long")
    index = {r["dimension"]: (r["count"], r["filename"])
             for r in writers.write_subpools(df, str(tmp_path / "out")).collect()}
    assert index == {"a": (2, "dimension=a"), "b": (1, "dimension=b")}
    one = readers.read_subpool(spark, str(tmp_path / "out" / "dimension_subpools"), "a")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(dimension" in one._jdf.queryExecution().toString()


def test_run_is_written_with_successes_only(spark, tmp_path):
    df = spark.createDataFrame([("a", True, 1), ("b", False, 2)],
                               "pair_id string, success boolean, total_attempts long")
    writers.write_run(df, str(tmp_path / "run"))
    assert spark.read.parquet(str(tmp_path / "run" / "dataset")).count() == 1
    report = spark.read.json(str(tmp_path / "run" / "validation_report")).head()
    assert (report["total_pairs"], report["valid_pairs"], report["validation_rate"]) == (2, 1, 0.5)


def test_jsonl_sink_keeps_nulls_and_appends(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "prompt string, model string")
    path = str(tmp_path / "sink")
    writers.write_jsonl(df, path)
    writers.append_jsonl(df, path)
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    assert lines == [{"prompt": "a", "model": None}] * 2
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        writers.write_jsonl(df, path)


def test_work_folders_lie_below_the_shared_one(spark):
    assert work_folder(spark, "x").startswith(shared_root(spark))
    assert work_folder(spark, "x") != work_folder(spark, "x")
    df = spark.range(5).withColumn("s", F.lit("v"))
    assert written(df, "t").orderBy("id").collect() == df.orderBy("id").collect()


def test_parameter_tables_are_bounded(spark):
    table = param_table(spark, [("a", ["x"], True), ("b", None, None)],
                        "d string, t array<string>, b boolean")
    assert [tuple(r) for r in table.orderBy("d").collect()] == [("a", ["x"], True),
                                                               ("b", None, None)]
    def hinted(n):
        table = param_table(spark, [(i,) for i in range(n)], "i int")
        assert table.count() == n
        return "ResolvedHint" in table._jdf.queryExecution().analyzed().toString()

    assert hinted(20_000) and not hinted(20_001)


def drain(spark, source, pool, checkpoint):
    stream = spark.readStream.schema("record_id long, source string, prompt string").option(
        "maxFilesPerTrigger", 1).json(str(source))
    incremental.append_new_prompts(stream, str(pool), str(checkpoint)).awaitTermination()
    return incremental.existing_pool(spark, str(pool))


def test_stream_appends_new_prompts_over_restarts(spark, tmp_path):
    source, pool, checkpoint = tmp_path / "in", tmp_path / "pool", tmp_path / "checkpoint"
    source.mkdir()

    def arrive(name, prompts):
        (source / name).write_text("\n".join(
            json.dumps({"record_id": i, "source": "s", "prompt": p}) for i, p in prompts))

    arrive("1.json", [(1, "one two three"), (2, "one  two three"), (3, "short")])
    assert {r["record_id"] for r in drain(spark, source, pool, checkpoint).collect()} == {1}
    arrive("2.json", [(4, "one two three"), (5, "four five six")])
    after = drain(spark, source, pool, checkpoint)
    assert {r["record_id"] for r in after.collect()} == {1, 5}
    # A batch that runs again writes the same rows to the same place.
    assert {(r["record_id"], r["batch"]) for r in after.collect()} == {(1, 0), (5, 1)}


def test_state_of_new_prompts_is_kept_in_groups(spark, tmp_path):
    words = F.concat_ws(" ", F.lit("a new prompt"), (F.col("id") % 4500).cast("string"))
    rows = spark.range(9000).select((10_000 - F.col("id")).alias("record_id"),
                                    F.lit("s").alias("source"), words.alias("prompt"))
    schema, pool = rows.schema, str(tmp_path / "pool")
    for arrived in (rows.where("id < 4000"), rows.where("id >= 4000")):
        arrived.write.mode("append").parquet(str(tmp_path / "in"))
        query = incremental.append_new_prompts(
            spark.readStream.schema(schema).parquet(str(tmp_path / "in")), pool,
            str(tmp_path / "checkpoint"))
        query.awaitTermination()
    got = {r["record_id"] for r in incremental.existing_pool(spark, pool).collect()}
    # of two new rows in the second batch the later one has the smaller number
    assert got == {10_000 - i for i in range(4000)} | {
        10_000 - (i + 4500) for i in range(4000, 4500)}
    assert query.lastProgress.stateOperators[0].numRowsTotal <= incremental.DIGEST_GROUPS


def test_stream_report_closes_windows(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "m", True, 1), ("2024-01-01 05:00:00", "m", False, 3),
            ("2024-01-02 12:00:00", "m", True, 1), ("2024-01-03 00:30:00", "n", True, 1)]
    df = spark.createDataFrame(rows, "t string, model_id string, success boolean, "
                                     "total_attempts long").select(
        F.to_timestamp("t").alias("ts"), "model_id", "success", "total_attempts")
    df.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "log"))
    got = incremental.run_to_table(incremental.running_report(stream), "report").collect()
    # The log has moved past the first day by more than the delay, not past the second.
    assert [(str(r["window_start"]), r["total_pairs"], r["validation_rate"]) for r in got] == [
        ("2024-01-01 00:00:00", 2, 0.5)]


def test_stream_actions_equal_batch_actions(spark, tmp_path):
    table = [(p, n, *a) for p, attempts in random_attempts(7).items()
             for n, a in enumerate(attempts)]
    df = spark.createDataFrame(table, ATTEMPT)
    folder = str(tmp_path / "attempts")
    # The first attempts of every pair arrive in one file, the later ones in another.
    df.where("attempt < 2").coalesce(1).write.parquet(folder)
    df.where("attempt >= 2").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = incremental.run_to_table(incremental.stream_next_actions(stream, 4), "actions")
    want = at.next_actions(df, 4).select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_subpools_are_written_without_a_sort(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "if(id % 3 = 0, 'a', 'b') AS dimension",
                                      "repeat(cast(id AS string), 20) AS prompt")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    index = writers.write_subpools(df, str(tmp_path / "out"))
    assert {r["dimension"]: r["count"] for r in index.collect()} == {"a": 667, "b": 1333}
    runs = store.executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(before, runs.size())]
    wrote = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and "Parquet" in p]
    assert wrote and not any("Sort " in p for p in wrote)
    assert spark.conf.get(writers.OPEN_FILES) == "0"
