"""Registered queries run over their whole tables: compared with plain counts of those."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract
from promptmill.plans.views import Views
from promptmill.streaming import incremental

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the given tables")


def test_generated_files_hold_every_prompt(spark):
    want = Counter(r.source for r in Views(spark, SMALL).prompts().select("source").collect())
    got = contract.queries()["collected_generated_files"](spark, SMALL).collect()
    assert {r.source: r.prompts for r in got} == want


def first_by_prompt(spark):
    """Tagged rows by prompt, the one with the smallest identifier of each."""
    rows = sorted(Views(spark, SMALL).tagged().collect(), key=lambda r: r.record_id)
    return rows, {r.prompt: r for r in reversed(rows) if r.prompt}


def test_results_match_sources_of_every_language(spark):
    first = first_by_prompt(spark)[1]
    want = Counter((r.dimension, r.label, first[r.prompt].record_id, first[r.prompt].source)
                   for r in Views(spark, SMALL).results().collect() if r.prompt in first)
    got = contract.queries()["matched_sources"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("name", ["batch_filter_verdicts", "older_batch_filter_verdicts"])
def test_no_prompt_goes_untagged(spark, name):
    n = Views(spark, SMALL).prompts().count()
    got = contract.queries()[name](spark, SMALL).collect()
    assert {r.verdict for r in got} <= {"ok", "tags", "special"}
    total = Counter()
    for r in got:
        total[r.dimension] += r.prompts
    assert set(total.values()) == {n}


def test_pairs_of_every_status_reach_the_operator(spark):
    want = Counter((r.pair_id, r.attempt) for r in Views(spark, SMALL).attempts().collect()
                   if r.negative_prompt)
    got = contract.queries()["successful_pairs"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == want


def test_tag_snapshots_hold_every_row(spark):
    rows = first_by_prompt(spark)[0]
    was = {r.record_id for r in rows if "hand" in (r.prompt or "").lower()}
    now = {r.record_id for r in rows if {"has_hand", "has_person"} & set(r.semantic_tags)}
    got = contract.queries()["tag_snapshot_diff"](spark, SMALL).collect()[0]
    assert (got.old_count, got.new_count, got.removed, got.added) == (
        len(was), len(now), len(was - now), len(now - was))


def test_run_report_holds_every_pair(spark):
    want = Counter()
    for r in Views(spark, SMALL).pairs().select("ts", "model_id", "success", "total_attempts").collect():
        key = str(r.ts)[:10] + " 00:00:00", r.model_id
        want[(*key, "total")] += 1
        want[(*key, "valid")] += bool(r.success)
        want[(*key, "attempts")] += r.total_attempts
    got = Counter()
    for r in contract.queries()["streamed_run_report"](spark, SMALL).collect():
        key = r.window_start, r.model_id
        got[(*key, "total")] += r.total_pairs
        got[(*key, "valid")] += r.valid_pairs
        got[(*key, "attempts")] += r.total_attempts
    assert dict(got) == dict(want)


def test_run_report_takes_late_rows_of_later_batches(spark, tmp_path):
    def arrive(*rows):
        spark.createDataFrame(rows, "t string, model_id string, success boolean, "
                                    "total_attempts long").selectExpr(
            "to_timestamp(t) ts", "model_id", "success", "total_attempts").coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "log"))

    def report():
        stream = spark.readStream.schema(
            "ts timestamp, model_id string, success boolean, total_attempts long").option(
            "maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
        return sorted((str(r.window_start)[:10], r.model_id, r.total_pairs, r.valid_pairs)
                      for r in incremental.complete_report(
            stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).collect())

    arrive(("2024-01-01 00:10:00", "m", True, 1), ("2024-01-05 12:00:00", "m", True, 1))
    assert report() == [("2024-01-01", "m", 1, 1), ("2024-01-05", "m", 1, 1)]
    arrive(("2024-01-01 09:00:00", "m", False, 2))
    arrive(("2024-01-05 13:00:00", "n", True, 1))
    assert report() == [("2024-01-01", "m", 2, 1), ("2024-01-05", "m", 1, 1),
                        ("2024-01-05", "n", 1, 1)]
