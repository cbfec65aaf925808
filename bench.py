"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from promptmill.plans.catalog import REGISTRY  # noqa: E402
from promptmill.plans.views import Views  # noqa: E402
from promptmill.session import build_session  # noqa: E402

HEADLINE = [
    "exact_dedup", "dedup_summary", "cleaning_summary", "tag_counts", "dimension_coverage",
    "macro_dimension_matrix", "dimension_subpools", "batch_filter_verdicts", "stratified_sample",
    "reservoir_sample", "people_family_summary", "screened_subpools", "screened_samples",
    "parsed_prompt_lists", "judge_answers", "request_plan", "run_statistics", "generation_speed",
    "failures_by_prompt", "curation_decisions", "pair_outcomes", "next_actions",
    "allocation_template",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


class DealtViews(Views):
    """The bench tables have one row group each, so a scan is one task however many cores there
    are; rows are dealt to the cores first, inside the timed part. A corpus of many files needs
    no such step."""

    def table(self, name):
        return super().table(name).repartition(self.spark.sparkContext.defaultParallelism)


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("promptmill-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    views = DealtViews(spark, sf_dir)

    def run(name):
        REGISTRY[name].plan(views).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        run(name)  # warm: code generation and file cache
        seconds[name] = round(statistics.median(timed(lambda: run(name))
                                                for _ in range(REPEATS)), 3)
    print(json.dumps({"metric": "headline query time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus)}))


main()
