import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from promptmill.plans.catalog import REGISTRY

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the given tables")


@needs_data
def test_flagship(spark):
    assert contract.entry(spark).count() == 32


def test_every_query_has_sql_but_the_ones_sql_cannot_say():
    without = set(REGISTRY) - set(contract.oracle_sql())
    assert without == {"token_counts_by_udf"}
    assert set(REGISTRY) <= set(contract.queries())


def test_names_are_plain():
    for name in REGISTRY:
        assert re.fullmatch(r"[a-z][a-z_]*", name) and "pipeline" not in name


@needs_data
@pytest.mark.parametrize("name", [
    "exact_dedup", "stratified_sample", "batch_filter_verdicts", "screened_samples",
    "curation_decisions", "next_actions", "streamed_next_actions", "request_plan"])
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = contract.queries()[name](spark, SMALL)
    result = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(map(str, r)) for r in result.fetchall()))
    assert sorted(tuple(str(r[n]) for n in names) for r in df.collect()) == want
