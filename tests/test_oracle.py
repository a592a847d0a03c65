"""Every registered workload equals its DuckDB oracle (small scale)."""

import pytest

from tools.compare_oracle import compare
from veilspark.plans.workloads import WORKLOADS


def test_all_workloads_match_oracle(spark, sf_small):
    rep = compare(spark, sf_small, list(WORKLOADS))
    bad = {k: v for k, v in rep.items()
           if not (v.get("hash_match") and v.get("types_match") and v.get("spark_rows") == v.get("oracle_rows"))}
    assert not bad, bad
    assert len(rep) >= 36


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert "ssn_hash" in df.columns
