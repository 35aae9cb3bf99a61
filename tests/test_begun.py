"""Jobs side by side."""

from __future__ import annotations

import threading

import pytest
from catalog.registry import Inputs
from conftest import rows
from outorga.session import JOBS, begun


def test_jobs_run_side_by_side_and_raise_where_they_are_asked(spark):
    met = threading.Barrier(JOBS, timeout=60)

    def job(n):
        met.wait()  # never passed by jobs that run one after another
        return spark.range(n).count()

    futures = begun(spark, [lambda n=n: job(n) for n in range(JOBS)])
    assert [f.result() for f in futures] == list(range(JOBS))
    bad, good = begun(spark, [lambda: spark.sql("select raise_error('no')").collect(), lambda: spark.range(3).count()])
    assert good.result() == 3
    with pytest.raises(Exception, match="no"):
        bad.result()


def test_begun_tables_are_staged_once_for_all_who_ask(spark, tmp_path):
    nation = [(n, f" N{n} ", n % 5) for n in range(25)]
    spark.createDataFrame(nation * 2, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    inputs = Inputs(spark, str(tmp_path))
    plain, ahead = inputs.staged(), inputs.staged().begin("estados")
    asked = begun(spark, [lambda: ahead["estados"]] * JOBS)
    assert [rows(f.result()) for f in asked] == [rows(plain["estados"])] * JOBS
    assert len(rows(plain["estados"])) == 25
