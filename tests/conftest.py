from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from outorga.schemas import STAGE_COLUMNS, stage_schema  # noqa: E402
from outorga.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def stage_table(spark):
    """Rows to a raw all-text table of the stage schema."""

    def make(name: str, *rows: tuple):
        assert all(len(r) == len(STAGE_COLUMNS[name]) for r in rows)
        return spark.createDataFrame(list(rows), stage_schema(name))

    return make


def ordered(tuples):
    return sorted(tuples, key=lambda t: tuple((v is None, str(v)) for v in t))


def rows(df, *columns):
    """Result rows as an ordered list of tuples."""
    picked = df.select(*columns) if columns else df
    return ordered(tuple(r) for r in picked.collect())
