"""Registered queries against their SQL on the smallest data, and the shape of the registry."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
HEAVY = re.compile(r"^(t9|t11|t13|u3|j8|l[67]|m[5-8]_|m10|m4|v_mart)")
LIGHT = [name for name in entry.oracle_sql() if not HEAVY.match(name) and not re.match(r"op\d+_|pipeline", name)]

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    from tools.check import oracle

    return oracle(SMALL)


@pytest.mark.parametrize("name", LIGHT)
def test_query_equals_sql(spark, con, name):
    from tools.check import compare

    verdict, _, _ = compare(spark, con, name, SMALL)
    assert verdict == "ok"


def test_every_inventory_entry_has_a_query():
    names = set(entry.queries())
    groups = {"s": 13, "p": 18, "f": 5, "j": 15, "a": 10, "w": 4, "u": 4, "k": 2, "c": 4, "x": 6, "t": 13, "m": 12, "v": 4}
    missing = [f"{letter}{n}" for letter, count in groups.items() for n in range(1, count + 1)
               if not any(re.match(rf"{letter}{n}_", name) for name in names)]
    assert missing == []
    assert set(entry.oracle_sql()) <= names


def test_entry(spark):
    df = entry.entry(spark)
    assert "VALOR_EMENDA_CONVENIO" in df.columns and df.count() > 0
