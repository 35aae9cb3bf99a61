"""Operators on their own, hot groups and odd values included."""

from __future__ import annotations

import random

import pytest
from conftest import ordered, rows
from outorga import fixed
from outorga.fixed.rules import suffix_rules
from outorga.functions.stems import stems, tokens
from outorga.functions.text import is_number_text, null_tokens, strip
from outorga.functions.values import day_first_date, decimal_comma
from outorga.operators.joins import null_safe_join, override
from outorga.operators.keys import dense_ids
from outorga.operators.ranking import principal, rank_in_group, top_with_ties
from outorga.operators.tables import append_member, group_sum, select_existing, union_all
from outorga.session import SETTINGS
from outorga.sinks.targets import jdbc_options
from pyspark.sql import functions as F


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r["x"] for r in df.select("n", fn(F.col("v")).alias("x")).orderBy("n").collect()]


def test_null_tokens(spark):
    values = [*fixed.NULL_TOKENS, "None", " NA", "x", None]
    df = null_tokens(spark.createDataFrame([(v,) for v in values], "v string"))
    assert [r["v"] for r in df.collect()] == [None] * len(fixed.NULL_TOKENS) + ["None", " NA", "x", None]


def test_strip_matches_python(spark):
    values = ["  a b\t", " x　", "\x1cy\x85", "plain", "", " \n ", None]
    assert column(spark, values, strip) == [None if v is None else v.strip() for v in values]


def test_strip_looks_at_both_ends(spark):
    rng = random.Random(1)
    letters = [*fixed.WHITESPACE, "a", "!", "~", "\x00", "\x7f", "\x80", "é", "日", "😀"]
    values = ["".join(rng.choice(letters) for _ in range(rng.randrange(6))) for _ in range(3000)]
    assert column(spark, values, strip) == [v.strip(fixed.WHITESPACE) for v in values]


def test_number_text(spark):
    values = ["12", "", "1a", "٣", "½", None, " 1"]
    assert column(spark, values, is_number_text) == [True, False, False, True, True, False, False]


def test_dates_and_money(spark):
    days = column(spark, ["5/3/2022", "05/03/2022 06:00:01", "2022-03-05", "03/25/2022", "31/02/2022", "x", None], day_first_date)
    assert [str(v) if v else None for v in days] == ["2022-03-05"] * 3 + ["2022-03-25", None, None, None]
    amounts = column(spark, ["1,50", "1.5", "-0,01", "abc", None], decimal_comma)
    assert [None if v is None else str(v) for v in amounts] == ["1.50", "1.50", "-0.01", None, None]


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows in one group, and one value repeated in it again and again."""
    rng = random.Random(7)
    data = [("hot" if n % 3 == 0 else f"g{rng.randrange(40)}", None if n % 97 == 0 else rng.choice([5, rng.randrange(400)]))
            for n in range(6000)]
    return data, spark.createDataFrame(data, "g string, v int")


def test_rank_in_hot_group(hot):
    data, df = hot
    by_group: dict = {}
    for g, v in data:
        by_group.setdefault(g, []).append(v)
    want = sorted(
        ((g, v, None if v is None else 1 + sum(1 for o in by_group[g] if o is not None and o > v)) for g, v in data),
        key=lambda t: tuple((x is None, str(x)) for x in t))
    for slot in (100_000, 300, 7):
        assert rows(rank_in_group(df, "g", "v", slot=slot)) == want


def test_rank_in_one_group_of_all_values(spark):
    df = spark.range(5000).select(F.lit("one").alias("g"), (F.col("id") * 7919 % 5000).alias("v"))
    assert rank_in_group(df, "g", "v", slot=100).where("rank <> 5000 - v").count() == 0
    none = spark.createDataFrame([(None, 1), (None, 2), ("a", 2), ("a", 3)], "g string, v int")
    assert rows(rank_in_group(none, "g", "v", slot=1)) == [("a", 2, 2), ("a", 3, 1), (None, 1, None), (None, 2, None)]


def test_rank_of_nulls_only(spark):
    df = spark.createDataFrame([("a", None)], "g string, v int")
    assert rows(rank_in_group(df, "g", "v")) == [("a", None, None)]


def test_top_with_ties_and_principal(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "w"), ("c", 2, None)], "g string, v int, m string")
    assert rows(top_with_ties(df, "g", "v")) == [("a", 3, "y"), ("a", 3, "z"), ("c", 2, None)]
    assert rows(principal(df, "g", "v", "m", "best")) == [("a", "z")]


def test_dense_ids_do_not_depend_on_layout(hot):
    _, df = hot
    first = rows(dense_ids(df, "id", ["g", "v"], run=50))
    again = rows(dense_ids(df.repartition(13).orderBy(F.rand(3)), "id", ["g", "v"], run=50))
    assert first == again
    assert sorted(r[0] for r in first) == list(range(1, 6001))
    assert sorted((g, v) for _, g, v in first if v is not None) == sorted((g, v) for g, v in rows(df) if v is not None)


def test_dense_ids_spread_copies_of_one_row(spark):
    ids = dense_ids(spark.range(1000).select(F.lit("same").alias("k")), "id", ["k"], run=10)
    assert sorted(r["id"] for r in ids.collect()) == list(range(1, 1001))


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_dense_ids_sort_the_rows_once(spark):
    df = spark.range(900).select((F.col("id") % 300).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("b"))
    plan = final_plan(dense_ids(df, "id", ["a", "b"], run=2))
    assert plan.count("Sort [_bucket#") == 2  # the rows, and the sizes of the buckets
    assert "ReusedExchange" in plan


def test_unique_dense_ids(spark):
    ids = dense_ids(spark.range(500).select(F.col("id").alias("k")), "n", ["k"], unique=True)
    got = rows(ids)
    assert sorted(n for n, _ in got) == list(range(1, 501))
    assert sorted(k for _, k in got) == list(range(500))


def test_null_keys(spark):
    left = spark.createDataFrame([("1", "a"), (None, "b"), ("2", "c")], "k string, x string")
    right = spark.createDataFrame([(None, "n"), ("1", "o"), ("1", "p")], "k string, y string")
    keys = right.select("k").distinct()
    assert rows(null_safe_join(left, keys, "k", "left_semi"), "x") == [("a",), ("b",)]
    assert rows(null_safe_join(left, keys, "k", "left_anti"), "x") == [("c",)]
    assert rows(override(left, right, "k", "y", {"x": "y"}), "x") == [("c",), ("n",), ("o",), ("p",)]


@pytest.mark.parametrize("run", [1_000, 3, 1])
def test_override_of_hot_keys(spark, run):
    rng = random.Random(4)
    left = [(rng.choice([None, None, "hot", "a", "b", "c"]), n % 40, rng.choice(["x", None])) for n in range(300)]
    right = [(rng.choice([None, "hot", "hot", "a", "d"]), rng.choice([None, 1, 2]), "y" if n % 2 else None) for n in range(60)]
    want = []
    for k, n, x in left:
        met = [(w, y) for key, w, y in right if key == k] or [(None, None)]
        want += [(k, n, y if w is not None else x) for w, y in met]
    got = override(
        spark.createDataFrame(left, "k string, n int, x string").repartition(3), spark.createDataFrame(right, "k string, w int, y string"),
        "k", "w", {"x": "y"}, run=run)
    assert got.columns == ["k", "n", "x"] and rows(got) == ordered(want)


def test_override_shuffles_the_left_side_for_its_counts_and_its_cells_only(spark):
    left = spark.createDataFrame([(None if n % 3 else f"k{n}", n, "x") for n in range(200)], "k string, n int, x string").repartition(3)
    right = spark.createDataFrame([(None, "y"), (None, "y"), ("k3", "z")], "k string, y string")
    got = override(left, right, "k", "y", {"x": "y"}, run=20)
    assert got.count() == 133 * 2 + 67
    whole = [line for line in final_plan(got).splitlines() if "Exchange hashpartitioning" in line and "_hot#" not in line]
    assert not [line for line in whole if "isnull(k#" in line and "_a#" not in line]


def test_tables(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, 5.0)], "id int, size double")
    assert rows(union_all([a, b])) == [(1, "x", None), (2, None, 5.0)]
    assert rows(append_member(a, id=-1, name="none")) == [(-1, "none"), (1, "x")]
    assert select_existing(a, ["name", "other", "id"]).columns == ["name", "id"]
    nulls = spark.createDataFrame([("k", None)], "k string, v decimal(18,2)")
    assert [float(v) for _, v in rows(group_sum(nulls, ["k"], "v"))] == [0.0]


def python_stem(word: str) -> str:
    """The steps written word by word."""

    def reduced(word, step):
        for r in suffix_rules():
            if r.step == step and word.endswith(r.suffix) and len(word) >= len(r.suffix) + r.least and word not in r.exceptions:
                return word[: -len(r.suffix)] + r.replacement
        return None

    for step in (0, 1, 3, 2):
        word = reduced(word, step) or word
    for step in (4, 5, 6):
        shorter = reduced(word, step)
        if shorter is not None:
            return shorter
    return word


def test_stems(spark):
    words = ("casas meninas valentona patrona camarona inglesas rapidamente experimente casinha caminho organizado "
             "pavimentos construcao reforma reformas escolas municipais municipal professora trabalhadores cantando "
             "amavel possibilidade contabil jegue mas dois leis").split()
    df = spark.createDataFrame([(words,)], "w array<string>")
    got = df.select(stems(F.col("w")).alias("s")).first()["s"]
    assert got == [python_stem(w) for w in words]
    assert got[words.index("casas")] == "cas"
    assert got[words.index("valentona")] == "valent"
    assert got[words.index("rapidamente")] == "rapid"


def test_tokens(spark):
    got = column(spark, ["Construção de 2 Escolas à beira-rio", "", None], lambda c: tokens(c, ["de"]))
    assert got == [["construcao", "escolas", "beira", "rio"], [], None]


def test_jdbc_options():
    options = jdbc_options("jdbc:mysql://host/db", "convenios", user="u", batch_rows=1000)
    assert options["truncate"] == "true" and options["batchsize"] == "1000" and options["user"] == "u"
    assert "password" not in options


def test_settings_are_runtime_settings(spark):
    for name in SETTINGS:
        assert spark.conf.isModifiable(name)
