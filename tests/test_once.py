"""Work that is done once: rows that stay where they are, ids with one shuffle, columns that are carried along."""

from __future__ import annotations

import glob
import os

import pytest
from catalog import marts
from catalog.registry import QUERIES, Inputs
from conftest import rows
from outorga.operators import tables as tables_
from outorga.llm.common import stored
from outorga.operators.keys import dense_ids
from outorga.operators.ranking import top_with_ties
from outorga.operators.tables import without_copies
from outorga.plans import ledger
from outorga.risk import features, linear
from outorga.session import cut_lineage
from outorga.sources.stage import clean_stage
from pyspark.sql import functions as F


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_are_found_by_digest(spark):
    # the digest leaves nulls out, so the first two rows share one and differ
    data = [("a", None), (None, "a"), ("b", "c"), ("b", "c"), ("b", "c"), (None, None), (None, None), ("d", "e")]
    df = cut_lineage(spark.createDataFrame(data, "x string, y string"))
    want = rows(df.distinct())
    assert len(want) == 5
    assert rows(without_copies(df)) == want
    assert rows(without_copies(df, few=0)) == want  # repeated rows in plenty: written down again
    different = cut_lineage(spark.range(100).select(F.col("id").cast("string").alias("x")))
    assert "Exchange" not in plan_of(without_copies(different)) and len(rows(without_copies(different))) == 100


@pytest.mark.parametrize("padded", [0, 3])
def test_staging_moves_no_whole_rows(spark, stage_table, padded):
    lines = [(str(n), f" {n} ", "A", "B", None) for n in range(40)] + [(f"{n} ", str(n), "A", " B", "N/A") for n in range(padded)]
    raw = stage_table("emendas", *lines)
    clean = clean_stage(raw, "emendas", cut_lineage)
    assert rows(clean) == rows(clean_stage(raw, "emendas")) and clean.count() == 40
    if not padded:
        assert "Exchange" not in plan_of(clean)


@pytest.mark.parametrize("copies", [1, 3, 70])
def test_ids_of_kept_rows(spark, copies):
    """Rows with more copies than a run are folded, others are not; the ids are those of the fold in both cases."""
    n = F.col("id")
    data = [spark.range(500).select((n % 100).alias("a"), F.when(n % 7 > 0, n).alias("b")),
            spark.range(copies).select(F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))]
    df = data[0].unionByName(data[1])
    kept = dense_ids(df, "id", ["a", "b"], run=20, keep=cut_lineage)
    assert rows(kept) == rows(dense_ids(df, "id", ["a", "b"], run=20))
    assert [r[0] for r in sorted(rows(kept), key=lambda r: r[0])] == list(range(1, 501 + copies))
    assert ("hashpartitioning(a#" in plan_of(kept)) == (copies == 70)  # the shuffle of the fold


def test_ids_of_one_row_without_end(spark):
    df = spark.range(1000).select(F.lit("same").alias("k"))
    assert rows(dense_ids(df, "id", ["k"], run=10, keep=cut_lineage)) == rows(dense_ids(df, "id", ["k"], run=10))
    assert rows(dense_ids(df.limit(0), "id", ["k"], keep=cut_lineage)) == []


def test_long_features_carry_columns(spark):
    df = spark.createDataFrame([(1, "g", 2.0, "p"), (2, None, None, "q")], "r long, name string, a double, who string")
    scale = linear.statistics(df, ["a"])
    plain = linear.long_features(df, "r", scale, ["a"], [], ["who"])
    carried = linear.long_features(df, "r", scale, ["a"], [], ["who"], carried=["name"])
    assert rows(carried, "row", "column", "value") == rows(plain)
    assert {(r["row"], r["name"]) for r in carried.collect()} == {(1, "g"), (2, None)}


def test_codec_of_written_tables(spark):
    df = spark.range(10)
    assert all(".zstd." in path for path in parts(cut_lineage(df)))
    assert not any(".zstd." in path for path in parts(stored(df)))  # the corpus operators keep the session's


def parts(df) -> list[str]:
    found = [path for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()} for path in glob.glob(f"{folder.removeprefix('file:').replace('//', '')}/*.parquet")]
    assert found
    return found


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty orders of eight customers, two lines each."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = "timestamp'1995-01-01' + make_interval(0, 0, 0, cast(id as int))"
    orders = spark.range(1, 41).selectExpr(
        "id o_orderkey", "id % 8 + 1 o_custkey", "if(id % 3 = 0, 'O', 'F') o_orderstatus", "id * 100.0D o_totalprice",
        f"{day} o_orderdate", "concat(id % 3, '-HIGH') o_orderpriority")
    customer = spark.range(1, 9).selectExpr(
        "id c_custkey", "concat('Customer#', id) c_name", "cast(id as int) c_nationkey", "1.0D c_acctbal", "if(id % 2 = 0, 'BUILDING', 'MACHINERY') c_mktsegment")
    lineitem = spark.range(80).selectExpr(
        "id div 2 + 1 l_orderkey", "id + 1 l_partkey", "id % 9 + 1 l_suppkey", "cast(id % 2 + 1 as int) l_linenumber", "2.0D l_quantity",
        "id * 10.0D + 5 l_extendedprice", "0.05D l_discount", "0.02D l_tax", "if(id % 4 = 0, 'R', 'N') l_returnflag", "if(id % 3 = 0, 'O', 'F') l_linestatus",
        f"{day} l_shipdate")
    for name, df in {"orders": orders, "customer": customer, "lineitem": lineitem}.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name, sums, joins", [("m6_long_features", 1, 0), ("m8_linear_scores", 2, 4), ("m10_linear_appended", 1, 2)])
def test_cells_are_read_once_for_each_sum(spark, tables, name, sums, joins):
    """The weights of the columns are written down, and cells don't meet the frame again for the number of the grant."""
    found = QUERIES[name](spark, tables)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("Generate inline"), plan.count("Join ")) == (sums, joins)
    assert found.count() > 0


def test_rows_of_one_digest_are_left_alone_unless_they_are_copies(spark):
    df = cut_lineage(spark.createDataFrame([("a", None), (None, "a"), ("b", "c")], "x string, y string"))
    alone = without_copies(df)
    assert len(rows(alone)) == 3 and "Join" not in plan_of(alone)


def test_digests_are_shuffled_in_lists(spark, monkeypatch):
    df = cut_lineage(spark.range(5000).selectExpr("cast(id % 4990 as string) x", "id % 7 * 0 y").repartition(2))
    found = []
    monkeypatch.setattr(tables_, "cut_lineage", lambda df: found.append(plan_of(df)) or cut_lineage(df))
    assert without_copies(df).count() == 4990
    assert "collect_list" in found[0] and "hashpartitioning(_list" in found[0] and "hashpartitioning(_digest" not in found[0]


def test_ids_shuffle_the_keys_alone(spark):
    df = spark.range(200).select((F.col("id") % 9).alias("a"), F.col("id").alias("b"))
    plan = plan_of(dense_ids(df, "id", ["a", "b"], unique=True))
    assert "hashpartitioning(substring(md5(" in plan and "hashpartitioning(_bucket" not in plan


def test_deltas_of_ids(spark):
    ids = spark.range(300_000).coalesce(1)
    plain, deltas = (cut_lineage(ids, codec="uncompressed", deltas=d) for d in (False, True))
    assert sum(map(os.path.getsize, parts(deltas))) * 10 < sum(map(os.path.getsize, parts(plain)))
    assert deltas.agg(F.sum("id"), F.count("id")).first() == plain.agg(F.sum("id"), F.count("id")).first()


def test_winners_of_gathered_groups(spark):
    data = [("a", 3, "x"), ("a", 3, "y"), ("a", 1, "z"), ("b", None, "x"), (None, 9, "x"), ("c", -2, "x")]
    df = spark.createDataFrame(data, "g string, v int, n string")
    gathered = df.repartition("g")
    assert rows(top_with_ties(gathered, "g", "v", gathered=True)) == rows(top_with_ties(df, "g", "v")) != []
    assert plan_of(top_with_ties(gathered, "g", "v", gathered=True)).count("Exchange") == 1


def test_marts_of_both_orders_hold_the_same_rows(spark, tables):
    i = Inputs(spark, tables)
    ordered, other = (marts.mart(i, in_order) for in_order in (True, False))
    assert other.keys() - ordered.keys() == {"politicians", "paid_most"}
    for name, df in ordered.items():
        assert rows(df) == rows(other[name]) != [], name
    stage = i.staged(in_order=False)
    assert all("Exchange" not in plan_of(stage[name]) for name in ("convenios", "proponentes"))


def test_principals_are_found_once_for_two_frames(spark, tables):
    given = marts.mart(Inputs(spark, tables), in_order=False)
    mart = {name: df for name, df in given.items() if name not in ("politicians", "paid_most")}
    want = rows(features.feature_frame(mart["convenios"], mart))
    given = {name: df for name, df in given.items() if name not in ("movimento", "emendas_convenios")}  # no ledger to ask
    assert rows(features.feature_frame(mart["convenios"], given)) == want != []
    live = features.live(mart["convenios"])
    assert rows(features.feature_frame(live, given)) == rows(features.feature_frame(live, mart)) != []


def test_payments_are_written_down_once(spark, tables):
    mart = marts.mart(Inputs(spark, tables), in_order=False)
    kept = []
    ledger.movimento(Inputs(spark, tables).staged(), mart["convenios"], mart["fornecedores"], keep_legs=lambda df: kept.append(df) or cut_lineage(df))
    kinds = {r[0] for df in kept for r in df.select("TIPO_MOV").distinct().collect()}
    assert kinds and "P" not in kinds and mart["movimento"].where("TIPO_MOV = 'P'").count() > 0
