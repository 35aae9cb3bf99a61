"""The whole run: landing to stage, stage to mart, mart to targets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga.contracts import check_mart
from outorga.plans import derived, geography, grants, ledger, procurements, suppliers
from outorga.risk.model import RiskModel, score_live
from outorga.schemas import COMMA_SEPARATED, STAGE_COLUMNS
from outorga.session import spread
from outorga.sinks.targets import Sink, export
from outorga.sources.gates import RUN, freshness, stale_tables
from outorga.sources.delimited import read_ranges, read_zipped
from outorga.sources.landing import read_raw
from outorga.sources.snapshots import Snapshots, Written
from outorga.sources.stage import clean_stage

COMPRESSED = (".gz", ".bz2", ".zst", ".xz", ".deflate", ".lz4", ".snappy")
STAGE, WORK, MART, CHECKS = "stage", "work", "mart", "checks"
REPORT = "step string, table_name string, rows long"


def read_landing(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Plain files in byte ranges, zip archives by member, other compressed files one to a task."""
    sep = "," if table in COMMA_SEPARATED else ";"
    if path.endswith(".zip"):
        return spread(read_zipped(spark, path, STAGE_COLUMNS[table], sep))
    if path.endswith(COMPRESSED):
        return spread(read_raw(spark, path, STAGE_COLUMNS[table], sep))
    return read_ranges(spark, path, STAGE_COLUMNS[table], sep)


def stage(
    spark: SparkSession, store: Snapshots, landing: dict[str, str], day: dt.date, force: bool = False,
) -> DataFrame:
    """Stage every landed table (name -> path) that has no snapshot as recent as ``day``."""
    wanted = spark.createDataFrame([(t, day) for t in landing], "table_name string, source_date date")
    due = wanted if force else stale_tables(wanted, store.current(STAGE))
    names = {r["table_name"] for r in due.collect()}
    report = []
    for table, path in landing.items():
        if table in names:
            written = store.write(clean_stage(read_landing(spark, path, table), table), STAGE, table, day)
            report.append((STAGE, table, written.rows))
    return spark.createDataFrame(report, REPORT)


def build(spark: SparkSession, store: Snapshots, day: dt.date, model: RiskModel | None = None) -> DataFrame:
    """Build the twelve mart tables and check them. Every table is read back by those after it, so nothing shared is
    computed twice. All become current together at the end, with the counts of broken contracts; a build that
    fails before leaves the mart as it was."""
    raw = store.read_zone(STAGE)
    done: dict[tuple[str, str], Written] = {}

    def put(table: str, df: DataFrame, zone: str = MART) -> DataFrame:
        done[zone, table] = written = store.put(df, zone, table, day)
        return spark.read.schema(df.schema).parquet(written.path)

    mart = {"estados": put("estados", geography.estados(raw)), "municipios": put("municipios", geography.municipios(raw))}
    granted = put("granted", grants.shared_grants(raw), WORK)
    mart["proponentes"] = put("proponentes", grants.proponentes(raw))
    transfers = put("transfers", grants.amendment_transfers(raw, granted), WORK)
    bridge = mart["emendas_convenios"] = put("emendas_convenios", grants.emendas_convenios(transfers))
    mart["emendas"] = put("emendas", grants.emendas(transfers))
    scored = grants.convenios(raw, bridge, granted)
    fact = put("convenios", scored) if model is None else put("unscored", scored, WORK)
    mart["licitacoes"] = put("licitacoes", procurements.licitacoes(raw, fact))
    paid = mart["fornecedores"] = put("fornecedores", suppliers.fornecedores(raw, fact))
    mart["movimento"] = put("movimento", ledger.movimento(raw, fact, paid, keep=lambda leg: put("payments", leg, WORK)))
    mart["atributos"] = put("atributos", derived.atributos(fact, mart["emendas"], mart["licitacoes"]))
    mart["calendario"] = put("calendario", derived.calendario(mart["movimento"], "DATA_MOV", F.lit(day)))
    mart["convenios"] = fact if model is None else put("convenios", score_live(fact, mart, model))
    mart["data_atual"] = put("data_atual", derived.data_atual(spark, day))
    broken = put("contracts", check_mart(mart), CHECKS).groupBy("table_name").agg(F.sum("violations").alias("rows"))
    store.publish(list(done.values()))
    report = spark.createDataFrame([(v.zone, v.table, v.rows) for v in done.values()], REPORT)
    return report.unionByName(broken.select(F.lit("contracts").alias("step"), "table_name", "rows"))


def run(
    spark: SparkSession, root: str, landing: dict[str, str], load_day: DataFrame, today: dt.date,
    model: RiskModel | None = None, force_stage: bool = False, force_build: bool = False, sinks: dict[str, Sink] | None = None,
) -> DataFrame:
    """Stage and build if the source (one-row DATA_ATUAL) is newer than the mart, then bring the sinks up to the mart,
    whether there were news or not. ``force_build`` passes the gate, ``force_stage`` also stages tables that are
    recent. Returns the run report (step, table_name, rows): its first row is the gate's status; further steps are the
    zones written, broken contracts by table, and what each sink wrote, held or failed at."""
    store = Snapshots(spark, root)
    held = store.current(MART).where("table_name = 'data_atual'").select(F.col("snapshot_date").alias("DATA_ATUAL"))
    gate = freshness(load_day, "DATA_ATUAL", held, "DATA_ATUAL", F.lit(today), force_stage or force_build).first()
    report = spark.createDataFrame([(gate["STATUS"], None, None)], REPORT)
    if gate["STATUS"] == RUN:
        day = gate["SOURCE_DATE"]
        report = report.unionByName(stage(spark, store, landing, day, force_stage)).unionByName(build(spark, store, day, model))
    if sinks:
        taken = export(store, sinks, MART)
        report = report.unionByName(taken.select(F.concat_ws(" ", "sink", "status").alias("step"), "table_name", "rows"))
    return report
