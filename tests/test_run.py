"""The whole run on a small register: landing files in, snapshots out."""

from __future__ import annotations

import csv
import datetime as dt
import gzip
import io
import zipfile
from decimal import Decimal

import pytest
from conftest import ordered, rows
from fixture_data import TABLES
from outorga import fixed
from outorga.contracts import check_mart
from outorga.plans import mart
from outorga.schemas import COMMA_SEPARATED, LOAD_ORDER, MART_SCHEMAS, STAGE_COLUMNS
from outorga.sinks.targets import json_sink, ledger_sink, run_sinks
from outorga.sources.landing import load_date, read_raw
from outorga.sources.snapshots import Snapshots
from pyspark.sql import functions as F

DAY = dt.date(2022, 3, 5)
GIVEN_DAY = "05/03/2022"


def d(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%d/%m/%Y").date()


def m(text: str) -> Decimal:
    return Decimal(text)


def csv_text(table: str) -> str:
    out = io.StringIO()
    writer = csv.writer(out, delimiter="," if table in COMMA_SEPARATED else ";", lineterminator="\n")
    writer.writerow(["UNUSED", *STAGE_COLUMNS[table]])
    for n, row in enumerate(TABLES[table]):
        # Nulls arrive as the tokens the reader knows.
        writer.writerow(["x", *(("", "NA", "NULL")[n % 3] if v is None else v for v in row)])
    return out.getvalue()


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    paths = {}
    for table in TABLES:
        text = csv_text(table)
        if table in COMMA_SEPARATED:
            path = folder / f"{table}.csv.gz"
            path.write_bytes(gzip.compress(text.encode()))
        elif table in ("pagamentos", "propostas"):
            path = folder / f"{table}.zip"
            with zipfile.ZipFile(path, "w") as archive:
                archive.writestr(f"{table}.csv", text)
        else:
            path = folder / f"{table}.csv"
            path.write_text(text)
        paths[table] = str(path)
    (folder / "load.csv").write_text(f"data_carga\n{GIVEN_DAY} 06:00:01\n")
    return folder, paths


@pytest.fixture(scope="module")
def store(spark, landing, tmp_path_factory):
    folder, paths = landing
    root = str(tmp_path_factory.mktemp("lake"))
    day = load_date(read_raw(spark, str(folder / "load.csv"), ["data_carga"], sep=","), "data_carga")
    report = mart.run(spark, root, paths, day, today=dt.date(2022, 3, 6))
    assert report.first()["step"] == "RUN"
    return Snapshots(spark, root)


def test_report_counts_every_table(spark, store):
    counts = {(r["zone"], r["table_name"]): r["row_count"] for r in store.manifest().collect()}
    assert counts["stage", "proponentes"] == 3  # padded copy folded
    assert counts["stage", "convenios"] == 5  # unsigned and unpublished ones dropped
    assert counts["stage", "licitacoes"] == 10
    assert {t for z, t in counts if z == "mart"} == set(LOAD_ORDER)
    assert counts["mart", "data_atual"] == 1


def test_schemas(store):
    for table, schema in MART_SCHEMAS.items():
        got = [(f.name, f.dataType) for f in store.read("mart", table).schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields]


def test_quoted_text_survives(store):
    assert {r["OBJETO_PROPOSTA"] for r in store.read("mart", "convenios").collect()} == {"Obra; com \"aspas\"\ne linha"}


def test_estados(store):
    assert rows(store.read("mart", "estados"), "SIGLA", "NOME", "REGIAO_ABREVIADA") == [
        ("BA", "BAHIA", "NE"), ("DF", "DISTRITO FEDERAL", "CO"), ("RO", "RONDÔNIA", "NO"),
        ("RS", "RIO GRANDE DO SUL", "SU"), ("SP", "SÃO PAULO", "SE"), ("XX", "LONGE", None)]


def test_municipios(store):
    assert rows(store.read("mart", "municipios")) == [
        (1100205, "PORTO VELHO", "RO", "NORTE", "NO", "RONDÔNIA", -8.76, -63.9, "SIM"),
        (2900001, "VILA", "BA", "NORDESTE", "NE", "BAHIA", -12.5, None, "NAO"),
        (3500001, "SEM LATITUDE", "SP", "SUDESTE", "SE", "SÃO PAULO", None, -46.1, "NAO"),
        (9999999, "Outra", "SP", "SUDESTE", "SE", "SÃO PAULO", None, None, "NAO"),
        (None, "Nenhures", "ZZ", None, None, fixed.UNSPECIFIED_M, None, None, "NAO")]


def test_proponentes(store):
    assert rows(store.read("mart", "proponentes")) == [
        ("A1", "Prefeitura A", 1100205), ("A1", "Prefeitura A", 9999999), ("B2", "Instituto B", None)]


def test_amendments(store):
    assert rows(store.read("mart", "emendas_convenios")) == ordered([
        (201110, 704101, m("50.00")), (201110, 774717, m("50.00")), (20107, 700427, m("100.00")),
        (20108, 700427, m("100.00")), (20119, 704101, None), (20119, 774717, None)])
    # The equal transfer to two grants counts once.
    assert rows(store.read("mart", "emendas")) == ordered([
        (201110, "Bia", "BANCADA", m("50.00")), (20107, "Ana", "INDIVIDUAL", m("100.00")),
        (20108, "Zeca", "INDIVIDUAL", m("100.00")),
        (20119, fixed.UNSPECIFIED_M, fixed.UNSPECIFIED_M, m("0.00"))])


def test_convenios(store):
    fact = store.read("mart", "convenios")
    assert rows(fact, "NR_CONVENIO", "DIA_ASSIN_CONV", "SIT_CONVENIO", "INSTRUMENTO_ATIVO", "VL_GLOBAL_CONV",
                "COM_EMENDAS", "VALOR_EMENDA_CONVENIO", "NATUREZA_JURIDICA", "INSUCESSO") == [
        (700427, d("05/01/2009"), "EM EXECUÇÃO", "NAO", m("1000.50"), "SIM", m("200.00"), "MUNICIPAL", 0.0),
        (704101, d("02/02/2011"), "INADIMPLENTE", "NAO", m("3000.00"), "SIM", m("50.00"), "MUNICIPAL", 0.0),
        (756498, d("03/02/2012"), "PRESTAÇÃO DE CONTAS REJEITADA", "SIM", m("4000.00"), "NAO", m("0.00"), "MUNICIPAL", 0.0),
        (774717, d("01/02/2011"), "#(INDEFINIDA)", "SIM", m("2000.00"), "SIM", m("50.00"), "MUNICIPAL", 0.0)]


def test_licitacoes(store):
    na = fixed.NOT_APPLICABLE
    got = rows(store.read("mart", "licitacoes"), "ID_LICITACAO", "MODALIDADE_COMPRA", "TIPO_LICITACAO", "FORMA_LICITACAO",
               "REGISTRO_PRECOS", "LICITACAO_INTERNACIONAL", "STATUS_LICITACAO", "VALOR_LICITACAO")
    assert got == [
        (1, "PREGÃO", "MENOR PREÇO", "PRESENCIAL", "NAO", "NAO", "CONCLUÍDA", m("10.00")),
        (2, "ELETRÔNICA", na, "ELETRÔNICO", "SIM", "NAO", "CONCLUÍDA", m("10.00")),
        (3, fixed.UNSPECIFIED_F, "MENOR PREÇO", "ELETRÔNICO", "SIM", "NAO", "CONCLUÍDA", m("10.00")),
        (4, "CONVITE", "MELHOR TÉCNICA", na, "NAO", "NAO", "CONCLUÍDA", m("10.00")),
        (5, "CONVITE", "TÉCNICA E PREÇO", na, "NAO", "NAO", "#(INDEFINIDO)", m("0.00")),
        (6, "CONVITE", na, na, "NAO", "NAO", "CONCLUÍDA", m("10.00")),
        (7, "CONVITE", "MENOR PREÇO", na, "NAO", "NAO", "CONCLUÍDA", m("10.00")),
        (8, "CONVITE", na, na, "NAO", "NAO", "CONCLUÍDA", m("10.00")),
        (8, "CONVITE", na, na, "NAO", "NAO", "CONCLUÍDA", m("10.00"))]  # apart in case before upper-casing


def test_fornecedores(store):
    dimension = store.read("mart", "fornecedores")
    assert rows(dimension, "IDENTIF_FORNECEDOR", "NOME_FORNECEDOR") == sorted([
        (fixed.UNSPECIFIED_F, fixed.UNSPECIFIED_M), ("B1", "BENEF UM"), ("B3", "BENEF TRES"), ("F1", "FIRMA UM"),
        ("F2", "FIRMA DOIS"), (fixed.NO_MEMBER, fixed.NO_MEMBER)])
    assert sorted(r[0] for r in rows(dimension, "FORNECEDOR_ID")) == [-1, 1, 2, 3, 4, 5]


def test_movimento(store):
    ledger = store.read("mart", "movimento")
    f1 = store.read("mart", "fornecedores").where("NOME_FORNECEDOR = 'FIRMA UM'").first()["FORNECEDOR_ID"]

    def leg(kind):
        return rows(ledger.where(f"TIPO_MOV = '{kind}'"), "NR_CONVENIO", "DATA_MOV", "VALOR_MOV", "FORNECEDOR_ID")

    assert [len(leg(k)) for k in "AIF"] == [4, 4, 4]
    assert leg("I")[0] == (700427, d("10/01/2009"), m("1000.50"), -1)
    assert leg("D") == ordered([
        (774717, d("01/03/2011"), m("10.00"), -1), (774717, d("01/03/2011"), m("10.00"), -1),
        (774717, d("24/06/2014"), m("3.00"), -1)])
    assert leg("C") == ordered([(704101, d("30/12/2009"), m("20.00"), -1), (704101, d("05/02/2012"), m("21.00"), -1)])
    assert leg("P") == ordered([
        (756498, d("10/01/2011"), m("12.00"), f1), (756498, d("03/09/2012"), m("13.00"), f1),
        (756498, d("09/12/2012"), m("11.00"), f1)])
    assert leg("T") == ordered([
        (700427, d("01/01/2009"), m("2.00"), -1), (700427, d("30/09/2009"), m("1.00"), -1),
        (756498, d("10/01/2011"), m("3.00"), -1), (774717, d("05/02/2011"), m("0.00"), -1),
        (999, d("01/01/2020"), m("4.00"), -1)])
    ids = sorted(r[0] for r in rows(ledger, "MOV_ID"))
    assert ids == list(range(1, len(ids) + 1))


def test_calendario_and_data_atual(store):
    days = store.read("mart", "calendario")
    assert days.count() == (DAY - d("01/01/2009")).days + 1
    assert rows(days.where("DATA = '2021-01-01'")) == [(
        d("01/01/2021"), 2021, 1, "janeiro", 202101, "01 2021", "janeiro 2021", 1, "1o semestre", 202101, "01 2021",
        "1o semestre 2021", 53, "53a semana", 202153, "53 2021", "53a semana 2021", "sexta-feira")]
    assert rows(store.read("mart", "data_atual")) == [(DAY,)]


def test_atributos(store):
    got = rows(store.read("mart", "atributos"))
    assert ("MODALIDADE_TRANSFERENCIA", "CONVENIO") in got
    assert ("TIPO_PARLAMENTAR", "BANCADA") in got
    assert {a for a, _ in got} == {
        "SIT_CONVENIO", "NATUREZA_JURIDICA", "MODALIDADE_TRANSFERENCIA", "TIPO_PARLAMENTAR", "MODALIDADE_COMPRA",
        "TIPO_LICITACAO", "FORMA_LICITACAO", "STATUS_LICITACAO"}
    assert len(got) == len(set(got))


def test_contracts(store):
    found = {(r["table_name"], r["contract"], r["column_name"]): r["violations"]
             for r in check_mart(store.read_zone("mart")).collect()}
    assert found["proponentes", "unique key", "IDENTIF_PROPONENTE"] == 1  # one proponent, two municipalities
    assert found["licitacoes", "unique key", "ID_LICITACAO"] == 1
    assert found["movimento", "unique key", "MOV_ID, DATA_MOV"] == 0
    assert found["emendas_convenios", "not null", "VALOR_REPASSE_EMENDA"] == 2
    assert found["movimento", "reference to convenios", "NR_CONVENIO"] == 1
    assert found["municipios", "reference to estados", "UF"] == 1
    assert found["movimento", "text length", "TIPO_MOV"] == 0


def test_rerun_gates(spark, store, landing):
    _, paths = landing
    day = spark.createDataFrame([(DAY,)], "DATA_ATUAL date")
    again = mart.run(spark, store.root, paths, day, today=dt.date(2022, 3, 6))
    assert [r["step"] for r in again.collect()] == ["UNCHANGED"]
    fresh = mart.run(spark, store.root, paths, day, today=DAY)
    assert [r["step"] for r in fresh.collect()] == ["UP_TO_DATE"]
    # Forcing the build passes the gate; recent stage tables are still not staged again.
    before = store.manifest().where("zone = 'stage'").count()
    forced = mart.run(spark, store.root, paths, day, today=DAY, force_build=True).collect()
    assert forced[0]["step"] == "RUN"
    assert store.manifest().where("zone = 'stage'").count() == before


def test_a_build_that_fails_midway_leaves_the_mart_whole(spark, store, landing, monkeypatch):
    _, paths = landing
    day = spark.createDataFrame([(DAY,)], "DATA_ATUAL date")
    before = store.paths("mart")
    with monkeypatch.context() as m:
        m.setattr(mart.derived, "atributos", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            mart.run(spark, store.root, paths, day, today=DAY, force_build=True)
    assert store.paths("mart") == before
    report = mart.run(spark, store.root, paths, day, today=DAY, force_build=True).collect()
    assert not set(store.paths("mart").values()) & set(before.values())
    latest = store.current("mart").agg(F.count_distinct("written_at"), F.count("*")).first()
    assert tuple(latest) == (1, 12)  # all became current in one line file
    assert {r["table_name"]: r["rows"] for r in report if r["step"] == "contracts"}["licitacoes"] == 1
    assert store.read("checks", "contracts").where("contract = 'unique key' and violations > 0").count() == 2


def test_sinks_take_up_where_they_failed(spark, store, landing, tmp_path):
    _, paths = landing
    day, failures, written = spark.createDataFrame([(DAY,)], "DATA_ATUAL date"), iter([True]), []

    def shaky(table, df):
        if table == "calendario" and next(failures, False):
            raise ConnectionError("target is down")
        written.append((table, df.count()))

    sinks = {"shaky": shaky, "json": json_sink(str(tmp_path / "json"))}
    counts = {t: store.read("mart", t).count() for t in LOAD_ORDER}

    def step(**given):
        report = mart.run(spark, store.root, paths, day, today=dt.date(2022, 3, 6), sinks=sinks, **given).collect()
        assert report[0]["step"] == "UNCHANGED"
        return [(r["step"], r["table_name"], r["rows"]) for r in report[1:]]

    first = step()
    done = LOAD_ORDER[:LOAD_ORDER.index("calendario")]
    assert first == [*[("shaky WRITTEN", t, counts[t]) for t in done], ("shaky FAILED", "calendario", None),
                     *[("json WRITTEN", t, counts[t]) for t in LOAD_ORDER]]
    second = step()
    assert second[:12] == [(f"shaky {'HELD' if t in done else 'WRITTEN'}", t, counts[t]) for t in LOAD_ORDER]
    assert all(s == "json HELD" for s, _, _ in second[12:])
    assert sorted(written) == sorted(counts.items())
    assert all(s.endswith("HELD") for s, _, _ in step()) and len(written) == 12


def test_sinks(spark, store, tmp_path):
    def down(table, df):
        raise ConnectionError("target is down")

    tables = {t: store.read("mart", t) for t in LOAD_ORDER}
    report = run_sinks(spark, {"down": down, "json": json_sink(str(tmp_path / "json"))}, tables)
    assert report.where("sink = 'down'").count() == 1
    assert report.where("sink = 'json' and error is null").count() == 12
    lines = spark.read.text(str(tmp_path / "json" / "municipios"))
    assert lines.where("value like '%\"LATITUDE\":null%'").count() == 3
    assert lines.where("value like '%RONDÔNIA%'").count() == 1
    only = spark.read.text(str(tmp_path / "json" / "data_atual")).first()["value"]
    assert only == '{"DATA_ATUAL":1646438400000}'
    ledger_sink(str(tmp_path / "year"))("movimento", tables["movimento"])
    back = spark.read.parquet(str(tmp_path / "year" / "movimento"))
    assert back.count() == tables["movimento"].count()
    assert back.where("ANO_MOV <> year(DATA_MOV)").count() == 0
