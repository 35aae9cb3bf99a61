"""Scans, cleaning, filters, joins, aggregates, ranks, unions, keys and calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.raw_views import day_text, every, money_text, pick, text
from catalog.registry import Inputs, query
from catalog.views_sql import D, M, STATE_LIST, STRIP, calendar_select, case_map, day, money, number_text, quoted
from outorga import fixed
from outorga.functions import labels, procurement, values
from outorga.functions import text as texts
from outorga.operators import joins, keys, ranking, tables
from outorga.plans import derived, grants, suppliers
from outorga.schemas import MART_SCHEMAS, STAGE_COLUMNS
from outorga.sources import gates
from outorga.sources.delimited import read_ranges, read_zipped
from outorga.sources.landing import load_date, read_raw
from outorga.sources.snapshots import Snapshots
from outorga.sources.stage import clean_stage

# ------------------------------------------------------------------ scans and staging


@query("s1_delimited_scan", "select * from v_pagamentos")
def _(i: Inputs):
    folder = f"{i.scratch()}/pagamentos"
    i.raw("pagamentos").write.options(header=True, sep=";", quote='"', escape='"').csv(folder)
    return read_ranges(i.spark, folder, STAGE_COLUMNS["pagamentos"])


_BROKEN = "NOME_FORNECEDOR || chr(10) || chr(34) || coalesce(NR_MOV_FIN, '') || chr(34) || ';' || chr(13) || chr(10) || chr(10) || NOME_FORNECEDOR"


@query("s1_quoted_ranges", f"select * replace ({_BROKEN} as NOME_FORNECEDOR) from v_pagamentos")
def _(i: Inputs):
    """Files whose quoted fields hold line breaks, quotes and separators, read in ranges of 64 KB."""
    folder = f"{i.scratch()}/pagamentos"
    rows = i.raw("pagamentos").withColumn("NOME_FORNECEDOR", F.expr(_BROKEN))
    rows.write.options(header=True, sep=";", quote='"', escape='"').csv(folder)
    return read_ranges(i.spark, folder, STAGE_COLUMNS["pagamentos"], step=1 << 16)


_INJECTED = [*fixed.NULL_TOKENS, "NULA", "Na"]


@query("s2_null_tokens", f"""
select ID_LICITACAO, case when tok in ({quoted(fixed.NULL_TOKENS)}) then null else tok end STATUS_LICITACAO, VALOR_LICITACAO
from (select *, [{quoted(_INJECTED)}][cast(ID_LICITACAO as bigint) % {len(_INJECTED)} + 1] tok from v_licitacoes)""")
def _(i: Inputs):
    token = pick(_INJECTED, F.col("ID_LICITACAO").cast("long") % len(_INJECTED))
    rows = i.raw("licitacoes").select("ID_LICITACAO", token.alias("STATUS_LICITACAO"), "VALOR_LICITACAO")
    return texts.null_tokens(rows)


@query("s3_column_pruning", "select l_orderkey, l_returnflag from lineitem")
def _(i: Inputs):
    return i.lineitem.select("l_orderkey", "l_returnflag")


@query("s4_staging_distinct", "select distinct l_partkey, l_suppkey from lineitem")
def _(i: Inputs):
    return i.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("s5_unicode_trim", f"""
select c_custkey, trim(chr(9) || chr(160) || c_name || chr(8195) || chr(10), {STRIP}) c_name from customer""")
def _(i: Inputs):
    padded = F.concat(F.lit("\t\xa0"), "c_name", F.lit(" \n"))
    return texts.on_text_columns(i.customer.select("c_custkey", padded.alias("c_name")), texts.strip)


@query("s6_required_fields", """
select NR_CONVENIO, null NR_MOV_FIN, 'convenios' source from v_convenios where DIA_ASSIN_CONV is not null and DIA_PUBL_CONV is not null
union all select null, NR_MOV_FIN, 'obtv' from v_obtv where IDENTIF_FAVORECIDO_OBTV_CONV is not null""")
def _(i: Inputs):
    grants_ = i.raw("convenios").dropna(subset=["DIA_ASSIN_CONV", "DIA_PUBL_CONV"])
    transfers = i.raw("obtv").dropna(subset=["IDENTIF_FAVORECIDO_OBTV_CONV"])
    return tables.union_all([
        grants_.select("NR_CONVENIO", F.lit("convenios").alias("source")),
        transfers.select("NR_MOV_FIN", F.lit("obtv").alias("source"))])


@query("s7_value_normalisation", """
select NR_CONVENIO, case when upper(INSTRUMENTO_ATIVO) = 'NÃO' then 'NAO' else INSTRUMENTO_ATIVO end INSTRUMENTO_ATIVO from v_convenios""")
def _(i: Inputs):
    return i.raw("convenios").select(
        "NR_CONVENIO", texts.without_tilde_no(F.col("INSTRUMENTO_ATIVO")).alias("INSTRUMENTO_ATIVO"))


def _last_day(i: Inputs, name: str, column: str):
    return i.table(name).agg(F.max(F.col(column).cast("date")).alias("day"))


@query("s8_snapshot_round_trip", "select * from s_desembolsos")
def _(i: Inputs):
    store = Snapshots(i.spark, i.scratch())
    day_ = _last_day(i, "lineitem", "l_shipdate").first()["day"]
    store.write(clean_stage(i.raw("desembolsos"), "desembolsos"), "stage", "desembolsos", day_)
    return store.read("stage", "desembolsos")


@query("s9_gzip_scan", "select * from v_licitacoes")
def _(i: Inputs):
    folder = f"{i.scratch()}/licitacoes"
    i.raw("licitacoes").write.options(header=True, sep=";", quote='"', escape='"', compression="gzip").csv(folder)
    return read_raw(i.spark, folder, STAGE_COLUMNS["licitacoes"])


def _zipped(rows, folder: str, archives: int, member: int) -> None:
    """Write the rows as that many zip archives, one to a task, in delimited members of so many rows."""
    names = rows.columns

    def write(batches):
        import csv
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        system, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        system.create_dir(path, recursive=True)
        n = 0
        with system.open_output_stream(f"{path}/{TaskContext.get().partitionId()}.zip") as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
            for batch in batches:
                for at in range(0, batch.num_rows, member):
                    out = io.StringIO()
                    writer = csv.writer(out, delimiter=";", lineterminator="\n")
                    writer.writerow(["ROW", *names])
                    writer.writerows([k, *r.values()] for k, r in enumerate(batch.slice(at, member).to_pylist()))
                    archive.writestr(f"part/{n}.csv", out.getvalue())
                    n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], names=["members"])

    rows.repartition(archives).mapInArrow(write, "members long").agg(F.sum("members")).first()


@query("s9_zip_scan", "select * from v_licitacoes")
def _(i: Inputs):
    """Two archives of several members."""
    folder = f"{i.scratch()}/licitacoes"
    _zipped(i.raw("licitacoes").select(*STAGE_COLUMNS["licitacoes"]), folder, 2, 300)
    return read_zipped(i.spark, folder, STAGE_COLUMNS["licitacoes"])


@query("s10_freshness_gate", """
with d as (select (select max(cast(ts as date)) from events) s, (select max(cast(o_orderdate as date)) from orders) h)
select s SOURCE_DATE, h HELD_DATE, case when h >= date '2001-09-01' then 'UP_TO_DATE' when h = s then 'UNCHANGED' else 'RUN' end STATUS from d""")
def _(i: Inputs):
    source = _last_day(i, "events", "ts")
    held = _last_day(i, "orders", "o_orderdate")
    return gates.freshness(source, "day", held, "day", F.lit("2001-09-01").cast("date"))


@query("s11_stale_tables", """
with h as (select o_orderpriority table_name, max(cast(o_orderdate as date)) snapshot_date from orders where o_orderstatus = 'F' group by 1),
w as (select o_orderpriority table_name, cast(o_orderdate as date) source_date from orders)
select * from w where not exists (select 1 from h where h.table_name = w.table_name and h.snapshot_date >= w.source_date)""")
def _(i: Inputs):
    manifest = i.orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderpriority").alias("table_name"), F.col("o_orderdate").cast("date").alias("snapshot_date"))
    wanted = i.orders.select(
        F.col("o_orderpriority").alias("table_name"), F.col("o_orderdate").cast("date").alias("source_date"))
    return gates.stale_tables(wanted, manifest)


@query("s12_snapshot_manifest", """
select 'orders' table_name, max(cast(o_orderdate as date)) snapshot_date, count(*) row_count from orders
union all select 'lineitem', max(cast(l_shipdate as date)), count(*) from lineitem""")
def _(i: Inputs):
    store = Snapshots(i.spark, i.scratch())
    for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        store.write(i.table(name), "stage", name, _last_day(i, name, column).first()["day"])
    return store.current("stage").select("table_name", "snapshot_date", "row_count")


@query("s13_load_date", "select max(cast(ts as date)) DATA_ATUAL from events")
def _(i: Inputs):
    folder = f"{i.scratch()}/data_carga"
    last = i.events.agg(F.max(F.col("ts").cast("date")).alias("d"))
    last.select(F.date_format("d", "dd/MM/yyyy").alias("data_carga")).write.option("header", True).csv(folder)
    return load_date(read_raw(i.spark, folder, ["data_carga"], sep=","), "data_carga")


# ------------------------------------------------------------------ projection and cleaning


@query("p1_upper_names", 'select n_nationkey "N_NATIONKEY", n_name "N_NAME", n_regionkey "N_REGIONKEY" from nation')
def _(i: Inputs):
    return tables.upper_names(i.nation)


@query("p2_rename", "select o_orderkey NR_CONVENIO, o_custkey IDENTIF_PROPONENTE, o_totalprice VL_GLOBAL_CONV from orders")
def _(i: Inputs):
    return i.orders.select("o_orderkey", "o_custkey", "o_totalprice").withColumnsRenamed(
        {"o_orderkey": "NR_CONVENIO", "o_custkey": "IDENTIF_PROPONENTE", "o_totalprice": "VL_GLOBAL_CONV"})


@query("p3_tolerant_projection", "select o_orderstatus, o_orderkey from orders")
def _(i: Inputs):
    return tables.select_existing(i.orders, ["o_orderstatus", "REGIAO_ABREVIADA", "o_orderkey"])


@query("p4_drop_columns", "select p_partkey, p_brand, p_type, p_size from part")
def _(i: Inputs):
    return i.part.drop("p_name", "p_retailprice")


@query("p5_constant_column", "select s_suppkey, 'NAO' CAPITAL, cast(-1 as bigint) FORNECEDOR_ID from supplier")
def _(i: Inputs):
    return i.supplier.select("s_suppkey", F.lit(fixed.NO).alias("CAPITAL"), F.lit(-1).cast("long").alias("FORNECEDOR_ID"))


@query("p6_conform", f"""
select try_cast(NR_CONVENIO as bigint) NR_CONVENIO, try_cast(SIT_CONVENIO as bigint) COD_SIT, {day('DIA_ASSIN_CONV')} DIA_ASSIN_CONV,
  {day('DIA_LIMITE_PREST_CONTAS')} DIA_LIMITE_PREST_CONTAS, try_cast({money('VL_GLOBAL_CONV')} as double) VL_GLOBAL_CONV from v_convenios""")
def _(i: Inputs):
    rows = i.raw("convenios").select(
        "NR_CONVENIO", F.col("SIT_CONVENIO").alias("COD_SIT"), "DIA_ASSIN_CONV", "DIA_LIMITE_PREST_CONTAS",
        F.replace("VL_GLOBAL_CONV", F.lit(","), F.lit(".")).alias("VL_GLOBAL_CONV"))
    fact = MART_SCHEMAS["convenios"]
    wanted = [(f.name, f.dataType) for f in fact.fields if f.name in rows.columns]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(*w) for w in wanted[:1]] + [T.StructField("COD_SIT", T.LongType())]
                          + [T.StructField(*w) for w in wanted[1:]])
    return values.conform(rows, schema)


@query("p7_day_first_dates", f"select NR_MOV_FIN, NR_CONVENIO, {day('DATA_PAG')} DATA_PAG from v_pagamentos")
def _(i: Inputs):
    return i.raw("pagamentos").select(
        "NR_MOV_FIN", "NR_CONVENIO", values.day_first_date(F.col("DATA_PAG")).alias("DATA_PAG"))


@query("p8_decimal_comma", f"""
select NR_MOV_FIN, NR_CONVENIO, cast({money('VL_PAGO')} as double) VL_PAGO, try_cast(replace(VL_PAGO, ',', '.') as double) VL_DOUBLE
from v_pagamentos""")
def _(i: Inputs):
    return i.raw("pagamentos").select(
        "NR_MOV_FIN", "NR_CONVENIO", values.decimal_comma(F.col("VL_PAGO")).alias("VL_PAGO"),
        values.decimal_comma(F.col("VL_PAGO"), "double").alias("VL_DOUBLE"))


@query("p9_upper_values", "select p_partkey, upper(p_name) p_name, upper(p_brand) p_brand, upper(p_type) p_type from part")
def _(i: Inputs):
    return texts.on_text_columns(i.part.select("p_partkey", "p_name", "p_brand", "p_type"), F.upper)


@query("p10_sentinel_fill", f"""
select ID_LICITACAO, coalesce(MODALIDADE_LICITACAO, '{fixed.UNSPECIFIED_F}') MODALIDADE_LICITACAO,
  coalesce(STATUS_LICITACAO, '{fixed.UNDEFINED_M}') STATUS_LICITACAO, coalesce(TIPO_LICITACAO, '{fixed.NO_MEMBER}') TIPO_LICITACAO,
  cast(coalesce({money('VALOR_LICITACAO')}, 0) as double) VALOR_LICITACAO from v_licitacoes""")
def _(i: Inputs):
    return i.raw("licitacoes").select(
        "ID_LICITACAO", "MODALIDADE_LICITACAO", "STATUS_LICITACAO", "TIPO_LICITACAO",
        values.decimal_comma(F.col("VALOR_LICITACAO")).alias("VALOR_LICITACAO")).fillna({
            "MODALIDADE_LICITACAO": fixed.UNSPECIFIED_F, "STATUS_LICITACAO": fixed.UNDEFINED_M,
            "TIPO_LICITACAO": fixed.NO_MEMBER, "VALOR_LICITACAO": 0})


@query("p11_conditional_replace", """
select s.NR_MOV_FIN, s.NR_CONVENIO, case when known then t.VL_PAGO_OBTV_CONV else s.VL_PAGO end VL_PAGO
from v_pagamentos s left join (select *, true known from v_obtv) t on s.NR_MOV_FIN is not distinct from t.NR_MOV_FIN""")
def _(i: Inputs):
    transfers = i.raw("obtv").withColumn("known", F.lit(True))
    rows = i.raw("pagamentos").select("NR_MOV_FIN", "NR_CONVENIO", "VL_PAGO")
    return joins.override(rows, transfers, "NR_MOV_FIN", "known", {"VL_PAGO": "VL_PAGO_OBTV_CONV"})


_REGION_BY_KEY = f"[{quoted(fixed.REGION_CODES)}]"


@query("p12_region_code", f"""
select c_custkey, {_REGION_BY_KEY}[n_regionkey + 1] REGIAO, {case_map(_REGION_BY_KEY + '[n_regionkey + 1]', fixed.REGION_CODES)} REGIAO_ABREVIADA
from customer join nation on c_nationkey = n_nationkey""")
def _(i: Inputs):
    region = pick(list(fixed.REGION_CODES), F.col("n_regionkey"))
    rows = i.customer.join(i.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", region.alias("REGIAO"), labels.region_code(region).alias("REGIAO_ABREVIADA"))


_STATE_OF = {uf: region for region, ufs in fixed.REGION_STATES.items() for uf in ufs}


@query("p13_state_region", f"select ID_PROPOSTA, UF_PROPONENTE UF, {case_map('UF_PROPONENTE', _STATE_OF)} REGIAO from v_propostas")
def _(i: Inputs):
    return i.raw("propostas").select(
        "ID_PROPOSTA", F.col("UF_PROPONENTE").alias("UF"), labels.state_region(F.col("UF_PROPONENTE")).alias("REGIAO"))


@query("p14_flag_label", """
select codigo_ibge, case capital when '1' then 'SIM' when '0' then 'NAO' else capital end CAPITAL from v_municipios""")
def _(i: Inputs):
    return i.raw("municipios").select("codigo_ibge", texts.flag_label(F.col("capital")).alias("CAPITAL"))


@query("p15_composite_key", """
select e.ID_PROPOSTA, try_cast(p.ANO_PROP || e.NR_EMENDA as bigint) NR_EMENDA from v_emendas e join v_propostas p using (ID_PROPOSTA)""")
def _(i: Inputs):
    rows = i.raw("emendas").join(i.raw("propostas").select("ID_PROPOSTA", "ANO_PROP"), "ID_PROPOSTA")
    key = values.year_and_number(F.col("ANO_PROP"), F.col("NR_EMENDA"))
    return rows.select("ID_PROPOSTA", key.try_cast("long").alias("NR_EMENDA"))


@query("p16_number_text", f"""
select ID_LICITACAO, MODALIDADE_LICITACAO, case when {number_text('MODALIDADE_LICITACAO')} then 'SIM' else 'NAO' end NUMERICA from v_licitacoes""")
def _(i: Inputs):
    return i.raw("licitacoes").select(
        "ID_LICITACAO", "MODALIDADE_LICITACAO",
        texts.yes_no(texts.is_number_text(F.col("MODALIDADE_LICITACAO"))).alias("NUMERICA"))


@query("p17_text_tests", """
select p_partkey, case when lower(p_name) like 'red%' or lower(p_name) like 'small%' then 'SIM' else 'NAO' end starts,
  case when lower(p_name) like '%ring' then 'SIM' else 'NAO' end ends,
  case when lower(p_name) like '%l w%' or lower(p_name) like '%d r%' then 'SIM' else 'NAO' end inside from part""")
def _(i: Inputs):
    name = F.col("p_name")
    return i.part.select(
        "p_partkey", texts.yes_no(texts.starts_with_any(name, "red", "small")).alias("starts"),
        texts.yes_no(texts.ends_with_any(name, "ring")).alias("ends"),
        texts.yes_no(texts.contains_any(name, "l w", "d r")).alias("inside"))


@query("p18_padded_labels", """
select o_orderkey, lpad(cast(month(o_orderdate) as varchar), 2, '0') || ' ' || year(o_orderdate) MES_ANO from orders""")
def _(i: Inputs):
    day_ = F.col("o_orderdate").cast("date")
    return i.orders.select("o_orderkey", texts.padded_label(F.month(day_), F.year(day_)).alias("MES_ANO"))


# ------------------------------------------------------------------ filters


@query("f1_not_null", "select * from v_desembolsos where DATA_DESEMBOLSO is not null and VL_DESEMBOLSADO is not null")
def _(i: Inputs):
    return i.raw("desembolsos").where(F.col("DATA_DESEMBOLSO").isNotNull() & F.col("VL_DESEMBOLSADO").isNotNull())


@query("f2_non_zero", f"select NR_MOV_FIN, NR_CONVENIO, VL_PAGO from v_pagamentos where {money('VL_PAGO')} <> 0")
def _(i: Inputs):
    rows = i.raw("pagamentos").where(values.non_zero(values.decimal_comma(F.col("VL_PAGO"))))
    return rows.select("NR_MOV_FIN", "NR_CONVENIO", "VL_PAGO")


@query("f3_status_equality", "select NR_CONVENIO, SIT_CONVENIO from v_convenios where lower(SIT_CONVENIO) = 'em execução'")
def _(i: Inputs):
    rows = i.raw("convenios").select("NR_CONVENIO", "SIT_CONVENIO")
    return rows.where(texts.equals_ignoring_case(F.col("SIT_CONVENIO"), "EM EXECUÇÃO"))


@query("f4_membership", "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus not in ('P')")
def _(i: Inputs):
    rows = i.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P"))
    return rows.select("o_orderkey", "o_orderpriority")


@query("f5_first_rows", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def _(i: Inputs):
    rows = i.orders.select("o_orderkey", "o_totalprice")
    return tables.first_rows(rows, 10, F.desc("o_totalprice"), F.asc("o_orderkey"))


# ------------------------------------------------------------------ joins


@query("j1_inner_lookup", "select s_suppkey, s_name, n_name from supplier join nation on s_nationkey = n_nationkey")
def _(i: Inputs):
    return i.supplier.join(i.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name")


@query("j2_inner_chain", """
select NR_CONVENIO, p.IDENTIF_PROPONENTE, NM_PROPONENTE, VL_GLOBAL_CONV
from v_propostas p join v_proponentes using (IDENTIF_PROPONENTE) join v_convenios using (ID_PROPOSTA)""")
def _(i: Inputs):
    proposals = i.raw("propostas").select("ID_PROPOSTA", "IDENTIF_PROPONENTE")
    return proposals.join(i.raw("proponentes"), "IDENTIF_PROPONENTE").join(i.raw("convenios"), "ID_PROPOSTA").select(
        "NR_CONVENIO", "IDENTIF_PROPONENTE", "NM_PROPONENTE", "VL_GLOBAL_CONV")


@query("j3_amendments_grants", """
select distinct p.ANO_PROP || e.NR_EMENDA NR_EMENDA, c.NR_CONVENIO, e.NOME_PARLAMENTAR, e.TIPO_PARLAMENTAR, e.VALOR_REPASSE_EMENDA
from s_emendas e join s_propostas p using (ID_PROPOSTA) join s_convenios c using (ID_PROPOSTA)
where e.NR_EMENDA is not null and p.IDENTIF_PROPONENTE in (select IDENTIF_PROPONENTE from s_proponentes)""")
def _(i: Inputs):
    return grants.amendment_transfers(i.staged()).distinct()


@query("j4_left_lookup", """
select ID_PROPOSTA, UF_PROPONENTE, e.nome NOME_ESTADO from v_propostas left join v_estados e on e.uf = UF_PROPONENTE""")
def _(i: Inputs):
    states = i.raw("estados").select(F.col("uf").alias("UF_PROPONENTE"), F.col("nome").alias("NOME_ESTADO"))
    return i.raw("propostas").select("ID_PROPOSTA", "UF_PROPONENTE").join(states, "UF_PROPONENTE", "left")


@query("j5_attach_total", """
select o_orderkey, cast(coalesce(total, 0) as double) total from orders
left join (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) total from lineitem where l_returnflag = 'R' group by 1) on l_orderkey = o_orderkey""")
def _(i: Inputs):
    lines = i.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    totals = tables.group_sum(lines, ["o_orderkey"], "price", "total")
    return joins.attach_total(i.orders.select("o_orderkey"), "o_orderkey", totals, "total")


@query("j6_override", """
select p.NR_MOV_FIN, p.NR_CONVENIO, coalesce(t.IDENTIF_FAVORECIDO_OBTV_CONV, p.IDENTIF_FORNECEDOR) IDENTIF_FORNECEDOR,
  case when t.IDENTIF_FAVORECIDO_OBTV_CONV is null then p.NOME_FORNECEDOR else t.NM_FAVORECIDO_OBTV_CONV end NOME_FORNECEDOR,
  case when t.IDENTIF_FAVORECIDO_OBTV_CONV is null then p.VL_PAGO else t.VL_PAGO_OBTV_CONV end VL_PAGO
from v_pagamentos p left join v_obtv t on p.NR_MOV_FIN is not distinct from t.NR_MOV_FIN""")
def _(i: Inputs):
    rows = i.raw("pagamentos").drop("DATA_PAG")
    return joins.override(rows, i.raw("obtv"), "NR_MOV_FIN", "IDENTIF_FAVORECIDO_OBTV_CONV", {
        "IDENTIF_FORNECEDOR": "IDENTIF_FAVORECIDO_OBTV_CONV", "NOME_FORNECEDOR": "NM_FAVORECIDO_OBTV_CONV",
        "VL_PAGO": "VL_PAGO_OBTV_CONV"})


@query("j7_fallback_lookup", f"""
select t.NR_CONVENIO, coalesce({day('DATA_TRIBUTO')}, paid, {day('DIA_INIC_VIGENC_CONV')}) DATA_TRIBUTO, VL_PAG_TRIBUTOS from v_tributos t
left join (select NR_CONVENIO, min({day('DATA_PAG')}) paid from v_pagamentos where DATA_PAG is not null group by 1) p using (NR_CONVENIO)
left join v_convenios c using (NR_CONVENIO)""")
def _(i: Inputs):
    paid = i.raw("pagamentos").groupBy("NR_CONVENIO").agg(F.min(values.day_first_date(F.col("DATA_PAG"))).alias("paid"))
    starts = i.raw("convenios").select("NR_CONVENIO", values.day_first_date(F.col("DIA_INIC_VIGENC_CONV")).alias("start"))
    rows = i.raw("tributos").join(paid, "NR_CONVENIO", "left").join(starts, "NR_CONVENIO", "left")
    day_ = F.coalesce(values.day_first_date(F.col("DATA_TRIBUTO")), "paid", "start")
    return rows.select("NR_CONVENIO", day_.alias("DATA_TRIBUTO"), "VL_PAG_TRIBUTOS")


@query("j8_composite_key", """
select NR_CONVENIO, IDENTIF_FORNECEDOR, NOME_FORNECEDOR, VL_PAGO from s_pagamentos join x_suppliers using (IDENTIF_FORNECEDOR, NOME_FORNECEDOR)""")
def _(i: Inputs):
    stage = i.staged()
    names = suppliers.paid_suppliers(stage, grants.known_grants(stage))
    return stage["pagamentos"].join(names, ["IDENTIF_FORNECEDOR", "NOME_FORNECEDOR"]).select(
        "NR_CONVENIO", "IDENTIF_FORNECEDOR", "NOME_FORNECEDOR", "VL_PAGO")


@query("j9_semi_join", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')")
def _(i: Inputs):
    known = i.orders.where("o_orderstatus = 'F'")
    rows = i.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.keep_known(rows, "l_orderkey", known, "o_orderkey")


@query("j10_anti_join", """
select ID_PROPOSTA, COD_MUNIC_IBGE from v_propostas p where not exists (select 1 from v_municipios m where m.codigo_ibge = p.COD_MUNIC_IBGE)""")
def _(i: Inputs):
    rows = i.raw("propostas").select("ID_PROPOSTA", "COD_MUNIC_IBGE")
    return joins.drop_known(rows, "COD_MUNIC_IBGE", i.raw("municipios"), "codigo_ibge")


@query("j11_existence_flag", """
select o_orderkey, case when o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') then 'SIM' else 'NAO' end COM_EMENDAS from orders""")
def _(i: Inputs):
    known = i.lineitem.where("l_returnflag = 'R'")
    return joins.flag_known(i.orders.select("o_orderkey"), "o_orderkey", known, "l_orderkey", "COM_EMENDAS")


@query("j12_date_corrections", """
with fixes as (select l_orderkey, cast(l_shipdate as date) wrong, max(cast(l_shipdate as date) + l_linenumber * 365) fixed_day
  from lineitem where l_linenumber >= 6 group by 1, 2)
select l.l_orderkey, l.l_linenumber, coalesce(f.fixed_day, cast(l.l_shipdate as date)) l_shipdate
from lineitem l left join fixes f on f.l_orderkey = l.l_orderkey and f.wrong = cast(l.l_shipdate as date)""")
def _(i: Inputs):
    day_ = F.col("l_shipdate").cast("date")
    rows = i.lineitem.select("l_orderkey", "l_linenumber", day_.alias("l_shipdate"))
    late = rows.where("l_linenumber >= 6")
    fixes = late.groupBy(F.col("l_orderkey").alias("_grant"), F.col("l_shipdate").alias("_wrong")).agg(
        F.max(F.date_add("l_shipdate", F.col("l_linenumber") * 365)).alias("_right"))
    return joins.correct_dates(rows, "l_orderkey", "l_shipdate", fixes)


@query("j13_suffix_year", """
select NR_CONVENIO, DATA_TRIBUTO, case when right(DATA_TRIBUTO, 5) = '/0209' then date '2009-01-01' end FIXED from v_tributos""")
def _(i: Inputs):
    return i.raw("tributos").select("NR_CONVENIO", "DATA_TRIBUTO", joins.bad_suffix_date(F.col("DATA_TRIBUTO")).alias("FIXED"))


@query("j14_null_safe_keys", """
select p.NR_CONVENIO, p.VL_PAGO from v_pagamentos p
where exists (select 1 from v_obtv t where t.NR_MOV_FIN is not distinct from p.NR_MOV_FIN)""")
def _(i: Inputs):
    known = i.raw("obtv").select("NR_MOV_FIN").distinct()
    rows = i.raw("pagamentos").select("NR_MOV_FIN", "NR_CONVENIO", "VL_PAGO")
    return joins.null_safe_join(rows, known, "NR_MOV_FIN", "left_semi").select("NR_CONVENIO", "VL_PAGO")


@query("j15_write_back", """
select o_orderkey, coalesce(score, 0) INSUCESSO from orders
left join (select l_orderkey, max(l_discount) score from lineitem where l_linestatus = 'O' group by 1) on l_orderkey = o_orderkey""")
def _(i: Inputs):
    from outorga.risk.model import write_back

    scores = i.lineitem.where("l_linestatus = 'O'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_discount").alias("score"))
    rows = i.orders.select("o_orderkey", F.lit(0.0).alias("INSUCESSO"))
    return write_back(rows, scores, "o_orderkey", "INSUCESSO", "score")


# ------------------------------------------------------------------ aggregates


def _priced(i: Inputs):
    return i.raw("emendas").withColumn("VALOR", values.decimal_comma(F.col("VALOR_REPASSE_EMENDA")))


@query("a1_sum_three_keys", f"""
select NR_EMENDA, NOME_PARLAMENTAR, TIPO_PARLAMENTAR, cast(coalesce(sum({money('VALOR_REPASSE_EMENDA')}), 0) as double) VALOR
from v_emendas group by 1, 2, 3""")
def _(i: Inputs):
    return tables.group_sum(_priced(i), ["NR_EMENDA", "NOME_PARLAMENTAR", "TIPO_PARLAMENTAR"], "VALOR")


@query("a2_sum_by_grant", "select l_orderkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) total from lineitem group by 1")
def _(i: Inputs):
    rows = i.lineitem.select("l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return tables.group_sum(rows, ["l_orderkey"], "price", "total")


@query("a3_sum_two_keys", "select l_orderkey, l_suppkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) total from lineitem group by 1, 2")
def _(i: Inputs):
    rows = i.lineitem.select("l_orderkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return tables.group_sum(rows, ["l_orderkey", "l_suppkey"], "price", "total")


@query("a4_first_date", "select l_orderkey, min(cast(l_shipdate as date)) first_day from lineitem group by 1")
def _(i: Inputs):
    return i.lineitem.groupBy("l_orderkey").agg(F.min(F.col("l_shipdate").cast("date")).alias("first_day"))


@query("a5_greatest_name", "select o_custkey, max(o_orderpriority) top from orders group by 1")
def _(i: Inputs):
    return i.orders.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("top"))


@query("a6_global_minimum", "select min(cast(l_shipdate as date)) first_day from lineitem")
def _(i: Inputs):
    return i.lineitem.agg(F.min(F.col("l_shipdate").cast("date")).alias("first_day"))


@query("a7_distinct_rows", "select distinct NOME_PARLAMENTAR, TIPO_PARLAMENTAR from v_emendas")
def _(i: Inputs):
    return i.raw("emendas").select("NOME_PARLAMENTAR", "TIPO_PARLAMENTAR").distinct()


@query("a8_distinct_keys", "select distinct l_suppkey from lineitem")
def _(i: Inputs):
    return i.lineitem.select("l_suppkey").distinct()


@query("a9_distinct_sum", f"""
select NR_EMENDA, cast(coalesce(sum(VALOR), 0) as double) VALOR from (select distinct NR_EMENDA, {money('VALOR_REPASSE_EMENDA')} VALOR from v_emendas) group by 1""")
def _(i: Inputs):
    return tables.distinct_sum(_priced(i), ["NR_EMENDA"], "VALOR")


_COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query("a10_row_counts", " union all ".join(f"select '{t}' table_name, count(*) \"rows\" from {t}" for t in _COUNTED))
def _(i: Inputs):
    return tables.row_counts({t: i.table(t) for t in _COUNTED})


# ------------------------------------------------------------------ ranks


@query("w1_rank_in_group", """
select l_orderkey, l_linenumber, l_quantity, case when l_quantity is not null then rank() over (partition by l_orderkey order by l_quantity desc nulls last) end rank
from (select l_orderkey, l_linenumber, case when l_linenumber <> 7 then l_quantity end l_quantity from lineitem)""")
def _(i: Inputs):
    rows = i.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("l_quantity"))
    return ranking.rank_in_group(rows, "l_orderkey", "l_quantity")


@query("w2_principal_politician", f"""
select NR_CONVENIO, max(NOME_PARLAMENTAR) PRINCIPAL_PARLAMENTAR
from (select *, rank() over (partition by NR_CONVENIO order by VALOR_REPASSE_EMENDA desc) r from m_emendas_convenios where VALOR_REPASSE_EMENDA is not null)
join m_emendas using (NR_EMENDA) where r = 1 group by 1""")
def _(i: Inputs):
    from catalog.marts import transfers
    from outorga.risk.features import principal_politician
    from outorga.session import cut_lineage

    lines = cut_lineage(transfers(i.staged()))
    return principal_politician(grants.emendas_convenios(lines), grants.emendas(lines))


@query("w3_principal_supplier", """
with s as (select l_orderkey, l_suppkey, sum(cast(l_extendedprice as decimal(18,2))) paid from lineitem group by 1, 2),
r as (select *, rank() over (partition by l_orderkey order by paid desc) r from s)
select l_orderkey NR_CONVENIO, max(s_name) PRINCIPAL_FORNECEDOR from r join supplier on s_suppkey = l_suppkey where r = 1 group by 1""")
def _(i: Inputs):
    from outorga.risk.features import principal_supplier

    ledger = i.lineitem.select(
        F.col("l_orderkey").alias("NR_CONVENIO"), F.col("l_suppkey").alias("FORNECEDOR_ID"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("VALOR_MOV"), F.lit("P").alias("TIPO_MOV"))
    names = i.supplier.select(F.col("s_suppkey").alias("FORNECEDOR_ID"), F.col("s_name").alias("IDENTIF_FORNECEDOR"))
    return principal_supplier(ledger, names)


@query("w4_descending_sort", "select c_nationkey, c_custkey from customer order by c_nationkey desc, c_custkey desc")
def _(i: Inputs):
    return i.customer.select("c_nationkey", "c_custkey").orderBy(F.desc("c_nationkey"), F.desc("c_custkey"))


# ------------------------------------------------------------------ set operations


@query("u1_union_by_name", """
select s_suppkey id, s_name name, null segment from supplier union all select c_custkey, c_name, c_mktsegment from customer""")
def _(i: Inputs):
    return tables.union_all([
        i.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        i.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))])


@query("u2_not_applicable_member", f"""
select s_suppkey FORNECEDOR_ID, s_name NOME_FORNECEDOR from supplier union all select -1, '{fixed.NO_MEMBER}'""")
def _(i: Inputs):
    rows = i.supplier.select(F.col("s_suppkey").alias("FORNECEDOR_ID"), F.col("s_name").alias("NOME_FORNECEDOR"))
    return tables.append_member(rows, FORNECEDOR_ID=fixed.NO_MEMBER_ID, NOME_FORNECEDOR=fixed.NO_MEMBER)


@query("u3_ledger_union", """
select TIPO_MOV, count(*) "rows", cast(sum(VALOR_MOV) as double) total from x_ledger group by 1""")
def _(i: Inputs):
    from catalog.marts import moves

    return moves(i).groupBy("TIPO_MOV").agg(F.count(F.lit(1)).alias("rows"), F.sum("VALOR_MOV").alias("total"))


@query("u4_attribute_union", """
select distinct 'STATUS' ATRIBUTO, o_orderstatus VALOR from orders union all select distinct 'PRIORITY', o_orderpriority from orders
union all select distinct 'SEGMENT', c_mktsegment from customer""")
def _(i: Inputs):
    return tables.union_all([
        tables.attribute_values(i.orders, {"o_orderstatus": "STATUS", "o_orderpriority": "PRIORITY"}),
        tables.attribute_values(i.customer, {"c_mktsegment": "SEGMENT"})])


# ------------------------------------------------------------------ surrogate keys


@query("k1_dense_ids", """
select row_number() over (order by substr(md5(concat_ws('|', p_name, p_brand, p_type, '0')), 1, 4), p_name, p_brand, p_type) id, p_name, p_brand, p_type
from (select distinct p_name, p_brand, p_type from part)""")
def _(i: Inputs):
    return keys.dense_ids(i.part.select("p_name", "p_brand", "p_type").distinct(), "id", ["p_name", "p_brand", "p_type"], unique=True)


@query("k2_ledger_line_ids", """
select row_number() over (order by substr(md5(concat_ws('|', cast(l_shipdate as varchar), l_returnflag, cast(l_suppkey as varchar), cast(copy // 5 as varchar))), 1, 4),
  l_shipdate, l_returnflag, l_suppkey, copy) id, l_shipdate, l_returnflag, l_suppkey
from (select *, row_number() over (partition by l_shipdate, l_returnflag, l_suppkey) - 1 copy
  from (select case when l_linenumber % 2 = 0 then null else cast(l_shipdate as date) end l_shipdate, l_returnflag, l_suppkey from lineitem))""")
def _(i: Inputs):
    day_ = F.when(~every("l_linenumber", 2), F.col("l_shipdate").cast("date"))
    rows = i.lineitem.select(day_.alias("l_shipdate"), "l_returnflag", "l_suppkey")
    return keys.dense_ids(rows, "id", ["l_shipdate", "l_returnflag", "l_suppkey"], run=5)


# ------------------------------------------------------------------ calendar


@query("c1_daily_calendar", """
select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) DATA
from (select min(cast(l_shipdate as date)) lo, max(cast(l_shipdate as date)) hi from lineitem)""")
def _(i: Inputs):
    days = i.lineitem.select(F.col("l_shipdate").cast("date").alias("d"))
    return derived.calendario(days, "d", days.agg(F.max("d")).scalar()).select("DATA")


_ORDER_DAYS = "(select cast(o_orderdate as date) d, o_orderkey from orders)"


@query("c2_date_parts", f"select o_orderkey, {', '.join(['ANO', 'MES_NUMERO', 'TRIMESTRE_NUMERO', 'SEMANA_NUMERO', 'ANO_MES_NUMERO', 'ANO_TRIMESTRE_NUMERO', 'ANO_SEMANA_NUMERO'])} from "
       f"({calendar_select(_ORDER_DAYS).replace('select d DATA,', 'select o_orderkey, d DATA,')})")
def _(i: Inputs):
    parts = labels.calendar_columns(F.col("o_orderdate").cast("date"))
    wanted = ["ANO", "MES_NUMERO", "TRIMESTRE_NUMERO", "SEMANA_NUMERO", "ANO_MES_NUMERO", "ANO_TRIMESTRE_NUMERO", "ANO_SEMANA_NUMERO"]
    return i.orders.select("o_orderkey", *[parts[c].alias(c) for c in wanted])


@query("c3_month_weekday_names", f"""
select o_orderkey, [{quoted(fixed.MONTHS)}][month(o_orderdate)] MES_NOME, [{quoted(fixed.WEEKDAYS)}][isodow(o_orderdate)] DIA_DA_SEMANA from orders""")
def _(i: Inputs):
    day_ = F.col("o_orderdate").cast("date")
    return i.orders.select(
        "o_orderkey", labels.month_name(day_).alias("MES_NOME"), labels.weekday_name(day_).alias("DIA_DA_SEMANA"))


_LABELS = ["MES_ANO", "MES_NOME_ANO", "TRIMESTRE_NOME", "TRIMESTRE_ANO", "TRIMESTRE_NOME_ANO", "SEMANA_NOME", "SEMANA_ANO", "SEMANA_NOME_ANO"]


@query("c4_calendar_labels", f"select o_orderkey, {', '.join(_LABELS)} from "
       f"({calendar_select(_ORDER_DAYS).replace('select d DATA,', 'select o_orderkey, d DATA,')})")
def _(i: Inputs):
    parts = labels.calendar_columns(F.col("o_orderdate").cast("date"))
    return i.orders.select("o_orderkey", *[parts[c].alias(c) for c in _LABELS])


# ------------------------------------------------------------------ procurement rules

_KIND = f"lower(case when not {number_text('TIPO_LICITACAO')} then TIPO_LICITACAO end)"


@query("x1_modality", f"""
select ID_LICITACAO, upper(case when MODALIDADE_LICITACAO = '12' then 'PREGÃO'
  when MODALIDADE_LICITACAO is not null and not {number_text('MODALIDADE_LICITACAO')} then MODALIDADE_LICITACAO
  when TP_PROCESSO_COMPRA is not null and not {number_text('TP_PROCESSO_COMPRA')} then TP_PROCESSO_COMPRA
  else '{fixed.UNSPECIFIED_F}' end) MODALIDADE_COMPRA from v_licitacoes""")
def _(i: Inputs):
    return i.raw("licitacoes").select("ID_LICITACAO", F.upper(procurement.modality(
        F.col("MODALIDADE_LICITACAO"), F.col("TP_PROCESSO_COMPRA"))).alias("MODALIDADE_COMPRA"))


@query("x2_numeric_type", f"select ID_LICITACAO, case when not {number_text('TIPO_LICITACAO')} then TIPO_LICITACAO end TIPO_LICITACAO from v_licitacoes")
def _(i: Inputs):
    return i.raw("licitacoes").select("ID_LICITACAO", procurement.type_text(F.col("TIPO_LICITACAO")).alias("TIPO_LICITACAO"))


@query("x3_form", f"""
select ID_LICITACAO, case when {_KIND} like 'presencial%' then 'PRESENCIAL' when regexp_matches({_KIND}, '^eletr[oô]nico') then 'ELETRÔNICO'
  else '{fixed.NOT_APPLICABLE}' end FORMA_LICITACAO from v_licitacoes""")
def _(i: Inputs):
    return i.raw("licitacoes").select("ID_LICITACAO", procurement.form(F.col("TIPO_LICITACAO")).alias("FORMA_LICITACAO"))


@query("x4_price_registration", f"""
select ID_LICITACAO, case when regexp_matches({_KIND}, 'registro de pre[cç]o') then 'SIM' else 'NAO' end REGISTRO_PRECOS from v_licitacoes""")
def _(i: Inputs):
    return i.raw("licitacoes").select(
        "ID_LICITACAO", procurement.price_registration(F.col("TIPO_LICITACAO")).alias("REGISTRO_PRECOS"))


@query("x5_international", "select ID_LICITACAO, 'NAO' LICITACAO_INTERNACIONAL from v_licitacoes")
def _(i: Inputs):
    return i.raw("licitacoes").select(
        "ID_LICITACAO", procurement.international(F.col("TIPO_LICITACAO")).alias("LICITACAO_INTERNACIONAL"))


@query("x6_type_class", f"""
select ID_LICITACAO, case when regexp_matches({_KIND}, 'menor (pre[cç]o|valor)') then 'MENOR PREÇO' when regexp_matches({_KIND}, 'melhor t[eé]cnica') then 'MELHOR TÉCNICA'
  when regexp_matches({_KIND}, 't[eé]cnica e pre[cç]o') then 'TÉCNICA E PREÇO' else '{fixed.NOT_APPLICABLE}' end TIPO_LICITACAO from v_licitacoes""")
def _(i: Inputs):
    return i.raw("licitacoes").select("ID_LICITACAO", procurement.type_class(F.col("TIPO_LICITACAO")).alias("TIPO_LICITACAO"))
