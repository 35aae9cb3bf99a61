"""The raw views and mart tables in DuckDB SQL, as common table expressions that name each other."""

from __future__ import annotations

import re

from catalog.raw_views import REGIONS, STATES
from outorga import fixed


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def day(x: str) -> str:
    """Day-first text to date; month-first and ISO as fallbacks."""
    return (f"cast(coalesce(try_strptime({x}, '%d/%m/%Y'), try_strptime({x}, '%m/%d/%Y'), "
            f"try_strptime({x}, '%Y-%m-%d')) as date)")


def D(x: str, plus: int = 0) -> str:
    return f"strftime(cast({x} as date) + {plus}, '%d/%m/%Y')"


def M(x: str) -> str:
    return f"replace(cast(cast({x} as decimal(18,2)) as varchar), '.', ',')"


def money(x: str) -> str:
    return f"try_cast(replace({x}, ',', '.') as decimal(18,2))"


def number_text(x: str) -> str:
    return f"coalesce(regexp_full_match({x}, '\\p{{N}}+'), false)"


STATE_LIST = f"[{quoted(STATES)}]"
REGION_LIST = f"[{quoted(REGIONS)}]"
STRIP = quoted([fixed.WHITESPACE])


def case_map(x: str, mapping: dict) -> str:
    return f"case {x} " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + " end"


STATE_REGION = {uf: region for region, ufs in fixed.REGION_STATES.items() for uf in ufs}

CTES: dict[str, str] = {}

CTES["v_estados"] = f"""
select cast(n_nationkey as varchar) codigo_uf, {STATE_LIST}[n_nationkey + 1] uf, n_name nome,
  case when n_nationkey = 24 then 'litoral' else {REGION_LIST}[n_regionkey + 1] end regiao from nation"""
CTES["v_municipios"] = f"""
select cast(s_suppkey as varchar) codigo_ibge, s_name nome,
  case when s_suppkey % 7 <> 0 then {M('s_acctbal')} end latitude, {M('-s_acctbal')} longitude,
  case when s_suppkey % 10 = 0 then '1' else '0' end capital,
  case when s_suppkey % 37 = 0 then '99' else cast(s_nationkey as varchar) end codigo_uf from supplier"""
CTES["v_proponentes"] = """
select cast(c_custkey as varchar) IDENTIF_PROPONENTE, c_name NM_PROPONENTE from customer
union all select cast(c_custkey as varchar), upper(c_name) || ' II' from customer where c_custkey % 50 = 0
union all select cast(c_custkey as varchar), chr(9) || '  ' || c_name || chr(160) from customer where c_custkey % 40 = 0"""
CTES["v_propostas"] = f"""
select cast(o_orderkey as varchar) ID_PROPOSTA,
  case when o_orderkey % 149 <> 0 then cast(o_custkey % 1500 as varchar) end COD_MUNIC_IBGE,
  cast(1000 + o_custkey % 20 as varchar) COD_ORGAO_SUP, 'Ministry ' || (o_custkey % 20) DESC_ORGAO_SUP,
  lower(c_mktsegment) NATUREZA_JURIDICA, cast(2000 + o_custkey % 40 as varchar) COD_ORGAO,
  'Agency ' || (o_custkey % 40) DESC_ORGAO, o_orderpriority MODALIDADE,
  case when o_custkey % 101 = 0 then 'X' else '' end || o_custkey IDENTIF_PROPONENTE,
  o_orderpriority || ' ' || c_mktsegment OBJETO_PROPOSTA, cast(year(o_orderdate) as varchar) ANO_PROP,
  {STATE_LIST}[(c_nationkey + o_custkey % 3) % 27 + 1] UF_PROPONENTE, 'Town ' || (o_custkey % 1500) MUNIC_PROPONENTE
from orders join customer on o_custkey = c_custkey"""
CTES["v_convenios"] = f"""
select cast(o_orderkey as varchar) NR_CONVENIO, cast(o_orderkey as varchar) ID_PROPOSTA,
  case when o_orderkey % 17 <> 0 then {D('o_orderdate')} end DIA_ASSIN_CONV,
  case when o_orderkey % 11 = 0 then null when o_orderstatus = 'O' then 'Em execução'
    when o_orderkey % 5 = 0 then 'Prestação de Contas Rejeitada' when o_orderkey % 5 = 1 then 'Inadimplente'
    when o_orderkey % 5 = 2 then 'Convênio Rescindido' else 'Prestação de Contas Aprovada' end SIT_CONVENIO,
  case when o_orderkey % 2 = 0 then 'Sim' when o_orderkey % 3 = 0 then 'Não' else 'NÃO' end INSTRUMENTO_ATIVO,
  case when o_orderkey % 13 <> 0 then {D('o_orderdate', 1)} end DIA_PUBL_CONV,
  {D('o_orderdate', 10)} DIA_INIC_VIGENC_CONV, {D('o_orderdate', 400)} DIA_FIM_VIGENC_CONV,
  case when o_orderkey % 19 <> 0 then {D('o_orderdate', 460)} end DIA_LIMITE_PREST_CONTAS,
  {M('o_totalprice')} VL_GLOBAL_CONV, {M('cast(o_totalprice as decimal(18,2)) - 10')} VL_REPASSE_CONV,
  '10,00' VL_CONTRAPARTIDA_CONV from orders"""
CTES["v_emendas"] = f"""
select cast(l_orderkey as varchar) ID_PROPOSTA, case when l_partkey % 23 <> 0 then cast(l_partkey as varchar) end NR_EMENDA,
  case when l_partkey % 17 <> 0 then 'P' || (l_partkey % 50) end NOME_PARLAMENTAR,
  case l_partkey % 3 when 0 then 'INDIVIDUAL' when 1 then 'BANCADA' end TIPO_PARLAMENTAR,
  case when l_linenumber <> 7 then {M('l_extendedprice')} end VALOR_REPASSE_EMENDA
from lineitem where l_returnflag = 'R'"""
CTES["v_desembolsos"] = f"""
select cast(l_orderkey * 10 + l_linenumber as varchar) ID_DESEMBOLSO, cast(l_orderkey as varchar) NR_CONVENIO,
  case when l_partkey % 41 <> 0 then {D('l_shipdate')} end DATA_DESEMBOLSO,
  case when l_quantity = 1 then '0,00' when l_partkey % 43 <> 0 then {M('l_extendedprice')} end VL_DESEMBOLSADO
from lineitem where l_linestatus = 'O'"""
CTES["v_contrapartidas"] = f"""
select cast(l_orderkey as varchar) NR_CONVENIO,
  case when l_partkey % 41 <> 0 then {D('l_shipdate')} end DT_INGRESSO_CONTRAPARTIDA,
  case when l_quantity = 1 then '0,00' when l_partkey % 43 <> 0 then {M('l_extendedprice')} end VL_INGRESSO_CONTRAPARTIDA
from lineitem where l_linestatus = 'F'"""
CTES["v_tributos"] = f"""
select cast(l_orderkey as varchar) NR_CONVENIO,
  case when l_linenumber % 3 = 0 then null when l_partkey % 10 = 0 then strftime(l_shipdate, '%d/%m') || '/0209'
    else {D('l_shipdate')} end DATA_TRIBUTO,
  {M('cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2))')} VL_PAG_TRIBUTOS
from lineitem where l_tax > 0"""
CTES["v_pagamentos"] = f"""
select case when l_partkey % 97 <> 0 then cast(l_orderkey * 10 + l_linenumber as varchar) end NR_MOV_FIN,
  cast(l_orderkey as varchar) NR_CONVENIO, case when l_suppkey % 31 <> 0 then cast(l_suppkey as varchar) end IDENTIF_FORNECEDOR,
  case when l_suppkey % 5 = 0 then 'Supplier ' else 'SUPPLIER ' end || l_suppkey NOME_FORNECEDOR,
  case when l_linenumber <> 6 or l_partkey % 2 = 0 then {D('l_shipdate')} end DATA_PAG,
  case when l_quantity = 1 then '0,00' else {M('l_extendedprice')} end VL_PAGO from lineitem"""
CTES["v_obtv"] = f"""
select case when l_orderkey % 211 <> 0 then cast(l_orderkey * 10 + 1 as varchar) end NR_MOV_FIN,
  case when min(l_partkey) % 29 <> 0 then 'B' || min(l_partkey) end IDENTIF_FAVORECIDO_OBTV_CONV,
  case when min(l_partkey) % 19 <> 0 then 'Benef ' || min(l_partkey) end NM_FAVORECIDO_OBTV_CONV,
  'Material' TP_AQUISICAO, {M('min(l_extendedprice)')} VL_PAGO_OBTV_CONV
from lineitem where l_returnflag = 'R' and l_linenumber = 1 group by l_orderkey"""
CTES["v_licitacoes_once"] = f"""
select cast(p_partkey as varchar) ID_LICITACAO, cast(p_partkey * 9 as varchar) NR_CONVENIO,
  case p_partkey % 7 when 0 then '12' when 1 then null when 2 then '34' else p_type end MODALIDADE_LICITACAO,
  case p_partkey % 3 when 1 then 'Eletrônica' when 2 then '5' end TP_PROCESSO_COMPRA,
  case p_partkey % 9 when 0 then 'Presencial - ' || p_name when 1 then 'Eletrônico - Registro de Preço'
    when 2 then 'ELETRONICO Menor Preço' when 3 then 'Melhor técnica' when 4 then 'Técnica e Preço' when 5 then '123'
    when 7 then 'menor preço e melhor tecnica' when 8 then 'Tecnica e preco registro de preco' end TIPO_LICITACAO,
  case when p_partkey % 8 <> 0 then p_brand end STATUS_LICITACAO,
  case when p_partkey % 6 <> 0 then {M('p_retailprice')} end VALOR_LICITACAO, p_partkey from part"""
CTES["v_licitacoes"] = """
select * exclude (p_partkey) from v_licitacoes_once
union all select * exclude (p_partkey) replace (lower(STATUS_LICITACAO) as STATUS_LICITACAO)
from v_licitacoes_once where p_partkey % 50 = 0"""

# Staged tables (only proponents carry padding).
for _name in ("estados", "municipios", "propostas", "emendas", "desembolsos", "contrapartidas", "tributos", "pagamentos"):
    CTES[f"s_{_name}"] = f"select distinct * from v_{_name}"
CTES["s_proponentes"] = f"select distinct IDENTIF_PROPONENTE, trim(NM_PROPONENTE, {STRIP}) NM_PROPONENTE from v_proponentes"
CTES["s_convenios"] = """
select distinct * replace (case when upper(INSTRUMENTO_ATIVO) = 'NÃO' then 'NAO' else INSTRUMENTO_ATIVO end as INSTRUMENTO_ATIVO)
from v_convenios where DIA_ASSIN_CONV is not null and DIA_PUBL_CONV is not null"""
CTES["s_obtv"] = "select distinct * from v_obtv where IDENTIF_FAVORECIDO_OBTV_CONV is not null"
CTES["s_licitacoes"] = "select * from v_licitacoes"

# Mart tables.
CTES["m_estados"] = f"""
select distinct upper(uf) SIGLA, upper(nome) NOME, upper(regiao) REGIAO,
  {case_map('upper(regiao)', fixed.REGION_CODES)} REGIAO_ABREVIADA from s_estados"""
CTES["x_listed"] = """
select upper(m.codigo_ibge) code, upper(m.nome) town, latitude, longitude, capital, upper(e.uf) uf, upper(e.nome) state,
  upper(e.regiao) region from s_municipios m join s_estados e using (codigo_uf)"""
CTES["x_towns"] = f"""
select code, town, latitude, longitude, case capital when '1' then 'SIM' when '0' then 'NAO' else capital end capital, uf, state, region
from x_listed
union
select p.COD_MUNIC_IBGE, p.MUNIC_PROPONENTE, null, null, 'NAO', p.UF_PROPONENTE, n.state, {case_map('p.UF_PROPONENTE', STATE_REGION)}
from s_propostas p left join (select distinct uf, state from x_listed) n on n.uf = p.UF_PROPONENTE
where not exists (select 1 from x_listed l where l.code = p.COD_MUNIC_IBGE)"""
CTES["m_municipios"] = f"""
select try_cast(code as bigint) CODIGO_IBGE, town NOME_MUNICIPIO, uf UF, region REGIAO,
  {case_map('region', fixed.REGION_CODES)} REGIAO_ABREVIADA, coalesce(state, '{fixed.UNSPECIFIED_M}') NOME_ESTADO,
  try_cast(replace(latitude, ',', '.') as double) LATITUDE, try_cast(replace(longitude, ',', '.') as double) LONGITUDE,
  capital CAPITAL from x_towns"""
CTES["x_chain"] = """
select c.*, p.* exclude (ID_PROPOSTA, IDENTIF_PROPONENTE), o.IDENTIF_PROPONENTE, o.NM_PROPONENTE
from s_convenios c join s_propostas p using (ID_PROPOSTA) join s_proponentes o using (IDENTIF_PROPONENTE)"""
CTES["m_proponentes"] = """
select distinct IDENTIF_PROPONENTE, NM_PROPONENTE, try_cast(COD_MUNIC_IBGE as bigint) CODIGO_IBGE from x_chain"""
CTES["x_grants"] = "select distinct * exclude (NM_PROPONENTE, COD_MUNIC_IBGE) from x_chain"
CTES["x_transfers"] = """
select distinct p.ANO_PROP || e.NR_EMENDA NR_EMENDA, g.NR_CONVENIO, e.NOME_PARLAMENTAR, e.TIPO_PARLAMENTAR, e.VALOR_REPASSE_EMENDA
from s_emendas e join (select distinct ID_PROPOSTA, ANO_PROP from s_propostas) p using (ID_PROPOSTA)
join (select distinct ID_PROPOSTA, NR_CONVENIO from x_grants) g using (ID_PROPOSTA) where e.NR_EMENDA is not null"""
CTES["m_emendas_convenios"] = f"""
select try_cast(NR_EMENDA as bigint) NR_EMENDA, try_cast(NR_CONVENIO as bigint) NR_CONVENIO,
  {money('VALOR_REPASSE_EMENDA')} VALOR_REPASSE_EMENDA
from (select distinct NR_EMENDA, NR_CONVENIO, VALOR_REPASSE_EMENDA from x_transfers)"""
CTES["m_emendas"] = f"""
select try_cast(NR_EMENDA as bigint) NR_EMENDA, coalesce(NOME_PARLAMENTAR, '{fixed.UNSPECIFIED_M}') NOME_PARLAMENTAR,
  coalesce(TIPO_PARLAMENTAR, '{fixed.UNSPECIFIED_M}') TIPO_PARLAMENTAR,
  cast(coalesce(sum({money('VALOR_REPASSE_EMENDA')}), 0) as decimal(18,2)) VALOR_EMENDA
from (select distinct NR_EMENDA, NOME_PARLAMENTAR, TIPO_PARLAMENTAR, VALOR_REPASSE_EMENDA from x_transfers) group by 1, 2, 3"""
CTES["m_convenios"] = f"""
select distinct try_cast(g.NR_CONVENIO as bigint) NR_CONVENIO, {day('DIA_ASSIN_CONV')} DIA_ASSIN_CONV,
  upper(coalesce(SIT_CONVENIO, '{fixed.UNDEFINED_F}')) SIT_CONVENIO, upper(INSTRUMENTO_ATIVO) INSTRUMENTO_ATIVO,
  {day('DIA_PUBL_CONV')} DIA_PUBL_CONV, {day('DIA_INIC_VIGENC_CONV')} DIA_INIC_VIGENC_CONV,
  {day('DIA_FIM_VIGENC_CONV')} DIA_FIM_VIGENC_CONV, {day('DIA_LIMITE_PREST_CONTAS')} DIA_LIMITE_PREST_CONTAS,
  {money('VL_GLOBAL_CONV')} VL_GLOBAL_CONV, {money('VL_REPASSE_CONV')} VL_REPASSE_CONV,
  {money('VL_CONTRAPARTIDA_CONV')} VL_CONTRAPARTIDA_CONV, try_cast(COD_ORGAO_SUP as bigint) COD_ORGAO_SUP, DESC_ORGAO_SUP,
  upper(NATUREZA_JURIDICA) NATUREZA_JURIDICA, try_cast(COD_ORGAO as bigint) COD_ORGAO, DESC_ORGAO, MODALIDADE,
  IDENTIF_PROPONENTE, OBJETO_PROPOSTA, cast(coalesce(t.total, 0) as decimal(18,2)) VALOR_EMENDA_CONVENIO,
  case when t.grant_nr is not null then 'SIM' else 'NAO' end COM_EMENDAS, cast(0 as double) INSUCESSO
from x_grants g left join (select NR_CONVENIO grant_nr, sum(VALOR_REPASSE_EMENDA) total from m_emendas_convenios group by 1) t
  on t.grant_nr = try_cast(g.NR_CONVENIO as bigint)"""
_MOD = "case when MODALIDADE_LICITACAO = '12' then 'PREGÃO' else MODALIDADE_LICITACAO end"
CTES["x_licitacoes"] = f"""
select *, lower(case when not {number_text('TIPO_LICITACAO')} then TIPO_LICITACAO end) kind,
  case when {_MOD} is null or {number_text(_MOD)} then TP_PROCESSO_COMPRA else {_MOD} end mod2
from s_licitacoes where try_cast(NR_CONVENIO as bigint) in (select NR_CONVENIO from m_convenios)"""
CTES["x_licitacoes_classified"] = f"""
select distinct ID_LICITACAO, NR_CONVENIO,
  case when mod2 is null or {number_text('mod2')} then '{fixed.UNSPECIFIED_F}' else mod2 end MODALIDADE_COMPRA,
  case when kind like '%menor preço%' or kind like '%menor preco%' or kind like '%menor valor%' then 'MENOR PREÇO'
    when kind like '%melhor técnica%' or kind like '%melhor tecnica%' then 'MELHOR TÉCNICA'
    when regexp_matches(kind, 't[eé]cnica e pre[cç]o') then 'TÉCNICA E PREÇO' else '{fixed.NOT_APPLICABLE}' end TIPO_LICITACAO,
  case when kind like 'presencial%' then 'PRESENCIAL' when kind like 'eletrônico%' or kind like 'eletronico%' then 'ELETRÔNICO'
    else '{fixed.NOT_APPLICABLE}' end FORMA_LICITACAO,
  case when kind like '%registro de preço%' or kind like '%registro de preco%' then 'SIM' else 'NAO' end REGISTRO_PRECOS,
  'NAO' LICITACAO_INTERNACIONAL, coalesce(STATUS_LICITACAO, '{fixed.UNDEFINED_M}') STATUS_LICITACAO,
  replace(VALOR_LICITACAO, ',', '.') amount from x_licitacoes"""
CTES["m_licitacoes"] = """
select try_cast(ID_LICITACAO as bigint) ID_LICITACAO, try_cast(NR_CONVENIO as bigint) NR_CONVENIO,
  upper(MODALIDADE_COMPRA) MODALIDADE_COMPRA, TIPO_LICITACAO, FORMA_LICITACAO, REGISTRO_PRECOS, LICITACAO_INTERNACIONAL,
  upper(STATUS_LICITACAO) STATUS_LICITACAO, coalesce(try_cast(amount as decimal(18,2)), 0) VALOR_LICITACAO
from x_licitacoes_classified"""
CTES["x_paid"] = """
select p.NR_MOV_FIN, p.NR_CONVENIO,
  case when b.IDENTIF_FAVORECIDO_OBTV_CONV is not null then b.IDENTIF_FAVORECIDO_OBTV_CONV else p.IDENTIF_FORNECEDOR end IDENTIF_FORNECEDOR,
  case when b.IDENTIF_FAVORECIDO_OBTV_CONV is not null then b.NM_FAVORECIDO_OBTV_CONV else p.NOME_FORNECEDOR end NOME_FORNECEDOR,
  case when b.IDENTIF_FAVORECIDO_OBTV_CONV is not null then b.VL_PAGO_OBTV_CONV else p.VL_PAGO end VL_PAGO
from s_pagamentos p left join s_obtv b on p.NR_MOV_FIN is not distinct from b.NR_MOV_FIN
where p.DATA_PAG is not null and try_cast(p.NR_CONVENIO as bigint) in (select NR_CONVENIO from m_convenios)"""
CTES["x_suppliers"] = f"""
select distinct upper(coalesce(IDENTIF_FORNECEDOR, '{fixed.UNSPECIFIED_F}')) IDENTIF_FORNECEDOR,
  upper(coalesce(NOME_FORNECEDOR, '{fixed.UNSPECIFIED_M}')) NOME_FORNECEDOR from x_paid where {money('VL_PAGO')} <> 0"""
CTES["m_fornecedores"] = f"""
select row_number() over (order by substr(md5(concat_ws('|', IDENTIF_FORNECEDOR, NOME_FORNECEDOR, '0')), 1, 4),
  IDENTIF_FORNECEDOR, NOME_FORNECEDOR) FORNECEDOR_ID, IDENTIF_FORNECEDOR, NOME_FORNECEDOR from x_suppliers
union all select -1, '{fixed.NO_MEMBER}', '{fixed.NO_MEMBER}'"""


def _deposits(table: str, kind: str, date: str, amount: str) -> str:
    return f"""
select try_cast(NR_CONVENIO as bigint) NR_CONVENIO, {day(date)} DATA_MOV, {money(amount)} VALOR_MOV, '{kind}' TIPO_MOV, cast(-1 as bigint) FORNECEDOR_ID
from s_{table} where {date} is not null and {amount} is not null and {money(amount)} <> 0
  and try_cast(NR_CONVENIO as bigint) in (select NR_CONVENIO from m_convenios)"""


CTES["x_leg_d"] = _deposits("desembolsos", "D", "DATA_DESEMBOLSO", "VL_DESEMBOLSADO")
CTES["x_leg_c"] = _deposits("contrapartidas", "C", "DT_INGRESSO_CONTRAPARTIDA", "VL_INGRESSO_CONTRAPARTIDA")
CTES["x_leg_aif"] = "".join(
    f"{'union all ' if kind != 'A' else ''}select NR_CONVENIO, {col} DATA_MOV, VL_GLOBAL_CONV VALOR_MOV, '{kind}' TIPO_MOV, "
    "cast(-1 as bigint) FORNECEDOR_ID from m_convenios\n"
    for kind, col in (("A", "DIA_ASSIN_CONV"), ("I", "DIA_INIC_VIGENC_CONV"), ("F", "DIA_FIM_VIGENC_CONV")))
CTES["x_leg_p"] = f"""
select try_cast(NR_CONVENIO as bigint) NR_CONVENIO, {day('DATA_PAG')} DATA_MOV, {money('VL_PAGO')} VALOR_MOV, 'P' TIPO_MOV, FORNECEDOR_ID
from s_pagamentos join m_fornecedores using (IDENTIF_FORNECEDOR, NOME_FORNECEDOR) where DATA_PAG is not null and {money('VL_PAGO')} <> 0"""
CTES["x_leg_t"] = f"""
select try_cast(t.NR_CONVENIO as bigint) NR_CONVENIO,
  case when right(DATA_TRIBUTO, 5) = '/0209' then date '2009-01-01' when DATA_TRIBUTO is not null then {day('DATA_TRIBUTO')}
    else coalesce(p.paid, c.DIA_INIC_VIGENC_CONV) end DATA_MOV,
  {money('VL_PAG_TRIBUTOS')} VALOR_MOV, 'T' TIPO_MOV, cast(-1 as bigint) FORNECEDOR_ID
from s_tributos t left join (select NR_CONVENIO, min(DATA_MOV) paid from x_leg_p group by 1) p
  on p.NR_CONVENIO = try_cast(t.NR_CONVENIO as bigint)
left join m_convenios c on c.NR_CONVENIO = try_cast(t.NR_CONVENIO as bigint)"""
CTES["x_ledger"] = """
select * from x_leg_aif union all select * from x_leg_d union all select * from x_leg_c
union all select * from x_leg_p union all select * from x_leg_t"""
CTES["m_movimento"] = """
select row_number() over (order by substr(md5(concat_ws('|', cast(DATA_MOV as varchar), TIPO_MOV, cast(NR_CONVENIO as varchar),
    cast(FORNECEDOR_ID as varchar), cast(VALOR_MOV as varchar), cast(copy // 10000 as varchar))), 1, 4),
  DATA_MOV nulls last, TIPO_MOV, NR_CONVENIO nulls last, FORNECEDOR_ID, VALOR_MOV nulls last, copy) MOV_ID,
  NR_CONVENIO, DATA_MOV, VALOR_MOV, TIPO_MOV, FORNECEDOR_ID
from (select *, row_number() over (partition by NR_CONVENIO, DATA_MOV, VALOR_MOV, TIPO_MOV, FORNECEDOR_ID) - 1 copy from x_ledger)"""
CTES["x_snapshot"] = "select max(cast(ts as date)) DATA_ATUAL from events"


def calendar_select(days: str) -> str:
    months = f"[{quoted(fixed.MONTHS)}]"
    weekdays = f"[{quoted(fixed.WEEKDAYS)}]"
    return f"""
select d DATA, year(d) ANO, month(d) MES_NUMERO, {months}[month(d)] MES_NOME, year(d) * 100 + month(d) ANO_MES_NUMERO,
  lpad(cast(month(d) as varchar), 2, '0') || ' ' || year(d) MES_ANO, {months}[month(d)] || ' ' || year(d) MES_NOME_ANO,
  quarter(d) TRIMESTRE_NUMERO, quarter(d) || 'o semestre' TRIMESTRE_NOME, year(d) * 100 + quarter(d) ANO_TRIMESTRE_NUMERO,
  lpad(cast(quarter(d) as varchar), 2, '0') || ' ' || year(d) TRIMESTRE_ANO, quarter(d) || 'o semestre ' || year(d) TRIMESTRE_NOME_ANO,
  weekofyear(d) SEMANA_NUMERO, weekofyear(d) || 'a semana' SEMANA_NOME, year(d) * 100 + weekofyear(d) ANO_SEMANA_NUMERO,
  lpad(cast(weekofyear(d) as varchar), 2, '0') || ' ' || year(d) SEMANA_ANO, weekofyear(d) || 'a semana ' || year(d) SEMANA_NOME_ANO,
  {weekdays}[isodow(d)] DIA_DA_SEMANA from {days}"""


CTES["x_days"] = """
select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) d
from (select min(DATA_MOV) lo, (select DATA_ATUAL from x_snapshot) hi from x_ledger)"""
CTES["m_calendario"] = calendar_select("x_days")
CTES["m_atributos"] = "\nunion all ".join(
    f"(select distinct '{label}' ATRIBUTO, {col} VALOR from {table})" for label, col, table in (
        ("SIT_CONVENIO", "SIT_CONVENIO", "m_convenios"), ("NATUREZA_JURIDICA", "NATUREZA_JURIDICA", "m_convenios"),
        ("MODALIDADE_TRANSFERENCIA", "MODALIDADE", "m_convenios"), ("TIPO_PARLAMENTAR", "TIPO_PARLAMENTAR", "m_emendas"),
        ("MODALIDADE_COMPRA", "MODALIDADE_COMPRA", "m_licitacoes"), ("TIPO_LICITACAO", "TIPO_LICITACAO", "m_licitacoes"),
        ("FORMA_LICITACAO", "FORMA_LICITACAO", "m_licitacoes"), ("STATUS_LICITACAO", "STATUS_LICITACAO", "m_licitacoes")))


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the expressions it names, directly or through one another."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(re.findall(r"\b[vsxm]_[a-z_]+\b", sql)) & CTES.keys():
            if name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(body)
    ordered = [name for name in CTES if name in needed]
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in ordered) + "\n" + body
