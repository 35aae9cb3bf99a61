"""Table builders, ledger legs, sinks, contracts and risk scoring on the raw views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalog.registry import Inputs, query
from catalog.views_sql import quoted
from outorga import contracts, fixed
from outorga.fixed.rules import suffix_rules
from outorga.functions.stems import ACCENTED, PLAIN, stems, tokens
from outorga.operators.joins import bad_suffix_date, keep_known
from outorga.operators.tables import append_member, union_all, without_copies
from outorga.plans import derived, geography, grants, ledger, procurements, suppliers
from outorga.risk import components, features, kmeans, linear, model, text
from outorga.schemas import CONTRACTS, MART_SCHEMAS, REFERENCES
from outorga.session import begun, cut_lineage, spread
from outorga.sinks import targets
from outorga.sources.gates import freshness
from outorga.sources.snapshots import Snapshots
from pyspark.sql import types as T


def mart_select(table: str, source: str | None = None) -> str:
    columns = [f"cast({f.name} as double) {f.name}" if isinstance(f.dataType, T.DecimalType) else f.name
               for f in MART_SCHEMAS[table].fields]
    return f"select {', '.join(columns)} from {source or 'm_' + table}"


# Tables several builders start from. Each is cut off where more than one reader follows.


def transfers(stage) -> DataFrame:
    return grants.amendment_transfers(stage)


def bridge(stage) -> DataFrame:
    return grants.emendas_convenios(transfers(stage))


def amendments(stage) -> DataFrame:
    return grants.emendas(transfers(stage))


def fact(i: Inputs, stage=None) -> DataFrame:
    stage = i.staged() if stage is None else stage
    return cut_lineage(grants.convenios(stage, bridge(stage)))


def supplier_dimension(i: Inputs, stage, grants_: DataFrame) -> DataFrame:
    return cut_lineage(suppliers.fornecedores(stage, grants_))


def dates(stage) -> DataFrame:
    """Grants for the ledger."""
    return cut_lineage(grants.dated_grants(stage).select("NR_CONVENIO", "VL_GLOBAL_CONV", "DIA_ASSIN_CONV", "DIA_INIC_VIGENC_CONV", "DIA_FIM_VIGENC_CONV"))


def moves(i: Inputs) -> DataFrame:
    """The ledger for those who don't look at suppliers: their names decide which payments are in it, so they need no ids."""
    stage = i.staged()
    grants_ = dates(stage)
    names = suppliers.paid_suppliers(stage, grants_).select(F.lit(0).cast("long").alias("FORNECEDOR_ID"), *suppliers.NAMES)
    names = append_member(names, FORNECEDOR_ID=fixed.NO_MEMBER_ID, IDENTIF_FORNECEDOR=fixed.NO_MEMBER, NOME_FORNECEDOR=fixed.NO_MEMBER)
    return ledger.movements(stage, grants_, names)


#: The extracts in the order in which the tables below ask for them.
EXTRACTS = ["propostas", "emendas", "convenios", "proponentes", "pagamentos", "obtv", "desembolsos", "contrapartidas", "tributos"]


#: Orders up to which the models' fact keeps the order of its rows. Spark's k-means draws its seeds from the rows in their order,
#: so few rows, which cost nothing, give the model they always gave. More rows lie as the cluster's tasks leave them in any case.
FEW_ORDERS = 1_000_000


def _ordered(i: Inputs) -> bool:
    return i.orders.count() <= FEW_ORDERS


def _ledger(stage, grants_: DataFrame, paid: DataFrame) -> DataFrame:
    return cut_lineage(ledger.movimento(stage, grants_, paid, keep_legs=cut_lineage), deltas=True)


def _base(stage) -> tuple[dict[str, DataFrame], DataFrame]:
    """The fact and the links to amendments, and the transfers. Granted rows and links are written down once, and
    no whole grant is shuffled to find its copies."""
    granted = cut_lineage(grants.shared_rows(stage))
    lines = cut_lineage(grants.amendment_transfers(stage, granted))
    links = cut_lineage(grants.emendas_convenios(lines))
    return {"emendas_convenios": links, "convenios": cut_lineage(grants.convenios(stage, links, granted, without_copies))}, lines


def mart(i: Inputs, in_order: bool | None = None) -> dict[str, DataFrame]:
    """Six tables of the mart and the ``features.principals`` of its grants. With ``in_order`` the rows of the fact, and of the
    features, come in the order that shuffles of whole rows give; principals are then left to the features."""
    in_order = _ordered(i) if in_order is None else in_order
    stage = i.staged(in_order).begin(*EXTRACTS)
    if in_order:
        lines = cut_lineage(transfers(stage))
        links = grants.emendas_convenios(lines)
        tables = {"emendas_convenios": links, "convenios": cut_lineage(grants.convenios(stage, links))}
        tables |= {"emendas": grants.emendas(lines), "proponentes": grants.proponentes(stage)}
    else:
        tables, lines = _base(stage)
        beside = begun(i.spark, [lambda: cut_lineage(grants.emendas(lines)), lambda: cut_lineage(grants.proponentes(stage))])
    tables["fornecedores"] = supplier_dimension(i, stage, tables["convenios"])
    tables["movimento"] = _ledger(stage, tables["convenios"], tables["fornecedores"])
    if not in_order:
        tables |= {name: table.result() for name, table in zip(("emendas", "proponentes"), beside)}
        tables |= features.principals(tables, tables["convenios"].select("NR_CONVENIO").distinct(), gathered=True)
    return tables


# ------------------------------------------------------------------ builders


@query("t1_estados", mart_select("estados"))
def _(i: Inputs):
    return geography.estados(i.staged())


@query("t2_municipios", mart_select("municipios"))
def _(i: Inputs):
    return geography.municipios(i.staged())


@query("t3_proponentes", mart_select("proponentes"))
def _(i: Inputs):
    return grants.proponentes(i.staged())


@query("t4_emendas_convenios", mart_select("emendas_convenios"))
def _(i: Inputs):
    return bridge(i.staged())


@query("t5_emendas", mart_select("emendas"))
def _(i: Inputs):
    return amendments(i.staged())


@query("t6_convenios", mart_select("convenios"))
def t6_convenios(i: Inputs):
    stage = i.staged()
    return grants.convenios(stage, bridge(stage))


@query("t7_licitacoes", mart_select("licitacoes"))
def _(i: Inputs):
    stage = i.staged()
    return procurements.licitacoes(stage, grants.granted_proposals(stage, ["NR_CONVENIO"]))


@query("t8_fornecedores", mart_select("fornecedores"))
def _(i: Inputs):
    stage = i.staged()
    return suppliers.fornecedores(stage, grants.known_grants(stage))


@query("t9_movimento", mart_select("movimento"))
def _(i: Inputs):
    stage = i.staged()
    grants_ = dates(stage)
    return ledger.movimento(stage, grants_, supplier_dimension(i, stage, grants_), keep_legs=cut_lineage)


@query("t10_atributos", "select * from m_atributos")
def _(i: Inputs):
    stage = i.staged()
    grants_ = fact(i, stage)
    return derived.atributos(grants_, amendments(stage), procurements.licitacoes(stage, grants_))


@query("t11_calendario", mart_select("calendario"))
def _(i: Inputs):
    last = i.events.agg(F.max(F.col("ts").cast("date"))).scalar()
    return derived.calendario(moves(i), "DATA_MOV", last)


@query("t12_data_atual", "select DATA_ATUAL from x_snapshot")
def _(i: Inputs):
    day = i.events.agg(F.max(F.col("ts").cast("date")).alias("d")).first()["d"]
    return derived.data_atual(i.spark, day)


# ------------------------------------------------------------------ ledger legs

_LEG = "select NR_CONVENIO, DATA_MOV, cast(VALOR_MOV as double) VALOR_MOV, TIPO_MOV, FORNECEDOR_ID from "


@query("l1_l3_milestones", _LEG + "x_leg_aif")
def _(i: Inputs):
    return ledger.milestone_legs(dates(i.staged()))


@query("l4_disbursements", _LEG + "x_leg_d")
def _(i: Inputs):
    stage = i.staged()
    grants_ = grants.granted_proposals(stage, ["NR_CONVENIO"])
    return ledger.deposit_leg(stage["desembolsos"], "D", "DATA_DESEMBOLSO", "VL_DESEMBOLSADO", grants_)


@query("l5_counterparts", _LEG + "x_leg_c")
def _(i: Inputs):
    stage = i.staged()
    grants_ = grants.granted_proposals(stage, ["NR_CONVENIO"])
    return ledger.deposit_leg(
        stage["contrapartidas"], "C", "DT_INGRESSO_CONTRAPARTIDA", "VL_INGRESSO_CONTRAPARTIDA", grants_)


@query("l6_payments", _LEG + "x_leg_p")
def _(i: Inputs):
    stage = i.staged()
    return ledger.payment_leg(stage["pagamentos"], supplier_dimension(i, stage, grants.known_grants(stage)))


@query("l7_taxes", _LEG + "x_leg_t")
def _(i: Inputs):
    stage = i.staged()
    grants_ = dates(stage)
    payments = ledger.payment_leg(stage["pagamentos"], supplier_dimension(i, stage, grants_))
    return ledger.tax_leg(stage["tributos"], payments, grants_)


# ------------------------------------------------------------------ text

STOP_WORDS = ["de", "la", "le", "the", "and", "of", "und", "der", "die", "des", "les", "los", "las", "que", "to", "in"]
_TOKENS = f"""list_filter(regexp_extract_all(translate(lower(text), '{ACCENTED}', '{PLAIN}'), '[a-z]+'),
  lambda w: length(w) > 1 and w not in ({quoted(STOP_WORDS)}))"""


@query("m1_tokens", f"select doc_id, array_to_string({_TOKENS}, ' ') tokens, len({_TOKENS}) n from documents")
def _(i: Inputs):
    words = tokens(F.col("text"), STOP_WORDS)
    return i.documents.select("doc_id", F.array_join(words, " ").alias("tokens"), F.size(words).cast("long").alias("n"))


def stem_case(word: str, *steps: int) -> str:
    """The rules of the given steps as one CASE per step; the first step with a hit wins."""
    cases = []
    for step in steps:
        branches = []
        for r in (r for r in suffix_rules() if r.step == step):
            test = f"ends_with({word}, '{r.suffix}') and length({word}) >= {len(r.suffix) + r.least}"
            if r.exceptions:
                test += f" and {word} not in ({quoted(r.exceptions)})"
            branches.append(f"when {test} then left({word}, length({word}) - {len(r.suffix)}) || '{r.replacement}'")
        cases.append(f"case {' '.join(branches)} end")
    return f"coalesce({', '.join(cases)}, {word})"


def stem_ctes(terms: str) -> str:
    """Steps one after another over ``terms(term)``; the last one is ``stemmed(term, stem)``."""
    parts = [f"z0 as (select term, {stem_case('term', 0)} w from {terms})"]
    for n, steps in enumerate(((1,), (3,), (2,)), 1):
        parts.append(f"z{n} as (select term, {stem_case('w', *steps)} w from z{n - 1})")
    return ", ".join([*parts, f"stemmed as (select term, {stem_case('w', 4, 5, 6)} stem from z3)"])


@query("m2_vocabulary_stems", f"""
with terms as (select distinct unnest({_TOKENS}) term from documents), {stem_ctes('terms')} select term, stem from stemmed""")
def _(i: Inputs):
    return text.vocabulary_stems(spread(i.documents), "text", STOP_WORDS)


@query("m2_plural_step", f"""
with terms as (select distinct unnest({_TOKENS}) term from documents) select term, {stem_case('term', 0)} stem from terms""")
def _(i: Inputs):
    plural = [r for r in suffix_rules() if r.step == 0]
    terms = i.documents.select(F.explode(tokens(F.col("text"), STOP_WORDS)).alias("term")).distinct()
    return terms.select("term", stems(F.array("term"), plural)[0].alias("stem"))


_WEIGHTS = f"""
words as (select doc_id, unnest({_TOKENS}) term from documents), terms as (select distinct term from words), {stem_ctes('terms')},
tf as (select doc_id, stem term, count(*) tf from words join stemmed using (term) where length(stem) > 1 group by 1, 2),
df as (select term, count(*) df from tf group by 1),
w as (select doc_id, term, tf, df, tf * (ln((1.0 + (select count(*) from documents)) / (1.0 + df)) + 1) w from tf join df using (term))"""


@query("m3_tf_idf", f"""
with {_WEIGHTS.strip()}
select doc_id, term, tf, df, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) weight from w""")
def _(i: Inputs):
    weights = text.tf_idf(spread(i.documents), "doc_id", "text", STOP_WORDS)
    return weights.withColumn("weight", F.round("weight", 6))


_GIVEN = f"""
with {_WEIGHTS.strip()},
x as (select doc_id, term, cast(round(1000000 * (w / sqrt(sum(w * w) over (partition by doc_id)))) as bigint) x from w),
given as (select doc_id, row_number() over (order by doc_id) - 1 cluster from (select distinct doc_id from x where x <> 0) qualify cluster < 5),
c as (select cluster, term, x c from x join given using (doc_id)),
n as (select cluster, sum(c * c) n from c group by 1), xx as (select doc_id, sum(x * x) xx from x where x <> 0 group by 1),
dots as (select x.doc_id, cluster, sum(x * c) d from x join c using (term) group by 1, 2),
far as (select doc_id, n.cluster, cast(xx - 2 * coalesce(d, 0) + n as bigint) far from xx join n on true left join dots using (doc_id, cluster)),
near as (select doc_id, cluster from far qualify row_number() over (partition by doc_id order by far, cluster) = 1)"""


def _given_points(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Points of the documents, and as centres those of the five smallest doc_ids."""
    points = cut_lineage(kmeans.points(text.tf_idf(spread(i.documents), "doc_id", "text", STOP_WORDS), "doc_id", "term", "weight"))
    given = points.select("key").distinct().orderBy("key").limit(5).select("key", (F.row_number().over(W.orderBy("key")) - 1).alias("cluster"))
    return points, cut_lineage(kmeans.centres_of(points, given, 5))


@query("m4_given_distances", _GIVEN + """
select doc_id, near.cluster::int cluster, max(far) filter (far.cluster = 0) distance_0, max(far) filter (far.cluster = 1) distance_1,
  max(far) filter (far.cluster = 2) distance_2, max(far) filter (far.cluster = 3) distance_3, max(far) filter (far.cluster = 4) distance_4
from far join near using (doc_id) group by 1, 2""")
def _(i: Inputs):
    points, centres = _given_points(i)
    far = kmeans.squared_distances(points, centres, 5)
    return far.select(
        F.col("key").alias("doc_id"), kmeans.nearest(F.col("distances")).alias("cluster"),
        *[F.col("distances")[j].alias(f"distance_{j}") for j in range(5)])


@query("m4_lloyd_step", _GIVEN + """
, sums as (select cluster, term, sum(x) s from x join near using (doc_id) group by 1, 2), sizes as (select cluster, count(*) k from near group by 1)
select * from (select cluster::int cluster, term, cast((2 * s + k) // (2 * k) as bigint) c from sums join sizes using (cluster)
union all select cluster::int, term, c from c where cluster not in (select cluster from near)) where c <> 0""")
def _(i: Inputs):
    points, centres = _given_points(i)
    moved = kmeans.step(points, centres, 5)
    return moved.select(F.col("column").alias("term"), F.posexplode("c").alias("cluster", "c")).where("c <> 0")


@query("m4_reproducible_clusters")
def _(i: Inputs):
    """Clusters from seeds of its own; the same whatever the partitions."""
    weights = text.tf_idf(spread(i.documents), "doc_id", "text", STOP_WORDS)
    points = cut_lineage(kmeans.points(weights, "doc_id", "term", "weight"))
    return kmeans.assigned(points, kmeans.fit(points, 5, steps=5), 5).select(F.col("key").alias("doc_id"), "cluster")


def _clusterer() -> text.TextClusterer:
    return text.TextClusterer(k=5, seed=0, width=2**12, stop_words=STOP_WORDS)


@query("m4_text_clusters")
def _(i: Inputs):
    return _clusterer().fit_predict(spread(i.documents.select("doc_id", "text")), "text").select("doc_id", "cluster")


@query("m4_cluster_distances")
def _(i: Inputs):
    distances = _clusterer().fit_transform(spread(i.documents.select("doc_id", "text")), "doc_id", "text")
    return distances.select("doc_id", *[F.col("distances")[j].alias(f"distance_{j}") for j in range(5)])


# ------------------------------------------------------------------ risk

_WINNERS = """
politician as (select NR_CONVENIO, max(NOME_PARLAMENTAR) PRINCIPAL_PARLAMENTAR from (
  select *, rank() over (partition by NR_CONVENIO order by VALOR_REPASSE_EMENDA desc) r from m_emendas_convenios where VALOR_REPASSE_EMENDA is not null)
  join m_emendas using (NR_EMENDA) where r = 1 group by 1),
paid as (select NR_CONVENIO, FORNECEDOR_ID, sum(VALOR_MOV) paid from x_leg_p group by 1, 2),
supplier_ as (select NR_CONVENIO, max(IDENTIF_FORNECEDOR) PRINCIPAL_FORNECEDOR from (
  select *, rank() over (partition by NR_CONVENIO order by paid desc) r from paid) join m_fornecedores using (FORNECEDOR_ID) where r = 1 group by 1)"""
_FILL = ", ".join(f"coalesce({c}, '{fixed.NO_MEMBER}') {c}" for c in features.TEXTS)


def _after_ctes(sql: str) -> str:
    """Common table expressions of a body that has some of its own."""
    from catalog.views_sql import with_ctes

    prefix = with_ctes(sql)
    head, _, _ = prefix.rpartition(sql)
    return head.rstrip() + ("," if head else "with") + sql


@query("m5_features")
def _(i: Inputs):
    tables = mart(i, in_order=False)
    return features.feature_frame(tables["convenios"], tables, label=True)


from catalog.registry import SQL  # noqa: E402

_FEATURES = f"""
select NR_CONVENIO, cast(VL_REPASSE_CONV as double) VL_REPASSE_CONV, cast(VL_CONTRAPARTIDA_CONV as double) VL_CONTRAPARTIDA_CONV,
  cast(VALOR_EMENDA_CONVENIO as double) VALOR_EMENDA_CONVENIO, COD_ORGAO, COD_ORGAO_SUP, CODIGO_IBGE, {_FILL},
  case when SIT_CONVENIO in ({quoted(s.upper() for s in fixed.FAILED_STATUSES)}) then 1 else 0 end LABEL
from m_convenios join m_proponentes using (IDENTIF_PROPONENTE) left join politician using (NR_CONVENIO) left join supplier_ using (NR_CONVENIO)"""
SQL["m5_features"] = _after_ctes(_WINNERS + _FEATURES)


def _fitted(i: Inputs):
    """The tables, the features of all grants, live ones included, and a model of the finished grants among them."""
    tables = mart(i)
    # of all grants, those that are scored later included
    tables |= {name: cut_lineage(tables[name]) for name in ("politicians", "paid_most") if name in tables}
    frame = cut_lineage(features.feature_frame(tables["convenios"], tables, label=True))
    texts_ = text.TextClusterer(k=5, width=2**12)
    return tables, frame, model.fit(_finished(tables, frame).where(~_UNSEEN()), components=8, hash_width=64, texts=texts_)


def _finished(tables, frame):
    """Features of the grants whose outcome is known."""
    return keep_known(frame, "NR_CONVENIO", features.finished(tables["convenios"]))


def _UNSEEN():
    """A fifth of the finished grants, by hash, that the models of the catalog don't learn from."""
    return F.crc32(F.col("NR_CONVENIO").cast("string").cast("binary")) % 5 == 0


@query("m6_encoded_features")
def _(i: Inputs):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    tables = mart(i)
    frame = cut_lineage(features.feature_frame(tables["convenios"], tables))
    frame = text.TextClusterer(k=5, width=2**12).fit(frame, "OBJETO_PROPOSTA").predict(frame, "OBJETO_PROPOSTA")
    frame = features.filled(frame.withColumnRenamed("cluster", model.CLUSTER))
    encoded = Pipeline(stages=model.encoder(64)).fit(frame).transform(frame)
    return encoded.select("NR_CONVENIO", F.transform(vector_to_array("encoded"), lambda v: F.round(v, 6)).alias("encoded"))


_SCALED = ", ".join(f"avg({c}) mean_{c}, stddev_samp({c}) dev_{c}" for c in features.NUMBERS)
_CELLS = "\nunion all ".join([
    f"select r, NR_CONVENIO, '{linear.BIAS}' col, 1.0::double as value from f",
    *[f"select r, NR_CONVENIO, '{c}', coalesce(({c} - mean_{c}) / coalesce(nullif(dev_{c}, 0), 1), 0) from f, known" for c in features.NUMBERS],
    *[f"select r, NR_CONVENIO, '{c}?', ({c} is null)::int::double from f" for c in features.NUMBERS],
    *[f"select r, NR_CONVENIO, '{c}=' || coalesce({c}::varchar, ''), 1 from f" for c in linear.CLOSED],
    *[f"select r, NR_CONVENIO, '{c}#' || substr(md5('{c}=' || coalesce({c}::varchar, '')), 1, 3), 1 from f" for c in linear.OPEN]])
_HEX = " + ".join(f"(instr('0123456789abcdef', substr(md5(col), {n}, 1)) - 1) * {16 ** (2 - n)}" for n in (1, 2))
_LONG = f"""{_WINNERS},
f as materialized (select row_number() over () r, * from ({_FEATURES})), known as (select {_SCALED} from f),
cells as (select * from ({_CELLS}) where value <> 0),
scored as (select r, 1 / (1 + exp(-sum(value * (({_HEX}) / 256.0 - 0.5)))) p from cells group by r)"""


def _long(i: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frame of all grants, its long features, and a given weight for each of their columns."""
    tables = mart(i, in_order=False)
    frame = features.feature_frame(tables["convenios"], tables, label=True)
    frame = cut_lineage(frame.withColumn("r", F.monotonically_increasing_id()))
    cells = linear.long_features(frame, "r", linear.statistics(frame), carried=["NR_CONVENIO"])
    weights = cells.select("column").distinct().withColumn("weight", F.expr(f"({_HEX.replace('col', '`column`')}) / 256.0D - 0.5D"))
    return frame, cells, weights


SQL["m6_long_features"] = _after_ctes(f'{_LONG} select NR_CONVENIO, col "column", round(value, 6) as value from cells')
SQL["m8_linear_scores"] = _after_ctes(f"""{_LONG}
select NR_CONVENIO, LABEL, (p > 0.5)::int::double PREDITO, round(p, 9) PROBABILIDADE from f join scored using (r)""")
SQL["m10_linear_appended"] = _after_ctes(f"""{_LONG}
select f.* exclude (r, LABEL), round(1 / (1 + exp(-2 * (p - 0.5))), 9) INSUCESSO from f join scored using (r)""")


@query("m6_long_features")
def _(i: Inputs):
    _, cells, _ = _long(i)
    return cells.select("NR_CONVENIO", "column", F.round("value", 6).alias("value"))


@query("m8_linear_scores")
def _(i: Inputs):
    frame, cells, weights = _long(i)
    weights = cut_lineage(weights)  # one number for each column, asked for by every sum of scores
    labelled = linear.predicted(frame, "r", cells, weights, name="PREDITO")
    return linear.predicted(labelled, "r", cells, weights, proba=True, name="PROBABILIDADE").select(
        "NR_CONVENIO", "LABEL", "PREDITO", F.round("PROBABILIDADE", 9).alias("PROBABILIDADE"))


@query("m10_linear_appended")
def _(i: Inputs):
    frame, cells, weights = _long(i)
    weights = cut_lineage(weights)  # one number for each column, asked for by every sum of scores
    return linear.predicted(frame, "r", cells, weights, proba=True, scale=True).drop("r", "LABEL").withColumn("INSUCESSO", F.round("INSUCESSO", 9))


@query("m7_subspace", """
select 'orthonormal' "check", true ok union all select 'falling variances', true union all select 'share of the variance', true
union all select 'variances are those of the coordinates', true""")
def _(i: Inputs):
    """Principal components of the orders, checked."""
    k, orders = 4, cut_lineage(i.orders.withColumn("r", F.monotonically_increasing_id()))
    scale = linear.statistics(orders, ["o_totalprice"])
    cells = cut_lineage(linear.long_features(orders, "r", scale, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"], ["o_custkey"], digits=2))
    directions, variances, total = components.principal_components(cells, k)
    products = components._products(directions, k)
    y = components.projected(cells, directions, k).agg(*[F.var_pop(F.col("y")[j]) for j in range(k)]).first()
    right = [
        ("orthonormal", all(abs(products[a, b] - (a == b)) < 1e-6 for a in range(k) for b in range(k))),
        ("falling variances", all(a >= b > 0 for a, b in zip(variances, variances[1:]))),
        ("share of the variance", 0 < sum(variances) <= total * (1 + 1e-9)),
        ("variances are those of the coordinates", all(abs(a - b) < 1e-6 * max(a, 1) for a, b in zip(variances, y)))]
    return i.spark.createDataFrame([(name, bool(ok)) for name, ok in right], "check string, ok boolean")


@query("m7_components")
def _(i: Inputs):
    _, frame, fitted = _fitted(i)
    parts = fitted.components(frame)
    return parts.select("NR_CONVENIO", *[F.col("components")[j].alias(f"component_{j}") for j in range(8)])


@query("m8_classify")
def _(i: Inputs):
    _, frame, fitted = _fitted(i)
    return fitted.predict(fitted.predict(frame, name="PREDITO"), proba=True, name="PROBABILIDADE").select(
        "NR_CONVENIO", "LABEL", "PREDITO", "PROBABILIDADE")


@query("m9_score_rescale", "select l_orderkey, l_linenumber, round(1 / (1 + exp(-2 * (l_discount - 0.5))), 9) score from lineitem")
def _(i: Inputs):
    return i.lineitem.select("l_orderkey", "l_linenumber", F.round(model.rescaled(F.col("l_discount")), 9).alias("score"))


@query("m10_appended_predictions")
def _(i: Inputs):
    _, frame, fitted = _fitted(i)
    parts = fitted.components(fitted.predict(frame, proba=True, scale=True))
    return parts.select("NR_CONVENIO", "components", "INSUCESSO")


@query("m11_validation_metrics")
def _(i: Inputs):
    tables, frame, fitted = _fitted(i)
    return model.validation_metrics(fitted, _finished(tables, frame).where(_UNSEEN()))


_POINTS = """
points as (select l_discount s, count(*) filter (l_returnflag = 'R') pos, count(*) filter (l_returnflag <> 'R') neg from lineitem group by 1),
above as (select *, coalesce(sum(pos) over w, 0) tp, coalesce(sum(neg) over w, 0) fp from points
  window w as (order by s desc rows between unbounded preceding and 1 preceding)),
curve as (select *, (tp + pos) / (tp + fp + pos + neg) now, case when tp + fp > 0 then tp / (tp + fp) else (tp + pos) / (tp + fp + pos + neg) end before from above)"""


@query("m11_areas", f"""
with {_POINTS.strip()} select 'areaUnderROC' metric, round(sum(neg * (tp + pos / 2)) / (sum(pos) * sum(neg)), 9) as value from curve
union all select 'areaUnderPR', round(sum(pos * (now + before) / 2) / sum(pos), 9) from curve""")
def _(i: Inputs):
    scored = i.lineitem.select("l_discount", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return model.areas(scored, "l_discount", "label", slot=4).withColumn("value", F.round("value", 9))


@query("m11_confusion", """
with t as (select count(*) filter (l_discount > 0.05 and l_returnflag = 'R') tp, count(*) filter (l_discount > 0.05 and l_returnflag <> 'R') fp,
  count(*) filter (l_discount <= 0.05 and l_returnflag = 'R') fn, count(*) n from lineitem)
select 'accuracy' metric, round((n - fp - fn) / n, 9) as value from t union all select 'precision', round(tp / (tp + fp), 9) from t
union all select 'recall', round(tp / (tp + fn), 9) from t union all select 'f1', round(2 * tp / (2 * tp + fp + fn), 9) from t""")
def _(i: Inputs):
    scored = i.lineitem.select("l_discount", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return model.confusion(scored, "l_discount", "label", 0.05).withColumn("value", F.round("value", 9))


@query("m11_hyperparameters")
def _(i: Inputs):
    _, _, fitted = _fitted(i)
    return fitted.hyperparameters(i.spark)


@query("m12_training_label", f"""
select NR_CONVENIO, case when upper(SIT_CONVENIO) in ({quoted(s.upper() for s in fixed.FAILED_STATUSES)}) then 1 else 0 end LABEL from v_convenios""")
def _(i: Inputs):
    return i.raw("convenios").select("NR_CONVENIO", features.failure_label(F.col("SIT_CONVENIO")).alias("LABEL"))


@query("t13_risk_scores")
def _(i: Inputs):
    tables, _, fitted = _fitted(i)
    return model.score_live(tables["convenios"], tables, fitted)


@query("t13_scored_grants", f"""
select NR_CONVENIO, case when lower(SIT_CONVENIO) = '{fixed.LIVE_STATUS}' then 'SIM' else 'NAO' end SCORED from m_convenios""")
def _(i: Inputs):
    tables, _, fitted = _fitted(i)
    scores = model.score_live(tables["convenios"], tables, fitted)
    return scores.select("NR_CONVENIO", F.when(F.col("INSUCESSO") > 0, "SIM").otherwise("NAO").alias("SCORED"))


# ------------------------------------------------------------------ sinks


@query("o1_json_export", """
select NR_CONVENIO, epoch_ms(cast(DATA_MOV as timestamp)) DATA_MOV, cast(VALOR_MOV as double) VALOR_MOV, TIPO_MOV, FORNECEDOR_ID from x_leg_d""")
def _(i: Inputs):
    stage = i.staged()
    grants_ = grants.granted_proposals(stage, ["NR_CONVENIO"])
    leg = ledger.deposit_leg(stage["desembolsos"], "D", "DATA_DESEMBOLSO", "VL_DESEMBOLSADO", grants_)
    folder = i.scratch()
    targets.json_sink(folder)("desembolsos", leg)
    return i.spark.read.schema(targets.epoch_dates(leg).schema).json(f"{folder}/desembolsos")


@query("o3_multi_sink", """
select 'failing' sink, 'first' table_name, 'NAO' ok union all select 'json', 'first', 'SIM' union all select 'json', 'second', 'SIM'""")
def _(i: Inputs):
    def failing(table: str, df: DataFrame) -> None:
        df.select(F.raise_error(F.lit("target is down"))).write.format("noop").mode("overwrite").save()

    given = {"first": i.orders, "second": i.customer}
    report = targets.run_sinks(i.spark, {"failing": failing, "json": targets.json_sink(i.scratch())}, given)
    return report.select("sink", "table_name", F.when(F.col("error").isNull(), "SIM").otherwise("NAO").alias("ok"))


@query("o3_restartable_sinks", """
with t as (select 'customer' table_name, count(*) n from customer union all select 'orders', count(*) from orders union all select 'supplier', count(*) from supplier)
select 1 run, 'json' sink, table_name, 'WRITTEN' status, n "rows" from t union all select 1, 'parquet', 'customer', 'WRITTEN', n from t where table_name = 'customer'
union all select 1, 'parquet', 'orders', 'FAILED', null union all select 2, 'json', table_name, 'HELD', n from t
union all select 2, 'parquet', table_name, case when table_name = 'customer' then 'HELD' else 'WRITTEN' end, n from t""")
def _(i: Inputs):
    """Three tables to two sinks, twice; one sink fails at its second table the first time."""
    store, folder, failures = Snapshots(i.spark, i.scratch()), i.scratch(), iter([True])
    for name in ("customer", "orders", "supplier"):
        store.write(i.table(name), "mart", name, dt.date(2001, 1, 1))

    def parquet(table: str, df: DataFrame) -> None:
        if table == "orders" and next(failures, False):
            raise ConnectionError("target is down")
        df.write.mode("overwrite").parquet(f"{folder}/parquet/{table}")

    runs = [targets.export(store, {"json": targets.json_sink(f"{folder}/json"), "parquet": parquet}) for _ in range(2)]
    return union_all([r.select(F.lit(n).alias("run"), "sink", "table_name", "status", "rows") for n, r in enumerate(runs, 1)])


@query("o4_year_partitions", """
select year(DATA_MOV) ANO_MOV, count(*) "rows" from x_leg_d group by 1""")
def _(i: Inputs):
    stage = i.staged()
    grants_ = grants.granted_proposals(stage, ["NR_CONVENIO"])
    leg = ledger.deposit_leg(stage["desembolsos"], "D", "DATA_DESEMBOLSO", "VL_DESEMBOLSADO", grants_)
    folder = i.scratch()
    targets.ledger_sink(folder)("movimento", leg)
    years = i.spark.read.parquet(f"{folder}/movimento").groupBy(F.col("ANO_MOV").cast("long").alias("ANO_MOV"))
    return years.agg(F.count(F.lit(1)).alias("rows"))


@query("o5_target_gate", """
with d as (select (select max(cast(l_shipdate as date)) from lineitem) s, (select max(cast(o_orderdate as date)) from orders) h)
select s SOURCE_DATE, h HELD_DATE, case when h >= s then 'UP_TO_DATE' when h = s then 'UNCHANGED' else 'RUN' end STATUS from d""")
def _(i: Inputs):
    day = i.lineitem.agg(F.max(F.col("l_shipdate").cast("date")).alias("day"))
    held = i.orders.agg(F.max(F.col("o_orderdate").cast("date")).alias("day"))
    return freshness(day, "day", held, "day", F.col("SOURCE_DATE"))


# ------------------------------------------------------------------ contracts


@query("v1_unique_keys", """
select l_orderkey, l_linenumber, count(*) "rows" from lineitem group by 1, 2 having count(*) > 1""")
def _(i: Inputs):
    return contracts.duplicate_keys(i.lineitem, ["l_orderkey", "l_linenumber"])


_NULLABLE = ["NR_MOV_FIN", "NR_CONVENIO", "IDENTIF_FORNECEDOR", "NOME_FORNECEDOR", "DATA_PAG", "VL_PAGO"]


@query("v2_not_null", " union all ".join(
    f"select '{c}' column_name, count(*) - count({c}) nulls from v_pagamentos" for c in _NULLABLE))
def _(i: Inputs):
    return contracts.null_counts(i.raw("pagamentos"), _NULLABLE)


@query("v3_text_lengths", """
select * from (select 'p_name' column_name, max(length(p_name)) max_length, 5 length_limit from part
union all select 'p_brand', max(length(p_brand)), 8 from part union all select 'p_type', max(length(p_type)), 3 from part) where max_length > length_limit""")
def _(i: Inputs):
    return contracts.overlong(i.part, {"p_name": 5, "p_brand": 8, "p_type": 3})


@query("v4_missing_references", """
select ID_PROPOSTA, IDENTIF_PROPONENTE from v_propostas where IDENTIF_PROPONENTE not in (select IDENTIF_PROPONENTE from v_proponentes)""")
def _(i: Inputs):
    rows = i.raw("propostas").select("ID_PROPOSTA", "IDENTIF_PROPONENTE")
    return contracts.missing_references(rows, "IDENTIF_PROPONENTE", i.raw("proponentes"), "IDENTIF_PROPONENTE")


def _contract_sql(table: str) -> str:
    """One row for each rule of a table."""
    contract, source = CONTRACTS[table], "x_snapshot" if table == "data_atual" else f"m_{table}"
    rules = [("not null", c, f"count(*) - count({c})") for c in contract.not_null(table)]
    rules += [("text length", c, f"count(*) filter (length({c}) > {n})") for c, n in contract.max_length]
    structs = ", ".join(f"{{'contract': '{rule}', 'column_name': '{c}', 'violations': {count}}}" for rule, c, count in rules)
    sql = f"select '{table}' table_name, unnest([{structs}], recursive := true) from {source}"
    if contract.key:
        keys = ", ".join(contract.key)
        sql += f" union all select '{table}', 'unique key', '{keys}', count(*) from (select 1 from {source} group by {keys} having count(*) > 1)"
    return sql


_REFERENCE_SQL = " union all ".join(
    f"select '{table}', 'reference to {target}', '{column}', count(*) from m_{table} where {column} is not null and {column} not in (select {key} from m_{target} where {key} is not null)"
    for (table, column), (target, key) in REFERENCES)


def whole_mart(i: Inputs) -> dict[str, DataFrame]:
    """All twelve tables, each written down once; those that the ledger does not need are built beside it."""
    stage = i.staged(in_order=False).begin(*EXTRACTS, "licitacoes", "estados", "municipios")
    base, lines = _base(stage)
    grants_ = base["convenios"]
    beside = {
        "emendas": lambda: grants.emendas(lines), "licitacoes": lambda: procurements.licitacoes(stage, grants_),
        "estados": lambda: geography.estados(stage), "municipios": lambda: geography.municipios(stage),
        "proponentes": lambda: grants.proponentes(stage)}
    others = dict(zip(beside, begun(i.spark, [lambda table=table: cut_lineage(table()) for table in beside.values()])))
    paid = supplier_dimension(i, stage, grants_)
    moved = _ledger(stage, grants_, paid)
    last = i.events.agg(F.max(F.col("ts").cast("date")).alias("d")).first()["d"]
    tables = {name: table.result() for name, table in others.items()}
    return {
        **base, **tables, "fornecedores": paid, "movimento": moved,
        "calendario": cut_lineage(derived.calendario(moved, "DATA_MOV", F.lit(last))),
        "atributos": cut_lineage(derived.atributos(grants_, tables["emendas"], tables["licitacoes"])),
        "data_atual": derived.data_atual(i.spark, last),
    }


@query("v_mart_contracts", " union all ".join([*map(_contract_sql, CONTRACTS), _REFERENCE_SQL]))
def _(i: Inputs):
    return contracts.check_mart(whole_mart(i))
