"""A registry laid over the star-schema tables, in the publisher's columns, and queries that run the engine on it.

``RAW`` says how each source column comes from orders and lineitem, in expressions that Spark and DuckDB read alike.
The engine's staging, rules, analytic table, marts and questions run on it; beside each query stands SQL written
from the definitions.  Doubles that geometry yields are compared as whole cells or kilometres.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import domains as D
from ..operators.relational import melt, shared_folder, top
from ..sources.reference import redundant
from ..sources.tables import SourceError, read_snapshot, replace_snapshot, snapshots, store
from . import curate, rules, staging
from .catalogue import query
from .questions import Questions

_c = F.col
SNAPSHOT = "2026-01-15"
TODAY = date(2026, 1, 15)


def _digit(n: str) -> str:
    return f"substring('{D.OLC_ALPHABET}', cast({n} as int) + 1, 1)"


_M = "(o_custkey % 20)"
_DIGITS = [
    "case when o_orderkey % 50 = 0 then 7 else 3 end", "6", f"{_M} % 18 + 1", f"{_M} % 15 + 1", "8 + o_orderkey % 4", "8 + cast(floor(o_orderkey / 4) as bigint) % 4",
    "o_orderkey % 20", "cast(floor(o_orderkey / 3) as bigint) % 20", "cast(floor(o_orderkey / 7) as bigint) % 20", "cast(floor(o_orderkey / 11) as bigint) % 20"]
_SHORT = " || ".join(map(_digit, _DIGITS[4:8])) + " || '+' || " + " || ".join(map(_digit, _DIGITS[8:]))
_FULL = " || ".join(map(_digit, _DIGITS[:4])) + " || " + _SHORT
_DAY = "cast(cast({} as date) as string)"
_WORK = "cast(l_orderkey - l_orderkey % 3 as string)"

#: table: (source, {header: (name, expression)}); headers that are not listed are null.
RAW: dict[str, tuple[str, dict[str, tuple[str, str]]]] = {
    "obras": ("orders", {
        "CNO": ("cno", "case when o_orderkey = 501 then '  ' else cast(o_orderkey - o_orderkey % 3 as string) end"),
        "Código do Pais": ("codigo_pais", "case when o_orderkey % 53 = 0 then '249' else '105' end"),
        "Data de início": ("data_inicio", "case when o_orderkey % 11 = 0 then '1970-01-01' when o_orderkey % 13 = 0 then 'n/d' when o_orderkey % 101 = 0 then '2099-05-05' when o_orderkey % 31 = 0 then '1985-03-01' else cast(date '2010-01-01' + cast(o_orderkey * 7 % 5200 as int) as string) end"),
        "Data de registro": ("data_registro", "case when o_orderkey % 17 = 0 then '' else cast(date '2015-06-01' + cast(o_orderkey % 3 * 1100 + o_orderkey % 900 as int) as string) end"),
        "NI do responsável": ("ni_responsavel", "case when o_orderkey % 4 = 0 then '12345678000199' else ' ' end"),
        "Qualificação do responsavel": ("qualificacao_codigo", "case o_orderkey % 5 when 0 then '0053' when 1 then '0057' when 2 then '0070' when 3 then '9999' else '' end"),
        "Nome": ("nome_obra", "'OBRA ' || cast(o_custkey as string)"),
        "Código do municipio": ("codigo_municipio", f"cast(1000 + {_M} as string)"),
        "Nome do município": ("nome_municipio", f"'VILA D''ÁGUA ' || cast({_M} as string)"),
        "Estado": ("estado", f"case {_M} % 4 when 0 then 'SC' when 1 then 'SÃO PAULO' when 2 then ' pr ' else 'EX' end"),
        "Unidade de medida": ("unidade_medida", "case when o_orderkey % 10 = 0 then 'km' else 'm2' end"),
        "Área total": ("area_total", "case when o_orderkey % 23 = 0 then '2500000.00' when o_orderkey % 19 = 0 then '' when o_orderkey % 29 = 0 then '-5' else cast(o_orderkey * 37 % 6000 as string) || '.25' end"),
        "Situação": ("situacao_codigo", "case o_orderkey % 7 when 0 then '01' when 1 then '02' when 2 then '03' when 3 then '14' when 4 then '15' when 5 then '02' else '99' end"),
        "Data da situação": ("data_situacao", "cast(date '2012-01-01' + cast(o_orderkey * 11 % 5000 as int) as string)"),
        "Código de localização": ("codigo_localizacao", f"case when o_orderkey % 50 = 0 or o_orderkey % 4 < 2 then {_FULL} when o_orderkey % 4 = 2 then {_SHORT} when o_orderkey % 8 = 3 then 'URBANO' else 'RUA 5+1' end"),
    }),
    "areas": ("lineitem", {
        "CNO": ("cno", f"case when l_linenumber = 6 and l_orderkey % 10 = 0 then 'X' || cast(l_orderkey as string) else {_WORK} end"),
        "Categoria": ("categoria", "case l_returnflag when 'R' then 'Obra Nova' when 'A' then 'Reforma' else '' end"),
        "Destinação": ("destinacao", "case l_partkey % 4 when 0 then 'Residencial' when 1 then 'Comercial' when 2 then 'Galpão' else '' end"),
        "Tipo de obra": ("tipo_obra", "case when l_suppkey % 2 = 0 then 'Alvenaria' else 'Madeira' end"),
        "Tipo de Área": ("tipo_area", "case when l_linestatus = 'O' then 'Principal' else 'Complementar' end"),
        "Metragem": ("metragem", "case when l_linenumber = 7 then '' when l_partkey % 37 = 0 and l_linenumber = 1 then '3000000' else cast(l_partkey % 50 as string) end"),
    }),
    "cnaes": ("lineitem", {
        "CNO": ("cno", f"case when l_linenumber = 2 and l_orderkey % 20 = 0 then 'Z' || cast(l_orderkey as string) else {_WORK} end"),
        "CNAE": ("cnae", "case l_partkey % 5 when 0 then '4120400' when 1 then '4399103' when 2 then '0111301' when 3 then '6810202' else '' end"),
        "Data de registro": ("data_registro", "case when l_linenumber = 5 then '' else " + _DAY.format("l_shipdate") + " end"),
    }),
    "vinculos": ("lineitem", {
        "CNO": ("cno", f"case when l_linenumber = 3 and l_orderkey % 25 = 0 then 'Y' || cast(l_orderkey as string) else {_WORK} end"),
        "Data de início": ("data_inicio", _DAY.format("l_shipdate")),
        "Data de fim": ("data_fim", "case when l_linenumber % 2 = 0 then cast(cast(l_shipdate as date) + cast(l_partkey % 40 - 10 as int) as string) else '' end"),
        "Qualificação do contribuinte": ("qualificacao_codigo", "case when l_suppkey % 3 = 0 then '0057' else '' end"),
    }),
}

_T = "nullif(trim({0}), '')"
_DATE = "case when trim({0}) in ('1900-01-01', '1970-01-01', '0001-01-01') then null else try_cast({0} as date) end as {0}"
_LABELS = " ".join(f"when '{k}' then '{v}'" for k, v in D.STATUSES.items())
_QUALIFIED = " ".join(f"when '{k}' then '{v}'" for k, v in D.QUALIFICATIONS.items())


def _raw_sql(table: str) -> str:
    source, columns = RAW[table]
    more = ", o_orderkey as k, o_custkey % 20 as m" if table == "obras" else ""
    return f"select {', '.join(f'{e} as {n}' for n, e in columns.values())}{more} from {source}"


_LAT = f"({' + '.join(f'({d}) * {20 ** (4 - i)}' for i, d in enumerate(_DIGITS[::2]))})"
_LON = f"({' + '.join(f'({d}) * {20 ** (4 - i)}' for i, d in enumerate(_DIGITS[1::2]))})"

STAGED = f"""with raw_obras as ({_raw_sql('obras')}), raw_areas as ({_raw_sql('areas')}), raw_cnaes as ({_raw_sql('cnaes')}), raw_vinculos as ({_raw_sql('vinculos')}),
cell as (select o_orderkey as k, {_LAT} as y, {_LON} as x, o_orderkey % 50 = 0 or o_orderkey % 4 < 2 as whole, o_orderkey % 50 <> 0 and o_orderkey % 4 = 2 as short from orders),
obras0 as (
  select k, m, {_T.format('cno')} as cno, codigo_pais, {_DATE.format('data_inicio')}, {_DATE.format('data_registro')}, {_DATE.format('data_situacao')}, {_T.format('ni_responsavel')} as ni_responsavel,
    {_T.format('qualificacao_codigo')} as qualificacao_codigo, nome_obra, codigo_municipio, nome_municipio, unidade_medida, try_cast({_T.format('area_total')} as decimal(18,2)) as area_total,
    situacao_codigo, codigo_localizacao, case upper(trim(estado)) when 'SC' then 'SC' when 'SÃO PAULO' then 'SP' when 'PR' then 'PR' end as uf from raw_obras),
obras as (
  select * exclude (r), case when ni_responsavel is null then 'PF' else 'PJ' end as responsavel_tipo, case situacao_codigo {_LABELS} end as situacao,
    case qualificacao_codigo {_QUALIFIED} end as qualificacao, situacao_codigo = '02' as obra_ativa, codigo_pais <> '105' as no_exterior, uf is null as uf_indefinida,
    codigo_localizacao like '%+%' as tem_plus_code, coalesce(unidade_medida = 'm2' and area_total > 1000000, false) as area_suspeita, coalesce(data_inicio > data_situacao, false) as datas_incoerentes
  from (select *, row_number() over (partition by cno order by data_registro desc nulls last) as r from obras0) where r = 1),
areas as (select distinct cno, {_T.format('categoria')} as categoria, {_T.format('destinacao')} as destinacao, tipo_obra, tipo_area, try_cast({_T.format('metragem')} as decimal(18,2)) as metragem, tipo_area = 'Principal' as area_principal from raw_areas),
cnaes as (select distinct cno, {_T.format('cnae')} as cnae, try_cast({_T.format('data_registro')} as date) as data_registro from raw_cnaes),
vinculos as (select distinct cno, data_inicio::date as data_inicio, try_cast({_T.format('data_fim')} as date) as data_fim, {_T.format('qualificacao_codigo')} as qualificacao_codigo,
    case {_T.format('qualificacao_codigo')} {_QUALIFIED} end as qualificacao, {_T.format('data_fim')} is null as vinculo_vigente from raw_vinculos)
"""

_HAV = "2 * 6371 * asin(sqrt(least(1.0, pow(sin(radians({2} - {0}) / 2), 2) + cos(radians({0})) * cos(radians({2})) * pow(sin(radians({3} - {1}) / 2), 2))))"
_SECTIONS = " ".join(f"when try_cast(substr(cnae_principal, 1, 2) as int) between {a} and {b} then '{letter}'" for a, b, letter, _ in D.CNAE_SECTIONS)
_SECTION_NAMES = " ".join(f"when try_cast(substr(cnae_principal, 1, 2) as int) between {a} and {b} then '{name}'" for a, b, _, name in D.CNAE_SECTIONS)
_DIVISIONS = " ".join(f"when '{k}' then '{v}'" for k, v in D.CNAE_DIVISIONS.items())
_BANDS = " ".join(f"when area_m2 < {top} then '{name}'" if top else f"when area_m2 is not null then '{name}'" for _, top, name in D.AREA_BANDS)

CURATED = STAGED + f""", agg_areas as (
  select cno, count(*) as n_areas, sum(metragem) filter (where area_principal) as area_principal_m2, sum(metragem) filter (where not area_principal) as area_complementar_m2,
    arg_max(categoria, (coalesce(metragem, 0), categoria)) filter (where area_principal and categoria is not null) as categoria_obra,
    arg_max(destinacao, (coalesce(metragem, 0), destinacao)) filter (where area_principal and destinacao is not null) as destinacao_obra,
    arg_max(tipo_obra, (coalesce(metragem, 0), tipo_obra)) filter (where area_principal) as tipo_obra from areas group by cno),
agg_cnaes as (select cno, count(*) as n_cnaes, first(cnae order by data_registro nulls last, cnae) filter (where cnae is not null) as cnae_principal from cnaes group by cno),
agg_vinculos as (select cno, count(*) as n_vinculos from vinculos group by cno),
geo0 as (select o.*, case when whole then y / 8000::double - 90 + 0.5 / 8000::double end as flat, case when whole then x / 8000::double - 180 + 0.5 / 8000::double end as flon,
    y / 8000::double - 90 + 0.5 / 8000::double as plat, x / 8000::double - 180 + 0.5 / 8000::double as plon, whole, short from obras o join cell using (k)),
anchor as (select codigo_municipio, median(flat) as alat, median(flon) as alon, count(*) as municipio_pontos_ancora from geo0 where flat is not null and codigo_municipio is not null group by 1),
geo as (select *, case when whole or short and alat is not null then plat end as latitude, case when whole or short and alat is not null then plon end as longitude,
    case when whole then 'completo' when short and alat is not null then 'curto_recuperado' end as geo_origem from geo0 left join anchor using (codigo_municipio)),
base as (select geo.*, {_HAV.format('latitude', 'longitude', 'alat', 'alon')} as geo_distancia_municipio_km, year(data_inicio) as ano_inicio, area_total as area_declarada,
    case when unidade_medida = 'm2' and not area_suspeita then area_total end as area_m2, coalesce(n_areas, 0) as n_areas, coalesce(n_cnaes, 0) as n_cnaes, coalesce(n_vinculos, 0) as n_vinculos,
    area_principal_m2, area_complementar_m2, categoria_obra, destinacao_obra, tipo_obra, cnae_principal
  from geo left join agg_areas using (cno) left join agg_cnaes using (cno) left join agg_vinculos using (cno)),
analitico as (select *, case {_SECTIONS} end as cnae_secao, case {_SECTION_NAMES} end as cnae_secao_nome, substr(cnae_principal, 1, 2) as cnae_divisao,
    case substr(cnae_principal, 1, 2) {_DIVISIONS} end as cnae_divisao_nome, case {_BANDS} end as faixa_area, ano_inicio >= 2019 as serie_comparavel, latitude is not null as geocodificada,
    coalesce(geo_distancia_municipio_km <= 150, false) as geo_plausivel, coalesce(area_principal_m2 > 1000000, false) as area_areas_suspeita from base)
"""

_MEASURES = """count(*) as n_obras, count(*) filter (where situacao_codigo = '02') as n_ativas, count(*) filter (where situacao_codigo = '15') as n_encerradas,
  count(*) filter (where situacao_codigo = '14') as n_paralisadas, count(*) filter (where situacao_codigo = '03') as n_suspensas, count(*) filter (where situacao_codigo = '01') as n_nulas,
  count(*) filter (where responsavel_tipo = 'PJ') as n_pj, count(area_m2) as n_com_area_m2, sum(area_m2) as area_m2_total, median(area_m2::double) as area_m2_mediana,
  count(*) filter (where geo_plausivel) as n_geocodificadas"""
MARTS = CURATED + f""", municipio_ano as (select uf, codigo_municipio, nome_municipio, ano_inicio, {_MEASURES}, median(latitude) filter (where geo_plausivel) as lat_mediana, median(longitude) filter (where geo_plausivel) as lon_mediana from analitico group by 1, 2, 3, 4),
setor_ano as (select uf, cnae_principal, cnae_divisao, ano_inicio, {_MEASURES}, max(cnae_divisao_nome) as cnae_divisao_nome from analitico group by 1, 2, 3, 4),
destinacao_ano as (select uf, destinacao_obra, categoria_obra, faixa_area, ano_inicio, {_MEASURES} from analitico group by 1, 2, 3, 4, 5)
"""

_PLACE = f"""select case n_nationkey % 4 when 0 then 'SC' when 1 then 'SP' when 2 then 'PR' else 'RS' end as uf, cast(4200000 + n_nationkey as string) as codigo_ibge,
  'Vila d`Água-' || cast(n_nationkey as string) as nome, 'i' || cast(n_nationkey % 2 as string) as regiao_imediata, 'r' || cast(n_nationkey % 3 as string) as regiao_intermediaria,
  cast((n_nationkey + 1) * 1000 as bigint) as populacao, cast(0 as double) as latitude, cast(0 as double) as longitude, n_nationkey from {{}} where n_nationkey < 20 and n_nationkey not in (9, 10)"""
PLACED = MARTS + f""", places as ({_PLACE.format('nation')}),
placed as (select t.uf, t.nome_municipio, p.* exclude (uf), t.m = '9' as fixed from (select distinct uf, nome_municipio, split_part(nome_municipio, ' ', 3) as m from municipio_ano) t
  left join places p on (t.uf = p.uf and t.m = p.n_nationkey::varchar) or (t.uf = 'SP' and t.m = '9' and p.n_nationkey = 5))
"""


def raw(t, table: str) -> DataFrame:
    """A source table.  Its rows are counted, as the publisher's are; the counter also parts these expressions from those that
    read them: compiled as one method they have over 8,000 bytes, which the JVM only interprets."""
    source, columns = RAW[table]
    rows = t(source).selectExpr(*[f"{columns[h][1] if h in columns else 'cast(null as string)'} as `{h}`" for h in staging.TABLES[table].headers])
    return rows.observe(Observation(), F.count(F.lit(1)).alias("lidas"))


def staged(t) -> dict[str, DataFrame]:
    return {n: staging.stage(n, raw(t, n), SNAPSHOT) for n in staging.TABLES}


def analytic(t) -> DataFrame:
    return curate.analytic(kept(t))


def reference(t) -> tuple[DataFrame, DataFrame]:
    nation: DataFrame = t("nation")
    places = nation.sparkSession.sql(_PLACE.format("{n}"), n=nation).drop("n_nationkey")
    fixes = nation.filter("n_nationkey = 9").selectExpr("'SP' as uf", "'VILA D''ÁGUA 9' as nome_cno", "'4200005' as codigo_ibge")
    return places, fixes


def _scratch(spark: SparkSession) -> str:
    """A folder of its own in the shared one that the session names; a temporary one on a local master that names none."""
    named = shared_folder(spark)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise SourceError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="lodestone-")
    return f"{named.rstrip('/')}/sample-{uuid.uuid4().hex}"


_folders: dict[tuple[str, ...], str] = {}


def _states(t) -> list[str]:
    """Names, lengths and times of the files, or of the folders of many, that the sample is laid over: new data under old names
    is another input."""
    out = []
    for table in ("orders", "lineitem", "nation"):
        names = t(table).inputFiles()
        for name in names if len(names) <= 16 else {n.rsplit("/", 1)[0] for n in names}:
            fs, path = store(t(table).sparkSession, name)
            out.append(f"{name} {len(names)} {fs.getContentSummary(path).getLength()} {fs.getFileStatus(path).getModificationTime()}")
    return out


def _once(t, kind: str, write: Callable[[SparkSession, str], None]) -> tuple[SparkSession, str]:
    """The folder that ``write`` fills, filled once a session and input; again if the shared folder was cleared."""
    source: DataFrame = t("orders")
    spark = source.sparkSession
    key = (kind, spark.sparkContext.applicationId, *sorted(_states(t)))
    folder = _folders.get(key)
    if folder is None or not snapshots(spark, f"{folder}/whole"):
        folder = _scratch(spark)
        write(spark, folder)
        replace_snapshot(spark.range(1), f"{folder}/whole", SNAPSHOT)
        _folders[key] = folder
    return spark, folder


def kept(t) -> dict[str, DataFrame]:
    """The staged tables, written and read as curation reads them."""
    def write(spark: SparkSession, folder: str) -> None:
        for name, table in staged(t).items():
            replace_snapshot(table, f"{folder}/{name}", SNAPSHOT, staging.TABLES[name].partitions)

    spark, folder = _once(t, "staged", write)
    return {n: read_snapshot(spark, f"{folder}/{n}", SNAPSHOT) for n in staging.TABLES}


def published(t) -> tuple[SparkSession, str]:
    """The curated tables of the sample registry, written as curation writes them."""
    def write(spark: SparkSession, folder: str) -> None:
        replace_snapshot(analytic(t), f"{folder}/obras_analitico", SNAPSHOT, ("uf",))
        works = read_snapshot(spark, f"{folder}/obras_analitico", SNAPSHOT)
        for name in curate.MARTS:
            replace_snapshot(curate.mart(name, works), f"{folder}/{name}", SNAPSHOT)

    return _once(t, "curated", write)


def works(t) -> DataFrame:
    """The published analytic table, from which marts and coverage are made."""
    spark, folder = published(t)
    return read_snapshot(spark, f"{folder}/obras_analitico", SNAPSHOT)


def questions(t, referenced: bool = True) -> Questions:
    """The questions on the published tables, opened as any user of the engine opens them: reference tables from their CSV files."""
    spark, folder = published(t)
    if not referenced:
        return Questions.open(spark, folder)
    _, files = _once(t, "reference", lambda spark, folder: _write_reference(t, folder))
    return Questions.open_with(spark, folder, f"{files}/places", f"{files}/corrections")


def _write_reference(t, folder: str) -> None:
    """The reference tables as users keep them: CSV with a header, populations by year."""
    places, fixes = reference(t)
    places = places.withColumns({"populacao_2024": _c("populacao") - 1, "populacao_2026": _c("populacao")}).drop("populacao")
    places.write.csv(f"{folder}/places", header=True)
    fixes.withColumns({"nome_ibge": F.lit(""), "motivo": F.lit("nome curto, de uso")}).write.csv(f"{folder}/corrections", header=True)


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles: one kind of number to compare."""
    return df.select(*[_c(f"`{n}`").cast("double").alias(n) if kind.startswith("decimal") else _c(f"`{n}`") for n, kind in df.dtypes])


def register(name: str, sql: str, f) -> None:
    f.__name__ = name
    query(sql)(f)


# staging
_STAGED_COLUMNS = {
    "obras": "cno codigo_pais data_inicio data_registro data_situacao ni_responsavel qualificacao_codigo nome_obra codigo_municipio nome_municipio unidade_medida area_total situacao_codigo codigo_localizacao uf "
             "responsavel_tipo situacao qualificacao obra_ativa no_exterior uf_indefinida tem_plus_code area_suspeita datas_incoerentes",
    "areas": "cno categoria destinacao tipo_obra tipo_area metragem area_principal",
    "cnaes": "cno cnae data_registro",
    "vinculos": "cno data_inicio data_fim qualificacao_codigo qualificacao vinculo_vigente",
}
for _n, _cols in _STAGED_COLUMNS.items():
    _out = ", ".join(f"{x}::double as {x}" if x in ("area_total", "metragem") else x for x in _cols.split())
    register(f"stage_{_n}", STAGED + f"select {_out} from {_n}", lambda t, n=_n, cols=_cols: doubles(staged(t)[n].select(*cols.split())))

# rules: on tables with planted faults, so that each has something to find
_FAULTY = STAGED + """, f_obras as (
  select cno, uf, situacao_codigo, case when k % 41 = 0 then null else situacao end as situacao, qualificacao_codigo, case when k % 37 = 0 then null else obra_ativa end as obra_ativa, no_exterior, uf_indefinida,
    tem_plus_code, area_suspeita, datas_incoerentes, ni_responsavel, case when k % 43 = 0 then 'PJ' else responsavel_tipo end as responsavel_tipo, case when k % 47 = 0 then date '1970-01-01' else data_inicio end as data_inicio,
    data_situacao, area_total, case when k % 59 = 0 then 'ZZ' else uf end as uf2 from obras
  union all by name select cno, situacao_codigo, situacao, qualificacao_codigo, obra_ativa, no_exterior, uf_indefinida, tem_plus_code, area_suspeita, datas_incoerentes, ni_responsavel, responsavel_tipo, data_inicio, data_situacao, area_total, uf as uf2 from obras where k % 61 = 0)
"""


def _with_faults(t) -> dict[str, DataFrame]:
    tables = kept(t)
    found = tables["obras"].join(t("orders").selectExpr("o_orderkey as k", "cast(o_orderkey - o_orderkey % 3 as string) as cno", RAW["obras"][1]["Data de registro"][1] + " as day").selectExpr(
        "k", "cno as __c", "try_cast(nullif(day, '') as date) as __d"), (F.coalesce("cno", F.lit("501")) == _c("__c")) & _c("data_registro").eqNullSafe(_c("__d")) & (_c("cno").isNull() == (_c("k") == 501)), "left")
    found = found.withColumn("n", F.explode(F.when(_c("k") % 61 == 0, F.array(_c("k"), F.lit(None).cast("long"))).otherwise(F.array(_c("k")))))  # null: a second row, as it was
    bad = found.withColumns({
        "situacao": F.when(_c("n") % 41 == 0, None).otherwise(_c("situacao")), "obra_ativa": F.when(_c("n") % 37 == 0, None).otherwise(_c("obra_ativa")),
        "responsavel_tipo": F.when(_c("n") % 43 == 0, "PJ").otherwise(_c("responsavel_tipo")), "data_inicio": F.when(_c("n") % 47 == 0, F.lit(date(1970, 1, 1))).otherwise(_c("data_inicio")),
        "uf": F.when(_c("n") % 59 == 0, "ZZ").otherwise(_c("uf"))})
    return tables | {"obras": bad.drop("n")}


def faulty(t) -> dict[str, DataFrame]:
    """The staged tables, works with faults, written and read as validation reads them; the others are read as they were staged."""
    spark, folder = _once(t, "faulty", lambda spark, folder: replace_snapshot(_with_faults(t)["obras"], f"{folder}/obras", SNAPSHOT))
    return kept(t) | {"obras": read_snapshot(spark, f"{folder}/obras", SNAPSHOT)}


_CODES = ", ".join(f"'{x}'" for x in D.STATUSES)
_RULES = {
    "cno_unico": "select cno, count(*) as n from f_obras group by cno having count(*) > 1",
    "cno_preenchido": "select cno from f_obras where cno is null",
    "areas_orfas": "select cno from areas where not exists (select 1 from f_obras o where o.cno = areas.cno)",
    "cnaes_orfaos": "select cno from cnaes where not exists (select 1 from f_obras o where o.cno = cnaes.cno)",
    "vinculos_orfaos": "select cno from vinculos where not exists (select 1 from f_obras o where o.cno = vinculos.cno)",
    "situacao_no_dominio": f"select cno from f_obras where situacao_codigo not in ({_CODES})",
    "situacao_traduzida": "select cno from f_obras where situacao_codigo is not null and situacao is null",
    "uf_valida": "select cno from f_obras where uf2 not in ({})".format(", ".join(f"'{x}'" for x in D.STATES)),
    "qualificacao_no_dominio": "select cno from f_obras where qualificacao_codigo not in ({})".format(", ".join(f"'{x}'" for x in D.QUALIFICATIONS)),
    "flags_nunca_nulas": "select cno from f_obras where obra_ativa is null or no_exterior is null or uf_indefinida is null or tem_plus_code is null or area_suspeita is null or datas_incoerentes is null",
    "responsavel_tipo_coerente": "select cno from f_obras where (ni_responsavel is null) <> (responsavel_tipo = 'PF')",
    "sem_datas_sentinela": "select cno from f_obras where data_inicio in (date '1970-01-01', date '1900-01-01') or data_situacao in (date '1970-01-01', date '1900-01-01')",
    "area_nao_negativa": "select cno from f_obras where area_total < 0",
    "datas_coerentes": "select cno from f_obras where datas_incoerentes",
    "area_plausivel": "select cno from f_obras where area_suspeita",
    "uf_identificada": "select cno from f_obras where uf_indefinida and not no_exterior",
    "data_inicio_nao_futura": f"select cno from f_obras where data_inicio > date '{TODAY}'",
    "metragem_preenchida": "select cno from areas where metragem is null",
    "periodo_coerente": "select cno from vinculos where data_fim < data_inicio",
}


def _violations(t, i: int) -> DataFrame:
    found = rules.rules(TODAY)[i].violations(faulty(t))
    return found.select("cno", _c("count").alias("n")) if "count" in found.columns else found.select("cno")


for _i, (_n, _s) in enumerate(_RULES.items()):
    register(f"regra_{_n}", _FAULTY + _s, lambda t, i=_i: _violations(t, i))


@query(_FAULTY + "select * from (" + " union all ".join(f"select '{n}' as regra, (select count(*) from ({s})) as violacoes" for n, s in _RULES.items()) + ")")
def regras_avaliadas(t):
    """Every rule through the evaluation that reports use."""
    tables = faulty(t)
    rows = [(n, o.violations) for n, o in zip(_RULES, rules.evaluate_all(rules.rules(TODAY), tables), strict=True)]
    return tables["obras"].sparkSession.createDataFrame(rows, "regra string, violacoes long")


@query(STAGED + """select 'obras' as tabela, (select count(*) from raw_obras) as lidas, (select count(*) from raw_obras) as publicadas, true as confere
  union all select 'areas', (select count(*) from raw_areas), (select count(*) + 1 from raw_areas), false
  union all select 'cnaes', (select count(*) from raw_cnaes), (select count(*) from raw_cnaes), true union all select 'vinculos', (select count(*) from raw_vinculos), null, true""")
def reconciliacao(t):
    """Rows read against published totals: one agrees, one is off by one, one is not published."""
    read = {n: raw(t, n).count() for n in staging.TABLES}
    published = {D.CONTROL_TOTALS["obras"]: t("orders").count(), D.CONTROL_TOTALS["areas"]: t("lineitem").count() + 1, D.CONTROL_TOTALS["cnaes"]: t("lineitem").count()}
    rows = [(r["tabela"], r["lidas"], r["publicadas"], r["confere"]) for r in rules.reconcile(read, published)]
    return t("orders").sparkSession.createDataFrame(rows, "tabela string, lidas long, publicadas long, confere boolean")


# the analytic table and the marts
_ANALYTIC = (
    "cno uf codigo_municipio nome_municipio data_inicio data_registro data_situacao ano_inicio situacao_codigo situacao obra_ativa responsavel_tipo no_exterior uf_indefinida datas_incoerentes unidade_medida "
    "area_suspeita n_areas categoria_obra destinacao_obra tipo_obra n_cnaes cnae_principal n_vinculos geo_origem municipio_pontos_ancora cnae_secao cnae_secao_nome cnae_divisao cnae_divisao_nome faixa_area "
    "serie_comparavel geocodificada geo_plausivel area_areas_suspeita").split()
_NUMBERS = "area_declarada area_m2 area_principal_m2 area_complementar_m2".split()


@query(CURATED + f"""select {', '.join(_ANALYTIC)}, {', '.join(f'{x}::double as {x}' for x in _NUMBERS)}, floor((latitude + 90) * 8000)::bigint as lat, floor((longitude + 180) * 8000)::bigint as lon,
  floor(geo_distancia_municipio_km * 10)::bigint as hectometros from analitico""")
def obras_analitico(t):
    return doubles(analytic(t).select(
        *_ANALYTIC, *_NUMBERS, F.floor((_c("latitude") + 90) * 8000).alias("lat"), F.floor((_c("longitude") + 180) * 8000).alias("lon"), F.floor(_c("geo_distancia_municipio_km") * 10).alias("hectometros")))


_M_OUT = "n_obras, n_ativas, n_encerradas, n_paralisadas, n_suspensas, n_nulas, n_pj, n_com_area_m2, area_m2_total::double as area_m2_total, area_m2_mediana, n_geocodificadas"


@query(MARTS + f"select uf, codigo_municipio, nome_municipio, ano_inicio, {_M_OUT}, round((lat_mediana + 90) * 16000)::bigint as lat, round((lon_mediana + 180) * 16000)::bigint as lon from municipio_ano")
def mart_municipio_ano(t):
    return doubles(curate.mart("mart_municipio_ano", works(t)).withColumns({"lat": F.round((_c("lat_mediana") + 90) * 16000).cast("long"), "lon": F.round((_c("lon_mediana") + 180) * 16000).cast("long")}).drop("snapshot_date", "lat_mediana", "lon_mediana"))


@query(MARTS + f"select uf, cnae_principal, cnae_divisao, ano_inicio, {_M_OUT}, cnae_divisao_nome from setor_ano")
def mart_setor_ano(t):
    return doubles(curate.mart("mart_setor_ano", works(t)).drop("snapshot_date"))


@query(MARTS + f"select uf, destinacao_obra, categoria_obra, faixa_area, ano_inicio, {_M_OUT} from destinacao_ano")
def mart_destinacao_ano(t):
    return doubles(curate.mart("mart_destinacao_ano", works(t)).drop("snapshot_date"))


@query(CURATED + """select count(*) as obras, count(*) filter (where whole) as completos, count(*) filter (where short) as curtos, count(*) filter (where geo_origem = 'completo') as decodificados,
  count(*) filter (where geo_origem = 'curto_recuperado') as recuperados, count(latitude) as geocodificadas, count(*) filter (where geo_plausivel) as plausiveis from analitico""")
def cobertura_geo(t):
    got = curate.coverage(works(t))
    names = "obras completos curtos decodificados recuperados geocodificadas plausiveis".split()
    return t("orders").sparkSession.createDataFrame([tuple(got[n] for n in names)], ", ".join(f"{n} long" for n in names))


# sinks, scans and small operators
@query(STAGED + f"""select '{SNAPSHOT}' as snapshot, count(*) as linhas, count(cnae) as com_cnae from cnaes union all select '2026-02-15', count(*), count(cnae) from cnaes where cnae is not null
  union all select 'ultimo', count(*), count(cnae) from cnaes where cnae is not null""")
def snapshot_replace(t):
    """A snapshot written, written again, and a second one beside it; each read back on its own, and the newest."""
    rows = staged(t)["cnaes"]
    spark, folder = rows.sparkSession, _scratch(rows.sparkSession)
    replace_snapshot(rows.limit(3), folder, SNAPSHOT)
    replace_snapshot(rows, folder, SNAPSHOT)
    replace_snapshot(rows.filter("cnae is not null"), folder, "2026-02-15")
    counted = [read_snapshot(spark, folder, s).agg(F.count("*").alias("linhas"), F.count("cnae").alias("com_cnae")).select(F.lit(s or "ultimo").alias("snapshot"), "linhas", "com_cnae") for s in (SNAPSHOT, "2026-02-15", None)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(CURATED + "select cno, uf, n_areas from analitico where uf = 'SC'")
def snapshot_pruned_scan(t):
    """The analytic table written by state; one state's folder is read back."""
    works = analytic(t).select("cno", "uf", "n_areas")
    folder = _scratch(works.sparkSession)
    replace_snapshot(works, folder, SNAPSHOT, ("uf",))
    return read_snapshot(works.sparkSession, folder).filter("uf = 'SC'").select("cno", "uf", "n_areas")


@query("""select p_partkey, 'p_size' as medida, p_size::bigint as valor from part union all select p_partkey, 'dobro', 2 * p_size::bigint from part""")
def melt_rows(t):
    wide = t("part").select("p_partkey", _c("p_size").cast("long").alias("p_size"), (2 * _c("p_size").cast("long")).alias("dobro"))
    return melt(wide, ["p_partkey"], ["p_size", "dobro"], "medida", "valor")


@query("select p_brand, count(*) as n from part group by 1 order by n desc, p_brand limit 5")
def top_of_result(t):
    return top(t("part").groupBy("p_brand").agg(F.count("*").alias("n")), 5, "n")


@query(f"with places as ({_PLACE.format('nation')}) select uf, 'VILA D''ÁGUA ' || n_nationkey as nome_cno, nome from places where n_nationkey in (4, 5)")
def correcoes_redundantes(t):
    """Of three corrections, the two whose names match a municipality anyway."""
    places, fixes = reference(t)
    more = t("nation").filter("n_nationkey in (4, 5)").selectExpr("case n_nationkey when 4 then 'SC' else 'SP' end as uf", "'VILA D''ÁGUA ' || cast(n_nationkey as string) as nome_cno", "'4200000' as codigo_ibge")
    return redundant(fixes.unionByName(more), places)
