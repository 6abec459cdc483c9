"""Every question of the catalogue as a query on the sample registry, with SQL written from its definition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalogue import query
from .questions import Questions
from .sample import CURATED, MARTS, PLACED, doubles, questions, register

_c = F.col
_KM2 = "sum({})::double / 1e6 as area_km2"


def _unpivot(inner: str, name: str, value: str, kind: str = "bigint") -> str:
    return f"select {name}, {value}::{kind} as {value} from (unpivot ({inner}) on columns(*) into name {name} value {value})"


def _ask(name: str, sql: str, answer: Callable[[Questions], DataFrame], referenced: bool = True) -> None:
    register(name, sql, lambda t: doubles(answer(questions(t, referenced))))


def _placed(df: DataFrame) -> DataFrame:
    """``df``, whose rows come in an order, with their places in it as ``lugar``."""
    return df.withColumn("__i", F.monotonically_increasing_id()).selectExpr(*[f"`{c}`" for c in df.columns], "cast(row_number() over (order by __i) as bigint) as lugar")


def _one(t, value, column: str, kind: str) -> DataFrame:
    return t("orders").sparkSession.createDataFrame([(value,)], f"{column} {kind}")


_ask("q_totais_do_cabecalho", MARTS + "select sum(n_obras)::bigint as obras, count(distinct codigo_municipio) as municipios from municipio_ano where uf = 'SC'", lambda q: q.totais_do_cabecalho("SC"))
_ask("q_volumetria", MARTS + _unpivot(
    """select count(*) as "obras (uma linha por obra)", count(distinct codigo_municipio) as "municípios distintos", count(distinct uf) as "UFs", sum(n_areas)::bigint as "áreas declaradas (1:N)",
    sum(n_cnaes)::bigint as "CNAEs declarados (1:N)", sum(n_vinculos)::bigint as "vínculos (1:N)" from analitico""", "o_que", "quantas"), lambda q: q.volumetria())
_ask("q_perfil_unidades", MARTS + """select unidade_medida as unidade, count(*) as obras, round(sum(area_declarada)::double / 1e6, 1) as soma_milhoes, round(100.0::double * count(*) / sum(count(*)) over (), 2) as pct_obras
  from analitico group by 1""", lambda q: q.perfil_unidades())
_ask("q_decomposicao_area", MARTS + _unpivot(
    """select round(sum(area_declarada)::double / 1e6, 1) as "SUM(area_total) cru", round(sum(area_declarada) filter (where not area_suspeita)::double / 1e6, 1) as "sem as áreas implausíveis",
    round(sum(area_declarada) filter (where unidade_medida = 'm2')::double / 1e6, 1) as "só o que está em m²", round(sum(area_m2)::double / 1e6, 1) as "m² e sem implausíveis (area_m2)" from analitico""",
    "criterio", "km2", "double"), lambda q: q.decomposicao_area())
_ask("q_areas_implausiveis", MARTS + """select cno, uf, nome_municipio as municipio, unidade_medida as unidade, area_declarada::double as area_declarada, destinacao_obra as destinacao from analitico
  where area_suspeita order by analitico.area_declarada desc nulls last, cno limit 10""", lambda q: q.areas_implausiveis())
_ask("q_quantis_area", MARTS + """select count(a) as obras_com_area, round(avg(a), 1) as media, quantile_cont(a, 0.25) as p25, median(a) as mediana, quantile_cont(a, 0.75) as p75, quantile_cont(a, 0.95) as p95,
  quantile_cont(a, 0.99) as p99 from (select area_m2::double as a from analitico where uf = 'SP')""", lambda q: q.quantis_area("SP"))
_ask("q_histograma_area", MARTS + "select least(floor(area_m2::double / 20) * 20, 1000)::double as faixa_inicio, count(*) as obras from analitico where area_m2 > 0 group by 1", lambda q: q.histograma_area())
_ask("q_faixas_area", MARTS + f"""select faixa_area, sum(n_obras)::bigint as obras, {_KM2.format('area_m2_total')}, list_position(['até 70 m²', '70 a 150 m²', '150 a 500 m²', '500 a 5.000 m²', 'acima de 5.000 m²'], faixa_area)::bigint as lugar
  from destinacao_ano where faixa_area is not null group by 1""",
     lambda q: _placed(q.faixas_area()))
_ask("q_cardinalidade", MARTS + _unpivot(
    """select count(*) filter (where n_areas > 1) as "obras com mais de uma área", count(*) filter (where n_areas = 0) as "obras sem nenhuma área", count(*) filter (where n_cnaes > 1) as "obras com mais de um CNAE",
    count(*) filter (where n_vinculos > 0) as "obras com algum vínculo", max(n_areas)::bigint as "maior número de áreas numa obra" from analitico""", "situacao", "obras"), lambda q: q.cardinalidade())
_ask("q_responsavel", MARTS + """select tipo, obras, round(100.0::double * obras / t, 1) as pct from (select 'PF' as tipo, sum(n_obras - n_pj)::bigint as obras, sum(n_obras)::bigint as t from municipio_ano
  union all select 'PJ', sum(n_pj)::bigint, sum(n_obras)::bigint from municipio_ano)""", lambda q: q.responsavel())
_ask("q_situacao", MARTS + _unpivot(
    """select sum(n_encerradas)::bigint as "Encerrada", sum(n_ativas)::bigint as "Ativa", sum(n_paralisadas)::bigint as "Paralisada", sum(n_nulas)::bigint as "Nula", sum(n_suspensas)::bigint as "Suspensa"
    from municipio_ano where uf = 'PR'""", "situacao", "obras"), lambda q: q.situacao("PR"))
_ask("q_perfil_geo", MARTS + """select coalesce(geo_origem, 'sem código utilizável') as origem, count(*) as pontos, count(*) filter (where geo_plausivel) as plausiveis,
  round(median(geo_distancia_municipio_km), 2) as dist_mediana_km, round(max(geo_distancia_municipio_km), 0) as dist_maxima_km from analitico group by 1""", lambda q: q.perfil_geo())
_ask("q_funil_geocodificacao", MARTS + """select etapa, obras, round(100.0::double * obras / (select sum(n_obras) from municipio_ano), 1) as pct_da_base from (""" + _unpivot(
    """select count(*) filter (where codigo_localizacao like '%+%') as "contém um '+'", count(*) filter (where geocodificada) as "decodifica de fato",
    count(*) filter (where geo_plausivel) as "cai no município certo" from analitico""", "etapa", "obras") + ")", lambda q: q.funil_geocodificacao())
_ask("q_distancia_geo", MARTS + """select case when d <= 150 then 'até 150 km (plausível)' when d <= 500 then '150 a 500 km' when d <= 5000 then '500 a 5.000 km' else 'mais de 5.000 km' end as faixa, count(*) as pontos, row_number() over (order by min(d) nulls last) as lugar
  from (select geo_distancia_municipio_km as d from analitico where geocodificada) group by 1""", lambda q: _placed(q.distancia_geo()))
_ask("q_pontos_fora", MARTS + """select cno, uf, nome_municipio as municipio, codigo_localizacao as plus_code, round(latitude * 10)::bigint as lat, round(longitude * 10)::bigint as lon, round(geo_distancia_municipio_km, 0)::bigint as km
  from analitico where geocodificada order by floor(geo_distancia_municipio_km * 1e6) desc nulls last, cno limit 10""",
     lambda q: q.pontos_fora().selectExpr("cno", "uf", "municipio", "plus_code", "cast(round(latitude * 10) as bigint) as lat", "cast(round(longitude * 10) as bigint) as lon", "cast(distancia_km as bigint) as km"))
_ask("q_mapa_municipios", MARTS + f"""select uf, nome_municipio as municipio, sum(n_obras)::bigint as obras, sum(n_geocodificadas)::bigint as geocodificadas, {_KM2.format('area_m2_total')},
  round((median(lat_mediana) + 90) * 32000)::bigint as lat, round((median(lon_mediana) + 180) * 32000)::bigint as lon from municipio_ano where lat_mediana is not null group by 1, 2 having sum(n_geocodificadas) > 0""",
     lambda q: q.mapa_municipios().selectExpr("uf", "municipio", "obras", "geocodificadas", "area_km2", "cast(round((latitude + 90) * 32000) as bigint) as lat", "cast(round((longitude + 180) * 32000) as bigint) as lon"))
_ask("q_obras_por_ano", MARTS + f"""select ano_inicio as ano, sum(n_obras)::bigint as obras, {_KM2.format('area_m2_total')}, sum(n_ativas)::bigint as ativas, row_number() over (order by ano_inicio nulls last) as lugar from municipio_ano where ano_inicio between 2012 and 2022 and uf = 'SC' group by 1""",
     lambda q: _placed(q.obras_por_ano("SC", 2012, 2022)))
_ask("q_entrada_no_cadastro", CURATED + "select year(data_registro) as ano_registro, count(*) as obras, min(data_registro) as primeiro_registro, row_number() over (order by year(data_registro)) as lugar from analitico where data_registro is not null group by 1", lambda q: _placed(q.entrada_no_cadastro()))
_ask("q_registro_de_obras_antigas", CURATED + """select year(data_registro) as ano_registro, count(*) as obras_iniciadas_antes_de_2019, row_number() over (order by year(data_registro)) as lugar from analitico where ano_inicio < 2019 and data_registro is not null group by 1""",
     lambda q: _placed(q.registro_de_obras_antigas()))
_ask("q_atraso_de_registro", CURATED + _unpivot(
    """select count(*) filter (where d < 0) as "registrada antes de começar", count(*) filter (where d between 0 and 30) as "registrada em até 30 dias", count(*) filter (where d between 31 and 365) as "registrada em até um ano",
    count(*) filter (where d > 365) as "registrada mais de um ano depois" from (select datediff('day', data_inicio, data_registro) as d from analitico where data_inicio is not null and data_registro is not null)""",
    "situacao", "obras"), lambda q: q.atraso_de_registro())
_ask("q_datas_ausentes", CURATED + """select count(*) filter (where data_inicio is null) as sem_data_inicio, count(*) filter (where ano_inicio < 1990) as antes_de_1990, min(data_inicio) as data_mais_antiga,
  max(data_inicio) as data_mais_recente from analitico""", lambda q: q.datas_ausentes())
_PEOPLE = "(select uf, sum(populacao)::bigint as populacao from places group by 1)"
_ask("q_ranking_ufs", PLACED + f"""select uf, obras, area_km2, populacao, round(1000.0::double * obras / populacao, 1) as obras_por_mil_hab from (select uf, sum(n_obras)::bigint as obras, {_KM2.format('area_m2_total')}
  from municipio_ano where uf is not null and ano_inicio >= 2019 group by 1) left join {_PEOPLE} using (uf)""", lambda q: q.ranking_ufs(comparavel=True))
_ask("q_ranking_ufs_sem_referencias", MARTS + f"""select uf, sum(n_obras)::bigint as obras, {_KM2.format('area_m2_total')}, null::bigint as populacao, null::double as obras_por_mil_hab from municipio_ano where uf is not null group by 1""",
     lambda q: q.ranking_ufs(), referenced=False)
_ask("q_municipios", PLACED + """select t.uf, t.codigo_municipio, t.nome_municipio, obras, ativas, geocodificadas, area_m2, codigo_ibge, nome as nome_ibge, regiao_imediata, regiao_intermediaria, populacao, fixed as casou_por_correcao,
  case when populacao > 0 then round(1000.0::double * obras / populacao, 1) end as obras_por_mil_hab from (select uf, codigo_municipio, nome_municipio, sum(n_obras)::bigint as obras, sum(n_ativas)::bigint as ativas,
  sum(n_geocodificadas)::bigint as geocodificadas, sum(area_m2_total)::double as area_m2 from municipio_ano group by 1, 2, 3) t join placed p on p.uf is not distinct from t.uf and p.nome_municipio = t.nome_municipio
  where coalesce(populacao, 0) >= 3000""", lambda q: q.municipios(populacao_minima=3000).drop("latitude_municipio", "longitude_municipio"))
_ask("q_divisoes_cnae", MARTS + f"""select *, round(100.0::double * obras / sum(obras) over (), 1) as pct_obras, round(100.0::double * area_km2 / sum(area_km2) over (), 1) as pct_area from (
  select cnae_divisao as divisao, max(cnae_divisao_nome) as nome, sum(n_obras)::bigint as obras, {_KM2.format('area_m2_total')} from setor_ano where cnae_divisao is not null group by 1)""", lambda q: q.divisoes_cnae())
_ask("q_destinacoes", CURATED + f"""select coalesce(destinacao_obra, 'não informada') as destinacao, count(*) as obras, {_KM2.format('area_m2')}, median(area_m2::double) as area_mediana_m2 from analitico where uf = 'SP' group by 1""",
     lambda q: q.destinacoes("SP"))
_ask("q_regioes", PLACED + f"""select regiao_intermediaria as regiao, count(*) as municipios, sum(obras)::bigint as obras, sum(populacao)::bigint as populacao, round(1000.0::double * sum(obras) / sum(populacao), 1) as obras_por_mil_hab,
  {_KM2.format('area_m2')} from (select uf, nome_municipio, sum(n_obras) as obras, sum(area_m2_total) as area_m2 from municipio_ano where uf = 'SP' group by 1, 2) join placed using (uf, nome_municipio)
  where regiao_intermediaria is not null group by 1""", lambda q: q.regioes("SP"))
_ask("q_cobertura_referencias", PLACED + """select count(*) as municipios_no_cno, count(codigo_ibge) as casaram, count(*) filter (where fixed and uf = 'SP') as via_tabela_de_correcao,
  count(*) filter (where codigo_ibge is null) as sem_par_no_ibge from placed where uf is not null""", lambda q: q.cobertura_referencias())
_ask("q_ufs_disponiveis", MARTS + "select distinct uf from municipio_ano where uf is not null", lambda q: q.ufs_disponiveis())


@query(MARTS + "select sum(n_obras)::bigint as obras from municipio_ano where uf = 'SC'")
def q_total_obras(t):
    return _one(t, questions(t).total_obras("SC"), "obras", "long")


@query(PLACED + "select substr(min(codigo_ibge), 1, 2) as prefixo from places where uf = 'SC'")
def q_prefixo_ibge(t):
    return _one(t, questions(t).prefixo_ibge("SC"), "prefixo", "string")


@query("select true as com, false as sem")
def q_tem_referencias(t):
    q, none = questions(t), questions(t, referenced=False)
    return t("orders").sparkSession.createDataFrame([(q.tem_referencias(), none.tem_referencias())], "com boolean, sem boolean")
