"""The catalogue of questions over the curated tables.  Every answer is a lazy DataFrame."""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import domains as D
from ..functions.columns import all_of, per
from ..operators.quantiles import quantiles, with_quantiles
from ..operators.relational import join_reference, rows_of, small, with_shares
from ..sources.reference import read_corrections, read_places
from ..sources.tables import age, current, read_snapshot, replace_snapshot

_F, _c = F, F.col


def _km2(c: str = "area_m2_total") -> Column:
    return (F.sum(c).cast("double") / 1e6).alias("area_km2")


def _top(df: DataFrame, by: str = "obras") -> DataFrame:
    """Largest first; ties in the order of the other columns."""
    return df.orderBy(_c(by).desc_nulls_last(), *[_c(x).asc_nulls_last() for x in df.columns if x != by])


def decode_lines(lines: list[bytes], encoding: str) -> list[str]:
    return [x.decode(encoding, errors="replace") for x in lines]


def sample_lines(path: str, most: int = 1000) -> list[bytes]:
    """The first ``most`` lines of a file, as bytes: a sample to look at, whatever the file's length."""
    with open(path, "rb") as f:
        return [line.rstrip(b"\r\n") for line in islice(f, most)]


@dataclass
class Questions:
    """The newest snapshot's tables; ``places`` and ``corrections`` are the optional reference tables."""

    obras: DataFrame
    municipio_ano: DataFrame
    setor_ano: DataFrame
    destinacao_ano: DataFrame
    places: DataFrame | None = None
    corrections: DataFrame | None = None
    population: str = "populacao"
    keep_seconds: float = 3600
    answers: str | None = None
    state: list = field(default_factory=list)
    _cache: dict = field(default_factory=dict, repr=False)

    @classmethod
    def open(cls, spark: SparkSession, curated: str, places: DataFrame | None = None, corrections: DataFrame | None = None, population: str = "populacao", answers: str | None = None) -> Questions:
        """Pins all four tables to the newest snapshot and registers them as views; ``answers``, a folder on a store, keeps answers for all sessions."""
        names = {"obras": "obras_analitico", "municipio_ano": "mart_municipio_ano", "setor_ano": "mart_setor_ano", "destinacao_ano": "mart_destinacao_ano"}
        tables = {k: read_snapshot(spark, f"{curated}/{v}") for k, v in names.items()}
        for k, v in tables.items():
            v.createOrReplaceTempView(k)
        state = [current(spark, f"{curated}/{v}") for v in names.values()] if answers else []
        return cls(**tables, places=places, corrections=corrections, population=population, answers=answers, state=state)

    def ask(self, question: str, **filters):
        """The answer, kept by question and filters for ``keep_seconds``: in the session, and with ``answers`` as a table that any session reads."""
        key, now = (question, *sorted(filters.items())), time.monotonic()
        for stale in [k for k, (until, _) in self._cache.items() if until <= now]:
            _, old = self._cache.pop(stale)
            if isinstance(old, DataFrame):
                old.unpersist()
        if key not in self._cache:
            until, answer = self._kept(question, filters) if self.answers else (self.keep_seconds, getattr(self, question)(**filters))
            self._cache[key] = now + until, answer.cache() if isinstance(answer, DataFrame) else answer
        return self._cache[key][1]

    def _kept(self, question: str, filters: dict) -> tuple[float, object]:
        """``(seconds left, answer)`` from the table kept for the question, its filters, the versions of the curated tables and the
        reference tables; asked and written, in its order, if there is none or it is too old."""
        spark = self.obras.sparkSession
        what = json.dumps([question, sorted(filters.items()), self.state, self._reference_state()], default=str, ensure_ascii=False)
        folder, name = f"{self.answers}/{question}", hashlib.sha256(what.encode()).hexdigest()[:32]
        old = age(spark, folder, name)
        if old is None or old >= self.keep_seconds:
            answer = getattr(self, question)(**filters)
            rows = answer if isinstance(answer, DataFrame) else spark.createDataFrame([(answer,)], "__answer " + ("long" if isinstance(answer, int) else "string"))
            replace_snapshot(rows.withColumn("__n", F.monotonically_increasing_id()), folder, name)
            old = 0.0
        rows = read_snapshot(spark, folder, name).drop("snapshot_date").orderBy("__n").drop("__n")
        return self.keep_seconds - old, rows.first()[0] if rows.columns == ["__answer"] else rows

    def _reference_state(self) -> list:
        """Number and hash of the rows of the reference tables: other rows, other answers."""
        if not self._cache.get("__reference"):
            found = []
            for df in (self.places, self.corrections):
                found.append(None if df is None else [str(x) for x in df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)"))).first()])
            self._cache["__reference"] = float("inf"), [self.population, *found]
        return self._cache["__reference"][1]

    @classmethod
    def open_with(cls, spark: SparkSession, curated: str, places: str, corrections: str, answers: str | None = None) -> Questions:
        """As :meth:`open`, with the reference tables read from CSV files."""
        table, population = read_places(spark, places)
        return cls.open(spark, curated, table, read_corrections(spark, corrections), population, answers)

    @staticmethod
    def _where(df: DataFrame, uf: str | None = None, comparavel: bool = False, extra: Column | None = None) -> DataFrame:
        conditions = [_c("uf") == uf] if uf else []
        if comparavel:
            conditions.append(_c("ano_inicio") >= D.FIRST_COMPARABLE_YEAR)
        return df.filter(all_of([*conditions, *([extra] if extra is not None else [])]))

    def tem_referencias(self) -> bool:
        return self.places is not None and self.corrections is not None

    def _placed(self, df: DataFrame) -> DataFrame:
        if self.tem_referencias():
            return join_reference(df, self.places, self.corrections, self.population)
        none = {"codigo_ibge": "string", "regiao_imediata": "string", "regiao_intermediaria": "string", "populacao": "long", "latitude_municipio": "double", "longitude_municipio": "double"}
        return df.withColumns({"nome_ibge": _c("nome_municipio"), **{k: F.lit(None).cast(v) for k, v in none.items()}, "casou_por_correcao": F.lit(False)})

    # what there is
    def totais_do_cabecalho(self, uf: str | None = None) -> DataFrame:
        return self._where(self.municipio_ano, uf).agg(F.coalesce(F.sum("n_obras"), F.lit(0)).alias("obras"), F.countDistinct("codigo_municipio").alias("municipios"))

    def total_obras(self, uf: str | None = None) -> int:
        return self._where(self.municipio_ano, uf).agg(F.sum("n_obras")).first()[0] or 0

    def volumetria(self, uf: str | None = None) -> DataFrame:
        one = self._where(self.obras, uf).agg(
            F.count("*").alias("obras (uma linha por obra)"), F.countDistinct("codigo_municipio").alias("municípios distintos"), F.countDistinct("uf").alias("UFs"),
            F.sum("n_areas").alias("áreas declaradas (1:N)"), F.sum("n_cnaes").alias("CNAEs declarados (1:N)"), F.sum("n_vinculos").alias("vínculos (1:N)"))
        return rows_of(one, "o_que", "quantas", "long")

    # profile
    def perfil_unidades(self, uf: str | None = None) -> DataFrame:
        by = self._where(self.obras, uf).groupBy(_c("unidade_medida").alias("unidade")).agg(F.count("*").alias("obras"), F.round(F.sum("area_declarada").cast("double") / 1e6, 1).alias("soma_milhoes"))
        return _top(with_shares(by, {"pct_obras": ("obras", 2)}))

    def decomposicao_area(self, uf: str | None = None) -> DataFrame:
        def km2(c: Column, name: str) -> Column:
            return F.round(F.sum(c).cast("double") / 1e6, 1).alias(name)

        declared = _c("area_declarada")
        return rows_of(self._where(self.obras, uf).agg(
            km2(declared, "SUM(area_total) cru"), km2(F.when(~_c("area_suspeita"), declared), "sem as áreas implausíveis"),
            km2(F.when(_c("unidade_medida") == "m2", declared), "só o que está em m²"), km2(_c("area_m2"), "m² e sem implausíveis (area_m2)")), "criterio", "km2")

    def areas_implausiveis(self, limite: int = 10) -> DataFrame:
        return self.obras.filter("area_suspeita").orderBy(_c("area_declarada").desc_nulls_last(), "cno").limit(limite).select(
            "cno", "uf", _c("nome_municipio").alias("municipio"), _c("unidade_medida").alias("unidade"), "area_declarada", _c("destinacao_obra").alias("destinacao"))

    def quantis_area(self, uf: str | None = None) -> DataFrame:
        works = self._where(self.obras, uf)
        one = works.agg(F.count("area_m2").alias("obras_com_area"), F.round(F.avg(_c("area_m2").cast("double")), 1).alias("media"))
        wanted = {n: (_c("area_m2"), q) for n, q in {"p25": 0.25, "mediana": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}.items()}
        return one.join(F.broadcast(quantiles(works, [], wanted)))  # one row each

    def histograma_area(self, uf: str | None = None) -> DataFrame:
        step = F.least(F.floor(_c("area_m2").cast("double") / D.HISTOGRAM_STEP) * D.HISTOGRAM_STEP, F.lit(D.HISTOGRAM_TOP)).cast("double")
        return self._where(self.obras, uf, extra=_c("area_m2") > 0).groupBy(step.alias("faixa_inicio")).agg(F.count("*").alias("obras")).orderBy("faixa_inicio")

    def faixas_area(self, uf: str | None = None) -> DataFrame:
        order = F.array(*[F.lit(b[2]) for b in D.AREA_BANDS])
        by = self._where(self.destinacao_ano, uf, extra=_c("faixa_area").isNotNull()).groupBy("faixa_area").agg(F.sum("n_obras").alias("obras"), _km2())
        return by.orderBy(F.nullif(F.array_position(order, _c("faixa_area")), F.lit(0)).asc_nulls_last())

    def cardinalidade(self) -> DataFrame:
        return rows_of(self.obras.agg(
            F.count_if(_c("n_areas") > 1).alias("obras com mais de uma área"), F.count_if(_c("n_areas") == 0).alias("obras sem nenhuma área"),
            F.count_if(_c("n_cnaes") > 1).alias("obras com mais de um CNAE"), F.count_if(_c("n_vinculos") > 0).alias("obras com algum vínculo"),
            F.max("n_areas").alias("maior número de áreas numa obra")), "situacao", "obras", "long")

    def responsavel(self, uf: str | None = None) -> DataFrame:
        one = self._where(self.municipio_ano, uf).agg(F.coalesce(F.sum("n_obras"), F.lit(0)).alias("t"), F.coalesce(F.sum("n_pj"), F.lit(0)).alias("pj"))
        rows = one.select("t", F.inline(F.array(F.struct(F.lit("PF").alias("tipo"), (_c("t") - _c("pj")).alias("obras")), F.struct(F.lit("PJ").alias("tipo"), _c("pj").alias("obras")))))
        return rows.select("tipo", "obras", F.coalesce(F.round(per(_c("obras"), _c("t"), 100.0), 1), F.lit(0.0)).alias("pct")).orderBy(_c("obras").desc(), "tipo")

    def situacao(self, uf: str | None = None) -> DataFrame:
        names = {"Encerrada": "n_encerradas", "Ativa": "n_ativas", "Paralisada": "n_paralisadas", "Nula": "n_nulas", "Suspensa": "n_suspensas"}
        return _top(rows_of(self._where(self.municipio_ano, uf).agg(*[F.sum(c).alias(n) for n, c in names.items()]), "situacao", "obras", "long"))

    # geocoding
    def perfil_geo(self, uf: str | None = None) -> DataFrame:
        d = "geo_distancia_municipio_km"
        works = self._where(self.obras, uf).withColumn("origem", F.coalesce("geo_origem", F.lit("sem código utilizável")))
        by = works.groupBy("origem").agg(F.count("*").alias("pontos"), F.count_if("geo_plausivel").alias("plausiveis"), F.round(F.max(d), 0).alias("dist_maxima_km"))
        by = with_quantiles(by, works, ["origem"], {"dist_mediana_km": (_c(d), 0.5)})
        return _top(by.select("origem", "pontos", "plausiveis", F.round("dist_mediana_km", 2).alias("dist_mediana_km"), "dist_maxima_km"), "pontos")

    def funil_geocodificacao(self, uf: str | None = None) -> DataFrame:
        rows = rows_of(self._where(self.obras, uf).agg(
            F.count_if(_c("codigo_localizacao").contains("+")).alias("contém um '+'"), F.count_if("geocodificada").alias("decodifica de fato"),
            F.count_if("geo_plausivel").alias("cai no município certo")), "etapa", "obras", "long")
        total = self._where(self.municipio_ano, uf).agg(F.sum("n_obras").alias("__t"))
        return rows.join(F.broadcast(total)).select("etapa", "obras", F.round(per(_c("obras"), _c("__t"), 100.0), 1).alias("pct_da_base"))  # one row

    def distancia_geo(self, uf: str | None = None) -> DataFrame:
        d, k = _c("geo_distancia_municipio_km"), D.PLAUSIBLE_KM
        band = F.when(d <= k, f"até {k} km (plausível)").when(d <= 500, f"{k} a 500 km").when(d <= 5000, "500 a 5.000 km").otherwise("mais de 5.000 km")
        by = self._where(self.obras, uf, extra=_c("geocodificada")).groupBy(band.alias("faixa")).agg(F.count("*").alias("pontos"), F.min(d).alias("__d"))
        return by.orderBy(_c("__d").asc_nulls_last()).drop("__d")

    def pontos_fora(self, limite: int = 10) -> DataFrame:
        return self.obras.filter("geocodificada").orderBy(_c("geo_distancia_municipio_km").desc_nulls_last(), "cno").limit(limite).select(
            "cno", "uf", _c("nome_municipio").alias("municipio"), _c("codigo_localizacao").alias("plus_code"), F.round("latitude", 3).alias("latitude"),
            F.round("longitude", 3).alias("longitude"), F.round("geo_distancia_municipio_km", 0).alias("distancia_km"))

    def mapa_municipios(self, uf: str | None = None) -> DataFrame:
        by = self._where(self.municipio_ano, uf, extra=_c("lat_mediana").isNotNull()).groupBy("uf", _c("nome_municipio").alias("municipio")).agg(
            F.sum("n_obras").alias("obras"), F.sum("n_geocodificadas").alias("geocodificadas"), _km2(), F.median("lat_mediana").alias("latitude"), F.median("lon_mediana").alias("longitude"))
        return _top(by.filter("geocodificadas > 0"))

    def prefixo_ibge(self, uf: str) -> str:
        return str(self.places.filter(_c("uf") == uf).agg(F.min("codigo_ibge").cast("string")).first()[0])[:2]

    # time
    def obras_por_ano(self, uf: str | None = None, desde: int = 1990, ate: int | None = None) -> DataFrame:
        years = _c("ano_inicio").between(desde, ate) if ate else _c("ano_inicio") >= desde
        return self._where(self.municipio_ano, uf, extra=years).groupBy(_c("ano_inicio").alias("ano")).agg(F.sum("n_obras").alias("obras"), _km2(), F.sum("n_ativas").alias("ativas")).orderBy("ano")

    def entrada_no_cadastro(self) -> DataFrame:
        return self.obras.filter("data_registro is not null").groupBy(F.year("data_registro").cast("long").alias("ano_registro")).agg(
            F.count("*").alias("obras"), F.min("data_registro").alias("primeiro_registro")).orderBy("ano_registro")

    def registro_de_obras_antigas(self) -> DataFrame:
        old = self.obras.filter((_c("ano_inicio") < D.FIRST_COMPARABLE_YEAR) & _c("data_registro").isNotNull())
        return old.groupBy(F.year("data_registro").cast("long").alias("ano_registro")).agg(F.count("*").alias(f"obras_iniciadas_antes_de_{D.FIRST_COMPARABLE_YEAR}")).orderBy("ano_registro")

    def atraso_de_registro(self) -> DataFrame:
        lag = F.datediff("data_registro", "data_inicio")
        return rows_of(self.obras.filter("data_registro is not null and data_inicio is not null").agg(
            F.count_if(lag < 0).alias("registrada antes de começar"), F.count_if(lag.between(0, 30)).alias("registrada em até 30 dias"),
            F.count_if(lag.between(31, 365)).alias("registrada em até um ano"), F.count_if(lag > 365).alias("registrada mais de um ano depois")), "situacao", "obras", "long")

    def datas_ausentes(self) -> DataFrame:
        return self.obras.agg(
            F.count_if(_c("data_inicio").isNull()).alias("sem_data_inicio"), F.count_if(_c("ano_inicio") < 1990).alias("antes_de_1990"),
            F.min("data_inicio").alias("data_mais_antiga"), F.max("data_inicio").alias("data_mais_recente"))

    # places and sectors
    def ranking_ufs(self, comparavel: bool = False) -> DataFrame:
        by = self._where(self.municipio_ano, comparavel=comparavel, extra=_c("uf").isNotNull()).groupBy("uf").agg(F.sum("n_obras").alias("obras"), _km2())
        if not self.tem_referencias():
            return _top(by.withColumns({"populacao": F.lit(None).cast("long"), "obras_por_mil_hab": F.lit(None).cast("double")}))
        people = small(self.places.groupBy("uf").agg(F.sum(self.population).alias("populacao")))
        return _top(by.join(people, "uf", "left").withColumn("obras_por_mil_hab", F.round(per(_c("obras"), _c("populacao"), 1000.0), 1)))

    def municipios(self, uf: str | None = None, comparavel: bool = False, populacao_minima: int = 0) -> DataFrame:
        by = self._where(self.municipio_ano, uf, comparavel).groupBy("uf", "codigo_municipio", "nome_municipio").agg(
            F.sum("n_obras").alias("obras"), F.sum("n_ativas").alias("ativas"), F.sum("n_geocodificadas").alias("geocodificadas"), F.sum("area_m2_total").alias("area_m2"))
        rate = F.when(_c("populacao") > 0, F.round(per(_c("obras"), _c("populacao"), 1000.0), 1))
        return _top(self._placed(by).withColumn("obras_por_mil_hab", rate).filter(F.coalesce("populacao", F.lit(0)) >= populacao_minima))

    def divisoes_cnae(self, uf: str | None = None) -> DataFrame:
        by = self._where(self.setor_ano, uf, extra=_c("cnae_divisao").isNotNull()).groupBy(_c("cnae_divisao").alias("divisao")).agg(
            F.max("cnae_divisao_nome").alias("nome"), F.sum("n_obras").alias("obras"), _km2())
        return _top(with_shares(by, {"pct_obras": ("obras", 1), "pct_area": ("area_km2", 1)}))

    def destinacoes(self, uf: str | None = None) -> DataFrame:
        works = self._where(self.obras, uf).withColumn("destinacao", F.coalesce("destinacao_obra", F.lit("não informada")))
        by = works.groupBy("destinacao").agg(F.count("*").alias("obras"), _km2("area_m2"))
        return _top(with_quantiles(by, works, ["destinacao"], {"area_mediana_m2": (_c("area_m2"), 0.5)}))

    def regioes(self, uf: str) -> DataFrame:
        by = self._where(self.municipio_ano, uf).groupBy("uf", "nome_municipio").agg(F.sum("n_obras").alias("obras"), F.sum("area_m2_total").alias("area_m2"))
        return _top(self._placed(by).filter("regiao_intermediaria is not null").groupBy(_c("regiao_intermediaria").alias("regiao")).agg(
            F.count("*").alias("municipios"), F.sum("obras").alias("obras"), F.sum("populacao").alias("populacao"),
            F.round(per(F.sum("obras"), F.sum("populacao"), 1000.0), 1).alias("obras_por_mil_hab"), _km2("area_m2")))

    def cobertura_referencias(self) -> DataFrame:
        names = self.municipio_ano.filter("uf is not null").select("uf", "nome_municipio").distinct()
        return self._placed(names).agg(
            F.count("*").alias("municipios_no_cno"), F.count("codigo_ibge").alias("casaram"), F.count_if("casou_por_correcao").alias("via_tabela_de_correcao"),
            F.count_if(_c("codigo_ibge").isNull()).alias("sem_par_no_ibge"))

    def ufs_disponiveis(self) -> DataFrame:
        return self.municipio_ano.filter("uf is not null").select("uf").distinct().orderBy("uf")
