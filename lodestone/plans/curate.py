"""One row per work with geocoding, and the three marts.

Geocoding works on the distinct codes of each municipality, each decoded once: anchors are medians weighted by
the number of works, short codes are recovered against them, and the points join back to the works.  Nothing leaves
the engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domains as D
from ..functions import olc
from ..functions.columns import area_band, flag, haversine_km, label, section
from ..operators.quantiles import with_quantiles
from ..operators.relational import arg_max, first_by, settled, small


def areas_per_work(areas: DataFrame) -> DataFrame:
    main, size = F.col("area_principal"), F.coalesce("metragem", F.lit(0))
    return areas.groupBy("cno").agg(
        F.count("*").alias("n_areas"),
        F.sum(F.when(main, F.col("metragem"))).alias("area_principal_m2"),
        F.sum(F.when(~main, F.col("metragem"))).alias("area_complementar_m2"),
        arg_max(F.col("categoria"), size, main).alias("categoria_obra"),
        arg_max(F.col("destinacao"), size, main).alias("destinacao_obra"),
        arg_max(F.col("tipo_obra"), size, main).alias("tipo_obra"))


def activities_per_work(cnaes: DataFrame) -> DataFrame:
    return cnaes.groupBy("cno").agg(F.count("*").alias("n_cnaes"), first_by(F.col("cnae"), F.col("data_registro"), F.col("cnae")).alias("cnae_principal"))


def links_per_work(links: DataFrame) -> DataFrame:
    return links.groupBy("cno").agg(F.count("*").alias("n_vinculos"))


def points(works: DataFrame) -> DataFrame:
    """A row for each municipality and code of ``works``, both as they stand: latitude, longitude, their origin, the
    works that anchor the municipality and the distance to the anchor.

    The medians of an anchor hold the distinct coordinates of one municipality: the lines of the grid of codes that
    it touches, however many works there are.
    """
    codes = works.groupBy("codigo_municipio", "codigo_localizacao").agg(F.count("*").alias("n"))
    code = olc.normal(F.col("codigo_localizacao"))
    lat, lon = olc.decode(code)
    decoded = settled(codes.withColumns({"code": code}).withColumns({"lat": lat, "lon": lon}))
    anchors = decoded.filter("lat is not null and codigo_municipio is not null").groupBy("codigo_municipio").agg(
        F.percentile("lat", 0.5, F.col("n")).alias("alat"), F.percentile("lon", 0.5, F.col("n")).alias("alon"), F.sum("n").alias("municipio_pontos_ancora"))
    out = decoded.join(small(settled(anchors)), "codigo_municipio", "left")
    lat2, lon2 = olc.recover(F.col("code"), F.col("alat"), F.col("alon"))
    out = settled(out.withColumns({"lat2": F.when(F.col("lat").isNull(), lat2), "lon2": F.when(F.col("lat").isNull(), lon2)}))
    latitude, longitude = F.coalesce("lat", "lat2"), F.coalesce("lon", "lon2")
    return out.select(
        "codigo_municipio", "codigo_localizacao", latitude.alias("latitude"), longitude.alias("longitude"),
        F.when(F.col("lat").isNotNull(), "completo").when(F.col("lat2").isNotNull(), "curto_recuperado").alias("geo_origem"),
        "municipio_pontos_ancora", haversine_km(latitude, longitude, F.col("alat"), F.col("alon")).alias("geo_distancia_municipio_km"))


def geocode(works: DataFrame) -> DataFrame:
    """``works`` with latitude, longitude, their origin, the municipality's anchor points and the distance to it."""
    keys = ["codigo_municipio", "codigo_localizacao"]
    at = points(works)
    at = small(at.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in at.columns]))
    on = F.col(keys[0]).eqNullSafe(F.col(f"__{keys[0]}")) & F.col(keys[1]).eqNullSafe(F.col(f"__{keys[1]}"))
    return works.join(at, on, "left").drop(*[f"__{k}" for k in keys])


_KEPT = (
    "cno snapshot_date uf codigo_municipio nome_municipio codigo_localizacao nome_obra bairro cep data_inicio data_registro data_situacao ano_inicio "
    "situacao_codigo situacao obra_ativa qualificacao_codigo qualificacao responsavel_tipo nome_empresarial no_exterior uf_indefinida datas_incoerentes "
    "unidade_medida area_declarada area_m2 area_suspeita n_areas area_principal_m2 area_complementar_m2 categoria_obra destinacao_obra tipo_obra "
    "n_cnaes cnae_principal n_vinculos latitude longitude geo_origem municipio_pontos_ancora geo_distancia_municipio_km"
).split()


def analytic(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per work: its own columns, what its children come to, the point, and derived columns."""
    out = geocode(tables["obras"])
    out = out.join(areas_per_work(tables["areas"]), "cno", "left").join(activities_per_work(tables["cnaes"]), "cno", "left").join(links_per_work(tables["vinculos"]), "cno", "left")
    zero = F.lit(0).cast("long")
    out = out.withColumnRenamed("area_total", "area_declarada").withColumns({
        "ano_inicio": F.year("data_inicio").cast("long"),
        "area_m2": F.when((F.col("unidade_medida") == "m2") & ~F.col("area_suspeita"), F.col("area_declarada")),
        **{n: F.coalesce(n, zero) for n in ("n_areas", "n_cnaes", "n_vinculos")}}).select(*_KEPT)
    cnae = F.col("cnae_principal")
    return out.withColumns({
        "cnae_secao": section(cnae, 2), "cnae_secao_nome": section(cnae, 3), "cnae_divisao": F.substring(cnae, 1, 2),
        "cnae_divisao_nome": label(F.substring(cnae, 1, 2), D.CNAE_DIVISIONS), "faixa_area": area_band(F.col("area_m2")),
        "serie_comparavel": F.col("ano_inicio") >= D.FIRST_COMPARABLE_YEAR, "geocodificada": F.col("latitude").isNotNull(),
        "geo_plausivel": flag(F.col("geo_distancia_municipio_km") <= D.PLAUSIBLE_KM),
        "area_areas_suspeita": flag(F.col("area_principal_m2") > D.SUSPICIOUS_AREA_M2)})


def _count(where: Column) -> Column:
    return F.count_if(where)


def measures() -> list[Column]:
    status = {"n_ativas": "02", "n_encerradas": "15", "n_paralisadas": "14", "n_suspensas": "03", "n_nulas": "01"}
    return [
        F.count("*").alias("n_obras"), *[_count(F.col("situacao_codigo") == code).alias(n) for n, code in status.items()],
        _count(F.col("responsavel_tipo") == "PJ").alias("n_pj"), F.count("area_m2").alias("n_com_area_m2"),
        F.sum("area_m2").cast("decimal(38,2)").alias("area_m2_total"),
        _count(F.col("geo_plausivel")).alias("n_geocodificadas")]


def _plausible(c: str) -> Column:
    return F.median(F.when(F.col("geo_plausivel"), F.col(c)))


#: name: (keys, further aggregates)
MARTS = {
    "mart_municipio_ano": ("snapshot_date uf codigo_municipio nome_municipio ano_inicio", lambda: [_plausible("latitude").alias("lat_mediana"), _plausible("longitude").alias("lon_mediana")]),
    "mart_setor_ano": ("snapshot_date uf cnae_principal cnae_divisao ano_inicio", lambda: [F.max("cnae_divisao_nome").alias("cnae_divisao_nome")]),
    "mart_destinacao_ano": ("snapshot_date uf destinacao_obra categoria_obra faixa_area ano_inicio", list),
}


def mart(name: str, works: DataFrame) -> DataFrame:
    """One mart.  The median area is exact in bounded memory; the medians of coordinates hold lines of the codes' grid."""
    keys, more = MARTS[name]
    grouped = works.groupBy(*keys.split()).agg(*measures(), *more())
    columns = [*grouped.columns]
    columns.insert(columns.index("area_m2_total") + 1, "area_m2_mediana")
    return with_quantiles(grouped, works, keys.split(), {"area_m2_mediana": (F.col("area_m2"), 0.5)}).select(*columns)


def coverage(works: DataFrame) -> dict:
    """Gross and usable geocoding coverage, in one pass."""
    code = olc.kind(olc.normal(F.col("codigo_localizacao")))
    row = works.agg(
        F.count("*").alias("obras"), _count(code == "completo").alias("completos"), _count(code == "curto").alias("curtos"),
        _count(F.col("geo_origem") == "completo").alias("decodificados"), _count(F.col("geo_origem") == "curto_recuperado").alias("recuperados"),
        _count(F.col("geocodificada")).alias("geocodificadas"), _count(F.col("geo_plausivel")).alias("plausiveis")).first().asDict()
    n = row["obras"] or 0
    return row | {"cobertura_bruta": row["geocodificadas"] / n if n else 0.0, "cobertura_util": row["plausiveis"] / n if n else 0.0}
