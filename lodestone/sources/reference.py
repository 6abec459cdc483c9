"""Reference tables that users keep beside the registry: municipalities with their population, and name corrections."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import name_key
from .tables import SourceError

# The columns of the reference files.
PLACE_COLUMNS = {"codigo_ibge": "string", "nome": "string", "uf": "string", "regiao_imediata": "string", "regiao_intermediaria": "string", "latitude": "double", "longitude": "double"}
FIX_COLUMNS = ("uf", "nome_cno", "codigo_ibge", "nome_ibge", "motivo")
_POPULATION = re.compile(r"populacao_(\d{4})")


def _read(spark: SparkSession, path: str, needed: tuple[str, ...]) -> DataFrame:
    """All columns as text, so that codes keep their leading zeros; a missing column is an error."""
    df = spark.read.option("header", True).option("inferSchema", False).option("mode", "FAILFAST").csv(path)
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise SourceError(f"{path} lacks {', '.join(missing)}")
    return df


def newest_population(columns: list[str]) -> str:
    """The column of the latest year's population."""
    years = {m[1]: c for c in columns if (m := _POPULATION.fullmatch(c))}
    if not years:
        raise SourceError("no column populacao_YYYY")
    return years[max(years)]


def read_places(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The municipalities, with the name key ``chave``, and the name of the newest population column."""
    df = _read(spark, path, tuple(PLACE_COLUMNS))
    population = newest_population(df.columns)
    out = df.select(*[F.col(c).cast(k).alias(c) for c, k in PLACE_COLUMNS.items()], F.col(population).cast("long").alias(population))
    return out.withColumn("chave", name_key("nome")), population


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Names that the registry spells in its own way, with the code they stand for, and ``chave``."""
    return _read(spark, path, FIX_COLUMNS[:3]).withColumn("chave", name_key("nome_cno"))


def redundant(corrections: DataFrame, places: DataFrame) -> DataFrame:
    """``uf, nome_cno, nome`` of the corrections whose name matches a municipality without them."""
    left = corrections.select("uf", "nome_cno", name_key("nome_cno").alias("__k"))
    return left.join(places.select("uf", name_key("nome").alias("__k"), "nome"), ["uf", "__k"]).select("uf", "nome_cno", "nome")
