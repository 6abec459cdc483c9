"""Source tables to typed tables: contracts that are also the projections."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domains as D
from ..functions.columns import date, flag, label, number, state, text
from ..operators.relational import latest

Cast = Callable[[str], Column]


@dataclass(frozen=True)
class Table:
    """``columns``: source header to (name, cleaning).  Headers keep the publisher's spelling."""

    name: str
    file: str
    columns: dict[str, tuple[str, Cast]]
    key: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()

    @property
    def headers(self) -> list[str]:
        return [*self.columns, *self.dropped]

    def clean(self, source: DataFrame) -> list[Column]:
        return [cast(header).alias(name) for header, (name, cast) in self.columns.items()]


# The headers of the publisher's files.
WORKS = Table("obras", "cno.csv", {
    "CNO": ("cno", text), "Código do Pais": ("codigo_pais", text), "Nome do pais": ("nome_pais", text),
    "Data de início": ("data_inicio", date), "Data de inicio da responsabilidade": ("data_inicio_responsabilidade", date),
    "Data de registro": ("data_registro", date), "CNO vinculado": ("cno_vinculado", text), "CEP": ("cep", text),
    "NI do responsável": ("ni_responsavel", text), "Qualificação do responsavel": ("qualificacao_codigo", text),
    "Nome": ("nome_obra", text), "Código do municipio": ("codigo_municipio", text), "Nome do município": ("nome_municipio", text),
    "Tipo de logradouro": ("tipo_logradouro", text), "Logradouro": ("logradouro", text), "Número do logradouro": ("numero_logradouro", text),
    "Bairro": ("bairro", text), "Estado": ("uf_origem", text), "Complemento": ("complemento", text),
    "Unidade de medida": ("unidade_medida", text), "Área total": ("area_total", number), "Situação": ("situacao_codigo", text),
    "Data da situação": ("data_situacao", date), "Nome empresarial": ("nome_empresarial", text), "Código de localização": ("codigo_localizacao", text),
}, ("cno",), ("uf",), ("Caixa Postal",))
AREAS = Table("areas", "cno_areas.csv", {
    "CNO": ("cno", text), "Categoria": ("categoria", text), "Destinação": ("destinacao", text), "Tipo de obra": ("tipo_obra", text),
    "Tipo de Área": ("tipo_area", text), "Tipo de Área Complementar": ("tipo_area_complementar", text), "Metragem": ("metragem", number),
})
ACTIVITIES = Table("cnaes", "cno_cnaes.csv", {"CNO": ("cno", text), "CNAE": ("cnae", text), "Data de registro": ("data_registro", date)})
LINKS = Table("vinculos", "cno_vinculos.csv", {
    "CNO": ("cno", text), "Data de início": ("data_inicio", date), "Data de fim": ("data_fim", date), "Data de registro": ("data_registro", date),
    "Qualificação do contribuinte": ("qualificacao_codigo", text), "NI do responsável": ("ni_responsavel", text),
})
TABLES = {t.name: t for t in (WORKS, AREAS, ACTIVITIES, LINKS)}


def works_flags() -> dict[str, Column]:
    c = F.col
    return {
        "responsavel_tipo": F.when(c("ni_responsavel").isNull(), "PF").otherwise("PJ"),
        "situacao": label(c("situacao_codigo"), D.STATUSES),
        "qualificacao": label(c("qualificacao_codigo"), D.QUALIFICATIONS),
        "obra_ativa": flag(c("situacao_codigo") == "02"),
        "no_exterior": ~c("codigo_pais").eqNullSafe(D.HOME_COUNTRY),
        "uf_indefinida": c("uf").isNull(),
        "tem_plus_code": flag(c("codigo_localizacao").contains("+")),
        "area_suspeita": flag((c("unidade_medida") == "m2") & (c("area_total") > D.SUSPICIOUS_AREA_M2)),
        "datas_incoerentes": flag(c("data_inicio") > c("data_situacao")),
    }


def stage(name: str, source: DataFrame, snapshot: str) -> DataFrame:
    """A source table cleaned, typed and deduplicated.  An unknown name raises KeyError."""
    table = TABLES[name]
    clean = table.clean(source)
    if table is WORKS:
        out = source.select(*clean, state("Estado").alias("uf")).withColumn("snapshot_date", F.lit(snapshot))
        return latest(out.withColumns(works_flags()), "cno", "data_registro")
    out = source.select(*clean).distinct()  # what follows from other columns comes after: rows are compared by less
    if table is AREAS:
        out = out.withColumn("area_principal", flag(F.col("tipo_area") == "Principal"))
    if table is LINKS:
        out = out.withColumn("qualificacao", label(F.col("qualificacao_codigo"), D.QUALIFICATIONS)).withColumn("vinculo_vigente", F.col("data_fim").isNull())
    return out.withColumn("snapshot_date", F.lit(snapshot))
