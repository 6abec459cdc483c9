"""Dedup, collapse, transposition, shares and reference joins over DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import name_key

#: Rows, and bytes in them, up to which a dimension is broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows and ``size`` bytes; else as it is, for a shuffled join.

    Text counts as its bytes, anything else as eight.
    """
    wide = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    width = reduce(Column.__add__, wide, F.lit(8 * (len(df.columns) - len(wide)))).cast("long")
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= rows and found["bytes"] <= size else df


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that the session names for what all executors read."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def settled(df: DataFrame) -> DataFrame:
    """What several plans read, computed once: checkpointed in the shared folder; as it is where the session names none."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not folder:
        return df
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def latest(df: DataFrame, key: str, by: str) -> DataFrame:
    """One row of each key: the last by ``by``, nulls last; ties go to the row of least hash, so reruns agree."""
    order = Window.partitionBy(key).orderBy(F.col(by).desc_nulls_last(), F.xxhash64(*df.columns))
    return df.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def arg_max(value: Column, by: Column, where: Column) -> Column:
    """The value of the row with the largest ``by`` among those that have one; ties go to the larger value."""
    return F.max(F.when(where & value.isNotNull(), F.struct(by.alias("by"), value.alias("value"))))["value"]


def first_by(value: Column, *order: Column) -> Column:
    """The value of the first row by ``order``, nulls last, among those that have one."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(k for o in order for k in (o.isNull(), o))]
    return F.min(F.when(value.isNotNull(), F.struct(*keys, value.alias("value"))))["value"]


def rows_of(one: DataFrame, name: str, value: str, kind: str = "double") -> DataFrame:
    """The columns of a one-row frame as rows, in order; null values go."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast(kind).alias(value)) for c in one.columns])
    return one.select(F.inline(pairs)).filter(F.col(value).isNotNull())


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """One row for each of ``values`` of each row."""
    return df.unpivot(ids, values, name, value)


def top(df: DataFrame, n: int, by: str) -> DataFrame:
    """The ``n`` rows of largest ``by``; nulls last, ties in the order of the other columns.  Each task keeps ``n`` rows."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in df.columns if c != by]).limit(n)


def with_shares(df: DataFrame, shares: dict[str, tuple[str, int]]) -> DataFrame:
    """``df`` with percentages of the totals over all rows: ``{new column: (column, digits)}``.

    The totals are an aggregate of one row, which meets every row by a broadcast; no task holds all rows.
    """
    values = list(dict.fromkeys(c for c, _ in shares.values()))
    total = df.agg(*[F.sum(F.col(c).cast("double")).alias(f"__t_{c}") for c in values])
    out = df.join(F.broadcast(total))  # one row
    out = out.withColumns({n: F.round(F.try_divide(100.0 * F.col(c).cast("double"), F.col(f"__t_{c}")), d) for n, (c, d) in shares.items()})
    return out.drop(*[f"__t_{c}" for c in values])


def join_reference(df: DataFrame, places: DataFrame, corrections: DataFrame, population: str, state: str = "uf", name: str = "nome_municipio") -> DataFrame:
    """Attributes of the reference table, by corrected code first and by name key otherwise; no row is lost."""
    attrs = ["codigo_ibge", "nome", "regiao_imediata", "regiao_intermediaria", population, "latitude", "longitude"]
    ref = places.select("uf", *attrs, name_key("nome").alias("chave"))
    fix = small(corrections.select(F.col("uf").alias("__u"), name_key("nome_cno").alias("__k"), F.col("codigo_ibge").alias("__c")))
    by_code = small(ref.select(*[F.col(a).alias(f"__c_{a}") for a in attrs]))
    by_name = small(ref.select(F.col("uf").alias("__mu"), F.col("chave").alias("__mk"), *[F.col(a).alias(f"__m_{a}") for a in attrs]))
    out = df.withColumn("__key", name_key(name))
    out = out.join(fix, (F.col("__u") == F.col(state)) & (F.col("__k") == F.col("__key")), "left")
    out = out.join(by_code, F.col("__c_codigo_ibge") == F.col("__c"), "left")
    out = out.join(by_name, (F.col("__mu") == F.col(state)) & (F.col("__mk") == F.col("__key")), "left")

    def either(a: str) -> Column:
        return F.coalesce(f"__c_{a}", f"__m_{a}")

    return out.select(
        *df.columns, F.coalesce("__c", "__m_codigo_ibge").alias("codigo_ibge"), either("nome").alias("nome_ibge"),
        either("regiao_imediata").alias("regiao_imediata"), either("regiao_intermediaria").alias("regiao_intermediaria"),
        either(population).alias("populacao"), either("latitude").alias("latitude_municipio"), either("longitude").alias("longitude_municipio"),
        F.col("__c").isNotNull().alias("casou_por_correcao"))
