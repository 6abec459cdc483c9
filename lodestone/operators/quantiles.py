"""Exact medians and quantiles in bounded memory.

``percentile`` and ``median`` hold all distinct values of a group in one buffer.  Here values are first counted where
they are read (equal ones become one row with their number), then range-partitioned by group and value.  Each range
counts its rows of each group; the ranges before it, one row a range and group, give every row its rank; and the
rows at the wanted ranks are picked.  A group of any size is spread over as many ranges as its values fill, no
task holds a group, and the result is exact: linear interpolation between the two nearest ranks, as a double.

Ranges must be the same when counted and when ranked, so the counted values are kept in the session's shared folder;
where it names none, the built-in percentile answers, with the same result and one buffer a group.

Nulls are left out; a group without values has null quantiles; a group key may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .relational import settled, shared_folder

Wanted = dict[str, tuple[Column, float]]


def quantiles(df: DataFrame, keys: list[str], wanted: Wanted) -> DataFrame:
    """One row of each group of ``keys`` that has a value, with a column for each of ``wanted``: a value and a share.

    Without keys there is one row, whatever the table holds.
    """
    if not shared_folder(df.sparkSession):
        return df.groupBy(*keys).agg(*[F.percentile(c.cast("double"), F.lit(float(share))).alias(name) for name, (c, share) in wanted.items()])
    measures = list(dict.fromkeys(repr(c) for c, _ in wanted.values()))
    columns = {repr(c): c for c, _ in wanted.values()}
    rows = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(k).alias("m"), columns[c].cast("double").alias("v")) for k, c in enumerate(measures)])).alias("__x"))
    counted = rows.select(*keys, "__x.m", "__x.v").filter("v is not null").groupBy(*keys, "m", "v").agg(F.count("*").alias("n"))
    by = [*keys, "m"]
    ranged = settled(counted.repartitionByRange(*by, "v").withColumn("range", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("range")
    pieces = ranged.groupBy(*by, "range").agg(F.sum("n").alias("piece"))
    starts = pieces.withColumns({
        "start": F.coalesce(F.sum("piece").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("piece").over(Window.partitionBy(*by))}).drop("piece")
    inside = Window.partitionBy(*by, "range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _null_safe(ranged.withColumn("upto", F.sum("n").over(inside)), starts, [*by, "range"])
    first, last = F.col("start") + F.col("upto") - F.col("n"), F.col("start") + F.col("upto") - 1

    def held(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, last), F.col("v")))

    picks = []
    for name, (c, share) in wanted.items():
        own = F.col("m") == measures.index(repr(c))
        at = (F.col("total") - 1) * F.lit(float(share))
        picks += [held(F.when(own, F.floor(at))).alias(f"__lo_{name}"), held(F.when(own, F.ceil(at))).alias(f"__hi_{name}"), F.max(F.when(own, at)).alias(f"__at_{name}")]
    out = ranked.groupBy(*keys).agg(*picks)
    for name in wanted:
        low, high, at = (F.col(f"__{p}_{name}") for p in ("lo", "hi", "at"))
        out = out.withColumn(name, F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high))
    return out.select(*keys, *wanted)


def with_quantiles(grouped: DataFrame, df: DataFrame, keys: list[str], wanted: Wanted) -> DataFrame:
    """``grouped``, one row a group of ``df``, with the group's quantiles."""
    if not keys:
        return grouped.crossJoin(quantiles(df, keys, wanted))  # one row each
    return _null_safe(grouped, quantiles(df, keys, wanted), keys, "left")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"__r_{c}" if c in keys else c) for c in right.columns])
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])
