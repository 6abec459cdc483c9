"""Exact quantiles, rules in shared passes, shares without a window over all rows."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators.quantiles import quantiles, with_quantiles
from lodestone.operators.relational import with_shares
from lodestone.plans import rules


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, float(rng.randrange(20)), rng.random() * 1e6, 3.0]), rng.randrange(-5, 5)) for _ in range(3000)] + [("c", None, 1), ("d", 2.5, None)]
    return rows, spark.createDataFrame(rows, "k string, v double, w int")


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_quantiles_of_groups(spark, values, parts):
    rows, df = values
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        wanted = {f"q{int(q * 100)}": (F.col("v"), q) for q in (0.0, 0.25, 0.5, 0.95, 1.0)} | {"w50": (F.col("w"), 0.5)}
        got = {r.k: r for r in with_quantiles(df.groupBy("k").count(), df, ["k"], wanted).collect()}
        whole = quantiles(df, [], wanted).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    for k in ("a", "b", "c", "d", None, "all"):
        own = [v for g, v, _ in rows if (g == k or k == "all") and v is not None]
        r = whole if k == "all" else got[k]
        for q in (0.0, 0.25, 0.5, 0.95, 1.0):
            assert r[f"q{int(q * 100)}"] == (pytest.approx(float(np.quantile(own, q)), rel=1e-12) if own else None)
        w = [x for g, _, x in rows if (g == k or k == "all") and x is not None]
        assert r.w50 == (statistics.median(w) if w else None)


def test_quantiles_of_nothing(spark, values):
    assert tuple(quantiles(values[1].limit(0), [], {"m": (F.col("v"), 0.5)}).first()) == (None,)
    assert quantiles(values[1].limit(0), ["k"], {"m": (F.col("v"), 0.5)}).collect() == []


def test_no_task_holds_a_group(spark):
    """All rows in one group: the ranges share them."""
    df = spark.range(40_000).select(F.lit(1).alias("k"), F.xxhash64("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # forty thousand rows would fit in one
    try:
        ranged = df.repartitionByRange("k", "v").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in ranged) < 10_000
    want = df.agg(F.percentile("v", 0.5)).first()[0]
    assert quantiles(df, ["k"], {"m": (F.col("v"), 0.5)}).first().m == want


def test_shares(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 3, None), ("c", 0, 6.0)], "k string, n int, v double")
    out = with_shares(df, {"p": ("n", 1), "q": ("v", 0)})
    assert sorted(map(tuple, out.collect())) == [("a", 1, 2.0, 25.0, 25.0), ("b", 3, None, 75.0, None), ("c", 0, 6.0, 0.0, 75.0)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def tables(spark, n):
    works = spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 4, "0").alias("cno"), *[F.lit("02").alias(c) for c in ("situacao_codigo",)], F.lit("Ativa").alias("situacao"), F.lit("SC").alias("uf"), F.lit("0070").alias("qualificacao_codigo"),
        *[F.lit(False).alias(f) for f in rules.FLAGS], F.lit(None).cast("string").alias("ni_responsavel"), F.lit("PF").alias("responsavel_tipo"), F.current_date().alias("data_inicio"), F.current_date().alias("data_situacao"),
        F.when(F.col("id") % 3 == 0, F.lit(-1.0)).otherwise(1.0).cast("decimal(18,2)").alias("area_total"))
    child = spark.range(n, n + 30).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("cno"), F.lit(1.0).alias("metragem"), F.current_date().alias("data_inicio"), F.current_date().alias("data_fim"))
    return {"obras": works.unionByName(works.limit(7)), "areas": child, "cnaes": child.limit(2), "vinculos": child.limit(0)}


def test_rules_share_their_passes(spark):
    t = tables(spark, 600)
    each = {r.name: r.violations(t).count() for r in rules.rules()}
    tracker, group = spark.sparkContext.statusTracker(), "rules"
    spark.sparkContext.setJobGroup(group, "")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else each shuffle is a job of its own
    try:
        out = rules.evaluate_all(rules.rules(), t)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {o.rule: o.violations for o in out} == each and [o.rule for o in out] == [r.name for r in rules.rules()]
    assert len(tracker.getJobIdsForGroup(group)) <= 6
    found = {o.rule: o.examples for o in out}
    assert [e["cno"] for e in found["obras.area_nao_negativa"]] == ["0000", "0000", "0003", "0003", "0006"] and found["obras.area_nao_negativa"][0]["area_total"] == "-1.00"
    assert [e["cno"] for e in found["areas.cno_existe_em_obras"]] == ["0600", "0601", "0602", "0603", "0604"] and found["obras.cno_unico"][0] == {"cno": "0000", "count": "2"}
    assert found["vinculos.cno_existe_em_obras"] == [] and rules.evaluate_all([], t) == []
