"""Queries that run the engine's operators on star-schema tables, each with the SQL for its result."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import domains as D
from ..functions import columns as X
from ..functions import olc
from ..operators import quantiles as exact
from ..operators.relational import arg_max, first_by, join_reference, latest, rows_of, small, with_shares


Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}
_c = F.col


def query(sql: str) -> Callable[[Callable], Callable]:
    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        _queries[f.__name__], _sql[f.__name__] = run, sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _case(*pairs, otherwise: Column) -> Column:
    return reduce(lambda w, p: w.when(*p), pairs[1:], F.when(*pairs[0])).otherwise(otherwise)


def _k() -> Column:
    return _c("o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN NULL ELSE o_orderpriority END AS t FROM orders""")
def clean_text(t):
    dirty = _case((_k() % 4 == 0, F.lit("  ")), (_k() % 4 == 1, F.lit("")), (_k() % 4 == 2, F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))), otherwise=_c("o_orderpriority"))
    return t("orders").select("o_orderkey", X.text(dirty).alias("t"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN NULL ELSE o_orderdate::DATE END AS d FROM orders""")
def clean_date(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    dirty = _case((_k() % 6 == 0, F.lit("1970-01-01")), (_k() % 6 == 1, F.lit("1900-01-01")), (_k() % 6 == 2, F.lit("2020-02-30")), (_k() % 6 == 3, F.lit("n/d")), (_k() % 6 == 4, F.concat(F.lit(" "), day)), otherwise=day)
    return t("orders").select("o_orderkey", X.date(dirty).alias("d"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 1000) + 0.25 END::DOUBLE AS n FROM orders""")
def clean_number(t):
    dirty = _case((_k() % 3 == 0, F.lit("x1")), otherwise=F.concat(F.lit(" "), (_k() % 1000).cast("string"), F.lit(".25")))
    return t("orders").select("o_orderkey", X.number(dirty).cast("double").alias("n"))


_STATUS = {"F": "ENCERRADA", "O": "ATIVA"}


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ENCERRADA' WHEN 'O' THEN 'ATIVA' END AS label,
  o_orderstatus = 'O' AS active, o_orderpriority IS DISTINCT FROM '1-URGENT' AS other, o_totalprice > 200000 AS large FROM orders""")
def domain_flags(t):
    return t("orders").select("o_orderkey", X.label(_c("o_orderstatus"), _STATUS).alias("label"), X.flag(_c("o_orderstatus") == "O").alias("active"), (~_c("o_orderpriority").eqNullSafe("1-URGENT")).alias("other"), X.flag(_c("o_totalprice") > 200000).alias("large"))


@query("""SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'SP' WHEN 1 THEN 'SC' WHEN 2 THEN NULL ELSE 'PE' END AS uf FROM nation""")
def state_normal(t):
    n = _c("n_nationkey") % 4
    raw = _case((n == 0, F.lit(" são paulo ")), (n == 1, F.lit("sc")), (n == 2, F.lit("CHILE")), otherwise=F.lit("PERNAMBUCO"))
    return t("nation").select("n_nationkey", X.state(raw).alias("uf"))


@query("""SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def dedup_latest(t):
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderdate").withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return latest(orders, "o_custkey", "at").drop("at")


@query("""SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem""")
def distinct_rows(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()


@query("""WITH a AS (SELECT l_orderkey, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT END)::BIGINT AS returned,
    arg_max(l_partkey, (l_quantity, l_partkey)) FILTER (WHERE l_linestatus = 'O') AS largest FROM lineitem GROUP BY 1)
  SELECT o_orderkey, coalesce(n, 0)::BIGINT AS n, returned, largest FROM orders LEFT JOIN a ON l_orderkey = o_orderkey""")
def child_collapse(t):
    agg = t("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.sum(F.when(_c("l_returnflag") == "R", _c("l_quantity").cast("long"))).alias("returned"),
        arg_max(_c("l_partkey"), _c("l_quantity"), _c("l_linestatus") == "O").alias("largest"))
    return t("orders").join(agg, _k() == _c("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "returned", "largest")


@query("""SELECT l_orderkey, l_partkey AS part FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate NULLS LAST, l_partkey) AS r FROM lineitem) WHERE r = 1""")
def primary_code(t):
    return t("lineitem").groupBy("l_orderkey").agg(first_by(_c("l_partkey"), _c("l_shipdate"), _c("l_partkey")).alias("part"))


@query("""SELECT o_orderkey, c_mktsegment, n_name, r_name, coalesce(a.n, 0)::BIGINT AS lines, CASE WHEN a.n > 4 THEN 'many' WHEN a.n > 0 THEN 'few' END AS size
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) a ON l_orderkey = o_orderkey""")
def wide_row(t):
    agg = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("k"))
    out = t("orders").join(agg, _k() == _c("l_orderkey"), "left").join(t("customer"), _c("c_custkey") == _c("o_custkey"), "left")
    out = out.join(small(t("nation")), _c("n_nationkey") == _c("c_nationkey"), "left").join(small(t("region")), _c("r_regionkey") == _c("n_regionkey"), "left")
    return out.select("o_orderkey", "c_mktsegment", "n_name", "r_name", F.coalesce("k", F.lit(0).cast("long")).alias("lines"), F.when(_c("k") > 4, "many").when(_c("k") > 0, "few").alias("size"))


_MEASURES = """count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done,
  sum((o_totalprice * 100)::DECIMAL(18, 0))::BIGINT AS cents, median(floor(o_totalprice)) AS middle"""


def _measures() -> list[Column]:
    return [
        F.count("*").alias("n"), F.count_if(_c("o_orderstatus") == "O").alias("n_open"), F.count_if(_c("o_orderstatus") == "F").alias("n_done"),
        F.sum((_c("o_totalprice") * 100).cast("decimal(18,0)")).cast("long").alias("cents"), F.median(F.floor("o_totalprice").cast("double")).alias("middle")]


@query(f"""SELECT n_name, year(o_orderdate) AS year, {_MEASURES} FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def mart_year(t):
    df = t("orders").join(t("customer"), _c("c_custkey") == _c("o_custkey")).join(small(t("nation")), _c("n_nationkey") == _c("c_nationkey"))
    return df.groupBy("n_name", F.year("o_orderdate").cast("long").alias("year")).agg(*_measures())


@query(f"""SELECT c_mktsegment, {_MEASURES} FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def mart_segment(t):
    return t("orders").join(t("customer"), _c("c_custkey") == _c("o_custkey")).groupBy("c_mktsegment").agg(*_measures())


_BAND_SQL = "CASE WHEN {0} < 70 THEN 'até 70 m²' WHEN {0} < 150 THEN '70 a 150 m²' WHEN {0} < 500 THEN '150 a 500 m²' WHEN {0} < 5000 THEN '500 a 5.000 m²' WHEN {0} IS NOT NULL THEN 'acima de 5.000 m²' END"


@query(f"""SELECT {_BAND_SQL.format('o_totalprice / 50')} AS band, {_MEASURES} FROM orders GROUP BY 1""")
def mart_band(t):
    return t("orders").groupBy(X.area_band(_c("o_totalprice") / 50).alias("band")).agg(*_measures())


@query("""SELECT count(*) AS base, (SELECT sum(n)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus)) AS mart FROM orders""")
def mart_reconcile(t):
    orders = t("orders")
    total = orders.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n")).agg(F.sum("n").alias("mart"))
    return orders.agg(F.count("*").alias("base")).join(F.broadcast(total))


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orphans(t):
    return t("orders").join(t("lineitem").select("l_orderkey"), _k() == _c("l_orderkey"), "left_anti").select("o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def rule_unique(t):
    return t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


_RULE_SQL = {
    "rule_filled": "SELECT o_orderkey FROM orders WHERE o_custkey IS NULL",
    "rule_domain": "SELECT o_orderkey FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')",
    "rule_not_negative": "SELECT c_custkey FROM customer WHERE c_acctbal < 0",
    "rule_plausible": "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000",
    "rule_not_future": "SELECT o_orderkey FROM orders WHERE o_orderdate > DATE '2000-01-01'",
    "rule_dates_agree": "SELECT DISTINCT l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate",
    "rule_flags_filled": "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F') IS NULL OR (o_totalprice > 0) IS NULL",
}


@query(_RULE_SQL["rule_filled"])
def rule_filled(t):
    return t("orders").filter(_c("o_custkey").isNull()).select("o_orderkey")


@query(_RULE_SQL["rule_domain"])
def rule_domain(t):
    return t("orders").filter(_c("o_orderstatus").isNotNull() & ~_c("o_orderstatus").isin("F", "O")).select("o_orderkey")


@query(_RULE_SQL["rule_not_negative"])
def rule_not_negative(t):
    return t("customer").filter("c_acctbal < 0").select("c_custkey")


@query(_RULE_SQL["rule_plausible"])
def rule_plausible(t):
    return t("orders").filter("o_totalprice > 300000").select("o_orderkey")


@query(_RULE_SQL["rule_not_future"])
def rule_not_future(t):
    return t("orders").filter(_c("o_orderdate") > F.lit("2000-01-01").cast("timestamp")).select("o_orderkey")


@query(_RULE_SQL["rule_dates_agree"])
def rule_dates_agree(t):
    return t("lineitem").join(t("orders"), _k() == _c("l_orderkey")).filter("l_shipdate < o_orderdate").select("l_orderkey").distinct()


@query(_RULE_SQL["rule_flags_filled"])
def rule_flags_filled(t):
    return t("orders").filter(X.any_of([(_c("o_orderstatus") == "F").isNull(), (_c("o_totalprice") > 0).isNull()])).select("o_orderkey")


@query("""SELECT count(*) AS n, quantile_cont(l_extendedprice, 0.25) AS p25, median(l_extendedprice) AS p50, quantile_cont(l_extendedprice, 0.75) AS p75 FROM (SELECT floor(l_extendedprice)::DOUBLE AS l_extendedprice FROM lineitem)""")
def quantiles(t):
    price = F.floor("l_extendedprice").cast("double")
    return exact.with_quantiles(t("lineitem").agg(F.count("*").alias("n")), t("lineitem"), [], {"p25": (price, 0.25), "p50": (price, 0.5), "p75": (price, 0.75)})


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, quantile_cont(l_quantity::DOUBLE, 0.9) AS q90, median(l_extendedprice::DOUBLE) AS mid FROM lineitem GROUP BY ALL""")
def quantiles_by_group(t):
    """Few groups, each of a large share of all rows."""
    keys = ["l_returnflag", "l_linestatus"]
    return exact.with_quantiles(t("lineitem").groupBy(*keys).agg(F.count("*").alias("n")), t("lineitem"), keys, {"q90": (_c("l_quantity"), 0.9), "mid": (_c("l_extendedprice"), 0.5)})


@query("""SELECT least(floor(o_totalprice / 20000) * 20000, 300000)::DOUBLE AS start, count(*) AS n FROM orders WHERE o_totalprice > 0 GROUP BY 1""")
def histogram(t):
    start = F.least(F.floor(_c("o_totalprice") / 20000) * 20000, F.lit(300000)).cast("double")
    return t("orders").filter("o_totalprice > 0").groupBy(start.alias("start")).agg(F.count("*").alias("n"))


@query("""SELECT c_mktsegment, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS pct FROM customer GROUP BY 1""")
def share_of_total(t):
    return with_shares(t("customer").groupBy("c_mktsegment").agg(F.count("*").alias("n")), {"pct": ("n", 2)})


@query("""SELECT p_brand, count(*) AS n, sum(p_size)::BIGINT AS size, round(100.0 * sum(p_size) / sum(sum(p_size)) OVER (), 1)::DOUBLE AS pct FROM part GROUP BY 1""")
def share_of_value(t):
    return with_shares(t("part").groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("size")), {"pct": ("size", 1)})


@query("""SELECT what, n FROM (UNPIVOT (SELECT count(*)::BIGINT AS rows, count(DISTINCT o_custkey)::BIGINT AS customers, max(o_orderkey)::BIGINT AS last, NULL::BIGINT AS none FROM orders) ON COLUMNS(*) INTO NAME what VALUE n)""")
def unpivot_counts(t):
    return rows_of(t("orders").agg(F.count("*").alias("rows"), F.countDistinct("o_custkey").alias("customers"), F.max("o_orderkey").alias("last"), F.lit(None).cast("long").alias("none")), "what", "n", "long")


_LAG = "datediff('day', o_orderdate, l_shipdate)"


@query(f"""SELECT lag, n FROM (UNPIVOT (SELECT count(*) FILTER (WHERE {_LAG} < 0)::BIGINT AS before, count(*) FILTER (WHERE {_LAG} BETWEEN 0 AND 30)::BIGINT AS month,
  count(*) FILTER (WHERE {_LAG} BETWEEN 31 AND 365)::BIGINT AS year, count(*) FILTER (WHERE {_LAG} > 365)::BIGINT AS later FROM lineitem JOIN orders ON o_orderkey = l_orderkey) ON COLUMNS(*) INTO NAME lag VALUE n)""")
def lag_buckets(t):
    lag = F.datediff("l_shipdate", "o_orderdate")
    one = t("lineitem").join(t("orders"), _k() == _c("l_orderkey")).agg(F.count_if(lag < 0).alias("before"), F.count_if(lag.between(0, 30)).alias("month"), F.count_if(lag.between(31, 365)).alias("year"), F.count_if(lag > 365).alias("later"))
    return rows_of(one, "lag", "n", "long")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10""")
def topk(t):
    return t("orders").orderBy(_c("o_totalprice").desc_nulls_last(), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("""SELECT year(o_orderdate) AS year, count(*) AS n, min(o_orderdate) AS first FROM orders WHERE o_orderdate IS NOT NULL AND year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1""")
def year_series(t):
    year = F.year("o_orderdate").cast("long")
    return t("orders").filter(year.between(1996, 2000)).groupBy(year.alias("year")).agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first"))


_AB = D.OLC_ALPHABET


def _codes(t) -> DataFrame:
    k = _c("c_custkey")
    step = [k % 9, k % 18, k % 20, F.floor(k / 20) % 20, F.floor(k / 7) % 20, F.floor(k / 3) % 20, k % 19, k % 17, k % 13, k % 11]
    ch = [F.substring(F.lit(_AB), s.cast("int") + 1, F.lit(1)) for s in step]
    return t("customer").select("c_custkey", "c_nationkey", F.concat(*ch[:8], F.lit("+"), *ch[8:]).alias("code"), F.concat(*ch[4:8], F.lit("+"), *ch[8:]).alias("short"))


_UNITS = """SELECT c_custkey, c_nationkey, (k % 9) * 160000 + (k % 20) * 8000 + ((k // 7) % 20) * 400 + (k % 19) * 20 + (k % 13) AS lat,
  (k % 18) * 160000 + ((k // 20) % 20) * 8000 + ((k // 3) % 20) * 400 + (k % 17) * 20 + (k % 11) AS lon FROM (SELECT *, c_custkey AS k FROM customer)"""


@query(f"""SELECT c_custkey, lat::BIGINT AS lat, lon::BIGINT AS lon FROM ({_UNITS})""")
def pluscode_decode(t):
    """Whole cells of 1/8000 of a degree, from 90 S and 180 W."""
    lat, lon = olc.decode(olc.normal(F.concat(F.lit(" '"), F.lower("code"), F.lit('"'))))
    return _codes(t).select("c_custkey", F.floor((lat + 90) * 8000).alias("lat"), F.floor((lon + 180) * 8000).alias("lon"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'completo' WHEN 1 THEN 'curto' END AS kind FROM customer""")
def pluscode_classify(t):
    k = _c("c_custkey") % 4
    raw = _case((k == 0, _c("code")), (k == 1, _c("short")), (k == 2, F.lit("URBANO")), otherwise=F.concat("code", F.lit("\n")))
    return _codes(t).select("c_custkey", olc.kind(olc.normal(raw)).alias("kind"))


@query(f"""SELECT c_custkey, lat::BIGINT AS lat, lon::BIGINT AS lon FROM ({_UNITS})""")
def pluscode_recover(t):
    """A code's short form, recovered from an anchor a tenth of a degree off, gives the code's own cell."""
    lat, lon = olc.decode(_c("code"))
    at = _codes(t).withColumns({"y": lat, "x": lon})
    lat2, lon2 = olc.recover(_c("short"), _c("y") + 0.1, _c("x") - 0.1)
    return at.select("c_custkey", F.floor((lat2 + 90) * 8000).alias("lat"), F.floor((lon2 + 180) * 8000).alias("lon"))


@query(f"""SELECT c_nationkey, count(*) AS n, median(lat::DOUBLE) AS lat FROM ({_UNITS}) GROUP BY 1""")
def anchors(t):
    lat, _ = olc.decode(_c("code"))
    return _codes(t).withColumn("lat", F.floor((lat + 90) * 8000).cast("double")).groupBy("c_nationkey").agg(F.count("*").alias("n"), F.median("lat").alias("lat"))


@query("""SELECT c_custkey, floor(2 * 6371 * asin(sqrt(pow(sin(radians(b - a) / 2), 2) + cos(radians(a)) * cos(radians(b)) * pow(sin(radians(d - c) / 2), 2))))::BIGINT AS km
  FROM (SELECT c_custkey, (c_custkey % 90)::DOUBLE AS a, (c_custkey % 45)::DOUBLE AS b, (c_custkey % 180)::DOUBLE AS c, (c_custkey % 60)::DOUBLE AS d FROM customer)""")
def haversine(t):
    k = _c("c_custkey")
    return t("customer").select("c_custkey", F.floor(X.haversine_km(*[(k % m).cast("double") for m in (90, 180, 45, 60)])).alias("km"))


@query("""SELECT s_suppkey, upper(replace(replace(s_name, '#', ' '), '-', ' ')) || ' SAO D AGUA' AS key FROM (SELECT s_suppkey, regexp_replace(s_name, '[#-]+', '#', 'g') AS s_name FROM supplier)""")
def name_key(t):
    return t("supplier").select("s_suppkey", X.name_key(F.concat(F.regexp_replace("s_name", "[#-]+", "-"), F.lit("  são d'Água "))).alias("key"))


def _reference(t) -> tuple[DataFrame, DataFrame]:
    n = t("nation").select("n_nationkey", "n_name")
    places = n.select(
        F.lit("SC").alias("uf"), (_c("n_nationkey") + 1000).cast("string").alias("codigo_ibge"), _c("n_name").alias("nome"), F.lit("i").alias("regiao_imediata"),
        F.concat(F.lit("r"), (_c("n_nationkey") % 3).cast("string")).alias("regiao_intermediaria"), (_c("n_nationkey") * 10 + 10).cast("long").alias("populacao"),
        F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude")).filter("codigo_ibge <> '1003'")
    fixes = n.filter("n_nationkey in (3, 4)").select(F.lit("SC").alias("uf"), _c("n_name").alias("nome_cno"), F.when(_c("n_nationkey") == 3, "1005").otherwise("1006").alias("codigo_ibge"))
    return places, fixes


_REF = """WITH n AS (SELECT n_nationkey AS k, n_name FROM nation), m AS (SELECT k + 1000 AS code, n_name AS name, k % 3 AS r, k * 10 + 10 AS pop, k FROM n WHERE k <> 3),
 j AS (SELECT n.k, n.n_name, CASE n.k WHEN 3 THEN 1005 WHEN 4 THEN 1006 ELSE n.k + 1000 END AS code, n.k IN (3, 4) AS fixed FROM n)"""


@query(_REF + """ SELECT j.n_name, j.code::VARCHAR AS codigo_ibge, m.name AS nome_ibge, m.pop::BIGINT AS populacao, j.fixed AS casou_por_correcao FROM j LEFT JOIN m ON m.code = j.code""")
def reference_join(t):
    df = t("nation").select(F.lit("SC").alias("uf"), "n_name")
    out = join_reference(df, *_reference(t), "populacao", name="n_name")
    return out.select("n_name", "codigo_ibge", "nome_ibge", "populacao", "casou_por_correcao")


@query(_REF + """ SELECT count(*) AS names, count(m.code) AS matched, count(*) FILTER (WHERE j.fixed) AS fixed FROM j LEFT JOIN m ON m.code = j.code""")
def reference_coverage(t):
    df = t("nation").select(F.lit("SC").alias("uf"), "n_name")
    out = join_reference(df, *_reference(t), "populacao", name="n_name")
    return out.agg(F.count("*").alias("names"), F.count("codigo_ibge").alias("matched"), F.count_if("casou_por_correcao").alias("fixed"))


@query("""SELECT n_name, a.n AS orders, b.n AS customers, round(1000.0 * a.n / b.n, 1)::DOUBLE AS per_mille FROM nation
  JOIN (SELECT c_nationkey, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1) a ON a.c_nationkey = n_nationkey
  LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) b ON b.c_nationkey = n_nationkey""")
def per_capita(t):
    people = t("customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    bought = t("orders").join(t("customer"), _c("c_custkey") == _c("o_custkey")).groupBy("c_nationkey").agg(F.count("*").alias("orders"))
    out = bought.join(people, "c_nationkey", "left").join(small(t("nation")), _c("n_nationkey") == _c("c_nationkey"))
    return out.select("n_name", "orders", "customers", F.round(X.per(_c("orders"), _c("customers"), 1000.0), 1).alias("per_mille"))


@query("""SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 3 THEN 'A' WHEN p_size BETWEEN 5 AND 9 THEN 'B' WHEN p_size BETWEEN 10 AND 33 THEN 'C' WHEN p_size = 35 THEN 'D'
  WHEN p_size BETWEEN 36 AND 39 THEN 'E' WHEN p_size BETWEEN 41 AND 43 THEN 'F' WHEN p_size BETWEEN 45 AND 47 THEN 'G' WHEN p_size BETWEEN 49 AND 53 THEN 'H' END AS section FROM part""")
def activity_section(t):
    return t("part").select("p_partkey", X.section(F.lpad(_c("p_size").cast("string"), 2, "0"), 2).alias("section"))


@query("""SELECT 'orders' AS t, count(*) AS n, true AS ok FROM orders UNION ALL SELECT 'lineitem', count(*), true FROM lineitem""")
def reconcile_counts(t):
    """Rows read against the total published for the table, here the sum over a partition of it."""
    def one(name: str, key: str) -> DataFrame:
        parts = t(name).groupBy(F.pmod(F.xxhash64(key), F.lit(7))).agg(F.count("*").alias("n")).agg(F.sum("n").alias("published"))
        return t(name).agg(F.count("*").alias("n")).join(F.broadcast(parts)).select(F.lit(name).alias("t"), "n", (_c("n") == _c("published")).alias("ok"))

    return one("orders", "o_orderkey").unionByName(one("lineitem", "l_orderkey"))


@query("""SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n_areas, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS r FROM orders""")
def ranked_rows(t):
    w = Window.partitionBy("o_custkey")
    return t("orders").select("o_orderkey", F.count("*").over(w).alias("n_areas"), F.row_number().over(w.orderBy(_c("o_orderdate").asc_nulls_last(), "o_orderkey")).cast("long").alias("r"))


