"""Shards stay even however page ids are spread."""

from pyspark.sql import functions as F

from lodestone.llm import warc

FAR = 1 << 63


def test_far_ids_shared_ids_and_nulls(spark, tmp_path):
    rows = [(-FAR, "u", "a" * 2000), (FAR - 1, "u", "b" * 3000), (None, "u", None), (None, None, "x" * 1500)]
    rows += [(i, f"u{i}", f"p{i % 700} " * 400) for i in range(900)] + [(7, f"w{i}", f"q{i} " * 300) for i in range(700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    limit = 200_000
    meta = warc.thin(pages)
    shards = warc.Shards(meta, limit, 1)
    loads = meta.groupBy(shards.number(F.col("page_id"), F.col("digest")).alias("shard")).agg(F.sum(F.col("bytes") + 512).alias("load")).collect()
    assert len(loads) == shards.n > 10 and max(r["load"] for r in loads) <= 1.5 * limit
    root = f"file://{tmp_path}/warc"
    manifest = warc.write_warc(pages, root, shard_bytes=limit)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    back = warc.read_warc(spark, root)
    assert back.count() == len(rows) and {r["page_id"] for r in back.select("page_id").collect()} == {r[0] for r in rows}
    order = {r["shard"]: r for r in back.withColumn("shard", F.substring("file", 1, 8).cast("int")).groupBy("shard").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).collect()}
    edges = [(order[k]["a"], order[k]["b"]) for k in sorted(order) if order[k]["a"] is not None]
    assert all(x[1] <= y[0] for x, y in zip(edges, edges[1:]))
