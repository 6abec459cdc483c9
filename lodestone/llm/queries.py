"""The queries ``opN_<name>``: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, intervals, language, linededup, ngramjoin, packing, quality, search, secrets, toxicity, training, urlfilter, warc
from .common import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(of: int, left: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == left, F.lit(False))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    sample = training.sample(docs, labels.filter(~_held_out(5, 0)), "toxic", toxicity.PER_CLASS, toxicity.bag)
    return toxicity.fit_bags([b for b, _ in sample], [y for _, y in sample])


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity_model(spark, sf_dir)).select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s.ord < len(secrets.BASE))

    def count(order: int, kind: str) -> Column:  # one parameter: a second would be the element's place
        return F.size(F.filter("spans", lambda s: s.ord == F.lit(order))).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    counts = [count(i, r.kind) for i, r in enumerate(secrets.BASE)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("n_lines", F.size(F.split("text", "\n", -1)).cast("long"))
    out = linededup.dedup_lines(docs, drop_emptied=False)
    left = F.size(F.split("text", "\n", -1)).cast("long")
    return out.select("doc_id", "n_lines", F.when(F.col("text") == "", F.lit(0).cast("long")).otherwise(left).alias("n_left"), F.octet_length("text").cast("long").alias("bytes_left"), F.md5("text").alias("text_md5"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = [F.col(f"quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *q, "base_failed", "kept")


def language_model(docs: DataFrame) -> language.Model:
    sample = training.sample(docs.filter(~_held_out(4, 2)), None, "lang", language.PER_LANGUAGE, language.bag)
    return language.fit_bags([b for b, _ in sample], [x for _, x in sample])


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs, language_model(docs)).select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def url_list(pages: DataFrame) -> DataFrame:
    """A dated list for tests of scale: a rule over the hosts of ``pages`` says what is listed when.

    The first two bytes of a host's MD5 number it: one host in three is blocked from a day of 2024 on, half of
    these are removed 90 days later; one in five has the path ``/en`` allowed, one in seven its parent domain.
    """
    host = urlfilter.host_of(F.col("url"))
    hosts = pages.select(host.alias("h")).filter("h is not null").distinct()
    n = F.conv(F.substring(F.md5("h"), 1, 4), 16, 10).cast("int")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(n, F.lit(300)).cast("int"))
    numbered = hosts.select("h", n.alias("n"), day.alias("day"))
    parent = F.regexp_replace("h", r"^[^.]+\.", "")
    parts = [
        numbered.filter("n % 3 = 0").select(F.col("h").alias("entry"), F.col("day").alias("listed"), F.lit("block").alias("action")),
        numbered.filter("n % 6 = 0").select(F.col("h").alias("entry"), F.date_add("day", 90).alias("listed"), F.lit("remove").alias("action")),
        numbered.filter("n % 5 = 0").select(F.concat("h", F.lit("/en")).alias("entry"), F.col("day").alias("listed"), F.lit("allow").alias("action")),
        numbered.filter("n % 7 = 0").select(parent.alias("entry"), F.col("day").alias("listed"), F.lit("block").alias("action")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7, F.lit(366)).cast("int")))
    out = urlfilter.filter_urls(captures, url_list(pages))
    return out.select("page_id", "fetched", "listing.verdict", "listing.entry", "listing.since")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), root)
    return warc.read_warc(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_interval_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlaps(*(_table(spark, sf_dir, t) for t in ("sales", "sale_lines", "clicks")))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_next(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f) and k[2].isdigit()}
