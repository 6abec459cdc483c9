"""Bounded samples of labelled texts, to fit the classifiers on.

The unit is a distinct text of an id, known by ``(doc_id, hash of the text)``: repeated rows count once, and an id
with many texts is many units.  Units of a label are ordered by a hash of both and the first ``per_label`` taken, so the
bound holds for units, whatever ids they have.  Only keys are counted and ranked; a cut on the hash, from
the labels' counts of units, leaves about twice as many as wanted before any are ranked, so no task meets a whole label.
The chosen keys are broadcast to one scan of the texts, where each text becomes its bag; only bags leave the
executors.

Defined cases: rows without id, text or label are no units; a unit with two labels counts under the lesser; a label
with fewer units than the bound has all of them; an empty table gives an empty sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_SPAN = 1 << 30


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    return docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), *more)


def sample(docs: DataFrame, labels: DataFrame | None, label: str, per_label: int, bag: Callable[[str], bytes | None]) -> list[tuple[bytes, object]]:
    """``(bag, label)`` of at most ``per_label`` texts of each label, in an order of their own.

    ``docs`` has doc_id and text, and the label too where ``labels`` (doc_id and label) is None.
    """
    spark = docs.sparkSession
    rows = _keyed(docs, label) if labels is None else _keyed(docs).join(labels.select("doc_id", label), "doc_id")
    units = rows.filter(F.col(label).isNotNull()).groupBy("doc_id", "hash").agg(F.min(label).alias(label))
    sizes = {r[label]: r["n"] for r in units.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    kind = dict(units.dtypes)[label]
    cuts = spark.createDataFrame([(k, min(_SPAN, -(-_SPAN * 2 * per_label // n) + _SPAN // n)) for k, n in sizes.items()], f"{label} {kind}, cut long")
    order = F.pmod(F.xxhash64("doc_id", "hash"), F.lit(_SPAN))
    near = units.join(F.broadcast(cuts), label).withColumn("order", order).filter("order < cut")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy(label).orderBy("order", "doc_id", "hash"))).filter(F.col("rank") <= per_label)
    chosen = {(r["doc_id"], r["hash"]): (r["order"], r[label]) for r in ranked.collect()}
    wanted = F.broadcast(spark.createDataFrame(list(chosen), "doc_id long, hash long"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()  # of a bounded list
        for batch in batches:
            rows = []
            for i, h, text in zip(*batch.columns, strict=True):
                key = i.as_py(), h.as_py()
                if key not in met:
                    met.add(key)
                    rows.append((*key, bag(text.as_py())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "hash", "bag"])

    found = _keyed(docs, "text").join(wanted, ["doc_id", "hash"]).mapInArrow(bags, "doc_id long, hash long, bag binary")
    once = found.groupBy("doc_id", "hash").agg(F.max("bag").alias("bag")).filter("bag is not null").collect()
    return [(bytes(r["bag"]), chosen[r["doc_id"], r["hash"]][1]) for r in sorted(once, key=lambda r: (chosen[r["doc_id"], r["hash"]][0], r["doc_id"], r["hash"]))]
