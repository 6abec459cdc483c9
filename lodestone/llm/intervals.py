"""Interval overlap join: which click sessions of a client overlap each of its sales, and how.

Sessions come by lag and cumulative sum, three times over ever fewer rows, so that no task meets all clicks of
one client: clicks of one quarter of an hour (the gap) are one session whatever else happens, and become one
row by a map-side aggregate; lag and running sum join these rows inside a day; and once more the days' runs.
A client has at most 96 quarters a day, so the last window is bounded by the calendar, not by the clicks.

Only slots are compared.  Sessions of a client that start and end in the same slots are one class with their
number and the sum of their checksums, at most some three a slot and client.  Sales meet the classes by an
equi-join on client with the overlap of slots as predicate; a client with more than its share of all sales
(``PARTS``) is salted: its sales are dealt over parts and its classes repeated in each.  At most ``PARTS``
clients can have such a share, so the list of them has a proven bound and is broadcast.  CASE names the relation.

Defined cases: rows without client or time are left out, and a sale of no session has no row; a click without
kind is no error; of clicks at one time, one error makes it one; repeated clicks change nothing, repeated rows
of sales count one by one; lines without sale or time, and sales without lines, leave the end at the sale's own
time; timestamps are read as they stand on the clock, with or without a zone; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GAP = 15 * 60 * 1_000_000
DAY = 24 * 60 * 60 * 1_000_000
SLOT = 6 * 60 * 60 * 1_000_000
#: A client with more than one in so many of all sales is salted, into parts of about that size.
PARTS = 1000
#: End of an open interval, in slots; beyond every real one, and equal to itself.
OPEN_END = 1 << 61


def micros(name: str) -> Column:
    """Whole microseconds since 1970 of what the clock shows; no session's zone comes into it for times without one."""
    c = F.col(f"`{name}`")
    second = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_date(F.to_date(c)).cast("long") * DAY + F.hour(c).cast("long") * (3600 * 1_000_000) + F.minute(c).cast("long") * (60 * 1_000_000) + second


def _step(of: str, width: int) -> Column:
    """``of`` divided by ``width``, rounded down, in whole numbers."""
    return F.expr(f"({of} - pmod({of}, {width}L)) div {width}L")


def _joined(rows: DataFrame, within: list[str]) -> DataFrame:
    """Rows ``first, last2`` of the same ``within``, joined where no more than the gap lies between them."""
    ordered = Window.partitionBy(*within).orderBy("first")
    apart = F.col("first") - F.shiftright(F.lag("last2").over(ordered), 1) > GAP
    run = F.sum(F.when(apart, 1).otherwise(0)).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("run", run).groupBy(*within, "run").agg(F.min("first").alias("first"), F.max("last2").alias("last2")).drop("run")


def sessions(clicks: DataFrame) -> DataFrame:
    """``client_id, first, last`` (microseconds) and ``open`` of each session of ``clicks`` (client_id, ts, kind)."""
    known = clicks.filter("client_id is not null and ts is not null").select(
        "client_id", micros("ts").alias("us"), F.coalesce(F.col("kind") == "error", F.lit(False)).cast("long").alias("error"))
    # the last time and whether an error lies there, as one number
    quarters = known.groupBy("client_id", _step("us", GAP).alias("quarter")).agg(F.min("us").alias("first"), F.max(F.col("us") * 2 + F.col("error")).alias("last2"))
    days = _joined(quarters.select("client_id", _step("first", DAY).alias("day"), "first", "last2"), ["client_id", "day"])
    return _joined(days.drop("day"), ["client_id"]).select(
        "client_id", "first", F.shiftright("last2", 1).alias("last"), (F.pmod("last2", F.lit(2)) == 1).alias("open"))


def sale_intervals(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """``sale_id, client_id, first, last`` (microseconds) and ``open`` of each sale with client and time."""
    shipped = lines.filter("sale_id is not null and shipped_at is not null").select("sale_id", micros("shipped_at").alias("us")).groupBy("sale_id").agg(F.max("us").alias("shipped"))
    known = sales.filter("client_id is not null and sold_at is not null").select(
        "sale_id", "client_id", micros("sold_at").alias("first"), F.coalesce(F.col("status") == "open", F.lit(False)).alias("open"))
    return known.join(shipped.hint("merge"), "sale_id", "left").select(
        "sale_id", "client_id", "first", F.greatest("first", "shipped").alias("last"), "open")


def in_slots(intervals: DataFrame, *more: Column | str) -> DataFrame:
    """Intervals as inclusive slots ``from, to``; an open one ends at ``OPEN_END``."""
    return intervals.select("client_id", _step("first", SLOT).alias("from"), F.when(F.col("open"), F.lit(OPEN_END)).otherwise(_step("last", SLOT)).alias("to"), *more)


def relation(a: str, b: str) -> Column:
    """Allen's relation of interval ``a`` to ``b``, which share a slot."""
    start, end = F.signum(F.col(f"{a}.from") - F.col(f"{b}.from")), F.signum(F.col(f"{a}.to") - F.col(f"{b}.to"))
    names = {-1: ("overlaps", "finished_by", "contains"), 0: ("starts", "equals", "started_by"), 1: ("during", "finishes", "overlapped_by")}
    out = F.lit(None)
    for s, of_end in names.items():
        for e, name in zip((-1, 0, 1), of_end, strict=True):
            out = F.when((start == s) & (end == e), name).otherwise(out)
    return out


def overlaps(sales: DataFrame, lines: DataFrame, clicks: DataFrame, parts: int = PARTS) -> DataFrame:
    """Per sale and relation: ``sale_id, relation, n_pairs, overlap_slots, sessions_crc``."""
    checksum = F.crc32(F.col("first").cast("string").cast("binary"))
    classes = in_slots(sessions(clicks), checksum.alias("crc")).groupBy("client_id", "from", "to").agg(F.count("*").alias("n"), F.sum("crc").alias("crc"))
    # at most `parts` clients have more than total / parts of the sales: a bounded list
    known = sales.filter("client_id is not null and sold_at is not null")
    total = known.count()
    hot = known.groupBy("client_id").count().filter(F.col("count") * parts > total).select("client_id", F.ceil(F.col("count") * parts / F.lit(max(1, total))).cast("int").alias("salts"))
    dealt = in_slots(sale_intervals(sales, lines), "sale_id", "first").join(F.broadcast(hot), "client_id", "left").withColumn(
        "salt", F.pmod(F.xxhash64("sale_id", "first"), F.coalesce("salts", F.lit(1))).cast("int"))
    repeated = classes.join(F.broadcast(hot), "client_id", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    on = (F.col("s.client_id") == F.col("c.client_id")) & (F.col("s.salt") == F.col("c.salt")) & (F.col("s.from") <= F.col("c.to")) & (F.col("c.from") <= F.col("s.to"))
    pairs = dealt.alias("s").join(repeated.hint("merge").alias("c"), on).select("s.sale_id", relation("s", "c").alias("relation"), "c.n", "c.crc", *_shared())
    return pairs.groupBy("sale_id", "relation").agg(F.sum("n").alias("n_pairs"), F.sum(F.col("shared") * F.col("n")).alias("overlap_slots"), F.sum("crc").alias("sessions_crc"))


def _shared() -> list[Column]:
    """Slots that sale and class share; null where both are open."""
    to = F.least("s.to", "c.to")
    return [F.when(to < OPEN_END, to - F.greatest("s.from", "c.from") + 1).alias("shared")]
