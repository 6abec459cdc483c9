"""Line dedup: a suffix array over line ids by distributed prefix doubling; maximal repeated runs go where they stand again.

The corpus is a sequence of line ids (128-bit hashes), document by document.  All steps are sorts of tables:

1. *Ranks.*  :func:`ranked` sorts places by (key, place) over range partitions and gives each the number of rows
   before the first of equal key, its rank, and whether an equal key stands at an earlier place.  The place is part
   of the order, so places that share a key, however many, lie in many partitions; what a partition must know of
   the one before it is one row a partition on the driver.  Nothing is joined or grouped by a line or a run.
2. *Prefix doubling.*  Round 0 ranks the lines; round k+1 ranks the places by the pair of the ranks of the runs of
   ``2^k`` lines at the place and ``2^k`` lines on.  Ranks keep the lexicographic order of the runs: a round is the
   suffix array sorted by its first ``2^(k+1)`` lines.  Places whose run occurs once are discarded, since nothing
   longer from there repeats, and the rounds end when no run repeats.
3. *Longest-common-prefix intervals.*  Places of equal rank are an interval of the array with at least that common
   prefix.  From the deepest round down, each interval is split by the rank of the next ``2^j`` lines.  A place that
   has an earlier one beside it in its part goes on in the part, with a prefix longer by ``2^j``; else it stays.  The
   first of a part goes along as a witness.  At the end each place has the length of the longest run from there that
   also stands at an earlier place.
4. *Runs.*  Of these lengths, those of at least ``min_words`` words count; overlapping ones of a document unite to
   maximal runs, and their lines go.

Before the doubling, lines that occur once in the corpus go: no repeated run holds one.  What is left is cut into
stretches of neighbouring lines, and stretches of under ``min_words`` words go.  A place stops going down once it
can no longer reach that many words.

A line goes if it lies in a run of at least ``min_words`` words whose lines also stand, in the same order,
at an earlier place (by doc_id, then hash of the text, then line).  Blank lines neither count nor part runs;
they go with nothing.

Defined cases: null texts stay null; empty texts and texts of under ``min_words`` words lose nothing; rows
with the same doc_id and text count as one document and are treated alike; a null doc_id counts as the least; an
empty table stays empty; extra columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import doc_key, drop_scratch, drop_scratch_since, materialise, scratch_mark, words_of

MIN_WORDS = 50
#: A place of the corpus: document, then its text, then the line's number among the non-blank ones.
PLACE = ["doc", "text", "seq"]
#: Lines to take out up to which the decisions are broadcast to the texts (some 4 bytes each).
BROADCAST_GONE = 4_000_000


def _doc():
    """``doc_id`` (null as the least) and a hash of the text."""
    doc, text = doc_key()
    return F.coalesce(doc.cast("long"), F.lit(-(1 << 63))).alias("doc"), text.alias("text")


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc, text, seq, pos, a, b, w``: the non-blank lines; seq counts them, pos counts all."""
    split = docs.select(*_doc(), F.split("text", "\n", -1).alias("l")).filter(F.col("l").isNotNull())
    cut = split.select("doc", "text", F.filter(F.transform("l", lambda x, i: F.struct(
        i.alias("pos"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), F.size(words_of(x)).alias("w"))), lambda s: s.w > 0).alias("l"))
    return cut.select("doc", "text", F.posexplode("l").alias("seq", "x")).select(*PLACE, "x.*")


def _numbered(n: int):
    """Rows sorted by key and place in, whose first ``n`` columns are the key; each place once out, with partition, row, first row of the key, and whether it
    is the last row of its key in the partition.  At the end three rows sum the partition up: row -1 has the first key and in
    ``at`` the number of rows, row -2 the last key and its first row, row -3 the number of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, before, head, row, start, distinct = None, None, None, 0, 0, 0
        for batch in chain(batches, [None]):
            table = held if batch is None else pa.Table.from_batches([*(held.to_batches() if held is not None else []), batch])
            if table is not None and table.num_rows > 1:  # a repeated row is one place; its copies lie beside it
                whole = [table.column(c).to_numpy() for c in (*range(n), *PLACE)]
                table = table.filter(pa.array(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in whole], axis=0)])))
            take = table.num_rows - (batch is not None) if table is not None else 0  # the last row waits for the next
            if take <= 0:
                held = table
                continue
            keys = [table.column(c).to_numpy() for c in range(n)]
            new = np.ones(table.num_rows + 1, bool)
            new[1:-1] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            new[0] = before is None or any(k[0] != x for k, x in zip(keys, before, strict=True))
            rows = row + np.arange(take)
            at = np.maximum.accumulate(np.where(new[:take], rows, start))
            out = table.slice(0, take).combine_chunks().to_batches()[0]
            names = [*out.schema.names, "part", "row", "at", "last"]
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.full(take, part, np.int32)), pa.array(rows), pa.array(at), pa.array(new[1:take + 1])], names)
            head = [k[0] for k in keys] if head is None else head
            before, start, row, held, distinct = [k[take - 1] for k in keys], int(at[-1]), row + take, table.slice(take), distinct + int(new[:take].sum())
        if row:
            own = [pa.array([a, b, b], out.schema.field(c).type) for c, (a, b) in enumerate(zip(head, before, strict=True))]
            rest = [pa.nulls(3, f.type) for f in list(out.schema)[n:]]
            yield pa.RecordBatch.from_arrays([*own, *rest, pa.array([part] * 3, pa.int32()), pa.array([-1, -2, -3]), pa.array([row, start, distinct]), pa.nulls(3, pa.bool_())], names)

    return run


def ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A written table of ``df`` with ``rank``: the rows of a lesser key; ``later``: the key stands at an earlier place;
    ``alone``: no other place has the key.  Keys and places hold no null.  Its attribute ``repeated`` counts the places that
    share a key with an earlier one.

    The writing pass also sums up each partition, in three rows that the driver reads: no further pass over the table.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = df.select(*keys, *rest).repartitionByRange(*keys, *PLACE).sortWithinPartitions(*keys, *PLACE)
    schema = ", ".join(f"{c} {t}" for c, t in ordered.dtypes) + ", part int, row long, at long, last boolean"
    held = materialise(ordered.mapInArrow(_numbered(len(keys)), schema), name)
    sums: dict[int, dict] = {}
    for r in held.filter("row < 0").select("part", "row", "at", F.struct(*keys).alias("key")).collect():
        sums.setdefault(r["part"], {})[r["row"]] = r["at"], r["key"]
    bounds, offset, rank, repeated, before = [], 0, None, 0, None
    parts = sorted(sums)
    for i, part in enumerate(parts):
        (n, head), (tail_at, tail), (distinct, _) = (sums[part][k] for k in (-1, -2, -3))
        goes_on = before is not None and head == before
        carried = rank if goes_on else None
        bounds.append((part, offset, carried, tail_at, i + 1 < len(parts) and sums[parts[i + 1]][-1][1] == tail))
        rank = carried if goes_on and tail_at == 0 else offset + tail_at
        repeated += n - distinct + goes_on
        offset, before = offset + n, tail
    edges = df.sparkSession.createDataFrame(bounds, "part int, offset long, carried long, tail_at long, more boolean")
    out = held.filter("row >= 0").join(F.broadcast(edges), "part")
    carried = (F.col("at") == 0) & F.col("carried").isNotNull()
    out = out.withColumns({
        "rank": F.when(carried, F.col("carried")).otherwise(F.col("offset") + F.col("at")), "later": carried | (F.col("row") > F.col("at")),
        "alone": F.col("last") & (F.col("row") == F.col("at")) & ~carried & ~(F.col("more") & (F.col("at") == F.col("tail_at")))})
    out = out.select(*df.columns, "rank", "later", "alone")
    out.scratch_path, out.repeated = held.scratch_path, repeated
    return out


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """``lines`` (PLACE, pos, w, rank, later) in stretches of neighbours of at least ``min_words`` words, with ``need``:
    how many lines from the place on have so many words, a very large number if the stretch ends before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(b.num_rows for b in held) < 100_000:
                    continue
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            doc, text, seq, w = (table.column(c).to_numpy() for c in (*PLACE, "w"))
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (seq[1:] != seq[:-1] + 1)
            stop = len(doc) if batch is None else int(np.flatnonzero(new)[-1])  # the last stretch may go on
            held = table.slice(stop).to_batches() if stop < len(doc) else []
            if not stop:
                continue
            starts = np.flatnonzero(new[:stop])
            number = np.cumsum(new[:stop]) - 1
            upto = np.cumsum(w[:stop].astype(np.int64))
            ends = np.append(starts[1:], stop)
            end = np.searchsorted(upto, upto - w[:stop] + min_words)
            need = np.where(end < ends[number], end - np.arange(stop) + 1, 1 << 30).astype(np.int32)
            words = np.add.reduceat(w[:stop].astype(np.int64), starts)
            out = table.slice(0, stop).append_column("need", pa.array(need)).filter(pa.array((words >= min_words)[number])).combine_chunks()
            yield from out.to_batches()

    dealt = lines.repartition("doc", "text").sortWithinPartitions(*PLACE)
    return dealt.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in dealt.dtypes) + ", need int")


def doubled(first: DataFrame) -> list[DataFrame]:
    """Rounds of prefix doubling: the k-th table has the places whose run of ``2^k`` lines occurs at least twice, with
    the run's ``r`` and whether it stands at an earlier place.  Rounds end with the last table that has rows."""
    levels = [first]
    while True:
        step = 1 << (len(levels) - 1)
        on = Window.partitionBy("doc", "text").orderBy("seq").rangeBetween(step, step)
        pairs = levels[-1].select(*PLACE, "need", "r", F.first("r").over(on).alias("r2")).filter("r2 is not null")
        sorted_ = ranked(pairs, ["r", "r2"], f"prefixes-{2 * step}")
        if not sorted_.repeated:
            return levels
        levels.append(sorted_.filter(~F.col("alone")).select(*PLACE, "need", F.col("rank").alias("r"), "later"))


def longest(levels: list[DataFrame]) -> DataFrame:
    """``doc, text, seq, len`` of the places from which a run of enough words also stands at an earlier place: the
    longest such run.  Walks the intervals from the deepest round down."""
    state = None
    for k in range(len(levels) - 1, -1, -1):
        table = levels[k]
        if state is not None:  # split the intervals by the next 2^k lines
            step = 1 << k
            nexts = table.select(F.col("doc").alias("__d"), F.col("text").alias("__t"), F.col("seq").alias("__s"), F.col("r").alias("r"))
            asked = state.join(nexts, (F.col("doc") == F.col("__d")) & (F.col("text") == F.col("__t")) & (F.col("seq") + F.col("len") == F.col("__s")), "left")
            asked = asked.select(*PLACE, "need", "len", "g", "own", F.coalesce("r", F.lit(-1)).alias("r"))
            parts = ranked(asked, ["len", "g", "r"], f"intervals-{step}")
            goes = F.col("later") & (F.col("r") >= 0)
            row = F.struct((F.col("len") + F.when(goes & F.col("own"), step).otherwise(0)).cast("int").alias("len"), F.when(goes & F.col("own"), F.col("rank")).otherwise(F.col("g")).alias("g"), "own")
            witness = F.when((F.col("r") >= 0) & ~F.col("later") & ~F.col("alone"), F.struct((F.col("len") + step).cast("int").alias("len"), F.col("rank").alias("g"), F.lit(False).alias("own")))
            state = parts.select(*PLACE, "need", F.explode(F.array_compact(F.array(row, witness))).alias("x")).select(*PLACE, "need", "x.*")
        # places that go no deeper than this round begin here, the first of each interval as its witness
        deeper = levels[k + 1].filter("later").select(*PLACE, F.lit(True).alias("deep")) if k + 1 < len(levels) else None
        fresh = table if deeper is None else table.join(deeper, PLACE, "left").filter("deep is null")
        fresh = fresh.select(*PLACE, "need", F.lit(1 << k).alias("len"), F.col("r").alias("g"), F.col("later").alias("own"))
        state = fresh if state is None else state.unionByName(fresh)
        # a place gains under 2^k lines from here on; an interval without a place of its own needs no witness
        state = state.filter(~F.col("own") | (F.col("len") + ((1 << k) - 1) >= F.col("need")))
    return state.filter("own and len >= need").select(*PLACE, "len")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, text, gone``: positions of the lines that go, in order, of documents that lose any."""
    lines = materialise(lines_of(docs), "lines")
    ids = ranked(lines, ["a", "b"], "line-ids")
    twice = ids.filter(~F.col("alone")).select(*PLACE, "pos", "w", "rank", "later")
    kept = materialise(stretches(twice, min_words), "stretches")
    drop_scratch(lines)
    found = longest(doubled(kept.select(*PLACE, "need", F.col("rank").alias("r"), "later")))
    at = Window.partitionBy("doc", "text").orderBy("seq")
    reach = F.max(F.col("seq") + F.col("len")).over(at.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("new", F.coalesce(F.col("seq") > reach, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(at))
    runs = runs.groupBy("doc", "text", "run").agg(F.min("seq").alias("first"), F.max(F.col("seq") + F.col("len") - 1).alias("end"))
    seqs = runs.select("doc", "text", F.explode(F.sequence("first", "end")).alias("seq"))
    gone = kept.select(*PLACE, "pos").join(seqs, PLACE, "left_semi")
    return gone.groupBy("doc", "text").agg(F.sort_array(F.collect_list("pos")).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = True) -> DataFrame:
    """``docs`` without their repeated runs of lines; a document that loses its last word goes too."""
    mark = scratch_mark()
    gone = materialise(repeats(docs, min_words), "gone")
    drop_scratch_since(mark, gone)
    small = (gone.agg(F.sum(F.size("gone") + 8)).first()[0] or 0) <= BROADCAST_GONE
    keyed = docs.select(F.struct("*").alias("__row"), *_doc()).join(F.broadcast(gone) if small else gone, ["doc", "text"], "left")
    lines = F.split("__row.text", "\n", -1)
    keyed = keyed.withColumn("__l", F.when(F.col("gone").isNotNull(), lines))
    keyed = keyed.withColumn("__k", F.expr("case when gone is not null then array_except(sequence(0, size(__l) - 1), gone) end"))
    text = F.when(F.col("gone").isNull(), F.col("__row.text")).otherwise(F.array_join(F.transform("__k", lambda i: F.get("__l", i)), "\n"))
    out = keyed.withColumn("__text", text)
    if drop_emptied:
        out = out.filter(F.col("gone").isNull() | F.col("__text").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(F.col("__row").withField("text", F.col("__text")).alias("__row")).select("__row.*")
