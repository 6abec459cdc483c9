"""Document fingerprints by content-defined chunking, and a containment measure between them.

A gear hash over the last ``LEAST`` bytes decides where a chunk ends.  Chunking is normalised: from ``LEAST`` to
``NORMAL`` bytes a place must pass the harder of two masks, from there to ``MOST`` bytes the easier one, so
lengths gather around ``NORMAL``.  The hash never sees bytes before its chunk, so after an insertion or a cut the
boundaries fall where they fell before: chunks are shift-resistant.  A fingerprint is the set of its chunks'
digests with their lengths; what share of one text's bytes, in distinct chunks, is found in another is read off two
fingerprints alone (``containment``).

``compare_next`` meets every row with the one that follows in descending order of ids.  Keys without texts are
sorted first, which gives each range of the order its first row; texts are then shuffled once, to their range, the
first row of each also to the range before it, and sorted inside.  No text is gathered: a task streams over its rows.

Defined cases: a null text is as an empty one, whose fingerprint is empty; an empty text is contained in an empty
one wholly and in any other not at all; rows of one id follow each other by the hash of their text, repeated rows
one after the other; rows without an id come last; after the last row comes the first, and a single row follows
itself; a text shorter than a chunk is one chunk; whole texts count; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shingles import BLOCK, _power, mix

LEAST, NORMAL, MOST = 16, 32, 128
#: Top bits of a 16-bit gear hash that must be zero: one place in 128 before the normal length, one in 8 after it.
HARD, EASY = np.uint16(0xFE00), np.uint16(0xE000)

_random = np.random.default_rng(20240613)
GEAR = _random.integers(0, 1 << 16, 256, np.uint16)
_value = _random.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def gear(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash at each byte: ``h = 2 * h + GEAR[byte]``, which the last 16 bytes decide."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):
        h[k:] += h[:-k] << np.uint16(k)
    return h


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the chunks of texts start that lie in ``data`` one after the other, text k up to ``bounds[k]``; the length
    of all at the end.  No chunk ends inside a UTF-8 character.

    Data are taken in pieces of about a block; a piece's last chunks, which later bytes could change, go to the next.
    Places that pass a mask are few; a chunk's end is looked up among them.
    """
    out, at = [0], 0
    texts = iter(bounds.tolist())
    end = next(texts)
    while at < len(data):
        piece = data[at:at + BLOCK]
        n = len(piece)
        h = gear(piece)
        whole = np.ones(n, bool)  # a character ends here
        whole[:-1] = (piece[1:] & 0xC0) != 0x80
        easy = np.flatnonzero(whole & ((h & EASY) == 0))
        hard = [*easy[(h[easy] & HARD) == 0].tolist(), n]
        easy = [*easy.tolist(), n]
        stop = n if at + n == len(data) else n - 2 * MOST
        here = k = j = 0
        while here < stop:
            while end <= at + here:
                end = next(texts)
            k = bisect.bisect_left(hard, here + LEAST - 1, k)
            last = hard[k] if k < len(hard) else n
            if last >= here + NORMAL - 1:
                j = bisect.bisect_left(easy, here + NORMAL - 1, j)
                last = easy[j] if j < len(easy) else n
                if last >= here + MOST - 1:
                    last = min(here + MOST - 1, n)
                    while last < n and not whole[last]:
                        last += 1
            here = min(last + 1, end - at, n)
            out.append(at + here)
        at += here
    return np.array(out)


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """Of each text the sorted set of its chunks: 56 bits of digest, 8 bits of length."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum([len(t) for t in texts])
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in texts]
    starts = chunk_starts(data, bounds)
    digests = np.empty(len(starts) - 1, np.uint64)
    for i in range(0, len(starts) - 1, BLOCK // MOST):  # running sums over a block at most
        edge = starts[i:i + BLOCK // MOST + 1]
        part = data[edge[0]:edge[-1]]
        edge = edge - edge[0]
        power, inverse = _power(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_value[part] * power[:-1], out=total[1:])
        length = np.diff(edge).astype(np.uint64)
        digests[i:i + len(length)] = mix((total[edge[1:]] - total[edge[:-1]]) * inverse[edge[:-1]] + length) & ~np.uint64(0xFF) | length
    cuts = np.searchsorted(starts, bounds)
    return [np.unique(digests[a:b]) for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The share of ``a``'s bytes, in distinct chunks, that ``b`` has too."""
    if not len(a):
        return float(not len(b))
    length = a & np.uint64(0xFF)
    return float(length[np.isin(a, b, assume_unique=True)].sum() / length.sum())


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def _output(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of each of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints = [as_text(f) for f in fingerprints([t.encode() for t in texts])]
            yield _output(doc_id=batch.column(0), n_chars=pa.array([len(t) for t in texts], pa.int64()), fingerprint=pa.array(prints, pa.string()))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _order() -> list[Column]:
    return [F.col("doc_id").desc_nulls_last(), F.col("hash").asc()]


def in_order(docs: DataFrame) -> DataFrame:
    """``range, again, doc_id, text``: rows in descending order of ids, a range of the order to a partition.

    The row after a range's last one stands at its end once more, with ``again`` true.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select("doc_id", "hash").repartitionByRange(parts, *_order()).withColumn("p", F.spark_partition_id())
    # a row's place in the order as numbers that ascend: has no id, id downwards, hash
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("down"), "hash")
    firsts = sorted(tuple(r["key"]) for r in keys.groupBy("p").agg(F.min(key).alias("key")).collect())  # one a range, however many rows
    shared = spark.sparkContext.broadcast(firsts)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ranges(none: pd.Series, down: pd.Series, hashes: pd.Series) -> pd.Series:
        firsts, out = shared.value, []
        for key in zip(none.tolist(), down.tolist(), hashes.tolist(), strict=True):
            r = bisect.bisect_right(firsts, key) - 1
            out.append([r, (r - 1) % len(firsts)] if firsts[r] == key else [r])
        return pd.Series(out)

    dealt = docs.withColumn("ranges", ranges(F.col("doc_id").isNull(), F.bitwise_not(F.coalesce("doc_id", F.lit(0))), "hash"))
    dealt = dealt.select("doc_id", "hash", "text", F.posexplode("ranges").alias("again", "range"))
    return dealt.repartitionById(max(1, len(firsts)), "range").sortWithinPartitions("range", "again", *_order()).select("range", (F.col("again") == 1).alias("again"), "doc_id", "text")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_next(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and what of its own is contained in that and in the next text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the row that waits for the next one
        for rows in _blocks(batches):
            pairs = []
            for (at, again, i, text), own in zip(rows, fingerprints([text.encode() for *_, text in rows]), strict=True):
                row = at, i, text, own
                if before is not None and before[0] == at:
                    pairs.append((before, row))
                before = None if again else row
            if pairs:
                yield _compared(pairs)

    return in_order(docs).mapInArrow(run, _COMPARED)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows, their text last, in runs of about a block of text."""
    rows, held = [], 0
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            rows.append(tuple(x.as_py() for x in row))
            held += len(rows[-1][-1])
            if held >= BLOCK:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


_SCHEMA = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t]) for n, t in (c.split() for c in _COMPARED.split(", "))])


def _compared(pairs: list[tuple[tuple, tuple]]) -> pa.RecordBatch:
    changed = [edited(row[2], following[2]).encode() for row, following in pairs]
    out = [{"doc_id": i, "n_chars": len(text), "edited_sha256": hashlib.sha256(data).hexdigest(), "fingerprint": as_text(own),
            "edited_fingerprint": as_text(other), "near_edited": containment(own, other), "near_next": containment(own, following[3])}
           for ((_, i, text, own), following), data, other in zip(pairs, changed, fingerprints(changed), strict=True)]
    return pa.RecordBatch.from_pylist(out, _SCHEMA)
