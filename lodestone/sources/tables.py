"""CSV and snapshot scans, and the sink that replaces one snapshot.

A CSV file is read by as many tasks as it has splits, quoted line breaks or not.  A snapshot is a folder of
versions; which of them holds is said by a marker, whose creation is the only step of a replacement that readers see.
"""

from __future__ import annotations

import csv
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


class SourceError(RuntimeError):
    """A source that is missing, malformed or wrongly encoded."""


# text in single-byte encodings


def _table(encoding: str) -> tuple[str, str, str]:
    """``(from, to, undefined)``: how characters read as Latin-1 become those of a single-byte encoding."""
    was, now, undefined = "", "", ""
    for code in range(256):
        try:
            right = bytes([code]).decode(encoding)
        except UnicodeDecodeError:
            undefined += chr(code)
            continue
        if right != chr(code):
            was, now = was + chr(code), now + right
    return was, now, undefined


def _from_latin(c: Column, encoding: str) -> Column:
    """Text whose bytes were read as Latin-1, in its own encoding; pure ASCII takes the quick path."""
    was, now, _ = _table(encoding)
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(c, was, now)) if was else c


def _undefined(c: Column, encoding: str) -> Column:
    """Whether text read as Latin-1 holds bytes that the encoding leaves undefined."""
    *_, bad = _table(encoding)
    if not bad:
        return F.lit(False)
    return F.coalesce((F.octet_length(c) != F.char_length(c)) & c.rlike("[" + "".join(f"\\x{{{ord(x):x}}}" for x in bad) + "]"), F.lit(False))


def _single_byte(encoding: str) -> bool:
    try:
        return encoding.lower() not in ("ascii", "us-ascii") and b"\x41\x0a\x22".decode(encoding) == 'A\n"' and len(bytes([0xE9]).decode(encoding)) == 1
    except UnicodeDecodeError:
        return False


# CSV

#: Lines that a quoted field may go on for in the split after the one in which it starts; a longer one is an error.
LONGEST_FIELD = 1_000_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, at, value``: the lines of each split of each file, in order inside a split."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").cast("binary").alias("value"))


def broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field goes over a line's end: then some line holds an odd number of quotes."""
    odd = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2)) == 1
    return not spark.read.text(path).filter(odd).isEmpty()


def _odd(lines: pa.BinaryArray) -> np.ndarray:
    return (pc.count_substring(lines, b'"').to_numpy(zero_copy_only=False) & 1).astype(np.int8)


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """``((file, at), rows)`` of lines in order; a batch with rows of several splits is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, file = batch.column(1).to_numpy(), batch.column(0).dictionary_encode().indices.to_numpy()
        edges = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (file[1:] != file[:-1])) + 1).tolist(), batch.num_rows]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            yield (batch.column(0)[s].as_py(), int(at[s])), batch.slice(s, e - s)


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a split: whether its quotes are odd, and its lines up to the first with an odd number of them."""
    held: dict[tuple, list[bytes]] = {}
    parity: dict[tuple, int] = {}
    head: dict[tuple, bytes | None] = {}
    for key, rows in _by_split(batches):
        lines = rows.column(2)
        odd = _odd(lines)
        parity[key] = (parity.get(key, 0) + int(odd.sum())) % 2
        if key in head:
            continue
        before = held.setdefault(key, [])
        if odd.any():
            head[key] = b"\n".join([*before, *lines[: int(np.argmax(odd)) + 1].to_pylist()])
        elif len(before) + len(lines) > LONGEST_FIELD:
            head[key] = None
        else:
            before += lines.to_pylist()
            continue
        del held[key]
    rows = [(*key, odd, head.get(key)) for key, odd in parity.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["file", "at", "odd", "head"])


def _records(columns: list[str], encoding: str):
    """``file, at, value, inside, rest`` in; whole records without their file's header out.

    A split whose start lies ``inside`` a quoted field leaves that record to the split before; ``rest`` is what the
    next one leaves to it.
    """

    def check(header: bytes, file: str) -> None:
        names = next(csv.reader([header.decode(encoding).rstrip("\r")]), [])
        if names != columns:
            raise SourceError(f"{file}: the header is {names}, not {columns}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, rest, held, fresh, skip = None, None, [], False, False

        def closing() -> list[bytes]:
            if held and rest is None:
                raise SourceError(f"{split[0]}: a quoted field has no end")
            return [b"\n".join([*held, rest])] if held else []

        for key, rows in _by_split(batches):
            if key != split:
                if done := closing():
                    yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["record"])
                inside, rest = rows.column(3)[0].as_py(), rows.column(4)[0].as_py()
                if inside is None:
                    raise SourceError(f"{key[0]}: the splits of the file have changed since it was looked at")
                split, held, fresh, skip = key, [], key[1] == 0, bool(inside)
            lines = rows.column(2)
            odd = _odd(lines)
            if skip:  # up to the line that ends the field from the split before
                if not odd.any():
                    continue
                k = int(np.argmax(odd)) + 1
                lines, odd, skip = lines.slice(k), odd[k:], False
            within = int(bool(held))
            after = (np.cumsum(odd) + within) & 1
            before = np.concatenate([[within], after[:-1]]) if len(after) else after
            alone = (before == 0) & (after == 0)
            joined = []
            for k in np.flatnonzero(~alone).tolist():
                held.append(lines[k].as_py())
                if not after[k]:
                    joined.append(b"\n".join(held))
                    held = []
            if fresh and len(lines):
                if alone[0]:
                    check(lines[0].as_py(), key[0])
                    alone[0] = False
                elif joined:
                    check(joined.pop(0), key[0])
                else:
                    continue  # a header over more than a batch
                fresh = False
            if alone.any():
                yield pa.RecordBatch.from_arrays([lines.filter(pa.array(alone))], ["record"])
            if joined:
                yield pa.RecordBatch.from_arrays([pa.array(joined, pa.binary())], ["record"])
        if done := closing():
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["record"])

    return run


def _whole_records(spark: SparkSession, path: str, columns: list[str], encoding: str) -> DataFrame:
    """``record``: the records of files with quoted line breaks, each split read by its own task.

    Quotes are counted by split; the parity of those before it says whether a split starts inside a field.  What is
    gathered is one row a split, with the end of the one record that goes over the split's start.
    """
    lines = _lines(spark, path)
    splits = lines.mapInArrow(_parities, "file string, at long, odd long, head binary")
    ordered = Window.partitionBy("file").orderBy("at")
    inside = F.pmod(F.coalesce(F.sum("odd").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(2))
    known = splits.withColumn("inside", inside).withColumn("rest", F.lead(F.when(F.col("inside") == 1, F.col("head"))).over(ordered)).select("file", "at", "inside", "rest").collect()
    table = F.broadcast(spark.createDataFrame(known, "file string, at long, inside long, rest binary"))
    return lines.join(table, ["file", "at"], "left").select("file", "at", "value", "inside", "rest").mapInArrow(_records(columns, encoding), "record binary")


def read_csv(spark: SparkSession, path: str, columns: list[str], encoding: str = "windows-1252") -> DataFrame:
    """All columns as text.  Bytes that the encoding leaves undefined, ragged rows and other headers fail the read.

    Files are split over tasks.  A first pass over the lines finds whether a quoted field holds a line break; if so,
    records are put together from the lines of each split (``_whole_records``) and parsed one by one.
    """
    latin = _single_byte(encoding)
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    undefined = F.raise_error(F.lit(f"{path} holds bytes that {encoding} does not define")).cast("boolean")
    if broken_lines(spark, path):
        text = F.decode("record", "ISO-8859-1" if latin else encoding).alias("text")
        rows = _whole_records(spark, path, columns, encoding).select(text)
        if latin:
            rows = rows.filter(F.when(_undefined(F.col("text"), encoding), undefined).otherwise(True))
        text = F.replace(F.regexp_replace("text", r"\r$", ""), F.lit("\r\n"), F.lit("\n"))
        ddl = ", ".join("`" + c.replace("`", "``") + "` string" for c in columns)
        df = rows.filter(F.trim(text) != "").select(F.from_csv(text, ddl, options).alias("row")).select("row.*")
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        df = spark.read.schema(schema).options(**options).option("enforceSchema", False).csv(path, header=True, encoding="ISO-8859-1" if latin else encoding)
        if latin:
            bad = F.lit(False)
            for c in columns:
                bad |= _undefined(F.col(f"`{c}`"), encoding)
            df = df.filter(F.when(bad, undefined).otherwise(True))  # a filter holds whatever columns are read
    return df.select(*[_from_latin(F.col(f"`{c}`"), encoding).alias(c) for c in columns]) if latin else df


def c1_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``path, c1``: whether each file has bytes 0x80 to 0x9F.  Read line by line, so files of any size are split."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), F.decode(F.col("value").cast("binary"), "ISO-8859-1").rlike("[\\x{80}-\\x{9F}]").alias("c1"))
    return lines.groupBy("path").agg(F.bool_or("c1").alias("c1"))


# snapshots
#
# table/snapshot_date=<id>/v-<uuid>/...       the files of a version
# table/snapshot_date=<id>/commit-<n>-<uuid>  an empty marker: from here on version <uuid> holds; the largest n counts

#: Versions that stay after a replacement, for readers that have begun: the one that holds and so many before it.
OLD_VERSIONS = 1


def store(spark: SparkSession, path: str):
    """``(file system, path)`` of Hadoop for a URI."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _list(spark: SparkSession, path: str) -> list[str]:
    fs, target = store(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _commits(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """``(number, version)`` of a snapshot's markers, the one that holds last."""
    return sorted((int(n), v) for _, n, v in (name.split("-", 2) for name in _list(spark, folder) if name.startswith("commit-")))


def snapshots(spark: SparkSession, table_dir: str) -> list[str]:
    """Ids of the snapshots that have a version, from names alone: no data is scanned."""
    return sorted(n.split("=", 1)[1] for n in _list(spark, table_dir) if n.startswith("snapshot_date=") and _commits(spark, f"{table_dir}/{n}"))


def read_snapshot(spark: SparkSession, table_dir: str, snapshot: str | None = None) -> DataFrame:
    """One snapshot, the newest by default, with its partition columns: the version that holds now, whole."""
    have = snapshots(spark, table_dir)
    snapshot = snapshot or (have[-1] if have else None)
    if snapshot not in have:
        raise SourceError(f"{table_dir} has no snapshot {snapshot}")
    folder = f"{table_dir}/snapshot_date={snapshot}"
    version = _commits(spark, folder)[-1][1]
    try:
        day = F.lit(date.fromisoformat(snapshot))
    except ValueError:
        day = F.lit(snapshot)
    return spark.read.parquet(f"{folder}/v-{version}").withColumn("snapshot_date", day)


def current(spark: SparkSession, table_dir: str, snapshot: str | None = None) -> tuple[str, str] | None:
    """``(snapshot, version)`` that a reader would get, the newest snapshot by default; None if there is none."""
    have = [snapshot] if snapshot else snapshots(spark, table_dir)[-1:]
    commits = _commits(spark, f"{table_dir}/snapshot_date={have[0]}") if have else []
    return (have[0], commits[-1][1]) if commits else None


def age(spark: SparkSession, table_dir: str, snapshot: str) -> float | None:
    """Seconds since the version that holds was put in place; None if there is none."""
    folder = f"{table_dir}/snapshot_date={snapshot}"
    commits = _commits(spark, folder)
    if not commits:
        return None
    fs, marker = store(spark, f"{folder}/commit-{commits[-1][0]:012d}-{commits[-1][1]}")
    return time.time() - fs.getFileStatus(marker).getModificationTime() / 1000


def replace_snapshot(df: DataFrame, table_dir: str, snapshot: str, partitions: tuple[str, ...] = (), guard: Callable[[], None] | None = None) -> dict:
    """Write ``df`` as the whole of one snapshot; others stay.  Returns rows, files, bytes and seconds.
    ``guard``, called before the marker is made, raises if the writer has lost its right to replace.

    The new version is written beside the old one; creating its marker switches readers over, in one step on any
    store.  A writer that dies before leaves the old version as it was, one that dies after leaves files that no
    reader looks at and the next replacement deletes.  Rows are counted by the writing pass itself.  Rows are gathered by
    partition value first, so that a value has few files; a value of many GB is split by the rebalance.
    """
    began, spark = time.monotonic(), df.sparkSession
    folder, version = f"{table_dir}/snapshot_date={snapshot}", uuid.uuid4().hex
    rows = Observation()
    out = df.drop("snapshot_date").observe(rows, F.count(F.lit(1)).alias("n"))
    if partitions:
        out = out.hint("rebalance", *partitions)
    writer = out.write.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{folder}/v-{version}")
    fs, fresh = store(spark, f"{folder}/v-{version}")
    files = _data_files(fs, fresh)
    if not files:
        fs.delete(fresh, True)
        raise SourceError(f"{folder}: nothing was written")
    if guard:
        guard()
    _commit(spark, folder, version)
    _vacuum(spark, folder)
    return {"linhas": rows.get["n"], "arquivos": len(files), "bytes": sum(files), "segundos": round(time.monotonic() - began, 2)}


def _data_files(fs, folder) -> list[int]:
    """Lengths of the Parquet files under ``folder``."""
    out, each = [], fs.listFiles(folder, True)
    while each.hasNext():
        status = each.next()
        if status.getPath().getName().endswith(".parquet"):
            out.append(status.getLen())
    return out


def _commit(spark: SparkSession, folder: str, version: str) -> None:
    """Make ``version`` the one that holds.  Two writers at once make two markers of one number; the larger name holds."""
    commits = _commits(spark, folder)
    fs, marker = store(spark, f"{folder}/commit-{commits[-1][0] + 1 if commits else 1:012d}-{version}")
    if not fs.createNewFile(marker):
        raise SourceError(f"{folder}: version {version} could not be put in place")


def _vacuum(spark: SparkSession, folder: str) -> None:
    """Delete versions older than the last ``OLD_VERSIONS`` before the one that holds, markers last, and those of dead writers."""
    commits = _commits(spark, folder)
    stay = {v for _, v in commits[-1 - OLD_VERSIONS:]}
    for name in _list(spark, folder):
        if name.startswith("v-") and name[2:] not in stay:
            fs, path = store(spark, f"{folder}/{name}")
            fs.delete(path, True)
    for n, v in commits[: -1 - OLD_VERSIONS]:
        fs, path = store(spark, f"{folder}/commit-{n:012d}-{v}")
        fs.delete(path, False)
