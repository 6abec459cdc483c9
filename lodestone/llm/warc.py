"""A deterministic sharded writer of WARC files, and their reader.

Records are sorted by page_id.  Shards are ranges of (page_id, start of the digest), cut at even steps of the
running sum of payload bytes in that order, so the same table gives the same shards whatever the cluster does,
however the ids are spread, and an id that very many rows share is cut too.  One row a shard reaches the driver;
each record finds its shard by binary search in an expression, and each shard is a partition of its own.  A shard
is written by one task as a chain of gzip members, one a record, and goes on in a new file once ``roll_bytes`` compressed bytes are reached.  Files get a temporary name in a folder of
the attempt and are renamed when whole; a shard's manifest rows come last, through Spark's own commit.  A
task that is run again writes the same bytes under the same names, so losing executors does no harm.

Record headers, digests and ids are made anew from the payload and page_id; no clock or random number enters.
Pages travel once, to be sorted; who revisits whom is decided on ids and digests alone, and the verdicts are
sorted in among the pages.

Defined cases: null html is an empty payload; a null url gives a ``urn:page:`` target; control characters in a
url are percent-encoded; a null page_id is a response; several rows of the largest page_id of a payload are
all responses; repeated rows give a record each, in one shard; ids may lie anywhere in the range of a long; an empty table gives no files and no rows; extra columns are
ignored.  Very long pages are streamed, one record in memory at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, open_store

REVISIT_FROM = 1000
ROLL_BYTES = 64 << 20
SHARD_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("7d1f5a5e-4c0e-5a53-9d0b-3f6f1f0c9a11")

MANIFEST = "shard long, file string, records long, compressed_bytes long, sha256 string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}:{digest}')}>"


def _b32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record; with ``refers_to``, a revisit without the payload."""
    digest = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    target = f"urn:page:{page_id}" if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest.hexdigest())}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest.digest()).decode()}",
        f"WARC-Block-Digest: {_b32(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest.hexdigest())}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


class _Shard:
    """The files of one shard, under temporary names until :meth:`close`."""

    def __init__(self, root: str, shard: int, roll: int):
        self.fs, self.root = open_store(root)
        self.shard, self.roll, self.done, self.out = shard, roll, [], None
        self.temp = f"{self.root}/_temporary/{shard:08d}-{uuid.uuid4().hex}"
        self.fs.create_dir(self.temp, recursive=True)

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"{self.shard:08d}-{len(self.done):05d}.warc.gz"
            self.out, self.n, self.size, self.sha = self.fs.open_output_stream(f"{self.temp}/{self.name}", compression=None), 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.n, self.size = self.n + 1, self.size + len(member)
        if self.size >= self.roll:
            self._end()

    def _end(self) -> None:
        self.out.close()
        self.done.append((self.shard, self.name, self.n, self.size, self.sha.hexdigest()))
        self.out = None

    def close(self) -> list[tuple]:
        if self.out is not None:
            self._end()
        self.fs.create_dir(f"{self.root}/data", recursive=True)
        for _, name, *_ in self.done:
            self.fs.move(f"{self.temp}/{name}", f"{self.root}/data/{name}")
        self.fs.delete_dir(self.temp)
        return self.done


def _prefix(digest: Column) -> Column:
    """The first 60 bits of a hexadecimal digest: with page_id, the order of the records."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def thin(pages: DataFrame) -> DataFrame:
    """``page_id, digest, bytes`` of each page: all that is asked of payloads before they are written."""
    html = F.coalesce("html", F.lit(""))
    return pages.select("page_id", F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))


def revisits(meta: DataFrame, at_least: int = REVISIT_FROM) -> DataFrame:
    """``page_id, digest, refers_to`` of each page of :func:`thin` whose payload a later page has too."""
    meta = meta.filter((F.col("bytes") >= at_least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    keep = meta.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return meta.join(keep, "digest").filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page_id, prefix, load`` in order in; with them the load before each row in its partition, and the partition, out."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        load = batch.column(2).to_numpy()
        upto = before + np.cumsum(load)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(upto - load), pa.array(np.full(len(load), part, np.int32))], ["page_id", "prefix", "load", "before", "part"])
        before = int(upto[-1]) if len(load) else before


class Shards:
    """Ranges of (page_id, prefix of the digest), null ids first, of about ``shard_bytes`` payload bytes each."""

    def __init__(self, meta: DataFrame, shard_bytes: int, least: int):
        load = meta.groupBy("page_id", _prefix(F.col("digest")).alias("prefix")).agg(F.sum(F.col("bytes") + 512).alias("load"))
        ordered = load.repartitionByRange("page_id", "prefix").sortWithinPartitions("page_id", "prefix")
        held = materialise(ordered.mapInArrow(_running, "page_id long, prefix long, load long, before long, part int"), "warc-order")
        sums = sorted(tuple(r) for r in held.groupBy("part").agg(F.sum("load")).collect())
        total = sum(x for _, x in sums)
        width = max(1, -(-total // max(least, -(-total // shard_bytes), 1)))
        starts, upto = [], 0
        for part, x in sums:
            starts.append((part, upto))
            upto += x
        offsets = meta.sparkSession.createDataFrame(starts, "part int, offset long")
        numbered = held.join(F.broadcast(offsets), "part").select(F.expr(f"(offset + before) div {width}").alias("shard"), F.struct("page_id", "prefix").alias("first"))
        self.starts = sorted((r["shard"], r["first"]["page_id"] is not None, r["first"]["page_id"] or 0, r["first"]["prefix"]) for r in numbered.groupBy("shard").agg(F.min("first").alias("first")).collect())
        self.n = max(1, len(self.starts))

    def number(self, page_id: Column, digest: Column) -> Column:
        """How many shards start at or before a record, less one, by binary search."""
        known, ids, prefixes = (F.split(F.lit(",".join(str(int(x[k])) for x in self.starts)), ",").try_cast("array<bigint>") for k in (1, 2, 3))
        key = (page_id.isNotNull().cast("long"), F.coalesce(page_id, F.lit(0)), _prefix(digest))

        def from_here(at: Column) -> Column:
            k, i, p = (F.get(x, at) for x in (known, ids, prefixes))
            return (k < key[0]) | ((k == key[0]) & ((i < key[1]) | ((i == key[1]) & (p <= key[2]))))

        steps = F.array(*[F.lit(1 << k) for k in range(self.n.bit_length() - 1, -1, -1)])
        found = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(from_here(at + step - 1), step).otherwise(0))
        return F.greatest(found - 1, F.lit(0)).cast("int")


def write_warc(pages: DataFrame, root: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES, least_shards: int = 12, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``root``; returns the manifest's table."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    meta = materialise(thin(rows), "warc-meta")
    again = materialise(revisits(meta, revisit_from), "revisits")
    shards = Shards(meta, shard_bytes, least_shards)
    digest = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    verdicts = again.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "refers_to", F.lit(0).alias("kind"))
    both = verdicts.unionByName(rows.select("*", digest.alias("digest"), F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind")))
    dealt = both.withColumn("shard", shards.number(F.col("page_id"), F.col("digest")))
    ordered = dealt.repartitionById(shards.n, F.col("shard")).sortWithinPartitions("page_id", "kind", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, page, verdict = None, [], None, {}
        for batch in batches:
            ids, kinds, shards = (batch.column(c).to_pylist() for c in ("page_id", "kind", "shard"))
            urls, htmls, digests, refers = (batch.column(c) for c in ("url", "html", "digest", "refers_to"))
            for i, (this, kind, shard) in enumerate(zip(ids, kinds, shards, strict=True)):
                if out is None or out.shard != shard:
                    if out is not None:
                        done += out.close()
                    out = _Shard(root, shard, roll_bytes)
                if page != this:
                    page, verdict = this, {}
                if kind == 0:
                    verdict[digests[i].as_py()] = refers[i].as_py()
                    continue
                payload = (htmls[i].as_py() or "").encode()
                refer = verdict.get(digests[i].as_py())
                out.add(_member(record(this, urls[i].as_py(), payload, refer)))
        if out is not None:
            done += out.close()
        cols = list(zip(*done, strict=True)) if done else [[]] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["shard", "file", "records", "compressed_bytes", "sha256"])

    ordered.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")


def _headers(lines: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in lines.decode().split("\r\n")[1:] if x)


def parse(data: bytes) -> tuple:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of one record; checks its digests."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["Content-Length"])]
    if _b32(block) != warc["WARC-Block-Digest"] or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"damaged record {warc['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_headers(http)["Content-Length"]), warc["WARC-Payload-Digest"].removeprefix("sha1:")
    if warc["WARC-Type"] == "response" and (len(payload) != size or _b32(payload) != f"sha1:{digest}"):
        raise ValueError(f"damaged payload {warc['WARC-Record-ID']}")
    page, target = warc.get("X-Page-ID"), warc.get("X-Refers-To-Page-ID")
    return (page and int(page), size, base64.b32decode(digest).hex(), warc["WARC-Type"], target and int(target))


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    gz, out, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(1 << 20)):
        out.append(gz.decompress(data))
        data = b""
        if gz.eof:
            yield b"".join(out)
            data, gz, out = gz.unused_data, zlib.decompressobj(31), []
    if out:
        raise ValueError("a file ends within a record")


def read_warc(spark: SparkSession, root: str) -> DataFrame:
    """A row for each record of the archives that the manifest under ``root`` names."""
    files = spark.read.parquet(f"{root}/manifest").select("file")
    n = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = open_store(root)
                with store.open_input_stream(f"{path}/data/{name}", compression=None) as stream:
                    rows = [(*parse(x), name) for x in members(stream)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return files.repartition(n, "file").mapInArrow(run, RECORDS)
