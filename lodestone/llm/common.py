"""Plumbing shared by the corpus operators: scratch tables, file systems, null-safe joins.

Scratch tables live under ``spark.checkpoint.dir``, which every executor and the driver can reach, so a
lost executor never takes an intermediate result with it.  Only where the setting is absent on a local master (unit
tests on one machine) does this module choose a folder of its own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``[\\x20\\x09-\\x0D]`` as a Java regular expression: the blanks between words.
BLANKS = r"[\x20\x09-\x0D]+"

_own_root: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the session; on a local master that names none a temporary one of our own, elsewhere an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors and the driver share")
    app = sc.applicationId
    if app not in _own_root:
        _own_root[app] = "file://" + tempfile.mkdtemp(prefix="lodestone-")
    return _own_root[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/lodestone-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


_written: list[tuple[SparkSession, str]] = []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through Hadoop's file system, whatever store it is in."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is not None:
            try:
                delete(spark, path)
            except Exception:  # the session is ending; a folder left behind is harmless
                return


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch Parquet table and read it back: cuts the lineage at a durable copy."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop_scratch(df: DataFrame) -> None:
    """Free a table of :func:`materialise` that no later plan reads."""
    delete(df.sparkSession, df.scratch_path)


def drop_scratch_since(mark: int, *keep: DataFrame) -> None:
    """Free the scratch tables that came after :func:`scratch_mark`, but for those of ``keep``, once nothing reads them."""
    stay = {df.scratch_path for df in keep}
    for entry in _written[mark:]:
        if entry[1] not in stay:
            delete(*entry)
            _written.remove(entry)


def scratch_mark() -> int:
    return len(_written)


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which nulls match nulls; the keys appear once, from the left."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}" if c in keys else c) for c in right.columns])
    on = reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


#: Keys of rows (some 24 bytes each) up to which a set of decisions is broadcast to the texts.
BROADCAST_KEYS = 1_000_000


def small_side(df: DataFrame, rows: int = BROADCAST_KEYS) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``rows`` rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def words_of(text: Column | str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array; null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def with_hashes(df: DataFrame, words: str) -> DataFrame:
    """``df`` with what :func:`window_hash` reads: hashes of each of ``words`` and of each four that follow one another.

    They stay columns of their own, since an array inside another's lambda would be built for every element;
    elements are taken one by one, since a slice inside a lambda copies the whole array.
    """
    df = df.withColumn("__h", F.transform(words, lambda w: F.xxhash64(w)))
    return df.withColumn("__h4", F.transform("__h", lambda h, i: F.xxhash64(h, *[F.get("__h", i + k) for k in (1, 2, 3)])))


def window_hash(size: int, at: Column) -> Column:
    """Hash of the ``size`` words from place ``at`` (from 0) on, which the text must have."""
    if size < 4:
        return F.xxhash64(*[F.get("__h", at + k) for k in range(size)])
    places = [*range(0, size - 3, 4), *([size - 4] if size % 4 else [])]
    return F.xxhash64(*[F.get("__h4", at + k) for k in places])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII takes the quick path of ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def doc_key() -> tuple[Column, Column]:
    """``doc_id`` and a hash of the text: tells apart rows that share an id."""
    return F.col("doc_id"), F.xxhash64("text").alias("text_hash")


KEY = ["doc_id", "text_hash"]


def open_store(uri: str):
    """``(file system, path)`` of pyarrow for a URI of Spark: local, HDFS, S3 or GCS."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
