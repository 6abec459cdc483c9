"""Split CSV reads and the atomic switch of snapshots."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lodestone.sources import tables


def write(path, rows, end="\n"):
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n\r') or v == " " else v
    path.write_bytes((end.join(",".join(map(quoted, r)) for r in rows) + end).encode("cp1252"))


def one_task(spark, path, columns):
    df = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(str(path), header=True, quote='"', escape='"', multiLine=True, encoding="ISO-8859-1", mode="FAILFAST")
    return sorted(map(repr, df.select(*[tables._from_latin(F.col(f"`{c}`"), "cp1252").alias(c) for c in columns]).collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_quoted_line_breaks_are_split(spark, tmp_path, seed, end):
    rng = random.Random(seed)
    value = lambda: rng.choice(["", "plain", "ação – €", "a,b", 'say "x"', "two\nlines", '"\n"', "\n\nthree " * rng.randrange(1, 9), "x" * rng.randrange(40), '","'])
    folder = tmp_path / "in"
    folder.mkdir()
    for name in "ab":
        write(folder / f"{name}.csv", [("nº", "texto", "c d")] + [(str(i), value(), value()) for i in range(600)], end)
    columns = ["nº", "texto", "c d"]
    want = one_task(spark, folder, columns)
    assert len(want) == 1200
    for size in (300, 1500, 1 << 27):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        try:
            df = tables.read_csv(spark, str(folder), columns)
            assert sorted(map(repr, df.collect())) == want
            parts = df.rdd.getNumPartitions()
            assert parts > 20 if size == 300 else parts >= 2 if size == 1500 else parts >= 1
            busy = df.groupBy(F.spark_partition_id()).count().count()
            assert size > 1500 or busy > 5
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_that_fail(spark, tmp_path):
    for name, rows in {"header": "a,x\n1,\"q\nr\"\n", "ragged": "a,b\n1,\"q\nr\",3\n", "open": "a,b\n1,\"q\nr\n", "byte": "a,b\n1,\"q\n\x81\"\n"}.items():
        path = tmp_path / f"{name}.csv"
        path.write_bytes(rows.encode("latin-1"))
        with pytest.raises(Exception):
            tables.read_csv(spark, str(path), ["a", "b"]).collect()
    path = tmp_path / "good.csv"
    path.write_bytes("a,b\n\n1,\"q\nré\"\n\n2,\n".encode())
    assert sorted(tables.read_csv(spark, str(path), ["a", "b"], "UTF-8").collect()) == [("1", "q\nré"), ("2", None)]
    assert tables.read_csv(spark, str(path), ["a", "b"], "UTF-8").select("a").count() == 2
    path.write_bytes("\"a\nb\",c\n1,2\n".encode())
    assert tables.read_csv(spark, str(path), ["a\nb", "c"]).collect() == [("1", "2")]


def test_no_session_flag_is_left(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("a\n–€\n".encode("cp1252"))
    df = tables.read_csv(spark, f"{tmp_path}/x.csv", ["a"])
    assert df.collect() == [("–€",)] and spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"


class Killed(BaseException):
    pass


def test_a_killed_writer_leaves_old_or_new(spark, tmp_path, monkeypatch):
    """The writer dies before each call to the store in turn; a reader finds the old snapshot or the new one, whole."""
    folder = f"file://{tmp_path}/t"
    tables.replace_snapshot(spark.range(10), folder, "2026-01-01")
    reader = tables.read_snapshot(spark, folder)  # has begun before any replacement
    usual, at, seen = tables.store, [0, None], set()

    def store(s, path):
        at[0] += 1
        if at[0] == at[1]:
            raise Killed
        return usual(s, path)

    monkeypatch.setattr(tables, "store", store)
    for step in range(1, 60):
        at[:] = 0, step
        try:
            tables.replace_snapshot(spark.range(10, 15), folder, "2026-01-01")
            finished = True
        except Killed:
            finished = False
        at[:] = 0, None
        rows = sorted(r.id for r in tables.read_snapshot(spark, folder).collect())
        assert rows in (list(range(10)), list(range(10, 15)))
        seen.add(len(rows))
        if finished:
            break
        if len(rows) == 5:
            tables.replace_snapshot(spark.range(10), folder, "2026-01-01")
    assert finished and step > 5 and seen == {5, 10}
    tables.replace_snapshot(spark.range(3), folder, "2026-01-01")
    assert len(list((tmp_path / "t" / "snapshot_date=2026-01-01").glob("v-*"))) == 2 == len(list((tmp_path / "t" / "snapshot_date=2026-01-01").glob("commit-*")))
    assert tables.snapshots(spark, folder) == ["2026-01-01"] and reader.columns == ["id", "snapshot_date"]


def test_a_write_that_fails_or_yields_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}/t"
    tables.replace_snapshot(spark.range(10).withColumn("k", F.col("id") % 2), folder, "s", ("k",))
    with pytest.raises(Exception):
        tables.replace_snapshot(spark.range(9).select(F.raise_error(F.lit("no")).alias("id")), folder, "s")
    assert tables.read_snapshot(spark, folder, "s").filter("k = 1").count() == 5
    with pytest.raises(tables.SourceError):
        tables.read_snapshot(spark, folder, "other")


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    """One action a table; the counts agree with what a reader finds."""
    read = Observation()
    done = tables.replace_snapshot(spark.range(100).observe(read, F.count(F.lit(1)).alias("n")).distinct().filter("id % 4 = 0"), f"file://{tmp_path}/t", "2026-01-01")
    again = tables.read_snapshot(spark, f"file://{tmp_path}/t")
    assert read.get["n"] == 100 and done["linhas"] == again.count() == 25
    assert done["arquivos"] == len(again.inputFiles()) and done["bytes"] > 0
