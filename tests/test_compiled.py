"""What large tables cost: plans whose methods the JVM compiles, and tables that are not written twice."""

import re

import pytest

from lodestone.plans import curate, sample, staging

DATA = "/root/testdata/sf0.001"
#: Longer methods are only interpreted.
MOST_BYTES = 8000


def tables(spark):
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")


def sizes(spark, df, capsys) -> list[int]:
    capsys.readouterr()
    df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]


@pytest.fixture
def planned(spark):
    """Plans that are whole before they run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_staged_tables_are_compiled(planned, capsys):
    for name in staging.TABLES:
        found = sizes(planned, sample.staged(tables(planned))[name], capsys)
        assert found and max(found) <= MOST_BYTES, (name, found)


def test_analytic_table_is_compiled(planned, capsys):
    found = sizes(planned, curate.analytic(sample.kept(tables(planned))), capsys)
    assert found and max(found) <= MOST_BYTES


def test_only_faulty_works_are_written_again(spark, monkeypatch):
    t, written, write = tables(spark), [], sample.replace_snapshot
    sample.kept(t)
    monkeypatch.setattr(sample, "_folders", {k: v for k, v in sample._folders.items() if k[0] == "staged"})
    monkeypatch.setattr(sample, "replace_snapshot", lambda df, folder, *more: (written.append(folder.rsplit("/", 1)[1]), write(df, folder, *more))[1])
    got = sample.faulty(t)
    assert written == ["obras", "whole"] and set(got) == set(staging.TABLES)
    assert got["obras"].count() > sample.kept(t)["obras"].count()


def test_rows_are_compared_by_source_columns_only(spark):
    for name, derived in (("areas", "area_principal"), ("vinculos", "vinculo_vigente")):
        plan = sample.staged(tables(spark))[name]._jdf.queryExecution().optimizedPlan().toString()
        keys = [line.split("Aggregate [")[1].split("], [")[0] for line in plan.splitlines() if "Aggregate [" in line]
        assert keys and not any(derived in line for line in keys)
