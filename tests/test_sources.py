"""Reference tables, probes, kept answers, settings, command line."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from registry import unpacked

from lodestone import cli
from lodestone.functions import columns
from lodestone.operators import relational
from lodestone.plans import pipeline, questions
from lodestone.sources import files, reference, tables


def test_reference_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text("codigo_ibge,nome,uf,regiao_imediata,regiao_intermediaria,latitude,longitude,populacao_2024,populacao_2026\n0042,Biritiba-Mirim,SP,a,b,-23.5,-46.0,1,7\n0043,Embu,SP,a,b,-23.6,-46.8,2,8\n")
    (tmp_path / "c.csv").write_text("uf,nome_cno,codigo_ibge,nome_ibge,motivo\nSP,BIRITIBA,0042,Biritiba-Mirim,nome curto\nSP,EMBU,0043,Embu,sem motivo\n")
    places, population = reference.read_places(spark, str(tmp_path / "m.csv"))
    fixes = reference.read_corrections(spark, str(tmp_path / "c.csv"))
    assert population == "populacao_2026" and [tuple(r) for r in places.select("codigo_ibge", "chave", population).orderBy("codigo_ibge").collect()] == [("0042", "BIRITIBA MIRIM", 7), ("0043", "EMBU", 8)]
    assert [r["nome_cno"] for r in reference.redundant(fixes, places).collect()] == ["EMBU"]
    with pytest.raises(tables.SourceError):
        reference.read_places(spark, str(tmp_path / "c.csv"))
    with pytest.raises(tables.SourceError):
        reference.newest_population(["nome"])


def test_days_left(tmp_path):
    (tmp_path / "meta.json").write_text('{"valido_ate": "2026-03-01"}')
    at = lambda d: datetime(2026, 2, d, 12, tzinfo=UTC)
    assert [files.days_left(tmp_path / "meta.json", at(d)) for d in (1, 28)] == [27, 0] and files.days_left(tmp_path / "meta.json", datetime(2026, 3, 2, tzinfo=UTC)) == -1
    (tmp_path / "none.json").write_text("{}")
    with pytest.raises(KeyError):
        files.days_left(tmp_path / "none.json")
    with pytest.raises(tables.SourceError):
        files.days_left(tmp_path / "missing.json")


def test_probes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("x,y\n1,\"a–b\"\n".encode("cp1252"))
    (tmp_path / "b.csv").write_bytes("x,y\n1,\"é\nb\"\n".encode("cp1252"))
    assert {r["path"].rsplit("/", 1)[1]: r["c1"] for r in tables.c1_bytes(spark, str(tmp_path)).collect()} == {"a.csv": True, "b.csv": False}
    assert [tables.broken_lines(spark, f"{tmp_path}/{n}.csv") for n in "ab"] == [False, True]
    assert tables.read_csv(spark, f"{tmp_path}/a.csv", ["x", "y"]).collect() == [("1", "a–b")]
    assert tables.read_csv(spark, f"{tmp_path}/b.csv", ["x", "y"]).collect() == [("1", "é\nb")]


def test_answers_are_kept_and_expire(spark):
    calls = []

    class Counted(questions.Questions):
        def anything(self, uf=None):
            calls.append(uf)
            return spark.range(3)

    q = Counted(None, None, None, None)
    assert q.ask("anything", uf="SC").count() == q.ask("anything", uf="SC").count() == 3 and q.ask("anything").is_cached
    assert calls == ["SC", None]
    q.keep_seconds, q._cache = -1, {}
    q.ask("anything"), q.ask("anything")
    assert len(calls) == 4


def test_sample_lines(tmp_path):
    (tmp_path / "x.csv").write_bytes("a–b\nc".encode("cp1252"))
    lines = questions.sample_lines(tmp_path / "x.csv")
    assert questions.decode_lines(lines, "cp1252") == ["a–b", "c"] and questions.decode_lines(lines, "latin-1")[0] != "a–b"


def test_a_sample_is_short_whatever_the_file(tmp_path):
    (tmp_path / "x.csv").write_bytes(b"line\r\n" * 5000)
    assert questions.sample_lines(tmp_path / "x.csv") == [b"line"] * 1000 and questions.sample_lines(tmp_path / "x.csv", 2) == [b"line"] * 2


def test_broadcasts_are_bounded_in_rows_and_bytes(spark):
    def sent(df, **bounds):
        return "broadcast" in relational.small(df, **bounds)._jdf.queryExecution().logical().toString().lower()

    few, wide = spark.range(10), spark.range(10).select(F.repeat(F.lit("é"), 1000).alias("s"), "id")
    assert sent(few) and not sent(few, rows=9) and sent(wide, size=10 * 2008) and not sent(wide, size=10 * 2008 - 1) and sent(few.limit(0))


def test_formats():
    assert columns.format_number(1234567.891, 2) == "1.234.567,89" and columns.format_percent(41.25) == "41,2%"
    assert [columns.format_bytes(n) for n in (12, 2048, 5 << 20, 3 << 40)] == ["12 B", "2.0 KB", "5.0 MB", "3072.0 GB"]


def test_settings():
    s = pipeline.Settings.from_env({"LODESTONE_DATA": "/x", "LODESTONE_ATTEMPTS": "2", "LODESTONE_KEEP_ZIP": "no", "LODESTONE_TABLES": "store://t/"})
    assert (str(s.data), s.attempts, s.keep_zip, s.store) == ("/x", 2, False, "store://t") and pipeline.Settings.from_env({}).store.startswith("file:///")
    with pytest.raises(ValueError):
        pipeline.Settings.from_env({"LODESTONE_ATTEMPTS": "two"})


def test_stages_from_the_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("LODESTONE_DATA", str(tmp_path))
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    unpacked(pipeline.Settings.from_env(), "2026-01-15")
    for stage in ("transform", "validate", "curate"):
        assert cli.main([stage, "--json"]) == 0
        done = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert done["tabelas"]["obras_analitico"]["linhas"] == 12 and done["tabelas"]["obras_analitico"]["bytes"] > 0
    assert cli.main(["info", "--json", "--snapshot", "2026-01-15"]) == 0 and {"extract", "staging", "validate", "curate"} <= json.loads(capsys.readouterr().out).keys()
    monkeypatch.setattr(pipeline, "extract", lambda s: {"snapshot": "2026-01-15"})
    assert pipeline.run_all(spark, pipeline.Settings.from_env()).keys() == {"extract", "transform", "validate", "curate"}
