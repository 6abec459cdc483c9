"""Stores other than the driver's disk, leases between drivers, answers kept for other sessions."""

import json
import shutil
import time
from pathlib import Path

import pytest
import registry

from lodestone.plans import pipeline
from lodestone.plans.questions import Questions
from lodestone.sources import files, leases
from lodestone.sources.tables import SourceError, read_snapshot, replace_snapshot


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    """A URI that only Hadoop's file systems resolve, and the folder behind it."""
    folder = tmp_path_factory.mktemp("far")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.store.link./data", folder.as_uri())
    return "viewfs://store/data", folder


def test_two_drivers_on_one_store(spark, far):
    uri, _ = far
    with leases.lease(spark, uri, "s1", owner="first") as held:
        with pytest.raises(files.Locked), leases.lease(spark, uri, "s1", owner="second"):
            pass
        with leases.lease(spark, uri, "s2", owner="second"):
            held.check()
    with leases.lease(spark, uri, "s1", owner="second") as later:
        assert later.number > held.number
        with pytest.raises(files.Locked):
            held.check()


def test_a_dead_owners_lease_expires(spark, far, monkeypatch):
    monkeypatch.setattr(leases, "SLACK", 0.0)
    uri, folder = far
    dead = leases.acquire(spark, uri, "s3", seconds=1.0, owner="dead")  # nothing renews it
    with pytest.raises(files.Locked):
        leases.acquire(spark, uri, "s3", seconds=1.0)
    time.sleep(1.1)
    with leases.lease(spark, uri, "s3", owner="heir") as heir:
        assert heir.number == dead.number + 1
        dead.renew()  # it wakes up, but its number is no longer the largest
        with pytest.raises(files.Locked):
            replace_snapshot(spark.range(3), f"{uri}/t", "s3", guard=dead.check)
        replace_snapshot(spark.range(4), f"{uri}/t", "s3", guard=heir.check)
    assert read_snapshot(spark, f"{uri}/t", "s3").count() == 4


def test_a_lease_is_renewed_while_it_is_held(spark, far, monkeypatch):
    monkeypatch.setattr(leases, "SLACK", 0.0)
    with leases.lease(spark, far[0], "s4", seconds=1.5, owner="slow") as held:
        time.sleep(2.5)
        held.check()
        with pytest.raises(files.Locked):
            leases.acquire(spark, far[0], "s4")


def test_rivals_at_the_same_time(spark, far, monkeypatch):
    """A rival that appears between looking and writing: whoever sees the other withdraws."""
    usual, seen = leases._given, []

    def given(s, folder):
        out = usual(s, folder)
        if not seen:  # after the first look, another one writes
            seen.append(1)
            leases.Lease(s, folder, 1, "rival", 60).renew()
        return out

    monkeypatch.setattr(leases, "_given", given)
    with pytest.raises(files.Locked):
        leases.acquire(spark, far[0], "s5", owner="late")
    assert usual(spark, f"{far[0]}/locks/s5") == [(1, "rival")]
    path = Path(far[1]) / "locks" / "s5" / "lease-000000000001-rival"
    path.write_text("")  # its file is not whole yet
    with pytest.raises(files.Locked):
        leases.acquire(spark, far[0], "s5")


def test_upload_is_checked(spark, far, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 100_000)
    digest = files.upload(spark, tmp_path / "a", f"{far[0]}/in/a")
    assert digest == files.sha256(tmp_path / "a") == files.remote_sha256(spark, f"{far[0]}/in/a")
    time_of = (far[1] / "in" / "a").stat().st_mtime_ns
    files.upload(spark, tmp_path / "a", f"{far[0]}/in/a")
    assert (far[1] / "in" / "a").stat().st_mtime_ns == time_of
    with pytest.raises(SourceError):
        files.upload(spark, tmp_path / "a", f"{far[0]}/in/b", "0" * 64)
    assert not (far[1] / "in" / "b").exists()


def test_stages_on_a_far_store(spark, far, tmp_path):
    """All of transform, validate and curate with the tables, and the raw files, on the store."""
    s = pipeline.Settings(tmp_path, tables=far[0])
    registry.unpacked(s, "2026-09-12")
    out = pipeline.transform(spark, s)
    assert {k: (v["lidas"], v["linhas"]) for k, v in out["tabelas"].items()} == {"obras": (12, 12), "areas": (4, 3), "cnaes": (2, 2), "vinculos": (3, 2)}
    assert (far[1] / "raw" / "snapshot_date=2026-09-12" / "csv" / "cno.csv").exists()
    assert pipeline.validate(spark, s)["passou"] and pipeline.run_curate(spark, s)["tabelas"]["obras_analitico"]["linhas"] == 12
    assert Questions.open(spark, f"{far[0]}/curated").total_obras() == 12


def test_answers_for_another_session(spark, tmp_path):
    s = pipeline.Settings(tmp_path)
    registry.unpacked(s, "2026-09-12")
    pipeline.transform(spark, s)
    pipeline.run_curate(spark, s)
    curated, answers = f"{s.store}/curated", f"{s.store}/answers"
    first = Questions.open(spark, curated, answers=answers)
    asked = {q: first.ask(q).collect() for q in ("quantis_area", "responsavel", "faixas_area", "obras_por_ano", "volumetria")}
    assert asked["responsavel"] == first.responsavel().collect() and first.ask("total_obras") == 12 and first.ask("total_obras", uf="SC") == 9
    second = Questions.open(spark.newSession(), curated, answers=answers)
    third = Questions.open(spark, curated, answers=answers)
    third.keep_seconds = -1
    for path in (tmp_path / "curated").rglob("*.parquet"):
        path.unlink()
    for q, rows in asked.items():
        assert second.ask(q).collect() == rows
    assert second.ask("total_obras") == 12
    with pytest.raises(Exception):
        second.ask("situacao").collect()  # never asked before
    with pytest.raises(Exception):
        third.ask("responsavel").collect()  # too old
    shutil.rmtree(tmp_path / "curated")
    pipeline.run_curate(spark, s)
    fresh = Questions.open(spark, curated, answers=answers)
    assert json.dumps(fresh.state) != json.dumps(second.state) and fresh.ask("responsavel").collect() == asked["responsavel"]
