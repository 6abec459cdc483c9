"""The stages over a data folder: extract, transform, validate, curate."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..sources.leases import lease
from ..sources.tables import SourceError, read_csv, read_snapshot, replace_snapshot
from . import curate, rules, staging


@dataclass(frozen=True)
class Settings:
    data: Path
    url: str = ""
    attempts: int = 5
    timeout: int = 60
    backoff: float = 2
    chunk: int = 1 << 20
    agent: str = "lodestone"
    keep_zip: bool = True
    tables: str = ""

    @property
    def store(self) -> str:
        """Where tables live: any URI that Spark reads; beside the raw files if none is named."""
        return self.tables.rstrip("/") or f"file://{self.data.resolve()}"

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env

        def whole(name: str, usual: int) -> int:
            try:
                return int(env.get(name) or usual)
            except ValueError as e:
                raise ValueError(f"{name} is not a whole number: {env[name]!r}") from e

        return cls(
            Path(env.get("LODESTONE_DATA", "data")), env.get("LODESTONE_URL", ""), whole("LODESTONE_ATTEMPTS", 5), whole("LODESTONE_TIMEOUT", 60),
            float(env.get("LODESTONE_BACKOFF") or 2), whole("LODESTONE_CHUNK", 1 << 20), env.get("LODESTONE_AGENT", "lodestone"),
            env.get("LODESTONE_KEEP_ZIP", "sim").strip().lower() in ("1", "true", "yes", "y", "sim"), env.get("LODESTONE_TABLES", ""))

    def manifest(self, stage: str, snapshot: str = "latest") -> Path:
        return self.data / "manifests" / stage / f"{snapshot}.json"


def _done(s: Settings, stage: str, snapshot: str, data: dict) -> dict:
    data = {"snapshot": snapshot, **data}
    files.write_json(s.manifest(stage, snapshot), data)
    files.write_json(s.manifest(stage), data)
    return data


def extract(s: Settings, force: bool = False) -> dict:
    """Fetch and unpack the package unless the same one, by ETag and checksum, is there."""
    source = files.HttpSource(s.url, s.timeout, s.attempts, s.backoff, s.chunk, s.agent)
    info = source.inspect()
    snapshot = info["snapshot"]
    with files.lock(s.data / "locks", snapshot):
        known = s.manifest("extract", snapshot)
        if known.exists() and not force:
            old = files.read_json(known)
            if old.get("etag") == info["etag"] and all(Path(f["path"]).exists() and files.sha256(Path(f["path"])) == f["sha256"] for f in old["files"].values()):
                return old
        raw = s.data / "raw" / f"snapshot_date={snapshot}"
        package = source.fetch(raw / "package.zip", info)
        members = files.unpack(package, raw / "csv")
        data = {**info, "sha256": files.sha256(package), "files": {n: {"path": str(p), "sha256": files.sha256(p)} for n, p in members.items()}, "totals": files.control_totals(members["cno_totais.csv"])}
        if not s.keep_zip:
            package.unlink()
        return _done(s, "extract", snapshot, data)


def _source(spark: SparkSession, s: Settings, raw: dict, name: str) -> str:
    """Where executors read a member of the package: on the tables' store, put there and checked if it is not this machine's."""
    member = raw["files"][name]
    local = Path(member["path"])
    if s.store.startswith("file:"):
        return f"file://{local.resolve()}"
    uri = f"{s.store}/raw/snapshot_date={raw['snapshot']}/csv/{name}"
    files.upload(spark, local, uri, member.get("sha256"))
    return uri


def transform(spark: SparkSession, s: Settings, snapshot: str | None = None) -> dict:
    """Source files to staged tables, one snapshot replaced."""
    raw = files.read_json(s.manifest("extract", snapshot or "latest"))
    snapshot = raw["snapshot"]
    out = {}
    with lease(spark, s.store, snapshot) as held:
        for name, table in staging.TABLES.items():
            source = read_csv(spark, _source(spark, s, raw, table.file), table.headers)
            read = Observation()  # rows in are counted by the pass that writes
            source = source.observe(read, F.count(F.lit(1)).alias("n"))
            wrote = replace_snapshot(staging.stage(name, source, snapshot), f"{s.store}/staging/{name}", snapshot, table.partitions, held.check)
            out[name] = {"lidas": read.get["n"], **wrote, "duplicatas": read.get["n"] - wrote["linhas"]}
    return _done(s, "staging", snapshot, {"tabelas": out, "totals": raw.get("totals", {})})


def _tables(spark: SparkSession, s: Settings, snapshot: str) -> dict:
    return {n: read_snapshot(spark, f"{s.store}/staging/{n}", snapshot) for n in staging.TABLES}


def validate(spark: SparkSession, s: Settings, snapshot: str | None = None) -> dict:
    staged = files.read_json(s.manifest("staging", snapshot or "latest"))
    snapshot = staged["snapshot"]
    report = rules.validate(_tables(spark, s, snapshot), snapshot, {n: t["lidas"] for n, t in staged["tabelas"].items()}, staged["totals"])
    return _done(s, "validate", snapshot, report.as_dict())


def run_curate(spark: SparkSession, s: Settings, snapshot: str | None = None) -> dict:
    snapshot = files.read_json(s.manifest("staging", snapshot or "latest"))["snapshot"]
    base, out = f"{s.store}/curated", {}
    with lease(spark, s.store, snapshot) as held:
        out["obras_analitico"] = replace_snapshot(curate.analytic(_tables(spark, s, snapshot)), f"{base}/obras_analitico", snapshot, ("uf",), held.check)
        works = read_snapshot(spark, f"{base}/obras_analitico", snapshot)
        for name in curate.MARTS:
            out[name] = replace_snapshot(curate.mart(name, works), f"{base}/{name}", snapshot, guard=held.check)
        geo = curate.coverage(works)
    return _done(s, "curate", snapshot, {"tabelas": out, "geo": geo})


def run_all(spark: SparkSession, s: Settings) -> dict[str, dict]:
    """All stages on one snapshot, even if another is published meanwhile."""
    out = {"extract": extract(s)}
    snapshot = out["extract"]["snapshot"]
    stages: dict[str, Callable] = {"transform": transform, "validate": validate, "curate": run_curate}
    for name, stage in stages.items():
        out[name] = stage(spark, s, snapshot)
        if name == "validate" and not out[name]["passou"]:
            raise SourceError(f"snapshot {snapshot} does not pass validation")
    return out
