"""Driver-side files: download with resume, unpacking, control totals, manifests, snapshot lock."""

from __future__ import annotations

import contextlib
import csv
import email.utils
import fcntl
import hashlib
import json
import os
import time
import unicodedata
import urllib.error
import urllib.request
import zipfile
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from .tables import SourceError, store

# Member names and labels of the publisher's package.
#: Members that a package must hold.
MEMBERS = ("cno.csv", "cno_areas.csv", "cno_cnaes.csv", "cno_vinculos.csv", "cno_totais.csv")
#: Labels of the totals file, without accents or case, and the tables' keys.
TOTALS = {"total de obras": "cno", "total de cnaes": "cno_cnaes", "total de areas": "cno_areas", "total de vinculos": "cno_vinculos"}


class HttpSource:
    """A file on a server, fetched in resumable pieces."""

    def __init__(self, url: str, timeout: float = 60, attempts: int = 5, backoff: float = 2, chunk: int = 1 << 20, agent: str = "lodestone"):
        self.url, self.timeout, self.attempts, self.backoff, self.chunk, self.agent = url, timeout, attempts, backoff, chunk, agent

    def _open(self, method: str = "GET", **headers: str):
        return urllib.request.urlopen(urllib.request.Request(self.url, method=method, headers={"User-Agent": self.agent, **headers}), timeout=self.timeout)

    def _retry(self, action: Callable):
        for k in range(self.attempts):
            try:
                return action()
            except urllib.error.HTTPError as e:
                if e.code < 500 and e.code != 429:
                    raise SourceError(f"{self.url}: {e}") from e
                last: Exception = e
            except OSError as e:
                last = e
            if k + 1 < self.attempts:
                time.sleep(self.backoff ** k * 0.1 if self.backoff < 1 else self.backoff ** k)
        raise SourceError(f"{self.url}: {last}") from last

    def inspect(self) -> dict:
        """Size, ETag, Last-Modified, whether ranges work, and the snapshot id."""

        def ask() -> dict:
            with self._open("HEAD") as head:
                h = head.headers
            with self._open(Range="bytes=0-0") as probe:
                ranges = probe.status == 206
            return {"url": self.url, "bytes": int(h.get("Content-Length") or 0), "etag": h.get("ETag"), "last_modified": h.get("Last-Modified"), "ranges": ranges}

        info = self._retry(ask)
        when = info["last_modified"] and email.utils.parsedate_to_datetime(info["last_modified"])
        return info | {"snapshot": (when or datetime.now(UTC)).strftime("%Y-%m-%d")}

    def fetch(self, target: Path, info: dict | None = None) -> Path:
        """Download to ``target`` by way of a ``.part`` file that later attempts go on with."""
        info = info or self.inspect()
        part = target.with_suffix(target.suffix + ".part")
        target.parent.mkdir(parents=True, exist_ok=True)

        def go() -> None:
            have = part.stat().st_size if part.exists() and info["ranges"] else 0
            headers = {"Range": f"bytes={have}-"} if have else {}
            if have and info["etag"]:
                headers["If-Range"] = info["etag"]
            if have and have == info["bytes"]:
                return
            with self._open(**headers) as response, part.open("ab" if have and response.status == 206 else "wb") as out:
                while data := response.read(self.chunk):
                    out.write(data)
            if info["bytes"] and part.stat().st_size != info["bytes"]:
                if part.stat().st_size > info["bytes"]:
                    part.unlink()
                raise OSError(f"got {part.stat().st_size if part.exists() else 0} of {info['bytes']} bytes")

        self._retry(go)
        os.replace(part, target)
        return target


def sha256(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def upload(spark: SparkSession, local: Path, uri: str, digest: str | None = None) -> str:
    """Put a local file on a store under ``uri``, whole or not at all; returns its SHA-256 as read back from the store.

    A file that is there with the same digest stays.
    """
    digest = digest or sha256(local)
    fs, target = store(spark, uri)
    if fs.exists(target) and remote_sha256(spark, uri) == digest:
        return digest
    _, part = store(spark, f"{uri}.part-{digest[:16]}")
    fs.copyFromLocalFile(False, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{local.resolve()}"), part)
    if (got := remote_sha256(spark, part.toString())) != digest:
        fs.delete(part, False)
        raise SourceError(f"{uri}: the store holds {got}, not {digest}")
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise SourceError(f"{uri} could not be put in place")
    return digest


def remote_sha256(spark: SparkSession, uri: str) -> str:
    """SHA-256 of a file on a store, read by the driver's JVM."""
    fs, path = store(spark, uri)
    jvm = spark.sparkContext._jvm
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    stream = jvm.java.security.DigestInputStream(fs.open(path), digest)
    try:
        stream.transferTo(jvm.java.io.OutputStream.nullOutputStream())
    finally:
        stream.close()
    return bytes(digest.digest()).hex()


def unpack(package: Path, target: Path, members: tuple[str, ...] = MEMBERS) -> dict[str, Path]:
    """Unpack after a CRC test; refuses paths that lead outside and packages without a required member."""
    try:
        with zipfile.ZipFile(package) as z:
            if (bad := z.testzip()) is not None:
                raise SourceError(f"{package}: {bad} is damaged")
            root = target.resolve()
            for name in z.namelist():
                if not (root / name).resolve().is_relative_to(root):
                    raise SourceError(f"{package}: {name} leads outside")
            if missing := {m.lower() for m in members} - {Path(n).name.lower() for n in z.namelist()}:
                raise SourceError(f"{package} lacks {', '.join(sorted(missing))}")
            target.mkdir(parents=True, exist_ok=True)
            z.extractall(target)
            return {Path(n).name.lower(): target / n for n in z.namelist() if not n.endswith("/")}
    except zipfile.BadZipFile as e:
        raise SourceError(f"{package}: {e}") from e


def _plain(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).strip().lower()


def control_totals(path: Path, encoding: str = "cp1252") -> dict[str, int]:
    with path.open(encoding=encoding, newline="") as f:
        row = next(csv.DictReader(f), None) or {}
    out = {TOTALS[_plain(k)]: v for k, v in row.items() if k and _plain(k) in TOTALS}
    try:
        return {k: int(v) for k, v in out.items() if v and v.strip()}
    except ValueError as e:
        raise SourceError(f"{path}: {e}") from e


def write_json(path: Path, data: dict) -> None:
    """Whole or not at all."""
    path.parent.mkdir(parents=True, exist_ok=True)
    temp = path.with_suffix(path.suffix + ".tmp")
    temp.write_text(json.dumps(data, ensure_ascii=False, indent=2, default=str))
    os.replace(temp, path)


def read_json(path: Path) -> dict:
    try:
        return json.loads(path.read_text())
    except (OSError, ValueError) as e:
        raise SourceError(f"{path}: {e}") from e


class Locked(RuntimeError):
    """Another process works on the snapshot."""


@contextlib.contextmanager
def lock(folder: Path, snapshot: str) -> Iterator[None]:
    """One process at a time on a snapshot; the lock ends with the process."""
    folder.mkdir(parents=True, exist_ok=True)
    with (folder / f"{snapshot}.lock").open("w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as e:
            raise Locked(f"snapshot {snapshot} is being worked on") from e
        yield


def days_left(meta: Path, today: datetime | None = None) -> int:
    """Days until the reference tables of ``meta`` (a JSON with valido_ate) go out of date."""
    end = datetime.fromisoformat(read_json(meta)["valido_ate"]).replace(tzinfo=UTC)
    return (end - (today or datetime.now(UTC))).days
