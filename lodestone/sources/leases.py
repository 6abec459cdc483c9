"""A lock that lives on the tables' store, so that drivers on different machines see it.

``<root>/locks/<name>/lease-<number>-<owner>`` holds, as JSON, until when its owner may work.  Numbers grow and are never
used again: a writer checks before it commits that its number is still the largest, so an owner that was taken for dead
cannot overwrite what its successor wrote.  Taking a lease needs no atomic creation: each contender writes a file of its
own and then looks again; whoever sees a rival of its number or a larger one withdraws.  Of two contenders at most
one does not see the other.  The store must list a file once it is written; clocks may differ by less than the slack.
"""

from __future__ import annotations

import contextlib
import json
import threading
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .files import Locked
from .tables import _list, store

#: Seconds that an expired lease is respected further, for clocks that differ.
SLACK = 5.0


@dataclass
class Lease:
    """A lease that is held; ``number`` is its fencing number."""

    spark: SparkSession
    folder: str
    number: int
    owner: str
    seconds: float
    until: float = 0.0

    @property
    def path(self) -> str:
        return f"{self.folder}/lease-{self.number:012d}-{self.owner}"

    def renew(self) -> None:
        self.until = time.time() + self.seconds
        self._write()

    def release(self) -> None:
        """The file stays, expired, so that numbers go on growing."""
        self.until = 0.0
        self._write()

    def _write(self) -> None:
        fs, path = store(self.spark, self.path)
        out = fs.create(path, True)
        try:
            out.write(bytearray(json.dumps({"until": self.until, "owner": self.owner}).encode()))
        finally:
            out.close()

    def check(self) -> None:
        """Raises :class:`Locked` if the lease has run out or another one has been given since."""
        newer = [n for n, owner in _given(self.spark, self.folder) if n > self.number]
        if newer or time.time() >= self.until:
            raise Locked(f"{self.folder}: lease {self.number} of {self.owner} is no longer held")


def _given(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    return sorted((int(n), owner) for _, n, owner in (name.split("-", 2) for name in _list(spark, folder) if name.startswith("lease-")))


def _until(spark: SparkSession, lease: Lease) -> float:
    """Until when a lease holds; one that is being written counts from its file's time."""
    fs, path = store(spark, lease.path)
    if not fs.exists(path):
        return 0.0
    stream = fs.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    try:
        return float(json.loads(text)["until"])
    except (ValueError, KeyError):
        return fs.getFileStatus(path).getModificationTime() / 1000 + lease.seconds


def acquire(spark: SparkSession, root: str, name: str, seconds: float = 600, owner: str | None = None) -> Lease:
    """The lease ``name``, or :class:`Locked` if another owner holds it."""
    folder, owner = f"{root}/locks/{name}", owner or uuid.uuid4().hex
    given = _given(spark, folder)
    for n, other in given:
        until = _until(spark, Lease(spark, folder, n, other, seconds))
        if until and time.time() < until + SLACK:
            raise Locked(f"{name} is being worked on by {other} until {until:.0f}")
    mine = Lease(spark, folder, given[-1][0] + 1 if given else 1, owner, seconds)
    mine.renew()
    if any(n >= mine.number and (n, o) != (mine.number, owner) for n, o in _given(spark, folder)):
        fs, path = store(spark, mine.path)
        fs.delete(path, False)
        raise Locked(f"{name}: another owner came at the same time")
    for n, other in given[:-1]:  # the last one keeps the number should this owner die before its file is whole
        fs, path = store(spark, Lease(spark, folder, n, other, seconds).path)
        fs.delete(path, False)
    return mine


@contextlib.contextmanager
def lease(spark: SparkSession, root: str, name: str, seconds: float = 600, owner: str | None = None) -> Iterator[Lease]:
    """Holds the lease, renewed from a thread of its own while the block runs; it ends with the block, or ``seconds`` after its owner's death."""
    held = acquire(spark, root, name, seconds, owner)
    over = threading.Event()

    def beat() -> None:
        while not over.wait(seconds / 3):
            held.renew()

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield held
    finally:
        over.set()
        thread.join()
        held.release()
