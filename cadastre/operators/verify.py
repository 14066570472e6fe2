"""Verification of a published run: its files are fetched from every gateway, hashed as they stream, and compared.

A check is an artifact at a gateway. Checks are rows, dealt to tasks; a task fetches, waits and tries again by itself, so that
slow gateways do not hold up the others. A run is verified if enough gateways gave the right bytes of each file, and of the smallest one by
its name under the root.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import stored
from .digests import read_store
from .publish import verified

ATTEMPTS, LEAST, AT_ONCE = 5, 2, 8
# Seconds before the second attempt, longer where a gateway asks for time, and the longest wait.
WAIT_S, BUSY_WAIT_S, LONGEST_S, BUSY = 5.0, 20.0, 180.0, (429, 504)

#: (status, pieces of the body) of a url; an OSError where there is no answer.
Open = Callable[[str], tuple[int, Iterable[bytes]]]
CHECK = "url string, ok boolean, status int, size long, digest string, attempts int, ms long, error string"


def wait_before(status: int | None, attempt: int) -> float:
    """Seconds to wait after a failed ``attempt``."""
    return min((BUSY_WAIT_S if status in BUSY else WAIT_S) * 2 ** (attempt - 1), LONGEST_S)


def fetch(open_url: Open, url: str) -> dict:
    began, status = time.monotonic(), None
    try:
        status, pieces = open_url(url)
        if not 200 <= status < 300:
            raise OSError(f"status {status}")
        digest, size = hashlib.sha256(), 0
        for piece in pieces:
            digest.update(piece)
            size += len(piece)
        told = {"ok": True, "status": status, "size": size, "digest": digest.hexdigest(), "error": None}
    except OSError as e:
        told = {"ok": False, "status": status, "size": None, "digest": None, "error": str(e)}
    return told | {"url": url, "ms": int(1000 * (time.monotonic() - began))}


def checked(wanted: DataFrame, open_url: Open, *, attempts: int = ATTEMPTS, pace: float = 1.0, at_once: int = AT_ONCE) -> DataFrame:
    """``wanted`` (artifact, gateway, url, want_size, want_digest) with what came of it. ``pace``: factor of all waits."""

    def one(url: str, size: int, digest: str) -> dict:
        for attempt in range(1, attempts + 1):
            told = fetch(open_url, url)
            if (told["size"], told["digest"]) == (size, digest) or attempt == attempts:
                return told | {"attempts": attempt}
            time.sleep(pace * wait_before(told["status"], attempt))
        raise AssertionError

    names = ["artifact", "gateway", "url", "want_size", "want_digest"]
    columns = [n.split()[0] for n in CHECK.split(", ")][1:]
    kinds = [pa.bool_(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(r["url"], r["want_size"], r["want_digest"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([m[c] for m in made], t) for c, t in zip(columns, kinds, strict=True)]], names=[*names, *columns])

    dealt = wanted.select(*names).repartition(at_once)
    return dealt.mapInArrow(run, "artifact string, gateway string, url string, want_size long, want_digest string, " + CHECK.partition(", ")[2])


@dataclass
class Report:
    """``artifacts``: matching gateways of each file; ``probe``: of the file fetched by name under the root, '' if there is no file."""

    checks: DataFrame
    artifacts: DataFrame
    probe: str
    least: int
    all_matched: bool


def verify(spark: SparkSession, manifest: dict, gateways: list[str], open_url: Open, *, least: int = LEAST, only: list[str] | None = None, **how) -> Report:
    """Check a manifest's files, all or ``only`` some, at ``gateways``; at least ``least`` of them, or all if there are fewer, must agree."""
    files = [a for a in manifest["artifacts"] if a["codec"] == "file" and (only is None or a["name"] in only)]
    asked = [(a["name"], g, f"{g.rstrip('/')}/{a['digest']}", a["size"], a["sha256"]) for a in files for g in gateways]
    smallest = min(files, key=lambda a: (a["size"], a["name"]), default=None)
    # An artifact has a name: what has none is the probe of the root.
    asked += [("", g, f"{g.rstrip('/')}/{manifest['root']}/{smallest['name']}", smallest["size"], smallest["sha256"]) for g in gateways if smallest]
    wanted = spark.createDataFrame(asked, "artifact string, gateway string, url string, want_size long, want_digest string")
    checks = stored(checked(wanted, open_url, **how), "checks")
    least = min(least, len(gateways))
    told = verified(checks, least)
    wrong = told.where("NOT passed").limit(1).count()
    return Report(checks, told.where("artifact <> ''"), smallest["name"] if smallest else "", least, bool(files) and not wrong)


def from_stores(url: str) -> tuple[int, Iterable[bytes]]:
    """An ``Open`` for stores by content that are folders: ``STORE/DIGEST`` or ``STORE/ROOT/NAME``."""
    found = re.fullmatch(r"(.*?)/([0-9a-f]{64})(?:/(.*))?", url)
    if not found:
        return 400, []
    try:
        pieces = read_store(found[1], found[2], found[3] or "")
        first = next(pieces, b"")
    except FileNotFoundError:
        return 404, []

    def rest() -> Iterator[bytes]:
        yield first
        yield from pieces

    return 200, rest()
