"""Members of a ZIP, each read by a task of its own straight from the archive: no copy of it or of them is made.

Only the archive's directory is read first. A compressed member is one task, since it can only be read from its start;
a stored one is split into ranges, each of which has the lines that begin in it.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from .delimited import Scan, split

#: Bytes of a stored member that one task reads, and lines of one batch.
RANGE, LINES = 64 << 20, 20_000
ENCODING = "ISO-8859-1"


def opened(uri: str) -> pa.NativeFile:
    system, where = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
    return system.open_input_file(where)


def members(uri: str, wanted: list[str] | None = None) -> dict[str, zipfile.ZipInfo]:
    """Files at the top or one folder down, by their lower-case name without folder; an error if a wanted one is not there."""
    with opened(uri) as f, zipfile.ZipFile(f) as z:
        found: dict[str, zipfile.ZipInfo] = {}
        for info in sorted(z.infolist(), key=lambda i: -i.filename.count("/")):
            if not info.is_dir() and info.filename.count("/") <= 1:
                found[info.filename.split("/")[-1].lower()] = info
    if wanted is None:
        return found
    missing = [n for n in wanted if n.lower() not in found]
    if missing:
        raise FileNotFoundError(f"{', '.join(missing)} not in {uri}")
    return {n.lower(): found[n.lower()] for n in wanted}


def line_batches(stream: io.BufferedIOBase, low: int, high: int) -> Iterator[list[bytes]]:
    """Lines that begin in [low, high) of a stream, in batches; the stream stands at ``low``, or one byte before it if it is not 0."""
    at = low
    if low:
        at = low - 1 + len(stream.readline())
    held: list[bytes] = []
    while at < high and (line := stream.readline()):
        at += len(line)
        held.append(line.rstrip(b"\r\n"))
        if len(held) == LINES:
            yield held
            held = []
    if held:
        yield held


def lines(spark: SparkSession, uri: str, wanted: list[str] | None = None, *, encoding: str = ENCODING, size: int = RANGE) -> DataFrame:
    """(member, low, place, line) of all lines of the wanted members; empty lines are left out.

    (low, place) orders the lines of a member: where the range begins, and the line's number in it from 0.
    """
    found = members(uri, wanted)
    tasks = []
    for name, info in found.items():
        step = size if info.compress_type == zipfile.ZIP_STORED else max(1, info.file_size)
        tasks += [(name, info.filename, low, min(low + step, info.file_size)) for low in range(0, info.file_size, step)]
    schema = "member string, file string, low long, high long"
    dealt = spark.createDataFrame(tasks, schema).repartitionByRange(max(1, len(tasks)), "member", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                with opened(uri) as f, zipfile.ZipFile(f) as z, z.open(task["file"]) as stream:
                    stream.seek(max(0, task["low"] - 1))
                    place = 0
                    for some in line_batches(stream, task["low"], task["high"]):
                        kept = [(place + k, line.decode(encoding)) for k, line in enumerate(some) if line]
                        place += len(some)
                        if kept:
                            places, texts = zip(*kept, strict=True)
                            columns = [pa.repeat(task["member"], len(kept)), pa.repeat(task["low"], len(kept)), pa.array(places, pa.int64()), pa.array(texts, pa.string())]
                            yield pa.RecordBatch.from_arrays(columns, names=["member", "low", "place", "line"])

    return dealt.mapInArrow(run, "member string, low long, place long, line string")


def first_lines(uri: str, wanted: list[str] | None = None, encoding: str = ENCODING) -> dict[str, str]:
    """The header of each member."""
    out = {}
    with opened(uri) as f, zipfile.ZipFile(f) as z:
        for name, info in members(uri, wanted).items():
            with z.open(info) as stream:
                out[name] = stream.readline().rstrip(b"\r\n").decode(encoding)
    return out


def scans(spark: SparkSession, uri: str, wanted: list[str] | None = None, *, sep: str = "|", encoding: str = ENCODING, size: int = RANGE) -> dict[str, Scan]:
    """A ``Scan`` of each member by its name, as ``delimited.scan`` gives for a file."""
    out = {}
    for name, header in first_lines(uri, wanted, encoding).items():
        own = lines(spark, uri, [name], encoding=encoding, size=size).where("low > 0 OR place > 0")
        out[name] = split(own.select("line"), [c.strip() for c in header.split(sep)], sep)
    return out
