"""Lossless raw scans of delimited files: everything a string, malformed rows set aside and counted."""

from __future__ import annotations

import hashlib
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import stored

# The files of the roll's archive and the tables they become.
ROLL_FILES = {
    name: f"raw_ocpa_{name}" for name in ("parcel", "site", "owner", "mail", "building", "detail", "sales", "permit", "legal", "lu_dor", "lu_sub")
}


@dataclass
class Scan:
    """Good rows, short ones padded with nulls; and rows with more fields than the header, as they stood."""

    rows: DataFrame
    quarantined: DataFrame


def lines_of(spark: SparkSession, path: str, encoding: str, *, header: bool) -> DataFrame:
    """Whole lines as ``line``, without the header; a separator that no line has keeps them whole."""
    read = spark.read.schema("line string").option("maxCharsPerColumn", 4 << 20)
    return read.csv(path, sep="\x01", header=header, quote="", escape="", encoding=encoding, enforceSchema=True)


def header_of(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    first = lines_of(spark, path, encoding, header=False).first()
    return [] if first is None else [n.strip() for n in first["line"].split(sep)]


def scan(spark: SparkSession, path: str, *, columns: list[str] | None = None, sep: str = "|", encoding: str = "ISO-8859-1") -> Scan:
    """A header-led file without quoting. A row with too few fields is kept, one with too many is quarantined.

    Empty fields are null. Lines are split here and not by the reader, which counts short rows as
    broken and cuts long ones without saying what it cut.
    """
    names = columns or header_of(spark, path, sep, encoding)
    found = split(lines_of(spark, path, encoding, header=True), names, sep)
    return Scan(found.rows, found.quarantined.withColumn("source_file", F.input_file_name()))


def split(lines: DataFrame, names: list[str], sep: str = "|") -> Scan:
    """Rows of ``lines`` (line); those with too many fields as they stand."""
    fields = lines.select("line", F.split("line", re.escape(sep), -1).alias("fields"))
    rows = fields.where(F.size("fields") <= len(names)).select(*[F.nullif(F.get("fields", F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)])
    return Scan(rows, fields.where(F.size("fields") > len(names)).select("line"))


def rejects(spark: SparkSession, path: str, *, columns: list[str] | None = None, sep: str = "|", encoding: str = "ISO-8859-1") -> DataFrame:
    """(file, line, column, reason, text) of every row that ``scan`` quarantines: where it stands in its file, from 1, and its first field too many.

    One pass: tasks count the lines of each block of a file as they look for rejects, and a block's first line is
    the sum of the counts before it. A row a block and a reject is all that is stored; nothing is sorted.
    """
    names = columns or header_of(spark, path, sep, encoding)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    most, mark = len(names), sep.encode(encoding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], int] = {}
        found: list[tuple] = []
        for batch in batches:
            for file, start, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = counts[file, start] = counts.get((file, start), 0) + 1
                if raw.count(mark) >= most and (start or at > 1):
                    found.append((file, start, at, raw.decode(encoding)))
        rows = [*found, *((f, s, n, None) for (f, s), n in counts.items())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["file", "start", "at", "text"])

    told = stored(lines.mapInArrow(run, "file string, start long, at long, text string"), "rejects")
    before = F.coalesce(F.sum("at").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = told.where("text IS NULL").select("file", "start", before.alias("before"))
    return told.where("text IS NOT NULL").join(blocks, ["file", "start"]).select("file", (F.col("before") + F.col("at")).alias("line"), F.lit(most + 1).alias("column"), F.lit("TOO MANY COLUMNS").alias("reason"), "text")


def with_provenance(rows: DataFrame, *, tax_year: int, source_file: str, run_id: str) -> DataFrame:
    return rows.withColumns({"tax_year": F.lit(tax_year), "source_file": F.lit(source_file), "loaded_run_id": F.lit(run_id)})


def sha256_of(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(1 << 20):
            digest.update(part)
    return digest.hexdigest()


def extract_member(archive: str | Path, member: str, into: str | Path) -> Path:
    """A file of a ZIP by its name at the top or one folder down; an error if neither is there. Driver-side."""
    with zipfile.ZipFile(archive) as z:
        names = {n: n.split("/")[-1].lower() for n in z.namelist() if n.count("/") <= 1 and not n.endswith("/")}
        found = [n for n, short in names.items() if short == member.lower()]
        if not found:
            raise FileNotFoundError(f"{member} is not in {archive}")
        return Path(z.extract(sorted(found, key=lambda n: n.count("/"))[0], into))


@dataclass
class Load:
    status: str
    digest: str
    seen: int = 0
    quarantined: int = 0
    tables: Mapping[str, DataFrame] = None  # type: ignore[assignment]


def load_roll(spark: SparkSession, files: Mapping[str, str], *, digest: str, loaded: Mapping[int, str], tax_year: int, run_id: str, force: bool = False) -> Load:
    """Load the roll's files (table name to path) unless this year's digest is loaded already."""
    return load_scans({n: lambda p=p: scan(spark, p) for n, p in files.items()}, digest=digest, loaded=loaded, tax_year=tax_year, run_id=run_id, force=force, named=files)


def load_scans(scans: Mapping[str, Callable[[], Scan]], *, digest: str, loaded: Mapping[int, str], tax_year: int, run_id: str, force: bool = False, named: Mapping[str, str] | None = None) -> Load:
    """The same for scans that are made when they are needed. ``named``: what to call their source file, if not by their name."""
    if not force and loaded.get(tax_year) == digest:
        return Load("skipped", digest)
    tables, seen, bad = {}, 0, 0
    for name, make in scans.items():
        found = make()
        tables[name] = with_provenance(found.rows, tax_year=tax_year, source_file=(named or {}).get(name, name), run_id=run_id)
        seen, bad = seen + found.rows.count(), bad + found.quarantined.count()
    return Load("loaded", digest, seen, bad, tables)
