"""Polygons of an ESRI shapefile in a ZIP, by the published format: a main file of shapes and a dBASE table beside it.

A boundary file is small and is read on the driver, as the ring that a scan of places is clipped to.
"""

from __future__ import annotations

import struct
import zipfile
from dataclasses import dataclass
from pathlib import Path

Ring = list[tuple[float, float]]
#: Fixed values of the format: the code of polygons (plain, with z, with measures), and header sizes.
POLYGONS, SHAPES_FROM, FIELD_BYTES = (5, 15, 25), 100, 32


@dataclass
class Shape:
    rings: list[Ring]
    attributes: dict[str, str]


def polygons(raw: bytes) -> list[list[Ring]]:
    """Rings of (longitude, latitude) of every record; none for a shape of another kind."""
    at, out = SHAPES_FROM, []
    while at + 12 <= len(raw):
        (words,) = struct.unpack_from(">i", raw, at + 4)
        body = raw[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words
        (kind,) = struct.unpack_from("<i", body)
        if kind not in POLYGONS:
            out.append([])
            continue
        parts, points = struct.unpack_from("<2i", body, 36)
        starts = [*struct.unpack_from(f"<{parts}i", body, 44), points]
        flat = struct.unpack_from(f"<{2 * points}d", body, 44 + 4 * parts)
        pairs = list(zip(flat[::2], flat[1::2], strict=True))
        out.append([pairs[a:b] for a, b in zip(starts, starts[1:], strict=False)])
    return out


def attributes(raw: bytes, encoding: str = "utf-8") -> list[dict[str, str]]:
    """Rows of the table, values as trimmed text."""
    rows, header, width = struct.unpack_from("<IHH", raw, 4)
    fields, at = [], 32
    while at + FIELD_BYTES <= header and raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(encoding), raw[at + 16]))
        at += FIELD_BYTES
    out = []
    for k in range(rows):
        low, row = header + k * width + 1, {}
        for name, size in fields:
            row[name] = raw[low : low + size].decode(encoding, "replace").strip()
            low += size
        out.append(row)
    return out


def read_zip(path: str | Path) -> list[Shape]:
    """Shapes of the one shapefile in a ZIP, each with its row of the table."""
    with zipfile.ZipFile(path) as z:
        names = {n.lower(): n for n in z.namelist()}
        main = next((n for n in sorted(names) if n.endswith(".shp")), None)
        if main is None:
            raise FileNotFoundError(f"no shapefile in {path}")
        shapes = polygons(z.read(names[main]))
        table = names.get(main[:-4] + ".dbf")
        rows = attributes(z.read(table)) if table else []
    return [Shape(r, rows[k] if k < len(rows) else {}) for k, r in enumerate(shapes)]


def boundary(path: str | Path, column: str, value: str) -> Ring:
    """The largest ring, by number of corners, of the shape whose attribute has this value."""
    found = [r for s in read_zip(path) if s.attributes.get(column) == value for r in s.rings]
    if not found:
        raise ValueError(f"no shape with {column} = {value}")
    return max(found, key=len)
