"""A run as a tree of digests, and a store by content that shares what runs have in common.

A file is its chunks, a folder the sorted listing of what is in it, and the root names all of a run. Tasks read each
file once: they hash its chunks and the whole, and put chunks that the store lacks there. What is listed on
the driver is a row a file.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import media_type
from ..storage import Folder

CHUNK = 4 << 20
#: Files of a run that are about the run and no part of it.
NOT_PACKED = ("manifest.json", "verification.json")


def local(uri: str) -> str:
    return re.sub("^file:/+", "file:///", uri)


def put_chunk(system: fs.FileSystem, root: str, digest: str, data: bytes) -> int:
    """Bytes written: none if the chunk is there. Written beside its place and moved, so that it is there whole or not at all."""
    at = f"{root}/chunks/{digest[:2]}/{digest}"
    if system.get_file_info(at).type == fs.FileType.File:
        return 0
    system.create_dir(at.rpartition("/")[0], recursive=True)
    beside = f"{at}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(beside) as out:
        out.write(data)
    system.move(beside, at)
    return len(data)


def digested(spark: SparkSession, path: str, *, store: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """(name, path, size, sha256, chunks, rows, copied, media_type) of the files under a folder; ``name`` is relative to it.

    ``rows``: of a Parquet file. ``copied``: bytes put into ``store``, which had the rest.
    """
    files = [f for f in Folder(spark, path).files() if not re.search(r"(^|/)[_.]", f[0]) and f[0] not in NOT_PACKED]
    wanted = spark.createDataFrame([(p, size, n) for n, p, size in files], "path string, size long, name string").repartition(max(1, min(len(files), 1024)), "path")

    def one(uri: str, title: str) -> tuple[str, list[str], int | None, int]:
        system, where = fs.FileSystem.from_uri(local(uri))
        there = fs.FileSystem.from_uri(local(store)) if store else None
        whole, chunks, copied = hashlib.sha256(), [], 0
        with system.open_input_stream(where) as stream:
            while piece := stream.read(chunk):
                whole.update(piece)
                chunks.append(hashlib.sha256(piece).hexdigest())
                if there:
                    copied += put_chunk(*there, chunks[-1], piece)
        rows = None
        if title.endswith(".parquet"):
            with system.open_input_file(where) as f:
                rows = pq.ParquetFile(f).metadata.num_rows
        return whole.hexdigest(), chunks, rows, copied

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64()]
        for batch in batches:
            if batch.num_rows:
                made = zip(*map(one, batch.column(0).to_pylist(), batch.column(2).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, t in zip(made, kinds, strict=True)]], names=["path", "size", "name", "sha256", "chunks", "rows", "copied"])

    found = wanted.mapInArrow(run, "path string, size long, name string, sha256 string, chunks array<string>, rows long, copied long")
    base = F.element_at(F.split("name", "/"), -1)
    return found.select("name", "path", "size", "sha256", "chunks", "rows", "copied", media_type(base).alias("media_type"))


@dataclass
class Tree:
    """``nodes``: digest to what it stands for; ``artifacts``: files and folders by name, for a manifest."""

    root: str = ""
    nodes: dict[str, dict] = field(default_factory=dict)
    artifacts: list[dict] = field(default_factory=list)

    def add(self, node: dict) -> str:
        digest = hashlib.sha256(json.dumps(node, sort_keys=True).encode()).hexdigest()
        self.nodes[digest] = node
        return digest


def tree(files: list[dict]) -> Tree:
    """The tree over rows of ``digested``: folders from the innermost out."""
    out, folders = Tree(), {"": {}}
    for f in sorted(files, key=lambda f: f["name"]):
        digest = out.add({"chunks": f["chunks"], "size": f["size"]})
        parent, _, base = f["name"].rpartition("/")
        folders.setdefault(parent, {})[base] = {"codec": "file", "digest": digest, "size": f["size"]}
        out.artifacts.append({"name": f["name"], "path": f["path"], "codec": "file", "size": f["size"], "digest": digest, "sha256": f["sha256"], "mediaType": f["media_type"], "rowCount": f["rows"]})
        while parent:
            parent = parent.rpartition("/")[0]
            folders.setdefault(parent, {})
    for name in sorted(folders, key=lambda n: (-n.count("/") if n else 1, n)):
        entries = folders[name]
        digest, size = out.add({"entries": entries}), sum(e["size"] for e in entries.values())
        if not name:
            out.root = digest
            continue
        parent, _, base = name.rpartition("/")
        folders[parent][base] = {"codec": "folder", "digest": digest, "size": size}
        counts = [a["rowCount"] for a in out.artifacts if a["name"].startswith(f"{name}/") and a["codec"] == "file" and a["rowCount"] is not None]
        out.artifacts.append({"name": name, "path": None, "codec": "folder", "size": size, "digest": digest, "sha256": None, "mediaType": None, "rowCount": sum(counts) if counts else None})
    out.artifacts.sort(key=lambda a: a["name"])
    return out


def publish_run(spark: SparkSession, folder: str, store: str) -> dict:
    """A run into a store by content: chunks it lacks, nodes it lacks, its manifest under its root, and last the pointer ``latest.json``.

    A run whose files are no longer those of its manifest is refused. Returns the root and the bytes and nodes that were new.
    """
    kept = Folder(spark, store)
    made = json.loads(Folder(spark, folder).read("manifest.json"))
    files = [r.asDict() for r in digested(spark, folder, store=store).collect()]  # a row a file
    found = tree(files)
    if found.root != made["root"]:
        raise ValueError(f"the files of {made['runId']} are not those of its manifest")
    todo, new = [found.root], []
    while todo:
        digest = todo.pop()
        # Where a node is, all below it is: nodes are written from the leaves up.
        if digest not in new and not kept.exists("nodes", f"{digest}.json"):
            new.append(digest)
            todo += [e["digest"] for e in found.nodes[digest].get("entries", {}).values()]
    for digest in reversed(new):
        kept.write(json.dumps(found.nodes[digest], sort_keys=True), "nodes", f"{digest}.json")
    kept.write(json.dumps(made, indent=1), f"{made['root']}.json")
    kept.write(json.dumps({"root": made["root"], "runId": made["runId"]}), "latest.json")
    return {"root": made["root"], "bytes": sum(f["copied"] for f in files), "nodes": len(new)}


def read_store(store: str, digest: str, name: str = "") -> Iterator[bytes]:
    """The bytes of a file by its own digest, or by its name under a folder's; FileNotFoundError if the store lacks it. Each chunk is checked."""
    system, root = fs.FileSystem.from_uri(local(store))

    def read(at: str) -> bytes:
        with system.open_input_stream(f"{root}/{at}") as f:
            return f.read()

    node = json.loads(read(f"nodes/{digest}.json"))
    for part in filter(None, name.split("/")):
        if part not in node.get("entries", {}):
            raise FileNotFoundError(f"{name} is not under {digest}")
        node = json.loads(read(f"nodes/{node['entries'][part]['digest']}.json"))
    for c in node["chunks"]:
        data = read(f"chunks/{c[:2]}/{c}")
        if hashlib.sha256(data).hexdigest() != c:
            raise OSError(f"chunk {c} is broken")
        yield data
