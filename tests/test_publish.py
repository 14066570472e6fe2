"""Digest trees, stores that share what runs have in common, and verification at gateways that lag, lie and fail."""

from __future__ import annotations

import hashlib
import json
import random

import pytest

from cadastre.operators import digests, publish, verify
from cadastre.storage import Folder


def run_of(spark, path, tables):
    for name, data in tables.items():
        target = path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
    files = [r.asDict() for r in digests.digested(spark, f"file://{path}").collect()]
    made = publish.manifest(path.name, digests.tree(files), {}, None)
    Folder(spark, f"file://{path}").write(json.dumps(made), "manifest.json")
    return made


def noise(seed, n):
    return random.Random(seed).randbytes(n)


def test_runs_share_what_did_not_change(spark, tmp_path, monkeypatch):
    # Tasks are handed the default at definition; small chunks through the argument of the operator.
    chunked = digests.digested
    monkeypatch.setattr(digests, "digested", lambda *a, **how: chunked(*a, chunk=1000, **how))
    tables = {"a/one.bin": noise(1, 5500), "a/two.bin": noise(2, 10), "b/c/deep.csv": noise(3, 2500), "top.json": b"{}", "empty.txt": b"", "_SUCCESS": b"", ".hidden": b"x"}
    first = run_of(spark, tmp_path / "r1", tables)
    changed = bytearray(tables["a/one.bin"])
    changed[3100] ^= 1
    second = run_of(spark, tmp_path / "r2", tables | {"a/one.bin": bytes(changed)})
    names = {a["name"]: a for a in first["artifacts"]}
    assert sorted(names) == ["a", "a/one.bin", "a/two.bin", "b", "b/c", "b/c/deep.csv", "empty.txt", "top.json"]
    assert names["a/one.bin"]["sha256"] == hashlib.sha256(tables["a/one.bin"]).hexdigest() and (names["a"]["codec"], names["a"]["size"]) == ("folder", 5510)
    store = f"file://{tmp_path}/store"
    told = [digests.publish_run(spark, f"file://{tmp_path}/{r}", store) for r in ("r1", "r2", "r2")]
    assert [t["bytes"] for t in told] == [5500 + 10 + 2500 + 2, 1000, 0]
    # The changed file, its folder and the root are new nodes; folder b is shared.
    assert [t["nodes"] for t in told] == [8 + 1, 3, 0]
    after = {a["name"]: a["digest"] for a in second["artifacts"]}
    assert {n for n in names if names[n]["digest"] != after[n]} == {"a", "a/one.bin"} and first["root"] != second["root"]
    for made, want in ((first, tables["a/one.bin"]), (second, bytes(changed))):
        assert b"".join(digests.read_store(store, made["root"], "a/one.bin")) == want
    assert b"".join(digests.read_store(store, after["b/c/deep.csv"])) == tables["b/c/deep.csv"] and list(digests.read_store(store, first["root"], "empty.txt")) == []
    with pytest.raises(FileNotFoundError):
        list(digests.read_store(store, first["root"], "a/none"))
    (tmp_path / "r2" / "top.json").write_text("[]")
    with pytest.raises(ValueError, match="not those of its manifest"):
        digests.publish_run(spark, f"file://{tmp_path}/r2", store)
    assert json.loads((tmp_path / "store" / "latest.json").read_text())["root"] == second["root"]


def test_the_tree_does_not_depend_on_the_order_of_files():
    files = [{"name": n, "path": n, "size": 1, "sha256": n, "chunks": [n], "rows": k, "media_type": "x"} for k, n in enumerate(["a/b/c", "a/d", "e", "a/b/f"])]
    found = digests.tree(files)
    assert found.root == digests.tree(files[::-1]).root and {a["name"]: a["rowCount"] for a in found.artifacts} == {"a": 4, "a/b": 3, "a/b/c": 0, "a/b/f": 3, "a/d": 1, "e": 2}
    assert digests.tree([]).artifacts == [] and len(digests.tree([]).root) == 64


def manifest_of(bodies):
    files = [{"name": n, "codec": "file", "size": len(b), "digest": hashlib.sha256(n.encode()).hexdigest(), "sha256": hashlib.sha256(b).hexdigest()} for n, b in bodies.items()]
    return {"root": "r" * 64, "artifacts": [*files, {"name": "folder", "codec": "folder"}]}


BODIES = {"big": b"x" * 5000, "small": b"s", "mid": b"m" * 100}


def gateway(calls, behave):
    """An ``Open`` that gives BODIES as ``behave(gateway, name, attempt)`` says: ok, lie, short, 404, 504 or down."""
    made = manifest_of(BODIES)
    of = {a["digest"]: a["name"] for a in made["artifacts"] if a["codec"] == "file"}

    def open_url(url):
        where, rest = url.split("/", 1)
        name = of.get(rest, rest.split("/")[-1])
        with (calls / f"{where}-{rest.replace('/', '-')}").open("a") as f:
            f.write("x")
        attempt = (calls / f"{where}-{rest.replace('/', '-')}").stat().st_size
        how = behave(where, "root" if rest.startswith("r" * 64) else name, attempt)
        if how == "down":
            raise OSError("no route")
        if how in ("404", "504"):
            return int(how), []
        body = {"lie": b"?" + BODIES[name][1:], "short": BODIES[name][:-1]}.get(how, BODIES[name])
        return 200, [body[:3], body[3:]]

    return made, open_url


CASES = {
    "all well": (lambda g, n, k: "ok", {}, True),
    "one lags": (lambda g, n, k: "504" if g == "g1" and k < 3 else "ok", {}, True),
    "one lies": (lambda g, n, k: "lie" if g == "g1" else "ok", {n: 2 for n in BODIES}, True),
    "one is down and one lies about one": (lambda g, n, k: "down" if g == "g1" else "lie" if g == "g2" and n == "mid" else "ok", {"big": 2, "small": 2, "mid": 1}, False),
    "two give too little": (lambda g, n, k: "short" if g != "g3" and n == "big" else "ok", {"big": 1}, False),
    "names under the root are not found": (lambda g, n, k: "404" if n == "root" and g != "g3" else "ok", {}, False),
}


@pytest.mark.parametrize("case", CASES)
def test_verdicts(spark, tmp_path, case):
    behave, matched, passed = CASES[case]
    made, open_url = gateway(tmp_path, behave)
    got = verify.verify(spark, made, ["g1", "g2", "g3"], open_url, attempts=3, pace=0.0)
    assert {r["artifact"]: r["matched"] for r in got.artifacts.collect()} == {n: 3 for n in BODIES} | matched and (got.all_matched, got.probe, got.least) == (passed, "small", 2)
    assert {(r["gateway"], r["artifact"]) for r in got.checks.collect()} == {(g, n) for g in ("g1", "g2", "g3") for n in [*BODIES, ""]}
    if case == "one lags":
        assert {r["attempts"] for r in got.checks.where("gateway = 'g1'").collect()} == {3} and {r["attempts"] for r in got.checks.where("gateway <> 'g1'").collect()} == {1}
    if case == "one is down and one lies about one":
        assert {(r["ok"], r["status"], r["error"]) for r in got.checks.where("gateway = 'g1'").collect()} == {(False, None, "no route")}


def test_few_gateways_and_no_files(spark, tmp_path):
    made, open_url = gateway(tmp_path, lambda g, n, k: "ok")
    assert verify.verify(spark, made, ["g1"], open_url, pace=0.0).all_matched and verify.verify(spark, made, ["g1"], open_url, only=["mid"], pace=0.0).probe == "mid"
    assert not verify.verify(spark, {"root": "r", "artifacts": []}, ["g1"], open_url).all_matched
    assert [verify.wait_before(s, k) for s, k in ((None, 1), (404, 2), (429, 1), (504, 2), (504, 9))] == [5.0, 10.0, 20.0, 40.0, 180.0]
