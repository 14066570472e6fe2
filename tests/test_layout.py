"""Where rows lie on disk: exports along a curve, keyed tables merged when they are read."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastre.contracts import CONTRACTORS, PROPERTIES
from cadastre.functions import geo
from cadastre.operators import publish
from cadastre.operators.keyed import KeyedTable


def morton(lat, lng):
    cell = lambda at, low, span: min(max(int((at - low) / span * (1 << 26) // 1), 0), (1 << 26) - 1)
    y, x = cell(lat, -90.0, 180.0), cell(lng, -180.0, 360.0)
    return sum(((y >> k & 1) << 2 * k + 1) | ((x >> k & 1) << 2 * k) for k in range(26))


def test_the_curve_takes_bits_in_turn(spark):
    draw = random.Random(1)
    places = [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(200)] + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (28.2919, -81.4076)]
    rows = spark.createDataFrame([*places, (None, 1.0), (1.0, None)], "lat double, lng double").withColumn("key", geo.curve_key("lat", "lng")).collect()
    assert [r["key"] for r in rows] == [*(morton(*p) for p in places), None, None]


def parcels(spark, n):
    draw = random.Random(7)
    rows = [(f"{draw.getrandbits(64):016x}", f"P{k}", 27.55 + draw.random() * 0.85, -81.7 + draw.random() * 0.85) if k % 50 else (f"{draw.getrandbits(64):016x}", f"P{k}", None, None) for k in range(n)]
    return spark.createDataFrame(rows, "property_id string, parcel_identifier string, latitude double, longitude double")


def groups(path):
    """Of each row group: rows, and the least and greatest of latitude and longitude."""
    out = []
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = {meta.row_group(0).column(c).path_in_schema: c for c in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(names[n]).statistics for n in ("latitude", "longitude")]
            out.append((meta.row_group(g).num_rows, *[(s.min, s.max) if s.has_min_max else None for s in stats]))
    return out


@pytest.mark.parametrize("file_rows", [100_000, 3000])
def test_a_box_reads_few_row_groups_of_an_export(spark, tmp_path, file_rows):
    given = parcels(spark, 8000)
    publish.export(given, PROPERTIES, str(tmp_path / "p"), file_rows=file_rows, group_rows=100)
    got = spark.read.parquet(str(tmp_path / "p"))
    assert got.columns == PROPERTIES.schema.names and got.select(given.columns).exceptAll(given).isEmpty() and got.count() == 8000
    assert len(list((tmp_path / "p").glob("*.parquet"))) == -(-8000 // file_rows)
    miles = 1 / 69.0
    low, high = (28.0 - miles, -81.3 - miles / 0.88), (28.0 + miles, -81.3 + miles / 0.88)
    found = groups(tmp_path / "p")
    read = [g for g in found if all(a and a[0] <= h and a[1] >= w for a, w, h in zip(g[1:], low, high, strict=True))]
    assert len(found) >= 80 and 0 < len(read) <= len(found) // 10 and sum(g[0] for g in found) == 8000
    # By key alone the row groups of the same rows all span the county.
    got.repartition(1).sortWithinPartitions("property_id").write.option("parquet.block.row.count.limit", 100).parquet(str(tmp_path / "flat"))
    assert all(g[1][0] < 27.7 and g[1][1] > 28.2 for g in groups(tmp_path / "flat"))
    near = F.col("latitude").between(low[0], high[0]) & F.col("longitude").between(low[1], high[1])
    assert got.where(near).count() == given.where(near).count() > 0


def test_exports_without_coordinates_are_by_key(spark, tmp_path):
    publish.export(spark.createDataFrame([("b",), ("a",), ("c",)], "contractor_id string"), CONTRACTORS, str(tmp_path / "c"))
    assert [r["contractor_id"] for r in spark.read.parquet(str(tmp_path / "c")).collect()] == ["a", "b", "c"]


def size(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


def table_of(spark, path, **how):
    return KeyedTable(spark, f"file://{path}", ["k"], lambda have: [F.col("at").desc_nulls_last()], **{"buckets": 4, "most_changes": 3} | how)


@pytest.mark.parametrize("newest", [False, True])
def test_merges_are_those_of_a_dictionary(spark, tmp_path, newest):
    draw, want, table = random.Random(newest), {}, table_of(spark, tmp_path / "t", newest=newest)
    assert table.current() is None
    for batch in range(7):
        rows = [(draw.randrange(12), draw.randrange(20), f"{batch}-{n}") for n in range(draw.choice([0, 1, 3, 8]))]
        table.merge(spark.createDataFrame(rows, "k int, at int, v string"), batch)
        own = {}
        for k, at, _ in rows:
            own[k] = max(own.get(k, -1), at)
        for k, at in own.items():
            if k not in want or newest or at >= want[k][0]:
                want[k] = (at, batch)
        if batch % 2:
            table = table_of(spark, tmp_path / "t", newest=newest)
        got = {r["k"]: (r["at"], int(r["v"].split("-")[0])) for r in table.current().collect()}
        assert got == want
        # The same batch again, as after a restart, with other rows: nothing changes.
        table.merge(spark.createDataFrame([(0, 99, "again-0")], "k int, at int, v string"), batch)
        assert {r["k"]: r["at"] for r in table.current().collect()} == {k: at for k, (at, _) in want.items()}
    for k in range(12):
        assert [r["at"] for r in table.row(k=k).collect()] == ([want[k][0]] if k in want else [])
    assert len(table.versions()) == 2


def test_a_small_batch_writes_little(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", buckets=8, most_changes=5)
    many = spark.range(40_000).selectExpr("CAST(id AS INT) AS k", "1 AS at", "sha2(CAST(id AS STRING), 256) AS v")
    table.merge(many, 0)
    whole = size(tmp_path / "t")
    before = table.current()
    table.merge(spark.createDataFrame([(5, 2, "five"), (41_000, 2, "new")], "k int, at int, v string"), 1)
    assert size(tmp_path / "t") - whole < whole / 100
    assert before.where("k = 5").first()["at"] == 1 and table.current().where("k = 5").first()["v"] == "five" and table.current().count() == 40_001
    for batch in range(2, 6):
        table.merge(spark.createDataFrame([(5, batch + 1, f"b{batch}")], "k int, at int, v string"), batch)
    number, version = table.version()
    assert version.changes == [5] and table.current().where("k = 5").first()["v"] == "b5"
    # The compaction at batch 4 wrote all buckets once; the next one writes the bucket of key 5 alone.
    bases = {f.split("/")[0] for f in version.base.values()}
    table.compact()
    after = {f.split("/")[0] for f in table.version()[1].base.values()}
    assert len(bases) == 1 and len(after) == 2 and table.current().count() == 40_001


def test_a_crash_before_the_version_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path / "t")
    table.merge(spark.createDataFrame([(1, 1, "a")], "k int, at int, v string"), 0)
    monkeypatch.setattr(table, "put", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        table.merge(spark.createDataFrame([(1, 2, "half"), (2, 1, "half")], "k int, at int, v string"), 1)
    table = table_of(spark, tmp_path / "t")
    assert [(r["k"], r["v"]) for r in table.current().collect()] == [(1, "a")]
    table.merge(spark.createDataFrame([(1, 2, "b")], "k int, at int, v string").withColumn("w", F.lit(7)), 1)
    assert [(r["k"], r["v"], r["w"]) for r in table.current().collect()] == [(1, "b", 7)]


@settings(max_examples=25)
@given(st.floats(27, 29), st.floats(-82, -80), st.floats(27, 29), st.floats(-82, -80))
def test_near_cells_share_their_first_bits(a, b, c, d):
    # Keys that share their first 2n bits lie in one cell of 180 / 2^n degrees.
    x, y = morton(a, b), morton(c, d)
    n = (52 - (x ^ y).bit_length()) // 2
    assert abs(a - c) <= 180 / 2**n + 1e-6 and abs(b - d) <= 360 / 2**n + 1e-6
