"""Readers and writers give back what was put in."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from cartolith.sources import files, sinks

SQUARE = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]


def _save(path, data):
    path.write_text(json.dumps(data, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_layer(spark, tmp_path):
    path = _save(tmp_path / "a.json", {"schema_version": 1, "items": [{"id": "x:1", "n": 2}, {"id": None}], "odd": {"id": "no list"}})
    assert [tuple(r) for r in files.read_layer(spark, path, "items", "id:string,n:long").collect()] == [("x:1", 2), (None, None)]
    assert files.read_layer(spark, path, "odd", "id:string").count() == 0
    assert files.read_layer(spark, path, "absent", "id:string").count() == 0
    assert files.read_layer(spark, str(tmp_path / "none.json"), "items", "id:string") is None


def test_geojson_and_vendors(spark, tmp_path):
    feats = [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": SQUARE}, "properties": {"shapeISO": "", "ISO": "ES-C", "NAME_2": "A Coruña"}},
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [SQUARE, SQUARE]}, "properties": {"shapeID": "77"}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {}},
        {"type": "Feature", "geometry": None, "properties": {}},
    ]
    path = _save(tmp_path / "f.geojson", {"type": "FeatureCollection", "features": feats})
    got = files.vendor_columns(files.read_geojson(spark, path)).orderBy("feature", "part").collect()
    assert [(r.feature, r.part) for r in got] == [(0, 0), (1, 0), (1, 1)]
    assert got[0].rings == SQUARE
    assert [(r.iso, r.name, r.admin1, r.boundary_id) for r in got[:2]] == [("ES-C", "A Coruña", "", "ES-C-A Coruña"), ("UNK", "Unnamed Admin-2", "", "77")]
    assert files.read_boundaries(spark, str(tmp_path / "f")).count() == 3


def test_shapefile(spark, tmp_path):
    body = struct.pack("<i4d2i", 5, 0, 0, 4, 4, 1, 5) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in SQUARE[0])
    records = [struct.pack("<i", 0), body]
    data = b"".join(struct.pack(">ii", k + 1, len(r) // 2) + r for k, r in enumerate(records))
    (tmp_path / "s.shp").write_bytes(bytes(100) + data)
    field = b"shapeName".ljust(11, b"\0") + b"C" + bytes(4) + bytes([10, 0]) + bytes(14)
    rows = b"".join(b" " + n.encode("latin-1").ljust(10) for n in ("none", "Ávila"))
    (tmp_path / "s.dbf").write_bytes(struct.pack("<B3BIHH20x", 3, 0, 0, 0, 2, 65, 11) + field + b"\r" + rows)
    (row,) = files.read_boundaries(spark, str(tmp_path / "s")).collect()
    assert (row.record, row.rings, row.name) == (2, SQUARE, "Ávila")


def test_counts_and_required(spark, tmp_path):
    df = spark.createDataFrame([("p:2", "OK", 3), ("p:1", "OK", 5), ("p:3", "NO_AREA", 9)], "id string, status string, n int")
    sinks.write_csv(df, str(tmp_path / "c"), "id")
    got = files.read_counts(spark, str(tmp_path / "c"), "id", "n", status="OK")
    assert sorted(tuple(r) for r in got.collect()) == [("p:1", 5), ("p:2", 3)]
    assert files.required(df, "id", "p:3").first().n == 9
    for bad in (df, df.union(df)):
        with pytest.raises(Exception, match="rows with this key"):
            files.required(bad, "id", "p:9" if bad is df else "p:1").collect()


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", SQUARE, "red"), (1, "é", [], "blue")], "id int, name string, rings array<array<array<double>>>, color string")
    sinks.write_document(df.select("id", "name"), str(tmp_path / "d"), "items", "id", schema_version=1)
    text = "".join(r.value for r in spark.read.text(str(tmp_path / "d")).collect())
    assert json.loads(text) == {"schema_version": 1, "items": [{"id": 1, "name": "é"}, {"id": 2, "name": "b"}]}
    sinks.write_geojson(df, str(tmp_path / "g"))
    (line,) = spark.read.text(str(tmp_path / "g")).collect()
    assert json.loads(line.value) == {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": SQUARE}, "properties": {"id": 2, "name": "b"}}


def test_pyramid_and_blocks(spark, tmp_path):
    px = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 0, 6), (1, 1, 0, 7), (1, 1, 0, 7), (2, 3, 1, 1), (2, 3, 1, 2)], "z int, x int, y int, value int")
    path = str(tmp_path / "p")
    sinks.write_pyramid(px, path, spark.createDataFrame([(2, 3, 1)], "z int, x int, y int"))
    assert spark.read.parquet(path).select("z", "x", "y").distinct().collect() == [(1, 0, 0)]
    row = sinks.manifest(sinks.full_tiles(px), F.struct(F.lit(2).alias("gamma"))).first()
    assert row.counts == {1: 1, 2: 1} and len(row.profile_hash) == 16
    grid = sinks.raster_blocks(spark.range(30).select((F.col("id") / 6).cast("int").alias("row"), (F.col("id") % 6).cast("int").alias("col")), 4)
    got = sorted(tuple(r) for r in sinks.block_manifest(grid).collect())
    assert got == [(0, 0, 0, 0, 4, 4), (0, 1, 0, 4, 4, 2), (1, 0, 4, 0, 1, 4), (1, 1, 4, 4, 1, 2)]


def test_publish(spark, tmp_path):
    tiles = spark.createDataFrame([(1, 0, 0, b"a"), (1, 1, 0, b"b")], "z int, x int, y int, data binary")
    good, bad = (spark.createDataFrame([(1, n)], "z int, count long") for n in (2, 3))
    with pytest.raises(ValueError, match="not published"):
        sinks.publish(spark, {"deep": (tiles, good), "shelf": (tiles, bad)}, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    sinks.publish(spark, {"deep": (tiles, good)}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "deep")).count() == 2
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["deep"]


def test_documents_in_parts(spark, tmp_path):
    sinks.write_document(spark.range(1000).repartition(7).selectExpr("id", "concat('n', id) as name"), str(tmp_path / "d"), "items", "id", note="é")
    (file,) = [p for p in (tmp_path / "d").iterdir() if not p.name.startswith(".")]
    assert json.loads(file.read_text(encoding="utf-8")) == {"note": "é", "items": [{"id": k, "name": f"n{k}"} for k in range(1000)]}
    sinks.write_document(spark.range(0), str(tmp_path / "d"), "items", "id")
    assert json.loads((tmp_path / "d" / "part-00000.txt").read_text()) == {"items": []}
    assert [p.name for p in tmp_path.iterdir()] == ["d"]


def test_publish_digests_and_replaces(spark, tmp_path):
    png = sinks.PNG + b"x" + bytes.fromhex("49454E44AE426082")
    tiles = spark.createDataFrame([(1, 0, 0, png), (1, 1, 0, png + b"")], "z int, x int, y int, data binary")
    other = spark.createDataFrame([(1, 0, 0, png), (1, 2, 0, png)], "z int, x int, y int, data binary")
    broken = spark.createDataFrame([(1, 0, 0, png), (1, 1, 0, b"GIF")], "z int, x int, y int, data binary")
    said, out = sinks.tiles_digest(tiles), str(tmp_path / "out")
    sinks.publish(spark, {"deep": (tiles, said)}, out, sinks.is_png)
    for wrong in (other, broken):
        with pytest.raises(ValueError, match="not published"):
            sinks.publish(spark, {"deep": (wrong, said)}, out, sinks.is_png)
    assert spark.read.parquet(f"{out}/deep").count() == 2
    sinks.publish(spark, {"deep": (other, sinks.tiles_digest(other)), "shelf": (tiles, said)}, out)
    assert sorted(r.x for r in spark.read.parquet(f"{out}/deep").collect()) == [0, 2]
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_deleted_rows_of_a_table():
    field = b"n".ljust(11, b"\0") + b"C" + bytes(4) + bytes([2, 0]) + bytes(14)
    data = struct.pack("<B3BIHH20x", 3, 0, 0, 0, 3, 65, 3) + field + b"\r" + b" a *b  c "
    assert list(files.attributes(data, "latin-1")) == [(1, {"n": "a"}), (3, {"n": "c"})]


def test_document_faults(spark, tmp_path):
    from cartolith.operators import checks

    good, bad = _save(tmp_path / "good.json", {"schema_version": 1, "items": []}), _save(tmp_path / "bad.json", {"items": [1]})
    out = checks.document_violations(spark, {good: True, bad: True, f"{tmp_path}/none.json": True, f"{tmp_path}/maybe.json": False}, (str(tmp_path),))
    assert sorted((r.key.rsplit("/", 1)[1], r.rule) for r in out.collect()) == [("bad.json", "no_schema_version"), ("maybe.json", "warning_missing"), ("none.json", "missing")]
    assert checks.document_violations(spark, {good: True}).collect() == []
