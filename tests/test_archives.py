"""Archives read in parts: every row once, however small the parts are."""

import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from apportion.operators import geo
from apportion.sources import shapes, tables


def layer(n):
    """A shapefile of n squares, every fifth without a shape; with its table and index."""
    shp, index, offset = b"", b"", 100
    for k in range(n):
        ring = [(k, 0), (k, 2), (k + 2, 2), (k + 2, 0), (k, 0)]
        body = struct.pack("<i", 0) if k % 5 == 4 else struct.pack("<i4d2i1i", 5, k, 0, k + 2, 2, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in ring)
        index += struct.pack(">ii", offset // 2, len(body) // 2)
        shp += struct.pack(">ii", k + 1, len(body) // 2) + body
        offset += 8 + len(body)
    fields = [(b"GEOID20", b"C", 6), (b"NAME", b"C", 9)]
    head = struct.pack("<B3xIHH20x", 3, n, 32 + 32 * len(fields) + 1, 1 + sum(w for *_, w in fields))
    head += b"".join(name.ljust(11, b"\0") + kind + bytes(4) + bytes([w]) + bytes(15) for name, kind, w in fields) + b"\r"
    table = b"".join(b" " + str(k).rjust(6).encode() + f"né {k}".encode().ljust(9) for k in range(n))
    return bytes(100) + shp, head + table, bytes(100) + index


@pytest.mark.parametrize("split", [200, 5_000, 1 << 25])
def test_shapes_in_parts(spark, tmp_path, split):
    shp, dbf, shx = layer(100)
    for name, members in (("a.zip", {"x.SHP": shp, "x.dbf": dbf, "x.shx": shx, "x.prj": b'GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983"]]'}), ("b.zip", {"y.shp": shp, "y.dbf": dbf})):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as z:
            for member, data in members.items():
                z.writestr(member, data)
    assert geo.crs_of(shapes.zipped_shapes(spark, f"{tmp_path}/a.zip", ("NAME",))) == "EPSG:4269"
    assert geo.crs_of(shapes.zipped_shapes(spark, f"{tmp_path}/b.zip", ("NAME",))) is None
    with pytest.raises(ValueError, match="different"):
        shapes.zipped_shapes(spark, str(tmp_path), ("NAME",))
    with zipfile.ZipFile(tmp_path / "b.zip", "a") as z:
        z.writestr("y.PRJ", 'GEOGCS["NAD83"]')
    (tmp_path / "notes.txt").write_text("no archive")
    rows = shapes.zipped_shapes(spark, str(tmp_path), ("GEOID20", "NAME", "OTHER"), split_bytes=split)
    got = sorted((int(r["GEOID20"]), r["NAME"], r["OTHER"], r["area"]) for r in rows.withColumn("area", geo.area(F.col("rings"))).collect())
    assert got == sorted(2 * [(k, f"né {k}", "", 0.0 if k % 5 == 4 else 4.0) for k in range(100)])
    # b.zip has no index, so it is one part.
    parts = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 20 if split == 200 else parts <= 5
    bare = shapes.zipped_shapes(spark, f"{tmp_path}/a.zip", ("NAME",), with_rings=False, split_bytes=split)
    assert bare.columns == ["NAME"] and bare.distinct().count() == 100


@pytest.mark.parametrize("split", [1, 7, 1_000])
def test_text_in_parts(spark, tmp_path, split):
    lines = ["﻿BLOCKID|X|DISTRICT", *(f"{k:03}|\"a|b\"|d{k % 7}" for k in range(60)), "", "61|short"]
    for name, end in (("a.zip", "\n"), ("b.zip", "\r\n")):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("other.txt", "no\n")
            z.writestr("x_VTD.txt", end.join(lines))
    rows = tables.zipped_text(spark, str(tmp_path), "_vtd.txt", ("DISTRICT", "BLOCKID"), split_bytes=split)
    assert sorted(tuple(r) for r in rows.collect()) == sorted(2 * [*((f"d{k % 7}", f"{k:03}") for k in range(60)), ("", "61")])
    with pytest.raises(Exception, match="columns are missing"):
        tables.zipped_text(spark, str(tmp_path), "_VTD.txt", ("OTHER",)).collect()
