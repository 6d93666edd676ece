"""Shapefiles that the tests write themselves, read back by ranges of records."""

import datetime as dt
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from linemart.sources import shapefile

WGS84 = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
UTM_17S = f'PROJCS["WGS_1984_UTM_Zone_17S",{WGS84},PROJECTION["Transverse_Mercator"],PARAMETER["False_Easting",500000.0],PARAMETER["False_Northing",10000000.0],PARAMETER["Central_Meridian",-81.0],PARAMETER["Scale_Factor",0.9996],PARAMETER["Latitude_Of_Origin",0.0],UNIT["Meter",1.0]]'


def written(folder, shapes, fields, rows, prj=None, deleted=(), encoding="utf-8"):
    """fields: (name, kind, length, decimals); shapes: lists of rings, or None."""
    shp, index, at = b"", b"", 50
    for k, rings in enumerate(shapes):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            starts = np.cumsum([0, *[len(r) for r in rings]])[:-1].tolist()
            content = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        words = len(content) // 2
        shp += struct.pack(">2i", k + 1, words) + content
        index += struct.pack(">2i", at, words)
        at += 4 + words
    head = lambda n: struct.pack(">i20xi", 9994, n // 2) + struct.pack("<2i8d", 1000, 5, *[0] * 8)
    (folder / "b.shp").write_bytes(head(100 + len(shp)) + shp)
    (folder / "b.shx").write_bytes(head(100 + len(index)) + index)
    length = 1 + sum(f[2] for f in fields)
    dbf = struct.pack("<B3BIHH20x", 3, 126, 1, 1, len(rows), 32 * len(fields) + 33, length)
    dbf += b"".join(n.encode().ljust(11, b"\0") + k.encode() + b"\0" * 4 + bytes([size, d]) + b"\0" * 14 for n, k, size, d in fields) + b"\r"
    for k, row in enumerate(rows):
        dbf += (b"*" if k in deleted else b" ") + b"".join((v.encode(encoding).ljust(f[2]) if f[1] not in "NF" else v.encode().rjust(f[2]))[: f[2]] for v, f in zip(row, fields, strict=True))
    (folder / "b.dbf").write_bytes(dbf + b"\x1a")
    if prj:
        (folder / "b.prj").write_text(prj)
    return f"{folder}/b.shp"


def box(x, y, s=1.0, hole=False):
    ring = [(x, y), (x, y + s), (x + s, y + s), (x + s, y), (x, y)]  # clockwise
    return ring[::-1] if hole else ring


FIELDS = [("DPA_PARROQ", "C", 6, 0), ("DPA_DESPAR", "C", 20, 0), ("N", "N", 9, 0), ("AREA", "N", 12, 3), ("DAY", "D", 8, 0), ("OK", "L", 1, 0)]


def test_attributes_and_polygons_come_back(spark, tmp_path):
    shapes = [[box(0, 0)], [box(0, 0, 10), box(1, 1, 2, hole=True), box(1.5, 1.5, 0.5), box(20, 20), box(20.2, 20.2, 0.1, hole=True)], None, [box(5, 5, hole=True)], [box(7, 7)]]
    rows = [("010150", "Cañar", "7", "1.500", "20240229", "T"), ("090112", "Ñuñoa é", "-3", "2.25", "", "F"), ("000001", "", "", "", "00000000", "?"), ("ISLA", "x", "12", "*****", "20200101", "y"), ("999999", "gone", "1", "1", "20200101", "T")]
    path = written(tmp_path, shapes, FIELDS, rows, prj=WGS84, deleted={4})
    df = shapefile.read_shapefile(spark, path, ["DPA_PARROQ", "DPA_DESPAR"], records=2)
    assert df.rdd.getNumPartitions() == 3
    got = {r["DPA_PARROQ"]: r for r in df.collect()}
    assert list(got) == ["010150", "090112", "000001", "ISLA"]
    assert tuple(got["010150"])[1:6] == ("Cañar", 7, 1.5, dt.date(2024, 2, 29), True) and tuple(got["000001"])[1:] == (None,) * 6
    assert tuple(got["ISLA"])[2:6] == (12, None, dt.date(2020, 1, 1), True)
    floats = lambda ring: [[float(x), float(y)] for x, y in ring]
    assert got["090112"]["polygons"] == [[floats(box(0, 0, 10)), floats(box(1, 1, 2, hole=True))], [floats(box(1.5, 1.5, 0.5))], [floats(box(20, 20)), floats(box(20.2, 20.2, 0.1, hole=True))]]
    assert got["ISLA"]["polygons"] == [[floats(box(5, 5, hole=True))]]


def test_any_ranges_of_records_give_the_same_rows(spark, tmp_path):
    r = random.Random(3)
    shapes = [[box(r.random(), r.random(), r.random() + 0.1) for _ in range(r.randint(1, 3))] for _ in range(137)]
    path = written(tmp_path, shapes, FIELDS[:3], [(f"{k:06d}", "x", str(k)) for k in range(137)], encoding="latin-1")
    (tmp_path / "b.cpg").write_text("ISO-8859-1")
    whole = shapefile.read_shapefile(spark, path, records=1000).orderBy("N").collect()
    assert [x["N"] for x in whole] == list(range(137))
    for records in (1, 50, 137):
        assert shapefile.read_shapefile(spark, path, records=records).orderBy("N").collect() == whole


def test_what_is_missing_fails(spark, tmp_path):
    path = written(tmp_path, [[box(0, 0)]], FIELDS[:1], [("1",)])
    with pytest.raises(Exception, match="attributes are missing: DPA_ANIO"):
        shapefile.read_shapefile(spark, path, ["DPA_PARROQ", "DPA_ANIO"]).collect()
    (tmp_path / "b.prj").write_text(UTM_17S.replace("Transverse_Mercator", "Lambert_Conformal_Conic"))
    with pytest.raises(ValueError, match="transverse Mercator"):
        shapefile.read_shapefile(spark, path)
    (tmp_path / "b.shx").unlink()
    with pytest.raises(Exception, match="files are missing: .shx"):
        shapefile.read_shapefile(spark, path).collect()


def test_no_records(spark, tmp_path):
    assert shapefile.read_shapefile(spark, written(tmp_path, [], FIELDS, [])).count() == 0


def test_projected_coordinates_come_back_to_degrees(spark, tmp_path):
    tm = shapefile.projection_of(UTM_17S)
    assert tm == shapefile.TransverseMercator(6378137.0, 1 / 298.257223563, -81.0, 0.9996, 500000.0, 10000000.0, 0.0)
    assert tm.projected(-81, 0) == pytest.approx((500000, 10000000)) and shapefile.projection_of(WGS84) is None
    r = random.Random(6)
    degrees = [(r.uniform(-84, -75), r.uniform(-5, 2)) for _ in range(400)]
    path = written(tmp_path, [[[tm.projected(*p) for p in degrees[k : k + 4]]] for k in range(0, 400, 4)], FIELDS[:1], [(f"{k:06d}",) for k in range(100)], prj=UTM_17S)
    back = [p for x in shapefile.read_shapefile(spark, path).orderBy("DPA_PARROQ").collect() for p in x["polygons"][0][0]]
    assert np.abs(np.array(back) - np.array(degrees)).max() < 1e-10
    tilted = shapefile.TransverseMercator(6378388.0, 1 / 297, -78, 1.0, 1000.0, 2000.0, 40.0)
    points = [[[list(tilted.projected(-77.5, 41.25))]]]
    got = spark.createDataFrame([(points,)], "p array<array<array<array<double>>>>").select(shapefile.to_degrees("p", tilted).alias("p")).first()["p"][0][0][0]
    assert got == pytest.approx([-77.5, 41.25], abs=1e-10) and F is not None


def test_scale_on_the_central_meridian_is_that_of_the_ellipsoid():
    """The length of a short meridian arc, from the radius of curvature, against the projection."""
    tm = shapefile.TransverseMercator(6378137.0, 1 / 298.257223563, 0.0)
    for lat in (0.0, 10.0, 45.0, 80.0):
        e2 = tm.flattening * (2 - tm.flattening)
        m = tm.axis * (1 - e2) / (1 - e2 * np.sin(np.radians(lat)) ** 2) ** 1.5
        arc = tm.projected(0, lat + 1e-4)[1] - tm.projected(0, lat - 1e-4)[1]
        assert arc == pytest.approx(m * np.radians(2e-4), rel=1e-8)
