"""Polygons and their attributes from shapefiles, as a Spark data source, and projected coordinates back to degrees.

A shapefile is three files of one name: shapes (.shp), where each of them begins (.shx) and a table of attributes (.dbf).
The index has records of one length, so any task can find its own range of records: the driver reads headers alone, and each
partition reads the bytes of its records. Files are opened through Arrow's file systems: local ones, HDFS and object stores.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from linemart.operators.geometry import covers

#: Shape types that hold polygons (plain, with heights, with measures), the length of headers and index records, and what ends the list of fields.
POLYGON_TYPES, NULL_SHAPE, HEADER, INDEX, FIELD, FIELDS_END = {5, 15, 25}, 0, 100, 8, 32, 0x0D
RINGS = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))


@dataclass
class Attribute:
    name: str
    kind: str
    at: int
    length: int
    decimals: int

    def type(self) -> T.DataType:
        if self.kind in "NF":
            return T.LongType() if self.kind == "N" and not self.decimals and self.length <= 18 else T.DoubleType()
        return {"D": T.DateType(), "L": T.BooleanType()}.get(self.kind, T.StringType())

    def value(self, record: bytes, encoding: str):
        """Texts keep leading zeros and lose spaces at the end; blank or starred values are null."""
        raw = record[self.at : self.at + self.length]
        if self.kind not in "NFDL":
            return raw.decode(encoding).rstrip(" \0") or None
        text = raw.decode("ascii").strip(" \0")
        if not text or text[0] in "*?":
            return None
        if self.kind == "D":
            return dt.date(int(text[:4]), int(text[4:6]), int(text[6:8])) if text.strip("0") else None
        if self.kind == "L":
            return text in "YyTt"
        return int(float(text)) if isinstance(self.type(), T.LongType) and "." in text else int(text) if isinstance(self.type(), T.LongType) else float(text)


def _opened(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system, inner


def _bytes(path: str, start: int = 0, length: int | None = None) -> bytes:
    system, inner = _opened(path)
    with system.open_input_file(inner) as f:
        return f.read_at(f.size() - start if length is None else length, start)


def _size(path: str) -> int:
    system, inner = _opened(path)
    return system.get_file_info(inner).size


def _beside(path: str, suffix: str) -> str | None:
    """The file of the same name with another suffix, in either case; None if there is none."""
    for s in (suffix, suffix.upper()):
        system, inner = _opened(path[: -len(".shp")] + s)
        if system.get_file_info(inner).is_file:
            return path[: -len(".shp")] + s
    return None


@dataclass
class Table:
    """What the header of a .dbf says."""

    path: str
    records: int
    start: int
    length: int
    attributes: list[Attribute]

    @staticmethod
    def read(path: str) -> Table:
        head = _bytes(path, 0, 32)
        records, start, length = int.from_bytes(head[4:8], "little"), int.from_bytes(head[8:10], "little"), int.from_bytes(head[10:12], "little")
        fields, at, found = _bytes(path, 32, start - 32), 1, []
        for k in range(0, len(fields), FIELD):
            if fields[k] == FIELDS_END:
                break
            one = fields[k : k + FIELD]
            found.append(Attribute(one[:11].split(b"\0")[0].decode("ascii"), chr(one[11]), at, one[16], one[17]))
            at += one[16]
        return Table(path, records, start, length, found)


def rings_of(content: bytes) -> list[np.ndarray] | None:
    """The rings of one shape's content; None for a shape without any."""
    kind = int.from_bytes(content[:4], "little")
    if kind == NULL_SHAPE:
        return None
    if kind not in POLYGON_TYPES:
        raise ValueError(f"shape type {kind} is no polygon")
    parts, points = (int(v) for v in np.frombuffer(content, "<i4", 2, 36))
    first = [*np.frombuffer(content, "<i4", parts, 44).tolist(), points]
    xy = np.frombuffer(content, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    return [xy[a:b] for a, b in zip(first, first[1:], strict=False)]


def polygons_of(rings: list[np.ndarray]) -> list[list[list[list[float]]]]:
    """Rings as polygons: one that runs clockwise begins a polygon, another is a hole of the smallest ring around it, or a polygon if none is."""
    area = [float(((r[:-1, 0] - r[0, 0]) * (r[1:, 1] - r[0, 1]) - (r[1:, 0] - r[0, 0]) * (r[:-1, 1] - r[0, 1])).sum()) / 2 if len(r) else 0.0 for r in rings]
    outer = [k for k, a in enumerate(area) if a <= 0]
    holes: dict[int, list[int]] = {k: [] for k in outer}
    for k in (k for k, a in enumerate(area) if a > 0):
        middle = (rings[k][0] + rings[k][1]) / 2  # of an edge: a hole may touch its outer ring in a vertex
        around = [n for n in outer if (rings[n].min(0) <= middle).all() and (rings[n].max(0) >= middle).all() and covers(middle[:1], middle[1:], [[rings[n]]])[0]]
        if around:
            holes[min(around, key=lambda n: -area[n])].append(k)
        else:
            holes[k] = []
    return [[rings[n].tolist() for n in (k, *holes[k])] for k in sorted(holes)]


class Records(InputPartition):
    def __init__(self, first: int, count: int) -> None:
        super().__init__(first)
        self.first, self.count = first, count


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str, table: Table, schema: T.StructType, encoding: str, step: int) -> None:
        self.path, self.table, self.names, self.encoding, self.step = path, table, schema.fieldNames(), encoding, step
        self.arrow = {f.name: f.dataType for f in schema.fields}

    def partitions(self) -> list[Records]:
        n = (_size(_beside(self.path, ".shx")) - HEADER) // INDEX
        if n != self.table.records:
            raise ValueError(f"{self.path} has {n} shapes and {self.table.records} rows of attributes")
        return [Records(k, min(self.step, n - k)) for k in range(0, max(n, 1), self.step)]

    def read(self, partition: Records) -> Iterator[tuple]:
        """The records of one range: three reads, each of adjacent bytes, and rows that are marked as deleted left out."""
        if not partition.count:
            return
        at = np.frombuffer(_bytes(_beside(self.path, ".shx"), HEADER + INDEX * partition.first, INDEX * partition.count), ">i4").reshape(-1, 2) * 2  # in words of two bytes
        low, high = int(at[:, 0].min()), int((at[:, 0] + at[:, 1]).max()) + INDEX
        shapes = _bytes(self.path, low, high - low)
        rows = _bytes(self.table.path, self.table.start + self.table.length * partition.first, self.table.length * partition.count)
        told = {a.name: a for a in self.table.attributes}
        for k, (start, length) in enumerate(at.tolist()):
            record = rows[k * self.table.length : (k + 1) * self.table.length]
            if record[:1] == b"*":
                continue
            rings = rings_of(shapes[start - low + INDEX : start - low + INDEX + length])
            polygons = None if rings is None else polygons_of(rings)
            yield tuple(polygons if name == "polygons" else told[name].value(record, self.encoding) for name in self.names)


class ShapefileSource(DataSource):
    """format("shapefile"): attributes by their own names and `polygons`. Options: path (the .shp), required (attributes, comma-separated), encoding, recordsPerPartition."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def _path(self) -> str:
        path = self.options.get("path", "")
        if not path.lower().endswith(".shp"):
            raise ValueError("the path must be that of the .shp file")
        missing = [s for s in (".shp", ".shx", ".dbf") if _beside(path, s) is None]
        if missing:
            raise ValueError(f"{path}: files are missing: {', '.join(missing)}")
        return path

    def schema(self) -> T.StructType:
        found = Table.read(_beside(self._path(), ".dbf")).attributes
        names = [a.name for a in found]
        missing = [r for r in re.split(r"\s*,\s*", self.options.get("required", "")) if r and r not in names]
        if missing:
            raise ValueError(f"attributes are missing: {', '.join(missing)}; there are {', '.join(names)}")
        if "polygons" in names or len(set(names)) < len(names):
            raise ValueError("an attribute is named polygons, or two have one name")
        return T.StructType([*[T.StructField(a.name, a.type()) for a in found], T.StructField("polygons", RINGS)])

    def reader(self, schema: T.StructType) -> ShapefileReader:
        path = self._path()
        named = _beside(path, ".cpg")
        encoding = self.options.get("encoding") or (_bytes(named).decode("ascii").strip() if named else "utf-8")
        return ShapefileReader(path, Table.read(_beside(path, ".dbf")), schema, encoding, int(self.options.get("recordsPerPartition", "256")))


@dataclass
class TransverseMercator:
    """A transverse Mercator projection: ellipsoid, central meridian and latitude of origin in degrees, scale, false easting and northing."""

    axis: float
    flattening: float
    meridian: float
    scale: float = 1.0
    easting: float = 0.0
    northing: float = 0.0
    origin: float = 0.0

    def _third(self) -> float:
        return self.flattening / (2 - self.flattening)

    def radius(self) -> float:
        n = self._third()
        return self.scale * self.axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    def forward(self) -> list[float]:
        """Series from conformal to projected coordinates, in powers of the third flattening."""
        n = self._third()
        return [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]

    def backward(self) -> list[float]:
        n = self._third()
        return [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]

    def latitude(self) -> list[float]:
        """Series from conformal to geographic latitude."""
        n = self._third()
        return [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]

    def projected(self, lon: float, lat: float) -> tuple[float, float]:
        """One point forth, for the latitude of origin and for tests."""
        e = math.sqrt(self.flattening * (2 - self.flattening))
        s = math.sin(math.radians(lat))
        t = math.sinh(math.atanh(s) - e * math.atanh(e * s))
        d = math.radians(lon - self.meridian)
        xi, eta = math.atan2(t, math.cos(d)), math.asinh(math.sin(d) / math.hypot(t, math.cos(d)))
        up, side = xi, eta
        for j, a in enumerate(self.forward(), 1):
            up += a * math.sin(2 * j * xi) * math.cosh(2 * j * eta)
            side += a * math.cos(2 * j * xi) * math.sinh(2 * j * eta)
        return self.easting + self.radius() * side, self.northing + self.radius() * up - self._base()

    def _base(self) -> float:
        return TransverseMercator(self.axis, self.flattening, self.meridian, self.scale).projected(self.meridian, self.origin)[1] if self.origin else 0.0


def projection_of(text: str) -> TransverseMercator | None:
    """The projection that a .prj names: None for degrees of WGS 84, a transverse Mercator, or an error. Other ellipsoids in degrees are an error too, as no shift is known."""
    number = r"\s*,\s*([-+0-9.eE]+)"
    ellipsoid = re.search(r"(?:SPHEROID|ELLIPSOID)\s*\[\s*\"[^\"]*\"" + number + number, text, re.I)
    if not re.search(r"\bPROJC(?:S|RS)\s*\[", text, re.I):
        if ellipsoid and (abs(float(ellipsoid[1]) - 6378137) > 1 or abs(float(ellipsoid[2]) - 298.2572) > 1e-3):
            raise ValueError("coordinates are degrees of another ellipsoid than that of WGS 84")
        return None
    if not ellipsoid or not re.search(r"Transverse_Mercator|Transverse Mercator", text, re.I):
        raise ValueError("only transverse Mercator projections are known")
    given = {k.lower().replace(" ", "_"): float(v) for k, v in re.findall(r"PARAMETER\s*\[\s*\"([^\"]*)\"" + number, text, re.I)}
    of = lambda *names, default=0.0: next((given[n] for n in names if n in given), default)
    return TransverseMercator(
        float(ellipsoid[1]), 1 / float(ellipsoid[2]), of("central_meridian", "longitude_of_natural_origin"), of("scale_factor", "scale_factor_at_natural_origin", default=1.0),
        of("false_easting"), of("false_northing"), of("latitude_of_origin", "latitude_of_natural_origin"),
    )


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def to_degrees(polygons: Column | str, tm: TransverseMercator) -> Column:
    """polygons in degrees, by built-in expressions: Krueger's series, exact to far less than a millimetre in a zone."""
    r, base = tm.radius(), tm._base()

    def conformal(v: Column) -> Column:
        xi, eta = v["xi"], v["eta"]
        up, side = xi, eta
        for j, b in enumerate(tm.backward(), 1):
            up = up - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            side = side - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        return _let(F.struct(up.alias("up"), side.alias("side")), lambda w: _let(F.struct(F.asin(F.sin(w["up"]) / F.cosh(w["side"])).alias("chi"), F.atan2(F.sinh(w["side"]), F.cos(w["up"])).alias("lon")), geographic))

    def geographic(v: Column) -> Column:
        lat = v["chi"]
        for j, d in enumerate(tm.latitude(), 1):
            lat = lat + d * F.sin(2 * j * v["chi"])
        return F.array(F.lit(tm.meridian) + F.degrees(v["lon"]), F.degrees(lat))

    def point(p: Column) -> Column:
        return _let(F.struct(((p[1] - tm.northing + base) / r).alias("xi"), ((p[0] - tm.easting) / r).alias("eta")), conformal)

    return F.transform(polygons, lambda rings: F.transform(rings, lambda ring: F.transform(ring, point)))


def read_shapefile(spark: SparkSession, path: str, required: list[str] = (), records: int = 256) -> DataFrame:
    """Attributes and polygons in degrees. A required attribute that is missing fails, and so does a projection that is not known; without a .prj degrees are taken."""
    spark.dataSource.register(ShapefileSource)
    found = spark.read.format("shapefile").option("required", ",".join(required)).option("recordsPerPartition", records).load(path)
    named = _beside(path, ".prj")
    tm = projection_of(_bytes(named).decode("utf-8")) if named else None
    return found if tm is None else found.withColumn("polygons", to_degrees("polygons", tm))
