"""Access nodes: coordinates cleaned, located in official boundaries, and compared with what was reported."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemart.functions import columns as C
from linemart.operators import geometry
from linemart.operators.boundaries import celled, dissolve, level_of, levels_in
from linemart.operators.held import once

RINGS = "array<array<array<double>>>"
POLYGONS = f"array<{RINGS}>"


def clean_coordinates(nodes: DataFrame) -> DataFrame:
    """nodes (latitude_text, longitude_text) with decimals if valid, `is_valid`, `west_inferred` and the reasons."""
    lat, lon = F.col("latitude_text"), F.col("longitude_text")
    out = once(nodes, _nlat=C.dms_numbers(lat), _nlon=C.dms_numbers(lon))
    out = once(out, _rlat=C.dms_reason(lat, F.col("_nlat")), _rlon=C.dms_reason(lon, F.col("_nlon"))).withColumn("_raw", C.dms_to_decimal(lon, F.col("_nlon"), F.col("_rlon")))
    out = once(out, _lat=C.dms_to_decimal(lat, F.col("_nlat"), F.col("_rlat")), _lon=C.infer_west_longitude(lon, F.col("_raw")), west_inferred=C.west_inferred(lon, F.col("_raw")))
    out = out.withColumn("_range", C.range_reason(F.col("_lat"), F.col("_lon")))
    valid = F.col("_range").isNull()
    out = once(
        out, is_valid=valid, latitude=F.when(valid, F.col("_lat")), longitude=F.when(valid, F.col("_lon")), reasons=C.all_reasons(F.col("_rlat"), F.col("_rlon"), F.col("_range"))
    )
    return out.drop("_nlat", "_nlon", "_rlat", "_rlon", "_raw", "_lat", "_lon", "_range")


def invalid_reason_summary(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy(F.coalesce("reasons", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n_nodes"), F.count_if("west_inferred").alias("n_west_inferred"))


def parse_geojson(c: Column) -> Column:
    """Polygons of a GeoJSON Polygon or MultiPolygon as nested arrays; null for other types."""
    kind, rings = F.get_json_object(c, "$.type"), F.get_json_object(c, "$.coordinates")
    return F.when(kind == "Polygon", F.array(F.from_json(rings, RINGS))).when(kind == "MultiPolygon", F.from_json(rings, POLYGONS))


def with_box(boundaries: DataFrame, polygons: str = "polygons") -> DataFrame:
    points = F.flatten(F.flatten(polygons))
    side = lambda k: F.transform(points, lambda p: p[k])
    return boundaries.withColumns({"min_x": F.array_min(side(0)), "max_x": F.array_max(side(0)), "min_y": F.array_min(side(1)), "max_y": F.array_max(side(1))})


def nonstandard_codes(boundaries: DataFrame) -> DataFrame:
    """Boundaries whose codes are not of 6, 4 and 2 digits; reported, not dropped."""
    bad = ~F.col("parish_code").rlike(r"^\d{6}$") | ~F.col("canton_code").rlike(r"^\d{4}$") | ~F.col("province_code").rlike(r"^\d{2}$")
    return boundaries.filter(bad).select("parish_code", "canton_code", "province_code")


def _covering(batches):
    """Points in rows of a parish and some of its points: those that its polygons cover."""
    for rows in batches:
        found, codes = [], []
        for points, polygons, code in zip(rows["points"], rows["polygons"], rows["parish_code"], strict=True):
            rings = [[np.array([list(p) for p in ring], float) for ring in rings] for rings in polygons]
            x, y = (np.array([p[c] for p in points], float) for c in ("longitude", "latitude"))
            inside = [points[k]["node"] for k in np.nonzero(geometry.covers(x, y, rings))[0]]
            found += inside
            codes += [code] * len(inside)
        if found:
            yield pd.DataFrame({"node": found, "parish_code": codes})


def point_in_parish(nodes: DataFrame, boundaries: DataFrame, parts: int = 8) -> DataFrame:
    """(node, parish_code) of located nodes: the smallest code among parishes that cover the point, borders included.

    Points and boxes meet by an equi-join on grid cells without polygons; cells are of each box's own size, rounded up to a
    power of four, so islands and provinces take four cells each at most, and points ask at every size that occurs. The
    candidates of a parish then become one row for each of `parts` parts, which meets its polygons, and all of a row are tested
    together; parts split a crowded parish. Rows go to Python in batches, so a parish with few nodes costs no call of its own.
    """
    boxes = with_box(boundaries).drop("polygons").filter("min_x is not null")
    boxes = celled(boxes.withColumn("level", level_of(F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(1e-9)))), "min_x", "max_x", "min_y", "max_y")
    boxes = boxes.select("parish_code", "min_x", "max_x", "min_y", "max_y", "level", "cx", "cy")
    spots = nodes.filter("latitude is not null and longitude is not null").select("node", "latitude", "longitude", F.explode(levels_in(boxes)).alias("level"))
    spots = celled(spots, "longitude", "longitude", "latitude", "latitude")
    near = spots.join(boxes, ["level", "cx", "cy"]).filter((F.col("longitude") >= F.col("min_x")) & (F.col("longitude") <= F.col("max_x")) & (F.col("latitude") >= F.col("min_y")) & (F.col("latitude") <= F.col("max_y")))
    near = near.select("node", "latitude", "longitude", "parish_code", F.pmod(F.xxhash64("node"), F.lit(parts)).alias("_part"))
    crowds = near.groupBy("parish_code", "_part").agg(F.collect_list(F.struct("node", "longitude", "latitude")).alias("points"))
    kind = nodes.schema["node"].dataType.simpleString()
    hits = crowds.join(boundaries.filter("polygons is not null").select("parish_code", "polygons"), "parish_code").select("points", "polygons", "parish_code").mapInPandas(_covering, f"node {kind}, parish_code string")
    return hits.groupBy("node").agg(F.min("parish_code").alias("parish_code"))


def node_discrepancies(nodes: DataFrame, located: DataFrame, parishes: DataFrame) -> DataFrame:
    """Located nodes with reported and derived codes; discrepant if the reported canton is not blank and is another."""
    derived = parishes.select("parish_code", F.col("canton_code").alias("derived_canton"), F.col("province_code").alias("derived_province"))
    out = nodes.join(located.withColumnRenamed("parish_code", "derived_parish"), "node").join(derived, F.col("derived_parish") == derived["parish_code"]).drop(derived["parish_code"])
    reported = C.blank_to_null(F.col("reported_canton"))
    return out.select("node", "reported_canton", "derived_parish", "derived_canton", "derived_province", F.coalesce(reported != F.col("derived_canton"), F.lit(False)).alias("is_discrepant"))


def node_territory_ids(nodes: DataFrame) -> DataFrame:
    """Ids of province, canton and parish; null wherever a part is null."""
    return nodes.withColumns({
        "province_id": F.concat(F.lit("PROVINCIA|"), "province_code"), "canton_id": F.concat(F.lit("CANTON|"), "province_code", F.lit("|"), "canton_code"),
        "parish_id": F.concat(F.lit("PARROQUIA|"), "province_code", F.lit("|"), "canton_code", F.lit("|"), "parish_code"),
    })


def node_map(nodes: DataFrame, located: DataFrame, bridge: DataFrame, providers: DataFrame, discrepancies: DataFrame) -> DataFrame:
    """Nodes with place, provider (a licence of two providers gives two rows) and discrepancy."""
    out = nodes.join(located, "node", "left").join(bridge.select("licence", "provider_id"), "licence", "left").join(providers.select("provider_id", "provider_name"), "provider_id", "left")
    return out.join(discrepancies.select("node", "is_discrepant"), "node", "left").withColumn("is_discrepant", F.coalesce("is_discrepant", F.lit(False)))


def node_filter(nodes: DataFrame, provinces: list[str] = (), types: list[str] = (), only_discrepant: bool = False) -> DataFrame:
    out = nodes.filter(F.col("province_code").isin(list(provinces))) if provinces else nodes
    if types:
        out = out.filter(C.normalise_label(F.col("node_type")).isin([t.strip().upper() for t in types]))
    return out.filter("is_discrepant") if only_discrepant else out


def territory_bounds(territories: DataFrame, provinces: list[str] = (), cantons: list[str] = (), parishes: list[str] = ()) -> DataFrame:
    """The box about the selected territories; only the finest level with a selection counts."""
    level, codes = next(((n, c) for n, c in (("parish", parishes), ("canton", cantons), ("province", provinces)) if c), (None, ()))
    out = territories if level is None else territories.filter(F.col(f"{level}_code").isin(list(codes)))
    return out.agg(F.min("min_x").alias("min_x"), F.min("min_y").alias("min_y"), F.max("max_x").alias("max_x"), F.max("max_y").alias("max_y"))


def boundary_rollup(boundaries: DataFrame, level: str) -> DataFrame:
    """One shape for each canton or province, its parishes without the borders between them, with their box and first name."""
    named = with_box(boundaries).groupBy(f"{level}_code").agg(
        F.min(f"{level}_name").alias("name"), F.count("*").alias("n_parishes"),
        F.min("min_x").alias("min_x"), F.min("min_y").alias("min_y"), F.max("max_x").alias("max_x"), F.max("max_y").alias("max_y"),
    )
    return named.join(dissolve(boundaries, [f"{level}_code"]), f"{level}_code", "left")


def vertex_count(polygons: str = "polygons") -> Column:
    return F.size(F.flatten(F.flatten(polygons))).cast("long")


def simplify_boundary(boundaries: DataFrame, tolerance: float) -> DataFrame:
    """boundaries with simplified polygons, valid if they were, and the number of vertices before and after."""

    @F.pandas_udf(POLYGONS)
    def simple(polygons: pd.Series) -> pd.Series:
        def one(parts):
            rings = [np.array([list(p) for p in ring], float).reshape(-1, 2) for rings in parts for ring in rings]
            made = iter(geometry.simplify_rings(rings, tolerance))
            return [[next(made).tolist() for _ in rings] for rings in parts]

        return polygons.map(lambda parts: None if parts is None else one(parts))

    return boundaries.withColumn("n_before", vertex_count()).withColumn("polygons", simple("polygons")).withColumn("n_after", vertex_count())
