"""Boundaries as Spark jobs on edges: dissolving shared borders, and finding what makes polygons invalid.

A boundary is a row with `polygons`, an array of polygons, each an array of closed rings (the first outer, the others
holes) of [x, y] points. Its rings are exploded to directed edges, so no step needs a whole territory in one task: edges
meet by equi-joins on grid cells whose size follows each edge's own length (powers of four), not a parameter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linemart.operators.held import checkpointed, once

#: Degrees within which a vertex lies on an edge (a tenth of a millimetre).
SNAP = 1e-9


def _point(p: Column) -> Column:
    return F.struct((p[0] + 0.0).alias("x"), (p[1] + 0.0).alias("y"))  # + 0.0: no negative zero


def rings_of(shapes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, ring, points, area): a row for each ring, closed and without repeated points; area is positive if counterclockwise."""
    out = shapes.select(*keys, F.posexplode("polygons").alias("part", "_rings")).select(*keys, "part", F.posexplode("_rings").alias("ring", "_p"))
    out = once(once(out, _p=F.transform("_p", _point)), _p=F.filter("_p", lambda p, i: (i == 0) | (p != F.get("_p", i - 1))))
    closed = F.when((F.size("_p") > 1) & (F.get("_p", F.lit(0)) != F.get("_p", F.size("_p") - 1)), F.concat("_p", F.slice("_p", 1, 1))).otherwise(F.col("_p"))
    return with_area(once(out, points=closed).drop("_p"))


def with_area(rings: DataFrame) -> DataFrame:
    """rings with the signed area of their points, taken from the first of them; points must be a column that is computed."""
    o = F.get("points", F.lit(0))
    cross = lambda a, b: (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])
    steps = F.zip_with(F.slice("points", 1, F.size("points") - 1), F.slice("points", 2, F.size("points") - 1), cross)
    return rings.withColumn("area", F.when(F.size("points") > 1, F.aggregate(steps, F.lit(0.0), lambda s, v: s + v) / 2).otherwise(0.0))


def edges_of(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, n, ax, ay, bx, by): a row for each edge of rings with at least two points; n is the ring's number of edges."""
    both = F.zip_with(F.slice("points", 1, F.size("points") - 1), F.slice("points", 2, F.size("points") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    out = rings.filter(F.size("points") > 1).select(*keys, (F.size("points") - 1).alias("n"), F.posexplode(both).alias("pos", "e"))
    return out.select(*keys, "pos", "n", *[F.col(f"e.{p}.{c}").alias(p + c) for p in "ab" for c in "xy"])


def level_of(extent: Column) -> Column:
    """The power of four that is no less than an extent."""
    return F.ceil(F.log(4.0, extent)).cast("int")


def _size(level: Column) -> Column:
    return F.pow(F.lit(4.0), level)


def levels_in(df: DataFrame) -> Column:
    """The levels that occur, as an array; exponents of doubles, so a few dozen at most."""
    return F.lit(sorted(r[0] for r in df.select("level").distinct().collect())).cast("array<int>")


def _boxed(edges: DataFrame) -> DataFrame:
    low, high = F.least, F.greatest
    out = edges.withColumns({"x0": low("ax", "bx"), "x1": high("ax", "bx"), "y0": low("ay", "by"), "y1": high("ay", "by")})
    return out.withColumn("level", level_of(high(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))))


def celled(df: DataFrame, x0: str, x1: str, y0: str, y1: str) -> DataFrame:
    """df with a row for each cell of its level that its box meets."""
    at = lambda c: F.floor(F.col(c) / _size(F.col("level")))
    return df.withColumn("cx", F.explode(F.sequence(at(x0), at(x1)))).withColumn("cy", F.explode(F.sequence(at(y0), at(y1))))


def _orient(p: str, q: str, r: str) -> Column:
    """Which side of p -> q the point r lies on: positive to the left."""
    c = F.col
    return (c(q + "x") - c(p + "x")) * (c(r + "y") - c(p + "y")) - (c(q + "y") - c(p + "y")) * (c(r + "x") - c(p + "x"))


def noded(edges: DataFrame, group: list[str], snap: float = SNAP) -> DataFrame:
    """edges (group, eid, ax, ay, bx, by and others) split, by a further column sub, at every vertex of the group that lies on them.

    Neighbours then share whole edges even where only one of them has a vertex on the common border.
    """
    box = _boxed(edges)
    levels = levels_in(box)
    near = [(F.col("x0") - snap).alias("x0"), (F.col("x1") + snap).alias("x1"), (F.col("y0") - snap).alias("y0"), (F.col("y1") + snap).alias("y1")]
    owners = celled(box.select(*group, "eid", "ax", "ay", "bx", "by", "level", *near), "x0", "x1", "y0", "y1")
    spots = edges.select(*group, F.col("ax").alias("vx"), F.col("ay").alias("vy")).distinct().withColumn("level", F.explode(levels))
    spots = spots.withColumn("cx", F.floor(F.col("vx") / _size(F.col("level")))).withColumn("cy", F.floor(F.col("vy") / _size(F.col("level"))))
    met = owners.join(spots, [*group, "level", "cx", "cy"]).filter("vx between x0 and x1 and vy between y0 and y1")
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    square = dx * dx + dy * dy
    along = ((F.col("vx") - F.col("ax")) * dx + (F.col("vy") - F.col("ay")) * dy) / square
    on = (F.abs(_orient("a", "b", "v")) <= snap * F.sqrt(square)) & ~((F.col("vx") == F.col("ax")) & (F.col("vy") == F.col("ay"))) & ~((F.col("vx") == F.col("bx")) & (F.col("vy") == F.col("by")))
    cuts = met.filter(on).withColumn("t", along).filter("t > 0 and t < 1").groupBy("eid").agg(F.sort_array(F.collect_set(F.struct("t", F.struct(F.col("vx").alias("x"), F.col("vy").alias("y")).alias("p")))).alias("_cuts"))
    whole = edges.join(cuts, "eid", "left")
    end = lambda p: F.array(F.struct(F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y")))
    whole = whole.withColumn("_p", F.concat(end("a"), F.coalesce(F.transform("_cuts", lambda c: c["p"]), F.array().cast("array<struct<x:double,y:double>>")), end("b")))
    steps = F.zip_with(F.slice("_p", 1, F.size("_p") - 1), F.slice("_p", 2, F.size("_p") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    out = whole.drop("_cuts").select("*", F.posexplode(steps).alias("sub", "_e"))
    return out.select(*[c for c in edges.columns if c not in ("ax", "ay", "bx", "by")], "sub", *[F.col(f"_e.{p}.{c}").alias(p + c) for p in "ab" for c in "xy"])


def uncancelled(edges: DataFrame, group: list[str]) -> DataFrame:
    """(group, ring, pos, sub, ax, ay, bx, by): edges that no other edge of the group runs against.

    All edges have their inside on the left, so a border that two members share occurs once in each direction. Copies
    that run the same way (a member given twice) count once.
    """
    same = F.when(F.col("ax") == F.col("bx"), F.col("ay") < F.col("by")).otherwise(F.col("ax") < F.col("bx"))
    e = edges.withColumn("_f", same)
    ends = {f"{side}{c}": F.when(F.col("_f") == (side == "l"), F.col(f"a{c}")).otherwise(F.col(f"b{c}")) for side in "lh" for c in "xy"}
    source = F.struct("ring", "pos", "sub")
    net = e.withColumns(ends).groupBy(*group, *ends).agg(
        F.sum(F.when(F.col("_f"), 1).otherwise(-1)).alias("net"), F.min(F.when(F.col("_f"), source)).alias("up"), F.min(F.when(~F.col("_f"), source)).alias("down")
    ).filter("net <> 0")
    forth = F.col("net") > 0
    src = F.when(forth, F.col("up")).otherwise(F.col("down"))
    to = {f"{p}{c}": F.when(forth == (p == "a"), F.col(f"l{c}")).otherwise(F.col(f"h{c}")) for p in "ab" for c in "xy"}
    return net.select(*group, src["ring"].alias("ring"), src["pos"].alias("pos"), src["sub"].alias("sub"), *[v.alias(c) for c, v in to.items()])


def _cycles(links: DataFrame) -> DataFrame:
    """(cid, nxt) -> (cid, low, dist): the smallest cid of each cycle, and the steps from each member on to it. Pointer doubling: rounds grow with the logarithm of a cycle."""
    state, step = checkpointed(links.select("cid", "nxt", F.col("cid").alias("low"), F.lit(0).cast("long").alias("dist"))), 1
    while True:
        ahead = state.select(F.col("cid").alias("nxt"), F.col("nxt").alias("_n"), F.col("low").alias("_l"), F.col("dist").alias("_d"))
        better = F.col("_l") < F.col("low")
        state = checkpointed(
            state.join(ahead, "nxt").select(
                "cid", F.col("_n").alias("nxt"), F.least("low", "_l").alias("low"), F.when(better, F.col("_d") + step).otherwise(F.col("dist")).alias("dist"), better.alias("moved")
            )
        )
        if not state.filter("moved").limit(1).count():
            return state.select("cid", "low", "dist")
        state, step = state.drop("moved"), 2 * step


def stitched(edges: DataFrame, group: list[str]) -> DataFrame:
    """(group, rid, points, area): the rings that directed edges form, outer ones counterclockwise, holes clockwise.

    Runs of edges of one source ring become chains by one window; chains are linked where they meet. Where several leave a
    point, the leftmost turn is taken, which keeps regions that only touch there apart; a ring that still meets itself in a
    point (a hole that touches its outer ring) is cut there in two.
    """
    busy = edges.groupBy(*group, "ax", "ay").agg(F.count("*").alias("k")).filter("k > 1").select(*group, "ax", "ay", F.lit(True).alias("busy"))
    order = Window.partitionBy(*group, "ring").orderBy("pos", "sub")
    e = edges.join(busy, [*group, "ax", "ay"], "left")
    goes_on = (F.lag("bx").over(order) == F.col("ax")) & (F.lag("by").over(order) == F.col("ay")) & F.col("busy").isNull()
    e = e.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    at = F.struct("pos", "sub")
    chains = e.groupBy(*group, "ring", "run").agg(
        F.min(F.struct("pos", "sub", "ax", "ay", "bx", "by")).alias("first"), F.max(F.struct("pos", "sub", "ax", "ay", "bx", "by")).alias("last"),
        F.transform(F.sort_array(F.collect_list(F.struct(at, F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("p")))), lambda c: c["p"]).alias("line"),
    )
    chains = checkpointed(chains.withColumn("cid", F.monotonically_increasing_id()))
    heads = chains.select(*group, F.col("first.ax").alias("x"), F.col("first.ay").alias("y"), F.col("cid").alias("nxt"), F.atan2(F.col("first.by") - F.col("first.ay"), F.col("first.bx") - F.col("first.ax")).alias("out"))
    tails = chains.select(*group, F.col("last.bx").alias("x"), F.col("last.by").alias("y"), "cid", F.atan2(F.col("last.ay") - F.col("last.by"), F.col("last.ax") - F.col("last.bx")).alias("back"))
    turn = F.pmod(F.col("back") - F.col("out"), F.lit(2 * math.pi))
    turn = F.when(turn == 0, 2 * math.pi).otherwise(turn)
    links = checkpointed(tails.join(heads, [*group, "x", "y"]).groupBy("cid").agg(F.min_by("nxt", turn).alias("nxt")))
    cycles = _cycles(links)
    rank = Window.partitionBy(*group, "low", "x", "y").orderBy(F.when(F.col("dist") == 0, 0).otherwise(1), F.desc("dist"))
    visits = chains.select(*group, F.col("first.ax").alias("x"), F.col("first.ay").alias("y"), "cid").join(cycles, "cid")
    times = Window.partitionBy(*group, "low", "x", "y")
    twice = visits.withColumns({"k": F.count("*").over(times)}).filter("k > 1")
    twice = twice.withColumn("to", F.coalesce(F.lag("cid").over(rank), F.last("cid").over(rank.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))).select(F.col("cid").alias("nxt"), "to")
    if twice.limit(1).count():
        links = links.join(twice, "nxt", "left").select("cid", F.coalesce("to", "nxt").alias("nxt"))
        cycles = _cycles(links)
    place = F.when(F.col("dist") == 0, F.lit(-(2**62))).otherwise(-F.col("dist"))
    rings = chains.select(*group, "cid", "line").join(cycles, "cid").groupBy(*group, "low").agg(F.sort_array(F.collect_list(F.struct(place.alias("at"), "line"))).alias("lines"))
    rings = rings.select(*group, F.col("low").alias("rid"), F.flatten(F.transform("lines", lambda c: c["line"])).alias("points"))
    rings = once(rings, points=F.col("points"))
    return with_area(once(rings, points=F.concat("points", F.slice("points", 1, 1))))


def rings_around(spots: DataFrame, edges: DataFrame, group: list[str], ring: str) -> DataFrame:
    """(spot, ring): the rings of its group that each spot (group, spot, x, y) lies inside. Spots must not lie on edges.

    A ray to the right meets only edges whose height, in steps of their own size, holds the spot's.
    """
    steep = edges.filter("ay <> by").withColumns({"y0": F.least("ay", "by"), "y1": F.greatest("ay", "by")}).withColumn("level", level_of(F.col("y1") - F.col("y0")))
    levels = levels_in(steep)
    at = lambda c: F.floor(F.col(c) / _size(F.col("level")))
    owners = steep.withColumn("bin", F.explode(F.sequence(at("y0"), at("y1")))).select(*group, ring, "ax", "ay", "bx", "by", "level", "bin")
    probes = spots.withColumn("level", F.explode(levels)).withColumn("bin", at("y"))
    met = probes.join(owners, [*group, "level", "bin"]).filter((F.col("ay") > F.col("y")) != (F.col("by") > F.col("y")))
    right = F.col("x") < F.col("ax") + (F.col("y") - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    return met.filter(right).groupBy(*group, "spot", ring).agg(F.count("*").alias("_n")).filter("_n % 2 = 1").drop("_n")


def dissolve(boundaries: DataFrame, group: list[str], snap: float = SNAP) -> DataFrame:
    """(group, polygons, area, perimeter, n_rings, n_vertices): each group's members as one shape without the borders between them.

    Members must be valid and must not overlap; `area` then is the sum of theirs. Members of any size and orientation, in
    any number, with holes, islands, enclaves and corners that only touch. Null or empty polygons add nothing.
    """
    rings = rings_of(boundaries.filter(F.size("polygons") > 0), group).filter(F.size("points") > 3)
    inward = (F.col("area") < 0) == (F.col("ring") == 0)  # an outer ring is to run counterclockwise, a hole clockwise
    rings = rings.filter("area <> 0").withColumn("points", F.when(inward, F.reverse("points")).otherwise(F.col("points"))).drop("ring").withColumn("ring", F.monotonically_increasing_id())
    edges = checkpointed(edges_of(rings, [*group, "ring"]).drop("n").withColumn("eid", F.monotonically_increasing_id()))
    outline = checkpointed(uncancelled(noded(edges, group, snap), group))
    made = checkpointed(stitched(outline, group))
    outer, holes = made.filter("area > 0"), made.filter("area < 0")
    side = lambda c: (F.get("points", F.lit(0))[c] + F.get("points", F.lit(1))[c]) / 2  # noqa: E731  the middle of an edge lies on no other ring
    spots = holes.select(*group, F.col("rid").alias("spot"), side("x").alias("x"), side("y").alias("y"))
    around = rings_around(spots, edges_of(outer, [*group, "rid"]), group, "rid")
    home = around.join(outer.select("rid", "area"), "rid").groupBy("spot").agg(F.min_by("rid", "area").alias("home"))
    placed = holes.join(home, holes["rid"] == home["spot"]).select("home", F.struct(F.col("area"), F.col("points")).alias("h"))
    inner = placed.groupBy("home").agg(F.sort_array(F.collect_list("h")).alias("inner"))
    ring = lambda p: F.transform(p, lambda q: F.array(q["x"], q["y"]))
    parts = outer.join(inner, outer["rid"] == inner["home"], "left").withColumn("inner", F.coalesce("inner", F.array().cast(inner.schema["inner"].dataType)))
    parts = parts.select(*group, F.concat(F.array(ring("points")), F.transform("inner", lambda h: ring(h["points"]))).alias("rings"), (-F.col("area")).alias("_k"))
    shape = parts.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(F.struct("_k", "rings"))), lambda p: p["rings"]).alias("polygons"))
    size = made.groupBy(*group).agg(F.sum("area").alias("area"), F.count("*").alias("n_rings"), F.sum(F.size("points")).alias("n_vertices"))
    long = outline.groupBy(*group).agg(F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).alias("perimeter"))
    return shape.join(size, group).join(long, group).select(*group, "polygons", "area", "perimeter", "n_rings", "n_vertices")


# What makes a boundary invalid

TOO_FEW, NOT_FINITE, CROSSING, TOUCHING, HOLE_OUTSIDE, NESTED, OVERLAP, SPLIT, MISSING = (
    "too_few_points", "not_finite", "rings_cross", "ring_touches_itself", "hole_outside", "holes_nested", "parts_overlap", "interior_disconnected", "no_polygon",
)


def meeting_edges(edges: DataFrame, group: list[str]) -> DataFrame:
    """Pairs of edges (columns a.., and c.. with ids e1 < e2) of one group whose boxes meet, each pair once.

    An edge owns the cells of its own level that its box meets, and asks in those of every coarser level that occurs. A
    pair counts in one cell alone: that of the lower left corner of the boxes' common part.
    """
    box = _boxed(edges)
    levels = levels_in(box)
    owners = celled(box, "x0", "x1", "y0", "y1")
    asked = box.withColumnRenamed("level", "own").withColumn("level", F.explode(F.filter(levels, lambda v: v >= F.col("own"))))
    names = {"ax": "cx_", "ay": "cy_", "bx": "dx_", "by": "dy_", "eid": "e2", "ring": "ring2", "part": "part2", "pos": "pos2", "n": "n2", "x0": "u0", "x1": "u1", "y0": "v0", "y1": "v1"}
    asked = celled(asked, "x0", "x1", "y0", "y1")
    for old, new in names.items():
        asked = asked.withColumnRenamed(old, new)
    met = owners.withColumnRenamed("eid", "e1").join(asked, [*group, "level", "cx", "cy"])
    met = met.filter((F.col("own") < F.col("level")) | (F.col("e1") < F.col("e2")))
    met = met.filter("x0 <= u1 and u0 <= x1 and y0 <= v1 and v0 <= y1")
    corner = lambda p, q: F.floor(F.greatest(p, q) / _size(F.col("level")))
    met = met.filter((corner("x0", "u0") == F.col("cx")) & (corner("y0", "v0") == F.col("cy")))
    return met.drop("level", "own", "cx", "cy").withColumnsRenamed({"cx_": "cx", "cy_": "cy", "dx_": "dx", "dy_": "dy"})


def _in_a_circle(rings, xs, ys) -> bool:
    """Whether rings that touch in these points do so in a circle: one more link between rings and points than a forest has."""
    root: dict = {}

    def find(v):
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for r, x, y in zip(rings, xs, ys, strict=True):
        a, b = find(("ring", r)), find((x, y))
        if a == b:
            return True
        root[a] = b
    return False


def _cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Polygons whose rings touch in a circle, of rows with the links (rings, xs, ys) of one polygon each: a batch a call."""
    for b in batches:
        cut = [_in_a_circle(*links) for links in zip(b["rings"], b["xs"], b["ys"], strict=True)]
        yield b.loc[pd.Series(cut, index=b.index, dtype=bool), ["_row"]].assign(reason=SPLIT)


def offences(boundaries: DataFrame, key: str = "parish_code") -> DataFrame:
    """(key, reason): what is wrong with each invalid boundary, a row for each kind; valid ones have none.

    The rules are those of simple features: rings have four points or more and neither cross, retrace
    nor touch themselves; rings of one polygon meet in single points only and leave its inside connected; holes lie inside the outer
    ring and in no other hole; polygons of a boundary do not overlap and share no border. Containment is asked only of
    boundaries whose rings do not cross.
    """
    say = lambda df, reason: df.select(key, F.lit(reason).alias("reason"))
    spark = boundaries.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    boundaries = boundaries.repartition(parts, key)  # rows are short and ask for much work: by their bytes alone they would share a few tasks
    empty = say(boundaries.filter(F.coalesce(F.size("polygons"), F.lit(0)) <= 0), MISSING)
    unfit = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    bad = F.exists("polygons", lambda rs: rs.isNull() | (F.size(rs) == 0) | F.exists(rs, lambda r: r.isNull() | F.exists(r, lambda p: p.isNull() | (F.size(p) < 2) | unfit(p[0]) | unfit(p[1]))))
    there = boundaries.filter(F.size("polygons") > 0).withColumn("_bad", F.coalesce(bad, F.lit(True)))
    broken = say(there.filter("_bad"), NOT_FINITE)
    rings = rings_of(there.filter("not _bad").withColumn("_row", F.monotonically_increasing_id()), [key, "_row"])
    rings = checkpointed(rings.withColumn("rid", F.monotonically_increasing_id()))
    few = rings.filter(F.size("points") < 4)
    sound = rings.join(few.select("_row").distinct(), "_row", "left_anti")
    edges = checkpointed(edges_of(sound.withColumnsRenamed({"ring": "ring_no"}).withColumn("ring", F.col("rid")), [key, "_row", "part", "ring_no", "ring"]).withColumn("eid", F.monotonically_increasing_id()))

    pairs = meeting_edges(edges.drop(key, "ring_no"), ["_row"])
    d1, d2, d3, d4 = _orient("a", "b", "c"), _orient("a", "b", "d"), _orient("c", "d", "a"), _orient("c", "d", "b")
    pairs = pairs.withColumns({"d1": F.signum(d1), "d2": F.signum(d2), "d3": F.signum(d3), "d4": F.signum(d4)})
    pairs = pairs.filter("d1 * d2 <= 0 and d3 * d4 <= 0")
    along = F.when(F.abs(F.col("bx") - F.col("ax")) >= F.abs(F.col("by") - F.col("ay")), F.least("x1", "u1") - F.greatest("x0", "u0")).otherwise(F.least("y1", "v1") - F.greatest("y0", "v0"))
    flat = F.expr("d1 = 0 and d2 = 0 and d3 = 0 and d4 = 0")
    cross = F.expr("d1 * d2 < 0 and d3 * d4 < 0") | (flat & (along > 0))
    joined = F.expr("ring = ring2 and (abs(pos - pos2) = 1 or abs(pos - pos2) = n - 1)")  # next to each other: they share a point
    where = F.expr(
        "CASE WHEN d1 = 0 AND cx BETWEEN x0 AND x1 AND cy BETWEEN y0 AND y1 THEN struct(cx AS x, cy AS y) WHEN d2 = 0 AND dx BETWEEN x0 AND x1 AND dy BETWEEN y0 AND y1 THEN struct(dx AS x, dy AS y) "
        "WHEN d3 = 0 AND ax BETWEEN u0 AND u1 AND ay BETWEEN v0 AND v1 THEN struct(ax AS x, ay AS y) WHEN d4 = 0 AND bx BETWEEN u0 AND u1 AND by BETWEEN v0 AND v1 THEN struct(bx AS x, by AS y) END"
    )
    met = checkpointed(pairs.select("_row", "part", "part2", "ring", "ring2", "pos", "pos2", cross.alias("crosses"), joined.alias("joined"), where.alias("at")).filter("crosses or at is not null"))
    crossing = met.filter("crosses").select("_row", F.lit(CROSSING).alias("reason"))
    itself = met.filter("not crosses and ring = ring2 and not joined").select("_row", F.lit(TOUCHING).alias("reason"))
    touches = met.filter("not crosses and ring <> ring2")

    # where rings touch, the edges about the point must lie on one side of the other ring: else they cross in a vertex
    about = touches.select("_row", F.explode(F.array(F.struct("ring", F.col("ring2").alias("other"), "pos", "at"), F.struct(F.col("ring2").alias("ring"), F.col("ring").alias("other"), F.col("pos2").alias("pos"), "at"))).alias("t")).select("_row", "t.*").distinct()
    middle = lambda c: F.col(f"a{c}") + 0.381966 * (F.col(f"b{c}") - F.col(f"a{c}"))
    probes = about.select("_row", "ring", "other", "pos").distinct().join(edges.select("_row", "ring", "pos", middle("x").alias("x"), middle("y").alias("y"), F.col("eid").alias("spot")), ["_row", "ring", "pos"])
    lie = rings_around(probes.select("_row", "spot", "x", "y").distinct(), edges.join(touches.select("_row").distinct(), "_row", "left_semi").select("_row", F.col("ring").alias("other"), "ax", "ay", "bx", "by"), ["_row"], "other")
    sides = probes.join(lie.withColumn("in", F.lit(1)), ["_row", "spot", "other"], "left").groupBy("_row", "ring", "other").agg(F.count("in").alias("inside"), F.count("*").alias("all"))
    through = sides.filter("inside > 0 and inside < all").select("_row", F.lit(CROSSING).alias("reason"))

    # containment, of boundaries whose rings do not cross
    clean = sound.join(crossing.union(itself).union(through).select("_row").distinct(), "_row", "left_anti")
    several = checkpointed(clean.withColumn("_k", F.count("*").over(Window.partitionBy("_row"))).filter("_k > 1").drop("_k"))
    start = lambda c: F.get("points", F.lit(0))[c] + 0.381966 * (F.get("points", F.lit(1))[c] - F.get("points", F.lit(0))[c])
    spots = several.select("_row", F.col("rid").alias("spot"), start("x").alias("x"), start("y").alias("y"))
    around = rings_around(spots, edges_of(several, ["_row", "rid"]), ["_row"], "rid").join(several.select("rid", F.col("part").alias("in_part"), F.col("ring").alias("in_ring")), "rid").filter("rid <> spot")
    lies = several.select("_row", F.col("rid").alias("spot"), "part", "ring").join(around.drop("_row"), "spot", "left").groupBy("_row", "spot", "part", "ring").agg(
        F.count_if(F.expr("in_part = part and in_ring = 0")).alias("own"), F.count_if(F.expr("in_part = part and in_ring > 0")).alias("own_holes"),
        F.collect_list(F.when(F.expr("in_part <> part"), F.struct("in_part", "in_ring"))).alias("others"),
    )
    foreign = F.exists("others", lambda o: (o["in_ring"] == 0) & ~F.exists("others", lambda h: (h["in_part"] == o["in_part"]) & (h["in_ring"] > 0)))
    placed = [lies.filter("ring > 0 and own = 0").select("_row", F.lit(HOLE_OUTSIDE).alias("reason")), lies.filter("ring > 0 and own_holes > 0").select("_row", F.lit(NESTED).alias("reason")), lies.filter("ring = 0").filter(foreign).select("_row", F.lit(OVERLAP).alias("reason"))]
    tidy = about.join(clean.select("_row").distinct(), "_row", "left_semi")
    circles = tidy.join(edges.select("_row", "ring", "part").distinct(), ["_row", "ring"]).join(edges.select("_row", F.col("ring").alias("other"), F.col("part").alias("part2")).distinct(), ["_row", "other"]).filter("part = part2")
    circles = circles.select("_row", "part", "ring", F.col("at.x").alias("x"), F.col("at.y").alias("y")).groupBy("_row", "part").agg(F.collect_set(F.struct("ring", "x", "y")).alias("l")).filter("size(l) > 3")  # a circle has four links at least
    circles = circles.select("_row", *[F.col(f"l.{c}").alias(f"{c}s") for c in ("ring", "x", "y")]).mapInPandas(_cut_up, "_row long, reason string")

    by_row = crossing.union(itself).union(through).union(circles)
    for p in placed:
        by_row = by_row.union(p)
    named = by_row.distinct().join(rings.select("_row", key).distinct(), "_row").select(key, "reason")
    return empty.union(broken).union(say(few, TOO_FEW)).union(named).distinct()


def valid_boundaries(boundaries: DataFrame, key: str = "parish_code") -> tuple[DataFrame, DataFrame]:
    """(valid rows as they are, (key, reasons) of the others): nothing is mended. A key with any invalid row is left out whole."""
    found = checkpointed(offences(boundaries, key).groupBy(key).agg(F.array_join(F.sort_array(F.collect_set("reason")), "; ").alias("reasons")))
    return boundaries.alias("b").join(found.alias("o"), F.col(f"b.{key}").eqNullSafe(F.col(f"o.{key}")), "left_anti"), found
