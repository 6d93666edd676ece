"""Dissolve, validity and simplification of boundaries against brute force."""

import json
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from linemart.operators import boundaries, geometry, nodes
from linemart.sources import tables

SCHEMA = "canton_code string, parish_code string, polygons array<array<array<array<double>>>>"


def floats(v):
    return [floats(x) for x in v] if isinstance(v, (list, tuple)) else float(v)


def square(x, y, s=1):
    return [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]


def frame(spark, rows):
    return spark.createDataFrame([(a, b, floats(p) if p is not None else None) for a, b, p in rows], SCHEMA)


def test_dissolve_of_special_shapes(spark):
    around = [(i, j) for i in range(3) for j in range(3) if (i, j) != (1, 1)]
    rows = [
        ("pair", "a", [[square(0, 0)]]), ("pair", "b", [[square(1, 0)[::-1]]]),  # drawn the other way round
        ("corner", "a", [[square(0, 0)]]), ("corner", "b", [[square(1, 1)]]),
        *[("ring", f"{i}{j}", [[square(i, j)]]) for i, j in around],
        ("island", "a", [[square(0, 0, 10), square(2, 2, 4)]]), ("island", "b", [[square(3, 3)]]),
        ("enclave", "a", [[square(0, 0, 10), square(2, 2, 4)]]), ("enclave", "b", [[square(2, 2, 4)]]),
        ("step", "a", [[square(0, 0, 2)]]), ("step", "b", [[square(2, 0)]]), ("step", "c", [[square(2, 1)]]),  # a vertex in the middle of another's border
        ("pinched", "a", [[[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[4, 2], [2, 1], [2, 3], [4, 2]]]]),  # a hole that touches
        ("twice", "a", [[square(0, 0)]]), ("twice", "a", [[square(0, 0)]]), ("twice", "none", None), ("twice", "empty", []),
    ]
    got = {r["canton_code"]: r for r in boundaries.dissolve(frame(spark, rows), ["canton_code"]).collect()}
    want = {"pair": (2, 6, 1, 1), "corner": (2, 8, 2, 2), "ring": (8, 16, 2, 1), "island": (85, 60, 3, 2), "enclave": (100, 40, 1, 1), "step": (6, 10, 1, 1), "twice": (1, 4, 1, 1)}
    assert {k: (r["area"], r["perimeter"], r["n_rings"], len(r["polygons"])) for k, r in got.items() if k != "pinched"} == want
    assert got["pinched"]["area"] == 14 and got["pinched"]["n_rings"] == 2 and len(got["pinched"]["polygons"]) == 1
    assert all(ring[0] == ring[-1] for r in got.values() for rings in r["polygons"] for ring in rings)


def test_dissolve_of_random_patches(spark):
    """Members are single cells or bars of an uneven grid; which group has which is random, so holes, islands and corners abound."""
    r = random.Random(4)
    rows, cells, n = [], {}, 9
    xs = [0.0, *np.cumsum([r.choice([0.5, 1.0, 0.3125, 2.0]) for _ in range(n)]).tolist()]
    for g in range(5):
        for j in range(n):
            i = 0
            while i < n:
                k = min(n, i + r.choice([1, 1, 2, 3]))
                if r.random() < 0.6:
                    ring = [[xs[i], xs[j]], [xs[k], xs[j]], [xs[k], xs[j + 1]], [xs[i], xs[j + 1]], [xs[i], xs[j]]]
                    turn = r.randrange(4)
                    ring = [*ring[turn:-1], *ring[: turn + 1]]
                    rows.append((f"g{g}", f"{i}-{j}", [[ring if r.random() < 0.5 else ring[::-1]]]))
                    cells |= {(g, c, j): True for c in range(i, k)}
                i = k
    made = boundaries.dissolve(frame(spark, rows), ["canton_code"])
    assert boundaries.offences(made, "canton_code").count() == 0
    for row in made.collect():
        g = int(row["canton_code"][1:])
        size = lambda i, j: (xs[i + 1] - xs[i]) * (xs[j + 1] - xs[j])
        mine = [(i, j) for (h, i, j) in cells if h == g]
        open_sides = sum(xs[j + 1] - xs[j] for i, j in mine for d in (-1, 1) if (g, i + d, j) not in cells) + sum(xs[i + 1] - xs[i] for i, j in mine for d in (-1, 1) if (g, i, j + d) not in cells)
        assert row["area"] == pytest.approx(sum(size(*c) for c in mine)) and row["perimeter"] == pytest.approx(open_sides)
        polygons = [[np.array(ring) for ring in rings] for rings in row["polygons"]]
        at = [(i, j) for i in range(n) for j in range(n)]
        x, y = np.array([(xs[i] + xs[i + 1]) / 2 for i, _ in at]), np.array([(xs[j] + xs[j + 1]) / 2 for _, j in at])
        assert geometry.covers(x, y, polygons).tolist() == [(g, i, j) in cells for i, j in at]


# Validity

def side(p, q, r):
    v = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return (v > 0) - (v < 0)


def on(p, q, r):
    return side(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])


def within(p, ring):
    odd = False
    for a, b in zip(ring, ring[1:]):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + Fraction(p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
            odd = not odd
    return odd


def brute_offences(polygons):
    """All pairs of edges and of rings, in whole numbers and fractions."""
    if not polygons:
        return {boundaries.MISSING}
    rings = []
    for part, rs in enumerate(polygons):
        for k, ring in enumerate(rs):
            ring = [p for i, p in enumerate(ring) if i == 0 or p != ring[i - 1]]
            rings.append((part, k, ring if len(ring) < 2 or ring[0] == ring[-1] else [*ring, ring[0]]))
    if any(len(ring) < 4 for _, _, ring in rings):
        return {boundaries.TOO_FEW}
    found, touches = set(), defaultdict(set)
    edges = [(n, i, ring[i], ring[i + 1]) for n, (_, _, ring) in enumerate(rings) for i in range(len(ring) - 1)]
    for u, (n, i, a, b) in enumerate(edges):
        for m, j, c, d in edges[u + 1 :]:
            meet = {p for p in (c, d) if on(a, b, p)} | {p for p in (a, b) if on(c, d, p)}
            if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0 or len(meet) > 1:
                found.add(boundaries.CROSSING)
            elif meet and n != m:
                touches[n, m] |= meet
            elif meet and abs(i - j) not in (1, len(rings[n][2]) - 2):
                found.add(boundaries.TOUCHING)
    for (n, m), points in touches.items():
        for p, q in ((n, m), (m, n)):
            lies = set()
            for a, b in zip(rings[p][2], rings[p][2][1:]):
                stops = sorted({a, b, *[t for t in points if on(a, b, t)]}, key=lambda t: (t[0] - a[0]) ** 2 + (t[1] - a[1]) ** 2)
                lies |= {within((Fraction(s[0] + t[0]) / 2, Fraction(s[1] + t[1]) / 2), rings[q][2]) for s, t in zip(stops, stops[1:])}
            if len(lies) > 1:
                found.add(boundaries.CROSSING)
    if found:
        return found
    place = [tuple(Fraction(381966, 1000000) * (ring[1][k] - ring[0][k]) + ring[0][k] for k in (0, 1)) for _, _, ring in rings]
    for n, (part, k, _) in enumerate(rings):
        around = [(p, h) for m, (p, h, ring) in enumerate(rings) if m != n and within(place[n], ring)]
        if k and (part, 0) not in around:
            found.add(boundaries.HOLE_OUTSIDE)
        if k and any(p == part and h for p, h in around):
            found.add(boundaries.NESTED)
        if not k and any(h == 0 and p != part and not any(q == p and g for q, g in around) for p, h in around):
            found.add(boundaries.OVERLAP)
    for part in {p for p, _, _ in rings}:
        links = {(n, t) for (n, m), points in touches.items() if rings[n][0] == rings[m][0] == part for t in points} | {(m, t) for (n, m), points in touches.items() if rings[n][0] == rings[m][0] == part for t in points}
        group = {}
        root = lambda v: v if group.setdefault(v, v) == v else root(group[v])
        for n, t in sorted(links):
            a, b = root(n), root(t)
            if a == b:
                found.add(boundaries.SPLIT)
            group[a] = b
    return found


def random_boundary(r):
    def ring():
        kind, x, y = r.random(), r.randrange(9), r.randrange(9)
        if kind < 0.55:
            w, h = r.choice([1, 2, 3, 6, 9]), r.choice([1, 2, 3, 6, 9])
            out = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        elif kind < 0.9:
            out = [(x + r.randrange(-3, 4), y + r.randrange(-3, 4)) for _ in range(3)]
        else:
            out = [(x + r.randrange(-4, 5), y + r.randrange(-4, 5)) for _ in range(r.randrange(2, 7))]
        out = out if r.random() < 0.5 else out[::-1]
        return [*out, out[0]] if r.random() < 0.9 else out

    big = [(-1, -1), (13, -1), (13, 13), (-1, 13), (-1, -1)]
    return [[big if r.random() < 0.8 else ring(), *[ring() for _ in range(r.choice([0, 1, 2, 2, 3]))]] for _ in range(r.choice([1, 1, 1, 2]))]


def test_offences_are_those_of_all_pairs(spark):
    r = random.Random(8)
    shapes = [random_boundary(r) for _ in range(500)]
    shapes += [[[square(0, 0)], [square(3 + k, 0)]] for k in range(3)] + [[], [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(0, 2), (2, 1), (4, 2), (2, 3), (0, 2)]]], [[[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]]]
    shapes = [[[[tuple(p) for p in ring] for ring in rings] for rings in shape] for shape in shapes]
    got = defaultdict(set)
    for row in boundaries.offences(frame(spark, [("c", str(k), s) for k, s in enumerate(shapes)])).collect():
        got[int(row["parish_code"])].add(row["reason"])
    expected = {k: found for k, s in enumerate(shapes) if (found := brute_offences(s))}
    assert dict(got) == expected
    assert {x for found in expected.values() for x in found} >= {boundaries.CROSSING, boundaries.TOUCHING, boundaries.HOLE_OUTSIDE, boundaries.NESTED, boundaries.SPLIT, boundaries.TOO_FEW, boundaries.MISSING, boundaries.OVERLAP}
    assert len(expected) < len(shapes)


def test_numbers_that_are_none_and_missing_parts_are_reported(spark):
    rows = [("c", "nan", [[[[0, 0], [1, 0], [float("nan"), 1], [0, 0]]]]), ("c", "ok", [[square(0, 0)]])]
    df = frame(spark, rows).union(spark.createDataFrame([("c", "null", None), ("c", "hole", [[None]]), ("c", "point", [[[[0.0, 0.0], None, [1.0, 1.0], [0.0, 0.0]]]]), ("c", "half", [[[[0.0], [1.0, 2.0]]]])], SCHEMA))
    valid, bad = boundaries.valid_boundaries(df)
    assert [x["parish_code"] for x in valid.collect()] == ["ok"]
    assert {x["parish_code"]: x["reasons"] for x in bad.collect()} == {"nan": "not_finite", "null": "no_polygon", "hole": "not_finite", "point": "not_finite", "half": "not_finite"}
    assert boundaries.offences(df.limit(0)).count() == 0


def test_invalid_boundaries_are_left_out_and_reported(spark, tmp_path):
    fields = {"parish_name": "n", "canton_code": "0001", "canton_name": "c", "province_code": "01", "province_name": "p"}
    rows = [{"parish_code": "010101", **fields, "geometry": {"type": "Polygon", "coordinates": [square(0, 0)]}}, {"parish_code": "010102", **fields, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]]]}}]
    (tmp_path / "b.json").write_text("\n".join(map(json.dumps, rows)))
    valid, bad = tables.read_valid_boundaries(spark, f"{tmp_path}/b.json")
    assert [r["parish_code"] for r in valid.collect()] == ["010101"]
    assert [tuple(r) for r in bad.collect()] == [("010102", "rings_cross")]


# Simplification

def blob(r, x, y, size, n, rough):
    angle = np.sort(r.random(n)) * 2 * np.pi
    reach = size * (1 - rough * r.random(n))
    p = np.c_[x + reach * np.cos(angle), y + reach * np.sin(angle)]
    return np.vstack([p, p[:1]]).tolist()


def test_simplified_shapes_stay_valid(spark):
    r = np.random.default_rng(5)
    rows = []
    for k in range(120):
        holes = [blob(r, 0.18 * np.cos(h * 1.57), 0.18 * np.sin(h * 1.57), 0.11, r.integers(5, 40), 0.6) for h in range(4)]
        rows.append((str(k % 3), str(k), [[blob(r, 0, 0, 1, r.integers(12, 150), 0.5 * r.random()), *holes], [blob(r, 1.6, 0, 0.5, 50, 0.9)]]))
    rows.append(("0", "tiny", [[[[0, 0], [4e-4, 0], [4e-4, 4e-4], [0, 4e-4], [0, 0]]]]))  # far smaller than the tolerance
    valid = boundaries.valid_boundaries(frame(spark, rows))[0].cache()
    assert valid.count() > 60
    each = [nodes.simplify_boundary(valid, tolerance).withColumn("parish_code", F.concat("parish_code", F.lit(f"/{tolerance}"))) for tolerance in (0.003, 0.1, 2.0)]
    simple = each[0].union(each[1]).union(each[2]).cache()
    assert boundaries.offences(simple).count() == 0
    n = defaultdict(int)
    for row in simple.collect():
        code, _, tolerance = row["parish_code"].partition("/")
        before = next(p for _, c, p in rows if c == code)
        assert [len(rings) for rings in row["polygons"]] == [len(rings) for rings in before] and row["n_after"] <= row["n_before"]
        n[tolerance] += row["n_after"] / row["n_before"]
        for old, new in zip([q for rings in before for q in rings], [q for rings in row["polygons"] for q in rings], strict=True):
            assert len(new) >= 4 and new[0] == new[-1] and {tuple(p) for p in new} <= {tuple(map(float, p)) for p in old}
    assert n["2.0"] <= n["0.1"] < 0.8 * n["0.003"]


def test_dropped_vertices_are_near_the_line():
    ring = np.array(blob(np.random.default_rng(2), 0, 0, 1, 400, 0.05))
    new = geometry.simplify_rings([ring], 0.02)[0]
    assert len(new) < len(ring) // 2
    for p in ring:
        a, b = new[:-1], new[1:]
        t = np.clip(((p - a) * (b - a)).sum(1) / ((b - a) ** 2).sum(1), 0, 1)
        assert np.hypot(*(a + t[:, None] * (b - a) - p).T).min() <= 0.02 + 1e-12


def test_a_hole_in_a_bay_is_not_shut_out():
    bay = np.array([[0, 0], [10, 0], [10, 10], [5.2, 10], [5, 10.5], [4.8, 10], [0, 10], [0, 0]], float)
    hole = np.array([[4.95, 10.1], [5.05, 10.1], [5, 10.2], [4.95, 10.1]])
    outer, inner = geometry.simplify_rings([bay, hole], 1.0)
    assert geometry.covers(hole[:, 0], hole[:, 1], [[outer]]).all() and len(inner) == 4
    assert len(geometry.simplify_rings([bay], 1.0)[0]) == 5


def test_touching_rings_go_to_python_in_batches(spark):
    """One call for many polygons, and short rows of one file in as many parts as there are."""
    import pandas as pd

    calls = list(boundaries._cut_up(iter([pd.DataFrame({"_row": [1, 2], "rings": [[1, 1, 2, 2], [1, 2, 3, 3]], "xs": [[0.0, 1.0, 0.0, 1.0], [0.0, 0.0, 0.0, 1.0]], "ys": [[0.0] * 4, [0.0] * 4]})])))
    assert [c.values.tolist() for c in calls] == [[[1, boundaries.SPLIT]]]
    square = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]]
    rows = spark.createDataFrame([(str(k), square) for k in range(40)], "parish_code string, polygons array<array<array<array<double>>>>").coalesce(1)
    plan = boundaries.offences(rows)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" in plan and "REPARTITION_BY_NUM" in plan
