"""Traps of the domain on tiny frames, and the registered queries' contract."""

import datetime as dt
import json
import os
import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from linemart.functions import columns as C
from linemart.operators import compliance, concentration, dims, facts, gapfill, geometry, identity, nodes, quality, scd
from linemart.plans import registry
from linemart.sources import tables
from linemart.streaming import loads

D = lambda y, m, d=1: dt.date(y, m, d)


def test_every_query_has_sql_of_a_known_name():
    names = set(__spark_entry__.queries())
    assert set(registry.oracle_sql()) <= names and len(registry.queries()) >= 120


@pytest.mark.parametrize(
    "kbps,band",
    [(None, "no_data"), (0, "no_data"), (-5, None), (1, "lt_1m"), (1023, "lt_1m"), (1024, "1_10m"), (10240, "10_30m"), (30720, "30_100m"), (102400, "100m_1g"), (1048576, "ge_1g")],
)
def test_speed_bands_are_half_open(spark, kbps, band):
    row = spark.createDataFrame([(kbps,)], "dl long").select(*C.speed_bands(F.col("dl"), "dl")).first().asDict()
    assert [k[3:] for k, v in row.items() if v] == ([band] if band else [])


@pytest.mark.parametrize(
    "text,value,reason",
    [
        (None, None, "valor_nulo"), ("", None, "valor_vacio_o_cero"), ("-", None, "valor_vacio_o_cero"), (" NaN ", None, "valor_vacio_o_cero"), ("abc", None, "sin_componentes_numericos"),
        ("2°10'30\"S", -2.175, None), ("79 53 15,5 O", -79.88763888888889, None), ("1° 75' N", None, "minutos_o_segundos_fuera_de_rango_0_60"), ("-1.2", 1.2, None), ("79,53,15", 79.53 + 0.25, None),
    ],
)
def test_dms(spark, text, value, reason):
    row = spark.createDataFrame([(text,)], "t string").select(C.dms_to_decimal(F.col("t")).alias("v"), C.dms_reason(F.col("t")).alias("r")).first()
    assert row.r == reason and (row.v is None if value is None else row.v == pytest.approx(value))


def test_west_is_inferred_for_longitudes_without_a_letter_only(spark):
    df = spark.createDataFrame([(1, "1 S", "78.5"), (2, "1 S", "78.5 E"), (3, "4.0 N", "78.5"), (4, None, None)], "node long, latitude_text string, longitude_text string")
    got = {r.node: r for r in nodes.clean_coordinates(df).collect()}
    assert got[1].is_valid and got[1].longitude == -78.5 and got[1].west_inferred
    assert not got[2].is_valid and not got[2].west_inferred
    assert got[3].reasons == "latitud_fuera_de_rango_ecuador(4.0000)" and got[3].latitude is None
    assert got[4].reasons == "valor_nulo; coordenada_no_convertible"


KEY = ["k", "n"]


def test_locf_is_interior_atomic_and_null_safe(spark):
    r = random.Random(1)
    rows = [(k, n, D(2000 + m // 12, m % 12 + 1), r.choice([None, 1, 2]), r.choice([None, "x", "y"])) for k in "ab" for n in (None, "z") for m in range(300) if r.random() < 0.3]
    df = spark.createDataFrame(rows, "k string, n string, month date, v int, w string")
    want = []
    for k in "ab":
        for n in (None, "z"):
            own = {m: (v, w) for a, b, m, v, w in rows if (a, b) == (k, n)}
            m, last = min(own), None
            while m <= max(own):
                last = own.get(m, last)
                want.append((k, n, m, *last, m in own, m not in own))
                m = D(m.year + m.month // 12, m.month % 12 + 1)
    assert sorted(map(str, map(tuple, gapfill.interior_locf(df, KEY).collect()))) == sorted(map(str, want))
    assert gapfill.interior_locf(df, KEY, max_months=240).count() < len(want)


def test_scd2(spark):
    schema = "id long, status string, phone string"
    v0 = spark.createDataFrame([], schema + ", valid_from timestamp, valid_to timestamp, is_current boolean")
    s1 = spark.createDataFrame([(1, "a", "p"), (2, "a", "p"), (3, None, "p")], schema)
    s2 = spark.createDataFrame([(1, "b", "q"), (2, "a", "q"), (3, "c", "p"), (4, "a", None)], schema)
    apply = lambda v, s, at: scd.scd2_apply(v, s, ["id"], ["status"], ["phone"], at)
    one = apply(v0, s1, "2020-01-15 00:00:00")
    two = apply(one, s2, "2020-02-15 00:00:00")
    rows = lambda df: sorted(map(str, df.select("id", "status", "phone", "valid_from", "valid_to", "is_current").collect()))
    assert rows(apply(one, s1, "2021-01-01 00:00:00")) == rows(one)
    assert rows(apply(two, s2, "2021-01-01 00:00:00")) == rows(two)
    current = {r.id: (r.status, r.phone) for r in scd.current_view(two).collect()}
    assert current == {1: ("b", "q"), 2: ("a", "q"), 3: ("c", "p"), 4: ("a", None)} and two.count() == 6
    fact = spark.createDataFrame([(1, D(2020, 2)), (1, D(2020, 3)), (9, D(2020, 3))], "id long, month date")
    assert {(r.month.month, r.status) for r in scd.asof_dimension_join(fact, two, ["id"]).collect()} == {(2, "a"), (3, "b")}
    assert scd.current_version_violations(two, ["id"]).count() == 0


def test_licences_resolve_once_for_all_measures(spark):
    def row(provider, licence, lines, dl):
        base = {c: 0 for c in facts.split_measures()} | {"lines": lines, "users": lines, "lines_reported": lines, "lines_imputed": None, "dl_no_data": dl}
        return {"period_id": 200001, "month": D(2000, 1), "provider_id": provider, "licence": licence, "geography_id": "g", **base, "has_reported": True, "has_imputed": False}

    rows = [row("one", "a", 5, 5), row("same", "a", 5, 5), row("same", "b", 5, 3), row("none", "a", None, None), row("none", "b", None, None), row("sum", "a", 5, 5), row("sum", "b", 6, 6)]
    schema = "period_id int, month date, provider_id string, licence string, geography_id string, " + ", ".join(f"{c} long" for c in facts.split_measures()) + ", has_reported boolean, has_imputed boolean"
    df = spark.createDataFrame([tuple(r[f.split()[0]] for f in schema.split(", ")) for r in rows], schema)
    got = {r.provider_id: (r.state, r.lines, r.dl_no_data) for r in facts.resolve_licences(df).collect()}
    assert got == {"one": ("UN_SOLO_PEVA", 5, 5), "same": ("PEVA_DUPLICADOS_MISMO_VALOR_O_UNICO", 5, 5), "none": ("TODOS_SIN_DATO", None, None), "sum": ("PEVA_VALORES_DIFERENTES_SUMADOS", 11, 11)}


def shares(spark, rows):
    cols = "period_id int, month date, provider_id string, geography_id string, lines long, users long, lines_reported long, lines_imputed long, has_reported boolean, has_imputed boolean"
    fact = spark.createDataFrame([(p, D(p // 100, p % 100), q, "g", n, n, n if r else 0, 0 if r else n, r, not r) for p, q, n, r in rows], cols)
    bridge = spark.createDataFrame([("g", C.NATIONAL)], "geography_id string, territory_id string")
    return fact, bridge, concentration.market_share(fact, bridge)


def test_concentration(spark):
    rows = [(202001, "a", 10, True), (202002, "a", 5, True), (202002, "b", 5, True), (202003, "b", 4, True), (202003, "a", 9, False), (202003, "c", 0, True)]
    _, _, share = shares(spark, rows)
    h = {r.period_id: r for r in concentration.hhi(share).collect()}
    assert (h[202001].hhi, h[202002].hhi, h[202002].leader, h[202003].hhi) == (10000.0, 5000.0, "a", 10000.0)
    third = {r.provider_id: r for r in share.filter("period_id = 202003").collect()}
    assert third["a"].share_pct is None and third["a"].is_leader is None and third["a"].line_state == "SIN_REPORTE_ESTE_MES" and third["c"].line_state == "CERO"
    alert = {r.period_id: (r.dominant_absent, r.absent_providers) for r in concentration.dominant_absent_alert(share).collect()}
    assert alert == {202001: (False, None), 202002: (False, None), 202003: (True, "a")}
    assert [(r.provider_id, r.n_months) for r in concentration.absence_episodes(share).collect()] == [("a", 1)]


def test_cr2_of_a_half_is_rounded_up_whatever_doubles_say(spark):
    """6.145324 + 0.791726 is 6.93705, but 6.937049999999999 in doubles."""
    schema = "provider_id string, rank int, share_pct double, hhi_term double, market_reported long, lines_imputed long, n_reported long, n_providers long, coverage_pct double, period_id int, month date, territory_id string"
    share = spark.createDataFrame([(p, k, v, v * v, 9, 0, 2, 2, 100.0, 202001, D(2020, 1), "t") for p, k, v in (("a", 1, 6.145324), ("b", 2, 0.791726))], schema)
    assert concentration.hhi(share).first().cr2 == 6.9371


def test_two_notions_of_the_month_before(spark):
    m = spark.createDataFrame([(202001, D(2020, 1), "t", 10), (202003, D(2020, 3), "t", 20), (202101, D(2021, 1), "t", 5)], "period_id int, month date, territory_id string, lines long")
    by = {r.period_id: r for r in facts.calendar_offset_join(m).collect()}
    assert by[202003].prev_month is None and by[202101].prev_year == 10 and by[202101].pct_year == -50.0
    assert {r.period_id: r.diff for r in compliance.month_diff(m, "lines", "period_id", ["territory_id"]).collect()} == {202001: None, 202003: 10, 202101: -15}


def test_variation_and_churn(spark):
    rows = [(202001, "a", 10, True), (202002, "a", 20, True), (202003, "a", 5, False), (202004, "a", 40, True), (202001, "b", 10, True), (202002, "b", 0, True), (202002, "c", 0, True), (202003, "c", 9, True)]
    fact, _, share = shares(spark, rows)
    odd = {(r.provider_id, r.period_id): r.variation_pct for r in compliance.anomalous_variation(fact, 202001, 202012).collect()}
    assert odd == {("a", 202002): 100.0, ("b", 202002): -100.0}
    assert {r.period_id: r.churn for r in compliance.churn_history(share, "2020-04-01").collect()} == {202001: 0, 202002: 1, 202003: 1, 202004: 0}
    assert [r.provider_id for r in compliance.churned_providers(share, 202002, 202001).collect()] == ["b"]


def test_delivery_rate(spark):
    fact, _, _ = shares(spark, [(202001, "a", 1, True), (202003, "a", 1, True), (202003, "b", 1, False)])
    providers = spark.createDataFrame([("a", None, D(2020, 1)), ("b", D(2019, 2, 10), D(2020, 1))], "provider_id string, permit_date date, first_reported date")
    r = compliance.delivery_rate(fact, providers, 202001, 202003).first()
    assert (r.n_providers, r.n_due, r.n_delivered, r.rate_pct) == (2, 5, 2, 40.0)
    assert compliance.delivery_rate(fact, providers.limit(0), 202001, 202003).first().rate_pct is None


def test_conflict_classes(spark):
    rows = [("1", "a", "X", "SI", "b", "x ", "Nuevo", True), ("1", "a", "X", "Nuevo", "b", "X", "Nuevo", False), ("1", "a", "X - CANCELADO", "Nuevo", "b", "Y", "Nuevo", True), ("1", "a", "X", "Nuevo", "b", "Y", "Nuevo", False)]
    df = spark.createDataFrame(rows, "tax_id string, licence_a string, provider_name_a string, status_a string, licence_b string, provider_name_b string, status_b string, coexist boolean")
    got = [(r.category[0], r.discarded_licence, r.action, r.review_state) for r in identity.classify_conflict(df).collect()]
    assert got == [("A", "a", "DESCARTAR_LEGADO", "CONFIRMADO_AUTOMATICO"), ("B", None, "SIN_CONFLICTO_NO_COEXISTEN", "CONFIRMADO_AUTOMATICO"), ("B", None, "REVISION_MANUAL", "PENDIENTE"), ("C", None, "REVISION_MANUAL", "PENDIENTE")]


def test_points_in_polygons_with_holes_and_borders():
    outer, hole = np.array([[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], float), np.array([[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]], float)
    x, y = np.array([0.5, 0, 1, 1.5, 5]), np.array([0.5, 2, 1.5, 1.5, 2])
    assert geometry.covers(x, y, [[outer, hole]]).tolist() == [True, True, True, False, False]
    line = np.array([[0, 0], [1, 0.001], [2, 0], [2, 2], [0, 2], [0, 0]], float)
    assert len(geometry.simplify_rings([line], 0.01)[0]) == 5 and len(geometry.simplify_rings([line], 0.0001)[0]) == 6


def test_parishes_of_every_shape(spark):
    """A square and an L that share a border, a hole, two polygons, and a code that is no number, against a ray cast point by point."""
    shapes = {
        "000001": [[[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]], "000002": [[[(2, 0), (4, 0), (4, 1), (3, 1), (3, 2), (2, 2), (2, 0)]]],
        "000003": [[[(0, 2), (2, 2), (2, 4), (0, 4), (0, 2)], [(0.5, 2.5), (1.5, 2.5), (1.5, 3.5), (0.5, 3.5), (0.5, 2.5)]]],
        "ISLA": [[[(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]], [[(3.5, 3.5), (4, 3.5), (4, 4), (3.5, 3.5)]]],
    }
    rows = [(c, json.dumps({"type": "MultiPolygon", "coordinates": p} if len(p) > 1 else {"type": "Polygon", "coordinates": p[0]})) for c, p in shapes.items()]
    parishes = spark.createDataFrame(rows, "parish_code string, geometry string").withColumn("polygons", nodes.parse_geojson(F.col("geometry")))
    points = [(k, i / 4 - 0.5, j / 4 - 0.5) for k, (i, j) in enumerate((i, j) for i in range(21) for j in range(21))]
    found = nodes.point_in_parish(spark.createDataFrame(points, "node long, longitude double, latitude double"), parishes, parts=3)

    def inside(x, y, rings):
        odd = False
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                    return True
                if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                    odd = not odd
        return odd

    want = {k: min((c for c, p in shapes.items() if any(inside(x, y, r) for r in p)), default=None) for k, x, y in points}
    assert {r.node: r.parish_code for r in found.collect()} == {k: c for k, c in want.items() if c}
    assert [r.parish_code for r in nodes.nonstandard_codes(parishes.withColumns({"canton_code": F.lit("0001"), "province_code": F.lit("01")})).collect()] == ["ISLA"]


def test_parishes_go_to_python_in_batches(spark):
    """No Python call for each parish: what holds few nodes is tested with others. Without polygons or without a hit there is no row."""
    square = lambda x: [[[[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 1.0], [x, 0.0]]]]
    hook = [[[[8.0, 0.0], [9.0, 0.0], [8.0, 1.0], [8.0, 0.0]]]]
    shapes = spark.createDataFrame([("b", square(0.0)), ("a", square(1.0)), ("c", None), ("d", hook)], f"parish_code string, polygons {nodes.POLYGONS}")
    spots = spark.createDataFrame([(k, 0.5, x) for k, x in enumerate((0.5, 1.0, 1.5, 8.9))], "node long, latitude double, longitude double")
    found = nodes.point_in_parish(spots, shapes)
    assert "CoGroup" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {(0, "b"), (1, "a"), (2, "a")}
    assert nodes.point_in_parish(spots.filter("longitude > 8"), shapes).collect() == []


def test_mart_check_rows_are_the_rows_that_break_a_check(spark):
    split = facts.split_measures()
    fact = spark.createDataFrame(
        [(202001, D(2020, 1), "a", "g", *[1 if c in ("lines", "lines_reported") or c.startswith(("dl_no_data", "ul_no_data")) and not c.endswith("imputed") else 0 for c in split]), (202001, D(2020, 1), "b", "g", *[2] * len(split))],
        "period_id int, month date, provider_id string, geography_id string, " + ", ".join(f"{c} long" for c in split),
    )
    share = spark.createDataFrame([(202001, "t", "a", True, 60.0, 1.0, 50.0), (202001, "t", "b", False, 30.0, 1.0, 101.0)], "period_id int, territory_id string, provider_id string, has_reported boolean, share_pct double, hhi_term double, coverage_pct double")
    hhi = spark.createDataFrame([(202001, "t", 10001.0, 5.0, 4.0), (202002, "t", 10000.0, 4.0, 5.0)], "period_id int, territory_id string, hhi double, cr2 double, cr4 double")
    market = spark.createDataFrame([(202001, "t", 1, 1, 1, 4)], "period_id int, territory_id string, n_positive int, n_zero int, n_no_data int, n_providers int")
    rows = quality.mart_check_rows(fact, share, hhi, market).collect()
    assert sorted((r.check, r.provider_id) for r in rows) == [
        ("bands_sum_to_lines", "b"), ("coverage_in_range", "b"), ("cr2_cr4_ordered", None), ("hhi_in_range", None), ("no_share_without_report", "b"),
        ("provider_counts_add_up", None), ("reported_and_imputed_sum", "b"), ("shares_sum_to_100", None),
    ]
    assert json.loads(next(r for r in rows if r.check == "hhi_in_range").detail) == {"cr2": 5.0, "cr4": 4.0, "hhi": 10001.0, "period_id": 202001, "territory_id": "t"}
    assert {r.check: r.n_bad for r in quality.mart_checks(fact, share, hhi, market).collect()} == {r.check: 1 for r in rows}


def test_mart_checks_make_the_mart_once(spark):
    """Each registered check reads the line detail once in all, not once for each of the eight checks and twelve of their inputs."""
    for name in ("mart_checks", "mart_check_rows"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_shipdate" not in plan, name


def test_normalise_equals_its_two_steps(spark):
    """Test names that take out a tax id or a licence, blanks, null months and licences, against exclusion and resolution one after the other."""
    r = random.Random(4)
    rows = [
        (r.choice(["a", " a", "b", "c", "d", "", None]), r.choice([None, "1-1", "11", "2", "x", "3"]), r.choice(["n", "Prueba", None, "m", "o", "p"]) if k % 3 == 0 else "n", r.choice([None, D(2020, 1), D(2020, 2), D(2021, 1)]), str(k))
        for k in range(40)
    ]
    geo = "province_code string, canton_code string, parish_code string"
    for reports in (rows[::2], rows):
        df, told = (spark.createDataFrame([(*x, "1", "2", "3") for x in y], "licence string, tax_id_raw string, provider_name string, month date, id string, " + geo) for y in (rows, reports))
        told = identity.valid_source_rows(told)
        for used, base in ((None, df), (told, told)):
            left = identity.resolve_tax_id(identity.exclude_test_providers(identity.valid_source_rows(base), used), used)
            got = {(x.id, x.tax_id) for x in identity.normalise(base, used).collect()}
            assert got == {(x.id, x.tax_id) for x in left.collect()}


def test_a_tax_id_that_a_test_name_takes_out_is_nobodys_latest(spark):
    """a shares its tax id with a test provider: its rows under that go, those without a tax id stay and have none; b falls back to its own other one."""
    rows = [("a", "9", "n", D(2020, 1)), ("a", None, "n", D(2020, 2)), ("t", "9", "de Prueba", D(2020, 1)), ("b", "9", "n", D(2020, 3)), ("b", "5", "n", D(2020, 1)), ("b", None, "n", D(2020, 4))]
    df = spark.createDataFrame([(*x, "1", "2", "3") for x in rows], "licence string, tax_id_raw string, provider_name string, month date, province_code string, canton_code string, parish_code string")
    expected = {("a", D(2020, 2), "PEVA|a"), ("b", D(2020, 1), "RUC|5"), ("b", D(2020, 4), "RUC|5")}
    assert {(x.licence, x.month, x.provider_id) for x in identity.normalise(df, df).collect()} == expected
    left = identity.resolve_tax_id(identity.exclude_test_providers(df), df)
    assert {(x.licence, x.tax_id) for x in left.collect()} == {("a", None), ("b", "5")}


def test_percentages_round_as_sql_rounds_doubles(spark):
    """Halves that the double is just under stay under, in both signs; F.round takes them for halves. Results are those of SQL, row by row."""
    duckdb = pytest.importorskip("duckdb")
    pairs = [(201, 20000), (-201, 20000), (1, 200000), (23, 40000), (-1, 3), (7, 0), (10**15, 1)] + [(k * 3 + 1, 16000) for k in range(3000)] + [(-k, 8000) for k in range(1000)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.p for r in df.select(C.pct(F.col("a"), F.col("b"), 2).alias("p")).collect()]
    one = duckdb.connect().execute
    want = [r[0] for r in one("SELECT round(100.0 * a::DOUBLE / nullif(b, 0), 2) FROM (SELECT unnest(?) AS a, unnest(?) AS b)", [[a for a, _ in pairs], [b for _, b in pairs]]).fetchall()]
    assert got == want
    assert got[:2] == [1.0, -1.0]


def test_months_between_reports_are_not_shuffled(spark):
    """Rows of each month are made where the facts of their provider and geography are: no exchange stands above the explosion."""
    for df in (registry.Mart(spark, "/root/testdata/sf0.001").fact, registry.Mart(spark, "/root/testdata/sf0.001").licence_geo):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "sequence(" in plan and "Exchange" not in plan[: plan.index("sequence(")]


def test_lines_meet_once_in_numbers(spark):
    """Grouping and gap filling share one exchange, in which no text of `DETAIL` is; what comes out is what the texts would give."""
    m = registry.Mart(spark, "/root/testdata/sf0.001")
    plan = m.carried._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(l_suppkey") == 1
    by_text = facts.monthly_line_summary(m.detail, [*registry.NATURAL_KEY, *registry.ATTRIBUTES])
    for got, want in ((m.summary, by_text), (m.consolidated, gapfill.interior_locf(by_text, registry.SERIES))):
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()


def test_territories_are_made_in_one_read(spark):
    m = registry.Mart(spark, "/root/testdata/sf0.001")
    assert m.territories._jdf.queryExecution().executedPlan().toString().count("Union") == 0
    g = spark.createDataFrame([("01", "p", "0101", "c", None, None), (None, None, "0101", "b", "010101", "q")], ", ".join(f"{c} string" for c in dims.GEOGRAPHY))
    assert {tuple(r) for r in dims.territory_dimension(g).collect()} == {
        ("NACIONAL|ECUADOR", "NACIONAL", 0, None, "Ecuador"), ("PROVINCIA|01", "PROVINCIA", 1, "01", "p"), ("CANTON|0101", "CANTON", 2, "0101", "b"), ("PARROQUIA|010101", "PARROQUIA", 3, "010101", "q")}


def test_plans_compile(spark, capfd):
    """Coordinates under a filter, and facts with their many measures: no plan falls back to interpreted code."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        for name in ("point_in_parish", "resolve_licences", "hhi"):
            registry.queries()[name](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_sources_and_sinks(spark, tmp_path):
    path = f"{tmp_path}/summary"
    rows = lambda *r: spark.createDataFrame(list(r), "licence string, share_level string, year int, lines long")
    tables.upsert_summary(spark, path, rows(("a", None, 2020, 1), ("b", "x", 2021, 1)), ["licence", "share_level", "year"], ["year"])
    for _ in range(2):
        tables.upsert_summary(spark, path, rows(("a", None, 2020, 9)), ["licence", "share_level", "year"], ["year"])
    got = lambda back=0: sorted((r.licence, r.year, r.lines) for r in tables.read_summary(spark, path, back).collect())
    assert got() == [("a", 2020, 9), ("b", 2021, 1)] and got(2) == [("a", 2020, 1), ("b", 2021, 1)]
    for _ in range(2):  # a null partition is replaced like any other; others stay where they are
        tables.upsert_summary(spark, path, spark.createDataFrame([("n", "y", None, 5), ("b", "x", 2021, 7)], "licence string, share_level string, year int, lines long"), ["licence", "share_level", "year"], ["year"])
    assert sorted(r.lines for r in tables.read_summary(spark, path).collect()) == [5, 7, 9]
    assert not os.path.exists(f"{path}/data/batch=3/year=2020") and os.path.exists(f"{path}/data/batch=3/year=2021")
    with pytest.raises(ValueError, match="2 rows of the key"):
        tables.upsert_summary(spark, path, rows(("a", None, 2020, 1), ("a", None, 2020, 2)), ["licence", "share_level", "year"], ["year"])
    codes = f"{tmp_path}/codes"
    for lines in (1, 2):
        tables.upsert_summary(spark, codes, spark.createDataFrame([("01", lines)], "code string, lines long"), ["code"], ["code"])
    assert [(r.code, r.lines) for r in tables.read_summary(spark, codes).collect()] == [("01", 2)]
    pub = f"{tmp_path}/pub"
    tables.publish_with_previous(spark, rows(("a", None, 1, 1)), pub), tables.publish_with_previous(spark, rows(("b", None, 1, 1)), pub)
    assert tables.read_published(spark, pub).first().licence == "b" and tables.read_published(spark, pub, 1).first().licence == "a"
    os.makedirs(f"{pub}/version=2/half")  # begun and never finished
    assert tables.publish_with_previous(spark, rows(("c", None, 1, 1)), pub).endswith("version=3")
    assert tables.read_published(spark, pub).first().licence == "c" and tables.read_published(spark, pub, 1).first().licence == "b"
    tables.append_load_log(spark, f"{tmp_path}/log", "year", 2020, 5, "ok")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 1
    built = []
    for _ in range(2):
        tables.load_if_empty(spark, f"{tmp_path}/once", lambda: built.append(1) or rows(("a", None, 1, 1)))
    assert built == [1]
    tables.export_report(rows(("a", None, 1, 1)), f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").columns == ["licence", "share_level", "year", "lines"]
    with pytest.raises(ValueError, match="geometry"):
        spark.createDataFrame([("1",)], "parish_code string").write.json(f"{tmp_path}/geo")
        tables.read_boundaries(spark, f"{tmp_path}/geo")


def test_stream_of_batches_upserts(spark, tmp_path):
    schema = "licence string, year int, lines long"
    for k, lines in enumerate((1, 2)):
        spark.createDataFrame([("a", 2020, lines)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        loads.upsert_available(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/cp", ["licence", "year"], ["year"])
        assert [r.lines for r in tables.read_summary(spark, f"{tmp_path}/out").collect()] == [lines]


def test_a_month_and_its_correction_in_one_batch(spark, tmp_path):
    """Files that arrive between two calls meet in one batch: the latest row of a key counts, and the stream goes on."""
    schema = "licence string, year int, lines long"
    for k, rows in enumerate(([("a", 2020, 1), ("b", 2020, 5)], [("a", 2020, 2), (None, 2020, 3)], [("a", 2020, 7), (None, 2020, 4), ("a", 2020, 8)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for f in (tmp_path / "in").glob("part-*"):  # times apart, in the order of arrival
            if f.stat().st_mtime > 1_000_000_100:
                os.utime(f, (1_000_000_000 + k, 1_000_000_000 + k))
    for _ in range(2):
        loads.upsert_available(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/cp", ["licence", "year"], ["year"])
        assert {r.licence: r.lines for r in tables.read_summary(spark, f"{tmp_path}/out").collect()} == {"a": 8, "b": 5, None: 4}


def test_writers_at_once_do_not_share_a_number(spark, tmp_path, monkeypatch):
    row = lambda k, v: spark.createDataFrame([(k, 2020, v)], "licence string, year int, lines long")
    path = f"{tmp_path}/t"
    tables.upsert_summary(spark, path, row("a", 1), ["licence"], ["year"])
    with ThreadPoolExecutor(4) as pool:
        assert len({f.result() for f in [pool.submit(tables.claimed, spark, path) for _ in range(12)]}) == 12
    upserted = tables.upsert

    def slow(*args):  # another writer gets in between
        monkeypatch.setattr(tables, "upsert", upserted)
        tables.upsert_summary(spark, path, row("b", 2), ["licence"], ["year"])
        return upserted(*args)

    monkeypatch.setattr(tables, "upsert", slow)
    with pytest.raises(RuntimeError, match="another upsert"):
        tables.upsert_summary(spark, path, row("c", 3), ["licence"], ["year"])
    assert {r.licence for r in tables.read_summary(spark, path).collect()} == {"a", "b"}
    tables.upsert_summary(spark, path, row("c", 3), ["licence"], ["year"])
    assert {r.licence for r in tables.read_summary(spark, path).collect()} == {"a", "b", "c"}


def test_flagship_is_sound(spark):
    m = registry.Mart(spark, "/root/testdata/sf0.001")
    checks = {r.check: r.n_bad for r in quality.mart_checks(m.fact, m.share, m.hhi, m.market).collect()}
    may_fail = {"bands_sum_to_lines", "reported_and_imputed_sum"}  # of licences with equal totals and different splits the larger parts count
    assert all(v == 0 for k, v in checks.items() if k not in may_fail) and len(checks) == 8
    assert dims.territory_dimension(m.geographies).filter("level = 'NACIONAL'").count() == 1
    assert __spark_entry__.entry(spark).count() > 0


def test_national_shares_and_provider_months_are_made_once(spark, monkeypatch):
    """Alert, dependency and stopped providers read all facts once for each table that they need: what is read again is stored."""
    m = registry.Mart(spark, "/root/testdata/sf0.001")
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("l_shipdate#")
    assert scans(concentration.dominant_absent_alert(m.share, 3.0)) == 0
    assert scans(compliance.stopped_reporting(m.fact, m.providers)) == 0
    fact, geographies = scans(m.fact), scans(m.geographies)
    assert scans(compliance.geographic_dependency(m.fact, m.share, m.geographies, 200106, 0.5)) <= fact + geographies


def test_facts_are_not_exchanged_for_markets(spark):
    m = registry.Mart(spark, "/root/testdata/sf0.001")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    parishes, above = m.provider_months
    assert "hashpartitioning(period_id" not in plan(facts.market_totals(parishes))
    assert "hashpartitioning(period_id" not in plan(concentration.shares_of(parishes))
    assert plan(above).count("hashpartitioning(period_id") == 1  # sums of areas, not facts
    wide = plan(m.speeds)
    assert wide.count("hashpartitioning(period_id") == 1 and "REPARTITION_BY_NUM" in wide


def test_sums_of_parishes_and_areas_are_those_of_all_territories(spark):
    r = random.Random(5)
    rows = []
    for k in range(300):
        place = "|".join(["GEO", r.choice(["01", "02", "SIN_PROVINCIA"]), r.choice(["0101", "0102", "SIN_CANTON"]), r.choice(["010101", "010102", "SIN_PARROQUIA"])])
        lines = r.choice([None, 0, 3, 5])
        rows.append((199901, D(1999, 1), f"P{k % 7}", place, lines, r.choice([None, 4]), lines, None, lines is not None, r.random() < 0.5))
    fact = spark.createDataFrame(rows, "period_id int, month date, provider_id string, geography_id string, lines long, users long, lines_reported long, lines_imputed long, has_reported boolean, has_imputed boolean")
    whole = {tuple(x) for x in facts.provider_territory_month(fact).collect()}
    at = facts.parish_territory(F.col("geography_id"))
    parishes = facts.provider_sums(fact.withColumn("territory_id", at).filter("territory_id is not null"), facts.PROVIDER_CELL)
    above = facts.provider_area_month(fact.withColumn("area", facts.area_id(F.col("geography_id"))))
    apart = [tuple(x) for x in parishes.unionByName(above).collect()]
    assert len(apart) == len(set(apart)) and set(apart) == whole


def test_territories_of_providers_need_no_months_between(spark):
    plan = registry.queries()["territories_of_providers"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "lead(" not in plan and "sequence(" not in plan


def test_shares_are_not_exchanged_for_names(spark):
    """However large the dimensions are; the same rows as those that all dimensions are joined to."""
    m = registry.Mart(spark, "/root/testdata/sf0.001")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = registry.queries()["vw_share"](spark, m.sf_dir)
        plan = view._jdf.queryExecution().executedPlan().toString()
        share_joins = [x for x in plan.split("\n") if "Join [" in x and ("[_p#" in x or "[period_id#" in x)]
        assert not [x for x in share_joins if "Join [provider_id#" in x] and all("BroadcastHashJoin [period_id#" in x or "[_p#" in x for x in share_joins)
        assert "hashpartitioning(territory_id" in plan and "Exchange hashpartitioning(period_id" in plan  # the sums of areas are
        want = dims.star_view(m.share, m.periods, m.territories, m.providers).select(*view.columns)
        assert sorted(map(repr, view.collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
