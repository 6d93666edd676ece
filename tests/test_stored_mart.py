"""The stored mart: a reload gives what building all again gives, and writes only what it touches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from linemart.functions.columns import BAND_COLUMNS
from linemart.operators import concentration, facts, gapfill, identity
from linemart.plans.adapters import ATTRIBUTES, SERIES
from linemart.sources.mart import StoredMart
from linemart.sources.tables import read_published

FIELDS = [*SERIES, "month", *ATTRIBUTES, "lines", "users", *BAND_COLUMNS]
SCHEMA = ", ".join(f"{c} {'date' if c == 'month' else 'bigint' if c in ('lines', 'users', *BAND_COLUMNS) else 'string'}" for c in FIELDS)


def report(licence="1", parish="010101", month=(2020, 1), tax="11", name="n", lines=1, users=1, share=None, province="01"):
    values = dict.fromkeys(FIELDS) | {"licence": licence, "parish_code": parish, "month": month and dt.date(*month, 1), "link_type": "a", "client_type": "b", "share_level": share}
    values |= {"tax_id_raw": tax, "provider_name": name, "province_code": province, "canton_code": "0101", "lines": lines, "users": users} | {c: lines for c in BAND_COLUMNS}
    return tuple(values[c] for c in FIELDS)


def key(row):
    return tuple(row[: len(SERIES) + 1])


def frame(spark, rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(df, columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


def assert_as_built_again(spark, mart, reports):
    reports = frame(spark, reports).filter("month is not null")
    filled = gapfill.interior_locf(reports, SERIES)
    cells = facts.licence_geo_month(identity.normalise(filled, reports))
    fact = facts.resolve_licences(cells)
    wanted = {"reports": reports, "filled": filled, "licence_geo": cells, "fact": fact, "market": facts.market_summary(fact)}
    for name, want in wanted.items():
        assert rows_of(mart.layer(name), want.columns) == rows_of(want, want.columns), name
    shares = concentration.shares_of(mart.share_cells())
    want = concentration.market_share(fact)
    assert rows_of(shares, want.columns) == rows_of(want, want.columns)


def test_random_reloads_equal_building_again(spark, tmp_path):
    """Gaps closed and opened, series that begin earlier or go on later, other geographies, tax ids that move, names of test providers that come and go."""
    r = random.Random(7)

    def some():
        return report(
            r.choice(["1", "2", "3", " ", None]), r.choice(["010101", "010102", None]), r.choice([(2020, m) for m in range(1, 9)]), r.choice([None, "11", "1-1", "22", "33"]),
            r.choice(["n"] * 9 + ["Prueba"]), r.choice([0, 1, 2, 2, None]), r.choice([1, 5, None]), r.choice([None, "S"]), r.choice(["01", "01", "02", None]),
        )

    held = {key(x): x for x in [some() for _ in range(25)]}
    mart = StoredMart(spark, f"{tmp_path}/m", SERIES)
    mart.build(frame(spark, held.values()), parts=2)
    for n in (2, 7):
        batch = {key(x): x for x in [some() for _ in range(n)]}
        mart.reload(frame(spark, batch.values()))
        held |= batch
        assert_as_built_again(spark, StoredMart(spark, f"{tmp_path}/m", SERIES), held.values())


def test_a_reload_writes_the_months_it_reaches(spark, tmp_path):
    """A correction reaches the months up to the next report of its series; other months keep their files, a repeated load writes nothing."""
    months = [(y, m) for y in (2019, 2020) for m in range(1, 13)]
    rows = [report(str(n), f"0101{n:02}", at, str(10 + n), lines=n) for n in range(1, 5) for at in months if n != 1 or at not in ((2020, 4), (2020, 5))]
    mart = StoredMart(spark, f"{tmp_path}/m", SERIES)
    mart.build(frame(spark, rows), parts=4)
    written = mart.reload(frame(spark, [report("1", "010101", (2020, 3), "11", lines=9)]))
    assert written["reports"] == 1 and written["filled"] == written["fact"] == written["licence_geo"] == 3
    assert 3 <= written["market"] <= 12 and written["market"] == written["provider_month"]
    batches = read_published(spark, f"{tmp_path}/m/manifest").filter("layer = 'filled'").groupBy(F.col("batch") > 0).count().collect()
    assert {r[0]: r["count"] for r in batches} == {True: 3, False: len(mart.held["filled"]) - 3}
    before = mart.version
    assert mart.reload(frame(spark, [report("1", "010101", (2020, 3), "11", lines=9), report("1", "010101", None)])) == {} and mart.version == before
    plan = mart.layer("market").filter("month = date'2020-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_errors_and_empty_marts(spark, tmp_path):
    mart = StoredMart(spark, f"{tmp_path}/m", SERIES)
    with pytest.raises(ValueError, match="no mart"):
        mart.reload(frame(spark, [report()]))
    with pytest.raises(ValueError, match="2 reports of the key"):
        mart.build(frame(spark, [report(), report(lines=2)]))
    mart.build(frame(spark, []), parts=2)
    assert mart.layer("market").count() == 0
    mart.reload(frame(spark, [report(), report(month=(2020, 3))]))
    assert_as_built_again(spark, mart, [report(), report(month=(2020, 3))])
    with pytest.raises(ValueError, match="already"):
        mart.build(frame(spark, [report()]))
    late = StoredMart(spark, f"{tmp_path}/m", SERIES)
    mart.reload(frame(spark, [report(lines=4)]))
    with pytest.raises(RuntimeError, match="another upsert"):
        late.reload(frame(spark, [report(lines=5)]))
    late.refresh()
    assert late.reload(frame(spark, [report(lines=5)]))["reports"] == 1


@pytest.mark.parametrize("seed", [7, 11])
def test_random_reloads_without_stored_detail(spark, tmp_path, seed):
    """What is not stored is made of the reports: the same layers, counters and markets, and no files of detail."""
    r = random.Random(seed)

    def some():
        return report(
            r.choice(["1", "2", "3", " ", None]), r.choice(["010101", "010102", None]), r.choice([(2020, m) for m in range(1, 9)]), r.choice([None, "11", "1-1", "22", "33"]),
            r.choice(["n"] * 9 + ["Prueba"]), r.choice([0, 1, 2, 2, None]), r.choice([1, 5, None]), r.choice([None, "S"]), r.choice(["01", "01", "02", None]),
        )

    held = {key(x): x for x in [some() for _ in range(25)]}
    mart = StoredMart(spark, f"{tmp_path}/m", SERIES)
    mart.build(frame(spark, held.values()), parts=2, detail=False)
    assert not {"filled", "licence_geo", "fact"} & set(mart.held)
    assert_as_built_again(spark, mart, held.values())
    for n in (2, 7):
        batch = {key(x): x for x in [some() for _ in range(n)]}
        written = mart.reload(frame(spark, batch.values()))
        held |= batch
        assert not {"filled", "licence_geo", "fact"} & set(written)
        assert_as_built_again(spark, StoredMart(spark, f"{tmp_path}/m", SERIES), held.values())
