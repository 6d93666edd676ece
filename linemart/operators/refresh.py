"""What a late or corrected month changes in the layers above it, from the changed reports up, instead of building all again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemart.functions.columns import clean_tax_id
from linemart.operators import facts
from linemart.operators.gapfill import carried_months
from linemart.operators.identity import known_reporters, with_period
from linemart.operators.scd import same

CELL = ["month", "territory_id", "provider_id"]
COUNTERS = ["lines", "with_data", "users", "with_users", "lines_reported", "lines_imputed", "reported_cells", "imputed_cells", "cells"]
REPORTER = ["licence", "month", "tax_id_raw", "provider_name"]
#: What counters are made of.
COUNTED = ["lines", "users"]


def matching(rows: DataFrame, units: DataFrame, key: list[str], how: str = "left_semi") -> DataFrame:
    """The rows whose key is among the units (left_anti: is not), nulls being equal to each other."""
    return rows.alias("a").join(units.select(*key).alias("b"), same("a", "b", key), how)


def changed_reports(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the batch that are new or differ from the stored report of their key; what is loaded again unchanged is not among them."""
    return matching(batch, stored.select(*batch.columns), batch.columns, "left_anti")


def report_months(reports: DataFrame, series: list[str]) -> DataFrame:
    """The months of each series in order: one short array a series, however many measures its reports have."""
    return reports.groupBy(*series).agg(F.array_sort(F.collect_set("month")).alias("months"))


def merged_months(before: DataFrame, changed: DataFrame, series: list[str]) -> DataFrame:
    """(series, months, before) of the series that have changed reports: their months now, and those they had, null if they are new."""
    added = report_months(changed, series)
    joined = added.alias("b").join(before.alias("a"), same("a", "b", series), "left")
    months = F.array_sort(F.array_union(F.coalesce("a.months", F.array().cast("array<date>")), F.col("b.months")))
    return joined.select(*[F.col(f"b.{c}").alias(c) for c in series], months.alias("months"), F.col("a.months").alias("before"))


def _after(months: str, month: str) -> Column:
    return F.array_min(F.filter(months, lambda x: x > F.col(month)))


def refilled(changed: DataFrame, merged: DataFrame, series: list[str]) -> DataFrame:
    """The filled rows that changed reports give: their own month and those up to the next report of the series."""
    values = [c for c in changed.columns if c not in [*series, "month"]]
    known = changed.alias("a").join(merged.alias("b"), same("a", "b", series)).select("a.*", F.col("b.months").alias("_all"))
    until = F.greatest("month", F.add_months(_after("_all", "month"), -1))
    rows = known.withColumn("_m", F.explode(F.sequence(F.col("month"), until, F.expr("interval 1 month"))))
    reported = F.col("_m") == F.col("month")
    return rows.select(*series, F.col("_m").alias("month"), *values, reported.alias("is_reported"), (~reported).alias("is_imputed"))


def lengthened(merged: DataFrame, series: list[str]) -> DataFrame:
    """(series, month, from, until): last reports so far that are now carried on, as a series goes on after a gap."""
    last = F.array_max("before")
    told = merged.filter("before is not null").select(*series, last.alias("month"), F.add_months(F.array_min(F.filter("months", lambda x: x > last)), -1).alias("until"))
    return told.filter("until > month").withColumn("from", F.add_months("month", 1).cast("date")).select(*series, "month", "from", "until")


def carried_on(reports: DataFrame, ends: DataFrame, series: list[str]) -> DataFrame:
    """The filled rows that lengthened reports add; their own months are there already."""
    values = [c for c in reports.columns if c not in [*series, "month"]]
    rows = reports.alias("a").join(ends.alias("b"), same("a", "b", [*series, "month"])).select("a.*", F.explode(F.sequence("b.from", "b.until", F.expr("interval 1 month"))).alias("_m"))
    return rows.select(*series, F.col("_m").alias("month"), *values, F.lit(False).alias("is_reported"), F.lit(True).alias("is_imputed"))


def reporter_counts(reports: DataFrame, weight: int = 1) -> DataFrame:
    """How many reports say so of a licence, its tax id and its name, by month. The counts of what goes count down."""
    return reports.groupBy(*REPORTER).agg((F.count("*") * weight).alias("n"))


def added_up(parts: list[DataFrame], key: list[str], counters: list[str], count: str) -> DataFrame:
    """Sums of counters over the parts; a key whose count comes to nothing goes."""
    return reduce(DataFrame.unionByName, parts).groupBy(*key).agg(*[F.sum(c).alias(c) for c in counters]).filter(F.col(count) > 0)


def other_identity(before: DataFrame, after: DataFrame) -> DataFrame:
    """(licence, own): reporters on both sides that a test name takes out, or no longer, or whose fallback tax id is another one.

    One that is on one side only has changed reports itself.
    """
    pair = ["licence", "own"]
    joined = known_reporters(before).alias("a").join(known_reporters(after).alias("b"), same("a", "b", pair))
    fallback = F.col("a.own").isNull() & ~same("a", "b", ["latest"])
    return joined.filter(~same("a", "b", ["is_test"]) | fallback).select("a.licence", "a.own")


def rows_of_reporters(rows: DataFrame, reporters: DataFrame) -> DataFrame:
    own = rows.withColumn("own", clean_tax_id(F.col("tax_id_raw")))
    return matching(own, reporters, ["licence", "own"]).drop("own")


def provider_counters(fact: DataFrame, weight: int = 1) -> DataFrame:
    """Market cells by month, territory and provider as counters that add up: facts that go have weight -1."""
    return counters(facts.territory_rollup(fact), CELL, weight)


def counters(fact: DataFrame, key: list[str], weight: int = 1) -> DataFrame:
    count = lambda c: F.count_if(c)
    sums = {
        "lines": F.sum(F.coalesce("lines", F.lit(0))), "with_data": F.count("lines"), "users": F.sum(F.coalesce("users", F.lit(0))), "with_users": F.count("users"),
        "lines_reported": F.sum(F.coalesce("lines_reported", F.lit(0))), "lines_imputed": F.sum(F.coalesce("lines_imputed", F.lit(0))),
        "reported_cells": count(F.col("has_reported")), "imputed_cells": count(F.col("has_imputed")), "cells": F.count("*"),
    }
    return fact.groupBy(*key).agg(*[(c * weight).alias(n) for n, c in sums.items()])


def counters_of_reports(reports: DataFrame, parts: int, weight: int = 1) -> DataFrame:
    """The counters of the facts of resolved reports with `until`, in the months `wanted` of each if they have that column.

    Reports are exchanged twice, by parish and by provider and area; months, licences and facts are made where they then are,
    of the measures that are counted, and only the sums of areas are exchanged.
    """

    def made(rows: DataFrame, by: list[str], also: str) -> DataFrame:
        months = wanted_months(rows.repartition(parts, *by)) if "wanted" in rows.columns else carried_months(rows.repartition(parts, *by))
        return facts.resolve_licences(facts.licence_geo_month(with_period(months), [also], COUNTED), [also], COUNTED)

    at = reports.withColumn("territory_id", facts.parish_territory(F.col("geography_id"))).filter("territory_id is not null")
    parishes = counters(made(at, ["territory_id"], "territory_id"), CELL, weight)
    within = made(reports.withColumn("area", facts.area_id(F.col("geography_id"))), ["provider_id", "area"], "area")
    areas = counters(within, ["month", "provider_id", "area"], weight).withColumn("territory_id", F.explode(facts.territories_of_id(F.col("area"))))
    return parishes.unionByName(areas.groupBy(*CELL).agg(*[F.sum(c).alias(c) for c in COUNTERS]))


def wanted_at(reports: DataFrame, units: DataFrame, key: list[str]) -> DataFrame:
    """Reports with `until` of the units' keys, each with its key's months as `wanted`: an array no longer than there are months."""
    months = units.groupBy(*key).agg(F.collect_set("month").alias("wanted"))
    return reports.alias("a").join(months.alias("b"), same("a", "b", key)).select("a.*", "b.wanted")


def wanted_months(reports: DataFrame) -> DataFrame:
    """A row for each wanted month that a report is carried to."""
    hit = F.filter("wanted", lambda m: (m >= F.col("month")) & (m <= F.col("until")))
    rows = reports.withColumn("_m", F.explode(hit))
    reported = F.col("_m") == F.col("month")
    rest = [c for c in reports.columns if c not in ("month", "until", "wanted")]
    return rows.select(F.col("_m").alias("month"), *rest, reported.alias("is_reported"), (~reported).alias("is_imputed"))


def provider_month_of(counters: DataFrame) -> DataFrame:
    """The counters as sums by month, territory and provider, as the market functions take them."""
    return counters.select(
        (F.year("month") * 100 + F.month("month")).cast("int").alias("period_id"), *CELL, "lines", "with_data", F.when(F.col("with_users") > 0, F.col("users")).alias("users"),
        "lines_reported", "lines_imputed", (F.col("reported_cells") > 0).alias("has_reported"), (F.col("imputed_cells") > 0).alias("has_imputed"),
    )
