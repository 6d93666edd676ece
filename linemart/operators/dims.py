"""Dimensions and bridges of the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linemart.functions.columns import MONTHS, NATIONAL, assign_period_id, is_cancelled, parse_permit_date
from linemart.operators.facts import territory_ids


def latest_per_key(rows: DataFrame, key: list[str], order: list[str], values: list[str] | None = None) -> DataFrame:
    """The row of each key that is last by `order`; an aggregate of structs, so nothing is sorted."""
    values = [c for c in rows.columns if c not in key] if values is None else values
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v"))
    return best.select(*key, *[F.col(f"_v.{c}").alias(c) for c in values])


def period_dimension(spark, first: str, last: str) -> DataFrame:
    """A row for each month from first to last (ISO dates)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("month"))
    return describe_months(days)


def describe_months(days: DataFrame) -> DataFrame:
    m = F.col("month")
    return days.select(
        assign_period_id(m).alias("period_id"), "month", F.year(m).alias("year"), F.month(m).alias("month_number"),
        F.element_at(F.array(*[F.lit(x) for x in MONTHS]), F.month(m)).alias("month_name"), F.quarter(m).alias("quarter"),
        F.date_format(m, "yyyy-MM").alias("year_month"), F.concat(F.year(m), F.lit("-T"), F.quarter(m)).alias("year_quarter"),
        F.trunc(m, "quarter").alias("quarter_start"), F.last_day(m).alias("month_end"),
    )


def provider_dimension(rows: DataFrame) -> DataFrame:
    """One row for each provider: its latest attributes, months on record and really reported, statuses and licences.

    rows are months, reported or imputed, or reports with the month `until` which they are carried; both give the same.
    """
    status = F.array_join(F.sort_array(F.collect_set("status")), ", ")
    licences = F.sort_array(F.collect_set("licence"))
    last = "until" if "until" in rows.columns else "month"
    real = F.when(F.col("is_reported"), F.col("month")) if last == "month" else F.col("month")
    return rows.groupBy("provider_id").agg(
        F.max_by(F.struct("provider_name", "tax_id", "permit_text"), F.struct(last, "licence")).alias("_v"),
        F.min("month").alias("first_month"), F.max(last).alias("last_month"), F.min(real).alias("first_reported"), F.max(real).alias("last_reported"),
        F.bool_and(is_cancelled(F.col("status"))).alias("is_cancelled"), status.alias("statuses"),
        F.size(licences).cast("long").alias("n_licences"), F.array_join(licences, ", ").alias("licences"),
    ).select(
        "provider_id", F.col("_v.provider_name").alias("provider_name"), F.col("_v.tax_id").alias("tax_id"), F.col("_v.permit_text").alias("permit_text"),
        parse_permit_date(F.col("_v.permit_text")).alias("permit_date"), "first_month", "last_month", "first_reported", "last_reported",
        "is_cancelled", "statuses", "n_licences", "licences",
    )


def provider_licence_bridge(rows: DataFrame) -> DataFrame:
    return rows.groupBy("provider_id", "licence").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))


GEOGRAPHY = ["province_code", "province_name", "canton_code", "canton_name", "parish_code", "parish_name"]


def geography_dimension(rows: DataFrame) -> DataFrame:
    """Codes and names of each geography in its latest month."""
    return latest_per_key(rows.select("geography_id", "month", *GEOGRAPHY), ["geography_id"], ["month", *GEOGRAPHY], GEOGRAPHY)


def geography_territory_bridge(geographies: DataFrame) -> DataFrame:
    ids = territory_ids(F.col("province_code"), F.col("canton_code"), F.col("parish_code"))
    return geographies.select("geography_id", F.explode(ids).alias("territory_id"))


LEVELS = ["NACIONAL", "PROVINCIA", "CANTON", "PARROQUIA"]


def territory_dimension(geographies: DataFrame) -> DataFrame:
    """All territories of the four levels with the first name (in order of text) of each code."""
    fields = ("territory_id", "level", "level_order", "code", "name")
    row = lambda *values: F.struct(*[v.alias(f) for v, f in zip(values, fields, strict=True)])
    cells = [row(F.lit(NATIONAL), F.lit(LEVELS[0]), F.lit(0), F.lit(None).cast("string"), F.lit("Ecuador"))]
    for k, (level, name) in enumerate(zip(LEVELS[1:], ("province", "canton", "parish"), strict=True), 1):
        code = F.col(f"{name}_code")
        cells.append(F.when(code.isNotNull(), row(F.concat(F.lit(f"{level}|"), code), F.lit(level), F.lit(k), code, F.col(f"{name}_name"))))
    whole = geographies.select(F.inline(F.array_compact(F.array(*cells))))
    return whole.groupBy("territory_id", "level", "level_order", "code").agg(F.min("name").alias("name"))


def star_view(fact: DataFrame, periods: DataFrame, territories: DataFrame, providers: DataFrame | None = None, leader: str | None = None) -> DataFrame:
    """A fact with the names of its month and territory, and of its provider, or (optionally) its leader.

    Territories come first, as facts may lie by them already; months are as few as the calendar has, so they are broadcast.
    """
    rest = [c for c in fact.columns if c not in ("territory_id", "period_id")]
    out = fact.join(territories.select("territory_id", "level", "name"), "territory_id").join(F.broadcast(periods.select("period_id", "year_month", "year_quarter")), "period_id")
    out = out.select("territory_id", "period_id", *rest, "year_month", "year_quarter", "level", "name")
    if providers is not None:
        named = providers.select(F.col("provider_id").alias("_p"), "provider_name")
        out = out.join(named, F.col(leader or "provider_id") == F.col("_p"), "left" if leader else "inner").drop("_p")
    return out


def evolution(market: DataFrame, territory: str, first: int, last: int) -> DataFrame:
    return market.filter((F.col("territory_id") == territory) & F.col("period_id").between(first, last)).orderBy("period_id")


def resolve_period(periods: DataFrame, day) -> DataFrame:
    """The month of a day, moved to the first or last that there is."""
    bounds = periods.agg(F.min("period_id").alias("low"), F.max("period_id").alias("high"))
    wanted = assign_period_id(F.lit(day).cast("date"))
    return bounds.select(F.least(F.greatest(wanted, "low"), "high").alias("period_id"))


def latest_month_row(market: DataFrame, territory: str) -> DataFrame:
    """The last month of a territory, and the last with really reported lines."""
    own = market.filter(F.col("territory_id") == territory)
    return own.agg(F.max("period_id").alias("last_period"), F.max(F.when(F.col("lines_reported") > 0, F.col("period_id"))).alias("last_reported_period"))


def facet_values(rows: DataFrame, column: str, split: bool = False, normalise: bool = False) -> DataFrame:
    """Distinct values to choose from: of a comma list one by one, or trimmed and in upper case."""
    c = F.explode(F.split(F.col(column), ",")) if split else F.col(column)
    values = rows.select(c.alias("value")).select((F.upper(F.trim("value")) if normalise else F.trim("value")).alias("value"))
    return values.filter("value <> ''").distinct()


def faceted_territories(geographies: DataFrame, level: str, **selected: list[str]) -> DataFrame:
    """Codes of one level that remain under selections of codes on other levels."""
    out = geographies.filter(F.col(f"{level}_code").isNotNull())
    for other, codes in selected.items():
        if codes and other != level:
            out = out.filter(F.col(f"{other}_code").isin(codes))
    return out.groupBy(F.col(f"{level}_code").alias("code")).agg(F.min(f"{level}_name").alias("name"))


def territory_filter(fact: DataFrame, geographies: DataFrame, provinces: list[str] = (), cantons: list[str] = (), parishes: list[str] = ()) -> DataFrame:
    """Facts in the selected territories: every level with a selection must fit; no row is multiplied."""
    chosen = geographies
    for level, codes in (("province", provinces), ("canton", cantons), ("parish", parishes)):
        if codes:
            chosen = chosen.filter(F.col(f"{level}_code").isin(list(codes)))
    return fact.join(chosen.select("geography_id"), "geography_id", "left_semi")


def territories_of_providers(share: DataFrame, providers: list[str] | None = None) -> DataFrame:
    own = share.filter("has_reported")
    return (own if providers is None else own.filter(F.col("provider_id").isin(providers))).select("territory_id").distinct()
