"""Facts: monthly roll-up of line detail, licences per provider resolved to one figure, markets by territory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linemart.functions.columns import BAND_COLUMNS, BAND_NAMES, NATIONAL, month_index, pct, speed_bands

MEASURES = ["lines", "users", *BAND_COLUMNS]


def attach_admin_codes(rows: DataFrame, parishes: DataFrame, cities: DataFrame, provinces: DataFrame, parish: str = "par_code") -> DataFrame:
    """rows with the codes and names of parish, city and province; a code that is unknown gives nulls."""
    chain = parishes.join(cities, "city_code", "left").join(provinces, "pro_code", "left").drop("city_code", "pro_code")
    return rows.join(chain, parish, "left")


def monthly_line_summary(detail: DataFrame, key: list[str]) -> DataFrame:
    """Lines, users and the 14 band counters for each key. Equal detail rows all count."""
    banded = detail.select(*key, "users", *speed_bands(F.col("dl"), "dl"), *speed_bands(F.col("ul"), "ul"))
    return banded.groupBy(*key).agg(
        F.count("*").alias("lines"), F.sum("users").cast("long").alias("users"), *[F.sum(c).cast("long").alias(c) for c in BAND_COLUMNS]
    )


def count_natural_keys(detail: DataFrame, key: list[str]) -> DataFrame:
    return detail.select(*key).distinct().agg(F.count("*").alias("n_keys"))


def licence_geo_month(rows: DataFrame, also: list[str] = (), measures: list[str] = MEASURES) -> DataFrame:
    """Sums by provider, licence, geography and month; lines and bands split by whether the row was reported or imputed.

    Columns `also`, which follow from the others, are kept: rows that meet by them are then summed where they are.
    """
    key = ["period_id", "month", "provider_id", "licence", "geography_id", *also]
    split = [c for c in measures if c != "users"]
    return rows.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in measures],
        *[F.sum(F.when(F.col("is_reported"), F.col(c))).alias(f"{c}_reported") for c in split],
        *[F.sum(F.when(F.col("is_imputed"), F.col(c))).alias(f"{c}_imputed") for c in split],
        F.bool_or("is_reported").alias("has_reported"), F.bool_or("is_imputed").alias("has_imputed"),
        F.bool_and("is_reported").alias("all_reported"), F.count("*").alias("source_rows"),
    )


FACT_KEY = ["period_id", "month", "provider_id", "geography_id"]


def split_measures(measures: list[str] = MEASURES) -> list[str]:
    base = [c for c in measures if c != "users"]
    return [*measures, *(f"{c}_reported" for c in base), *(f"{c}_imputed" for c in base)]


#: The states of a group of licences.
SINGLE, NO_DATA, SAME, ADDED_UP = "UN_SOLO_PEVA", "TODOS_SIN_DATO", "PEVA_DUPLICADOS_MISMO_VALOR_O_UNICO", "PEVA_VALORES_DIFERENTES_SUMADOS"


def resolution_state(n: Column, with_data: Column, distinct: Column) -> Column:
    return (
        F.when(n == 1, SINGLE).when(with_data == 0, NO_DATA)
        .when(distinct <= 1, SAME).otherwise(ADDED_UP)
    )


def resolve_licences(per_licence: DataFrame, also: list[str] = (), measures: list[str] = MEASURES) -> DataFrame:
    """One row for each provider, geography and month: equal totals of several licences count once, different ones add up.

    The rows are one per licence, so licences are counted as rows. Whether the totals differ is min against max, so
    every aggregate is partial and no value is expanded. Columns `also` are kept as in `licence_geo_month`.
    """
    names = split_measures(measures)
    grouped = per_licence.groupBy(*FACT_KEY, *also).agg(
        F.count("*").alias("n_licences"), F.count("lines").alias("_with"), F.min("lines").alias("_low"), F.max("lines").alias("_high"),
        *[F.max(c).alias(f"_max_{c}") for c in names], *[F.sum(c).alias(f"_sum_{c}") for c in names],
        F.bool_or("has_reported").alias("has_reported"), F.bool_or("has_imputed").alias("has_imputed"),
    )
    distinct = F.when(F.col("_with") == 0, 0).when(F.col("_low") == F.col("_high"), 1).otherwise(2)
    stated = grouped.withColumn("state", resolution_state(F.col("n_licences"), F.col("_with"), distinct))
    add = F.col("state") == ADDED_UP
    return stated.select(
        *FACT_KEY, *also, "n_licences", "state", *[F.when(add, F.col(f"_sum_{c}")).otherwise(F.col(f"_max_{c}")).alias(c) for c in names],
        "has_reported", "has_imputed",
    )


def licence_conflict_audit(per_licence: DataFrame) -> DataFrame:
    """Groups with several licences and several different totals, with the licences as ordered JSON."""
    detail = F.to_json(F.sort_array(F.collect_list(F.struct("licence", "lines"))))
    return (
        per_licence.groupBy("period_id", "provider_id", "geography_id")
        .agg(F.count("*").alias("n_licences"), F.min("lines").alias("_a"), F.max("lines").alias("_b"), detail.alias("detail"))
        .filter("n_licences > 1 and _a <> _b").drop("_a", "_b")
    )


def licence_resolution_audit(fact: DataFrame) -> DataFrame:
    return fact.groupBy("state").agg(
        F.count("*").alias("n_rows"), F.count_distinct("provider_id").alias("n_providers"), F.min("month").alias("first_month"), F.max("month").alias("last_month")
    )


def unpivot_speeds(fact: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each direction and band: band order, name, total, reported and imputed lines."""
    cells = [
        F.struct(F.lit(d).alias("direction"), F.lit(k).alias("band_order"), F.lit(b).alias("band"), F.col(f"{d}_{b}").alias("lines"),
                 F.col(f"{d}_{b}_reported").alias("lines_reported"), F.col(f"{d}_{b}_imputed").alias("lines_imputed"))
        for d in ("dl", "ul") for k, b in enumerate(BAND_NAMES)
    ]
    return fact.select(*keep, F.explode(F.array(*cells)).alias("_c")).select(*keep, "_c.*")


def territory_ids(province: Column, canton: Column, parish: Column) -> Column:
    """The territories of a geography, national first; a level without a code is skipped."""
    level = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}|"), c))
    return F.array_compact(F.array(F.lit(NATIONAL), level("PROVINCIA", province), level("CANTON", canton), level("PARROQUIA", parish)))


def territories_of_id(geography_id: Column) -> Column:
    """The territories of a geography by its id, which holds the codes of all levels; codes have no bar in them."""
    code = lambda k, none: F.nullif(F.split_part(geography_id, F.lit("|"), F.lit(k)), F.lit(none))
    return territory_ids(code(2, "SIN_PROVINCIA"), code(3, "SIN_CANTON"), code(4, "SIN_PARROQUIA"))


def parish_territory(geography_id: Column) -> Column:
    """The territory of a geography's parish, null without one."""
    return F.concat(F.lit("PARROQUIA|"), F.nullif(F.split_part(geography_id, F.lit("|"), F.lit(4)), F.lit("SIN_PARROQUIA")))


def area_id(geography_id: Column) -> Column:
    """The geography without its parish: the id of its province and canton."""
    return F.concat(F.substring_index(geography_id, "|", 3), F.lit("|SIN_PARROQUIA"))


def territory_rollup(fact: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """fact once for each territory of its geography, at most four: by a bridge, which may hold a choice of them, or all by the id alone, without a join."""
    return fact.withColumn("territory_id", F.explode(territories_of_id(F.col("geography_id")))) if bridge is None else fact.join(bridge, "geography_id")


PROVIDER_CELL = ["period_id", "month", "territory_id", "provider_id"]


def provider_sums(fact: DataFrame, key: list[str]) -> DataFrame:
    """What facts add up to for each key; all additive."""
    return fact.groupBy(*key).agg(
        F.sum(F.coalesce("lines", F.lit(0))).alias("lines"), F.count("lines").alias("with_data"), F.sum("users").alias("users"),
        F.sum(F.coalesce("lines_reported", F.lit(0))).alias("lines_reported"), F.sum(F.coalesce("lines_imputed", F.lit(0))).alias("lines_imputed"),
        F.bool_or("has_reported").alias("has_reported"), F.bool_or("has_imputed").alias("has_imputed"),
    )


def provider_territory_month(fact: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """Sums by month, territory and provider: all additive, so partial sums meet the skew of the national territory."""
    return provider_sums(territory_rollup(fact, bridge), PROVIDER_CELL)


def provider_area_month(fact: DataFrame, also: list[str] = ()) -> DataFrame:
    """The sums of `provider_territory_month` for the territories above parishes, from facts with `area` (`area_id`): those of a
    provider's areas first, of which there are few, so that no fact is multiplied. Columns `also` follow from the provider."""
    areas = provider_sums(fact, ["period_id", "month", "provider_id", "area", *also]).withColumn("territory_id", F.explode(territories_of_id(F.col("area"))))
    return areas.groupBy(*PROVIDER_CELL, *also).agg(
        *[F.sum(c).alias(c) for c in ("lines", "with_data", "users", "lines_reported", "lines_imputed")], F.bool_or("has_reported").alias("has_reported"), F.bool_or("has_imputed").alias("has_imputed")
    )


def market_summary(fact: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """Market totals by month and territory, and providers by whether they have lines, none, or no data."""
    return market_totals(provider_territory_month(fact, bridge))


def market_totals(provider_month: DataFrame) -> DataFrame:
    out = provider_month.groupBy("period_id", "month", "territory_id").agg(
        F.sum("lines").alias("lines"), F.sum("users").alias("users"), F.sum("lines_reported").alias("lines_reported"), F.sum("lines_imputed").alias("lines_imputed"),
        F.count("*").alias("n_providers"), F.count_if((F.col("with_data") > 0) & (F.col("lines") > 0)).alias("n_positive"),
        F.count_if((F.col("with_data") > 0) & (F.col("lines") == 0)).alias("n_zero"), F.count_if(F.col("with_data") == 0).alias("n_no_data"),
        F.count_if("has_reported").alias("n_reported"),
    )
    return out.withColumn("pct_imputed", pct(F.col("lines_imputed"), F.col("lines"), 4))


def calendar_offset_join(market: DataFrame, value: str = "lines", key: tuple[str, ...] = ("territory_id",)) -> DataFrame:
    """value of the same market one month and one year before by the calendar (null if that month is missing), with
    differences and percentages. A range window over the month's number finds both in one pass."""
    m = market.withColumn("_m", month_index(F.col("month")))
    at = lambda k: F.max(value).over(Window.partitionBy(*key).orderBy("_m").rangeBetween(-k, -k))
    out = m.withColumn("prev_month", at(1)).withColumn("prev_year", at(12)).drop("_m")
    for name, before in (("month", "prev_month"), ("year", "prev_year")):
        change = F.col(value) - F.col(before)
        out = out.withColumn(f"diff_{name}", change).withColumn(f"pct_{name}", pct(change, F.col(before), 4))
    return out


def speed_market(fact: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """Lines by month, territory, direction and band: wide sums first, of a geography before its territories, unpivoted after the roll-up."""
    bands = [c for c in split_measures() if c.startswith(("dl_", "ul_"))]
    local = fact.groupBy("period_id", "month", "geography_id").agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in bands])
    wide = territory_rollup(local, bridge).groupBy("period_id", "month", "territory_id").agg(*[F.sum(c).alias(c) for c in bands])
    return unpivot_speeds(wide, ["period_id", "month", "territory_id"])


def band_share(speeds: DataFrame) -> DataFrame:
    """speeds with the share of each band in its direction."""
    total = F.sum("lines").over(Window.partitionBy("period_id", "month", "territory_id", "direction"))  # a period is a month: rows stay where they were summed
    return speeds.withColumn("direction_lines", total).withColumn("share_pct", pct(F.col("lines"), F.col("direction_lines"), 4))
