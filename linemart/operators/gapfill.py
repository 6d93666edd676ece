"""Interior gap filling: the last report is carried between reports, never beyond the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linemart.functions.columns import months_between_int, rounded


def gap_spine(reports: DataFrame, key: list[str], month: str = "month", max_months: int | None = None) -> DataFrame:
    """A row for each key and month from its first report to its last (or for `max_months` at most)."""
    spans = reports.groupBy(*key).agg(F.min(month).alias("_first"), F.max(month).alias("_last"))
    last = F.col("_last") if max_months is None else F.least("_last", F.add_months("_first", max_months - 1))
    return spans.select(*key, F.explode(F.sequence("_first", last, F.expr("interval 1 month"))).alias(month))


def spine_to_reports(spine: DataFrame, reports: DataFrame, key: list[str], month: str = "month") -> DataFrame:
    """The spine with each month's report as one struct `snapshot`, null in gaps. Null key parts are equal to each other."""
    values = [c for c in reports.columns if c not in [*key, month]]
    packed = reports.select(*[F.col(c).alias(f"_r_{c}") for c in [*key, month]], F.struct(*values).alias("snapshot"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return spine.join(packed, same & (F.col(month) == F.col(f"_r_{month}")), "left").select(*key, month, "snapshot")


def carried_intervals(reports: DataFrame, key: list[str], month: str = "month", max_months: int | None = None) -> DataFrame:
    """reports with `until`, the last month that each is carried to: that before the next report of its series, or its own.

    One window over the reports is all that is shuffled, and values that nobody reads are pruned. Reports without a month
    give nothing; of reports that repeat a month each stays and one is carried.
    """
    series = Window.partitionBy(*key)
    dated = reports.filter(F.col(month).isNotNull()).withColumn("_end", F.add_months(F.lead(month).over(series.orderBy(month)), -1))
    if max_months is not None:
        dated = dated.withColumn("_limit", F.add_months(F.min(month).over(series), max_months - 1)).filter(F.col(month) <= F.col("_limit"))
        dated = dated.withColumn("_end", F.least("_end", "_limit"))
    return dated.withColumn("until", F.greatest(month, "_end")).select(*reports.columns, "until")


def interior_locf(reports: DataFrame, key: list[str], month: str = "month", max_months: int | None = None) -> DataFrame:
    """All months of each series, with the values of the last report taken as a whole, and is_reported / is_imputed.

    Each report gives its own month and those up to the next one of its series; nothing is joined. A null measure of a
    report stays null and is carried as null. Months are first days.
    """
    values = [c for c in reports.columns if c not in [*key, month]]
    return carried_months(carried_intervals(reports, key, month, max_months), month).select(*key, month, *values, "is_reported", "is_imputed")


def carried_months(carried: DataFrame, month: str = "month") -> DataFrame:
    """A row for each month of `carried_intervals`, which may have had columns added and rows taken out since."""
    filled = carried.withColumn("_m", F.explode(F.sequence(month, "until", F.expr("interval 1 month"))))
    reported = F.col("_m") == F.col(month)
    rest = [c for c in carried.columns if c not in (month, "until")]
    return filled.select(F.col("_m").alias(month), *rest, reported.alias("is_reported"), (~reported).alias("is_imputed"))


def gapfill_forecast(reports: DataFrame, key: list[str], month: str = "month") -> DataFrame:
    """What gap filling will make: series, real rows, rows afterwards."""
    spans = reports.groupBy(*key).agg(F.min(month).alias("a"), F.max(month).alias("b"), F.count("*").alias("n"))
    return spans.agg(
        F.count("*").alias("n_series"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_real"),
        F.coalesce(F.sum(months_between_int(F.col("b"), F.col("a")) + 1), F.lit(0)).alias("n_filled"),
    )


def gapfill_stats(filled: DataFrame) -> DataFrame:
    n, imputed = F.count("*"), F.count_if("is_imputed")
    return filled.agg(n.alias("n_rows"), imputed.alias("n_imputed"), rounded(F.try_divide(imputed * 100.0, n), 4).alias("pct_imputed"))


def key_collisions(reports: DataFrame, key: list[str], month: str = "month") -> DataFrame:
    """Keys and months with more than one row once key texts are trimmed; gap filling needs none."""
    text = {f.name for f in reports.schema.fields if f.dataType.simpleString() == "string"}
    trimmed = reports.select(*[F.trim(c).alias(c) if c in text else F.col(c) for c in key], month)
    return trimmed.groupBy(*key, month).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
