"""Integrity checks of the mart: each returns the rows that break it, and none is expected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linemart.functions.columns import BAND_COLUMNS, BAND_NAMES


def offending_rows(fact: DataFrame, share: DataFrame, hhi: DataFrame, market: DataFrame) -> dict[str, DataFrame]:
    """The rows that break each of the eight checks, with all their columns."""
    total = lambda d: sum((F.coalesce(F.col(f"{d}_{b}"), F.lit(0)) for b in BAND_NAMES), F.lit(0))
    lines = F.coalesce("lines", F.lit(0))
    bad_split = lambda c: F.coalesce(c, F.lit(0)) != F.coalesce(f"{c}_reported", F.lit(0)) + F.coalesce(f"{c}_imputed", F.lit(0))
    sums = share.filter("hhi_term is not null").groupBy("period_id", "territory_id").agg(F.sum("share_pct").alias("s")).filter(F.abs(F.col("s") - 100) > 0.01)
    return {
        "shares_sum_to_100": sums,
        "hhi_in_range": hhi.filter("hhi < 0 or hhi > 10000.01"),
        "provider_counts_add_up": market.filter("n_positive + n_zero + n_no_data <> n_providers"),
        "bands_sum_to_lines": fact.filter((total("dl") != lines) | (total("ul") != lines)),
        "reported_and_imputed_sum": fact.filter(reduce(lambda a, b: a | b, [bad_split(c) for c in ["lines", *BAND_COLUMNS]])),
        "no_share_without_report": share.filter("not has_reported and share_pct is not null"),
        "coverage_in_range": share.filter("coverage_pct < 0 or coverage_pct > 100"),
        "cr2_cr4_ordered": hhi.filter("cr2 > cr4 + 0.001 or cr4 > 100.001"),
    }


KEYS = ["period_id", "territory_id", "provider_id", "geography_id"]


def mart_check_rows(fact: DataFrame, share: DataFrame, hhi: DataFrame, market: DataFrame) -> DataFrame:
    """(check, period_id, territory_id, provider_id, geography_id, detail) of each row that breaks a check; detail is the whole row as JSON."""
    out = []
    for name, df in offending_rows(fact, share, hhi, market).items():
        key = [F.col(k).cast("string").alias(k) if k in df.columns else F.lit(None).cast("string").alias(k) for k in KEYS]
        out.append(df.select(F.lit(name).alias("check"), *key, F.to_json(F.struct(*sorted(df.columns))).alias("detail")))
    return reduce(DataFrame.union, out)


def mart_checks(fact: DataFrame, share: DataFrame, hhi: DataFrame, market: DataFrame) -> DataFrame:
    """(check, n_bad) of the eight checks."""
    counted = [df.agg(F.lit(name).alias("check"), F.count("*").alias("n_bad")) for name, df in offending_rows(fact, share, hhi, market).items()]
    return reduce(DataFrame.union, counted)
