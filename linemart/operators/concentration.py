"""Concentration of reported markets: shares, ranks, HHI, leaders, absent dominant providers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linemart.functions.columns import NATIONAL, line_state, pct, rounded
from linemart.operators.facts import provider_territory_month
from linemart.operators.held import checkpointed

MARKET = ["period_id", "territory_id"]


def reported_market(provider_month: DataFrame) -> DataFrame:
    """The denominator: reported lines only, providers that reported, and all providers."""
    return provider_month.groupBy("period_id", "month", "territory_id").agg(
        F.sum(F.when(F.col("has_reported"), F.col("lines_reported")).otherwise(0)).alias("market_reported"),
        F.count_if("has_reported").alias("n_reported"), F.count("*").alias("n_providers"),
    )


def market_share(fact: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """Share, HHI term, rank and coverage of each provider in each market; null for providers that did not report."""
    return shares_of(provider_territory_month(fact, bridge))


def shares_of(p: DataFrame, also: list[str] = ()) -> DataFrame:
    """The same from sums by month, territory and provider, such as a stored mart holds. Columns `also` are kept."""
    w = Window.partitionBy(*MARKET)
    own = F.when(F.col("has_reported"), F.col("lines_reported"))
    p = p.withColumn("market_reported", F.sum(F.coalesce(own, F.lit(0))).over(w)).withColumn("n_reported", F.count_if("has_reported").over(w)).withColumn("n_providers", F.count("*").over(w))
    return _shares(p, also)


def _shares(p: DataFrame, also: list[str]) -> DataFrame:
    positive = F.col("has_reported") & (F.col("lines_reported") > 0) & (F.col("market_reported") > 0)
    ranked = Window.partitionBy(*MARKET).orderBy(F.when(positive, F.col("lines_reported")).desc_nulls_last(), "provider_id")
    ratio = F.lit(100.0) * F.col("lines_reported") / F.col("market_reported")
    return p.select(
        "period_id", "month", "territory_id", "provider_id", "lines", "lines_reported", "lines_imputed", "has_reported", "has_imputed", "market_reported",
        "n_reported", "n_providers",
        F.when(F.col("has_reported") & (F.col("market_reported") > 0), rounded(ratio, 6)).alias("share_pct"),
        F.when(positive, rounded(ratio * ratio, 4)).alias("hhi_term"),
        F.when(positive, F.row_number().over(ranked)).cast("int").alias("rank"),
        line_state(F.col("has_reported"), F.col("lines_reported")).alias("line_state"),
        pct(F.col("n_reported"), F.col("n_providers"), 4).alias("coverage_pct"), *also,
    ).withColumn("is_leader", F.col("rank") == 1)


def hhi(share: DataFrame) -> DataFrame:
    """HHI, leader, CR2 and CR4 of each market. Aggregates only: the leader is the row of rank one."""
    top = lambda k: rounded(F.sum(F.when(F.col("rank") <= k, F.col("share_pct"))), 4)
    return share.groupBy("period_id", "month", "territory_id").agg(
        rounded(F.sum("hhi_term"), 2).alias("hhi"), F.max(F.when(F.col("rank") == 1, F.col("provider_id"))).alias("leader"),
        rounded(F.max(F.when(F.col("rank") == 1, F.col("share_pct"))), 4).alias("leader_share"), top(2).alias("cr2"), top(4).alias("cr4"),
        F.max("market_reported").alias("market_reported"), F.sum("lines_imputed").alias("lines_imputed"),
        F.max("n_reported").alias("n_reported"), F.max("n_providers").alias("n_providers"), F.max("coverage_pct").alias("coverage_pct"),
    ).withColumn("imputed_pct_of_market", pct(F.col("lines_imputed"), F.col("market_reported"), 4))


def dominant_providers(share: DataFrame, threshold: float = 30.0) -> DataFrame:
    """Providers that ever reached the threshold nationally."""
    return share.filter((F.col("territory_id") == NATIONAL) & (F.col("share_pct") >= threshold)).select("provider_id").distinct()


def dominant_absent_alert(share: DataFrame, threshold: float = 30.0) -> DataFrame:
    """For each national month whether a once dominant provider did not report, and which, from its first report on."""
    national = checkpointed(share.filter(F.col("territory_id") == NATIONAL).select("period_id", "territory_id", "provider_id", "has_reported", "share_pct"))  # few rows, read several times
    reported = national.filter("has_reported").select("period_id", "provider_id")
    first = reported.groupBy("provider_id").agg(F.min("period_id").alias("first_period")).join(dominant_providers(national, threshold), "provider_id", "left_semi")
    due = national.select("period_id").distinct().join(first, F.col("period_id") >= F.col("first_period"))
    seen = due.join(reported.withColumn("reported", F.lit(True)), ["period_id", "provider_id"], "left").withColumn("absent", F.col("reported").isNull())
    return seen.groupBy("period_id").agg(
        F.bool_or("absent").alias("dominant_absent"), F.nullif(F.array_join(F.sort_array(F.collect_set(F.when(F.col("absent"), F.col("provider_id")))), ", "), F.lit("")).alias("absent_providers")
    )


def hhi_with_alert(share: DataFrame, threshold: float = 30.0) -> DataFrame:
    alert = dominant_absent_alert(share, threshold).withColumn("territory_id", F.lit(NATIONAL))
    return hhi(share).join(alert, ["period_id", "territory_id"], "left")


def top_providers(share: DataFrame, territory: str, period: int, k: int = 15, by: str = "share_pct") -> DataFrame:
    return share.filter((F.col("territory_id") == territory) & (F.col("period_id") == period) & F.col(by).isNotNull()).orderBy(F.desc(by), "provider_id").limit(k)


def share_snapshot(share: DataFrame, territory: str, period: int) -> DataFrame:
    return share.filter((F.col("territory_id") == territory) & (F.col("period_id") == period)).orderBy(F.asc_nulls_last("rank"), "provider_id")


def provider_history(share: DataFrame, territory: str, provider: str) -> DataFrame:
    return share.filter((F.col("territory_id") == territory) & (F.col("provider_id") == provider)).orderBy("period_id")


def absence_episodes(share: DataFrame, territory: str = NATIONAL) -> DataFrame:
    """Runs of successive months of a provider without a report, between its first and last rows."""
    rows = share.filter(F.col("territory_id") == territory).select("provider_id", "month", "has_reported")
    w = Window.partitionBy("provider_id").orderBy("month")
    marked = rows.withColumn("_change", F.when(F.col("has_reported") != F.lag("has_reported").over(w), 1).otherwise(0))
    return (
        marked.withColumn("_run", F.sum("_change").over(w)).filter(~F.col("has_reported")).groupBy("provider_id", "_run")
        .agg(F.min("month").alias("from_month"), F.max("month").alias("to_month"), F.count("*").alias("n_months")).drop("_run")
    )
