"""Reporting compliance: who never reported, who stopped, how much of what is due was delivered, what changed oddly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linemart.functions.columns import NATIONAL, assign_period_id, compliance_class, has_any_status, months_between_int, pct
from linemart.operators.concentration import dominant_providers
from linemart.operators.held import checkpointed


def last_report_detail(licences: DataFrame, reports: DataFrame) -> DataFrame:
    """Current licences with their last month and its totals; licences that never reported stay with nulls."""
    monthly = reports.groupBy("licence", "month").agg(F.sum("lines").alias("lines"), F.sum("users").alias("users"))
    last = monthly.groupBy("licence").agg(F.max_by(F.struct("month", "lines", "users"), "month").alias("_l"))
    out = licences.join(last, "licence", "left")
    return out.select(*licences.columns, F.col("_l.month").alias("last_month"), F.col("_l.lines").alias("lines"), F.col("_l.users").alias("users"), F.col("_l").isNotNull().alias("has_reports"))


def never_reported(detail: DataFrame, as_of: str, states: list[str] = (), names: list[str] = ()) -> DataFrame:
    """Licences without any report: whether their year of grace has passed (null without a permit date), and their class."""
    out = detail.filter(~F.col("has_reports"))
    if states:
        out = out.filter(has_any_status(F.col("status"), list(states)))
    if names:
        out = out.filter(F.col("provider_name").isin(list(names)))
    past = F.when(F.col("permit_date").isNotNull(), F.lit(as_of).cast("date") >= F.add_months("permit_date", 12))
    return out.select("licence", "provider_name", "status", "permit_date", past.alias("past_grace"), compliance_class(F.col("status")).alias("compliance_class"))


def never_reported_detail(detail: DataFrame, as_of: str, states: list[str] = (), names: list[str] = ()) -> DataFrame:
    return never_reported(detail, as_of, states, names).orderBy(F.asc_nulls_last("permit_date"), "licence")


def stopped_reporting(fact: DataFrame, providers: DataFrame, lag_months: int = 3) -> DataFrame:
    """Providers that reported, with their last month, its lines, all lines ever, and months since, counted to the last
    month less the reporting lag (so it may be negative)."""
    own = checkpointed(fact.groupBy("provider_id", "month").agg(F.sum("lines_reported").alias("lines")))  # few rows, read twice, from all facts
    providers = checkpointed(providers)
    sums = own.join(providers.select("provider_id", "last_reported"), "provider_id").groupBy("provider_id").agg(
        F.coalesce(F.sum(F.when(F.col("month") == F.col("last_reported"), F.col("lines"))), F.lit(0)).alias("lines_last_report"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines_ever"),
    )
    ref = own.agg(F.add_months(F.max("month"), -lag_months).alias("_ref"))  # one row
    out = providers.filter("first_reported is not null").join(sums, "provider_id", "left").join(F.broadcast(ref))
    return out.select(
        "provider_id", "provider_name", "tax_id", "statuses", "is_cancelled", "first_reported", "last_reported",
        F.coalesce("lines_last_report", F.lit(0)).alias("lines_last_report"), F.coalesce("lines_ever", F.lit(0)).alias("lines_ever"),
        months_between_int(F.col("_ref"), F.col("last_reported")).cast("int").alias("months_since"),
    )


def stopped_reporting_detail(stopped: DataFrame, fact: DataFrame, bridge: DataFrame, territory: str, min_months: int, first: str | None = None, last: str | None = None, states: list[str] = (), names: list[str] = ()) -> DataFrame:
    """Stopped providers that ever were in a territory, by months since, with optional filters."""
    there = fact.join(bridge.filter(F.col("territory_id") == territory), "geography_id", "left_semi").select("provider_id").distinct()
    out = stopped.filter(F.col("months_since") >= min_months).join(there, "provider_id", "left_semi")
    if first:
        out = out.filter(F.col("last_reported") >= F.lit(first).cast("date"))
    if last:
        out = out.filter(F.col("last_reported") <= F.lit(last).cast("date"))
    if states:
        out = out.filter(has_any_status(F.col("statuses"), list(states)))
    if names:
        out = out.filter(F.col("provider_name").isin(list(names)))
    return out.orderBy(F.desc("months_since"), "provider_id")


def expected_cells(providers: DataFrame, first: int, last: int) -> DataFrame:
    """A row for each provider and month that it owes a report: from a year after its permit, or from the first month."""
    to_date = lambda p: F.make_date(F.lit(p // 100), F.lit(p % 100), F.lit(1))
    start = F.greatest(F.coalesce(F.trunc(F.add_months("permit_date", 12), "month"), to_date(first)), to_date(first))
    due = providers.select("provider_id", start.alias("_s")).filter(F.col("_s") <= to_date(last))
    return due.select("provider_id", F.explode(F.sequence("_s", to_date(last), F.expr("interval 1 month"))).alias("month")).select("provider_id", assign_period_id(F.col("month")).alias("period_id"))


def delivery_rate(fact: DataFrame, providers: DataFrame, first: int, last: int) -> DataFrame:
    """Providers, cells due and delivered, and the rate (null if nothing is due). The universe is bounded above only."""
    universe = providers.filter(F.col("first_reported").isNotNull() & (assign_period_id(F.col("first_reported")) <= last))
    due = expected_cells(universe, first, last)
    reported = fact.filter("has_reported").select("provider_id", "period_id").distinct().withColumn("_r", F.lit(True))
    cells = due.join(reported, ["provider_id", "period_id"], "left").agg(F.count("*").alias("n_due"), F.count("_r").alias("n_delivered"))
    out = universe.agg(F.count("*").alias("n_providers")).join(cells)
    return out.withColumn("rate_pct", pct(F.col("n_delivered"), F.col("n_due"), 4))


def provider_series(fact: DataFrame) -> DataFrame:
    return fact.groupBy("provider_id", "period_id", "month").agg(F.sum(F.coalesce("lines_reported", F.lit(0))).alias("lines"), F.bool_or("has_reported").alias("reported"))


def anomalous_variation(fact: DataFrame, first: int, last: int, threshold: float = 30.0) -> DataFrame:
    """Changes of a provider's reported lines against its row before, both really reported, of at least the threshold in percent."""
    s = provider_series(fact.filter(F.col("period_id").between(first, last)))
    w = Window.partitionBy("provider_id").orderBy("period_id")
    s = s.withColumn("lines_before", F.lag("lines").over(w)).withColumn("_rb", F.lag("reported").over(w))
    odd = s.filter("reported and _rb and lines_before > 0").withColumn("difference", F.col("lines") - F.col("lines_before"))
    odd = odd.withColumn("variation_pct", pct(F.col("difference"), F.col("lines_before"), 2))
    return odd.filter(F.abs(F.lit(100.0) * F.col("difference") / F.col("lines_before")) >= threshold).select("provider_id", "period_id", "month", "lines_before", "lines", "difference", "variation_pct")


def top_variations(variations: DataFrame, k: int = 15) -> DataFrame:
    return variations.orderBy(F.abs("variation_pct").desc(), "provider_id", "period_id").limit(k)


def churn_history(rows: DataFrame, end: str, months: int = 12, lines: str = "lines") -> DataFrame:
    """By month, providers whose row is inactive and whose row before was active; a provider without a row is not counted.

    The window has months + 1 months, and its first one counts zero."""
    last = F.lit(end).cast("date")
    own = rows.filter((F.col("month") >= F.add_months(last, -months)) & (F.col("month") <= last))
    s = own.groupBy("provider_id", "period_id").agg((F.bool_or("has_reported") & (F.sum(F.coalesce(lines, F.lit(0))) > 0)).alias("active"))
    w = Window.partitionBy("provider_id").orderBy("period_id")
    return s.withColumn("_before", F.lag("active").over(w)).groupBy("period_id").agg(F.count_if(F.col("_before") & ~F.col("active")).alias("churn"))


def churned_providers(rows: DataFrame, period: int, before: int) -> DataFrame:
    """Providers with lines in the month before and none, or no row, in this one; carried lines count."""
    active = lambda p: rows.filter((F.col("period_id") == p) & (F.col("lines") > 0)).select("provider_id").distinct()
    return active(before).join(active(period), "provider_id", "left_anti")


def providers_in_range(fact: DataFrame, bridge: DataFrame, territory: str, first: int, last: int) -> DataFrame:
    own = fact.filter(F.col("period_id").between(first, last) & F.col("has_reported")).join(bridge.filter(F.col("territory_id") == territory), "geography_id", "left_semi")
    return own.agg(F.count_distinct("provider_id").alias("n_providers"))


def noncompliance_universe(never: DataFrame, stopped: DataFrame, min_lines: int = 100000, min_months: int = 3) -> DataFrame:
    """Active licences that never reported, and providers that stopped and matter."""
    a = never.agg(F.count_if(F.col("compliance_class") == "activo_sin_reportar").alias("n_never"))
    relevant = (F.col("statuses") == "Opera Normalmente") & ~F.col("is_cancelled") & (F.col("lines_ever") > min_lines) & (F.col("months_since") >= min_months)
    b = stopped.agg(F.count_if(relevant).alias("n_stopped"))
    return a.join(b).withColumn("n_total", F.col("n_never") + F.col("n_stopped"))


def geographic_dependency(fact: DataFrame, share: DataFrame, geographies: DataFrame, period: int, threshold: float = 30.0) -> DataFrame:
    """By province: lines reported now, lines of absent dominant providers when they last reported, and the part that is missing."""
    whole = checkpointed(share.filter(F.col("territory_id") == NATIONAL).select("period_id", "territory_id", "provider_id", "has_reported", "share_pct"))
    national = whole.filter("has_reported")
    absent = dominant_providers(whole, threshold).join(national.filter(F.col("period_id") == period), "provider_id", "left_anti")
    last = national.filter(F.col("period_id") < period).join(absent, "provider_id", "left_semi").groupBy("provider_id").agg(F.max("period_id").alias("period_id"))
    then = (F.col("period_id") == F.col("_p")) | (F.col("period_id") == period) & F.col("has_reported")
    asked = fact.select("provider_id", "period_id", "geography_id", "has_reported", "lines_reported").join(last.withColumnRenamed("period_id", "_p"), "provider_id", "left").filter(then)
    named = asked.join(geographies.select("geography_id", "province_name"), "geography_id")
    sums = named.groupBy("province_name").agg(
        F.sum(F.when((F.col("period_id") == period) & F.col("has_reported"), F.col("lines_reported"))).alias("now"),
        F.sum(F.when(F.col("period_id") == F.col("_p"), F.col("lines_reported"))).alias("gone"),
    )
    out = sums.select("province_name", F.coalesce("now", F.lit(0)).alias("lines_now"), F.coalesce("gone", F.lit(0)).alias("lines_absent"))
    return out.filter("lines_absent > 0").withColumn("pct_understated", F.coalesce(pct(F.col("lines_absent"), F.col("lines_now") + F.col("lines_absent"), 1), F.lit(0.0)))


def month_diff(series: DataFrame, value: str, order: str, key: list[str]) -> DataFrame:
    """Difference and percentage against the row before (not the calendar month) of the same key; null where that is zero or missing."""
    if not key:
        raise ValueError("month_diff needs a key: without one the whole series would be sorted in one task")
    w = Window.partitionBy(*key).orderBy(order)
    before = F.lag(value).over(w)
    return series.withColumn("diff", F.col(value) - before).withColumn("pct_change", pct(F.col(value) - before, before, 4))


def months_stopped_histogram(stopped: DataFrame, bins: int = 30) -> DataFrame:
    bounds = stopped.agg(F.min("months_since").alias("_a"), F.max("months_since").alias("_b"))
    width = F.greatest(F.col("_b") - F.col("_a"), F.lit(1)) / F.lit(float(bins))
    spot = F.least(F.floor((F.col("months_since") - F.col("_a")) / width), F.lit(bins - 1))
    return stopped.join(F.broadcast(bounds)).select(spot.cast("int").alias("bin")).groupBy("bin").agg(F.count("*").alias("n_providers"))


def count_by_category(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n_rows"))


def top_categories(rows: DataFrame, column: str, k: int = 15) -> DataFrame:
    return count_by_category(rows, column).orderBy(F.desc("n_rows"), column).limit(k)


def evolution_filtered(fact: DataFrame) -> DataFrame:
    """Month totals of an already filtered fact: lines, reported lines, providers that reported."""
    return fact.groupBy("period_id").agg(
        F.sum(F.coalesce("lines", F.lit(0))).alias("lines"), F.sum(F.coalesce("lines_reported", F.lit(0))).alias("lines_reported"),
        F.count_distinct(F.when(F.col("has_reported"), F.col("provider_id"))).alias("n_reporting"),
    )


