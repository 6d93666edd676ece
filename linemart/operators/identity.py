"""Who is who: test providers, tax ids of licences, licences of one tax id and their conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linemart.functions.columns import LEGACY_STATES, assign_geography_id, assign_period_id, assign_provider_id, blank_to_null, clean_tax_id, is_test_provider
from linemart.operators.dims import latest_per_key


def valid_source_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("month").isNotNull() & blank_to_null(F.col("licence")).isNotNull())


def exclude_test_providers(rows: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """A row with a test name takes out its tax id and its licence in all months; a null tax id is not excluded by tax id.

    Names are looked for in `reports` if given: what gap filling carries adds none, and reports are fewer.
    """
    marked = (rows if reports is None else reports).filter(is_test_provider(F.col("provider_name")))
    by_tax = marked.select(clean_tax_id(F.col("tax_id_raw")).alias("_t")).filter("_t is not null").distinct()
    by_licence = marked.select(F.trim("licence").alias("_l")).distinct()
    left = rows.join(by_tax, clean_tax_id(F.col("tax_id_raw")) == F.col("_t"), "left_anti")
    return left.join(by_licence, F.trim(left["licence"]) == F.col("_l"), "left_anti")


def test_provider_audit(rows: DataFrame) -> DataFrame:
    """What test names match by themselves: a row for each tax id and licence."""
    return rows.filter(is_test_provider(F.col("provider_name"))).groupBy(clean_tax_id(F.col("tax_id_raw")).alias("tax_id"), "licence").agg(
        F.max("provider_name").alias("provider_name"), F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count("*").alias("n_rows")
    )


def resolve_tax_id(rows: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """rows with tax_id: their own, or the latest that their licence ever had (in `reports` less test providers if given)."""
    own = rows.withColumn("_own", clean_tax_id(F.col("tax_id_raw")))
    told = own if reports is None else exclude_test_providers(reports).withColumn("_own", clean_tax_id(F.col("tax_id_raw")))
    known = latest_per_key(told.filter("_own is not null").select("licence", "month", "_own"), ["licence"], ["month", "_own"], ["_own"])
    known = known.select(F.col("licence").alias("_l"), F.col("_own").alias("_latest"))
    return own.join(known, F.col("licence") == F.col("_l"), "left").withColumn("tax_id", F.coalesce("_own", "_latest")).drop("_own", "_l", "_latest")


def geography(rows: DataFrame) -> Column:
    return assign_geography_id(rows["province_code"], rows["canton_code"], rows["parish_code"], rows["parish_code"])


def known_reporters(reports: DataFrame) -> DataFrame:
    """(licence, own, is_test, latest) for each licence and cleaned tax id that reported: whether a test name takes the pair
    out by tax id or by licence, and the latest tax id that the licence had in pairs that stay. Few rows, made in one pass over the reports."""
    pairs = reports.filter(blank_to_null(F.col("licence")).isNotNull()).groupBy("licence", clean_tax_id(F.col("tax_id_raw")).alias("own")).agg(
        F.max("month").alias("last"), F.bool_or(is_test_provider(F.col("provider_name"))).alias("named")
    )
    by_tax = F.col("own").isNotNull() & F.bool_or("named").over(Window.partitionBy("own"))
    by_licence = F.bool_or("named").over(Window.partitionBy(F.trim("licence")))
    told = pairs.withColumn("is_test", by_tax | by_licence)
    counts = F.col("own").isNotNull() & F.col("last").isNotNull() & ~F.col("is_test")
    latest = F.max(F.when(counts, F.struct("last", "own"))).over(Window.partitionBy("licence"))
    return told.select("licence", "own", "is_test", latest["own"].alias("latest"))


def normalise(rows: DataFrame, reports: DataFrame | None = None, named: DataFrame | None = None) -> DataFrame:
    """Valid rows without test providers, with tax_id, provider_id, geography_id and period_id.

    As `exclude_test_providers` and `resolve_tax_id` say, by one join with the distinct reporters of `reports` (of the rows if not given).
    `named` has columns of providers (one row each): they come with the reporters, so rows are not exchanged by provider for them.
    """
    valid = valid_source_rows(rows).withColumn("_own", clean_tax_id(F.col("tax_id_raw")))
    known = known_reporters(valid if reports is None else reports).select(F.col("licence").alias("_l"), F.col("own").alias("_o"), "is_test", "latest")
    if named is not None:
        provider = assign_provider_id(F.coalesce("_o", "latest"), F.col("_l"))
        known = known.withColumn("_p", provider).join(named.withColumnRenamed("provider_id", "_q"), F.col("_p") == F.col("_q"), "left").drop("_p", "_q")
    joined = valid.join(known, (F.col("licence") == F.col("_l")) & F.col("_own").eqNullSafe(F.col("_o")), "left").filter(~F.coalesce("is_test", F.lit(False)))
    resolved = joined.withColumn("tax_id", F.coalesce("_own", "latest")).drop("_own", "_l", "_o", "is_test", "latest")
    return with_period(resolved.withColumns({"provider_id": assign_provider_id(F.col("tax_id"), F.col("licence")), "geography_id": geography(resolved)}))


def with_period(rows: DataFrame) -> DataFrame:
    return rows.withColumn("period_id", assign_period_id(F.col("month")))


def licence_pairs(licences: DataFrame) -> DataFrame:
    """Pairs of licences (a < b) of one tax id, with both sides' name and status."""
    side = lambda s: licences.select("tax_id", *[F.col(c).alias(f"{c}_{s}") for c in ("licence", "provider_name", "status")])
    return side("a").join(side("b"), "tax_id").filter("licence_a < licence_b")


def pairs_coexist(pairs: DataFrame, months: DataFrame) -> DataFrame:
    """pairs with whether both ever reported in one month; one join over all pairs."""
    m = months.select("licence", "month").distinct()
    a = m.select(F.col("licence").alias("licence_a"), "month")
    b = m.select(F.col("licence").alias("licence_b"), "month")
    met = pairs.select("licence_a", "licence_b").join(a, "licence_a").join(b, ["licence_b", "month"]).select("licence_a", "licence_b").distinct()
    return pairs.join(met.withColumn("_met", F.lit(True)), ["licence_a", "licence_b"], "left").withColumn("coexist", F.coalesce("_met", F.lit(False))).drop("_met")


#: Classes of conflicts between licences of one tax id, what to do about them, and states of their review.
MIGRATED, SAME_HOLDER, OTHER_NAMES = "A_DUPLICADO_MIGRACION_CODIFICACION", "B_SECUENCIA_MISMO_TITULAR", "C_NOMBRES_DISTINTOS_MISMO_RUC"
DISCARD, NO_CONFLICT, BY_HAND = "DESCARTAR_LEGADO", "SIN_CONFLICTO_NO_COEXISTEN", "REVISION_MANUAL"
CONFIRMED, PENDING = "CONFIRMADO_AUTOMATICO", "PENDIENTE"


def _legacy(status: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(status, F.lit("")), r"^\s+|\s+$", "")).isin(LEGACY_STATES)


def classify_conflict(pairs: DataFrame) -> DataFrame:
    """pairs with category, discarded licence, recommended action and first review state."""
    clean = lambda c: F.lower(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"^\s+|\s+$", ""))
    a, b = clean("provider_name_a"), clean("provider_name_b")
    exact = a == b
    holder = exact | a.contains("cancelad") | b.contains("cancelad")
    old_a, old_b = _legacy(F.col("status_a")), _legacy(F.col("status_b"))
    is_a = exact & (old_a != old_b)
    apart = holder & ~F.col("coexist")
    return pairs.withColumns({
        "category": F.when(is_a, MIGRATED).when(holder, SAME_HOLDER).otherwise(OTHER_NAMES),
        "discarded_licence": F.when(is_a, F.when(old_a, F.col("licence_a")).otherwise(F.col("licence_b"))),
        "action": F.when(is_a, DISCARD).when(apart, NO_CONFLICT).otherwise(BY_HAND),
        "review_state": F.when(is_a | apart, CONFIRMED).otherwise(PENDING),
    })


def classification_summary(conflicts: DataFrame, column: str = "category") -> DataFrame:
    return conflicts.groupBy(column).agg(F.count("*").alias("n_rows"))


def excluded_licences(conflicts: DataFrame) -> DataFrame:
    """The discarded side of confirmed conflicts of class A."""
    sure = F.col("category").startswith("A_") & F.col("review_state").startswith("CONFIRMADO")
    return conflicts.filter(sure).select(F.col("discarded_licence").alias("licence")).distinct()


def exclude_confirmed_duplicates(rows: DataFrame, conflicts: DataFrame) -> DataFrame:
    return rows.join(excluded_licences(conflicts), "licence", "left_anti")
