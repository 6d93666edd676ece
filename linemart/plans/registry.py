"""Registered queries by name, each with SQL of the same result where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linemart.functions import columns as C
from linemart.operators import boundaries as boundary
from linemart.operators import compliance, concentration, dims, facts, gapfill, identity, nodes, quality, scd
from linemart.operators.held import new_folder
from linemart.plans import oracle
from linemart.plans.adapters import ATTRIBUTES, NATURAL_KEY, SERIES, Mart
from linemart.plans.oracle import PID, commas, permit_date, same, sql
from linemart.sources.mart import StoredMart

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Parameters of the registered queries.
PROVINCE, FIRST, LAST, AT = "PROVINCIA|01", 199601, 200012, 199906
AS_OF, THRESHOLD = "2001-06-15", 3.0
PERIOD_COLUMNS = "period_id, month"


def add(name: str, build: Callable[[Mart], DataFrame], text: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Mart(spark, sf_dir))
    if text is not None:
        ORACLE[name] = text


def plain(name: str, build: Callable[[Mart], DataFrame], text: str) -> None:
    """A query whose SQL needs no layer."""
    add(name, build, text)


def expr(name: str, rows: Callable[[Mart], DataFrame], column: Callable[[], Column], table: str, id_col: str, text: str) -> None:
    """A column expression (made when a session is there) over a whole table."""
    add(name, lambda m: rows(m).select(F.col(id_col).alias("id"), column().alias("value")), f"SELECT {id_col} AS id, {text} AS value FROM {table}")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# Column expressions

T = lambda name: (lambda m: m.table(name))
SUPPLIERS = lambda m: m.table("supplier").selectExpr("s_suppkey", "'RUC ' || CAST(s_suppkey AS STRING) || '-x' AS dirty", "CASE WHEN s_suppkey % 3 = 0 THEN '  ' WHEN s_suppkey % 3 = 1 THEN NULL ELSE '  a ' END AS blank")
DIRTY = "(SELECT s_suppkey, 'RUC ' || CAST(s_suppkey AS STRING) || '-x' AS dirty, CASE WHEN s_suppkey % 3 = 0 THEN '  ' WHEN s_suppkey % 3 = 1 THEN NULL ELSE '  a ' END AS blank FROM supplier)"
expr("clean_tax_id", SUPPLIERS, lambda: C.clean_tax_id(F.col("dirty")), DIRTY, "s_suppkey", "nullif(regexp_replace(coalesce(dirty, ''), '[^0-9]', '', 'g'), '')")
expr("blank_to_null", SUPPLIERS, lambda: C.blank_to_null(F.col("blank")), DIRTY, "s_suppkey", "nullif(trim(blank), '')")
expr("normalise_label", SUPPLIERS, lambda: C.normalise_label(F.col("blank")), DIRTY, "s_suppkey", "upper(trim(blank))")
expr("provider_label", SUPPLIERS, lambda: C.provider_label(F.col("blank"), F.lit(None).cast("string"), F.col("dirty")), DIRTY, "s_suppkey", "coalesce(nullif(trim(blank), ''), dirty)")
LICENCES = "licences"
add("is_test_provider", lambda m: m.licences.select("licence", C.is_test_provider(F.col("provider_name")).alias("is_test")), sql("SELECT licence, provider_name ILIKE '%prueba%' AS is_test FROM licences"))
add("parse_permit_date", lambda m: m.licences.select("licence", C.parse_permit_date(F.col("permit_text")).alias("permit_date")), sql(f"SELECT licence, {permit_date('permit_text')} AS permit_date FROM licences"))
add("is_cancelled", lambda m: m.licences.select("licence", C.is_cancelled(F.col("status")).alias("is_cancelled")), sql("SELECT licence, status ILIKE '%cancelac%' AS is_cancelled FROM licences"))
add("filter_by_status", lambda m: m.licences.filter(C.has_any_status(F.col("status"), ["normal", "nuevo"])).select("licence", "status"), sql("SELECT licence, status FROM licences WHERE status ILIKE '%normal%' OR status ILIKE '%nuevo%'"))
add("filter_by_names", lambda m: m.licences.filter(F.col("provider_name").isin("Grupo 3", "Grupo 9")).select("licence", "provider_name"), sql("SELECT licence, provider_name FROM licences WHERE provider_name IN ('Grupo 3', 'Grupo 9')"))
expr("assign_period_id", T("orders"), lambda: C.assign_period_id(F.col("o_orderdate")), "orders", "o_orderkey", PID.format("o_orderdate"))
expr("period_id_to_date", T("orders"), lambda: C.period_id_to_date(C.assign_period_id(F.col("o_orderdate"))), "orders", "o_orderkey", "CAST(date_trunc('month', o_orderdate) AS DATE)")
expr("months_between_int", T("orders"), lambda: C.months_between_int(F.col("o_orderdate"), F.lit("1995-11-30").cast("date")), "orders", "o_orderkey", "((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 11)::INT")
expr("obligation_start", T("orders"), lambda: C.obligation_start(F.col("o_orderdate").cast("date")), "orders", "o_orderkey", PID.format("(o_orderdate::DATE + INTERVAL 1 YEAR)"))
expr("signed_log", T("customer"), lambda: F.round(C.signed_log(F.col("c_acctbal")), 6), "customer", "c_custkey", "round(sign(c_acctbal) * log10(1 + abs(c_acctbal)), 6)")
expr("pct", T("orders"), lambda: C.pct(F.col("o_custkey"), F.col("o_orderkey") % 7, 4), "orders", "o_orderkey", "round(100.0 * o_custkey::DOUBLE / nullif(o_orderkey % 7, 0), 4)")
expr("row_hash", lambda m: m.table("supplier").selectExpr("s_suppkey", "s_name", "CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_nationkey END AS nation"), lambda: C.row_hash(["s_suppkey", "s_name", "nation"]), "supplier", "s_suppkey", "md5(CAST(s_suppkey AS VARCHAR) || '|' || coalesce(s_name, 'NULL') || '|' || CASE WHEN s_suppkey % 4 = 0 THEN 'NULL' ELSE CAST(s_nationkey AS VARCHAR) END)")
add("broadband_totals", lambda m: m.summary.groupBy("licence").agg(F.sum(C.broadband_totals("dl")[0]).alias("broadband"), F.sum(C.broadband_totals("dl")[1]).alias("ultra")), sql(
    f"SELECT licence, sum({' + '.join('dl_' + b for b in C.BROADBAND)})::BIGINT AS broadband, sum({' + '.join('dl_' + b for b in C.ULTRA)})::BIGINT AS ultra FROM summary GROUP BY licence"))
add("speed_bands", lambda m: m.detail.select("month", *C.speed_bands(F.col("dl"), "dl")).groupBy("month").agg(*[F.sum(f"dl_{b}").alias(f"dl_{b}") for b in C.BAND_NAMES]), sql(
    f"SELECT month, {', '.join(f'sum(dl_{b})::BIGINT AS dl_{b}' for b in C.BAND_NAMES)} FROM summary GROUP BY month"))

# Ingest

plain("attach_admin_codes", lambda m: facts.attach_admin_codes(
    m.table("customer").select("c_custkey", (F.col("c_nationkey") + F.when(F.col("c_custkey") % 9 == 0, 100).otherwise(0)).alias("par_code")),
    m.table("nation").select(F.col("n_nationkey").alias("par_code"), F.col("n_name").alias("par_name"), F.col("n_regionkey").alias("city_code")),
    m.table("region").select(F.col("r_regionkey").alias("city_code"), F.col("r_name").alias("city_name"), (F.col("r_regionkey") % 2).alias("pro_code")),
    m.table("region").filter("r_regionkey < 2").select(F.col("r_regionkey").alias("pro_code"), F.concat(F.lit("P "), "r_name").alias("pro_name"))),
    "SELECT c_custkey, par_code, par_name, city_name, pro_name FROM (SELECT c_custkey, c_nationkey + CASE WHEN c_custkey % 9 = 0 THEN 100 ELSE 0 END AS par_code FROM customer) LEFT JOIN (SELECT n_nationkey AS par_code, n_name AS par_name, r.r_name AS city_name, 'P ' || p.r_name AS pro_name FROM nation JOIN region r ON n_regionkey = r.r_regionkey JOIN region p ON p.r_regionkey = r.r_regionkey % 2) USING (par_code)")
SUMMARY = f"{commas([*NATURAL_KEY, *ATTRIBUTES])}, lines, users, {commas(C.BAND_COLUMNS)}"
add("monthly_line_summary", lambda m: m.summary, sql(f"SELECT {SUMMARY} FROM summary"))
add("count_natural_keys", lambda m: facts.count_natural_keys(m.detail, NATURAL_KEY), sql(f"SELECT count(*) AS n_keys FROM (SELECT DISTINCT {commas(NATURAL_KEY)} FROM detail)"))
add("unmatched_codes_count", lambda m: scd.unmatched_codes_count(m.summary, "province_code"), sql("SELECT count(*) FILTER (province_code IS NULL) AS n_unmatched, count(*) AS n_rows FROM summary"))

HASHED = [*NATURAL_KEY, "lines", "users"]


def stored(m: Mart, changed: bool = False) -> DataFrame:
    """The summary with row hashes; as a later source has it: some measures other, some rows gone, some new."""
    s = m.summary.select(*HASHED)
    if changed:
        n = F.col("licence").cast("long")
        s = s.filter(~((n % 10 == 1) & (F.month("month") == 5))).withColumn("users", F.when((n % 10 == 2) & (F.month("month") == 6), F.col("users") + 1).otherwise(F.col("users")))
        s = s.unionByName(s.filter((n % 10 == 3) & (F.month("month") == 7)).withColumn("licence", F.concat(F.lit("N"), "licence")))
    return s.withColumn("row_hash", C.row_hash(HASHED))


HASH = "md5(" + " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in HASHED) + ")"
KEYS = commas(NATURAL_KEY)
STORED = (
    f", before AS (SELECT {commas(HASHED)}, {HASH} AS row_hash FROM summary), later0 AS (SELECT {KEYS}, lines, CASE WHEN CAST(licence AS BIGINT) % 10 = 2 AND month(month) = 6 THEN users + 1 ELSE users END AS users FROM summary WHERE NOT (CAST(licence AS BIGINT) % 10 = 1 AND month(month) = 5)), "
    f"later1 AS (SELECT * FROM later0 UNION ALL SELECT 'N' || licence, {commas(NATURAL_KEY[1:])}, lines, users FROM later0 WHERE CAST(licence AS BIGINT) % 10 = 3 AND month(month) = 7), later AS (SELECT *, {HASH} AS row_hash FROM later1)"
)


def with_stored(final: str) -> str:
    head, _, _ = sql("\x00").rpartition("\n\x00")
    return head + STORED + "\n" + final


add("upsert_summary", lambda m: scd.upsert(stored(m), stored(m, True), NATURAL_KEY), with_stored(f"SELECT * FROM before b WHERE NOT EXISTS (SELECT 1 FROM later l WHERE {same('b', 'l', NATURAL_KEY)}) UNION ALL SELECT * FROM later"))
SNAPSHOT = "to_json({{" + ", ".join(f"'{c}': {{row}}.{c}" for c in [*HASHED, "row_hash"]) + "}})::VARCHAR"
add("row_snapshot_json", lambda m: stored(m).select(*NATURAL_KEY, C.row_snapshot([*HASHED, "row_hash"]).alias("snapshot")), with_stored(f"SELECT {commas(NATURAL_KEY)}, {SNAPSHOT.format(row='before')} AS snapshot FROM before"))
add("correction_history", lambda m: scd.correction_history(stored(m), stored(m, True), NATURAL_KEY), with_stored(f"SELECT {commas(NATURAL_KEY, 'b.{}')}, b.row_hash AS old_hash, l.row_hash AS new_hash, {SNAPSHOT.format(row='b')} AS before_image FROM before b JOIN later l ON {same('b', 'l', NATURAL_KEY)} WHERE b.row_hash <> l.row_hash"))
add("detect_change", lambda m: scd.detect_change(stored(m), stored(m, True), NATURAL_KEY, ["lines", "users"]), with_stored(f"SELECT {commas(NATURAL_KEY, 'b.{}')} FROM before b JOIN later l ON {same('b', 'l', NATURAL_KEY)} WHERE NOT (b.lines IS NOT DISTINCT FROM l.lines AND b.users IS NOT DISTINCT FROM l.users)"))
RECONCILED = f"SELECT {', '.join(f'CASE WHEN b.row_hash IS NOT NULL THEN b.{c} ELSE l.{c} END AS {c}' for c in NATURAL_KEY)}, CASE WHEN b.row_hash IS NULL THEN 'only_stored' WHEN l.row_hash IS NULL THEN 'only_source' ELSE 'different' END AS finding FROM before b FULL JOIN later l ON {same('b', 'l', NATURAL_KEY)} WHERE b.row_hash IS DISTINCT FROM l.row_hash"
add("reconcile_hashes", lambda m: scd.reconcile_hashes(stored(m), stored(m, True), NATURAL_KEY), with_stored(RECONCILED))
add("sync_admin_codes", lambda m: scd.sync_admin_codes(m.summary.select("licence", "parish_code", "month", "province_code", "canton_code", "lines"), m.table("nation").select((F.concat(F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("01"))).alias("parish_code"), F.lit("99").alias("province_code"), F.col("n_name").alias("canton_code")), "parish_code", ["province_code", "canton_code"]),
    sql("SELECT licence, s.parish_code, month, CASE WHEN n.p IS NOT NULL THEN '99' ELSE province_code END AS province_code, CASE WHEN n.p IS NOT NULL THEN n_name ELSE canton_code END AS canton_code, lines FROM summary s LEFT JOIN (SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '01' AS p, n_name FROM nation) n ON n.p = s.parish_code"))

# Slowly changing dimensions: customers, and the same with edits, deletions and additions

CUSTOMER = ["c_custkey", "segment", "balance"]
SNAP2 = "SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_mktsegment || ' 2' ELSE c_mktsegment END AS segment, CAST(floor(c_acctbal) AS BIGINT) + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS balance FROM {t} WHERE c_custkey % 13 <> 0 UNION ALL SELECT c_custkey + 1000000000, c_mktsegment, 0 FROM {t} WHERE c_custkey % 50 = 0"


def versions(m: Mart) -> DataFrame:
    c = m.table("customer")
    first = c.selectExpr("c_custkey", "c_mktsegment AS segment", "CAST(floor(c_acctbal) AS BIGINT) AS balance")
    begun = first.selectExpr("*", f"TIMESTAMP '{scd.BEGINNING}' AS valid_from", "CAST(NULL AS TIMESTAMP) AS valid_to", "true AS is_current")
    second = c.filter("c_custkey % 13 <> 0").selectExpr("c_custkey", "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_mktsegment || ' 2' ELSE c_mktsegment END AS segment", "CAST(floor(c_acctbal) AS BIGINT) + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS balance")
    new = c.filter("c_custkey % 50 = 0").selectExpr("c_custkey + 1000000000 AS c_custkey", "c_mktsegment AS segment", "CAST(0 AS BIGINT) AS balance")
    return scd.scd2_apply(begun, second.unionByName(new), ["c_custkey"], ["segment"], ["balance"], "1998-03-15 10:00:00")


VERSIONS = (
    "WITH a AS (SELECT c_custkey, c_mktsegment AS segment, CAST(floor(c_acctbal) AS BIGINT) AS balance FROM customer), b AS (" + SNAP2.format(t="customer") + "), "
    "versions AS (SELECT a.c_custkey, a.segment, CASE WHEN b.c_custkey IS NOT NULL AND a.segment IS NOT DISTINCT FROM b.segment THEN b.balance ELSE a.balance END AS balance, TIMESTAMP '1900-01-01' AS valid_from, "
    "CASE WHEN b.c_custkey IS NOT NULL AND a.segment IS DISTINCT FROM b.segment THEN TIMESTAMP '1998-03-15 10:00:00' END AS valid_to, NOT (b.c_custkey IS NOT NULL AND a.segment IS DISTINCT FROM b.segment) AS is_current FROM a LEFT JOIN b USING (c_custkey) "
    "UNION ALL SELECT b.c_custkey, b.segment, b.balance, CASE WHEN a.c_custkey IS NULL THEN TIMESTAMP '1900-01-01' ELSE TIMESTAMP '1998-03-15 10:00:00' END, NULL, true FROM b LEFT JOIN a USING (c_custkey) WHERE a.c_custkey IS NULL OR a.segment IS DISTINCT FROM b.segment) "
)
plain("scd2_apply", versions, VERSIONS + "SELECT * FROM versions")
plain("current_view", lambda m: scd.current_view(versions(m)), VERSIONS + "SELECT * FROM versions WHERE is_current")
plain("current_version_violations", lambda m: scd.current_version_violations(versions(m).unionByName(versions(m).filter("c_custkey % 100 = 0")), ["c_custkey"]), VERSIONS + "SELECT c_custkey, count(*) AS n_current FROM (SELECT * FROM versions UNION ALL SELECT * FROM versions WHERE c_custkey % 100 = 0) WHERE is_current GROUP BY c_custkey HAVING count(*) > 1")
plain("version_diagnostics", lambda m: scd.version_diagnostics(versions(m), ["c_custkey"]), VERSIONS + "SELECT count(*) AS n_versions, count(DISTINCT c_custkey) AS n_keys, round(count(*)::DOUBLE / count(DISTINCT c_custkey), 4) AS versions_per_key FROM versions")
ORDER_MONTHS = lambda m: m.table("orders").selectExpr("o_orderkey", "o_custkey AS c_custkey", "CAST(date_trunc('month', o_orderdate) AS DATE) AS month")
ASOF = "SELECT o_orderkey, c_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, segment, balance, is_current, valid_from, valid_to FROM orders JOIN versions ON o_custkey = c_custkey AND CAST(date_trunc('month', o_orderdate) AS DATE) >= CAST(valid_from AS DATE) AND (valid_to IS NULL OR CAST(date_trunc('month', o_orderdate) AS DATE) < CAST(valid_to AS DATE))"
plain("asof_dimension_join", lambda m: scd.asof_dimension_join(ORDER_MONTHS(m), versions(m), ["c_custkey"]), VERSIONS + ASOF)
plain("view_duplicates", lambda m: scd.view_duplicates(scd.asof_dimension_join(ORDER_MONTHS(m), versions(m), ["c_custkey"]), ["c_custkey", "month"]), VERSIONS + f"SELECT c_custkey, month, count(*) AS n_rows FROM ({ASOF}) GROUP BY ALL HAVING count(*) > 1")
HISTORY = lambda m: m.table("orders").select("o_custkey", F.col("o_orderstatus").alias("status"), "o_orderkey", F.timestamp_seconds(F.col("o_orderkey") * 3600).alias("valid_from"), F.timestamp_seconds(F.col("o_orderkey") * 3600 + 3599).alias("valid_to"), (F.col("o_orderkey") % 2 == 0).alias("is_current"))
plain("collapse_versions", lambda m: scd.collapse_versions(HISTORY(m), ["o_custkey"], ["status"]),
    "WITH h AS (SELECT o_custkey, o_orderstatus AS status, o_orderkey, lag(o_orderstatus) OVER w IS NOT DISTINCT FROM o_orderstatus AND row_number() OVER w > 1 AS again FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)), r AS (SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS run FROM h) "
    "SELECT o_custkey, min_by(status, o_orderkey) AS status, min(o_orderkey) AS o_orderkey, make_timestamp(min(o_orderkey) * 3600000000) AS valid_from, make_timestamp((max(o_orderkey) * 3600 + 3599) * 1000000) AS valid_to, max(o_orderkey) % 2 = 0 AS is_current FROM r GROUP BY o_custkey, run")
add("certify_load", lambda m: scd.certify_load(stored(m), stored(m, True), versions(m), stored(m), NATURAL_KEY, ["c_custkey"]), with_stored(
    f"SELECT (SELECT count(*) FROM before) AS n_source, (SELECT count(*) FROM later) AS n_stored, count(*) FILTER (finding = 'only_source') AS n_only_source, count(*) FILTER (finding = 'only_stored') AS n_only_stored, count(*) FILTER (finding = 'different') AS n_different, 0::BIGINT AS n_version_violations, 0::BIGINT AS n_view_duplicates, false AS certified FROM ({RECONCILED})"))

# Identity

add("valid_source_rows", lambda m: identity.valid_source_rows(m.detail.withColumn("licence", F.when(F.col("users") == 1, " ").otherwise(F.col("licence")))).groupBy("licence").agg(F.count("*").alias("n_rows")), sql("SELECT licence, count(*) AS n_rows FROM detail WHERE users <> 1 GROUP BY licence"))
add("exclude_test_providers", lambda m: identity.exclude_test_providers(m.consolidated).groupBy("licence").agg(F.count("*").alias("n_rows")), sql("SELECT licence, count(*) AS n_rows FROM real_rows GROUP BY licence"))
add("test_provider_audit", lambda m: identity.test_provider_audit(m.consolidated), sql(f"SELECT {oracle.DIGITS.format('tax_id_raw')} AS tax_id, licence, max(provider_name) AS provider_name, min(month) AS first_month, max(month) AS last_month, count(*) AS n_rows FROM test_rows GROUP BY ALL"))
add("resolve_tax_id", lambda m: identity.resolve_tax_id(identity.exclude_test_providers(m.consolidated)).groupBy("licence", "tax_id").agg(F.count("*").alias("n_rows")), sql("SELECT licence, tax_id, count(*) AS n_rows FROM taxed GROUP BY licence, tax_id"))
add("assign_provider_id", lambda m: m.normalised.groupBy("provider_id", "licence").agg(F.count("*").alias("n_rows")), sql("SELECT provider_id, licence, count(*) AS n_rows FROM normalised GROUP BY ALL"))
add("assign_geography_id", lambda m: m.normalised.groupBy("geography_id", "parish_code").agg(F.count("*").alias("n_rows")), sql("SELECT geography_id, parish_code, count(*) AS n_rows FROM normalised GROUP BY ALL"))
PAIR = "tax_id, licence_a, provider_name_a, status_a, licence_b, provider_name_b, status_b"
add("licence_pairs", lambda m: identity.licence_pairs(m.licences), sql(f"SELECT {PAIR} FROM pairs"))
coexisting = lambda m: identity.pairs_coexist(identity.licence_pairs(m.licences), m.detail)
conflicts = lambda m: identity.classify_conflict(coexisting(m))
FAST = sql("\x00").replace("EXISTS (SELECT 1 FROM detail x JOIN detail y ON x.month = y.month WHERE x.licence = p.licence_a AND y.licence = p.licence_b) AS coexist", "(p.licence_a, p.licence_b) IN (SELECT (x.licence, y.licence) FROM (SELECT DISTINCT licence, month FROM detail) x JOIN (SELECT DISTINCT licence, month FROM detail) y ON x.month = y.month) AS coexist")
paired = lambda final: FAST.replace("\x00", final)
add("pairs_coexist", coexisting, paired(f"SELECT {PAIR}, coexist FROM coexisting"))
add("classify_conflict", conflicts, paired(f"SELECT {PAIR}, coexist, category, discarded_licence, action, review_state FROM conflicts"))
add("classification_summary", lambda m: identity.classification_summary(conflicts(m)), paired("SELECT category, count(*) AS n_rows FROM conflicts GROUP BY category"))
add("excluded_licences", lambda m: identity.excluded_licences(conflicts(m)), paired("SELECT DISTINCT discarded_licence AS licence FROM conflicts WHERE category LIKE 'A_%' AND review_state LIKE 'CONFIRMADO%'"))
add("exclude_confirmed_duplicates", lambda m: identity.exclude_confirmed_duplicates(m.summary, conflicts(m)).groupBy("licence").agg(F.count("*").alias("n_rows")), paired("SELECT licence, count(*) AS n_rows FROM summary WHERE licence NOT IN (SELECT discarded_licence FROM conflicts WHERE category LIKE 'A_%' AND review_state LIKE 'CONFIRMADO%') GROUP BY licence"))
plain("merge_preserving_review", lambda m: scd.merge_preserving_review(
    m.table("customer").filter("c_custkey % 3 <> 0").selectExpr("c_custkey", "c_mktsegment AS finding", "CASE WHEN c_custkey % 2 = 0 THEN 'DECIDED' ELSE 'PENDIENTE' END AS review_state"),
    m.table("customer").filter("c_custkey % 4 <> 0").selectExpr("c_custkey", "c_name AS finding", "'PENDIENTE' AS review_state"), ["c_custkey"], ["finding"], ["review_state"]),
    "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_name ELSE c_mktsegment END AS finding, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 2 = 0 THEN 'DECIDED' ELSE 'PENDIENTE' END AS review_state FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 4 <> 0")

# Gap filling

FILLED = f"{commas(SERIES)}, month, {commas(ATTRIBUTES)}, {commas(facts.MEASURES)}, is_reported, is_imputed"
add("gap_spine", lambda m: gapfill.gap_spine(m.summary, SERIES), sql(f"SELECT {commas(SERIES)}, month FROM spine"))
add("spine_to_reports", lambda m: gapfill.spine_to_reports(gapfill.gap_spine(m.summary, SERIES), m.summary, SERIES).select(*SERIES, "month", F.col("snapshot.lines").alias("lines")), sql(f"SELECT {commas(SERIES, 'p.{}')}, p.month, lines FROM spine p LEFT JOIN summary s ON {same('p', 's', NATURAL_KEY)}"))
add("interior_locf", lambda m: m.consolidated, sql(f"SELECT {FILLED} FROM consolidated"))
add("gapfill_forecast", lambda m: gapfill.gapfill_forecast(m.summary, SERIES), sql("SELECT count(*) AS n_series, (SELECT count(*) FROM summary) AS n_real, sum((year(b) - year(a)) * 12 + month(b) - month(a) + 1)::BIGINT AS n_filled FROM spans"))
add("gapfill_stats", lambda m: gapfill.gapfill_stats(m.consolidated), sql("SELECT count(*) AS n_rows, count(*) FILTER (is_imputed) AS n_imputed, round(count(*) FILTER (is_imputed) * 100.0::DOUBLE / count(*), 4) AS pct_imputed FROM consolidated"))
add("key_collisions", lambda m: gapfill.key_collisions(m.detail, SERIES), sql(f"SELECT {commas(SERIES)}, month, count(*) AS n_rows FROM detail GROUP BY ALL HAVING count(*) > 1"))

# Facts

add("licence_geo_month", lambda m: m.licence_geo, sql("SELECT * FROM licence_geo"))
add("licence_conflict_audit", lambda m: facts.licence_conflict_audit(m.licence_geo).drop("detail"), sql("SELECT period_id, provider_id, geography_id, count(*) AS n_licences FROM licence_geo GROUP BY ALL HAVING count(*) > 1 AND count(DISTINCT lines) > 1"))
add("licence_detail_json", lambda m: facts.licence_conflict_audit(m.licence_geo).select("period_id", "provider_id", "geography_id", "detail"), sql("SELECT period_id, provider_id, geography_id, '[' || string_agg('{\"licence\":\"' || licence || '\",\"lines\":' || lines || '}', ',' ORDER BY licence) || ']' AS detail FROM licence_geo GROUP BY ALL HAVING count(*) > 1 AND count(DISTINCT lines) > 1"))
add("resolve_licences", lambda m: m.fact, sql("SELECT * FROM fact"))
add("licence_resolution_audit", lambda m: facts.licence_resolution_audit(m.fact), sql("SELECT state, count(*) AS n_rows, count(DISTINCT provider_id) AS n_providers, min(month) AS first_month, max(month) AS last_month FROM fact GROUP BY state"))
add("unpivot_speeds", lambda m: facts.unpivot_speeds(m.fact, ["period_id", "provider_id", "geography_id"]).groupBy("period_id", "direction", "band_order", "band").agg(F.sum("lines").alias("lines"), F.sum("lines_reported").alias("lines_reported"), F.sum("lines_imputed").alias("lines_imputed")), sql(
    "SELECT period_id, d.direction, d.band_order, d.band, sum(d.l)::BIGINT AS lines, sum(d.r)::BIGINT AS lines_reported, sum(d.i)::BIGINT AS lines_imputed FROM (SELECT period_id, unnest([" + ", ".join(f"{{'direction': '{d}', 'band_order': {k}, 'band': '{b}', 'l': {d}_{b}, 'r': {d}_{b}_reported, 'i': {d}_{b}_imputed}}" for d in ("dl", "ul") for k, b in enumerate(C.BAND_NAMES)) + "]) AS d FROM fact) GROUP BY ALL"))
add("territory_rollup", lambda m: facts.provider_territory_month(m.fact, m.bridge), sql("SELECT * FROM ptm"))
add("market_summary", lambda m: m.market, sql("SELECT * FROM market"))
offset = ", ".join(f"lines - {p} AS diff_{n}, round(100.0 * (lines - {p})::DOUBLE / nullif({p}, 0), 4) AS pct_{n}" for n, p in (("month", "prev_month"), ("year", "prev_year")))
add("calendar_offset_join", lambda m: facts.calendar_offset_join(m.market.select("period_id", "month", "territory_id", "lines")), sql(f"SELECT *, {offset} FROM (SELECT a.period_id, a.month, a.territory_id, a.lines, b.lines AS prev_month, c.lines AS prev_year FROM market a LEFT JOIN market b ON b.territory_id = a.territory_id AND b.month = a.month - INTERVAL 1 MONTH LEFT JOIN market c ON c.territory_id = a.territory_id AND c.month = a.month - INTERVAL 1 YEAR)"))
add("speed_market", lambda m: facts.speed_market(m.local_fact), sql("SELECT * FROM speed_wide"))
add("band_share", lambda m: m.speeds, sql("SELECT * FROM speeds"))
add("month_diff", lambda m: compliance.month_diff(m.market.select("territory_id", "period_id", "lines"), "lines", "period_id", ["territory_id"]).filter(F.col("territory_id") == C.NATIONAL).drop("territory_id"), sql("SELECT period_id, lines, lines - lag(lines) OVER w AS diff, round(100.0 * (lines - lag(lines) OVER w)::DOUBLE / nullif(lag(lines) OVER w, 0), 4) AS pct_change FROM market WHERE territory_id = 'NACIONAL|ECUADOR' WINDOW w AS (ORDER BY period_id)"))

# Dimensions and views

add("latest_per_key", lambda m: dims.latest_per_key(m.summary.select("licence", "month", "parish_code", "lines"), ["licence", "parish_code"], ["month", "lines"], ["month", "lines"]), sql("SELECT licence, parish_code, month, lines FROM summary QUALIFY row_number() OVER (PARTITION BY licence, parish_code ORDER BY month DESC, lines DESC) = 1"))
add("period_dimension", lambda m: m.periods, sql("SELECT * FROM periods"))
add("provider_dimension", lambda m: m.providers, sql("SELECT * FROM providers"))
add("provider_licence_bridge", lambda m: dims.provider_licence_bridge(m.normalised), sql("SELECT provider_id, licence, min(month) AS first_month, max(month) AS last_month FROM normalised GROUP BY ALL"))
add("geography_dimension", lambda m: m.geographies, sql("SELECT * FROM geographies"))
add("territory_dimension", lambda m: m.territories, sql("SELECT * FROM territories"))
add("geography_territory_bridge", lambda m: m.bridge, sql("SELECT * FROM bridge"))
VIEW = "year_month, year_quarter, level, name"
add("vw_evolution", lambda m: dims.star_view(m.market, m.periods, m.territories), sql(f"SELECT k.*, {VIEW} FROM market k JOIN periods p USING (period_id) JOIN territories t USING (territory_id)").replace("k.*,", "k.period_id, k.month, k.territory_id, lines, users, lines_reported, lines_imputed, n_providers, n_positive, n_zero, n_no_data, n_reported, pct_imputed,"))
add("vw_speed", lambda m: dims.star_view(m.speeds, m.periods, m.territories), sql(f"SELECT k.*, {VIEW} FROM speeds k JOIN (SELECT period_id, year_month, year_quarter FROM periods) USING (period_id) JOIN territories USING (territory_id)").replace("SELECT k.*,", "SELECT period_id, k.month, territory_id, direction, band_order, band, lines, lines_reported, lines_imputed, direction_lines, share_pct,"))
add("vw_share", lambda m: m.share_view.select("period_id", "territory_id", "provider_id", "provider_name", "year_month", "level", "name", "share_pct", "rank"), sql("SELECT s.period_id, s.territory_id, s.provider_id, provider_name, year_month, level, name, share_pct, rank FROM share s JOIN periods p ON p.period_id = s.period_id JOIN territories t ON t.territory_id = s.territory_id JOIN providers v ON v.provider_id = s.provider_id"))
add("vw_hhi", lambda m: dims.star_view(m.hhi, m.periods, m.territories, m.providers, "leader").select("period_id", "territory_id", "hhi", "leader", "provider_name", "year_month", "level", "name"), sql("SELECT h.period_id, h.territory_id, hhi, leader, provider_name, year_month, level, name FROM hhi h JOIN periods p ON p.period_id = h.period_id JOIN territories t ON t.territory_id = h.territory_id LEFT JOIN providers v ON v.provider_id = leader"))
add("evolution", lambda m: dims.evolution(m.market, PROVINCE, FIRST, LAST), sql(f"SELECT * FROM market WHERE territory_id = '{PROVINCE}' AND period_id BETWEEN {FIRST} AND {LAST}"))
add("resolve_period", lambda m: dims.resolve_period(m.periods, "2030-05-05"), sql("SELECT max(period_id) AS period_id FROM periods"))
add("latest_month_row", lambda m: dims.latest_month_row(m.market, PROVINCE), sql(f"SELECT max(period_id) AS last_period, max(period_id) FILTER (lines_reported > 0) AS last_reported_period FROM market WHERE territory_id = '{PROVINCE}'"))
add("facet_values", lambda m: dims.facet_values(m.providers, "statuses", split=True), sql("SELECT DISTINCT trim(unnest(string_split(statuses, ','))) AS value FROM providers"))
add("faceted_territories", lambda m: dims.faceted_territories(m.geographies, "canton", province=["01", "02"]), sql("SELECT canton_code AS code, min(canton_name) AS name FROM geographies WHERE province_code IN ('01', '02') GROUP BY canton_code"))
add("territories_of_providers", lambda m: dims.territories_of_providers(facts.territory_rollup(m.found.select("provider_id", "geography_id").distinct()).withColumn("has_reported", F.lit(True))), sql("SELECT DISTINCT territory_id FROM share WHERE has_reported"))
SELECTED = "(SELECT f.* FROM fact f JOIN geographies g USING (geography_id) WHERE province_code IN ('01', '03') AND (canton_code NOT LIKE '%05'))"
chosen = lambda m: m.fact_of(dims.territory_filter(m.resolved, m.geographies.filter(~F.col("canton_code").endswith("05")), provinces=["01", "03"]))
add("filter_by_territories", lambda m: chosen(m).groupBy("period_id", "geography_id").agg(F.sum("lines").alias("lines")), sql(f"SELECT period_id, geography_id, sum(lines)::BIGINT AS lines FROM {SELECTED} GROUP BY ALL"))
add("evolution_filtered", lambda m: compliance.evolution_filtered(chosen(m)), sql(f"SELECT period_id, sum(coalesce(lines, 0))::BIGINT AS lines, sum(coalesce(lines_reported, 0))::BIGINT AS lines_reported, count(DISTINCT CASE WHEN has_reported THEN provider_id END) AS n_reporting FROM {SELECTED} GROUP BY period_id"))

# Concentration

add("reported_market", lambda m: concentration.reported_market(facts.provider_territory_month(m.fact)), sql("SELECT * FROM reported_market"))
add("market_share", lambda m: m.share, sql("SELECT * FROM share"))
add("provider_rank", lambda m: m.share.filter("rank is not null").select("period_id", "territory_id", "provider_id", "rank", "is_leader"), sql("SELECT period_id, territory_id, provider_id, rank, is_leader FROM share WHERE rank IS NOT NULL"))
add("line_state", lambda m: m.share.groupBy("territory_id", "line_state").agg(F.count("*").alias("n_rows")), sql("SELECT territory_id, line_state, count(*) AS n_rows FROM share GROUP BY ALL"))
add("hhi", lambda m: m.hhi, sql("SELECT * FROM hhi"))
ALERT = "SELECT d.period_id, bool_or(r.provider_id IS NULL) AS dominant_absent, string_agg(DISTINCT d.provider_id, ', ' ORDER BY d.provider_id) FILTER (r.provider_id IS NULL) AS absent_providers FROM (SELECT p.period_id, f.provider_id FROM (SELECT DISTINCT period_id FROM share WHERE territory_id = 'NACIONAL|ECUADOR') p JOIN (SELECT provider_id, min(period_id) AS first FROM share WHERE territory_id = 'NACIONAL|ECUADOR' AND has_reported AND provider_id IN (SELECT provider_id FROM dominant) GROUP BY provider_id) f ON p.period_id >= f.first) d LEFT JOIN (SELECT period_id, provider_id FROM share WHERE territory_id = 'NACIONAL|ECUADOR' AND has_reported) r ON r.period_id = d.period_id AND r.provider_id = d.provider_id GROUP BY d.period_id"
add("dominant_absent_alert", lambda m: concentration.dominant_absent_alert(m.share, THRESHOLD), sql(ALERT))
add("top_providers", lambda m: concentration.top_providers(m.share, PROVINCE, AT).select("provider_id", "share_pct", "hhi_term"), sql(f"SELECT provider_id, share_pct, hhi_term FROM share WHERE territory_id = '{PROVINCE}' AND period_id = {AT} AND share_pct IS NOT NULL ORDER BY share_pct DESC, provider_id LIMIT 15"))
add("share_snapshot", lambda m: concentration.share_snapshot(m.share, PROVINCE, AT), sql(f"SELECT * FROM share WHERE territory_id = '{PROVINCE}' AND period_id = {AT}"))
add("provider_history", lambda m: concentration.provider_history(m.share, C.NATIONAL, "RUC|0000000009001"), sql("SELECT * FROM share WHERE territory_id = 'NACIONAL|ECUADOR' AND provider_id = 'RUC|0000000009001'"))
add("hhi_series", lambda m: m.hhi.filter(F.col("territory_id") == PROVINCE).select("period_id", "hhi", "cr2", "cr4"), sql(f"SELECT period_id, hhi, cr2, cr4 FROM hhi WHERE territory_id = '{PROVINCE}'"))
add("absence_episodes", lambda m: concentration.absence_episodes(m.share), sql("WITH RECURSIVE x AS (SELECT 1)".replace("WITH RECURSIVE x AS (SELECT 1)", "") + "SELECT provider_id, min(month) AS from_month, max(month) AS to_month, count(*) AS n_months FROM (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY month) - row_number() OVER (PARTITION BY provider_id, has_reported ORDER BY month) AS run FROM share WHERE territory_id = 'NACIONAL|ECUADOR') WHERE NOT has_reported GROUP BY provider_id, run"))
FILTERED = sql("\x00").replace("FROM fact JOIN bridge USING (geography_id) GROUP BY period_id, month, territory_id, provider_id", f"FROM {SELECTED} JOIN (SELECT geography_id, 'NACIONAL|ECUADOR' AS territory_id FROM geographies) USING (geography_id) GROUP BY period_id, month, territory_id, provider_id")
nation_only = lambda m: m.bridge.filter(F.col("territory_id") == C.NATIONAL)
add("share_filtered", lambda m: concentration.market_share(chosen(m), nation_only(m)), FILTERED.replace("\x00", "SELECT * FROM share"))
add("hhi_filtered", lambda m: concentration.hhi(concentration.market_share(chosen(m), nation_only(m))), FILTERED.replace("\x00", "SELECT * FROM hhi"))
add("speed_filtered", lambda m: facts.band_share(facts.speed_market(chosen(m), nation_only(m))), sql("\x00").replace("] ) AS d FROM fact)", "").replace("]) AS d FROM fact) JOIN bridge USING (geography_id) GROUP BY ALL", f"]) AS d FROM {SELECTED}) JOIN (SELECT geography_id, 'NACIONAL|ECUADOR' AS territory_id FROM geographies) USING (geography_id) GROUP BY ALL").replace("\x00", "SELECT * FROM speeds"))

# Compliance

last_detail = lambda m: compliance.last_report_detail(m.licences.withColumn("permit_date", C.parse_permit_date(F.col("permit_text"))), m.summary)
never = lambda m: compliance.never_reported(last_detail(m), AS_OF)
stopped = lambda m: compliance.stopped_reporting(m.fact, m.providers)
add("last_report_detail", last_detail, sql("SELECT * FROM last_detail"))
add("never_reported", never, sql("SELECT * FROM never"))
add("never_reported_detail", lambda m: compliance.never_reported_detail(last_detail(m), AS_OF, states=["normal"]), sql("SELECT * FROM never WHERE status ILIKE '%normal%'"))
add("stopped_reporting", stopped, sql("SELECT * FROM stopped"))
add("stopped_reporting_detail", lambda m: compliance.stopped_reporting_detail(stopped(m), m.fact, m.bridge, PROVINCE, 1), sql(f"SELECT * FROM stopped WHERE months_since >= 1 AND provider_id IN (SELECT provider_id FROM fact JOIN bridge USING (geography_id) WHERE territory_id = '{PROVINCE}')"))
DUE = f"SELECT provider_id, p.period_id FROM providers v JOIN periods p ON p.period_id BETWEEN {FIRST} AND {LAST} AND (permit_date IS NULL OR p.period_id >= {PID.format('(permit_date + INTERVAL 1 YEAR)')})"
add("expected_cells", lambda m: compliance.expected_cells(m.providers, FIRST, LAST), sql(DUE))
add("delivery_rate", lambda m: compliance.delivery_rate(m.fact, m.providers, FIRST, LAST), sql(
    f"SELECT *, round(100.0 * n_delivered::DOUBLE / nullif(n_due, 0), 4) AS rate_pct FROM (SELECT (SELECT count(*) FROM providers WHERE {PID.format('first_reported')} <= {LAST}) AS n_providers, count(*) AS n_due, count(r.period_id) AS n_delivered FROM ({DUE} WHERE {PID.format('first_reported')} <= {LAST}) d LEFT JOIN (SELECT DISTINCT provider_id, period_id FROM fact WHERE has_reported) r USING (provider_id, period_id))"))
SERIES_SQL = f"(SELECT *, lag(lines) OVER w AS lines_before, lag(reported) OVER w AS rb FROM (SELECT provider_id, period_id, month, sum(coalesce(lines_reported, 0))::BIGINT AS lines, bool_or(has_reported) AS reported FROM fact WHERE period_id BETWEEN {FIRST} AND {LAST} GROUP BY ALL) WINDOW w AS (PARTITION BY provider_id ORDER BY period_id))"
ODD = f"SELECT provider_id, period_id, month, lines_before, lines, lines - lines_before AS difference, round(100.0 * (lines - lines_before)::DOUBLE / lines_before, 2) AS variation_pct FROM {SERIES_SQL} WHERE reported AND rb AND lines_before > 0 AND abs(100.0::DOUBLE * (lines - lines_before) / lines_before) >= 30"
odd = lambda m: compliance.anomalous_variation(m.fact, FIRST, LAST)
add("anomalous_variation", odd, sql(ODD))
add("top_variations", lambda m: compliance.top_variations(odd(m)), sql(f"SELECT * FROM ({ODD}) ORDER BY abs(variation_pct) DESC, provider_id, period_id LIMIT 15"))
CHURN = "SELECT period_id, count(*) FILTER (b AND NOT active) AS churn FROM (SELECT *, lag(active) OVER (PARTITION BY provider_id ORDER BY period_id) AS b FROM (SELECT provider_id, period_id, bool_or(has_reported) AND sum(coalesce({c}, 0)) > 0 AS active FROM {t} WHERE month BETWEEN DATE '1998-12-01' AND DATE '1999-12-01' GROUP BY ALL)) GROUP BY period_id"
add("churn_history", lambda m: compliance.churn_history(m.share.filter(F.col("territory_id") == PROVINCE), "1999-12-01"), sql(CHURN.format(c="lines", t=f"(SELECT * FROM share WHERE territory_id = '{PROVINCE}')")))
add("churn_history_filtered", lambda m: compliance.churn_history(chosen(m), "1999-12-01", lines="lines_reported"), sql(CHURN.format(c="lines_reported", t=SELECTED)))
add("churned_providers", lambda m: compliance.churned_providers(m.share.filter(F.col("territory_id") == PROVINCE), 200006, 200005), sql(f"SELECT provider_id FROM share WHERE territory_id = '{PROVINCE}' AND period_id = 200005 AND lines > 0 EXCEPT SELECT provider_id FROM share WHERE territory_id = '{PROVINCE}' AND period_id = 200006 AND lines > 0"))
add("providers_in_range", lambda m: compliance.providers_in_range(m.fact, m.bridge, PROVINCE, FIRST, LAST), sql(f"SELECT count(DISTINCT provider_id) AS n_providers FROM fact JOIN bridge USING (geography_id) WHERE territory_id = '{PROVINCE}' AND period_id BETWEEN {FIRST} AND {LAST} AND has_reported"))
add("noncompliance_universe", lambda m: compliance.noncompliance_universe(never(m), stopped(m), 10, 3), sql("SELECT *, n_never + n_stopped AS n_total FROM (SELECT (SELECT count(*) FROM never WHERE compliance_class = 'activo_sin_reportar') AS n_never, (SELECT count(*) FROM stopped WHERE statuses = 'Opera Normalmente' AND NOT is_cancelled AND lines_ever > 10 AND months_since >= 3) AS n_stopped)"))
add("geographic_dependency", lambda m: compliance.geographic_dependency(m.fact, m.share, m.geographies, 200106, 0.5), sql(
    "SELECT *, coalesce(round(100.0 * lines_absent::DOUBLE / nullif(lines_now + lines_absent, 0), 1), 0.0) AS pct_understated FROM (SELECT coalesce(t.province_name, h.province_name) AS province_name, coalesce(now, 0) AS lines_now, coalesce(gone, 0) AS lines_absent FROM "
    "(SELECT province_name, sum(lines_reported)::BIGINT AS now FROM fact JOIN geographies USING (geography_id) WHERE period_id = 200106 AND has_reported GROUP BY province_name) t FULL JOIN "
    "(SELECT province_name, sum(lines_reported)::BIGINT AS gone FROM fact f JOIN geographies USING (geography_id) JOIN (SELECT provider_id, max(period_id) AS period_id FROM share WHERE territory_id = 'NACIONAL|ECUADOR' AND has_reported AND period_id < 200106 AND provider_id IN (SELECT provider_id FROM share WHERE territory_id = 'NACIONAL|ECUADOR' AND share_pct >= 0.5) AND provider_id NOT IN (SELECT provider_id FROM share WHERE territory_id = 'NACIONAL|ECUADOR' AND period_id = 200106 AND has_reported) GROUP BY provider_id) l ON l.provider_id = f.provider_id AND l.period_id = f.period_id GROUP BY province_name) h ON t.province_name IS NOT DISTINCT FROM h.province_name) WHERE lines_absent > 0"))
add("months_stopped_histogram", lambda m: compliance.months_stopped_histogram(stopped(m)), sql("SELECT least(floor((months_since - a) / (greatest(b - a, 1) / 30.0::DOUBLE)), 29)::INT AS bin, count(*) AS n_providers FROM stopped, (SELECT min(months_since) AS a, max(months_since) AS b FROM stopped) GROUP BY bin"))
add("count_by_category", lambda m: compliance.count_by_category(never(m), "compliance_class"), sql("SELECT compliance_class, count(*) AS n_rows FROM never GROUP BY compliance_class"))
add("top_provinces", lambda m: compliance.top_categories(m.geographies, "province_name"), sql("SELECT province_name, count(*) AS n_rows FROM geographies GROUP BY province_name ORDER BY n_rows DESC, province_name LIMIT 15"))
CHECKS = {
    "shares_sum_to_100": "SELECT period_id FROM share WHERE hhi_term IS NOT NULL GROUP BY period_id, territory_id HAVING abs(sum(share_pct) - 100) > 0.01",
    "hhi_in_range": "SELECT period_id FROM hhi WHERE hhi < 0 OR hhi > 10000.01",
    "provider_counts_add_up": "SELECT period_id FROM market WHERE n_positive + n_zero + n_no_data <> n_providers",
    "bands_sum_to_lines": "SELECT period_id FROM fact WHERE " + " OR ".join("(" + " + ".join(f"coalesce({d}_{b}, 0)" for b in C.BAND_NAMES) + ") <> coalesce(lines, 0)" for d in ("dl", "ul")),
    "reported_and_imputed_sum": "SELECT period_id FROM fact WHERE " + " OR ".join(f"coalesce({c}, 0) <> coalesce({c}_reported, 0) + coalesce({c}_imputed, 0)" for c in ["lines", *C.BAND_COLUMNS]),
    "no_share_without_report": "SELECT period_id FROM share WHERE NOT has_reported AND share_pct IS NOT NULL",
    "coverage_in_range": "SELECT period_id FROM share WHERE coverage_pct < 0 OR coverage_pct > 100",
    "cr2_cr4_ordered": "SELECT period_id FROM hhi WHERE cr2 > cr4 + 0.001 OR cr4 > 100.001",
}
add("mart_checks", lambda m: quality.mart_checks(*m.checked), sql(" UNION ALL ".join(f"SELECT '{name}' AS \"check\", count(*) AS n_bad FROM ({text})" for name, text in CHECKS.items())))
add(
    "mart_check_rows",
    lambda m: quality.mart_check_rows(*m.checked).select("check", "period_id", "territory_id", "provider_id", "geography_id"),
    sql(" UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", period_id::VARCHAR AS period_id, {'territory_id' if from_ != 'fact' else 'NULL::VARCHAR'} AS territory_id, {'provider_id' if from_ in ('fact', 'share') and name != 'shares_sum_to_100' else 'NULL::VARCHAR'} AS provider_id, {'geography_id' if from_ == 'fact' else 'NULL::VARCHAR'} AS geography_id FROM ({text.replace('SELECT period_id', 'SELECT *' if name != 'shares_sum_to_100' else 'SELECT period_id, territory_id')})"
        for name, text in CHECKS.items() for from_ in [text.split(" FROM ")[1].split(" ")[0]]
    )),
)

# Nodes

LAT = "CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '0' WHEN c_custkey % 23 = 0 THEN '1° 75'' N' WHEN c_custkey % 29 = 0 THEN 'abc' WHEN c_custkey * 7 % 50 < 40 THEN CAST((40 - c_custkey * 7 % 50) DIV 10 AS STRING) || '°' || CAST((40 - c_custkey * 7 % 50) % 10 * 6 AS STRING) || ''' S' ELSE '0 ' || CAST((c_custkey * 7 % 50 - 40) * 6 AS STRING) || ' N' END"
LON = "CAST((800 - c_custkey % 50) DIV 10 AS STRING) || ' ' || CAST((800 - c_custkey % 50) % 10 * 6 AS STRING) || ',0 ' || CASE WHEN c_custkey % 31 = 0 THEN 'E' WHEN c_custkey % 3 = 0 THEN 'O' WHEN c_custkey % 3 = 1 THEN 'W' ELSE '' END"
NODE = {
    "node": "c_custkey", "licence": "lpad(CAST(c_custkey % 100 + 1 AS STRING), 6, '0')", "node_type": "CASE WHEN c_custkey % 2 = 0 THEN ' Nodo ' ELSE 'RADIO' END",
    "province_code": "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE lpad(CAST(c_nationkey % 5 AS STRING), 2, '0') END", "canton_code": "lpad(CAST(c_nationkey AS STRING), 4, '0')",
    "parish_code": "lpad(CAST(c_nationkey AS STRING), 6, '0')", "reported_canton": "CASE WHEN c_custkey % 6 = 0 THEN ' ' ELSE lpad(CAST(c_nationkey AS STRING), 4, '0') END",
    "latitude_text": LAT, "longitude_text": LON,
}
#: Corners of the parish shapes by number modulo 4: a square, an L, a square with a hole, and two strips. Coordinates are parts of the cell's side.
SHAPES = [
    [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]],
    [[[(0, 0), (1, 0), (1, 0.45), (0.45, 0.45), (0.45, 1), (0, 1), (0, 0)]]],
    [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25)]]],
    [[[(0, 0), (0.35, 0), (0.35, 1), (0, 1), (0, 0)]], [[(0.65, 0), (1, 0), (1, 1), (0.65, 1), (0.65, 0)]]],
]
IN_SHAPE = (
    "CASE k % 4 WHEN 1 THEN NOT (longitude > x + CAST(0.45 AS DOUBLE) * s AND latitude > y + CAST(0.45 AS DOUBLE) * s) WHEN 2 THEN NOT (longitude > x + CAST(0.25 AS DOUBLE) * s AND longitude < x + CAST(0.75 AS DOUBLE) * s "
    "AND latitude > y + CAST(0.25 AS DOUBLE) * s AND latitude < y + CAST(0.75 AS DOUBLE) * s) WHEN 3 THEN NOT (longitude > x + CAST(0.35 AS DOUBLE) * s AND longitude < x + CAST(0.65 AS DOUBLE) * s) ELSE true END"
)
CORNERS, AREA = "CASE k % 4 WHEN 0 THEN 5 WHEN 1 THEN 7 ELSE 10 END", "CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 0.6975 WHEN 2 THEN 0.75 ELSE 0.7 END"
#: Parishes are cells of a square grid over the nodes' box, one for each supplier: k of n; the grid is as wide as the next power of two.
WIDE = "CASE " + " ".join(f"WHEN n <= {4**q} THEN {2**q}" for q in range(16)) + " END"
CELL = {"i": "k % w", "j": "k DIV w", "s": "CAST(5 AS DOUBLE) / w", "x": "-80 + k % w * (CAST(5 AS DOUBLE) / w)", "y": "-4 + k DIV w * (CAST(5 AS DOUBLE) / w)"}
_code = lambda e, n: f"lpad(CAST({e} AS STRING), greatest({n}, length(CAST({e} AS STRING))::INT), '0')"
CODES = {
    "parish_code": _code("k", 6), "parish_name": "'P' || CAST(k AS STRING)", "canton_code": _code("(j DIV 2 * w + i DIV 2)", 4), "canton_name": "'K' || CAST(j DIV 2 * w + i DIV 2 AS STRING)",
    "province_code": _code("(j * 4 DIV w * 4 + i * 4 DIV w)", 2), "province_name": "'R' || CAST(j * 4 DIV w * 4 + i * 4 DIV w AS STRING)",
}
#: A vertex on the lower border of parish k for each of its customers, of which there are cn in all.
EDGE = "CAST(0.35 AS DOUBLE) * (CAST(5 AS DOUBLE) / w) * (c_custkey DIV n + CAST(0.5 AS DOUBLE)) / (cn DIV n + 2)"


def _shape_text(shape: list) -> str:
    """SQL of a shape's GeoJSON; after the first corner come the points `edge` of the lower border."""
    point = lambda p: f"concat('[', x + CAST({p[0]} AS DOUBLE) * s, ',', y + CAST({p[1]} AS DOUBLE) * s, ']')"
    polygons = []
    for n, rings in enumerate(shape):
        made = []
        for k, ring in enumerate(rings):
            corners = [point(c) for c in ring]
            if n == 0 and k == 0:
                corners.insert(1, "CASE WHEN size(edge) > 0 THEN array_join(transform(edge, e -> concat('[', x + e, ',', CAST(y AS DOUBLE), ']')), ',') END")
            made.append("concat('[', concat_ws(',', " + ", ".join(corners) + "), ']')")
        polygons.append("concat('[', concat_ws(',', " + ", ".join(made) + "), ']')")
    if len(polygons) == 1:
        return "concat('{\"type\": \"Polygon\", \"coordinates\": ', " + polygons[0] + ", '}')"
    return "concat('{\"type\": \"MultiPolygon\", \"coordinates\": [', concat_ws(',', " + ", ".join(polygons) + "), ']}')"


def node_rows(m: Mart) -> DataFrame:
    return m.table("customer").selectExpr(*[f"{e} AS {n}" for n, e in NODE.items()])


def sized(m: Mart) -> DataFrame:
    """One row: the numbers of suppliers and customers, and the width of the grid."""
    counted = m.table("supplier").agg(F.count("*").alias("n")).crossJoin(m.table("customer").agg(F.count("*").alias("cn")))
    return counted.selectExpr("n", "cn", f"{WIDE} AS w")


def boundaries(m: Mart) -> DataFrame:
    """A parish for each supplier, in four shapes, with a vertex on its lower border for each of its customers: both follow the tables."""
    cells = m.table("supplier").selectExpr("s_suppkey AS k").crossJoin(F.broadcast(sized(m))).selectExpr("*", *[f"{e} AS {c}" for c, e in CELL.items()])
    places = m.table("customer").select("c_custkey").crossJoin(F.broadcast(sized(m))).selectExpr("c_custkey % n AS k", f"{EDGE} AS e")
    edges = places.groupBy("k").agg(F.sort_array(F.collect_set("e")).alias("edge"))
    cells = cells.join(edges, "k", "left").withColumn("edge", F.coalesce("edge", F.array().cast("array<double>")))
    text = "CASE k % 4 " + " ".join(f"WHEN {k} THEN {_shape_text(shape)}" for k, shape in enumerate(SHAPES)) + " END AS geometry"
    rows = cells.selectExpr("k", *[f"{e} AS {c}" for c, e in CODES.items()], text)
    return rows.withColumn("polygons", nodes.parse_geojson(F.col("geometry")))


def coasts(m: Mart) -> DataFrame:
    """A square for each supplier whose lower border has a tooth for each customer: every third stands out, the others are flatter than a tolerance of 0.001."""
    teeth = m.table("customer").select("c_custkey").crossJoin(F.broadcast(sized(m))).selectExpr("c_custkey % n AS k", "c_custkey DIV n AS t", "(c_custkey DIV n + 0.5D) / (cn DIV n + 2) AS e", "0.4D / (cn DIV n + 2) AS d", "IF(c_custkey DIV n % 3 = 0, 0.02D, 0.0004D) AS h")
    at = teeth.groupBy("k").agg(F.expr("flatten(transform(sort_array(collect_list(struct(t, e, d, h))), v -> array(array(v.e, 0D), array(v.e, v.h), array(v.e + v.d, v.h), array(v.e + v.d, 0D))))").alias("edge"))
    squares = m.table("supplier").selectExpr("s_suppkey AS k").join(at, "k", "left").withColumn("edge", F.coalesce("edge", F.array().cast("array<array<double>>")))
    ring = "transform(concat(array(array(0D, 0D)), edge, array(array(1D, 0D), array(1D, 1D), array(0D, 1D), array(0D, 0D))), p -> array(p[0] + k % 1000 * 2, p[1] + k DIV 1000 * 2))"
    return squares.selectExpr(f"{_code('k', 6)} AS parish_code", f"array(array({ring})) AS polygons")


#: A ring or two for each kind of mistake, by parish number modulo 12, in parts of a unit square; other parishes are as they are.
MISTAKES = {
    1: ("rings_cross", "[[[[0,0],[1,1],[1,0],[0,1],[0,0]]]]"), 2: ("hole_outside", "[[[[0,0],[1,0],[1,1],[0,1],[0,0]],[[2,2],[3,2],[3,3],[2,3],[2,2]]]]"), 3: ("too_few_points", "[[[[0,0],[1,0],[0,0]]]]"),
    4: ("parts_overlap", "[[[[0,0],[9,0],[9,9],[0,9],[0,0]]],[[[1,1],[2,1],[2,2],[1,2],[1,1]]]]"), 5: ("no_polygon", "[]"), 6: ("interior_disconnected", "[[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[0,2],[2,1],[4,2],[2,3],[0,2]]]]"),
    7: ("holes_nested", "[[[[0,0],[9,0],[9,9],[0,9],[0,0]],[[1,1],[8,1],[8,8],[1,8],[1,1]],[[2,2],[3,2],[3,3],[2,3],[2,2]]]]"), 8: ("ring_touches_itself", "[[[[0,0],[4,0],[4,4],[2,0],[0,4],[0,0]]]]"),
    9: ("rings_cross", "[[[[0,0],[2,0],[2,2],[0,2],[0,0]],[[1,1],[3,1],[3,3],[1,3],[1,1]]]]"),
}


def sketched(m: Mart) -> DataFrame:
    """Parishes of which nine in twelve are drawn with a mistake, ten times as many as suppliers."""
    wrong = "CASE k % 12 " + " ".join(f"WHEN {k} THEN '{text}'" for k, (_, text) in MISTAKES.items()) + " END"
    spare = m.table("customer").selectExpr("c_custkey AS k").withColumn("parish_code", F.expr(_code("k", 6)))
    return spare.withColumn("polygons", F.from_json(F.coalesce(F.expr(wrong), F.lit("[[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[4,2],[2,1],[2,3],[4,2]]],[[[4,4],[5,4],[5,5],[4,4]]]]")), nodes.POLYGONS))


cleaned = lambda m: nodes.clean_coordinates(node_rows(m))
located = lambda m: nodes.point_in_parish(cleaned(m), boundaries(m))
discrepant = lambda m: nodes.node_discrepancies(cleaned(m), located(m), boundaries(m))
duck = lambda e: e.replace(" DIV ", " // ")
NUMS = "regexp_extract_all(replace(trim({c}), ',', '.'), '\\d+(?:[.,]\\d+)?')"


def _reason(c: str) -> str:
    n = NUMS.format(c=c)
    p = lambda k: f"coalesce(TRY_CAST({n}[{k}] AS DOUBLE), 0)"
    return f"CASE WHEN {c} IS NULL THEN 'valor_nulo' WHEN lower(trim({c})) IN ('', 'nan', 'null', 'none', '0', '-') THEN 'valor_vacio_o_cero' WHEN len({n}) = 0 THEN 'sin_componentes_numericos' WHEN {p(2)} >= 60 OR {p(3)} >= 60 THEN 'minutos_o_segundos_fuera_de_rango_0_60' END"


def _value(c: str) -> str:
    n = NUMS.format(c=c)
    p = lambda k: f"coalesce(TRY_CAST({n}[{k}] AS DOUBLE), 0.0)"
    return f"CASE WHEN {_reason(c)} IS NULL THEN ({p(1)} + {p(2)} / 60 + {p(3)} / 3600) * CASE WHEN regexp_matches(upper({c}), '[SOW]') THEN -1 ELSE 1 END END"


NODES = (
    f"WITH nodes AS (SELECT {', '.join(f'{duck(e)} AS {n}' for n, e in NODE.items())} FROM customer), n1 AS (SELECT *, {_value('latitude_text')} AS la, {_value('longitude_text')} AS raw FROM nodes), "
    "n2 AS (SELECT *, coalesce(raw > 0 AND NOT regexp_matches(upper(coalesce(longitude_text, '')), '[NSOEW]'), false) AS west_inferred FROM n1), n3 AS (SELECT *, CASE WHEN west_inferred THEN -raw ELSE raw END AS lo FROM n2), "
    "n4 AS (SELECT *, CASE WHEN la IS NULL OR lo IS NULL THEN 'coordenada_no_convertible' WHEN NOT la BETWEEN -5.0 AND 1.5 THEN printf('latitud_fuera_de_rango_ecuador(%.4f)', la) WHEN NOT lo BETWEEN -92.0 AND -75.0 THEN printf('longitud_fuera_de_rango_ecuador(%.4f)', lo) END AS rr FROM n3), "
    f"cleaned AS (SELECT {commas(NODE)}, west_inferred, rr IS NULL AS is_valid, CASE WHEN rr IS NULL THEN la END AS latitude, CASE WHEN rr IS NULL THEN lo END AS longitude, nullif(array_to_string(list_filter([{_reason('latitude_text')}, CASE WHEN {_reason('longitude_text')} IS DISTINCT FROM {_reason('latitude_text')} THEN {_reason('longitude_text')} END, rr], lambda x: x IS NOT NULL), '; '), '') AS reasons FROM n4), "
    f"sized AS (SELECT n, cn, {WIDE} AS w FROM (SELECT count(*) AS n FROM supplier), (SELECT count(*) AS cn FROM customer)), "
    f"grid AS (SELECT k, n, cn, w, {', '.join(f'{duck(e)} AS {c}' for c, e in CELL.items())} FROM (SELECT s_suppkey AS k FROM supplier), sized), "
    f"cells AS (SELECT *, {', '.join(f'{duck(e)} AS {c}' for c, e in CODES.items())} FROM grid), "
    "located AS (SELECT node, min(c.parish_code) AS parish_code FROM cleaned n JOIN cells c ON longitude BETWEEN x AND x + s AND latitude BETWEEN y AND y + s AND " + IN_SHAPE + " GROUP BY node), "
    "vertices AS (SELECT parish_code, " + CORNERS + " AS corners, coalesce(placed, 0) AS placed FROM cells LEFT JOIN (SELECT c_custkey % n AS k, count(*) AS placed FROM customer, sized GROUP BY 1) USING (k)), "
    "discrepant AS (SELECT node, reported_canton, l.parish_code AS derived_parish, c.canton_code AS derived_canton, c.province_code AS derived_province, coalesce(nullif(trim(reported_canton), '') <> c.canton_code, false) AS is_discrepant FROM cleaned JOIN located l USING (node) JOIN cells c ON c.parish_code = l.parish_code) "
)
plain("validate_coordinates", lambda m: cleaned(m).select("node", "west_inferred", "is_valid", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "reasons"), NODES + "SELECT node, west_inferred, is_valid, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, reasons FROM cleaned")
plain("dms_to_decimal", lambda m: node_rows(m).select("node", F.round(C.dms_to_decimal(F.col("latitude_text")), 6).alias("value"), C.dms_reason(F.col("latitude_text")).alias("reason")), NODES + f"SELECT node, round(la, 6) AS value, {_reason('latitude_text')} AS reason FROM n1")
plain("infer_west_longitude", lambda m: node_rows(m).select("node", F.round(C.infer_west_longitude(F.col("longitude_text"), C.dms_to_decimal(F.col("longitude_text"))), 6).alias("value")), NODES + "SELECT node, round(lo, 6) AS value FROM n3")
plain("invalid_reason_summary", lambda m: nodes.invalid_reason_summary(cleaned(m)), NODES + "SELECT coalesce(reasons, 'valid') AS reason, count(*) AS n_nodes, count(*) FILTER (west_inferred) AS n_west_inferred FROM cleaned GROUP BY 1")
plain("point_in_parish", located, NODES + "SELECT * FROM located")
plain("node_discrepancies", discrepant, NODES + "SELECT * FROM discrepant")
plain("node_territory_ids", lambda m: nodes.node_territory_ids(node_rows(m)).select("node", "province_id", "canton_id", "parish_id"), NODES + "SELECT node, 'PROVINCIA|' || province_code AS province_id, 'CANTON|' || province_code || '|' || canton_code AS canton_id, 'PARROQUIA|' || province_code || '|' || canton_code || '|' || parish_code AS parish_id FROM nodes")
plain("node_filter", lambda m: nodes.node_filter(node_rows(m), provinces=["01", "02"], types=["nodo"]).select("node"), NODES + "SELECT node FROM nodes WHERE province_code IN ('01', '02') AND upper(trim(node_type)) = 'NODO'")
plain("nonstandard_codes", lambda m: nodes.nonstandard_codes(boundaries(m).withColumn("parish_code", F.when(F.col("parish_code") == "000007", "ISLA").otherwise(F.col("parish_code")))), NODES + "SELECT 'ISLA' AS parish_code, canton_code, province_code FROM cells WHERE parish_code = '000007'")
#: Borders cut at every vertex of the canton on them; a piece that only one parish has is the canton's. All run along an axis.
OUTLINE = (
    "corners(shape, ring, q, px, py) AS (VALUES " + ", ".join(f"({k}, {n * 10 + r}, {q}, {px}, {py})" for k, shape in enumerate(SHAPES) for n, rings in enumerate(shape) for r, ring in enumerate(rings) for q, (px, py) in enumerate(ring)) + "), "
    "spots AS (SELECT canton_code, k, ring, q, x + px::DOUBLE * s AS vx, y + py::DOUBLE * s AS vy FROM cells JOIN corners ON shape = k % 4), "
    "lines AS (SELECT *, lead(vx) OVER w AS ux, lead(vy) OVER w AS uy FROM spots WINDOW w AS (PARTITION BY canton_code, k, ring ORDER BY q)), "
    f"knots AS (SELECT canton_code, vx, vy FROM spots UNION SELECT canton_code, x + {duck(EDGE)}, y FROM customer, sized JOIN cells USING (n, cn, w) WHERE k = c_custkey % n), "
    "bits AS (SELECT l.canton_code, k, ring, q, ux = l.vx AS upright, CASE WHEN ux = l.vx THEN ux ELSE uy END AS lane, CASE WHEN ux = l.vx THEN n.vy ELSE n.vx END AS u FROM lines l JOIN knots n ON l.canton_code = n.canton_code AND n.vx BETWEEN least(l.vx, ux) AND greatest(l.vx, ux) AND n.vy BETWEEN least(l.vy, uy) AND greatest(l.vy, uy) WHERE ux IS NOT NULL), "
    "pieces AS (SELECT canton_code, upright, lane, u, lead(u) OVER (PARTITION BY canton_code, k, ring, q ORDER BY u) AS v FROM bits), "
    "border AS (SELECT canton_code, sum(v - u) AS perimeter, count(*) AS n_edges FROM (SELECT canton_code, u, v FROM pieces WHERE v IS NOT NULL GROUP BY canton_code, upright, lane, u, v HAVING count(*) % 2 = 1) GROUP BY canton_code) "
)
plain(
    "boundary_rollup", lambda m: nodes.boundary_rollup(boundaries(m), "canton").select("canton_code", "name", "n_parishes", "min_x", "min_y", "max_x", "max_y", F.round("area", 6).alias("area"), F.round("perimeter", 6).alias("perimeter"), (F.col("n_vertices") - F.col("n_rings")).alias("n_edges")),
    NODES.rstrip() + ", " + OUTLINE + f"SELECT canton_code, min(canton_name) AS name, count(*) AS n_parishes, min(x)::DOUBLE AS min_x, min(y)::DOUBLE AS min_y, max(x + s)::DOUBLE AS max_x, max(y + s)::DOUBLE AS max_y, round(sum({AREA} * s * s), 6)::DOUBLE AS area, round(any_value(perimeter), 6) AS perimeter, any_value(n_edges)::BIGINT AS n_edges FROM cells JOIN border USING (canton_code) GROUP BY canton_code",
)
plain("boundary_offences", lambda m: boundary.offences(sketched(m)), f"SELECT {_code('c_custkey', 6)} AS parish_code, CASE c_custkey % 12 " + " ".join(f"WHEN {k} THEN '{reason}'" for k, (reason, _) in MISTAKES.items()) + " END AS reason FROM customer WHERE c_custkey % 12 IN (" + ", ".join(map(str, MISTAKES)) + ")")
plain("territory_bounds", lambda m: nodes.territory_bounds(nodes.with_box(boundaries(m)), provinces=["01", "02"]), NODES + "SELECT min(x)::DOUBLE AS min_x, min(y)::DOUBLE AS min_y, max(x + s)::DOUBLE AS max_x, max(y + s)::DOUBLE AS max_y FROM cells WHERE province_code IN ('01', '02')")
plain("parse_geojson", lambda m: boundaries(m).select("parish_code", nodes.vertex_count().alias("n_vertices")), NODES + "SELECT parish_code, (corners + placed)::BIGINT AS n_vertices FROM vertices")
plain("simplify_boundary", lambda m: nodes.simplify_boundary(coasts(m), 0.001).select("parish_code", "n_before", "n_after"), f"SELECT {_code('k', 6)} AS parish_code, (5 + 4 * coalesce(a, 0))::BIGINT AS n_before, (5 + 4 * coalesce(b, 0))::BIGINT AS n_after FROM (SELECT s_suppkey AS k FROM supplier) LEFT JOIN (SELECT c_custkey % n AS k, count(*) AS a, count(*) FILTER (c_custkey // n % 3 = 0) AS b FROM customer, (SELECT count(*) AS n FROM supplier) GROUP BY 1) USING (k)")
add("node_map", lambda m: nodes.node_map(node_rows(m).select("node", "licence"), located(m), dims.provider_licence_bridge(m.normalised), m.providers, discrepant(m)), NODES.rstrip() + ", " + sql("\x00")[len("WITH "):].replace("\x00", "SELECT n.node, n.licence, l.parish_code, b.provider_id, p.provider_name, coalesce(d.is_discrepant, false) AS is_discrepant FROM nodes n LEFT JOIN located l USING (node) LEFT JOIN (SELECT DISTINCT provider_id, licence FROM normalised) b ON b.licence = n.licence LEFT JOIN providers p ON p.provider_id = b.provider_id LEFT JOIN discrepant d ON d.node = n.node"))

# Stored layers


def reloaded(m: Mart) -> StoredMart:
    """A mart built from reports of which some were wrong and some still missing, and then loaded again as they are."""
    n = F.col("licence").cast("long")
    wrong = (n % 10 == 4) & (F.month("month") == 5)
    late = ((n % 10 == 2) & (F.year("month") == 1997) & (F.month("month") == 6)) | ((n % 40 == 6) & (F.year("month") >= 1998) & (F.month("month") > 9))
    begun = m.summary.filter(~late).withColumn("users", F.when(wrong, F.col("users") + 3).otherwise(F.col("users"))).withColumn("province_code", F.when(wrong & (n % 20 == 4), None).otherwise(F.col("province_code")))
    mart = StoredMart(m.spark, new_folder(m.spark, "mart"), SERIES)
    mart.build(begun, detail=False)
    mart.reload(m.summary.filter(wrong | late))
    return mart


add("reload_months", lambda m: reloaded(m).layer("market"), sql("SELECT * FROM market"))
