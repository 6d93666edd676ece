"""Slowly changing dimensions, as-of joins, upserts and their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linemart.functions.columns import row_snapshot

BEGINNING = "1900-01-01 00:00:00"


def same(a: str, b: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def detect_change(before: DataFrame, after: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys of both sides whose columns differ, null being a value like others."""
    joined = before.alias("a").join(after.alias("b"), same("a", "b", key))
    return joined.filter(~same("a", "b", columns)).select(*[F.col(f"b.{c}").alias(c) for c in key])


def scd2_apply(current: DataFrame, snapshot: DataFrame, key: list[str], versioned: list[str], type1: list[str], now: str) -> DataFrame:
    """All versions after a snapshot. New keys start at the beginning of time; a changed versioned column closes the
    version and opens one at `now`; otherwise type-1 columns are refreshed; keys that the snapshot lacks stay open.
    Applied again with the same snapshot nothing changes."""
    columns = [*key, *versioned, *type1]
    at = F.lit(now).cast("timestamp")
    open_end = F.lit(None).cast("timestamp")
    old = current.filter(~F.col("is_current")).select(*columns, "valid_from", "valid_to", "is_current")
    joined = current.filter("is_current").alias("a").join(snapshot.alias("b"), same("a", "b", key), "full_outer").select("*", F.col("a.is_current").isNotNull().alias("_old"), F.col(f"b.{key[0]}").isNotNull().alias("_new"))
    changed = F.col("_old") & F.col("_new") & ~same("a", "b", versioned)
    take = lambda side, names: [F.col(f"{side}.{c}").alias(c) for c in names]
    kept = joined.filter(F.col("_old")).select(
        *take("a", [*key, *versioned]),
        *[F.when(F.col("_new") & ~changed, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in type1],
        F.col("a.valid_from").alias("valid_from"), F.when(changed, at).otherwise(open_end).alias("valid_to"), (~changed).alias("is_current"),
    )
    opened = joined.filter(F.col("_new") & (~F.col("_old") | changed)).select(
        *take("b", columns), F.when(F.col("_old"), at).otherwise(F.lit(BEGINNING).cast("timestamp")).alias("valid_from"), open_end.alias("valid_to"), F.lit(True).alias("is_current")
    )
    return old.unionByName(kept).unionByName(opened)


def current_view(versions: DataFrame) -> DataFrame:
    return versions.filter("is_current")


def asof_dimension_join(fact: DataFrame, versions: DataFrame, key: list[str], month: str = "month") -> DataFrame:
    """Facts with the version valid on the first of their month; a version opened within a month counts from the next
    one, and facts without a version drop."""
    v = versions.withColumnsRenamed({c: f"_v_{c}" for c in [*key, "valid_from", "valid_to"]})
    cond = (F.col(month) >= F.to_date("_v_valid_from")) & (F.col("_v_valid_to").isNull() | (F.col(month) < F.to_date("_v_valid_to")))
    for c in key:
        cond = cond & (F.col(c) == F.col(f"_v_{c}"))
    return fact.join(v, cond).withColumnsRenamed({"_v_valid_from": "valid_from", "_v_valid_to": "valid_to"}).drop(*[f"_v_{c}" for c in key])


def collapse_versions(versions: DataFrame, key: list[str], versioned: list[str]) -> DataFrame:
    """Successive versions that are equal in the versioned columns become one: attributes and start of the first,
    end and currency of the last."""
    w = Window.partitionBy(*key).orderBy("valid_from")
    state = F.struct(*versioned)
    starts = F.when(F.row_number().over(w) == 1, 1).when(state.eqNullSafe(F.lag(state).over(w)), 0).otherwise(1)
    runs = versions.withColumn("_start", starts).withColumn("_run", F.sum("_start").over(w))
    others = [c for c in versions.columns if c not in [*key, "valid_from", "valid_to", "is_current"]]
    return runs.groupBy(*key, "_run").agg(
        F.min_by(F.struct(*others), "valid_from").alias("_first"), F.min("valid_from").alias("valid_from"),
        F.max_by(F.struct("valid_to", "is_current"), "valid_from").alias("_last"),
    ).select(*key, *[F.col(f"_first.{c}").alias(c) for c in others], "valid_from", "_last.valid_to", "_last.is_current")


def version_diagnostics(versions: DataFrame, key: list[str]) -> DataFrame:
    n, keys = F.count("*"), F.count_distinct(*key)
    return versions.agg(n.alias("n_versions"), keys.alias("n_keys"), F.round(F.try_divide(n.cast("double"), keys), 4).alias("versions_per_key"))


def current_version_violations(versions: DataFrame, key: list[str]) -> DataFrame:
    return versions.filter("is_current").groupBy(*key).agg(F.count("*").alias("n_current")).filter("n_current > 1")


def upsert(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """target with the rows of batch in place of those of the same key, null key parts being equal to each other."""
    return target.alias("a").join(batch.alias("b"), same("a", "b", key), "left_anti").unionByName(batch)


def correction_history(before: DataFrame, after: DataFrame, key: list[str], hash_col: str = "row_hash") -> DataFrame:
    """The image, before the change, of rows whose hash changed; new rows have none."""
    changed = before.alias("a").join(after.select(*key, hash_col).alias("b"), same("a", "b", key)).filter(~same("a", "b", [hash_col]))
    return changed.select(*[F.col(f"a.{c}").alias(c) for c in key], F.col(f"a.{hash_col}").alias("old_hash"), F.col(f"b.{hash_col}").alias("new_hash"), row_snapshot([f"a.{c}" for c in before.columns]).alias("before_image"))


def sync_admin_codes(summary: DataFrame, codes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """summary with fresh administrative codes where the key is known; everything else, hashes included, stays."""
    fresh = codes.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_known"))
    joined = summary.join(fresh, key, "left")
    new = {c: F.when(F.col("_known"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(new).select(*summary.columns)


def unmatched_codes_count(summary: DataFrame, column: str) -> DataFrame:
    return summary.agg(F.count_if(F.col(column).isNull()).alias("n_unmatched"), F.count("*").alias("n_rows"))


def merge_preserving_review(existing: DataFrame, detected: DataFrame, key: list[str], derived: list[str], review: list[str]) -> DataFrame:
    """Derived columns are refreshed, review columns of known rows never touched, rows not detected again stay."""
    joined = existing.alias("a").join(detected.alias("b"), same("a", "b", key), "full_outer").withColumn("_a", F.coalesce(*[F.col(f"a.{c}") for c in key]).isNotNull()).withColumn("_b", F.coalesce(*[F.col(f"b.{c}") for c in key]).isNotNull())
    pick = lambda cond, x, y: F.when(cond, x).otherwise(y)
    return joined.select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in key],
        *[pick(F.col("_b"), F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) for c in derived],
        *[pick(F.col("_a"), F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in review],
    )


def reconcile_hashes(source: DataFrame, stored: DataFrame, key: list[str], hash_col: str = "row_hash") -> DataFrame:
    """Keys that one side lacks or whose hashes differ."""
    joined = source.select(*key, hash_col).withColumn("_in", F.lit(True)).alias("a").join(stored.select(*key, hash_col).withColumn("_in", F.lit(True)).alias("b"), same("a", "b", key), "full_outer")
    kind = F.when(F.col("a._in").isNull(), "only_stored").when(F.col("b._in").isNull(), "only_source").when(~same("a", "b", [hash_col]), "different")
    picked = [F.when(F.col("a._in").isNotNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in key]
    return joined.select(*picked, kind.alias("finding")).filter("finding is not null")


def certify_load(source: DataFrame, stored: DataFrame, versions: DataFrame, view: DataFrame, key: list[str], version_key: list[str]) -> DataFrame:
    """One row: row counts, findings of each kind, and the verdict. All parts are aggregates."""
    counts = source.agg(F.count("*").alias("n_source")).join(stored.agg(F.count("*").alias("n_stored")))
    found = reconcile_hashes(source, stored, key).agg(*[F.count_if(F.col("finding") == k).alias(f"n_{k}") for k in ("only_source", "only_stored", "different")])
    twice = current_version_violations(versions, version_key).agg(F.count("*").alias("n_version_violations"))
    dup = view_duplicates(view, key).agg(F.count("*").alias("n_view_duplicates"))
    parts = counts.join(found).join(twice).join(dup)
    ok = (F.col("n_source") == F.col("n_stored")) & (F.col("n_only_source") + F.col("n_only_stored") + F.col("n_different") + F.col("n_version_violations") + F.col("n_view_duplicates") == 0)
    return parts.withColumn("certified", ok)


def view_duplicates(view: DataFrame, key: list[str]) -> DataFrame:
    return view.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
