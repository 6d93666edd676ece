"""Sources and sinks: partitioned reads, versioned and idempotent writes, logs and exports."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linemart.operators.boundaries import valid_boundaries
from linemart.operators.nodes import parse_geojson
from linemart.operators.scd import same, upsert

BOUNDARY_FIELDS = ["parish_code", "parish_name", "canton_code", "canton_name", "province_code", "province_name", "geometry"]
LOG_SCHEMA = "load_type string, year int, n_rows long, status string, error string, loaded_at timestamp"


def read_line_detail(spark: SparkSession, path: str, year: int | None = None, months: list[int] | None = None) -> DataFrame:
    """Line detail from Parquet partitioned by year and month; only the partitions asked for are read."""
    out = spark.read.parquet(path)
    if year is not None:
        out = out.filter(F.col("year") == year)
    return out if months is None else out.filter(F.col("month_number").isin(months))


def read_line_detail_jdbc(spark: SparkSession, url: str, table: str, year: int, months: list[int], properties: dict[str, str]) -> DataFrame:
    """The same from a database, one query, and so one task, for each month."""
    predicates = [f"year = {int(year)} AND month_number = {int(m)}" for m in months]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A current-state table by its declared schema; nothing is inferred, so codes keep leading zeros."""
    return spark.read.schema(schema).parquet(path)


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """Boundary rows (JSON lines) with seven required fields, the geometry as GeoJSON text, all others as text. A field that no row has fails."""
    found = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("f"))  # an object within is kept as its JSON text
    there = found.agg(*[F.max(F.map_contains_key("f", f)).alias(f) for f in BOUNDARY_FIELDS]).first()
    missing = [f for f in BOUNDARY_FIELDS if not there[f]]
    if missing:
        raise ValueError(f"boundary fields are missing: {', '.join(missing)}")
    return found.select(*[F.col("f")[f].alias(f) for f in BOUNDARY_FIELDS])


def read_valid_boundaries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(boundary rows with their polygons, (parish_code, reasons) of those left out because their polygons are not valid)."""
    return valid_boundaries(read_boundaries(spark, path).withColumn("polygons", parse_geojson(F.col("geometry"))))


def upsert_summary(spark: SparkSession, path: str, batch: DataFrame, key: list[str], partitions: list[str]) -> None:
    """Replaces rows of the same key in the partitions that the batch touches, and stamps the load time.

    The next content of the touched partitions is written as a batch of its own under path/data; a manifest (a row for
    each partition: its values and the batch that holds it) is then published, which makes all of them current at once.
    Other partitions are neither read nor written, and a crash leaves the manifest before. Null key and partition values
    are equal to each other. A batch with two rows of one key is an error, as either could be meant.

    Two upserts at once never share a number: each claims one by creating a folder that only one of them can create. Of two
    that began from the same state and end at different times the second is withdrawn and fails; if they end at once, both.
    """
    stamped = batch.withColumn("loaded_at", F.current_timestamp())
    twice = batch.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the batch has {twice[0]['n']} rows of the key {tuple(twice[0][k] for k in key)}")
    number = claimed(spark, path)
    touched = batch.select(*partitions).distinct()
    manifest, after = touched.withColumn("batch", F.lit(number)), stamped
    based_on = current_version(spark, f"{path}/manifest")
    if based_on is not None:
        before = read_published(spark, f"{path}/manifest")
        held = read_summary(spark, path).alias("a").join(touched.alias("b"), same("a", "b", partitions), "left_semi").select(*stamped.columns)
        after = upsert(held, stamped, key)
        manifest = before.alias("a").join(touched.alias("b"), same("a", "b", partitions), "left_anti").unionByName(manifest)
    after.write.partitionBy(*partitions).parquet(f"{path}/data/batch={number}")
    publish_claimed(spark, manifest, path, number, based_on)


def publish_claimed(spark: SparkSession, manifest: DataFrame, path: str, number: int, based_on: int | None) -> None:
    """Makes a manifest the current one; it is withdrawn if another was published since the version that it is based on."""
    publish_with_previous(spark, manifest, f"{path}/manifest", number)
    if {n for n in _numbers(spark, f"{path}/manifest", "current") if based_on is None or n > based_on} != {number}:
        fs, mark = _folder(spark, f"{path}/manifest/current={number}")
        fs.delete(mark, False)
        raise RuntimeError(f"another upsert into {path} was published meanwhile; this one is withdrawn, and may be run again")


def claimed(spark: SparkSession, path: str) -> int:
    """A batch number that no other writer has: its claim, an empty file, is created only if there is none."""
    number = max([-1, *_numbers(spark, f"{path}/data", "batch"), *_numbers(spark, f"{path}/claims", "batch"), *_numbers(spark, f"{path}/manifest", "version")]) + 1
    while True:
        fs, where = _folder(spark, f"{path}/claims/batch={number}")
        try:
            fs.create(where, False).close()
            return number
        except Py4JJavaError as taken:
            if not fs.exists(where):
                raise taken
            number += 1


def latest_of_each(batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key: of several the last by `order`, which must tell them apart."""
    rows = [c for c in batch.columns if c not in order]
    return batch.groupBy(*key).agg(F.max_by(F.struct(*rows), F.struct(*order)).alias("_r")).select("_r.*")


def read_summary(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """What upserts have made current, or what was so many upserts ago."""
    manifest = read_published(spark, f"{path}/manifest", back)
    keys = [f for f in manifest.schema.fields if f.name != "batch"]
    batches = [r.batch for r in manifest.select("batch").distinct().collect()]
    at = spark.read.option("basePath", f"{path}/data")
    files = [f"{path}/data/batch={n}" for n in batches]
    values = [f for f in at.parquet(*files).schema.fields if f.name not in manifest.columns]
    found = at.schema(T.StructType([*values, T.StructField("batch", T.IntegerType()), *keys])).parquet(*files)
    current = same("a", "b", manifest.columns)
    return found.alias("a").join(manifest.alias("b"), current, "left_semi").drop("batch")


def append_load_log(spark: SparkSession, path: str, load_type: str, year: int, n_rows: int, status: str, error: str | None = None) -> None:
    row = spark.createDataFrame([(load_type, year, n_rows, status, error)], "load_type string, year int, n_rows long, status string, error string")
    row.withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of entries prefix=number, in order."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(where)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{prefix}=") and n.partition("=")[2].isdigit())


def globbed(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """The folders below path that a pattern names, as paths relative to it."""
    fs, where = _folder(spark, f"{path}/{pattern}")
    depth = pattern.count("/") + 1
    return ["/".join(str(x.getPath()).split("/")[-depth:]) for x in fs.globStatus(where) or []]


def current_version(spark: SparkSession, path: str) -> int | None:
    """The published version: the highest with a mark. A version without one was never finished."""
    return max(_numbers(spark, path, "current"), default=None)


def publish_with_previous(spark: SparkSession, df: DataFrame, path: str, number: int | None = None) -> str:
    """Writes the next version, then marks it as current by an empty file that only one writer can create; those before stay. Gives the new version's path.

    Numbers only rise, above those of versions that were begun and never marked, so nothing is overwritten.
    """
    if number is None:
        number = max([-1, *_numbers(spark, path, "version"), *_numbers(spark, path, "current")]) + 1
    version = f"{path}/version={number}"
    df.write.parquet(version)
    fs, mark = _folder(spark, f"{path}/current={number}")
    fs.create(mark, False).close()
    return version


def read_published(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """The current version, or one so many published versions back."""
    marked = _numbers(spark, path, "current")
    if len(marked) <= back:
        raise ValueError(f"{path} has {len(marked)} published versions")
    return spark.read.parquet(f"{path}/version={marked[-1 - back]}")


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_if_empty(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """The table at path; it is built and written only if there is none, or if forced."""
    if force or not exists(spark, path):
        overwrite_table(build(), path)
    return spark.read.parquet(path)


def export_report(df: DataFrame, path: str) -> None:
    """A report grid, small by its nature, as one CSV file with a header. It is computed in all tasks and gathered at the end."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
