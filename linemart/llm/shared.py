"""Small helpers that the operators of this subpackage have in common."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words everywhere in this subpackage: space and the control characters 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Folders of tables that `stored` and `bucketed` have written and nobody has removed yet, oldest first.
_tables: list[str] = []
#: Names in the catalog of those that `bucketed` has written, by folder.
_named: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    If that is unset, a temporary folder where driver and executors are one process (tests), else an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="spark-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and cut off from its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _new_path(spark: SparkSession) -> str:
    _tables.append(f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}")
    return _tables[-1]


def stored(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder; for what is too large for a plain checkpoint."""
    spark = df.sparkSession
    path = _new_path(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """df as a stored table with a bucket for each shuffle partition, so that joins on the column leave its rows in place."""
    spark = df.sparkSession
    path = _new_path(spark)
    name, n = f"bucketed_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(n, column).saveAsTable(name)
    _named[path] = name
    return spark.table(name)


def removed_after(spark: SparkSession, mark: int, but: DataFrame | None = None) -> None:
    """Removes the tables written since len(tables()) was `mark`, except those that `but` reads, and their names in the catalog."""
    held = {f.rpartition("/")[0].rpartition("/")[2] for f in but.inputFiles()} if but is not None else set()
    for path in _tables[mark:]:
        if path.rpartition("/")[2] not in held:
            if path in _named:
                spark.sql(f"DROP TABLE IF EXISTS {_named.pop(path)}")
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
            _tables.remove(path)


def tables() -> list[str]:
    return list(_tables)


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns named by position, so that no name of an operator clashes with one of theirs, and the new name of each."""
    names = {c: f"_in{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(names: dict[str, str]) -> list[Column]:
    """The columns that `renamed` has renamed, with their own names."""
    return [F.col(x).alias(c) for c, x in names.items()]


def words(text: Column) -> Column:
    """The words of a text as an array of strings; none for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
