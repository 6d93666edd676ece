"""Intermediate results: computed once in a row, or written to the folder that driver and executors share, which lost executors survive."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def new_folder(spark: SparkSession, name: str = "held") -> str:
    """The path of a folder that is not there yet in spark.checkpoint.dir; where that is unset, in a temporary folder of a local session."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-held-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df as Parquet files in a new folder, cut off from its lineage.

    Files keep the true size of what they hold. A plain checkpoint keeps the estimate, which in repeated joins of a table with
    itself doubles its digits each time. They stay until the folder is emptied, as plain checkpoints do.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once: an array of one struct, exploded.

    Else a column that later expressions name several times, or inside a lambda, is computed again for each of these, and
    conditions on it are pushed through the whole chain of expressions.
    """
    made = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", made.alias("_held")).select(*[c for c in df.columns if c not in columns], "_held.*")
