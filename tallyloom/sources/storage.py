"""Folders that driver and executors share, and tables written there to end a lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, in local mode alone, under the warehouse."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tallyloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in a shared folder: what is read again isn't computed again, and lost executors cost nothing."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once nothing that is still to run reads them."""
    for t in tables:
        remove(t.sparkSession, t._folder)


def files(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in store.listStatus(place)] if store.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
