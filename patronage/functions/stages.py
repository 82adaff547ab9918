"""Stages that later steps read more than once, kept as Parquet in the shared folder.

A stored stage keeps its columns (so later scans read only what they need), its true
size (so joins are planned by it) and survives the loss of executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, one in the warehouse, which every executor also sees."""
    base = spark.conf.get(_KEY, None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
        spark.conf.set(_KEY, base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str = "stage") -> str:
    """A path in the shared folder that no other stage uses."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows as Parquet to the shared folder and continue from there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> None:
    """Remove every stage this application stored; for the end of a run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
