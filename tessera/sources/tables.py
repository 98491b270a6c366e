"""Scans of the parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Schemas of paths as they were at a time of modification: without one Spark runs a job that reads the files' footers for each scan.
_SCHEMAS: dict[tuple[str, int, int], StructType] = {}


def _version(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """A path with its time of modification and length."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
    return path, status.getModificationTime(), status.getLen()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Scan one table; filters and columns that the plan needs reach the parquet reader."""
    path = f"{sf_dir}/{table}.parquet"
    key = _version(spark, path)
    if (known := _SCHEMAS.get(key)) is not None:
        return spark.read.schema(known).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[key] = df.schema
    return df


def views(spark: SparkSession, sf_dir: str, *tables: str) -> SparkSession:
    """Register tables as temporary views under their own names."""
    for t in tables:
        load(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark
