"""What several operators share: Arrow maps, written cuts of lineage and bitmap filters of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_folder, ship_package

#: Bits of the largest bitmap filter: 16 MB, whatever the size of the data.
MAX_FILTER_BITS = 1 << 27
#: Rows and bytes of the Arrow batches that go to Python, so that long texts don't pile up in one batch.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Hold the Arrow batches of this session to BATCH_ROWS rows and, where Spark can, BATCH_BYTES bytes; and
    see that the workers have this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; no shuffle, memory bounded by one batch."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def staging(spark: SparkSession) -> str:
    """A folder of this application in the shared folder that spark.checkpoint.dir names; a local session (tests) may leave that unset."""
    return f"{shared_folder(spark)}/tessera-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it again. Executors may be lost afterwards."""
    path = f"{staging(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap(keys: DataFrame, column: str, n: int, most: int = MAX_FILTER_BITS, hashed: bool = False) -> np.ndarray:
    """A filter of ``n`` 64-bit keys as 64-bit words: about 16 bits a key, ``most`` in all, so its size is bounded. Keys that are hashes
    already are not hashed again. Spark ors the bits of each word; the driver gets ``most / 64`` words at most. A key that is in is always found; others rarely are,
    so an exact join has to follow."""
    bits = 1 << 16
    while bits < min(16 * n, most):
        bits *= 2
    mixed = keys.where(F.col(column).isNotNull()).select((F.col(column) if hashed else F.xxhash64(column)).alias("m"))
    each = mixed.selectExpr(f"m & {(bits >> 6) - 1} AS w", "shiftleft(1L, CAST(shiftrightunsigned(m, 58) AS int)) AS b")
    rows = each.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out


def in_bitmap(words: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Which values of ``xxhash64(column)`` may be in a bitmap()."""
    return (words[mixed & (len(words) - 1)] >> (mixed.view(np.uint64) >> np.uint64(58)).astype(np.int64)) & 1 == 1


def texts(column: pa.Array) -> list[str]:
    """Python strings of a column, null as empty."""
    return [x or "" for x in column.to_pylist()]
