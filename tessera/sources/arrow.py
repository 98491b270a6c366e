"""Arrow in and out: bulk ingest with its modes, record batches, and IPC files and streams."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.ipc as ipc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of a streamed batch.
BATCH_ROWS = 65_536
_MAGIC = b"ARROW1"


def ingest(spark: SparkSession, data: pa.Table | DataFrame, path: str, mode: str = "create") -> None:
    """Write a table as Parquet. create: an error if it exists; append: it must exist with these columns; replace; create_append."""
    df = data if isinstance(data, DataFrame) else spark.createDataFrame(data)
    if mode == "append":
        there = spark.read.parquet(path)
        df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in there.schema.fields])
    df.write.mode({"create": "error", "append": "append", "replace": "overwrite", "create_append": "append"}[mode]).parquet(path)


def _serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as the bytes of a stream of its own."""
    for b in batches:
        out = pa.BufferOutputStream()
        with ipc.new_stream(out, b.schema) as w:
            w.write_batch(b)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], ["batch"])


def record_batches(df: DataFrame, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """A result as record batches of up to ``rows`` rows, in order of its partitions. The executors write the batches; the driver holds
    those of one partition at a time, and an error ends the stream."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(rows))
    try:
        found = df.mapInArrow(_serialized, "batch binary").toLocalIterator(prefetchPartitions=True)
        schema = to_arrow_schema(df.schema)
        for row in found:
            yield from (b.cast(schema) for b in ipc.open_stream(bytes(row[0])))
    finally:
        conf.set(key, before)


def export_ipc(df: DataFrame, path: str, stream: bool = False, compression: str | None = None) -> None:
    """One IPC file (or stream) of a result, for results that fit on the driver; it appears whole, by a rename."""
    table = df.toArrow()
    options = ipc.IpcWriteOptions(compression=compression)
    fd, part = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    try:
        with os.fdopen(fd, "wb") as f:
            with (ipc.new_stream if stream else ipc.new_file)(f, table.schema, options=options) as w:
                w.write_table(table, max_chunksize=BATCH_ROWS)
        os.replace(part, path)
    except BaseException:
        os.unlink(part)
        raise


def import_ipc(spark: SparkSession, path: str) -> DataFrame:
    """A file or stream, told apart by its first bytes."""
    with open(path, "rb") as f:
        is_file = f.read(len(_MAGIC)) == _MAGIC
        f.seek(0)
        table = (ipc.open_file(f) if is_file else ipc.open_stream(f)).read_all()
    return spark.createDataFrame(table)
