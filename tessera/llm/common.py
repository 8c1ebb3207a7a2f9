"""Shared plumbing of the corpus operators: tables, the shared folder, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that Python takes at once. Few, because one text may hold 100 KB and more.
ARROW_ROWS = 1024
#: Rows and bytes of a side up to which it may be broadcast; beyond, the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 250_000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset, a temporary one on a single machine, an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.tessera.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.tessera.checkpoint.dir", path)
    return path.rstrip("/")


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def _file_system(spark: SparkSession, path: str) -> tuple:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed with the scratch folder around it, or when the driver's JVM ends."""
    path = f"{_SCRATCH.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, hadoop = _file_system(spark, path)
    fs.deleteOnExit(hadoop)
    return path


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """What operators write inside goes at the end; nothing that reads it may be left to run then."""
    path = fresh_path(spark, name)
    token = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        remove(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over batches of at most ARROW_ROWS rows; on the JVM's side spark.sql.execution.arrow.maxBytesPerBatch bounds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(batch.slice(k, ARROW_ROWS) for batch in batches for k in range(0, batch.num_rows, ARROW_ROWS))

    return df.mapInArrow(run, schema)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if its counted rows and bytes are within the bounds, else as it is."""
    wide = [F.octet_length(F.col(f"`{c}`")) for c, kind in df.dtypes if kind in ("string", "binary")]
    bytes_of = sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(8 * len(df.columns)))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(bytes_of), F.lit(0))).head()
    return F.broadcast(df) if n <= (rows or BROADCAST_ROWS) and size <= BROADCAST_BYTES else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def columns_of(docs: DataFrame) -> list[Column]:
    """The columns of docs, whatever they are called."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text with null as empty; other columns are left behind, whatever they are called."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
