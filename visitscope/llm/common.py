"""Helpers shared by the operators: reading tables, tables staged in the
cluster's shared folder, and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes of one Arrow batch sent to Python. Both bound the memory of
# a task; a single longer row travels alone. Spark reads them when a query runs,
# so they are the same for all operators of a session.
ARROW_ROWS = 2000
ARROW_BYTES = "4m"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python stages to `ARROW_ROWS` rows and `ARROW_BYTES`."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`.

    A session without one gets a private folder, but only in local mode,
    where driver and executors are one process.
    """
    sc = spark.sparkContext
    target = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
              or sc.getCheckpointDir())
    if target:
        return target.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="visitscope-llm-"))
    return sc.getCheckpointDir().rstrip("/")


# Lists that take down the folders written by `staged`, one for each open `staging` of this thread of control.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staging", default=())


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs later stages a re-read, not a
    recomputation, and the table is computed once however often it is used.
    It stands until `drop_staged`, or for the cluster to clear with its folder.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/visitscope/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for scope in _scopes.get():
        scope.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging() -> Iterator[list[str]]:
    """The folders of the tables that `staged` writes within, oldest first."""
    written: list[str] = []
    token = _scopes.set((*_scopes.get(), written))
    try:
        yield written
    finally:
        _scopes.reset(token)


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that no query will read again; one that is gone is passed over."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: T.StructType) -> DataFrame:
    """`fn` over every Arrow batch of `df`; batches without rows are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """Strings of an Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def text_or_empty(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
