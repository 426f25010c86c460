"""Helpers shared by the training-data operators: shared-folder tables, sized broadcasts, Arrow buffers."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a checked lookup table is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 20_000
#: A null doc_id travels as this value inside numpy arrays; it is no doc_id itself (a row that has it counts as null).
NULL_ID = -(2**63)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset.

    Our own is a temporary folder in local mode, else one on the cluster's default file system; a cluster whose default
    is its machines' own disks is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.startswith("local"):
            found = "file://" + tempfile.mkdtemp(prefix="varqa-")
        else:
            default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            if default.startswith("file:"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            found = f"{default.rstrip('/')}/tmp/varqa-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/varqa/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df once as Parquet in the shared folder and reads it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_rows(df: DataFrame):
    """All columns of df as one struct, so that columns beside it can have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def filter_batches(df: DataFrame, run) -> DataFrame:
    """df through run (Arrow batches to Arrow batches of the same columns), whatever the columns' names are."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def sized_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows, else df itself (a shuffle join, split by AQE where skewed)."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).take(rows + 1)) <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches_for(df: DataFrame, column: str, target_bytes: int) -> int:
    """How many batches of about target_bytes hold the whole column; at least the number of shuffle partitions."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // target_bytes))


def utf8_buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one uint8 array, with int64 offsets (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return flat, at - at[0]


def texts(column: pa.Array) -> list[str]:
    """The column's texts; a null is an empty text."""
    return [x if x is not None else "" for x in column.to_pylist()]


def ids(column: pa.Array) -> np.ndarray:
    """int64 ids; a null is NULL_ID."""
    return column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def id_array(values: np.ndarray) -> pa.Array:
    """The reverse of ids()."""
    return pa.array(values, pa.int64(), mask=values == NULL_ID)


def doc_crc(column: str = "doc_id"):
    """crc32 of an id's decimal text, as the folds of held-out rows take it."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
