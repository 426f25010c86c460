"""Helpers of the operator modules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized_broadcast(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows, else df itself (a shuffle join, split by AQE where skewed)."""
    return F.broadcast(df) if len(df.select(F.lit(1)).take(rows + 1)) <= rows else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir); deleted when the session's JVM ends.

    Where the setting is missing, local mode takes a temporary folder and a cluster its default file system; a cluster
    whose default is its machines' own disks is refused.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        default = context._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        if context.master.startswith("local"):
            folder = "file://" + tempfile.mkdtemp(prefix="varqa-")
        elif default.startswith("file:"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            folder = f"{default.rstrip('/')}/tmp/varqa-{context.applicationId}"
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/varqa/{name}-{uuid.uuid4().hex}"
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back."""
    path = shared_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_positions(df: DataFrame, name: str, *order: str) -> DataFrame:
    """df with `name`, each row's position from 0 in the order of the columns, without one task that sorts all.

    Only the columns of the order are dealt out by ranges and written (the ranges must not be drawn anew); a range's sums
    go on from those before it. The first position of equal ones then goes in front of their rows, which are shuffled
    once, without the columns that nobody asks for, and follow one another by a hash of the row.
    """
    mark = "_"
    while any(c.startswith(mark) for c in df.columns):
        mark += "_"
    own, tie, first = [f"{mark}k{i}" for i in range(len(order))], f"{mark}tie", f"{mark}first"
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = F.xxhash64(*[c for c, (_, t) in zip(columns, df.dtypes) if "map<" not in t])
    rows = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(order, own)], F.lit(None).cast("long").alias(first), hashed.alias(tie), *columns)
    keys = rows.groupBy(*own).agg(F.count("*").alias("c"))
    dealt = cut_lineage(keys.repartitionByRange(*own).withColumn("part", F.spark_partition_id()))
    here = dealt.withColumn("here", F.sum("c").over(Window.partitionBy("part").orderBy(*own)) - F.col("c"))
    sums = dealt.groupBy("part").agg(F.sum("c").alias("n"))  # one row for each range
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    ahead = here.join(F.broadcast(before), "part").select(*own, (F.col("before") + F.col("here")).alias(first), F.lit(None).cast("long").alias(tie), *nothing)
    turn = Window.partitionBy(*own).orderBy(F.col(first).isNull(), tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.union(ahead).withColumn(f"{mark}n", F.first(first).over(turn) + F.row_number().over(turn) - 2)
    return placed.where(F.col(first).isNull()).select(*columns, F.col(f"{mark}n").alias(name))


def ordered_list(value: Column, *order: Column) -> Column:
    """Aggregate: values in the given order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.alias("v")))), lambda x: x["v"])


# Fragments that the SQL of several modules shares: DuckDB's forms of the text functions.
SQL_WORDS = r"list_filter(string_split_regex(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'), lambda w: w <> '')"
SQL_LINES = r"list_transform(list_filter(string_split({0}, chr(10)), lambda x: trim(x) <> ''), lambda x: rtrim(x))"


def sql_words(column: str) -> str:
    return SQL_WORDS.format(column)


def sql_lines(column: str) -> str:
    return SQL_LINES.format(column)
