"""What the operators share: stage tables, hot keys, row numbers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: White space of the contracts: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
#: A key counts as hot above this share of the rows, so there are fewer than 1/HOT_SHARE hot keys.
HOT_SHARE = 1 / 500
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local session (one machine) without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="llm-stage-")
    return _OWN[sc.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read again: cuts lineage and survives lost executors. Tables of whole texts take half the room with ``zstd``."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def join_hot(left: DataFrame, right: DataFrame, key: str, hot: Column, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` (one row a key) where a key may own a third of ``left``.

    ``hot`` marks the rows of ``right`` whose key is frequent in ``left``. It has to select a number
    of rows that does not grow with the data (a share of all rows); only those are broadcast. The
    other keys are joined by a shuffle.
    """
    few = F.broadcast(right.where(hot))
    keys = F.broadcast(right.where(hot).select(key))
    rest = left.join(keys, key, "left_anti").join(right.where(~hot), key, how)
    return left.join(few, key, "inner").select(*rest.columns).unionByName(rest)


def number_rows(df: DataFrame, group: str, order: list[Column], name: str, total: int, rows_per_chunk: int = 50_000) -> DataFrame:
    """Number the rows of each group from 0, gapless, without a window over a whole group.

    Rows are ordered by the first 32 bits of a hash (MD5) of the first of ``order``, then by ``order``. Chunks are ranges of that hash,
    so their number (from ``total``) decides how the work is cut but not the order. Each window
    covers one chunk of one group; the chunks' first numbers come from running sums of chunk counts.
    Rows that are equal in ``order`` share a chunk (as do those without the first) and are numbered in any order among themselves.
    ``group`` must not be null.
    """
    chunks = max(1, -(-total // rows_per_chunk), min(64, -(-total // 500)))  # few rows are spread, too
    prefix = F.conv(F.substring(F.md5(order[0].cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    keyed = df.withColumn("_hash", F.coalesce(prefix, F.lit(0))).withColumn("_chunk", F.shiftright(F.col("_hash") * chunks, 32))
    counts = keyed.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long")).drop("_n")
    inside = Window.partitionBy(group, "_chunk").orderBy("_hash", *order)
    numbered = keyed.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
    starts = starts.withColumnsRenamed({group: "_g", "_chunk": "_c"})
    joined = numbered.join(starts, (F.col(group) == F.col("_g")) & (F.col("_chunk") == F.col("_c")))
    return joined.withColumn(name, F.col("_start") + F.col("_row")).drop("_g", "_c", "_chunk", "_row", "_start", "_hash")
