"""Stored tables that are edited by key: merchants, partners, adjustments, payments.

A table is partitioned by a hash bucket of its key. A batch of edits reads and rewrites the buckets of its keys only; what has to be looked up in the
whole table (the highest id, taken months) reads those columns alone. The new buckets and the refused edits are stored below the shared folder before
anything is replaced, so they can be read at any time, and a batch that broke off can run again.

The number of buckets belongs to the table for good (its files lie below ``of-<buckets>``); choose it so that a bucket fits a few tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ledgermill.operators.changes import Changed, replace_rows
from ledgermill.sources.sinks import _delete_folder, shared_folder, stage_in

BUCKETS = 64


def _bucket(keys: Sequence[str], schema: StructType, buckets: int) -> Column:
    """A key's bucket, whatever type the edits give it."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _root(path: str, buckets: int) -> str:
    return f"{path.rstrip('/')}/of-{buckets}"


def _write(table: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    rows = table.withColumn("bucket", _bucket(keys, table.schema, buckets)).repartition("bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(_root(path, buckets))


def write_keyed(table: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Store a new table."""
    _write(table, path, keys, buckets)


def read_keyed(spark: SparkSession, path: str, schema: StructType, buckets: int = BUCKETS, only: Sequence[int] | None = None) -> DataFrame:
    """The stored table, or some buckets of it."""
    stored = spark.read.schema(StructType([*schema.fields]).add("bucket", IntegerType())).parquet(_root(path, buckets))
    if only is not None:
        stored = stored.filter(F.col("bucket").isin(list(only)) if only else F.lit(False))
    return stored.select(*schema.names)


def change_keyed(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], edits: DataFrame, make: Callable[[DataFrame], Changed], buckets: int = BUCKETS,
) -> Changed:
    """Apply edits whose outcome depends on the rows under their own keys only; ``edits`` has the key columns."""
    stage = stage_in(spark, shared_folder(spark))
    touched = [r["bucket"] for r in edits.select(_bucket(keys, schema, buckets).alias("bucket")).distinct().collect()]  # at most ``buckets`` numbers
    done = make(read_keyed(spark, path, schema, buckets, touched))
    rows, refused = stage(done.table.select(*schema.names), "rows"), stage(done.refused, "refused")
    left = {r["bucket"] for r in rows.select(_bucket(keys, schema, buckets).alias("bucket")).distinct().collect()}
    _write(rows, path, keys, buckets)
    for bucket in set(touched) - left:
        _delete_folder(spark, f"{_root(path, buckets)}/bucket={bucket}")
    return Changed(read_keyed(spark, path, schema, buckets), refused)


def change_numbered(spark: SparkSession, path: str, schema: StructType, make: Callable[[DataFrame], Changed], buckets: int = BUCKETS) -> Changed:
    """Apply edits that need the whole table to be judged and numbered (``Changed.rows``); only the buckets of their ids are rewritten."""
    stage = stage_in(spark, shared_folder(spark))
    done = make(read_keyed(spark, path, schema, buckets))
    rows, refused = stage(done.rows, "rows"), stage(done.refused, "refused")
    return change_keyed(spark, path, schema, ["id"], rows, lambda table: Changed(replace_rows(table, rows, "id"), refused), buckets)
