"""Writing the ledger."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.changes import LEDGER_KEYS, Changed, iso_month_delete, ledger_delete, ledger_update
from ledgermill.schemas import LEDGER_COLUMNS, LEDGER_SCHEMA

SALTS = 64


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``. Only a session in which one
    machine does everything may leave it unset; it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="ledgermill-")
    return _LOCAL[sc.applicationId]


def _delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class StagedTables:
    """Writes intermediate tables below a folder and reads them back, so that later steps neither
    recompute them nor lose them with an executor. ``drop`` removes them once results are stored."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.run = spark, f"{folder}/stage-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        writer = df.write.mode("error")
        if name == "grid":
            writer = writer.partitionBy("family")
        writer.parquet(f"{self.run}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.run}/{name}").select(*df.columns)

    def drop(self) -> None:
        _delete_folder(self.spark, self.run)


def stage_in(spark: SparkSession, folder: str) -> StagedTables:
    return StagedTables(spark, folder)


def _spread(rows: DataFrame) -> DataFrame:
    """Rows clustered by merchant inside each month. A month, or a merchant, of any size is cut
    into several ranges: the hash of the whole row breaks ties between equal keys."""
    salt: Column = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    keys = [F.col("date"), F.col("mid"), salt]
    return rows.repartitionByRange(*keys).sortWithinPartitions("date", "mid")


def log_changes(rows: DataFrame, log_path: str) -> None:
    """Note which months have lines stamped on which day; the log is partitioned by day. It is written before the lines, so it never misses
    one; a month noted in vain costs a reading only."""
    days = rows.filter("updated_at IS NOT NULL").select(F.to_date("updated_at").alias("changed_on"), "date").distinct()
    days.repartition("changed_on").write.mode("append").partitionBy("changed_on").parquet(log_path)


def read_change_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema("date date, changed_on date").parquet(log_path)


def append_ledger(rows: DataFrame, path: str, log_path: str | None = None) -> None:
    """Add rows as one commit; the ledger is partitioned by ``date``. With ``log_path`` the change log is kept."""
    if log_path:
        log_changes(rows, log_path)
    _spread(rows.select(*LEDGER_COLUMNS)).write.mode("append").partitionBy("date").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).select(*LEDGER_COLUMNS)


def rewrite_months(table: DataFrame, touched: DataFrame, path: str) -> None:
    """Replace the partitions of the months in ``touched`` by their rows in ``table``.

    Other months are left alone; the partition of a month that lost all its rows is removed.
    """
    months = touched.select("date").distinct()
    rows = table.join(months, "date", "left_semi").select(*LEDGER_COLUMNS)
    # calendar months, asked for before their files change
    emptied = [r["date"] for r in months.join(rows.select("date").distinct(), "date", "left_anti").collect() if r["date"]]
    _spread(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date"
    ).parquet(path)
    for month in emptied:
        _delete_folder(table.sparkSession, f"{path.rstrip('/')}/date={month.isoformat()}")


def change_ledger(spark: SparkSession, path: str, edits: DataFrame, make: Callable[[DataFrame, DataFrame], Changed], audit_path: str | None = None) -> Changed:
    """Apply a batch of edits to the stored ledger and return what came of it, to be read at any time later.

    The edits are stored before all else: they are looked at several times, and deriving them may cost more than applying them. Then the plan is stored, below the shared folder: the new lines of the months in ``edits``, what is refused and the audit. Then the audit is
    appended, and the months are replaced from the plan, which no longer depends on the files it replaces. Other months are neither read nor written.
    A job that breaks off and runs again finds what is left to do, and adds a second audit only for that.
    """
    stage = stage_in(spark, shared_folder(spark))
    edits = stage(edits, "edits")
    months = [r["date"] for r in edits.select("date").distinct().collect() if r["date"]]  # calendar months
    done = make(read_ledger(spark, path).filter(F.col("date").isin(months) if months else F.lit(False)), edits)
    lines, refused = stage(done.table.select(*LEDGER_COLUMNS), "lines"), stage(done.refused, "refused")
    audit = None if done.audit is None else stage(done.audit, "audit")
    if audit is not None and audit_path:
        audit.write.mode("append").parquet(audit_path)
    rewrite_months(lines, edits.filter(F.col("date").isNotNull()), path)
    return Changed(read_ledger(spark, path), refused, audit)


def update_ledger(spark: SparkSession, changes: DataFrame, path: str, updated_by: str | None = None, updated_at: dt.datetime | str | None = None, log_path: str | None = None) -> Changed:
    """Edit stored lines (see ``ledger_update``). With ``log_path`` the change log is kept."""
    if log_path and updated_at is not None:
        log_changes(changes.select("date", F.lit(str(updated_at)).cast("timestamp_ntz").alias("updated_at")), log_path)
    return change_ledger(spark, path, changes, lambda ledger, edits: ledger_update(ledger, edits, updated_by, updated_at))


def delete_lines(spark: SparkSession, keys: DataFrame, path: str) -> Changed:
    """Delete stored lines by (date, iso, mid)."""
    return change_ledger(spark, path, keys.select(*LEDGER_KEYS), ledger_delete)


def delete_partner_months(spark: SparkSession, keys: DataFrame, path: str, audit_path: str, deleted_by: str) -> DataFrame:
    """Delete the (date, iso) pairs in ``keys`` from the stored ledger and store the audit rows. Returns the refused keys."""
    return change_ledger(spark, path, keys.select("date", "iso"), lambda ledger, edits: iso_month_delete(ledger, edits, deleted_by), audit_path).refused


def write_version(table: DataFrame, root: str) -> str:
    """Write the whole table to a fresh folder below ``root`` and return it."""
    path = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    append_ledger(table, path)
    return path
