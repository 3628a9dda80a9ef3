"""Statements from files: one batch over a folder, or a stream of arriving files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgermill.operators import identity
from ledgermill.operators.load import LoadResult, Stage, load_statements
from ledgermill.schemas import LEDGER_COLUMNS
from ledgermill.sources import csv_cells, sinks, workbook_cells
from ledgermill.sources.tables import LedgerTables

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _grid(files: DataFrame) -> DataFrame:
    """Grid rows of the CSV and XLSX files of a batch. CSV files are read in splits, as in
    ``load_folder``; the batch only names them (``files_per_batch`` at most)."""
    books = workbook_cells.workbook_grid(files.filter(F.lower("path").endswith(".xlsx")).select("path", "content"))
    named = [r["path"] for r in files.filter(F.lower("path").endswith(".csv")).select("path").collect()]
    return csv_cells.read_csv_grid(files.sparkSession, named).unionByName(books) if named else books


def load_folder(
    spark: SparkSession, folder: str, registry: DataFrame, tables: LedgerTables,
    updated_by: str, updated_at: dt.datetime | str, rules: Iterable[identity.Rule] = (),
    stage: Stage | None = None, **options,
) -> LoadResult:
    """Load every CSV and XLSX statement below ``folder``. Nothing is written to the ledger yet."""
    files = csv_cells.list_files(spark, folder, csv_cells.STATEMENT_NAMES)
    names = identity.identify(files.select("path"), registry, rules)
    grid = csv_cells.read_csv_grid(spark, folder).unionByName(
        workbook_cells.read_workbook_grid(spark, folder)
    )
    return load_statements(grid, names, registry, tables, updated_by, updated_at, stage=stage, **options)


class BatchLog:
    """What a stream decided about its batches: for each, the rows to load and what is refused.

    A decision is stored before anything else is written, so a batch that runs again after a failure does
    what was decided the first time instead of judging its statements against a ledger that may hold them by now.
    Empty marker files say how far a batch has come. Batches are kept apart by stream: a stream
    that starts over with a new checkpoint numbers its batches from 0 again.
    """

    TABLES = ("rows", "lines", "statements")

    def __init__(self, spark: SparkSession, root: str, stream: str, batch_id: int):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/stream={stream}/batch={batch_id}"

    def _marker(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def has(self, name: str) -> bool:
        system, path = self._marker(name)
        return system.exists(path)

    def mark(self, name: str) -> None:
        system, path = self._marker(name)
        system.create(path, True).close()

    def decide(self, result: LoadResult) -> None:
        for name in self.TABLES:
            getattr(result, name).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self.mark("DECIDED")

    def decided(self) -> LoadResult:
        return LoadResult(**{name: self.spark.read.parquet(f"{self.folder}/{name}") for name in self.TABLES})


def _not_yet_there(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The decided rows that a broken append has not stored. The ledger had no line of their
    partners and months before, so what it has of them now came from that append."""
    rows = rows.select(*LEDGER_COLUMNS)
    ends = [rows.agg(f("date")).scalar() for f in (F.min, F.max)]
    own = ledger.filter(F.col("date").between(*ends)).join(rows.select("date", "iso").distinct(), ["date", "iso"], "left_semi")
    return rows.exceptAll(own.select(*LEDGER_COLUMNS))


def load_stream(
    spark: SparkSession, folder: str, ledger_path: str, rejects_path: str, registry: DataFrame,
    tables: Callable[[], LedgerTables], updated_by: str, rules: Iterable[identity.Rule] = (),
    clock: Callable[[], dt.datetime] = dt.datetime.now, files_per_batch: int = 1000,
    change_log: str | None = None, **options,
) -> DataStreamWriter:
    """Append statements to the ledger as files arrive.

    A batch is decided once; the decision is stored next to ``rejects_path`` and replayed if the batch
    runs again after a failure, wherever it broke off. A replay appends only the decided rows that the ledger lacks, and
    gives the same refused statements and lines. The ledger and the refusals are written per batch. Months may arrive in
    any order. The caller sets the checkpoint location and the trigger, and starts the returned writer.
    With ``change_log`` the change log by day is kept.
    """
    rule_list = list(rules)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        log = BatchLog(spark, f"{rejects_path.rstrip('/')}-log", stream, batch_id)
        replay = log.has("DECIDED")
        if not replay:
            names = identity.identify(batch.select("path"), registry, rule_list)
            stage = sinks.stage_in(spark, sinks.shared_folder(spark))
            log.decide(load_statements(_grid(batch), names, registry, tables(), updated_by, clock(), stage=stage, **options))
            stage.drop()
        decision = log.decided()
        decision.statements.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        decision.lines.write.mode("overwrite").parquet(f"{rejects_path}-lines/batch={batch_id}")
        if not log.has("APPENDED"):
            rows = _not_yet_there(decision.rows, tables().revenue) if replay else decision.rows
            sinks.append_ledger(rows, ledger_path, change_log)
            log.mark("APPENDED")

    files = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch).load(folder)
    )
    return files.writeStream.foreachBatch(load)
