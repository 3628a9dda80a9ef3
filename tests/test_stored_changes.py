import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill import schemas as S
from ledgermill.operators import changes
from ledgermill.plans import reports
from ledgermill.sources import keyed_tables, sinks
from ledgermill.sources.tables import LedgerTables

CLOCK = dt.datetime(2024, 6, 1, 12)
MAY, JUNE = dt.date(2024, 5, 1), dt.date(2024, 6, 1)
MERCHANTS = "mid string, dba string, is_referred int, agent1_name string, agent1_split decimal(5,2), agent2_name string, agent2_split decimal(5,2)"


def line(date, mid, house, iso="Alpha"):
    return (date, iso, mid, "d", Decimal(1), Decimal(1), Decimal(house), None, None, None, None, None, None, "me", CLOCK)


def stored(spark, folder, rows):
    sinks.append_ledger(spark.createDataFrame(rows, S.LEDGER_SCHEMA), f"{folder}/revenue")
    return f"{folder}/revenue"


def houses(df):
    return sorted((r.date, r.mid, int(r.house_residual)) for r in df.collect())


def test_all_results_of_a_stored_change_stay_readable(spark, folder):
    path = stored(spark, folder, [line(MAY, "1", 5), line(MAY, "2", 6), line(JUNE, "1", 7)])
    keys = spark.createDataFrame([(MAY, "Alpha"), (JUNE, "Nobody"), (None, "Alpha")], "date date, iso string")
    first = sinks.delete_partner_months(spark, keys, path, f"{folder}/audit", "me")
    again = sinks.delete_partner_months(spark, keys, path, f"{folder}/audit", "me")
    assert sorted((str(r.date), r.iso) for r in first.collect()) == [("2024-06-01", "Nobody"), ("None", "Alpha")]
    assert sorted((str(r.date), r.iso) for r in again.collect()) == [("2024-05-01", "Alpha"), ("2024-06-01", "Nobody"), ("None", "Alpha")]
    assert houses(sinks.read_ledger(spark, path)) == [(JUNE, "1", 7)]
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/audit").collect()] == [(MAY, "Alpha", "me")]


def test_stored_edits_touch_their_months_only(spark, folder):
    path = stored(spark, folder, [line(MAY, "1", 5), line(MAY, "2", 6), line(JUNE, "1", 7)])
    june = {f for f in sinks.read_ledger(spark, path).inputFiles() if "2024-06" in f}
    edits = spark.createDataFrame([line(MAY, "9", 50), line(MAY, "8", 50)], S.LEDGER_SCHEMA).withColumns({
        "seq": F.col("mid").cast("long"), "old_mid": F.when(F.col("mid") == "9", "1").otherwise("8")}).drop("updated_by", "updated_at")
    done = sinks.update_ledger(spark, edits, path, updated_by="editor")
    assert houses(done.table) == [(MAY, "2", 6), (MAY, "9", 50), (JUNE, "1", 7)]
    assert [(r.mid, r.reason) for r in done.refused.collect()] == [("8", "not_found")]
    assert june <= set(done.table.inputFiles())
    left = sinks.delete_lines(spark, spark.createDataFrame([(MAY, "Alpha", "9"), (MAY, "Alpha", "2"), (JUNE, "Alpha", "5")], "date date, iso string, mid string"), path)
    assert houses(sinks.read_ledger(spark, path)) == [(JUNE, "1", 7)]
    assert [(r.mid, r.reason) for r in left.refused.collect()] == [("5", "not_found")]


def test_change_log_names_the_months_to_read(spark, folder):
    def stamped(date, mid, at):
        return (*line(date, mid, 5)[:-1], at)
    path, log = f"{folder}/revenue", f"{folder}/log"
    rows = [stamped(MAY, "1", dt.datetime(2024, 5, 20)), stamped(JUNE, "2", dt.datetime(2024, 6, 20, 1)), stamped(dt.date(2024, 7, 1), "3", dt.datetime(2024, 7, 2)), stamped(JUNE, "4", None)]
    sinks.append_ledger(spark.createDataFrame(rows, S.LEDGER_SCHEMA), path, log)
    edits = spark.createDataFrame([line(MAY, "1", 50)], S.LEDGER_SCHEMA).withColumns({"seq": F.lit(1), "old_mid": F.col("mid")}).drop("updated_by", "updated_at")
    sinks.update_ledger(spark, edits, path, "editor", dt.datetime(2024, 7, 1, 8), log)
    tables = LedgerTables(**{f: None for f in LedgerTables.__dataclass_fields__} | {"revenue": sinks.read_ledger(spark, path)})
    seen = sinks.read_change_log(spark, log)
    got = reports.recent_changes(tables, "2024-07-02 12:00:00", 7, seen)
    assert [r.mid for r in got.collect()] == ["3", "1"]
    assert [r.mid for r in reports.recent_changes(tables, "2024-07-02 12:00:00", 7).collect()] == ["3", "1"]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [date" in plan and "2024-06-01" not in plan.split("PartitionFilters")[1].split("]")[0]
    assert reports.recent_changes(tables, "2030-01-01 00:00:00", 1, seen).count() == 0


def test_keyed_table_rewrites_touched_buckets(spark, folder):
    table = spark.createDataFrame([(str(k), "old", 0, None, None, None, None) for k in range(200)], MERCHANTS)
    path, keys = f"{folder}/merchants", ["mid"]
    keyed_tables.write_keyed(table, path, keys, 16)
    before = set(keyed_tables.read_keyed(spark, path, table.schema, 16).inputFiles())
    edits = spark.createDataFrame([(1, "7", "new", 1, "Ann", Decimal("1.50"), None, None), (2, "500", "added", 0, "Bob", None, None, None), (3, None, "x", 0, None, None, None, None)], f"seq long, {MERCHANTS}")
    read = []

    def make(part):
        read.append(part)
        return changes.merchants_upsert(part, edits)

    done = keyed_tables.change_keyed(spark, path, table.schema, keys, edits, make, 16)
    assert {r.mid: (r.dba, r.agent1_name) for r in done.table.collect() if r.dba != "old"} == {"7": ("new", "Ann"), "500": ("added", None)}
    assert done.table.count() == 201 and [r.reason for r in done.refused.collect()] == ["missing_fields"]
    after = set(done.table.inputFiles())
    touched = {f.split("bucket=")[1].split("/")[0] for f in before - after}
    assert 1 <= len(touched) <= 3 and len(before & after) >= 13
    plan = read[0]._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [bucket" in plan and " IN (" in plan.split("PartitionFilters")[1]


def test_emptied_bucket_and_empty_batch(spark, folder):
    table = spark.createDataFrame([("1", "a", 0, None, None, None, None)], MERCHANTS)
    path = f"{folder}/merchants"
    keyed_tables.write_keyed(table, path, ["mid"], 4)
    drop = lambda ids: keyed_tables.change_keyed(spark, path, table.schema, ["mid"], ids, lambda part: changes.merchants_delete(part, ids), 4)
    none = spark.createDataFrame([], "mid string")
    assert drop(none).table.count() == 1
    done = drop(spark.createDataFrame([("1",), ("2",)], "mid string"))
    assert done.table.count() == 0 and [(r.mid, r.reason) for r in done.refused.collect()] == [("2", "not_found")]


def test_numbered_rows_follow_the_whole_table(spark, folder):
    table = spark.createDataFrame([(k, f"Iso {k}", "MID", 1) for k in range(1, 30)], "id int, iso string, referral_type string, is_active int")
    path = f"{folder}/iso"
    keyed_tables.write_keyed(table, path, ["id"], 4)
    edits = spark.createDataFrame([(1, None, "New", "MID", 1), (2, 3, "Three", "MID", 0), (3, 99, "None", "MID", 1), (4, 0, "Newer", "Gateway", 1)], "seq long, id int, iso string, referral_type string, is_active int")
    done = keyed_tables.change_numbered(spark, path, table.schema, lambda whole: changes.iso_upsert(whole, edits), 4)
    assert {r.id: r.iso for r in done.table.filter(~F.col("iso").startswith("Iso")).collect()} == {3: "Three", 30: "New", 31: "Newer"}
    assert done.table.count() == 31 and [(r.id, r.reason) for r in done.refused.collect()] == [(99, "not_found")]
