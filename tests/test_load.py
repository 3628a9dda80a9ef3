import datetime as dt
from decimal import Decimal

import pytest
from helpers import grid
from pyspark.sql import functions as F

from ledgermill import schemas as S
from ledgermill.operators import changes, identity, load
from ledgermill.plans import reports
from ledgermill.functions import dates
from ledgermill.sources import csv_cells, merchant_bulk, sinks, workbook_cells
from ledgermill.sources.registry import parse_registry
from ledgermill.sources.tables import LedgerTables
from ledgermill.streaming.statement_stream import load_folder, load_stream

REGISTRY = '''{"Alpha": {"iso": "Alpha", "mapping": {"mid": "ID", "dba": "Name", "volume": "Vol", "total_residual": "Tot", "house_residual": "Net"}},
 "Betamax": {"iso": "Betamax", "mapping": {"mid": "ID", "dba": "Name", "volume": "Vol", "total_residual": "Tot", "house_residual": "Net"}}}'''
HEAD = ["ID", "Name", "Vol", "Tot", "Net"]
CLOCK = dt.datetime(2024, 6, 1, 12)


@pytest.fixture
def registry(spark):
    return parse_registry(spark.createDataFrame([(REGISTRY,)], "value string"))


def tables(spark, revenue=None):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    merchant = S.MERCHANT_SCHEMA
    half, ten = Decimal("50.00"), Decimal("10.00")
    merchants = make([
        ("1", "One", None, "Alpha", None, None, None, None, None, 1, 1, "Ann", half, "Bob", Decimal("0.00")),
        ("2", "Two", None, "Alpha", None, None, None, None, None, 1, 0, "Ann", ten, None, None),
        ("3", "Three", None, "Alpha", None, None, None, None, None, 1, 1, "Ann", None, None, None),
        ("4", "Four", None, "Alpha", None, None, None, None, None, 1, 1, "Ann", ten, "Bob", ten),
    ], merchant)
    return LedgerTables(
        revenue=make([], S.LEDGER_SCHEMA) if revenue is None else revenue, merchants=merchants,
        iso=make([(1, "Alpha", "MID", 1)], S.ISO_SCHEMA), adjustments=make([], S.ADJUSTMENT_SCHEMA),
        payments=make([], S.PAYMENT_SCHEMA), sic_codes=make([], S.SIC_SCHEMA),
    )


def statements(spark, files):
    g = None
    for path, rows in files.items():
        part = grid(spark, {"S": [HEAD, *rows]}, path=path)
        g = part if g is None else g.unionByName(part)
    return g


def test_load_is_all_or_nothing_and_idempotent(spark, registry):
    g = statements(spark, {
        "Alpha May2024.csv": [["1", "x", "10", "3", "2.00"], ["1", "y", "1", "1", "0"], ["4", None, "1", "1", "5"]],
        "Alpha May 2024 copy.csv": [["2", "x", "1", "1", "1"]],
        "Betamax May2024.csv": [["2", "z", "1", "1", "1"], ["99", "q", "1", "1", "1"]],
        "Alpha Jun2024.csv": [["3", "x", "1", "1", "1"]],
        "Alpha Jul2024.csv": [["Total", "x", "1", "1", "1"]],
        "Alpha.csv": [["1", "x", "1", "1", "1"]],
    })
    names = identity.identify(g.select("path").distinct(), registry)
    out = load.load_statements(g, names, registry, tables(spark), "me", CLOCK)
    assert {r.path: r.reason for r in out.statements.collect()} == {
        "Alpha May2024.csv": "duplicate_in_batch", "Betamax May2024.csv": "statement_rejected",
        "Alpha Jun2024.csv": "statement_rejected", "Alpha Jul2024.csv": "no_lines", "Alpha.csv": "filename_format",
    }
    assert {(r.path, r.mid): r.reject for r in out.lines.collect()} == {
        ("Betamax May2024.csv", "2"): "statement_rejected", ("Betamax May2024.csv", "99"): "missing_merchant",
        ("Alpha Jun2024.csv", "3"): "missing_agent_split",
    }
    rows = out.rows.collect()
    assert [(r.iso, r.mid, r.dba, r.agent1_name, r.updated_by, r.updated_at) for r in rows] == [("Alpha", "2", "Two", None, "me", CLOCK)]

    again = load.load_statements(g, names, registry, tables(spark, out.rows), "me", CLOCK)
    assert again.rows.count() == 0
    reasons = {r.path: r.reason for r in again.statements.collect()}
    assert reasons["Alpha May2024.csv"] == reasons["Alpha May 2024 copy.csv"] == "already_loaded"


def test_payouts_and_names(spark, registry):
    g = statements(spark, {"Alpha May2024.csv": [["1", "x", "10", "3", "2.01"], ["1", "y", "1", "1", "0"], ["4", None, "1", "1", "5"], ["2", "n", "1", "1", "1"]]})
    names = identity.identify(g.select("path").distinct(), registry)
    out = load.load_statements(g, names, registry, tables(spark), "me", CLOCK)
    got = {(r.mid, r.dba): (r.agent1_payout, r.agent2_name, r.agent2_payout) for r in out.rows.collect()}
    assert got == {
        ("1", "One"): (Decimal("1.01"), "Bob", None), ("1", "y"): (Decimal("0.00"), "Bob", None),
        ("4", "Four"): (Decimal("0.50"), "Bob", Decimal("0.50")), ("2", "Two"): (None, None, None),
    }


def test_prefix_guard(spark):
    ledger = spark.createDataFrame([(dt.date(2024, 5, 1), "Alpha Two")], "date date, iso string")
    wanted = spark.createDataFrame([("a", dt.date(2024, 5, 1), "Alpha"), ("b", dt.date(2024, 5, 1), "Alpha Two B"), ("c", dt.date(2024, 5, 1), "")],
                                   "path string, date date, iso string")
    assert {r.path for r in load.already_loaded(wanted, ledger, "prefix").collect()} == {"a", "c"}
    assert load.already_loaded(wanted, ledger, "exact").count() == 0


def test_caseless_guard(spark, registry):
    ledger = spark.createDataFrame([(dt.date(2024, 5, 1), "ALPHA")], "date date, iso string")
    wanted = spark.createDataFrame([("a", dt.date(2024, 5, 1), "Alpha"), ("b", dt.date(2024, 6, 1), "alpha")], "path string, date date, iso string")
    assert [r.path for r in load.already_loaded(wanted, ledger, "caseless").collect()] == ["a"]
    assert load.already_loaded(wanted, ledger).count() == 0
    entries = spark.createDataFrame([(1, dt.date(2024, 5, 1), "alpha", 1.0), (2, dt.date(2024, 6, 1), "alpha", 1.0), (3, dt.date(2024, 6, 1), "Alpha", 1.0)],
                                    "seq int, date date, iso string, amount double")
    rows, refused = load.manual_revenue(entries, ledger, "me", CLOCK, match="caseless")
    assert [(r.iso, r.dba) for r in rows.collect()] == [("alpha", "alpha")]
    assert {(r.seq, r.iso, r.reason) for r in refused.collect()} == {(1, "alpha", "already_loaded"), (3, "Alpha", "duplicate_in_batch")}


def test_hot_merchant_first_line_only(spark):
    rows = [("p", 0, i, "1", f"n{i}", None) for i in range(2000)]
    lines = spark.createDataFrame(rows, "path string, sheet_idx int, row_idx bigint, mid string, dba string, reject string")
    out = load.override_dba(lines, tables(spark).merchants).filter("dba = 'One'").collect()
    assert [r.row_idx for r in out] == [0]


def test_number_rows_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(changes, "RANGES", 7)
    for step in (F.col("id") * 3, F.col("id") * F.col("id") * 1_700_000_000_000, F.lit(5) + F.col("id") % 2 * 1_000_000_000_000 + F.col("id")):
        rows = spark.range(100).select(step.alias("seq"))
        df = changes.number_rows(rows, spark.range(6).agg(F.max("id")), "id")
        assert [r.id for r in df.orderBy("seq").collect()] == list(range(6, 106))
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert all("_bucket" in line.split("windowspecdefinition")[1] for line in text.splitlines() if "windowspecdefinition" in line)


def test_changes_twice_equal_once(spark):
    t = tables(spark)
    edits = spark.createDataFrame([(1, 1, dt.date(2024, 5, 1), Decimal("5.00")), (2, 1, dt.date(2024, 5, 1), Decimal("6.00")), (3, 0, dt.date(2024, 5, 1), Decimal("1.00"))],
                                  f"seq int, iso_id int, date date, bank_amount {S.MONEY}")
    once = changes.payments_upsert(t.payments, edits)
    twice = changes.payments_upsert(once.table, edits)
    assert once.table.collect() == twice.table.collect() == [(1, dt.date(2024, 5, 1), Decimal("6.00"))]
    assert once.refused.count() == 1


CSV = '\ufeff"a","x ""q"", 1",NA\r\n\n  \n"multi\r\nline\rend",5" pipe,"t"\rlone,cr\n,,\n"",z,"tail"'
CELLS = [(0, 0, "a"), (0, 1, 'x "q", 1'), (1, 0, "multi\r\nline\rend"), (1, 1, '5" pipe'), (1, 2, "t"), (2, 0, "lone"), (2, 1, "cr"), (4, 1, "z"), (4, 2, "tail")]


def cells(df):
    return sorted((r.row_idx, c.col_idx, c.value) for r in df.collect() for c in r.cells)


def put(folder, name, data):
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)


@pytest.mark.parametrize("split", [7, 40, 1 << 20])
def test_csv_cells_for_any_split(spark, folder, split):
    put(folder, "a b%.csv", CSV.encode())
    put(folder, "UPPER.CSV", b"x,y\n1,2")
    put(folder, "latin.csv", "caf\xe9,1\n2,3\n".encode("latin-1"))
    put(folder, "open.csv", b'a,b\n"never,closed\n' + b"1,2\n" * 500)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = csv_cells.read_csv_grid(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.openCostInBytes", "262144")
    by_name = {}
    for r in rows:
        by_name.setdefault(r.path.rsplit("/", 1)[1], []).append(r)
    assert sorted((r.row_idx, c.col_idx, c.value) for r in by_name["a b%.csv"] for c in r.cells) == CELLS
    assert sorted(c.value for r in by_name["UPPER.CSV"] for c in r.cells) == ["1", "2", "x", "y"]
    assert [(r.sheet_idx, r.sheet, r.cells) for r in by_name["latin.csv"]] == [(-1, "not UTF-8", [])]
    assert [(r.sheet_idx, r.sheet, r.cells) for r in by_name["open.csv"]] == [(-1, "unclosed quote", [])]


def test_csv_content_is_parsed_alike(spark):
    files = spark.createDataFrame([("p", CSV.encode(), 5), ("q", b'"open', 6)], "path string, content binary, tag int")
    out = csv_cells.csv_grid(files)
    assert cells(out.filter("path = 'p'")) == CELLS
    assert [(r.path, r.sheet_idx, r.tag) for r in out.filter("sheet_idx < 0").collect()] == [("q", -1, 6)]


def test_broken_workbook_is_marked(spark):
    import io
    import zipfile

    def book(**parts):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, text in parts.items():
                z.writestr(name.replace("__", "/") + ".xml", text)
        return out.getvalue()

    files = spark.createDataFrame([("a.xlsx", b"no zip"), ("b.xlsx", b""), ("c.xlsx", book(xl__workbook="<workbook><sheets><sheet/></sheets></workbook>"))], "path string, content binary")
    got = {r.path: (r.sheet_idx, r.sheet) for r in workbook_cells.workbook_grid(files).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a.xlsx": -1, "b.xlsx": -1, "c.xlsx": -1} and all(v[1] for v in got.values())


def test_bulk_merchants(spark):
    def row(line, mid, **over):
        values = {c: None for c in merchant_bulk.BULK_COLUMNS} | {"mid": mid, **over}
        return (*values.values(), line)
    schema = ", ".join(f"{c} string" for c in merchant_bulk.BULK_COLUMNS) + ", line int"
    rows = spark.createDataFrame([row(1, "9", dba="first", sic_code="12345", approval_date="03/02/2020", closed_date="nope"), row(2, "9", dba="second"), row(3, "1", dba="known")], schema)
    new = merchant_bulk.add_merchants(tables(spark).merchants, rows).filter("mid in ('9', '1')").orderBy("mid").collect()
    assert [r.dba for r in new] == ["One", "first"]
    assert (new[1].sic_code, new[1].corporation, new[1].approval_date, new[1].closed_date, new[1].agent1_split) == ("1234", "None", dt.date(2020, 2, 3), None, Decimal("0.00"))


def test_bulk_merchants_from_files(spark, folder):
    """Splits smaller than a record, order by file and record number, odd notations, unreadable files."""
    head = ",".join(merchant_bulk.BULK_COLUMNS) + ",more\n"
    def line(mid, dba="d", closed="", extra=""):
        return f'{mid},"{dba}",,,,,,,,,1,0,,{closed},,{extra}\n'
    files = {
        "a.csv": head + line(1, "known") + "\n" + line(7, "a ""quote"", and\nbreak", '"Feb 3, 2001"', ",beyond") + line(8, "x" * 400, "20010203") + line(7, "later"),
        "b.csv": head + line(8, "later file") + line(9, "nine", "2024-05-31 00:00:00"), "c.csv": head, "d.csv": head + '10,"open\n',
    }
    for name, text in files.items():
        with open(f"{folder}/{name}", "w") as file:
            file.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        rows = merchant_bulk.read_merchant_csv(spark, folder)
        got = {r.mid: (r.dba, r.closed_date) for r in merchant_bulk.add_merchants(tables(spark).merchants, rows).collect()}
        assert [r.line.path[-5:] for r in rows.filter("problem is not null").collect()] == ["d.csv"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {k: got.get(k) for k in ("1", "7", "8", "9", "10")} == {
        "1": got["1"], "7": ("a quote, and\nbreak", dt.date(2001, 2, 3)), "8": ("x" * 400, dt.date(2001, 2, 3)), "9": ("nine", dt.date(2024, 5, 31)), "10": None}
    assert got["1"][0] == "One"


def test_days(spark):
    cases = {
        "2001-2-3": "2001-02-03", "20010203": "2001-02-03", "2/3/01": "2001-02-03", "2/3/70": "1970-02-03", "3-feb-2001": "2001-02-03", "3 February 2001": "2001-02-03",
        "FEBRUARY 3, 2001": "2001-02-03", "Feb 3 2001": "2001-02-03", "2001-02-03T10:00:00Z": "2001-02-03", "2/3/2001 1:00 pm": "2001-02-03", "2001-02-30": None,
        "3 Sept 2001": None, "1/2/3": None, "never": None, "": None, "2/3/2001x": None, "20011301": None, "Feb-3-2001": None,
    }
    df = spark.createDataFrame(list(cases.items()), "t string, d string")
    assert {r.t: r.d for r in df.select("t", dates.day(dates.without_time(df.t)).cast("string").alias("d")).collect()} == cases


def ledger_row(date, mid, house):
    return (date, "Alpha", mid, "d", Decimal(1), Decimal(1), Decimal(house), None, None, None, None, None, None, "me", CLOCK)


def test_share_of_the_unrounded_amount(spark):
    lines = spark.createDataFrame([("p", 0, 1, "1", "x", 1.0, 1.0, 2.345, None)],
                                  "path string, sheet_idx int, row_idx bigint, mid string, dba string, volume double, total_residual double, house_residual double, reject string")
    merchants = spark.createDataFrame([("1", "One", 1, "A", Decimal("50.00"), None, None)],
                                      f"mid string, dba string, is_referred int, agent1_name string, agent1_split {S.PERCENT}, agent2_name string, agent2_split {S.PERCENT}")
    for out in (load.check_lines(lines, merchants), load.agent_payouts(lines, merchants)):
        assert out.first().agent1_payout == Decimal("1.17")  # 1.1725


def test_deleted_months_stay_deleted(spark, folder):
    import os

    may, june = dt.date(2024, 5, 1), dt.date(2024, 6, 1)
    path = f"{folder}/revenue"
    sinks.append_ledger(spark.createDataFrame([ledger_row(may, "1", 1), ledger_row(may, "2", 1), ledger_row(june, "1", 2)], S.LEDGER_SCHEMA), path)
    keys = spark.createDataFrame([(may, "Alpha"), (may, "Beta")], "date date, iso string")
    for _ in range(2):
        refused = sinks.delete_partner_months(spark, keys, path, f"{folder}/audit", "me")
        spark.catalog.refreshByPath(path)
    assert [(r.date, r.mid) for r in sinks.read_ledger(spark, path).collect()] == [(june, "1")]
    assert not os.path.exists(f"{path}/date=2024-05-01") and refused.count() == 2
    assert [(r.date, r.iso) for r in spark.read.parquet(f"{folder}/audit").collect()] == [(may, "Alpha")]


def test_partner_with_labelled_names_is_known_again(spark, folder):
    may = dt.date(2024, 5, 1)
    label = load.SHEET_LABELS.get(next(iter(load.SHEET_CANDIDATES)), next(iter(load.SHEET_CANDIDATES)))
    row = (may, f"Alpha {label}", "1", "d", Decimal(1), Decimal(1), Decimal(1), None, None, None, None, None, None, "me", CLOCK)
    sinks.append_ledger(spark.createDataFrame([row], S.LEDGER_SCHEMA), f"{folder}/revenue")
    ledger = sinks.read_ledger(spark, f"{folder}/revenue")
    wanted = spark.createDataFrame([("a", may, "Alpha", "multi_sheet"), ("b", may, "Alpha", "generic"), ("c", dt.date(2024, 6, 1), "Alpha", "multi_sheet")],
                                   "path string, date date, iso string, family string")
    out = load.flag_loaded(wanted, ledger)
    assert {r.path: r.is_loaded for r in out.collect()} == {"a": True, "b": False, "c": False}
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "subquery" in [line for line in text.splitlines() if "PartitionFilters" in line and "revenue" in line][0].split("PushedFilters")[0].lower()


def test_rewrite_touches_only_its_months(spark, folder):
    may, june = dt.date(2024, 5, 1), dt.date(2024, 6, 1)
    path = f"{folder}/revenue"
    sinks.append_ledger(spark.createDataFrame([ledger_row(may, "1", 1), ledger_row(june, "1", 2)], S.LEDGER_SCHEMA), path)
    ledger = sinks.read_ledger(spark, path)
    edit = spark.createDataFrame([(1, may, "Alpha", "1", "7", "new", *[Decimal(9)] * 3, None, None, None, None, None, None)],
                                 f"seq int, date date, iso string, old_mid string, mid string, dba string, volume {S.MONEY}, total_residual {S.MONEY}, house_residual {S.MONEY}, "
                                 f"agent1_name string, agent1_percentage {S.PERCENT}, agent1_payout {S.MONEY}, agent2_name string, agent2_percentage {S.PERCENT}, agent2_payout {S.MONEY}")
    stamped = changes.ledger_update(ledger, edit, "you", "2025-01-01 00:00:00").table.collect()
    old = ledger.where("mid = '1' AND date = '2024-06-01'").first()
    assert {(r.mid, r.updated_by, r.updated_at) for r in stamped} == {("7", "you", dt.datetime(2025, 1, 1)), ("1", old.updated_by, old.updated_at)}
    sinks.rewrite_months(changes.ledger_update(ledger, edit).table, edit, path)
    spark.catalog.refreshByPath(path)
    got = {(r.date, r.mid): r.house_residual for r in sinks.read_ledger(spark, path).collect()}
    assert got == {(may, "7"): Decimal("9.00"), (june, "1"): Decimal("2.00")}


def test_one_month_prunes_partitions(spark, folder):
    path = f"{folder}/revenue"
    sinks.append_ledger(spark.createDataFrame([ledger_row(dt.date(2024, 5, 1), "1", 1)], S.LEDGER_SCHEMA), path)
    t = tables(spark, sinks.read_ledger(spark, path))
    for plan in (reports.volume_month(t, "2024-05-01"), reports.iso_month(t, "2024-05-01"), reports.mid_insights(t, "2024-05-01", "2024-07-01", "1")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date" in text or "PartitionFilters: [date" in text, text
        assert "CartesianProduct" not in text
    with pytest.raises(ValueError):
        reports.iso_lines(t, iso="Alpha")


def test_folder_and_stream(spark, registry, folder):
    inbox, path = f"{folder}/in", f"{folder}/revenue"
    import os
    os.mkdir(inbox)
    def put(name, house):
        with open(f"{inbox}/{name}", "w") as f:
            f.write(f"report\n\nID,Name,Vol,Tot,Net\n2,x,\"$1,000.50\",1,{house}\nTotal,,,,\n")
    put("Alpha May2024.csv", "1.50")
    once = load_folder(spark, inbox, registry, tables(spark), "me", CLOCK)
    assert [(r.mid, r.volume, r.house_residual) for r in once.rows.collect()] == [("2", Decimal("1000.50"), Decimal("1.50"))]

    sinks.append_ledger(once.rows.limit(0), path)
    put("Alpha Jun2024.csv", "2.50")
    def now():
        return tables(spark, sinks.read_ledger(spark, path) if os.path.exists(path) else None)
    for round_ in range(2):
        if round_ == 1:
            put("Alpha June 2024 again.csv", "9")
        writer = load_stream(spark, inbox, path, f"{folder}/rejects", registry, now, "me", clock=lambda: CLOCK)
        writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.date, r.house_residual) for r in sinks.read_ledger(spark, path).collect())
    assert got == [(dt.date(2024, 5, 1), Decimal("1.50")), (dt.date(2024, 6, 1), Decimal("2.50"))]
    assert [r.reason for r in spark.read.parquet(f"{folder}/rejects/batch=1").collect()] == ["already_loaded"]


@pytest.mark.parametrize("breaks", ["before append", "after append", "inside append"])
def test_broken_batch_is_replayed(spark, registry, folder, monkeypatch, breaks):
    """A batch that breaks off anywhere and runs again leaves the same ledger and the same refusals."""
    import os
    inbox, path = f"{folder}/in", f"{folder}/revenue"
    os.mkdir(inbox)
    for name, mids in (("Alpha May2024.csv", "2 2 4"), ("Alpha Jun2024.csv", "404"), ("Nobody.csv", "2")):
        with open(f"{inbox}/{name}", "w") as f:
            f.write("ID,Name,Vol,Tot,Net\n" + "".join(f"{m},x,10,1,1.50\n" for m in mids.split()))
    def now():
        return tables(spark, sinks.read_ledger(spark, path) if os.path.exists(path) else None)
    def run():
        writer = load_stream(spark, inbox, path, f"{folder}/rejects", registry, now, "me", clock=lambda: CLOCK)
        writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    append = sinks.append_ledger
    def broken(rows, *where):
        if breaks == "after append":
            append(rows, *where)
        elif breaks == "inside append":
            append(rows.limit(1), *where)
        raise RuntimeError("lost")
    monkeypatch.setattr(sinks, "append_ledger", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    refused = lambda: sorted((os.path.basename(r.path), r.reason) for r in spark.read.parquet(f"{folder}/rejects/batch=0").collect())
    first = refused()
    monkeypatch.setattr(sinks, "append_ledger", append)
    run()
    assert refused() == first and [reason for _, reason in first] == ["statement_rejected", "filename_format"]
    lines = sinks.read_ledger(spark, path).collect()
    assert sorted((r.date.month, r.mid, r.house_residual) for r in lines) == [(5, m, Decimal("1.50")) for m in ("2", "2", "4")]
    assert [r.reject for r in spark.read.parquet(f"{folder}/rejects-lines/batch=0").collect()] == ["missing_merchant"]
