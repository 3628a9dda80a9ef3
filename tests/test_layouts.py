import datetime as dt

import pytest
from helpers import grid, lines
from pyspark.sql import functions as F

from ledgermill.operators import extract, grids, identity
from ledgermill.operators.column_blocks import column_blocks
from ledgermill.operators.form_sheets import form_per_sheet
from ledgermill.sources.registry import parse_registry

REGISTRY = '''{"Alpha Pay": {"iso": "Alpha", "mapping": {"mid": "Merchant ID", "dba": "Merchant", "volume": "Sales", "total_residual": "", "own": "Net"}},
 "Beta": {"iso": "Beta", "mid": "MID", "dba": "Name", "own": "Payout"}, "Gamma": {"iso": "Gamma"}}'''


@pytest.fixture
def registry(spark):
    return parse_registry(spark.createDataFrame([(REGISTRY,)], "value string"), house_key="own")


def test_registry_forms(registry):
    rows = {(r.layout, r.target): (r.ordinal, r.source) for r in registry.collect()}
    assert rows[("Alpha Pay", "house_residual")] == (0, "Net")
    assert rows[("Beta", "mid")] == (1, "MID")
    assert rows[("Gamma", None)] == (2, None)


def test_generic(spark, registry):
    g = grid(spark, {"S": [["Report"], [None, "Merchant ID", "Merchant", "Sales", "Net"], [None, "1-2", "A", "$1,234.501", "(12.30)"],
                           [None, "Total", None, "9", "9"], [None, 77, "B", None, "0.07"]]})
    out = lines(extract.read_layout(g.withColumn("layout", F.lit("Alpha Pay")), "generic", registry))
    assert out == [("1-2", "A", 1234.51, 0.0, 0.0, None), ("77", "B", 0.0, 0.0, 0.08, None)]


def test_generic_repeated_header_is_refused(spark, registry):
    g = grid(spark, {"S": [["Merchant ID", "Merchant", "Sales", "Net", "Net"], ["1", "A", "1", "1", "1"]]})
    out = lines(extract.read_layout(g.withColumn("layout", F.lit("Alpha Pay")), "generic", registry))
    assert [o[-1] for o in out] == ["duplicate_column"]


def test_missing_column_is_refused(spark):
    g = grid(spark, {"S": [["MID", "MERCHANT", "NET SALES"], [1, "A", 2.0]]})
    assert [o[-1] for o in lines(extract.read_layout(g, "split_70"))] == ["missing_columns"]


def test_net_collections(spark):
    g = grid(spark, {"S": [["MID", "Reference ID", "Collection Attempts", "Collection Returns/Subsidized Fees"],
                           [1, None, 10.0, -4.0], [1, "A", 5.0, 1.0], [None, "x", 1.0, 1.0], [2, "B", None, None]]})
    assert lines(extract.read_layout(g, "net_collections")) == [("1", "A", 0.0, 0.0, 10.0, None), ("2", "B", 0.0, 0.0, 0.0, None)]


def test_multi_sheet_priority_and_labels(spark):
    g = grid(spark, {"EMS_OR": [["MID", "DBA", "BC Volume", "Volume", "Total", "Partner %2"], [5, "A", 1.0, 2.0, 3.0, 4.0], ["6", "text id", 1.0, 1.0, 1.0, 1.0]],
                     "Other": [["MID"], [9]]}).withColumn("iso", F.lit("Cloud"))
    out = extract.read_layout(g, "multi_sheet")
    assert lines(out) == [("5", "A", 2.0, 3.0, 4.0, None)]
    assert out.first().iso == "Cloud EMS OR"


def test_first_valid_sheet_stops_at_first(spark):
    head = ["Merchant Identifier", "DBA", "Volume", "Revenue", "Commission"]
    g = grid(spark, {"a": [["x"]], "b": [head, ["1", "A", "($1,000.00)", "2", "3"], [7, "number", "1", "1", "1"]], "c": [head, ["2", "B", "1", "1", "1"]]})
    assert lines(extract.read_layout(g, "first_valid_sheet")) == [("1", "A", -1000.0, 2.0, 3.0, None)]


def test_payout_period(spark):
    head = ["Partner ID", "Referred Merchant Company Name", "Gross Processing Volume", "Total Payout (less delivery)", "Commission Payout Date"]
    g = grid(spark, {"CSV": [["t"], head, ["9", "A", "$1,000.50", "5", "2024-05-03"], ["9", "B", "bad", "1.25", "5/31/2024"],
                             ["9", "C", "1", "1", "2024-06-01"], ["8", "D", "1", "1", "soon"], ["7", "E", "1", "1", None], [None, "Total", "1", "1", "all"]]}, path="Some Co May 2024.csv")
    assert [(o[0], *o[2:]) for o in lines(extract.read_layout(g, "payout_period"))] == [("9", 1000.5, 0.0, 6.25, None), ("8", 1.0, 0.0, 1.0, "unreadable_date")]
    days = ["05/31/2024 12:00:00 AM", "2024/05/31", "20240531", "31 May 2024", "May 30, 2024", "May 3, 2024 10:15", "2024-05-31T00:00:00Z", "3-May-24", "5-31-2024"]
    g = grid(spark, {"CSV": [head, *[[str(k), "A", "1", "1", day] for k, day in enumerate(days)]]}, path="Some Co May 2024.csv")
    assert [o[0] for o in lines(extract.read_layout(g, "payout_period")) if o[-1] is None] == [str(k) for k in range(len(days))]
    late = grid(spark, {"CSV": [head, ["9", "A", "1", "1", "2024-05-03"]]}, path="Some Co.csv")
    assert [o[-1] for o in lines(extract.read_layout(late, "payout_period"))] == ["no_period_in_name"]


def test_active_sheet_last_duplicate_and_blank_id(spark):
    head = ["Merchant ID", " Merchant Name", "P Volume", "Net Income", "Agent Residual", "Net Income"]
    g = grid(spark, {"a": [["x"]], "b": [head, ["1", "A", "1", "2", "=X", "4"], [None, "no id", "1", "1", "1", "1"], [None] * 8 + ["note"]]}, active=1)
    assert lines(extract.read_layout(g, "active_sheet")) == [("1", "A", 1.0, 4.0, 0.0, None), (None, "no id", 1.0, 1.0, 1.0, "no_merchant_id")]


def test_form_per_sheet(spark):
    form = [["Mid# 55"], ["Merchant : Shop"], [None, "Per Transaction"], [None, 0.1], [None, "12.345"], ["Total Commissions due", "(5.00)"]]
    g = grid(spark, {"one": form, "two": [["nothing"]], "three": [["Mid# 56"], ["Total Commissions due", "7"]]})
    assert lines(form_per_sheet(g)) == [("55", "Shop", round(12.345, 2), 0.0, -5.0, None), ("56", None, None, 0.0, 7.0, "unreadable_amount")]


def test_column_blocks(spark):
    a, b = "635400000000001", "635400000000002"
    heads = ["Merchant COUNT/Amount", "Gross Total", "ISO Payout"]
    sheet = [["x"], ["x"], ["x"], [None, "A", None, None, "B"], [None, a, a, None, b, None, None, b], [None, *heads, *heads],
             ["Visa/MC/Discover Interchange Dues", 10, 1, None, 20, 2], ["Total Income", None, 100], ["NET residuals for payout", None, None, 7, None, None, 8, None]]
    out = lines(column_blocks(grid(spark, {"s": [["x"]], "d": sheet})))
    # the second id of block A is covered by it; the id in the last column starts nothing
    assert out == [(a, "A", 10.0, 1.0, 7.0, None), (b, "B", 20.0, 2.0, 8.0, None)]


def test_identity(spark, registry):
    names = ["Alpha Pay May2024.xls", "alpha  pay_Sept_2024 residuals.csv", "Alphapay Jun 2024.csv", "Delta May 2024.csv",
             "Alpha Pay Foo 2024.csv", "Alpha Pay.csv", "ABCMay2024.csv"]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    rules = [identity.Rule("equals", "Alpha", "split_70"), identity.Rule("contains", "Al", "paynote")]
    got = {r.path: (r.iso, r.date, r.family, r.error) for r in identity.identify(files, registry, rules).collect()}
    assert got[names[0]] == ("Alpha", dt.date(2024, 5, 1), "split_70", None)
    assert got[names[1]] == ("Alpha", dt.date(2024, 9, 1), "split_70", None)
    assert got[names[2]][:2] == ("Alpha", dt.date(2024, 6, 1))
    assert got[names[3]][3] == "no_matching_layout" and got[names[4]][3] == "invalid_month"
    assert got[names[5]][3] == "filename_format" and got[names[6]][3] in ("no_matching_layout", "invalid_month")


def test_hot_sheet_is_not_collected(spark):
    """One sheet with nearly all rows still joins by header row, without a window or a list."""
    g = grid(spark, {"S": [["MID", "MERCHANT", "NET SALES", "SPLIT TO RAC - 70%", "SPLIT TO AGENT - 70%"], [1, "A", 1.0, 1.0, 1.0]]})
    plan = extract.read_layout(g, "split_70")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan
    assert grids.to_cells(g).count() == 10
