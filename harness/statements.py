"""Statement grids written from the derived ledger, one writer per layout.

Every writer puts the whole ledger into its layout: one statement per partner and month (or
per line, for the two form-like layouts), with title rows, total rows and the awkward cases a
layout must survive. ``pos`` numbers the lines of a statement by merchant, so no ordering
window is needed to place them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harness.views import Views
from ledgermill.sources import sinks

TOKENS = ["Jan", "February", "Mar", "April", "May", "June", "Jul", "August", "Sept", "October", "Nov", "December"]
FULL = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
        "October", "November", "December"]
CELLS = "array<struct<col_idx:int,value:string,kind:string>>"
LAST = 9_000_000_000


def _strings(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def derive_once(v: Views) -> None:
    """Write the view's ledger to the shared folder: it is a join and a sum of the two largest tables, which every use of it would repeat."""
    if "_ledger_written" not in v.__dict__:
        v.__dict__.update(revenue=sinks.stage_in(v.spark, sinks.shared_folder(v.spark))(v.revenue, "view"), _ledger_written=True)
        v.__dict__.pop("tables", None)


def lines(v: Views) -> DataFrame:
    """Ledger lines with the statement they belong to."""
    month = F.month("date")
    style = month % 3
    year = F.year("date").cast("string")
    path = F.concat(
        "iso", F.when(style == 0, "_").otherwise(" "), F.element_at(_strings(TOKENS), month),
        F.when(style == 0, "_").when(style == 1, "").otherwise(" "), year,
        F.when(style == 2, " residuals").otherwise(""), F.lit(".csv"),
    )
    return v.revenue.join(v.iso.select("id", "iso"), "iso").select(
        path.alias("path"), F.substring("mid", 5, 12).cast("bigint").alias("pos"), "id", "iso", "date",
        "mid", "dba", "volume", "total_residual", "house_residual", F.lit(True).alias("dashes"),
        F.concat("iso", F.lit(" "), F.element_at(_strings(FULL), month), F.lit(" "), year, F.lit(".csv")).alias("full_path"),
        F.concat("iso", F.lit(" "), "mid", F.lit(" "), F.element_at(_strings(TOKENS), month), year, F.lit(".xlsx")).alias("line_path"),
    )


def row(*cells: tuple[Column | str, str], columns: Sequence[int] | None = None) -> Column:
    """A grid row's cells; ``(value, kind)`` per column, NULL values are no cell."""
    places = columns or range(len(cells))
    built = [
        F.struct(F.lit(i).alias("col_idx"),
                 (F.lit(c) if isinstance(c, str) else c).cast("string").alias("value"), F.lit(k).alias("kind"))
        for i, (c, k) in zip(places, cells)
    ]
    return F.filter(F.array(*built), lambda c: c["value"].isNotNull()).cast(CELLS)


def accounting(c: str) -> Column:
    """``$1,234.50``, ``12.30`` or ``(12.30)``."""
    x = F.col(c)
    return F.when(x < 0, F.concat(F.lit("("), (-x).cast("string"), F.lit(")"))).when(
        x >= 1000, F.concat(F.lit("$"), F.format_number(x, 2))
    ).otherwise(x.cast("string"))


def dollars_in_parens(c: str) -> Column:
    x = F.col(c)
    return F.when(x < 0, F.concat(F.lit("($"), F.format_number(-x, 2), F.lit(")"))).otherwise(
        F.concat(F.lit("$"), F.format_number(x, 2))
    )


def plain_parens(c: str) -> Column:
    x = F.col(c)
    return F.when(x < 0, F.concat(F.lit("("), (-x).cast("string"), F.lit(")"))).otherwise(x.cast("string"))


def place(rows: DataFrame, entries: list[tuple], path: str = "path") -> DataFrame:
    """Grid rows: ``entries`` are (sheet_idx, sheet, is_active, row_idx, cells) per input row."""
    structs = [
        F.struct(
            (F.lit(i) if isinstance(i, int) else i).cast("int").alias("sheet_idx"),
            (F.lit(s) if isinstance(s, str) else s).alias("sheet"), F.lit(a).alias("is_active"),
            (F.lit(r) if isinstance(r, int) else r).cast("bigint").alias("row_idx"), c.alias("cells"),
        )
        for i, s, a, r, c in entries
    ]
    return rows.select(F.col(path).alias("path"), "iso", "date", F.inline(F.array(*structs)))


def heads(rows: DataFrame, path: str = "path") -> DataFrame:
    """One row per statement."""
    return rows.select(path, "id", "iso", "date").distinct()


def header(names: Sequence[str], columns: Sequence[int] | None = None) -> Column:
    cells = ", ".join(
        f"named_struct('col_idx', {i}, 'value', '{n}', 'kind', 's')"
        for i, n in zip(columns or range(len(names)), (n.replace("\n", "\\n") for n in names))
    )
    return F.expr(f"cast(array({cells}) AS {CELLS})")


def tabular(rows: DataFrame, statement: list[tuple], line: list[tuple], path: str = "path") -> DataFrame:
    return place(heads(rows, path), statement, path).unionByName(place(rows, line, path))


S1 = "Sheet1"


def hdr() -> Column:
    return 1 + F.col("id") % 3


def pos() -> Column:
    return F.col("pos")


def mid_n() -> tuple[Column, str]:
    return F.col("mid"), "n"


def mid_s() -> tuple[Column, str]:
    return F.col("mid"), "s"


def dba() -> tuple[Column, str]:
    return F.col("dba"), "s"


def dashed() -> Column:
    """The id as the statement writes it: with a dash on every fifth line."""
    cut = F.concat(F.substring("mid", 1, 4), F.lit("-"), F.substring("mid", 5, 12))
    return F.when((pos() % 5 == 0) & F.col("dashes"), cut).otherwise(F.col("mid"))


def title() -> Column:
    return row(("Residual report", "s"))


def total() -> Column:
    return row(("Total", "s"))


def n(c: str) -> tuple[Column, str]:
    return (F.col(c), "n")


def generic(rows: DataFrame) -> DataFrame:
    names = ["Merchant ID", "Merchant", "Sales Amount", "Net", "Agent Net"]
    amounts = [(accounting(c), "s") for c in ("volume", "total_residual", "house_residual")]
    return tabular(
        rows,
        [(0, S1, True, 0, title()), (0, S1, True, hdr(), header(names)), (0, S1, True, LAST, total())],
        [(0, S1, True, hdr() + 1 + pos(), row((dashed(), "s"), dba(), *amounts))],
    )


def net_collections(rows: DataFrame) -> DataFrame:
    names = ["MID", "Reference ID", "Collection Attempts", "Collection Returns/Subsidized Fees"]
    returns = F.when(pos() % 2 == 0, F.col("volume")).otherwise(-F.col("volume"))
    nothing = F.lit(None).cast("string")
    return tabular(
        rows,
        [(0, S1, True, 0, header(names)), (0, S1, True, LAST, row((nothing, "n"), ("Sum", "s"), ("9", "n"), ("1", "n")))],
        [(0, S1, True, 1 + 2 * pos(), row(mid_n(), (nothing, "s"), n("total_residual"), (returns, "n"))),
         (0, S1, True, 2 + 2 * pos(), row(mid_n(), dba()))],
    )


def two_volume(rows: DataFrame) -> DataFrame:
    names = ["MID", "DBA\nName", "Total Profit", "Agent Net", " V/MC/Discover Vol", "AMEX Vol"]
    amex = F.when(pos() % 2 == 0, "1.25")
    return tabular(
        rows,
        [(0, "Cover", True, 0, title()), (1, "PPI", False, 0, header(names)), (1, "PPI", False, LAST, total())],
        [(1, "PPI", False, 1 + pos(), row(mid_n(), dba(), n("total_residual"), n("house_residual"), n("volume"), (amex, "n")))],
    )


def commission_group(rows: DataFrame) -> DataFrame:
    names = ["MID", "Merchant", "Total Resale Price", "Total\nCommission"]
    nothing = F.lit(None).cast("string")
    return tabular(
        rows,
        [(0, S1, True, 0, header(names)), (0, S1, True, LAST, row(("1", "n"), (nothing, "s"), ("5", "n"), ("5", "n")))],
        [(0, S1, True, 1 + 2 * pos(), row(mid_n(), dba(), n("total_residual"), n("house_residual"))),
         (0, S1, True, 2 + 2 * pos(), row(mid_n(), dba(), ("1.00", "n")))],
    )


def marker_header(rows: DataFrame) -> DataFrame:
    names = ["ACCOUNT", "DBA Name", "Total Sales", "Net Profit", "Payment to Sales Agent"]
    sheet = "Residual Payments - Schedule A"
    return tabular(
        rows,
        [(0, "Cover", True, 0, header(names)), (1, sheet, False, 0, title()), (1, sheet, False, hdr(), header(names)),
         (1, sheet, False, LAST, total())],
        [(1, sheet, False, hdr() + 1 + pos(), row(mid_n(), dba(), n("volume"), n("total_residual"), n("house_residual")))],
    )


def split_70(rows: DataFrame) -> DataFrame:
    names = ["MID", "MERCHANT", "NET SALES", "SPLIT TO RAC - 70%", "SPLIT TO AGENT - 70%"]
    mid = F.when(pos() % 4 == 0, F.concat("mid", F.lit(".25"))).otherwise(F.col("mid"))
    house = F.when(pos() % 50 == 7, "n/a").otherwise(F.col("house_residual").cast("string"))
    return tabular(
        rows,
        [(0, S1, True, 0, header(names)), (0, S1, True, LAST, total())],
        [(0, S1, True, 1 + pos(), row((mid, "n"), dba(), n("volume"), n("total_residual"), (house, "n")))],
    )


def multi_sheet(rows: DataFrame) -> DataFrame:
    sheet = F.element_at(_strings(["EMS", "First_Data", "CMS"]), (pos() % 3 + 1).cast("int"))
    first = ["MID", "DBA", "BC Volume", "Volume", "Revenue", "Partner Comm."]
    second = ["Merchant ID", "Merchant", "Other", "BC Volume", "Payee Income", "Partner Comm"]
    third = ["Merchant Identifier", "Merchant Name", "Other", "volume", "Agent Residual", "Partner Comm"]
    return tabular(
        rows,
        [(0, "EMS", True, 0, header(first)), (1, "First_Data", False, 0, header(second)),
         (2, "CMS", False, 0, header(third)), (3, "Notes", False, 0, header(first)),
         (3, "Notes", False, 1, row(("1", "n"), ("x", "s"))), (0, "EMS", True, LAST, row(("77", "s"), ("text id", "s")))],
        [(pos() % 3, sheet, False, 1 + pos(),
          row(mid_n(), dba(), ("0", "n"), n("volume"), n("total_residual"), n("house_residual")))],
    )


def form_per_sheet(rows: DataFrame) -> DataFrame:
    name = F.when(pos() % 7 == 0, "Contact").when(pos() % 2 == 0, F.concat(F.lit("DBA: "), "dba")).otherwise(
        F.concat(F.lit("Merchant : "), "dba"))
    sheet = F.concat(F.lit("Form "), pos().cast("string"))
    at = [pos().cast("int"), sheet, False]
    return place(rows, [
        (*at, 0, title()),
        (*at, 1, row((F.concat(F.lit("Account Mid# "), "mid"), "s"))),
        (*at, 2, row((name, "s"))),
        (*at, 4, row(("Fees", "s"), ("Per Transaction", "s"), columns=[0, 2])),
        (*at, 5, row(("Count", "s"), ("0.10", "n"), columns=[0, 2])),
        (*at, 6, row(("Volume", "s"), n("volume"), columns=[0, 2])),
        (*at, 8, row(("Total Commissions due", "s"), (plain_parens("house_residual"), "s"), columns=[1, 2])),
    ]).unionByName(place(heads(rows), [(2_000_000_000, "Summary", True, 0, title())]))


PAREN_HEADERS = ["Merchant Identifier", "DBA", "Volume", "Revenue", "Commission"]


def first_valid_sheet(rows: DataFrame) -> DataFrame:
    house = F.when(pos() % 50 == 7, "n/a").otherwise(dollars_in_parens("house_residual"))
    cells = row(mid_s(), dba(), (dollars_in_parens("volume"), "s"), (dollars_in_parens("total_residual"), "s"), (house, "s"))
    return tabular(
        rows,
        [(0, "Cover", True, 0, title()), (1, "Data", False, 0, title()), (1, "Data", False, hdr(), header(PAREN_HEADERS)),
         (1, "Data", False, LAST, row(("12", "n"), ("number id", "s"))), (2, "Old", False, 0, header(PAREN_HEADERS)),
         (2, "Old", False, 1, row(("5", "s"), ("old", "s"), ("1", "s"), ("1", "s"), ("1", "s")))],
        [(1, "Data", False, hdr() + 1 + pos(), cells)],
    )


def int_or_digits(rows: DataFrame) -> DataFrame:
    names = ["MID", "Merchant Name", "Volume", "Residual", "Payout Total"]
    amounts = [n("volume"), n("total_residual"), n("house_residual")]
    as_number, as_text = F.when(pos() % 3 == 0, F.col("mid")), F.when(pos() % 3 != 0, F.col("mid"))
    cells = row((as_number, "n"), (as_text, "s"), dba(), *amounts, columns=[0, 0, 1, 2, 3, 4])
    return tabular(
        rows,
        [(0, S1, True, 0, title()), (0, S1, True, hdr(), header(names)),
         (0, S1, True, LAST, row(("123.5", "n"), ("fraction", "s"), ("1", "n"), ("1", "n"), ("1", "n")))],
        [(0, S1, True, hdr() + 1 + pos(), cells)],
    )


def all_sheets_union(rows: DataFrame) -> DataFrame:
    names = ["MID", "Merchant", "Total Resale Price", "Total Commission"]
    sheet = F.concat(F.lit("Part "), (pos() % 2).cast("string"))
    cells = row(mid_s(), dba(), (dollars_in_parens("total_residual"), "s"), (dollars_in_parens("house_residual"), "s"))
    return tabular(
        rows,
        [(0, "Part 0", True, hdr(), header(names)), (1, "Part 1", False, hdr(), header(names)),
         (2, "Notes", False, 0, title())],
        [(pos() % 2, sheet, False, hdr() + 1 + pos(), cells)],
    )


def processor_marker(rows: DataFrame) -> DataFrame:
    names = ["Processor", " MID", "Name ", "Volume", " Income ", "Net"]
    net = F.when(pos() % 10 != 3, F.concat(F.lit("$"), F.col("house_residual").cast("string")))
    return tabular(
        rows,
        [(0, S1, True, 0, title()), (0, S1, True, hdr(), header(names)), (0, S1, True, LAST, total())],
        [(0, S1, True, hdr() + 1 + pos(),
          row(("P", "s"), mid_s(), dba(), (F.format_number("volume", 2), "s"), n("total_residual"), (net, "s")))],
    )


def payout_period(rows: DataFrame, unreadable: bool = False) -> DataFrame:
    """``unreadable``: some dates are none."""
    names = ["Partner ID", "Referred Merchant Company Name", " Gross Processing Volume",
             "Total Payout (less delivery)", "Commission Payout Date"]
    day = (
        F.when(pos() % 6 == 1, F.date_format(F.add_months("date", 1), "yyyy-MM-dd"))
        .when(pos() % 6 == 3, F.date_format(F.date_add("date", 9), "M/d/yyyy"))
        .when(pos() % 24 == 2, F.date_format(F.date_add("date", 9), "yyyy/MM/dd")).when(pos() % 24 == 8, F.date_format(F.date_add("date", 20), "yyyyMMdd"))
        .when(pos() % 24 == 14, F.date_format("date", "d MMM yyyy")).when(pos() % 24 == 20, F.date_format("date", "MMMM d, yyyy"))
        .when(pos() % 12 == 5, F.concat(F.date_format("date", "MM/dd/yyyy"), F.lit(" 12:00:00 AM"))).when(pos() % 12 == 4, F.date_format("date", "M/d/yy"))
        .when(pos() % 12 == 10, F.date_format("date", "d-MMM-yyyy"))
        .otherwise(F.concat(F.date_format(F.date_add("date", 5), "yyyy-MM-dd"), F.lit(" 00:00:00")))
    )
    if unreadable:
        day = F.when(pos() % 12 == 2, "soon").when(pos() % 12 == 8, "31/31/2000").otherwise(day)
    return tabular(
        rows,
        [(0, S1, True, 0, title()), (0, S1, True, hdr(), header(names))],
        [(0, S1, True, hdr() + 1 + 2 * pos(),
          row(mid_n(), dba(), (F.concat(F.lit("$"), F.format_number("volume", 2)), "s"), n("house_residual"), (day, "s"))),
         (0, S1, True, hdr() + 2 + 2 * pos(), row(mid_n(), dba(), ("n/a", "s"), ("1.50", "n"), (day, "s")))],
        path="full_path",
    )


BLOCK = ["Merchant COUNT/Amount", "Gross Total", "ISO Payout"]


def column_blocks(rows: DataFrame) -> DataFrame:
    """Columns 1-3 and 17-19 are whole blocks, 4-6 lacks a heading, 13-15 has a foreign id,
    and the last column holds an id that no block can start at."""
    stray = (F.concat(F.lit("635400000000"), F.lit("99999")), "n")
    at = [1, "Detail", False]
    other = F.concat(F.col("mid"), F.lit("7"))
    return place(rows, [
        (0, "Summary", True, 0, title()),
        (*at, 3, row(dba(), ("half", "s"), ("foreign", "s"), (F.concat("dba", F.lit(" B")), "s"), columns=[1, 4, 13, 17])),
        (*at, 4, row(mid_n(), stray, ("77", "n"), (other, "s"), stray, columns=[1, 4, 13, 17, 20])),
        (*at, 5, row(*[(h, "s") for h in BLOCK], (BLOCK[0], "s"), (BLOCK[2], "s"),
                     *[(h, "s") for h in BLOCK], *[(h, "s") for h in BLOCK],
                     columns=[1, 2, 3, 4, 6, 13, 14, 15, 17, 18, 19])),
        (*at, 6, row(("Visa/MC/Discover Interchange Dues", "s"), n("volume"), ("3.00", "n"), ("8", "n"), ("5.5", "n"),
                     columns=[0, 1, 2, 3, 17])),
        (*at, 7, row(("AMEX Sponsorship Fee", "s"), ("1.25", "n"), n("total_residual"), ("=A1", "f"), ("2.5", "s"),
                     columns=[0, 1, 2, 17, 18])),
        (*at, 8, row(("Total Income", "s"), ("100", "n"), ("100", "n"), columns=[0, 2, 18])),
        (*at, 9, row(("NET residuals for payout", "s"), n("house_residual"), ("4", "n"), columns=[0, 3, 19])),
        (*at, 10, row(("NET residuals for payout", "s"), ("1", "n"), ("1", "n"), columns=[0, 3, 19])),
    ], path="line_path")


def active_sheet(rows: DataFrame) -> DataFrame:
    names = ["Merchant ID", "Merchant Name ", " P Volume", "Net Income", "Agent Residual", "Net Income"]
    cells = row(mid_s(), dba(), n("volume"), ("0", "n"), n("house_residual"), n("total_residual"))
    return tabular(
        rows,
        [(0, "Old", False, 0, header(names)), (0, "Old", False, 1, row(("1", "s"), ("old", "s"))),
         (1, "Now", True, 0, title()), (1, "Now", True, hdr(), header(names)),
         (1, "Now", True, LAST, row(("note", "s"), columns=[9]))],
        [(1, "Now", True, hdr() + 1 + pos(), cells)],
    )


def paynote(rows: DataFrame) -> DataFrame:
    names = ["MID", "Merchant Name", "Debit Processing Volume", "Total Partner Income", "Total Partner Payout"]
    amounts = [(accounting(c), "s") for c in ("volume", "total_residual", "house_residual")]
    return tabular(
        rows,
        [(0, S1, True, 0, title()), (0, S1, True, hdr(), header(names)), (0, S1, True, LAST, total())],
        [(0, S1, True, hdr() + 1 + pos(), row((dashed(), "s"), dba(), *amounts))],
    )


WRITERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        generic, net_collections, two_volume, commission_group, marker_header, split_70, multi_sheet,
        form_per_sheet, first_valid_sheet, int_or_digits, all_sheets_union, processor_marker,
        payout_period, column_blocks, active_sheet, paynote,
    )
}


def registry_text(v: Views) -> DataFrame:
    """A registry document per partner, in the three accepted forms, from the partner table."""
    mapping = F.create_map(
        F.lit("mid"), F.lit("Merchant ID"), F.lit("dba"), F.lit("Merchant"),
        F.lit("volume"), F.when(F.col("id") % 5 == 0, "").otherwise("Sales Amount"),
        F.lit("total_residual"), F.lit("Net"), F.lit("house_residual"), F.lit("Agent Net"),
    )
    body = (
        F.when(F.col("id") % 4 == 0, F.to_json(F.map_concat(F.create_map(F.lit("iso"), F.col("iso")), mapping)))
        .otherwise(F.to_json(F.struct("iso", mapping.alias("mapping"))))
    )
    entry = F.concat(F.lit('"'), F.col("iso"), F.lit('":'), body)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("id", entry.alias("entry")))), lambda e: e["entry"])
    return v.iso.agg(F.concat(F.lit("{"), F.concat_ws(",", ordered), F.lit("}")).alias("value"))
