"""The statement layouts, declared as data.

A layout says where its table starts, which header names feed which target, which cells are
merchant ids, how money is written and whether lines are grouped. ``extract`` evaluates all
declared layouts in one pass. Two layouts are no tables with a header row and live in their
own modules (``form_sheets``, ``column_blocks``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions import merchant_ids, numbers, text
from ledgermill.operators import grids

Rule = Callable[[Column], Column]

# Header names each layout looks for, in target order
# mid, dba, volume, total_residual, house_residual and one auxiliary column.
HEADERS: dict[str, dict[str, str]] = {
    "net_collections": {
        "mid": "MID", "dba": "Reference ID", "house_residual": "Collection Attempts",
        "other": "Collection Returns/Subsidized Fees",
    },
    "two_volume": {
        "mid": "MID", "dba": "DBA Name", "volume": "V/MC/Discover Vol",
        "total_residual": "Total Profit", "house_residual": "Agent Net", "other": "AMEX Vol",
    },
    "commission_group": {
        "mid": "MID", "dba": "Merchant", "total_residual": "Total Resale Price",
        "house_residual": "Total Commission",
    },
    "marker_header": {
        "mid": "ACCOUNT", "dba": "DBA Name", "volume": "Total Sales",
        "total_residual": "Net Profit", "house_residual": "Payment to Sales Agent",
    },
    "split_70": {
        "mid": "MID", "dba": "MERCHANT", "volume": "NET SALES",
        "total_residual": "SPLIT TO RAC - 70%", "house_residual": "SPLIT TO AGENT - 70%",
    },
    "first_valid_sheet": {
        "mid": "Merchant Identifier", "dba": "DBA", "volume": "Volume",
        "total_residual": "Revenue", "house_residual": "Commission",
    },
    "int_or_digits": {
        "mid": "MID", "dba": "Merchant Name", "volume": "Volume",
        "total_residual": "Residual", "house_residual": "Payout Total",
    },
    "all_sheets_union": {
        "mid": "MID", "dba": "Merchant", "total_residual": "Total Resale Price",
        "house_residual": "Total Commission",
    },
    "processor_marker": {
        "mid": "MID", "dba": "Name", "volume": "Volume", "total_residual": "Income",
        "house_residual": "Net",
    },
    "payout_period": {
        "mid": "Partner ID", "dba": "Referred Merchant Company Name",
        "volume": "Gross Processing Volume", "house_residual": "Total Payout (less delivery)",
        "other": "Commission Payout Date",
    },
    "active_sheet": {
        "mid": "Merchant ID", "dba": "Merchant Name", "volume": "P Volume",
        "total_residual": "Net Income", "house_residual": "Agent Residual",
    },
    "paynote": {
        "mid": "MID", "dba": "Merchant Name", "volume": "Debit Processing Volume",
        "total_residual": "Total Partner Income", "house_residual": "Total Partner Payout",
    },
}

# Sheets addressed by name.
TWO_VOLUME_SHEET = "PPI"
MARKER_HEADER_SHEET = "Residual Payments - Schedule A"

# Candidate headers of the many-sheet workbook, first present one wins.
_MANY_SHEET_BASE: dict[str, list[str]] = {
    "mid": ["MID", "Merchant ID", "Merchant Identifier"],
    "dba": ["DBA", "Merchant", "DBAName"],
    "volume": ["Volume", "BC Volume", "volume"],
    "total_residual": ["Revenue", "Res. Earned", "Payee Income", "Total"],
    "house_residual": ["Partner Comm.", "Partner Comm"],
}
_MANY_SHEET_EXTRA: dict[str, dict[str, list[str]]] = {
    "Digipay": {"volume": ["Total SalesCount"], "total_residual": ["Payout"]},
    "EMS": {},
    "EMS_OR": {"house_residual": ["Partner %2"]},
    "First_Data": {},
    "NXGEN_Elavon": {},
    "TMS": {"total_residual": ["Total Residuals Earned"]},
    "CMS_Nexio": {"dba": ["Merchant Name"], "total_residual": ["Agent Residual"]},
    "CMS": {"dba": ["Merchant Name"], "total_residual": ["Agent Residual"]},
}
SHEET_CANDIDATES: dict[str, dict[str, list[str]]] = {
    sheet: {t: names + extra.get(t, []) for t, names in _MANY_SHEET_BASE.items()}
    for sheet, extra in _MANY_SHEET_EXTRA.items()
}
# Partner suffix of a sheet where it is not the sheet name itself.
SHEET_LABELS = {
    "First_Data": "FD", "NXGEN_Elavon": "NXGEN", "EMS_OR": "EMS OR", "CMS_Nexio": "CMS", "CMS": "CMS",
}


@dataclass(frozen=True, eq=False)
class Layout:
    """How one layout is read. ``missing`` says what an unreadable or empty amount means:
    ``zero``, ``reject`` (the line is refused) or ``skip`` (left out of the group's sum)."""

    name: str
    header: Column
    mid: Rule
    money: Rule = numbers.plain
    missing: str = "reject"
    clean: Rule = text.unchanged
    zero: tuple[str, ...] = ()
    last_duplicate: bool = False
    keep_blank_mid: bool = False
    complete_rows: bool = False
    group_by: tuple[str, ...] = ()
    optional: bool = False
    headers: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return list(self.headers.values())


def _array(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _declare(name: str, header: Column | Callable[[Column], Column], **options) -> Layout:
    names = HEADERS.get(name, {})
    condition = header(_array(list(names.values()))) if callable(header) and not isinstance(header, Column) else header
    return Layout(name=name, header=condition, headers=names, **options)


def layouts(
    two_volume_sheet: str = TWO_VOLUME_SHEET,
    marker_sheet: str = MARKER_HEADER_SHEET,
    sheet_candidates: dict[str, dict[str, list[str]]] | None = None,
) -> dict[str, Layout]:
    """All layouts with a header row, by name. ``generic`` takes its headers from the registry."""
    sheets = list(sheet_candidates or SHEET_CANDIDATES)
    first_sheet, top_row = F.col("sheet_idx") == 0, F.col("row_idx") == 0
    declared = [
        Layout(
            "generic", first_sheet & grids.has_all(F.col("required")), merchant_ids.dash,
            money=numbers.money_ceil, missing="zero",
        ),
        _declare(
            "net_collections", first_sheet & top_row, mid=merchant_ids.present, missing="skip",
            zero=("volume", "total_residual"), group_by=("mid",),
        ),
        _declare(
            "two_volume", (F.col("sheet") == two_volume_sheet) & top_row,
            mid=merchant_ids.numeric, clean=text.one_line,
        ),
        _declare(
            "commission_group", first_sheet & top_row, mid=merchant_ids.present, missing="skip",
            clean=text.one_line, zero=("volume",), group_by=("mid", "dba"),
        ),
        _declare(
            "marker_header",
            (F.col("sheet") == marker_sheet) & grids.has_marker("ACCOUNT", ignore_case=True),
            mid=merchant_ids.numeric, clean=text.one_line,
        ),
        _declare(
            "split_70", first_sheet & top_row, mid=merchant_ids.numeric, clean=text.one_line,
        ),
        Layout(
            "multi_sheet", F.col("sheet").isin(sheets) & top_row, merchant_ids.integral_kind,
            optional=True,
        ),
        _declare("first_valid_sheet", grids.has_all, mid=merchant_ids.digit_string,
                 money=numbers.money_paren),
        _declare("int_or_digits", lambda h: first_sheet & grids.has_all(h),
                 mid=merchant_ids.int_or_digits),
        _declare("all_sheets_union", grids.has_all, mid=merchant_ids.digit_string,
                 money=numbers.money_paren, zero=("volume",)),
        _declare("processor_marker", first_sheet & grids.has_marker("Processor"),
                 mid=merchant_ids.present, money=numbers.money_strict, clean=text.stripped,
                 complete_rows=True),
        _declare("payout_period", lambda h: first_sheet & grids.has_any(h),
                 mid=merchant_ids.present, money=numbers.money_coerce, missing="skip",
                 clean=text.slug, zero=("total_residual",), group_by=("mid",)),
        _declare("active_sheet", F.col("is_active") & grids.has_cell("Merchant ID"),
                 mid=merchant_ids.present, money=numbers.money_lenient, missing="zero",
                 clean=text.stripped, last_duplicate=True, keep_blank_mid=True),
        _declare("paynote", lambda h: first_sheet & grids.has_all(h),
                 mid=merchant_ids.dash_text, money=numbers.money_ceil, missing="zero"),
    ]
    return {layout.name: layout for layout in declared}
