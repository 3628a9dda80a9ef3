"""Column lists and schemas shared by the whole package."""

from __future__ import annotations

MONEY = "decimal(18,2)"
PERCENT = "decimal(5,2)"

# One spreadsheet row. A row is the unit of work: header tests and column lookups
# are row-local, so a sheet never has to be gathered in one place.
GRID_SCHEMA = (
    "path string, sheet_idx int, sheet string, is_active boolean, row_idx bigint, "
    "cells array<struct<col_idx:int,value:string,kind:string>>"
)
GRID_COLUMNS = ("path", "sheet_idx", "sheet", "is_active", "row_idx", "cells")
SHEET_KEYS = ("path", "sheet_idx")
# Sheet number of the one row that stands for a file that cannot be read; its sheet names the reason.
UNREADABLE_SHEET = -1

# What is known about a statement before its cells are read.
IDENTITY_COLUMNS = ("iso", "date", "layout")

AMOUNTS = ("volume", "total_residual", "house_residual")
TARGETS = ("mid", "dba", *AMOUNTS)

AGENT_COLUMNS = (
    "agent1_name", "agent1_percentage", "agent1_payout",
    "agent2_name", "agent2_percentage", "agent2_payout",
)

LEDGER_SCHEMA = (
    "date date, iso string, mid string, dba string, "
    f"volume {MONEY}, total_residual {MONEY}, house_residual {MONEY}, "
    f"agent1_name string, agent1_percentage {PERCENT}, agent1_payout {MONEY}, "
    f"agent2_name string, agent2_percentage {PERCENT}, agent2_payout {MONEY}, "
    "updated_by string, updated_at timestamp_ntz"
)
LEDGER_COLUMNS = (
    "date", "iso", *TARGETS, *AGENT_COLUMNS, "updated_by", "updated_at",
)

MERCHANT_SCHEMA = (
    "mid string, dba string, corporation string, iso string, iso_referral_type string, "
    "sic_code string, sic_description string, approval_date date, closed_date date, "
    "is_active int, is_referred int, "
    f"agent1_name string, agent1_split {PERCENT}, agent2_name string, agent2_split {PERCENT}"
)
ISO_SCHEMA = "id int, iso string, referral_type string, is_active int"
ADJUSTMENT_SCHEMA = f"id bigint, iso_id int, date date, adjustment_price {MONEY}"
PAYMENT_SCHEMA = f"iso_id int, date date, bank_amount {MONEY}"
SIC_SCHEMA = "sic_code string, description string"

# Referral types in report order.
REFERRAL_TYPES = ("3rd Party", "MID", "Gateway")
