"""The derived tables as SQL, used as leading CTEs of every oracle statement."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "iso": """
SELECT CAST(n_nationkey AS INT) + 1 AS id, n_name AS iso,
  CASE n_regionkey % 4 WHEN 0 THEN 'MID' WHEN 1 THEN 'Gateway' WHEN 2 THEN 'MID' ELSE '3rd Party' END AS referral_type,
  CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE 1 END AS is_active FROM nation""",
    "sic_codes": """
SELECT DISTINCT CAST(5000 + p_size AS VARCHAR) AS sic_code, concat('Industry ', CAST(p_size AS VARCHAR)) AS description FROM part""",
    "merchants": """
SELECT concat('6354', lpad(CAST(c_custkey AS VARCHAR), 12, '0')) AS mid, c_name AS dba,
  CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN '' ELSE concat('Corp ', CAST(c_custkey % 97 AS VARCHAR)) END AS corporation,
  i.iso, i.referral_type AS iso_referral_type, CAST(5001 + c_custkey % 60 AS VARCHAR) AS sic_code,
  concat('Industry ', CAST(1 + c_custkey % 60 AS VARCHAR)) AS sic_description,
  make_date(1994, CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT)) AS approval_date,
  CASE WHEN c_custkey % 11 = 0 THEN make_date(2001, CAST(1 + c_custkey % 12 AS INT), 1) END AS closed_date,
  CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 1 END AS is_active,
  CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_referred,
  CASE WHEN c_custkey % 3 = 0 THEN concat('Agent ', CAST(c_custkey % 10 AS VARCHAR)) END AS agent1_name,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(10 + 5 * (c_custkey % 5) AS DECIMAL(5,2)) END AS agent1_split,
  CASE WHEN c_custkey % 6 = 0 THEN concat('Agent ', CAST((c_custkey + 3) % 10 AS VARCHAR)) END AS agent2_name,
  CASE WHEN c_custkey % 6 = 0 THEN CAST(5 * (c_custkey % 4) AS DECIMAL(5,2)) END AS agent2_split
FROM customer JOIN iso i ON i.id = c_nationkey + 1""",
    "revenue": """
SELECT b.date, b.iso, b.mid, b.dba, b.volume, b.total_residual, b.house_residual, m.agent1_name,
  m.agent1_split AS agent1_percentage,
  CASE WHEN m.is_referred = 1 THEN CAST(ROUND(b.house_residual * m.agent1_split * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) END AS agent1_payout,
  m.agent2_name, m.agent2_split AS agent2_percentage,
  CASE WHEN m.is_referred = 1 AND m.agent2_split <> 0 AND b.house_residual <> 0 THEN CAST(ROUND(b.house_residual * m.agent2_split * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) END AS agent2_payout,
  'import' AS updated_by, b.updated_at
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, m0.iso, m0.mid, m0.dba,
   CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS volume,
   CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS total_residual,
   CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2)))), 2) AS DECIMAL(18,2)) AS house_residual,
   MAX(l_shipdate) AS updated_at
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN merchants m0 ON m0.mid = concat('6354', lpad(CAST(o_custkey AS VARCHAR), 12, '0'))
 GROUP BY 1, 2, 3, 4) b JOIN merchants m ON b.mid = m.mid""",
    "adjustments": """
SELECT s_suppkey AS id, CAST(s_nationkey AS INT) + 1 AS iso_id,
  make_date(CAST(1995 + FLOOR((s_suppkey % 80) / 12.0) AS INT), CAST(1 + (s_suppkey % 80) % 12 AS INT), 1) AS date,
  CAST(s_acctbal AS DECIMAL(18,2)) AS adjustment_price FROM supplier""",
    "payments": """
SELECT i.id AS iso_id, r.date, CAST(ROUND(SUM(r.house_residual) * CAST(0.98 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS bank_amount
FROM revenue r JOIN iso i ON r.iso = i.iso WHERE i.id % 4 <> 0 GROUP BY i.id, r.date""",
    "stmt_lines": """
SELECT concat(iso, CASE mon % 3 WHEN 0 THEN '_' ELSE ' ' END,
    list_element(['Jan','February','Mar','April','May','June','Jul','August','Sept','October','Nov','December'], mon),
    CASE mon % 3 WHEN 0 THEN '_' WHEN 1 THEN '' ELSE ' ' END, yr, CASE mon % 3 WHEN 2 THEN ' residuals' ELSE '' END, '.csv') AS path,
  CAST(substr(mid, 5) AS BIGINT) AS pos, id, iso, date, mid, dba, volume, total_residual, house_residual, 1 + id % 3 AS hdr,
  concat(iso, ' ', list_element(['January','February','March','April','May','June','July','August','September','October','November','December'], mon), ' ', yr, '.csv') AS full_path,
  concat(iso, ' ', mid, ' ', list_element(['Jan','February','Mar','April','May','June','Jul','August','Sept','October','Nov','December'], mon), yr, '.xlsx') AS line_path
FROM (SELECT r.*, i.id, CAST(EXTRACT(MONTH FROM r.date) AS INT) AS mon, CAST(EXTRACT(YEAR FROM r.date) AS VARCHAR) AS yr
  FROM revenue r JOIN iso i ON r.iso = i.iso) x""",
    # statement grid of the generic layout, as cells
    "cells": """
SELECT path, sheet_idx, row_idx, col_idx, value, 's' AS kind FROM (
  SELECT DISTINCT path, 0 AS sheet_idx, CAST(0 AS BIGINT) AS row_idx, 0 AS col_idx, 'Residual report' AS value FROM stmt_lines
  UNION ALL SELECT DISTINCT path, 0, hdr, 0, 'Merchant ID' FROM stmt_lines
  UNION ALL SELECT DISTINCT path, 0, hdr, 1, 'Merchant' FROM stmt_lines
  UNION ALL SELECT DISTINCT path, 0, hdr, 2, 'Sales Amount' FROM stmt_lines
  UNION ALL SELECT DISTINCT path, 0, hdr, 3, 'Net' FROM stmt_lines
  UNION ALL SELECT DISTINCT path, 0, hdr, 4, 'Agent Net' FROM stmt_lines
  UNION ALL SELECT path, 0, hdr + 1 + pos, 0, CASE WHEN pos % 5 = 0 THEN concat(substr(mid, 1, 4), '-', substr(mid, 5)) ELSE mid END FROM stmt_lines
  UNION ALL SELECT path, 0, hdr + 1 + pos, 1, dba FROM stmt_lines
  UNION ALL SELECT path, 0, hdr + 1 + pos, u.col_idx, CASE WHEN x < 0 THEN concat('(', CAST(-x AS VARCHAR), ')')
      WHEN x >= 1000 THEN concat('$', format('{:,.2f}', CAST(x AS DOUBLE))) ELSE CAST(x AS VARCHAR) END
    FROM (SELECT path, hdr, pos, 2 AS col_idx, volume AS x FROM stmt_lines UNION ALL SELECT path, hdr, pos, 3, total_residual FROM stmt_lines
      UNION ALL SELECT path, hdr, pos, 4, house_residual FROM stmt_lines) u
  UNION ALL SELECT DISTINCT path, 0, CAST(9000000000 AS BIGINT), 0, 'Total' FROM stmt_lines) c""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it mentions, directly or through another view."""
    names = list(VIEWS)
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in names:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text, re.I):
                needed.add(name)
                todo.append(VIEWS[name])
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names if n in needed)
    recursive = "RECURSIVE " if re.match(r"\s*WITH RECURSIVE", sql, re.I) else ""
    body = re.sub(r"^\s*WITH (RECURSIVE )?", ", ", sql, count=1, flags=re.I) if re.match(
        r"\s*WITH\b", sql, re.I) else sql
    return f"WITH {recursive}{ctes}\n{body}"
