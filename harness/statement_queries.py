"""Registered ingestion queries: identity, header search, scalar rules and layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harness import statements as W

from harness.oracle_views import with_views
from harness.views import Views
from ledgermill.functions import merchant_ids, numbers, text
from ledgermill.operators import column_blocks, extract, form_sheets, grids, identity
from ledgermill.sources import registry as registry_source

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, make, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: make(Views(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = with_views(sql)


def registry(v: Views) -> DataFrame:
    return registry_source.parse_registry(W.registry_text(v))


def generic_grid(v: Views) -> DataFrame:
    return W.generic(W.lines(v))


# --- registry and file names ----------------------------------------------------------------
register("src_layout_registry", registry, """
SELECT i.iso AS layout, i.id - 1 AS ordinal, i.iso, t.target, CASE WHEN t.target = 'volume' AND i.id % 5 = 0 THEN '' ELSE t.source END AS source, 0 AS priority
FROM iso i CROSS JOIN (VALUES ('mid', 'Merchant ID'), ('dba', 'Merchant'), ('volume', 'Sales Amount'), ('total_residual', 'Net'), ('house_residual', 'Agent Net')) t(target, source)""")


def file_names(v: Views) -> DataFrame:
    """A file name per order: well-formed ones in several notations, and broken ones."""
    month = F.month("o_orderdate")
    name = F.concat(F.lit("NATION"), F.when(F.col("o_orderkey") % 3 == 0, "_").otherwise(" "),
                    (F.col("o_custkey") % 30).cast("string"))
    year, token = F.year("o_orderdate").cast("string"), F.element_at(W._strings(W.TOKENS), month)
    case = F.col("o_orderkey") % 8
    path = (
        F.when(case == 0, F.concat(name, F.lit(" "), token, year, F.lit(".xls")))
        .when(case == 1, F.concat(name, F.lit("  "), F.lower(token), F.lit(" "), year, F.lit(" residuals")))
        .when(case == 2, F.concat(name, F.lit("_"), F.upper(token), F.lit("_"), year, F.lit(".v2.csv")))
        .when(case == 3, F.concat(F.lower(name), F.lit(" "), token, F.lit(" "), year, F.lit(".csv")))
        .when(case == 4, F.concat(name, F.lit(" residuals.csv")))
        .when(case == 5, F.concat(name, F.lit(" Foo "), year, F.lit(".csv")))
        .when(case == 6, F.concat(F.lit("Unknown Partner "), token, F.lit(" "), year, F.lit(".csv")))
        .otherwise(F.concat(F.lit("X"), token, year, F.lit(".csv")))
    )
    return v.read("orders").select(path.alias("path"))


NAMES = """
SELECT CASE o_orderkey % 8
  WHEN 0 THEN concat(name, ' ', token, yr, '.xls') WHEN 1 THEN concat(name, '  ', lower(token), ' ', yr, ' residuals')
  WHEN 2 THEN concat(name, '_', upper(token), '_', yr, '.v2.csv') WHEN 3 THEN concat(lower(name), ' ', token, ' ', yr, '.csv')
  WHEN 4 THEN concat(name, ' residuals.csv') WHEN 5 THEN concat(name, ' Foo ', yr, '.csv')
  WHEN 6 THEN concat('Unknown Partner ', token, ' ', yr, '.csv') ELSE concat('X', token, yr, '.csv') END AS path
FROM (SELECT o_orderkey, concat('NATION', CASE WHEN o_orderkey % 3 = 0 THEN '_' ELSE ' ' END, CAST(o_custkey % 30 AS VARCHAR)) AS name,
  list_element(['Jan','February','Mar','April','May','June','Jul','August','Sept','October','Nov','December'], CAST(EXTRACT(MONTH FROM o_orderdate) AS INT)) AS token,
  CAST(EXTRACT(YEAR FROM o_orderdate) AS VARCHAR) AS yr FROM orders) o"""
PARTS = rf"""
SELECT path, trim(regexp_replace(regexp_extract(stem, '{{p}}', 1), '\s+', ' ', 'g')) AS name, regexp_extract(stem, '{{p}}', 2) AS month_word,
  regexp_extract(stem, '{{p}}', 3) AS year FROM (SELECT path, trim(regexp_replace(path, '\.[^.]*$', '')) AS stem FROM ({NAMES}) n) s
""".replace("{p}", r"^(.*?)(?:[_\s]+)?([A-Za-z]+)[_\s]?(\d{4})(?:\s.*)?$")
# LCS of every distinct name with every layout name, one character of the name per step, one
# table row per prefix of the layout name
LCS = f"""WITH RECURSIVE parts AS ({PARTS}), names AS (SELECT DISTINCT name FROM parts WHERE name <> ''),
lcs(name, layout, iso, ordinal, step, dp) AS (
  SELECT lower(n.name), i.iso, i.iso, i.id - 1, 0, list_transform(range(length(i.iso) + 1), lambda x: 0) FROM (SELECT DISTINCT lower(name) AS name FROM names) n CROSS JOIN iso i
  UNION ALL
  SELECT name, layout, iso, ordinal, step + 1,
    list_reduce(list_transform(range(1, length(layout) + 1), lambda j: [j]), lambda acc, j: list_append(acc,
      CASE WHEN substr(lower(layout), j[1], 1) = substr(name, step + 1, 1) THEN dp[j[1]] + 1 ELSE greatest(dp[j[1] + 1], acc[-1]) END), [0])
  FROM lcs WHERE step < length(name)),
scored AS (SELECT name, layout, iso, ordinal, CAST(round_even(200.0 * dp[-1] / (length(name) + length(layout)), 0) AS INT) AS similarity
  FROM lcs WHERE step = length(name)),
best AS (SELECT name AS lname, arg_max(layout, similarity * 1000 - ordinal) AS layout, arg_max(iso, similarity * 1000 - ordinal) AS iso, max(similarity) AS similarity FROM scored GROUP BY name)
"""
register("stmt_fuzzy_layout",
         lambda v: identity.match_names(identity.split_names(file_names(v)).filter("name <> ''"), registry(v)),
         LCS + """SELECT n.name, similarity, CASE WHEN similarity >= 80 THEN layout END AS layout, CASE WHEN similarity >= 80 THEN iso END AS iso
FROM names n JOIN best b ON lower(n.name) = b.lname""")
MONTH_CASE = """CASE lower(month_word) WHEN 'jan' THEN 1 WHEN 'february' THEN 2 WHEN 'mar' THEN 3 WHEN 'april' THEN 4 WHEN 'may' THEN 5 WHEN 'june' THEN 6
 WHEN 'jul' THEN 7 WHEN 'august' THEN 8 WHEN 'sept' THEN 9 WHEN 'october' THEN 10 WHEN 'nov' THEN 11 WHEN 'december' THEN 12 END"""
RULES = (
    identity.Rule("equals", "NATION_3", "two_volume"), identity.Rule("contains", "NATION_1", "multi_sheet"),
    identity.Rule("equals", "NATION_12", "split_70"), identity.Rule("contains", "_2", "first_valid_sheet"),
)
FAMILY_CASE = """CASE WHEN iso = 'NATION_3' THEN 'two_volume' WHEN contains(iso, 'NATION_1') THEN 'multi_sheet'
  WHEN iso = 'NATION_12' THEN 'split_70' WHEN contains(iso, '_2') THEN 'first_valid_sheet' ELSE 'generic' END"""
register("stmt_identity", lambda v: identity.identify(file_names(v), registry(v), RULES, generic_by="similarity"), LCS + f"""
SELECT path, iso, CASE WHEN error IS NULL THEN make_date(CAST(year AS INT), m, 1) END AS date, layout,
  CASE WHEN error IS NULL THEN {FAMILY_CASE} END AS family, error
FROM (SELECT *, CASE WHEN month_word = '' THEN 'filename_format' WHEN layout IS NULL THEN 'no_matching_layout' WHEN m IS NULL THEN 'invalid_month' END AS error
  FROM (SELECT p.*, {MONTH_CASE} AS m, CASE WHEN similarity >= 80 THEN layout END AS layout, CASE WHEN similarity >= 80 THEN iso END AS iso
    FROM parts p LEFT JOIN best b ON p.name <> '' AND lower(p.name) = b.lname) q) z""")
register("stmt_substring_layout", lambda v: identity.match_substring(file_names(v), registry(v)), f"""
SELECT f.path, h.layout, h.layout AS iso FROM ({NAMES}) f LEFT JOIN (
  SELECT u.path, arg_min(i.iso, i.id) AS layout FROM (SELECT DISTINCT path FROM ({NAMES}) n) u JOIN iso i
  ON contains(lower(regexp_replace(regexp_replace(u.path, '\\.[^.]*$', ''), '[^a-zA-Z0-9]', '', 'g')), lower(regexp_replace(i.iso, '[^a-zA-Z0-9]', '', 'g')))
  GROUP BY u.path) h ON h.path = f.path""")
register("layout_dispatch", lambda v: v.merchants.select("mid", "iso", identity.dispatch(F.col("iso"), RULES).alias("family")),
         f"SELECT mid, iso, {FAMILY_CASE} AS family FROM merchants")

# --- header search --------------------------------------------------------------------------
GENERIC_HEADERS = ["Merchant ID", "Merchant", "Sales Amount", "Net", "Agent Net"]


def header_of(condition):
    return lambda v: grids.first_rows(generic_grid(v), condition()).select("path", "sheet_idx", "header_row")


def _first_row(having: str, where: str) -> str:
    return f"""SELECT path, sheet_idx, MIN(row_idx) AS header_row FROM (
  SELECT path, sheet_idx, row_idx FROM cells WHERE {where} GROUP BY path, sheet_idx, row_idx HAVING {having}) h GROUP BY path, sheet_idx"""


IN_HEADERS = "value IN ('Merchant ID', 'Merchant', 'Sales Amount', 'Net', 'Agent Net')"
register("stmt_header_all", header_of(lambda: grids.has_all(W._strings(GENERIC_HEADERS))),
         _first_row("COUNT(DISTINCT value) = 5", IN_HEADERS))
register("stmt_header_any", header_of(lambda: grids.has_any(W._strings(["Net", "Payout"]))),
         _first_row("COUNT(*) >= 1", "trim(value) IN ('Net', 'Payout')"))
register("stmt_header_contains", header_of(lambda: grids.has_marker("MERCHANT", ignore_case=True)),
         _first_row("COUNT(*) >= 1", "contains(lower(value), 'merchant')"))
register("stmt_header_cell", header_of(lambda: grids.has_cell("Merchant ID")), _first_row("COUNT(*) >= 1", "value = 'Merchant ID'"))


def clean_headers(v: Views) -> DataFrame:
    """All cell texts of the ledger's statements in the three clean-up forms."""
    raw = F.concat(F.lit(" \n"), "value", F.lit(" (less\nfees)  "))
    return grids.to_cells(generic_grid(v)).select(
        "path", "row_idx", "col_idx", text.one_line(raw).alias("one_line"), text.slug(raw).alias("slug"),
        text.stripped(raw).alias("stripped"),
    )


register("stmt_clean_headers", clean_headers, r"""
SELECT path, row_idx, col_idx, regexp_replace(replace(raw, chr(10), ' '), '^\s+|\s+$', '', 'g') AS one_line,
  regexp_replace(lower(raw), '[^a-z0-9_]', '', 'g') AS slug, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS stripped
FROM (SELECT path, row_idx, col_idx, concat(' ', chr(10), value, ' (less', chr(10), 'fees)  ') AS raw FROM cells) c""")


def table_below(v: Views) -> DataFrame:
    grid = generic_grid(v)
    headers = grids.first_rows(grid, grids.has_all(W._strings(GENERIC_HEADERS)))
    texts = grids.header_texts()
    wanted = dict(zip(("mid", "dba", "volume", "total_residual", "house_residual"), GENERIC_HEADERS))
    columns = {t: grids.column_of(texts, F.lit(h)) for t, h in wanted.items()}
    return grids.sheet_table(grid, headers, {**columns, "absent": grids.column_of(texts, F.lit("No such header"))})


register("stmt_table", table_below, f"""
SELECT c.path, c.sheet_idx, c.row_idx, MAX(CASE WHEN h.value = 'Merchant ID' THEN c.value END) AS mid,
  MAX(CASE WHEN h.value = 'Merchant' THEN c.value END) AS dba, MAX(CASE WHEN h.value = 'Sales Amount' THEN c.value END) AS volume,
  MAX(CASE WHEN h.value = 'Net' THEN c.value END) AS total_residual, MAX(CASE WHEN h.value = 'Agent Net' THEN c.value END) AS house_residual,
  CAST(NULL AS VARCHAR) AS absent
FROM cells c JOIN ({_first_row("COUNT(DISTINCT value) = 5", IN_HEADERS)}) f ON c.path = f.path AND c.sheet_idx = f.sheet_idx AND c.row_idx > f.header_row
JOIN cells h ON h.path = f.path AND h.sheet_idx = f.sheet_idx AND h.row_idx = f.header_row AND h.col_idx = c.col_idx
GROUP BY c.path, c.sheet_idx, c.row_idx""")


def candidate_columns(v: Views) -> DataFrame:
    headers = grids.first_rows(generic_grid(v), grids.has_cell("Merchant ID"))
    texts = grids.header_texts()
    wanted = {"mid": ["MID", "Merchant ID", "Merchant"], "total_residual": ["Agent Net", "Net"], "volume": ["Volume"]}
    return headers.select(
        "path", "sheet_idx", *[grids.first_candidate(texts, W._strings(c)).alias(t) for t, c in wanted.items()]
    )


register("stmt_first_candidate_column", candidate_columns, f"""
SELECT f.path, f.sheet_idx, arg_min(h.col_idx, CASE h.value WHEN 'MID' THEN 1 WHEN 'Merchant ID' THEN 2 WHEN 'Merchant' THEN 3 END) AS mid,
  arg_min(h.col_idx, CASE h.value WHEN 'Agent Net' THEN 1 WHEN 'Net' THEN 2 END) AS total_residual, CAST(NULL AS INT) AS volume
FROM ({_first_row("COUNT(*) >= 1", "value = 'Merchant ID'")}) f JOIN cells h ON h.path = f.path AND h.sheet_idx = f.sheet_idx AND h.row_idx = f.header_row
GROUP BY f.path, f.sheet_idx""")


def lacking_columns(v: Views) -> DataFrame:
    headers = grids.first_rows(generic_grid(v), grids.has_cell("Merchant ID"))
    required = W._strings(["MID", "Merchant", "Net", "Total Profit"])
    return headers.select("path", "sheet_idx", F.explode(grids.missing_columns(grids.header_texts(), required)).alias("missing"))


register("stmt_required_columns", lacking_columns, f"""
SELECT f.path, f.sheet_idx, w.missing FROM ({_first_row("COUNT(*) >= 1", "value = 'Merchant ID'")}) f
CROSS JOIN (VALUES ('MID'), ('Merchant'), ('Net'), ('Total Profit')) w(missing)
WHERE NOT EXISTS (SELECT 1 FROM cells h WHERE h.path = f.path AND h.sheet_idx = f.sheet_idx AND h.row_idx = f.header_row AND h.value = w.missing)""")

# --- scalar rules ---------------------------------------------------------------------------
ID_FORMS = """CASE l_orderkey % 8 WHEN 0 THEN CAST(l_partkey AS VARCHAR) WHEN 1 THEN concat('63-', CAST(l_partkey AS VARCHAR))
  WHEN 2 THEN concat(CAST(l_partkey AS VARCHAR), '.0') WHEN 3 THEN concat(CAST(l_partkey AS VARCHAR), '.75') WHEN 4 THEN concat('A', CAST(l_partkey AS VARCHAR))
  WHEN 5 THEN 'Total' WHEN 6 THEN '' END"""


def id_cells(v: Views) -> DataFrame:
    """Merchant id cells in many spellings, one per order line, stored as text or as number."""
    k, p = F.col("l_orderkey") % 8, F.col("l_partkey").cast("string")
    value = (
        F.when(k == 0, p).when(k == 1, F.concat(F.lit("63-"), p)).when(k == 2, F.concat(p, F.lit(".0")))
        .when(k == 3, F.concat(p, F.lit(".75"))).when(k == 4, F.concat(F.lit("A"), p)).when(k == 5, "Total").when(k == 6, "")
    )
    kind = F.when(k.isin(0, 2, 3) & (F.col("l_linenumber") % 2 == 0), "n").otherwise("s")
    return v.read("lineitem").select("l_orderkey", "l_linenumber", F.struct(value.alias("value"), kind.alias("kind")).alias("cell"))


ID_CELLS = f"""(SELECT l_orderkey, l_linenumber, {ID_FORMS} AS v,
  CASE WHEN l_orderkey % 8 IN (0, 2, 3) AND l_linenumber % 2 = 0 THEN 'n' ELSE 's' END AS k FROM lineitem) c"""
WHOLE = "k = 'n' AND CAST(v AS DOUBLE) = floor(CAST(v AS DOUBLE))"
CANON = f"CASE WHEN {WHOLE} THEN CAST(CAST(CAST(v AS DOUBLE) AS BIGINT) AS VARCHAR) ELSE v END"
DASH_OK = "regexp_matches(replace(v, '-', ''), '^[0-9]+$')"
ID_RULES = {
    "mid_valid_dash": (merchant_ids.dash, f"CASE WHEN k = 'n' OR {DASH_OK} THEN {CANON} END"),
    "mid_valid_dash_text": (merchant_ids.dash_text, f"CASE WHEN regexp_matches(replace({CANON}, '-', ''), '^[0-9]+$') THEN replace({CANON}, '.0', '') END"),
    "mid_valid_numeric": (merchant_ids.numeric, "CAST(CAST(trunc(TRY_CAST(NULLIF(v, '') AS DOUBLE)) AS BIGINT) AS VARCHAR)"),
    "mid_valid_integral_kind": (merchant_ids.integral_kind, f"CASE WHEN {WHOLE} THEN CAST(CAST(CAST(v AS DOUBLE) AS BIGINT) AS VARCHAR) END"),
    "mid_valid_digit_string": (merchant_ids.digit_string, "CASE WHEN k = 's' AND regexp_matches(v, '^[0-9]+$') THEN v END"),
    "mid_valid_int_or_digits": (merchant_ids.int_or_digits, f"CASE WHEN {WHOLE} THEN CAST(CAST(CAST(v AS DOUBLE) AS BIGINT) AS VARCHAR) WHEN k = 's' AND regexp_matches(v, '^[0-9]+$') THEN v END"),
    "mid_strip_point_zero": (lambda c: merchant_ids.strip_point_zero(c["value"]), "replace(v, '.0', '')"),
}
for _name, (_rule, _sql) in ID_RULES.items():
    register(_name, lambda v, rule=_rule: id_cells(v).select("l_orderkey", "l_linenumber", rule(F.col("cell")).alias("mid")),
             f"SELECT l_orderkey, l_linenumber, {_sql} AS mid FROM {ID_CELLS}")


def money_texts(v: Views) -> DataFrame:
    """Amounts of every order line in many notations, some unreadable."""
    x = F.col("l_extendedprice").cast("decimal(12,2)")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 9
    plain = x.cast("string")
    value = (
        F.when(k == 0, plain).when(k == 1, F.concat(F.lit("$"), F.format_number(x, 2))).when(k == 2, F.concat(F.lit("("), plain, F.lit(")")))
        .when(k == 3, F.concat(F.lit("($"), F.format_number(x, 2), F.lit(")"))).when(k == 4, F.concat(F.lit("-"), plain, F.lit("7")))
        .when(k == 5, F.concat(F.lit("="), plain)).when(k == 6, F.lit("n/a")).when(k == 7, F.concat(plain, F.lit("d")))
    )
    return v.read("lineitem").select("l_orderkey", "l_linenumber", value.alias("value"))


MONEY = """(SELECT l_orderkey, l_linenumber, k, x, CAST(x AS VARCHAR) AS p FROM (SELECT l_orderkey, l_linenumber,
  (l_orderkey + l_linenumber) % 9 AS k, CAST(l_extendedprice AS DECIMAL(12,2)) AS x FROM lineitem) y) m"""
PLUS, LONG = "CAST(p AS DOUBLE)", "CAST(concat('-', p, '7') AS DOUBLE)"
MONEY_RULES = {
    "money_ceil": (numbers.money_ceil, f"CASE k WHEN 0 THEN ceil({PLUS} * 100) / 100 WHEN 1 THEN ceil({PLUS} * 100) / 100 WHEN 4 THEN ceil({LONG} * 100) / 100 ELSE 0.0 END"),
    "money_paren": (numbers.money_paren, f"CASE k WHEN 0 THEN {PLUS} WHEN 1 THEN {PLUS} WHEN 2 THEN -{PLUS} WHEN 3 THEN -{PLUS} WHEN 4 THEN {LONG} END"),
    "money_paren_plain": (numbers.money_paren_plain, f"CASE k WHEN 0 THEN {PLUS} WHEN 2 THEN -{PLUS} WHEN 4 THEN round_even({LONG} * 100, 0) / 100 END"),
    "money_lenient": (numbers.money_lenient, f"CASE k WHEN 0 THEN {PLUS} WHEN 4 THEN round_even({LONG} * 100, 0) / 100 ELSE 0 END"),
    "money_strict": (numbers.money_strict, f"CASE k WHEN 0 THEN {PLUS} WHEN 1 THEN {PLUS} WHEN 4 THEN {LONG} END"),
    "money_coerce": (numbers.money_coerce, f"CASE k WHEN 0 THEN {PLUS} WHEN 1 THEN {PLUS} WHEN 4 THEN {LONG} END"),
}
for _name, (_rule, _sql) in MONEY_RULES.items():
    register(_name, lambda v, rule=_rule: money_texts(v).select("l_orderkey", "l_linenumber", rule(F.col("value")).alias("amount")),
             f"SELECT l_orderkey, l_linenumber, CAST({_sql} AS DOUBLE) AS amount FROM {MONEY}")

register("text_after_marker", lambda v: v.read("documents").select("doc_id", text.text_after_marker(F.col("text"), " a").alias("rest")),
         r"SELECT doc_id, regexp_replace(list_element(string_split(text, ' a'), -1), '^\s+|\s+$', '', 'g') AS rest FROM documents")
register("month_from_tokens", lambda v: W.lines(v).select("path", "full_path", text.month_from_tokens(F.col("full_path")).alias("month"),
                                                         text.month_from_tokens(F.col("path")).alias("short_month")), """
SELECT path, full_path, date AS month, CASE WHEN path LIKE '% May ____.csv' THEN date END AS short_month FROM stmt_lines""")

# --- layouts --------------------------------------------------------------------------------
SHOWN = ("path", "sheet_idx", "row_idx", "iso", "mid", "dba", "volume", "total_residual", "house_residual", "reject")


def layout_query(name: str, v: Views) -> DataFrame:
    W.derive_once(v)
    grid = W.WRITERS[name](W.lines(v))
    if name == "form_per_sheet":
        out = form_sheets.form_per_sheet(grid)
    elif name == "column_blocks":
        out = column_blocks.column_blocks(grid)
    elif name == "generic":
        out = extract.read_layout(grid.withColumn("layout", F.col("iso")), name, registry(v))
    else:
        out = extract.read_layout(grid, name)
    return out.select(*SHOWN)


V, T, H = (f"CAST({c} AS DOUBLE)" for c in ("volume", "total_residual", "house_residual"))


def ceil_cents(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN 0.0 ELSE ceil(CAST({c} AS DOUBLE) * 100) / 100 END"


DASHED = "CASE WHEN pos % 5 = 0 THEN concat(substr(mid, 1, 4), '-', substr(mid, 5)) ELSE mid END"
NO_REJECT = "CAST(NULL AS VARCHAR)"
GARBLED = "CASE WHEN pos % 50 = 7 THEN 'unreadable_amount' END"


def expected(name: str, row: str, volume=V, total=T, house=H, sheet="0", iso="iso", mid="mid", dba="dba",
             reject=NO_REJECT, where="TRUE", path="path") -> str:
    return f"""SELECT {path} AS path, CAST({sheet} AS INT) AS sheet_idx, CAST({row} AS BIGINT) AS row_idx, {iso} AS iso, {mid} AS mid, {dba} AS dba,
CAST({volume} AS DOUBLE) AS volume, CAST({total} AS DOUBLE) AS total_residual, CAST({house} AS DOUBLE) AS house_residual, {reject} AS reject
FROM stmt_lines WHERE {where}"""


HOUSE_OR_GARBLED = f"CASE WHEN pos % 50 = 7 THEN NULL ELSE {H} END"
LAYOUTS = {
    "generic": expected("generic", "hdr + 1 + pos", volume=f"CASE WHEN id % 5 = 0 THEN 0.0 ELSE {ceil_cents('volume')} END",
                        total=ceil_cents("total_residual"), house=ceil_cents("house_residual"), mid=DASHED),
    "net_collections": expected("net_collections", "1 + 2 * pos", volume="0.0", total="0.0", house="CAST(total_residual - abs(volume) AS DOUBLE)"),
    "two_volume": expected("two_volume", "1 + pos", volume="CAST(volume AS DOUBLE) + CASE WHEN pos % 2 = 0 THEN 1.25 ELSE 0.0 END", sheet="1"),
    "commission_group": expected("commission_group", "1 + 2 * pos", volume="0.0", total="CAST(total_residual + 1 AS DOUBLE)"),
    "marker_header": expected("marker_header", "hdr + 1 + pos", sheet="1"),
    "split_70": expected("split_70", "1 + pos", house=HOUSE_OR_GARBLED, reject=GARBLED),
    "multi_sheet": expected("multi_sheet", "1 + pos", sheet="pos % 3", iso="concat(iso, CASE pos % 3 WHEN 0 THEN ' EMS' WHEN 1 THEN ' FD' ELSE ' CMS' END)",
                            volume=f"CASE WHEN pos % 3 = 0 THEN {V} ELSE {V} END"),
    "form_per_sheet": expected("form_per_sheet", "0", total="0.0", sheet="pos", dba="CASE WHEN pos % 7 <> 0 THEN dba END"),
    "first_valid_sheet": expected("first_valid_sheet", "hdr + 1 + pos", sheet="1", house=HOUSE_OR_GARBLED, reject=GARBLED),
    "int_or_digits": expected("int_or_digits", "hdr + 1 + pos"),
    "all_sheets_union": expected("all_sheets_union", "hdr + 1 + pos", volume="0.0", sheet="pos % 2"),
    "processor_marker": expected("processor_marker", "hdr + 1 + pos", where="pos % 10 <> 3"),
    "payout_period": expected("payout_period", "hdr + 1 + 2 * pos", total="0.0", house="CAST(house_residual + 1.5 AS DOUBLE)",
                              where="pos % 6 <> 1", path="full_path"),
    "column_blocks": expected("column_blocks", "1", volume="CAST(volume + 1.25 AS DOUBLE)", total="CAST(total_residual + 3 AS DOUBLE)", sheet="1", path="line_path")
    + " UNION ALL " + expected("column_blocks", "17", volume="5.5", total="2.5", house="4.0", sheet="1", mid="concat(mid, '7')", dba="concat(dba, ' B')", path="line_path"),
    "active_sheet": expected("active_sheet", "hdr + 1 + pos", sheet="1"),
    "paynote": expected("paynote", "hdr + 1 + pos", volume=ceil_cents("volume"), total=ceil_cents("total_residual"), house=ceil_cents("house_residual"), mid=DASHED),
}


def payout_unreadable(v: Views) -> DataFrame:
    W.derive_once(v)
    return extract.read_layout(W.payout_period(W.lines(v), unreadable=True), "payout_period").select(*SHOWN)


register("layout_payout_unreadable", payout_unreadable, " UNION ALL ".join([
    expected("payout_period", "hdr + 1 + 2 * pos", total="0.0", house="CAST(house_residual + 1.5 AS DOUBLE)", where="pos % 6 NOT IN (1, 2)", path="full_path"),
    expected("payout_period", "hdr + 1 + 2 * pos", total="0.0", reject="'unreadable_date'", where="pos % 6 = 2", path="full_path"),
    expected("payout_period", "hdr + 2 + 2 * pos", volume="0.0", total="0.0", house="1.5", reject="'unreadable_date'", where="pos % 6 = 2", path="full_path"),
]))
for _name, _sql in LAYOUTS.items():
    register(f"layout_{_name}", lambda v, name=_name: layout_query(name, v), _sql)
