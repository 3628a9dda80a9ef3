"""Grid rows to statement lines, for any mix of layouts in one pass.

Every layout with a header row goes through the same three steps: find the header row of each
sheet, locate the target columns in it, project the rows below. What differs per layout is
chosen by ``CASE`` on the row's layout family, so a mixed batch is read once for headers and
once for rows, whatever the number of layouts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import dates, merchant_ids, numbers, text
from ledgermill.operators import grids
from ledgermill.operators.layout_specs import (
    HEADERS, SHEET_CANDIDATES, SHEET_LABELS, Layout, layouts,
)
from ledgermill.schemas import AMOUNTS, SHEET_KEYS

SLOTS = ("mid", "dba", *AMOUNTS, "other")
LINE_COLUMNS = ("path", "sheet_idx", "row_idx", "iso", "date", "mid", "dba", *AMOUNTS, "reject")

REJECT_COLUMNS = "missing_columns"
REJECT_DUPLICATE = "duplicate_column"
REJECT_AMOUNT = "unreadable_amount"
REJECT_MID = "no_merchant_id"
REJECT_PERIOD = "no_period_in_name"
REJECT_DATE = "unreadable_date"


def _case(specs: Iterable[Layout], pick: Callable[[Layout], object], build: Callable[[object], Column]) -> Column:
    """CASE over the layout family; layouts that share an option share one branch."""
    branches: list[tuple[object, list[str]]] = []
    for spec in specs:
        option = pick(spec)
        for known, names in branches:
            if known == option:
                names.append(spec.name)
                break
        else:
            branches.append((option, [spec.name]))
    if len(branches) == 1:
        return build(branches[0][0])
    out = None
    for option, names in branches:
        here = F.col("family").isin(names)
        value = build(option)
        out = F.when(here, value) if out is None else out.when(here, value)
    return out


def with_family(grid: DataFrame, family: str) -> DataFrame:
    """A grid of one known layout, with empty identity columns where it has none."""
    for name, kind in (("iso", "string"), ("date", "date"), ("layout", "string")):
        if name not in grid.columns:
            grid = grid.withColumn(name, F.lit(None).cast(kind))
    return grid.withColumn("family", F.lit(family))


def registry_headers(registry: DataFrame) -> DataFrame:
    """Per registry layout: target -> header map and the headers that must be present."""
    named = registry.filter("source <> ''")
    return named.groupBy("layout").agg(
        F.map_from_entries(F.collect_list(F.struct("target", "source"))).alias("sources"),
        F.collect_set("source").alias("required"),
    )


def _literal(names: Iterable[str]) -> str:
    quoted = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names)
    return f"cast(array({quoted}) AS array<string>)"


def _wanted(specs: list[Layout], slot: str, candidates: dict[str, dict[str, list[str]]]) -> str:
    """SQL for the headers that can stand for ``slot``, in order of preference, per family.

    Written as text: it is all literals, and one expression is far cheaper to hand to the JVM
    than a Column per header name.
    """
    branches = []
    for spec in specs:
        if spec.name == "generic":
            value = f"array_compact(array(try_element_at(sources, '{slot}')))"
        elif spec.name == "multi_sheet":
            sheets = [f"WHEN {_literal([sheet])}[0] THEN {_literal(c[slot])}" for sheet, c in candidates.items() if slot in c]
            value = f"CASE sheet {' '.join(sheets)} ELSE {_literal([])} END" if sheets else _literal([])
        else:
            names = [spec.headers[slot]] if slot in spec.headers else []
            value = _literal(text.slug_name(n) if spec.clean is text.slug else n for n in names)
        branches.append(f"WHEN '{spec.name}' THEN {value}")
    return f"CASE family {' '.join(branches)} ELSE {_literal([])} END"


def find_headers(
    grid: DataFrame, specs: list[Layout], registry: DataFrame | None = None,
    sheet_candidates: dict[str, dict[str, list[str]]] | None = None,
) -> DataFrame:
    """One row per sheet that has a header: its row, the column index per slot, and what is
    wrong with it (NULL when nothing is)."""
    names = [s.name for s in specs]
    keep = ["family", "sheet"]
    rows = grid
    if "generic" in names:
        if registry is None:
            raise ValueError("the generic layout needs a layout registry")
        rows = grid.join(registry_headers(registry), "layout", "left")
        keep.append("sources")
    condition = None
    for spec in specs:
        here = (F.col("family") == spec.name) & spec.header
        condition = here if condition is None else condition | here
    headers = grids.first_rows(rows, condition, *keep)

    reversed_names = [s.name for s in specs if s.last_duplicate]
    cleaned = headers.withColumns({
        "texts": _case(specs, lambda s: s.clean, grids.header_texts),
        "columns": F.col("header")["col_idx"],
        **{f"want_{slot}": F.expr(_wanted(specs, slot, sheet_candidates or SHEET_CANDIDATES)) for slot in SLOTS},
    })
    if reversed_names:
        last_wins = F.col("family").isin(reversed_names)
        cleaned = cleaned.withColumns({
            c: F.when(last_wins, F.reverse(c)).otherwise(F.col(c)) for c in ("texts", "columns")
        })
    located = cleaned.withColumns({
        f"at_{slot}": F.expr(
            f"get(array_compact(transform(want_{slot}, "
            "w -> get(columns, cast(array_position(texts, w) - 1 AS int)))), 0)"
        )
        for slot in SLOTS
    })
    lacking = " OR ".join(f"(size(want_{s}) > 0 AND at_{s} IS NULL)" for s in SLOTS)
    repeated = " OR ".join(f"size(filter(texts, t -> t = get(want_{s}, 0))) > 1" for s in SLOTS)
    strict = [s.name for s in specs if not s.optional]
    headers = located.withColumn(
        "problem",
        F.when(F.col("family").isin(strict) & F.expr(lacking), REJECT_COLUMNS)
        .when((F.col("family") == "generic") & F.coalesce(F.expr(repeated), F.lit(False)), REJECT_DUPLICATE),
    )
    if "first_valid_sheet" in names:
        # one row per sheet of a workbook: the group is bounded by the number of sheets
        order = Window.partitionBy("path").orderBy("sheet_idx")
        headers = headers.withColumn("nth", F.row_number().over(order)).filter(
            (F.col("family") != "first_valid_sheet") | (F.col("nth") == 1)
        )
    return headers.select(*SHEET_KEYS, "header_row", "problem", *[f"at_{s}" for s in SLOTS])


def _worked_out(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows with further columns, each worked out once a row. A generator of one row keeps the optimizer from copying
    their expressions into every filter and column that uses them."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def read_lines(grid: DataFrame, headers: DataFrame, specs: list[Layout]) -> DataFrame:
    """Lines below the headers, before grouping. A sheet whose header has a problem yields one
    rejected line, at the header row."""
    payout = any(s.name == "payout_period" for s in specs)
    if payout:  # the month in a file's name is looked up once a sheet
        headers = headers.withColumn("_month", text.month_from_tokens(text.base_name(F.col("path"))))
    joined = grid.join(headers, list(SHEET_KEYS)).filter(
        (F.col("problem").isNull() & (F.col("row_idx") > F.col("header_row")))
        | (F.col("problem").isNotNull() & (F.col("row_idx") == F.col("header_row")))
    )
    cells = joined.select(
        "path", "sheet_idx", "sheet", "row_idx", "iso", "date", "family", "problem", *(["_month"] if payout else []),
        *[F.when(F.col("problem").isNull(), F.expr(f"get(filter(cells, c -> c.col_idx = at_{s}), 0)")).alias(s) for s in SLOTS],
    )
    blank, every = F.lit(True), F.lit(True)
    for slot in SLOTS:
        blank = blank & F.col(slot).isNull()
    for slot in ("mid", "dba", *AMOUNTS):
        every = every & F.col(slot).isNotNull()
    found = {
        "mid_text": _case(specs, lambda s: s.mid, lambda rule: rule(F.col("mid"))), "dba_text": merchant_ids.canonical(F.col("dba")),
        **{f"raw_{slot}": F.col(slot)["value"] for slot in (*AMOUNTS, "other")}, "is_blank": blank, "is_full": every,
    }
    if payout:
        found["_day_text"] = F.when(F.col("family") == "payout_period", dates.without_time(F.col("other")["value"]))
    ids = _worked_out(cells, **found).drop(*SLOTS)
    keeps_blank = [s.name for s in specs if s.keep_blank_mid]
    accepted = (
        F.col("problem").isNotNull() | F.col("mid_text").isNotNull()
        | (F.col("family").isin(keeps_blank) & ~F.col("is_blank"))
    )
    ids = ids.filter(accepted)
    complete = [s.name for s in specs if s.complete_rows]
    if complete:
        ids = ids.filter(F.col("problem").isNotNull() | ~F.col("family").isin(complete) | F.col("is_full"))
    if payout:
        month = F.col("_month")
        ids = ids.withColumn(
            "problem", F.when((F.col("family") == "payout_period") & month.isNull(), REJECT_PERIOD)
            .otherwise(F.col("problem")),
        )
        ids = _worked_out(ids, _day=dates.day(F.col("_day_text")))
        day_text, day = F.col("_day_text"), F.col("_day")
        # a line whose filled date says nothing is refused rather than left out
        lost = (F.col("family") == "payout_period") & (day_text != "") & day.isNull() & F.col("mid_text").isNotNull()
        ids = ids.withColumn("problem", F.coalesce("problem", F.when(lost, REJECT_DATE)))
        ids = ids.filter(
            F.col("problem").isNotNull() | (F.col("family") != "payout_period")
            | (F.trunc(day, "month") == month)
        )

    money = {
        slot: _case(specs, lambda s: s.money, lambda rule, slot=slot: rule(F.col(f"raw_{slot}")))
        for slot in (*AMOUNTS, "other")
    }
    parsed = ids.select(
        "path", "sheet_idx", "sheet", "row_idx", "iso", "date", "family", "problem",
        F.col("mid_text").alias("mid"), F.col("dba_text").alias("dba"),
        *[f"raw_{slot}" for slot in (*AMOUNTS, "other")],
        *[money[slot].alias(slot) for slot in (*AMOUNTS, "other")],
    )
    family = F.col("family")
    unreadable_other = F.col("raw_other").isNotNull() & F.col("other").isNull()
    both = F.coalesce("volume", F.lit(0.0)) + F.coalesce("other", F.lit(0.0))
    both = F.when(~(unreadable_other | (F.col("raw_volume").isNotNull() & F.col("volume").isNull())), both)
    parsed = parsed.withColumns({
        "volume": F.when(family == "two_volume", both).otherwise(F.col("volume")),
        "house_residual": F.when(
            family == "net_collections",
            F.col("house_residual") - F.abs("other"),
        ).otherwise(F.col("house_residual")),
    })

    zeros = {slot: [s.name for s in specs if slot in s.zero or s.missing == "zero"] for slot in AMOUNTS}
    parsed = parsed.withColumns({
        slot: F.when(family.isin(zeros[slot]), F.coalesce(slot, F.lit(0.0))).otherwise(F.col(slot))
        for slot in AMOUNTS if zeros[slot]
    })
    refuse = [s.name for s in specs if s.missing == "reject"]
    bad_amount = F.lit(False)
    for slot in AMOUNTS:
        bad_amount = bad_amount | F.col(slot).isNull()
    labels = F.create_map(*[F.lit(x) for pair in SHEET_LABELS.items() for x in pair])
    sheet_iso = F.concat_ws(
        " ", F.col("iso"), F.coalesce(F.try_element_at(labels, F.col("sheet")), F.col("sheet"))
    )
    return parsed.select(
        "path", "sheet_idx", "row_idx",
        F.when(family == "multi_sheet", sheet_iso).otherwise(F.col("iso")).alias("iso"),
        "date", "family", "mid", "dba", *AMOUNTS,
        F.coalesce(
            F.col("problem"),
            F.when(F.col("mid").isNull(), REJECT_MID),
            F.when(family.isin(refuse) & bad_amount, REJECT_AMOUNT),
        ).alias("reject"),
    )


def _grouped(lines: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """One line per statement and key: first name by row order, exact sums, nothing counts as 0.
    Keys with a NULL part are dropped; rejected lines pass through ungrouped."""
    keys = ["path", "iso", "date", *by]
    for key in by:
        lines = lines.filter(F.col("reject").isNotNull() | F.col(key).isNotNull())
    position = F.struct("sheet_idx", "row_idx")
    broken = F.when(F.col("reject").isNotNull(), F.col("row_idx"))
    names = [] if "dba" in by else [F.min_by("dba", F.when(F.col("dba").isNotNull(), position)).alias("dba")]
    sums = [
        numbers.cents(F.coalesce(F.sum(numbers.exact(F.col(a))), F.lit(0)).cast("double")).alias(a)
        for a in AMOUNTS
    ]
    return (
        lines.groupBy(*keys, broken.alias("_broken"))
        .agg(F.min(position).alias("_at"), *names, *sums, F.max("reject").alias("reject"))
        .select("path", "_at.sheet_idx", "_at.row_idx", "iso", "date", "mid", "dba", *AMOUNTS, "reject")
    )


def extract(
    grid: DataFrame, specs: Iterable[Layout], registry: DataFrame | None = None,
    sheet_candidates: dict[str, dict[str, list[str]]] | None = None,
) -> DataFrame:
    """Statement lines of all layouts in ``specs``. ``grid`` carries ``family``, ``layout``,
    ``iso`` and ``date`` next to the grid columns."""
    specs = list(specs)
    out = None
    for by in {s.group_by: None for s in specs}:
        group = [s for s in specs if s.group_by == by]
        rows = grid.filter(F.col("family").isin([s.name for s in group]))
        headers = find_headers(rows, group, registry, sheet_candidates)
        lines = read_lines(rows, headers, group)
        lines = _grouped(lines, by) if by else lines
        lines = lines.select(*LINE_COLUMNS)
        out = lines if out is None else out.unionByName(lines)
    return out


def read_layout(grid: DataFrame, name: str, registry: DataFrame | None = None, **options) -> DataFrame:
    """Lines of a grid whose statements all have layout ``name``."""
    spec = layouts(**options)[name]
    return extract(with_family(grid, name), [spec], registry, options.get("sheet_candidates"))


def required_columns(name: str) -> list[str]:
    return list(HEADERS[name].values())
