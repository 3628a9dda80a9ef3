"""CSV statements to grid rows.

One parser for files of any size. Lines are numbered inside splits; ``csv_lines`` finds out which
of them start inside a quoted field and glues records together. Field splitting is a
column expression, so nothing leaves the JVM.

A file that is no UTF-8, or whose last quoted field is never closed, yields a single row with
``sheet_idx`` -1 and the reason in ``sheet``, so that the load refuses it by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.schemas import GRID_COLUMNS, UNREADABLE_SHEET

# File names by extension, whatever its case.
CSV_NAMES = "*.[cC][sS][vV]"
XLSX_NAMES = "*.[xX][lL][sS][xX]"
STATEMENT_NAMES = "*.{[cC][sS][vV],[xX][lL][sS][xX]}"

# Texts that stand for an empty cell.
EMPTY_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A field is quoted only when the quote is its first character; possessive quantifiers keep the
# matcher iterative on fields of any length.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+(?:"|\z)[^,\r\n]*+'
_FIELD = rf'(?:{_QUOTED}|[^",\r\n][^,\r\n]*+|)'
def _unquoted(field: Column) -> Column:
    shape = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?+(.*)$'
    inner = F.replace(F.regexp_extract(field, shape, 1), F.lit('""'), F.lit('"'))
    return F.when(F.startswith(field, F.lit('"')), F.concat(inner, F.regexp_extract(field, shape, 2))).otherwise(field)


def fields(record: Column) -> Column:
    """Cells of a record; empty ones are left out."""
    # with a comma in front every field, even an empty one, is a match of its own
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_FIELD})"), F.lit(1))
    cells = F.transform(
        found,
        lambda f, i: F.struct(i.cast("int").alias("col_idx"), _unquoted(f).alias("value"), F.lit("s").alias("kind")),
    )
    return F.filter(cells, lambda c: ~c["value"].isin(*EMPTY_TEXTS))


def _grid(read: DataFrame) -> DataFrame:
    """Grid rows of ``path, row_idx, record, problem``."""
    broken = F.col("problem").isNotNull()
    no_cells = F.filter(fields(F.lit("")), lambda c: F.lit(False))
    return read.select(
        "path", F.when(broken, F.lit(UNREADABLE_SHEET)).otherwise(0).alias("sheet_idx"), F.coalesce("problem", F.lit("CSV")).alias("sheet"),
        (~broken).alias("is_active"), F.col("row_idx").cast("bigint").alias("row_idx"),
        F.when(broken, no_cells).otherwise(fields(F.col("record"))).alias("cells"),
    ).select(*GRID_COLUMNS)


def csv_grid(files: DataFrame) -> DataFrame:
    """Grid rows of CSV files given as ``path`` and ``content`` bytes; other columns are kept."""
    from ledgermill.sources.csv_lines import content_lines, records

    carried = [c for c in files.columns if c not in ("path", "content")]
    grid = _grid(records(content_lines(files)))
    return grid.join(files.select("path", *carried), "path").select(*GRID_COLUMNS, *carried) if carried else grid


def list_files(spark: SparkSession, location: str, names: str = "*") -> DataFrame:
    """``path, content, length`` of the files below a folder or behind a glob whose name matches
    ``names``. Content is read only if used."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", names)
    return reader.option("recursiveFileLookup", "true").load(location).select("path", "content", "length")


def read_csv_grid(spark: SparkSession, location: str | list[str]) -> DataFrame:
    """Grid rows of every CSV file below a folder, behind a glob or in a list of files, whatever its size."""
    from ledgermill.sources.csv_lines import read_records

    return _grid(read_records(spark, location))
