"""Records of CSV files of any size.

Lines are read in splits. Whether a line starts inside a quoted field depends on all lines
before it, so every line is described by what it does to that state (keep, flip, open, close);
descriptions are combined inside a chunk of a split, chunks are combined per file, and lines that
continue a record are glued together, with the line ends they had. Chunks have a bounded number of
lines, so that sorting them spreads over many tasks however few the files and splits are. A file that ends inside a quoted field is
unreadable, so an unclosed quote never glues the rest of a file into one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.functions.text import stripped
from ledgermill.sources.csv_cells import CSV_NAMES

NOT_UTF8 = "not UTF-8"
UNCLOSED = "unclosed quote"

# Matches a text whose last field is an unfinished quoted one.
_CLOSED = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_OPEN = rf'(?s)^(?:{_CLOSED},)*+"[^"]*+(?:""[^"]*+)*+\z'
SPLIT = ["path", "block", "chunk"]

# Lines of a chunk: two to the power of this.
CHUNK_BITS = 16
# Tasks that sort the lines of one split.
TASKS_A_SPLIT = 8


def _opens(line: Column) -> Column:
    return line.rlike(_OPEN).cast("int")


def _by_line_end(lines: DataFrame) -> DataFrame:
    """Lines that were cut at line feeds, cut at carriage returns too; ``end`` is what followed."""
    feed = F.when(F.endswith("line", F.lit("\r")), F.lit("\r\n")).otherwise(F.lit("\n"))
    body = F.when(F.endswith("line", F.lit("\r")), F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    cut = lines.withColumn("_end", feed).select(*SPLIT, F.col("seq").alias("_seq"), "valid", "_end", F.posexplode(F.split(body, "\r")).alias("_nth", "line"), F.size(F.split(body, "\r")).alias("_n"))
    return cut.select(*SPLIT, F.struct("_seq", "_nth").alias("seq"), "line", "valid", F.when(F.col("_nth") == F.col("_n") - 1, F.col("_end")).otherwise(F.lit("\r")).alias("end"))


def records(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """Records of lines given as ``path, block, seq, line, valid``: ``block`` orders the splits of a
    file, ``seq`` the lines of a split, and ``valid`` says whether the bytes were UTF-8. Returns ``path, row_idx, record, problem`` without blanks;
    an unreadable file has one row with a ``problem``. ``tasks`` sort the lines; compressed lines look small, so left to itself Spark gives
    a task more of them than it can hold."""
    order = Window.partitionBy(*SPLIT).orderBy("seq")
    prior = order.rowsBetween(Window.unboundedPreceding, -1)
    lines = _by_line_end(lines.withColumn("chunk", F.shiftright("seq", CHUNK_BITS)))
    if tasks:
        lines = lines.repartition(tasks, *SPLIT)
    outside, inside = _opens(F.col("line")), _opens(F.concat(F.lit('"'), "line"))
    states = lines.select(*SPLIT, "seq", "line", "end", "valid", outside.alias("f0"), inside.alias("f1"))
    states = states.withColumn("flips", F.sum(F.when((F.col("f0") == 1) & (F.col("f1") == 0), 1).otherwise(0)).over(order))
    reset = F.when(F.col("f0") == F.col("f1"), F.struct("f0", "flips"))
    states = states.withColumns({
        "before": F.coalesce(F.max("flips").over(prior), F.lit(0)),
        "reset": F.last(reset, ignorenulls=True).over(prior),
        "reset_after": F.last(reset, ignorenulls=True).over(order),
    })

    def state(start: int, flips: str, mark: str) -> Column:
        since = F.col(flips) - F.coalesce(F.col(f"{mark}.flips"), F.lit(0))
        return (F.coalesce(F.col(f"{mark}.f0"), F.lit(start)) + since) % 2

    states = states.withColumns({
        f"s{s}": state(s, "before", "reset") for s in (0, 1)
    } | {f"e{s}": state(s, "flips", "reset_after") for s in (0, 1)})
    # A line starts a record when the state before it is "outside"; blank lines start none.
    blank = stripped(F.col("line")) == ""
    starts = {s: ((F.col(f"s{s}") == 0) & ~blank).cast("int") for s in (0, 1)}
    splits = states.groupBy(*SPLIT).agg(
        *[F.max_by(f"e{s}", "seq").alias(f"e{s}") for s in (0, 1)],
        *[F.sum(starts[s]).alias(f"n{s}") for s in (0, 1)], F.bool_or(~F.col("valid")).alias("coded"),
    )
    # One row a chunk: chunks of a file change the state as its lines do, and are looked at in the same way.
    place = Window.partitionBy("path").orderBy("block", "chunk")
    whole, earlier = place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), place.rowsBetween(Window.unboundedPreceding, -1)
    chunks = splits.withColumn("flips", F.sum(F.when((F.col("e0") == 1) & (F.col("e1") == 0), 1).otherwise(0)).over(place))
    set_to = F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("f0"), "flips"))
    chunks = chunks.withColumns({
        "before": F.coalesce(F.max("flips").over(earlier), F.lit(0)), "reset": F.last(set_to, ignorenulls=True).over(earlier),
        "reset_after": F.last(set_to, ignorenulls=True).over(place),
    }).withColumns({"entry": state(0, "before", "reset"), "left": state(0, "flips", "reset_after")})
    own = F.when(F.col("entry") == 0, F.col("n0")).otherwise(F.col("n1"))
    chunks = chunks.select(
        *SPLIT, "entry", (F.sum(own).over(place) - own).alias("offset"), F.row_number().over(place).alias("nth"),
        F.when(F.bool_or("coded").over(whole), NOT_UTF8).when(F.last("left").over(whole) == 1, UNCLOSED).alias("problem"),
    )
    # one join for sound and unreadable files; of the latter the first line stands for the file
    placed = states.join(chunks, SPLIT).withColumn(
        "starts", F.when(F.col("entry") == 0, starts[0]).otherwise(starts[1])
    ).withColumn("inside", F.when(F.col("entry") == 0, F.col("s0")).otherwise(F.col("s1")))
    sound = F.col("problem").isNull()
    numbered = placed.withColumns({
        "row_idx": F.when(sound, F.col("offset") + F.sum("starts").over(order) - 1).otherwise(-1), "line_no": F.row_number().over(order),
    }).filter(F.when(sound, (F.col("starts") == 1) | (F.col("inside") == 1)).otherwise((F.col("nth") == 1) & (F.col("line_no") == 1)))
    pieces = F.sort_array(F.collect_list(F.struct("block", "seq", "line", "end")))
    glued = F.aggregate(
        pieces, F.struct(F.lit("").alias("text"), F.lit("").alias("end")),
        lambda acc, p: F.struct(F.concat(acc["text"], acc["end"], p["line"]).alias("text"), p["end"].alias("end")),
        lambda acc: acc["text"],
    )
    # most records are one line
    record = F.when(F.count("*") == 1, F.first("line")).otherwise(glued)
    found = numbered.groupBy("path", "row_idx").agg(record.alias("record"), F.first("problem").alias("problem"))
    return found.withColumn("record", F.when(F.col("problem").isNull(), F.col("record")).otherwise(F.lit("")))


def read_lines(spark: SparkSession, location: str | list[str]) -> DataFrame:
    """Lines of CSV files, with split start and order in the split. The reader leaves a byte order mark out."""
    reader = spark.read.option("pathGlobFilter", CSV_NAMES).option("recursiveFileLookup", "true").option("lineSep", "\n")
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return reader.text(location).select(
        decoded.alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"), F.is_valid_utf8("value").alias("valid"),
    )


def read_records(spark: SparkSession, location: str | list[str]) -> DataFrame:
    """Records of CSV files, sorted by as many tasks as their splits need."""
    lines = read_lines(spark, location)
    return records(lines, TASKS_A_SPLIT * max(lines.rdd.getNumPartitions(), 1))


def content_lines(files: DataFrame) -> DataFrame:
    """Lines of files given as ``path`` and ``content`` bytes: one split a file."""
    text = F.col("content").cast("string")
    # a byte order mark is no part of the first field
    lines = F.split(F.when(F.startswith(text, F.lit("\ufeff")), F.substring(text, F.lit(2), F.length(text))).otherwise(text), "\n")
    return files.select("path", F.is_valid_utf8(F.col("content").cast("string")).alias("valid"), F.lit(0).cast("bigint").alias("block"), F.posexplode(lines).alias("seq", "line")).withColumn("seq", F.col("seq").cast("bigint"))
