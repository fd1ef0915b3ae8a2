"""Sheets as a grid relation: (file, row_no, cells).

`row_no` orders the rows of one file; it need not be dense. `cells` holds the
text of every cell up to the last filled one, NULL where the cell is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerline.session import materialise

CSV_FILES = "*.csv*"

# Cell texts that stand for an empty cell in a sheet reader.
EMPTY_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_ROW_BITS = 33  # bits monotonically_increasing_id leaves for the row within a task


def list_sources(
    spark: SparkSession, folder: str, extensions: str | Sequence[str] | None = None
) -> DataFrame:
    """(name, path) of the files in a folder whose name contains `.` and one of the extensions.

    Only the listing is read: the content column is pruned.
    """
    reader = spark.read.format("binaryFile")
    if extensions:
        wanted = [extensions] if isinstance(extensions, str) else list(extensions)
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(f"{e}*" for e in wanted) + "}")
    return reader.load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path")


def require_source(sources: DataFrame, name: str) -> None:
    """Stop early when the model file is not among the sources."""
    if sources.filter(F.col("name") == name).isEmpty():
        raise FileNotFoundError(f"model file not found: {name}")


def _row_order(block_start: Column) -> Column:
    """Order of a line within its file, without a shuffle or a sort.

    The split's whole place in the file leads; within a split the running row id of
    the task rises with the lines.
    """
    place = block_start.cast("decimal(38,0)") * F.lit(1 << _ROW_BITS).cast("decimal(38,0)")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (place + row).cast("decimal(38,0)")


def _blank_to_null(cells: Column) -> Column:
    return F.transform(cells, lambda c: F.when(~c.isin(*EMPTY_CELLS), c))


def text_lines(source: DataFrame) -> DataFrame:
    """(file, block_start, value) of a text source, batch or stream."""
    return source.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value"
    )


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _splits(numbered: DataFrame) -> DataFrame:
    """(file, block_start, odd, open): quotes of each split modulo 2, and whether it begins inside a quoted cell.

    Each task counts its own lines; only one row a split is summed along the file. A file whose quotes never
    close is an error that names it, before any of its lines is moved.
    """
    counted = numbered.groupBy("file", "block_start").agg(F.sum(_count(F.col("value"), '"') % 2).alias("odd"))
    along = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    never_closed = F.raise_error(F.concat(F.lit("a quoted cell is never closed in "), F.col("file")))
    closed = F.sum("odd").over(Window.partitionBy("file")) % 2 == 0
    before = F.coalesce(F.sum("odd").over(along), F.lit(0)) % 2
    return counted.select("file", "block_start", "odd", F.when(closed, before == 1).otherwise(never_closed.cast("boolean")).alias("open"))


def records(lines: DataFrame) -> DataFrame:
    """(file, row_no, value): lines, those that a quoted cell spreads over several put together again.

    Quotes are counted split by split and summed along the splits, which tells of every split whether it begins inside a
    quoted cell. Lines of splits that neither hold nor begin in an open cell stay where they are. In the others records are
    cut within the split, a file in as many tasks as it has splits; the pieces at the edges, at most two a
    split, then meet the piece they go on from. Runs one action: the splits are counted before the lines are read.
    """
    numbered = lines.withColumn("row_no", _row_order(F.col("block_start")))
    splits = materialise(_splits(numbered), "splits")
    touched = splits.filter((F.col("odd") > 0) | F.col("open"))
    if touched.isEmpty():
        return numbered.select("file", "row_no", "value")
    place = ["file", "block_start"]
    plain = numbered.join(touched, place, "left_anti").select("file", "row_no", "value")

    odd = _count(F.col("value"), '"') % 2
    in_split = Window.partitionBy(*place).orderBy("row_no")
    before = F.coalesce(F.sum("odd_line").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = numbered.join(touched.select(*place, "open"), place).withColumn("odd_line", odd)
    cut = cut.withColumn("starts", ((before + F.col("open").cast("int")) % 2 == 0).cast("long"))
    # Record 0 of a split goes on from an earlier one.
    cut = cut.withColumn("record", F.sum("starts").over(in_split))
    pieces = cut.groupBy(*place, "record").agg(
        F.min("row_no").alias("row_no"),
        F.sort_array(F.collect_list(F.struct("row_no", "value"))).alias("lines"),
        (F.sum("odd_line") % 2 == 1).alias("unclosed"),
    )
    pieces = materialise(
        pieces.withColumn("value", F.array_join(F.transform("lines", lambda line: line["value"]), "\n")).drop("lines"), "pieces"
    )
    edge = (F.col("record") == 0) | F.col("unclosed")
    # A piece at an edge belongs to the last split before it in which a record starts.
    starts = splits.join(pieces.groupBy(*place).agg(F.max("record").alias("cut_starts")), place, "left").withColumn(
        "origin", F.when(F.coalesce("cut_starts", F.lit(1)) > 0, F.col("block_start"))
    )
    along = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    origins = starts.select(*place, F.last("origin", ignorenulls=True).over(along).alias("origin"))
    edges = pieces.filter(edge).join(origins, place).select(
        "file", F.when(F.col("record") == 0, F.col("origin")).otherwise(F.col("block_start")).alias("origin"), "row_no", "value"
    )
    whole = edges.groupBy("file", "origin").agg(F.min("row_no").alias("row_no"), F.sort_array(F.collect_list(F.struct("row_no", "value"))).alias("parts"))
    joined = whole.select("file", "row_no", F.array_join(F.transform("parts", lambda part: part["value"]), "\n").alias("value"))
    return plain.unionByName(pieces.filter(~edge).select("file", "row_no", "value")).unionByName(joined)


# Stand-ins for a separator outside quotes, and what they are written as where a cell holds them itself.
_CUT, _ESCAPE = "\x01", "\x02"


def _swap(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def cells_of(line: Column) -> Column:
    """The cells of a CSV record as an array of its own length; a doubled quote within quotes is one quote.

    Parts between quotes alternate between outside and inside, so only commas of every other part cut. The work
    grows with the record's length, whatever other records hold.
    """
    guards = [(_ESCAPE, f"{_ESCAPE}b"), (_CUT, f"{_ESCAPE}a")]
    guarded = F.when(line.contains(_CUT) | line.contains(_ESCAPE), _swap(line, guards)).otherwise(line)
    parts = F.transform(
        F.split(guarded, '"'), lambda part, k: F.when(k % 2 == 0, F.replace(part, F.lit(","), F.lit(_CUT))).otherwise(part)
    )

    def unquoted(cell: Column) -> Column:
        inner = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        bare = F.when(cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1), inner).otherwise(cell)
        return F.when(bare.contains(_ESCAPE), _swap(bare, [(new, old) for old, new in reversed(guards)])).otherwise(bare)

    quoted = F.transform(F.split(F.array_join(parts, '"'), _CUT), unquoted)
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def trimmed(cells: Column) -> Column:
    """Cells up to the last filled one."""
    last = F.array_max(F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(0)))
    return F.slice(cells, 1, F.coalesce(last, F.lit(0)))


def parse_lines(lines: DataFrame, width: int | None = None) -> DataFrame:
    """Grid rows of CSV lines, each as long as its last filled cell.

    With a `width`, rows are filled up to it, and a line with more cells is an error rather than cut short.
    """
    cells = _blank_to_null(cells_of(F.col("value")))
    if width is None:
        return records(lines).select("file", "row_no", trimmed(cells).alias("cells"))
    too_wide = F.raise_error(F.concat(F.lit(f"more than {width} cells in a line of "), F.col("file")))
    filled = F.concat("cells", F.array_repeat(F.lit(None).cast("string"), F.lit(width) - F.size("cells")))
    whole = records(lines).select("file", "row_no", cells.alias("cells"))
    return whole.withColumn("cells", F.when(F.size("cells") <= width, filled).otherwise(too_wide.cast("array<string>")))


def read_grid(spark: SparkSession, path: str | Sequence[str], width: int | None = None) -> DataFrame:
    """Exported sheets (CSV) of any number, size and width.

    Lines are read split by split, so a huge file is spread over many tasks. They are read twice: once to count quotes,
    when this is called, and once for the rows.
    """
    return parse_lines(text_lines(spark.read.option("pathGlobFilter", CSV_FILES).text(path)), width)


def file_name(file: Column) -> Column:
    """Last part of a path."""
    return F.regexp_extract(file, r"([^/]*)$", 1)
