"""From a grid of sheets to typed staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.functions.numbers import scrub_placeholder, to_decimal, to_whole
from peerline.functions.periods import quarter_from_name
from peerline.functions.text import text_array
from peerline.operators.rows import dedup_rows, drop_sparse_rows, not_null, peer_flag, start_at_anchor
from peerline.session import materialise
from peerline.sources.grid import file_name, trimmed
from peerline.specs import PEER_FLAG, QUARTER, Measure, TableSpec

# Rows above the header, and the fewest filled cells of a column or row worth keeping.
ROWS_ABOVE_HEADER = 1
LEAST_CELLS_PER_COLUMN = 20
LEAST_CELLS_PER_ROW = 3


def _profile(grid: DataFrame) -> DataFrame:
    """Per file: its first row, and how many cells of each column are filled over all rows, as a map from the column's place.

    One aggregate keyed by file and place: a wide sheet costs its cells, and a wide line costs itself. A row
    without cells has no place, and counts for the first row all the same.
    """
    places = grid.select("file", "row_no", F.posexplode_outer("cells").alias("place", "cell"))
    counted = places.groupBy("file", "place").agg(F.count("cell").alias("n"), F.min("row_no").alias("first_row"))
    entries = F.collect_list(F.when(F.col("n") > 0, F.struct("place", "n")))
    return counted.groupBy("file").agg(F.min("first_row").alias("first_row"), F.map_from_entries(entries).alias("filled"))


def _layout(grid: DataFrame, spec: TableSpec, width: int | None, above: int, least: int) -> DataFrame:
    """Per file: quarter, the header's row, and where each wanted column sits.

    `last` tells how far columns that count reach, `kept` which ones count where some before that do not. A header
    that is absent, or whose column is nearly empty, is an error that names file and header.
    """
    profile = materialise(_profile(grid), f"{spec.name}-profile")
    header_row = F.col("first_row") + above
    top = grid.join(profile, "file").filter(F.col("row_no") <= header_row)
    # These groups hold the few rows down to the header; `filled` is the same in all of them.
    heads = top.groupBy("file").agg(
        F.max(header_row).alias("header_row"),
        F.max(F.when(F.col("row_no") == header_row, F.col("cells"))).alias("header"),
        F.array_agg("cells").alias("top_cells"),
        F.first("filled").alias("filled"),
    )
    # Rows above the data are not counted.
    counts = F.transform_values("filled", lambda i, n: n - F.size(F.filter("top_cells", lambda row: F.get(row, i).isNotNull())))
    columns = F.coalesce(F.array_max(F.map_keys("filled")) + 1, F.lit(0))
    names = F.transform(
        F.sequence(F.lit(0), F.greatest(columns, F.lit(1)) - 1),
        lambda i: F.coalesce(F.get("header", i), F.concat(F.lit("Unnamed: "), i.cast("string"))),
    )
    heads = heads.withColumns({"counts": counts, "columns": columns, "names": names, "wanted": text_array(spec.headers)})

    def position(header: Column) -> Column:
        return F.array_position("names", header).cast("int") - 1

    absent = F.filter("wanted", lambda h: position(h) < 0)
    sparse = F.filter("wanted", lambda h: F.coalesce(F.try_element_at("counts", position(h)), F.lit(0)) < least)

    def refuse(reason: str, headers: Column) -> Column:
        message = F.concat(F.lit(f"{spec.name}: {reason} "), F.array_join(headers, " | "), F.lit(" in "), F.col("file"))
        return F.raise_error(message).cast("array<int>")

    positions = (
        F.when(F.col("header").isNull(), refuse("no header row", F.array()))
        .when(F.col("columns") > (width or 1 << 30), refuse(f"more than {width} columns", F.array()))
        .when(F.size(absent) > 0, refuse("no header", absent))
        .when(F.size(sparse) > 0, refuse(f"fewer than {least} cells under", sparse))
        .otherwise(F.transform("wanted", position))
    )
    # Cells of a nearly empty column do not count; few sheets have such a column among the others.
    enough = F.map_keys(F.map_filter("counts", lambda _, n: n >= least))
    last = F.coalesce(F.array_max("enough") + 1, F.lit(0))
    stray = F.size(F.map_filter("counts", lambda i, n: (n > 0) & (n < least) & (i < F.col("last")))) > 0
    kept = F.when(stray, F.transform(F.sequence(F.lit(0), F.col("last") - 1), lambda i: F.array_contains("enough", i)))
    heads = heads.withColumn("enough", enough).withColumn("last", last)
    return heads.select(
        "file",
        F.coalesce(
            quarter_from_name(file_name(F.col("file"))),
            F.raise_error(F.concat(F.lit(f"{spec.name}: no quarter in the name of "), F.col("file"))).cast("int"),
        ).alias(QUARTER),
        "header_row",
        positions.alias("positions"),
        kept.alias("kept"),
        "last",
    )


def _require_anchors(anchors: DataFrame, layout: DataFrame, spec: TableSpec) -> None:
    """Stop when a file lacks its anchor row: nothing of it could be trusted."""
    without = layout.select("file").join(anchors.select("file").distinct(), "file", "left_anti")
    named = [r["file"] for r in without.take(5)]  # examples for the message
    if named:
        raise ValueError(f"{spec.name}: no row named {spec.anchor} in {', '.join(named)}")


def _typed(measure: Measure) -> Column:
    text = scrub_placeholder(F.col(measure.column))
    if measure.in_thousands:
        return to_decimal(text, 18, 3)
    return to_whole(text, measure.column)


def clean(
    grid: DataFrame,
    spec: TableSpec,
    width: int | None = None,
    above: int = ROWS_ABOVE_HEADER,
    least_per_column: int = LEAST_CELLS_PER_COLUMN,
    least_per_row: int = LEAST_CELLS_PER_ROW,
) -> DataFrame:
    """Typed staging rows of every sheet in the grid.

    Each file is read by its own header. Duplicates are judged on all columns
    that are filled enough, before the wanted ones are picked; the anchor row
    is found by row order, so a duplicate dropped above it cannot shift it.

    The per-file layout and the deduplicated rows are written as working tables:
    both are used twice, and Catalyst then knows the layout's true size and
    sends it to the tasks only if it is small. The grid is read twice, for the columns filled and for the result, and shuffled
    once, for the duplicates, with copies collapsed beforehand.
    """
    layout = materialise(_layout(grid, spec, width, above, least_per_column), f"{spec.name}-layout")
    body = grid.join(layout.select("file", "header_row", "kept", "last"), "file").filter(F.col("row_no") > F.col("header_row"))

    # The whole row is compared, cut to the columns that count. Wholly empty rows need no filter of
    # their own, they go with the missing ids.
    cut = F.slice("cells", 1, F.col("last"))
    masked = F.transform(cut, lambda c, i: F.when(F.get("kept", i), c))
    # Most rows are as long as their last filled cell and no longer than the columns that count: they stay as they are.
    plain = F.col("kept").isNull() & (F.size("cells") <= F.col("last")) & F.get("cells", F.size("cells") - 1).isNotNull()
    whole = F.when(plain, F.col("cells")).otherwise(trimmed(F.when(F.col("kept").isNull(), cut).otherwise(masked)))
    body = body.select("file", "row_no", whole.alias("cells"))
    rows = dedup_rows(body, ["file", "cells"], "row_no").join(layout.select("file", QUARTER, "positions"), "file")
    names = [*spec.key_columns, *spec.measure_columns]
    rows = rows.selectExpr(
        "file", QUARTER, "row_no", *(f"get(cells, get(positions, {k})) as {c}" for k, c in enumerate(names))
    )
    rows = materialise(rows, f"{spec.name}-rows")

    is_anchor = F.col(spec.entity_column) == spec.anchor
    _require_anchors(rows.filter(is_anchor), layout, spec)
    rows = start_at_anchor(rows, ["file"], "row_no", is_anchor)
    rows = drop_sparse_rows(not_null(rows, spec.id_column), least_per_row, names)
    return rows.select(
        *spec.key_columns,
        *(_typed(m).alias(m.column) for m in spec.measures),
        QUARTER,
        peer_flag(F.col(spec.entity_column), spec.peers).alias(PEER_FLAG),
    )
