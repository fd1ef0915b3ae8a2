"""One query per operator, each over whole tables.

Every callable takes (spark, folder of parquet tables) and returns a DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerline.functions.numbers import (
    round_divide,
    scrub_placeholder,
    to_decimal,
    to_double,
    to_whole,
)
from peerline.functions.periods import (
    quarter_from_name,
    quarter_label,
    quarter_month,
    quarter_of_date,
    quarter_year,
)
from peerline.functions.text import FINGERPRINT, add_fingerprint, clean_label, text_array
from peerline.operators import benchmark as B
from peerline.operators import rows as R
from peerline.operators.delta import compare_rows, fresh_rows, redundant_rows
from peerline.operators.profile import filled_cells, fingerprint_counts, rows_per_quarter
from peerline.plans import facts as X
from peerline.plans.clean import clean
from peerline.plans.job import append_fresh, load_fresh, quarters_of
from peerline.plans.publish import (
    append_rows,
    create_public_view,
    export_csv,
    export_summary_csv,
    public_view,
    refresh_quarters,
)
from peerline.plans.summary import peer_summary, peer_summary_stepwise
from peerline.registry.expected import ANCHOR, SHEETS
from peerline.session import materialise, new_folder
from peerline.sources.grid import list_sources, read_grid, require_source
from peerline.sources.tables import CORE, PUBLIC, STAGING, create_keyed_table, create_staging, read_staging, read_summary
from peerline.specs import PEER_FLAG, QUARTER, SPECS

Query = Callable[[SparkSession, str], DataFrame]

FACTS: dict[str, tuple[str, Query]] = {
    "peer_benchmark_assessment": ("tab_a1", X.assessment_facts),
    "peer_benchmark_prevention": ("tab_a2p", X.prevention_facts),
    "peer_benchmark_relief": ("tab_a2r", X.relief_facts),
    "peer_benchmark_ended_prevention": ("tab_p1", X.ended_prevention_facts),
    "peer_benchmark_ended_relief": ("tab_r1", X.ended_relief_facts),
    "peer_benchmark_accommodation": ("tab_ta1", X.accommodation_facts),
    "peer_benchmark_composition": ("tab_ta2", X.composition_facts),
}


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _benchmark(table: str, facts: Query) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        summary = peer_summary(facts(spark, folder, X.COMPARED), X.nation_spec(table))
        return _as_double(summary, "focal", "peer_group", "difference")

    return query


# --- steps of the comparison ------------------------------------------------


def _assessment_units(spark: SparkSession, folder: str) -> DataFrame:
    return B.to_units(X.assessment_facts(spark, folder, X.COMPARED), X.nation_spec("tab_a1"))


def peer_quarterly_avg(spark: SparkSession, folder: str) -> DataFrame:
    return B.peer_means(_assessment_units(spark, folder), X.nation_spec("tab_a1"))


def group_labels(spark: SparkSession, folder: str) -> DataFrame:
    spec = X.nation_spec("tab_a1")
    return B.label_group(peer_quarterly_avg(spark, folder), spec)


def focal_union_peer(spark: SparkSession, folder: str) -> DataFrame:
    return B.focal_with_peers(_assessment_units(spark, folder), X.nation_spec("tab_a1"))


def compared_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Peer rows and focal rows, each by its own predicate."""
    spec = X.nation_spec("tab_a1")
    units = _assessment_units(spark, folder)
    sides = [
        R.add_constant(B.peer_rows(units), "side", "peer"),
        R.add_constant(B.focal_rows(units, spec), "side", "focal"),
    ]
    return R.append_by_name(sides).drop(PEER_FLAG)


def ratio_columns(spark: SparkSession, folder: str) -> DataFrame:
    spec = X.nation_spec("tab_a1")
    rows = B.add_ratios(focal_union_peer(spark, folder), spec)
    return _as_double(rows, *spec.metric_names)


def scaled_population(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per nation in thousands, and back in units."""
    measure = SPECS["tab_a1"].measures[-1]
    wide = X.assessment_facts(spark, folder)
    return wide.select(
        "local_authority", QUARTER, F.expr(B.in_units(measure)).alias("households_in_area"),
        F.col(measure.column).cast("double").alias(measure.column),
    )


def _long(spark: SparkSession, folder: str) -> DataFrame:
    spec = X.nation_spec("tab_a1")
    rows = B.add_period(B.add_ratios(focal_union_peer(spark, folder), spec))
    return B.unpivot_metrics(rows, spec)


def unpivot_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _as_double(_long(spark, folder), "households")


def pivot_entities(spark: SparkSession, folder: str) -> DataFrame:
    spec = X.nation_spec("tab_a1")
    return _as_double(B.pivot_entities(_long(spark, folder), spec), "focal", "peer_group")


def difference(spark: SparkSession, folder: str) -> DataFrame:
    spec = X.nation_spec("tab_a1")
    pivoted = B.pivot_entities(_long(spark, folder), spec)
    return B.add_difference(pivoted, spec).select(QUARTER, "metrics", F.col("difference").cast("double"))


def stepwise_summary(spark: SparkSession, folder: str) -> DataFrame:
    spec = X.nation_spec("tab_a1")
    summary = peer_summary_stepwise(X.assessment_facts(spark, folder, X.COMPARED), spec)
    return _as_double(summary, "focal", "peer_group", "difference")


def public_summary_view(spark: SparkSession, folder: str) -> DataFrame:
    spec = X.nation_spec("tab_a1")
    summary = peer_summary(X.assessment_facts(spark, folder, X.COMPARED), spec)
    return _as_double(public_view(summary, spec, "initial_asmt_summary"), "focal", "peer_group", "difference")


def cleaned_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Metric names with and without their prefix, from the prevention summary."""
    summary = peer_summary(X.prevention_facts(spark, folder, X.COMPARED), X.nation_spec("tab_a2p"))
    return summary.select(QUARTER, "metrics", clean_label(F.col("metrics")).alias("label"))


# --- columns ----------------------------------------------------------------


def _order_quarters(spark: SparkSession, folder: str) -> DataFrame:
    orders = X.read_table(spark, folder, "orders")
    return orders.withColumn(QUARTER, quarter_of_date(F.col("o_orderdate")))


def quarter_parts(spark: SparkSession, folder: str) -> DataFrame:
    quarter = F.col(QUARTER)
    return _order_quarters(spark, folder).select(
        "o_orderkey", QUARTER, quarter_year(quarter).alias("qtr_year"), quarter_month(quarter).alias("qtr_month")
    )


def quarter_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Label of the order's month: q0 where the month ends no quarter."""
    orders = X.read_table(spark, folder, "orders")
    month = F.month("o_orderdate")
    return orders.select("o_orderkey", month.alias("month"), quarter_label(month).alias("year_qtr"))


def quarter_from_names(spark: SparkSession, folder: str) -> DataFrame:
    """Quarter read back from file names made of the order date, 25 years on."""
    quarter = (F.col(QUARTER) + 2500).cast("string")
    names = _order_quarters(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Detailed_LA_"), quarter, F.lit(".csv")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("Detailed_LA_"), quarter, F.lit("_revised.csv")))
        .otherwise(F.concat(F.lit("Detailed_LA_"), F.col(QUARTER).cast("string"), F.lit(".csv")))
        .alias("name"),
    )
    return names.withColumn(QUARTER, quarter_from_name(F.col("name")))


def peer_flags(spark: SparkSession, folder: str) -> DataFrame:
    nations = X.read_table(spark, folder, "nation")
    named = X.read_table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("c_custkey", "n_name", R.peer_flag(F.col("n_name"), X.PEER_NATIONS).alias(PEER_FLAG))


def value_map(spark: SparkSession, folder: str) -> DataFrame:
    codes = {"AUTOMOBILE": "A", "BUILDING": "B", "FURNITURE": "F", "HOUSEHOLD": "H", "MACHINERY": "M"}
    customers = X.read_table(spark, folder, "customer")
    return customers.select("c_custkey", R.map_values(F.col("c_mktsegment"), codes).alias("segment_code"))


def constant_column(spark: SparkSession, folder: str) -> DataFrame:
    orders = X.read_table(spark, folder, "orders").select("o_orderkey")
    return R.add_constant(R.add_constant(orders), "source", "orders")


def rename_and_keep(spark: SparkSession, folder: str) -> DataFrame:
    """Rename by map (an unknown name is passed over), then a fixed column order."""
    orders = X.read_table(spark, folder, "orders")
    names = {"o_orderkey": "system_id", "o_orderstatus": "status", "no_such_column": "unused"}
    return R.keep_columns(R.rename_columns(orders, names), ["status", "system_id", "o_custkey"])


def _part_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Part sizes as sheet texts: plain, padded, placeholder, thousands, exponent, dash, inner marker."""
    parts = X.read_table(spark, folder, "part")
    size = F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 8
    text = (
        F.when(kind == 0, F.lit(".."))
        .when(kind == 1, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(kind == 2, F.concat(F.lit("1,"), F.lpad(size, 3, "0")))
        .when(kind == 3, F.concat(size, F.lit("e2")))
        .when(kind == 4, F.lit("-"))
        .when(kind == 5, F.concat(size, F.lit(".."), size))
        .when(kind == 6, F.concat(size, F.lit(".0")))
        .otherwise(F.concat(F.lit("-"), size))
    )
    return parts.select("p_partkey", text.alias("cell"))


def scrubbed(spark: SparkSession, folder: str) -> DataFrame:
    return _part_texts(spark, folder).select("p_partkey", scrub_placeholder(F.col("cell")).alias("cell"))


def coerced_numbers(spark: SparkSession, folder: str) -> DataFrame:
    cell = F.col("cell")
    return scrubbed(spark, folder).select(
        "p_partkey", to_double(cell).alias("as_double"), to_decimal(cell, 18, 3).cast("double").alias("as_decimal")
    )


def coerced_integers(spark: SparkSession, folder: str) -> DataFrame:
    return scrubbed(spark, folder).select("p_partkey", to_whole(F.col("cell"), "cell").alias("whole"))


def cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Dates, floats, whole numbers and texts cast by column list."""
    orders = X.read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.col("o_custkey").cast("string").alias("customer_number"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("customer_key"),
        F.col("o_custkey").alias("customer_text"),
    )
    cast = R.recast_columns(orders, ["order_day"], ["customer_number"], ["customer_key"], ["customer_text"])
    return cast.withColumn("order_day", F.to_date("order_day"))


def half_away_rounding(spark: SparkSession, folder: str) -> DataFrame:
    """Signed halves and quarters rounded to 0 and 2 digits."""
    lines = X.read_table(spark, folder, "lineitem")
    quantity = "cast(if(l_linestatus = 'F', l_quantity, -l_quantity) as bigint)"
    by_line = round_divide(quantity, "cast(l_linenumber - 1 as bigint)", 2)
    return lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_linestatus", "l_quantity",
        round_divide(quantity, "2L").alias("half"),
        (round_divide(quantity, "8L", 2) / 100.0).alias("eighth"),
        (by_line / 100.0).alias("by_line"),
    )


# --- rows -------------------------------------------------------------------


def _gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with missing cells wherever the status or priority says so."""
    orders = X.read_table(spark, folder, "orders")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("system_id"),
        F.when(~urgent, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") > 250_000, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") < 10, F.lit("first")).alias("remark"),
    )


def drop_sparse_rows(spark: SparkSession, folder: str) -> DataFrame:
    return R.drop_sparse_rows(_gappy_orders(spark, folder), 3)


def drop_sparse_columns(spark: SparkSession, folder: str) -> DataFrame:
    return R.drop_sparse_columns(_gappy_orders(spark, folder), 20, ["o_orderkey", "system_id"])


def not_null_id(spark: SparkSession, folder: str) -> DataFrame:
    return R.not_null(_gappy_orders(spark, folder), "system_id").select("o_orderkey", "system_id")


def start_at_anchor(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of each status from its first urgent order above 400000 on."""
    orders = X.read_table(spark, folder, "orders").select("o_orderstatus", "o_orderkey", "o_orderpriority", "o_totalprice")
    is_anchor = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400_000)
    return R.start_at_anchor(orders, ["o_orderstatus"], "o_orderkey", is_anchor).select("o_orderstatus", "o_orderkey")


def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct line contents, each at its lowest row number."""
    lines = X.read_table(spark, folder, "lineitem")
    cells = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_linenumber"]
    return R.dedup_rows(lines.select(*cells, F.col("l_orderkey").alias("row_no")), cells, "row_no")


def dedup_wide_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that seldom repeat, the first of each."""
    lines = X.read_table(spark, folder, "lineitem")
    cells = ["l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate", "l_extendedprice"]
    return R.dedup_wide_rows(lines.select(*cells, F.col("l_orderkey").alias("row_no")), cells, "row_no")


def append_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Orders cut by status into frames of different columns, put together by name."""
    orders = X.read_table(spark, folder, "orders")
    frames = [
        orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus", "o_custkey"),
        orders.filter(F.col("o_orderstatus") == "O").select("o_orderstatus", "o_orderkey"),
        orders.filter(F.col("o_orderstatus") == "P").select("o_custkey", "o_orderkey", "o_orderpriority"),
    ]
    return R.append_by_name(frames)


# --- load -------------------------------------------------------------------


def _order_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _order_quarters(spark, folder).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("priority"), QUARTER
    )


def _held_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What an earlier load left: no pending orders, low priorities under an older name."""
    rows = _order_rows(spark, folder).filter(F.col("o_orderstatus") != "P")
    older = F.when(F.col("priority") == "5-LOW", F.lit("LOW")).otherwise(F.col("priority"))
    return rows.withColumn("priority", older)


def delta_load(spark: SparkSession, folder: str) -> DataFrame:
    new, old = add_fingerprint(_order_rows(spark, folder)), add_fingerprint(_held_orders(spark, folder))
    return fresh_rows(new, old).drop(FINGERPRINT)


def delta_redundant(spark: SparkSession, folder: str) -> DataFrame:
    new, old = add_fingerprint(_order_rows(spark, folder)), add_fingerprint(_held_orders(spark, folder))
    return redundant_rows(new, old).drop(FINGERPRINT)


def delta_both(spark: SparkSession, folder: str) -> DataFrame:
    """Fresh and redundant rows from one comparison."""
    new, old = add_fingerprint(_order_rows(spark, folder)), add_fingerprint(_held_orders(spark, folder))
    fresh, redundant = compare_rows(new, old)
    return R.append_by_name([R.add_constant(fresh, "side", "fresh"), R.add_constant(redundant, "side", "redundant")]).drop(FINGERPRINT)


def delta_keeps_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Line contents with many copies against the contents of returned lines: copies stay."""
    lines = X.read_table(spark, folder, "lineitem")
    cells = ["l_linestatus", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity")]
    new = add_fingerprint(lines.select(*cells))
    old = add_fingerprint(lines.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") < 25)).select(*cells))
    return fresh_rows(new, old).drop(FINGERPRINT)


def fingerprint_rows(spark: SparkSession, folder: str) -> DataFrame:
    customers = X.read_table(spark, folder, "customer")
    rich = F.when(F.col("c_acctbal") > 5_000, F.col("c_nationkey")).alias("rich_nation")
    return add_fingerprint(customers.select("c_custkey", "c_name", rich, "c_mktsegment"))


def fingerprint_totals(spark: SparkSession, folder: str) -> DataFrame:
    orders = X.read_table(spark, folder, "orders")
    return fingerprint_counts(add_fingerprint(orders.select("o_custkey", "o_orderstatus")))


def quarter_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rows_per_quarter(_order_quarters(spark, folder))


def non_null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return filled_cells(_gappy_orders(spark, folder))


# --- sheets -----------------------------------------------------------------

_SHEET_ROWS_ABOVE = 4  # title, header, sub-header, national total


def _sheet_grid(spark: SparkSession, folder: str) -> DataFrame:
    """One A1 sheet per quarter as a grid: a row per customer who ordered, each row there twice."""
    per_customer = _order_quarters(spark, folder).groupBy("o_custkey", QUARTER).agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("o"),
    )

    def text(count: Column) -> Column:
        return F.when(count > 0, count.cast("string")).otherwise(F.lit(".."))

    key = F.col("o_custkey")
    thousands = F.concat(F.expr("cast(o_custkey div 1000 as string)"), F.lit("."), F.lpad((key % 1000).cast("string"), 3, "0"))
    cells = {
        0: F.concat(F.lit("E"), key.cast("string")),
        1: F.concat(F.lit("Customer "), key.cast("string")),
        4: text(F.col("all")),
        5: text(F.col("f") + F.col("o")),
        6: text(F.col("f")),
        7: text(F.col("o")),
        15: thousands,
    }
    missing = F.lit(None).cast("string")
    row = F.array(*(cells.get(i, missing) for i in range(16)))
    name = F.concat(F.lit("Detailed_LA_"), (F.col(QUARTER) + 2500).cast("string"), F.lit(".csv"))
    twice = F.explode(F.array(F.lit(0), F.lit(1)))
    body = per_customer.select(name.alias("file"), key, row.alias("cells"), twice.alias("copy")).select(
        "file", (key * 2 + F.col("copy") + _SHEET_ROWS_ABOVE).cast("bigint").alias("row_no"), "cells"
    )

    named = [h for h in SHEETS["tab_a1"] if not h.startswith("Unnamed: ")]
    headers = [None] * 4 + named + [None] * (12 - len(named))
    top = [
        ["Table A1"] + [None] * 15,
        headers,
        [None] * 4 + ["count"] * 12,
        ["E92000001", ANCHOR, None, None, "100", "90", "50", "40"] + [None] * 7 + ["25.500"],
    ]
    lines = F.array(*(F.struct(F.lit(i).cast("bigint").alias("row_no"), text_array(r).alias("cells")) for i, r in enumerate(top)))
    head = per_customer.select(name.alias("file")).distinct().select("file", F.inline(lines))
    return body.unionByName(head)


def clean_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaner over sheets made of the orders."""
    grid = materialise(_sheet_grid(spark, folder), "sheets")
    cleaned = clean(grid, SPECS["tab_a1"])
    return _as_double(cleaned, "households_in_area_000s")


def _header_places(headers: list[str]) -> list[int]:
    """Column of each wanted header in a sheet: unnamed ones where their number says, the others in the gaps from the right."""
    fixed = {int(h.removeprefix("Unnamed: ")) for h in headers if h.startswith("Unnamed: ")}
    named = [h for h in headers if not h.startswith("Unnamed: ")]
    gaps = [i for i in range(2, 2 + len(named) + len(fixed)) if i not in fixed][: len(named)]
    place = dict(zip(named, reversed(gaps)))
    return [place[h] if h in place else int(h.removeprefix("Unnamed: ")) for h in headers]


def _counts_grid(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One sheet per quarter: a row per customer who ordered, there twice; measure k counts the orders whose key leaves k."""
    headers = ["Unnamed: 0", "Unnamed: 1", *SHEETS[table]]
    n, places = len(SHEETS[table]), _header_places(headers)
    width = max(places) + 1
    whole = [F.count_if(F.col("o_orderkey") % n == k).alias(f"n{k}") for k in range(n)]
    rows = _order_quarters(spark, folder).groupBy("o_custkey", QUARTER).agg(*whole)
    file = F.concat(F.lit("Detailed_LA_"), (F.col(QUARTER) + 2500).cast("string"), F.lit(".csv")).alias("file")

    def line(values: list[Column]) -> Column:
        cells = dict(zip(places, values))
        return F.array(*(cells.get(i, F.lit(None).cast("string")) for i in range(width)))

    key = F.col("o_custkey")
    ids = [F.concat(F.lit("E"), key.cast("string")), F.concat(F.lit("Customer "), key.cast("string"))]
    counts = [F.when(F.col(f"n{k}") > 0, F.col(f"n{k}").cast("string")).otherwise(F.lit("..")) for k in range(n)]
    body = rows.select(file, key, line(ids + counts).alias("cells"), F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    body = body.select("file", (key * 2 + F.col("copy") + _SHEET_ROWS_ABOVE).cast("bigint").alias("row_no"), "cells")
    names = [F.lit(h) if not h.startswith("Unnamed: ") else F.lit(None).cast("string") for h in headers]
    totals = [F.lit("E92000001"), F.lit(ANCHOR), *(F.lit(str(1000 + k)) for k in range(n))]
    top = [line([F.lit("Table"), *[F.lit(None).cast("string")] * (n + 1)]), line(names), line([F.lit(None).cast("string")] * (n + 2)), line(totals)]
    lines = F.array(*(F.struct(F.lit(i).cast("bigint").alias("row_no"), cells.alias("cells")) for i, cells in enumerate(top)))
    head = rows.select(file).distinct().select("file", F.inline(lines))
    return body.unionByName(head)


def _clean_counts(table: str) -> Query:
    """The cleaner by the headers of one table."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return clean(materialise(_counts_grid(spark, folder, table), "sheets"), SPECS[table])

    return query


# --- round trips through files ----------------------------------------------


def csv_export(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written as CSV with a header and read back by it."""
    rows = _order_rows(spark, folder)
    path = export_csv(rows, new_folder(spark, "cleaned-csv"))
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def grid_scan(spark: SparkSession, folder: str) -> DataFrame:
    """CSV exports with line breaks, quotes and commas in cells read as a grid, each file's header left out by its row order."""
    note = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit('first "line",\n\nlast of '), "priority")).otherwise(F.col("priority"))
    path = export_csv(_order_rows(spark, folder).withColumn("priority", note), new_folder(spark, "grid-csv"))
    grid = read_grid(spark, path)
    cell = [F.get("cells", F.lit(i)) for i in range(5)]
    kept = R.start_at_anchor(grid, ["file"], "row_no", cell[0] != "o_orderkey")
    return kept.select(
        cell[0].cast("bigint").alias("o_orderkey"), cell[1].cast("bigint").alias("o_custkey"),
        cell[2].alias("o_orderstatus"), cell[3].alias("priority"), cell[4].cast("int").alias(QUARTER),
    )


def source_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Quarters for which a folder of exports holds a CSV file."""
    path = new_folder(spark, "listing")
    _order_rows(spark, folder).hint("rebalance", QUARTER).write.partitionBy(QUARTER).option("header", True).csv(path)
    files = list_sources(spark, f"{path}/{QUARTER}=*", ["csv"])
    return files.select(_quarter_in_path().cast("int").alias(QUARTER)).distinct()


def _quarter_in_path() -> Column:
    return F.regexp_extract("path", rf"{QUARTER}=(\d+)", 1)


def other_files(spark: SparkSession, folder: str) -> DataFrame:
    """Quarters of the exports beside the model file, which must be among them."""
    path = new_folder(spark, "listing")
    _order_rows(spark, folder).hint("rebalance", QUARTER).write.partitionBy(QUARTER).option("header", True).csv(path)
    sources = list_sources(spark, f"{path}/{QUARTER}=*", ["csv"]).select(_quarter_in_path().alias("name")).distinct()
    require_source(sources, "199803")
    return sources.filter("name <> '199803'").select(F.col("name").cast("int").alias(QUARTER))


@contextmanager
def _own_tables(spark: SparkSession, *databases: str) -> Iterator[str]:
    """A table name of its own, in whose tables a query may write; they are dropped at the end."""
    own = f"run_{uuid.uuid4().hex}"
    try:
        yield own
    finally:
        for table in [f"{d}.{t.name}" for d in databases if spark.catalog.databaseExists(d) for t in spark.catalog.listTables(d) if t.name.startswith(own)]:
            kind = "VIEW" if table.startswith(PUBLIC) else "TABLE"
            spark.sql(f"DROP {kind} IF EXISTS {table}")


def staging_append(spark: SparkSession, folder: str) -> DataFrame:
    """Held rows appended to a staging table, then the fresh ones among all rows, the table read back."""
    held = _held_orders(spark, folder)
    with _own_tables(spark, STAGING) as own:
        table = create_keyed_table(spark, f"{STAGING}.{own}", held.schema)
        append_rows(held, table)
        append_fresh(_order_rows(spark, folder), table)
        return materialise(spark.table(table).select(*held.columns), "appended")


def staging_quarters(spark: SparkSession, folder: str) -> DataFrame:
    """Two quarters of a staging table read back in its declared columns."""
    with _own_tables(spark, STAGING) as own:
        spec = replace(X.nation_spec("tab_ta2"), name=own)
        append_rows(X.composition_facts(spark, folder), create_staging(spark, spec))
        return materialise(read_staging(spark, spec, [199603, 199712]), "quarters")


def summary_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The shipped tables: staging created and loaded twice, the summary brought up to date each time and read through its view."""
    with _own_tables(spark, STAGING, CORE, PUBLIC) as own:
        spec = replace(X.nation_spec("tab_ta2"), name=own, summary=own)
        wide = materialise(X.composition_facts(spark, folder), "facts")
        for rows in (wide.filter(F.col(QUARTER) < 199900), wide.filter(F.col(QUARTER) >= 199600)):
            fresh, _ = load_fresh(rows, spec)
            refresh_quarters(spark, spec, fresh, quarters_of(rows))
        create_public_view(spark, spec)
        return _as_double(materialise(read_summary(spark, spec), "summary"), "focal", "peer_group", "difference")


def summary_csv_order(spark: SparkSession, folder: str) -> DataFrame:
    """Quarter and metric of every line of the published summary CSV, by its place in the file."""
    summary = peer_summary(X.assessment_facts(spark, folder, X.COMPARED), X.nation_spec("tab_a1"))
    path = export_summary_csv(summary, new_folder(spark, "summary-csv"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("row_no")).cast("long") - 1
    lines = read_grid(spark, path).select(place.alias("line"), F.get("cells", F.lit(0)).alias(QUARTER), F.get("cells", F.lit(4)).alias("metrics"))
    return lines.filter("line > 0").withColumn(QUARTER, F.col(QUARTER).cast("int"))


def summary_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The published summary CSV read back."""
    spec = X.nation_spec("tab_a1")
    summary = peer_summary(X.assessment_facts(spark, folder, X.COMPARED), spec)
    path = export_summary_csv(summary, new_folder(spark, "summary-csv"))
    back = spark.read.schema(summary.schema).option("header", True).csv(path)
    return _as_double(back, "focal", "peer_group", "difference")


QUERIES: dict[str, Query] = {
    **{name: _benchmark(table, facts) for name, (table, facts) in FACTS.items()},
    "peer_quarterly_avg": peer_quarterly_avg,
    "group_labels": group_labels,
    "focal_union_peer": focal_union_peer,
    "compared_rows": compared_rows,
    "ratio_columns": ratio_columns,
    "scaled_population": scaled_population,
    "unpivot_metrics": unpivot_metrics,
    "pivot_entities": pivot_entities,
    "difference": difference,
    "stepwise_summary": stepwise_summary,
    "public_view": public_summary_view,
    "clean_label": cleaned_labels,
    "quarter_parts": quarter_parts,
    "quarter_label": quarter_labels,
    "quarter_from_name": quarter_from_names,
    "peer_flag": peer_flags,
    "value_map": value_map,
    "constant_column": constant_column,
    "rename_and_keep": rename_and_keep,
    "scrub_placeholder": scrubbed,
    "coerce_numeric": coerced_numbers,
    "coerce_integer": coerced_integers,
    "cast_columns": cast_columns,
    "half_away_rounding": half_away_rounding,
    "drop_sparse_rows": drop_sparse_rows,
    "drop_sparse_columns": drop_sparse_columns,
    "not_null_id": not_null_id,
    "start_at_anchor": start_at_anchor,
    "dedup_rows": dedup_rows,
    "dedup_wide_rows": dedup_wide_rows,
    "append_by_name": append_by_name,
    "delta_load": delta_load,
    "delta_redundant": delta_redundant,
    "delta_both": delta_both,
    "delta_keeps_copies": delta_keeps_copies,
    "fingerprint_rows": fingerprint_rows,
    "fingerprint_counts": fingerprint_totals,
    "rows_per_quarter": quarter_counts,
    "non_null_profile": non_null_profile,
    "clean_sheets": clean_sheets,
    **{name.replace("peer_benchmark", "clean"): _clean_counts(table) for name, (table, _) in FACTS.items() if table != "tab_a1"},
    "csv_export": csv_export,
    "grid_scan": grid_scan,
    "source_listing": source_listing,
    "other_files": other_files,
    "staging_append": staging_append,
    "staging_quarters": staging_quarters,
    "summary_refresh": summary_refresh,
    "summary_csv": summary_csv,
    "summary_csv_order": summary_csv_order,
}
