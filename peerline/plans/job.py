"""One table from source files to published summary, and all tables together."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerline.functions.text import add_fingerprint
from peerline.operators.delta import unmatched_keys
from peerline.operators.profile import rows_per_quarter
from peerline.plans.clean import clean
from peerline.plans.publish import (
    append_rows,
    create_public_view,
    export_csv,
    export_summary_csv,
    refresh_quarters,
)
from peerline.session import job_tables, materialise
from peerline.sources.grid import list_sources, read_grid, require_source
from peerline.sources.tables import (
    ROW_KEY,
    STAGING,
    bucket_count,
    create_staging,
    held_keys,
    read_summary,
    with_row_key,
)
from peerline.specs import QUARTER, SPECS, TableSpec


@dataclass(frozen=True)
class LoadReport:
    """What one run did to one table."""

    table: str
    cleaned: int
    fresh: int
    redundant: int | None
    per_quarter: dict[int | None, int]


def _checked_keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Refuse rows the staging table's NOT NULL columns could not take."""
    checks = {
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{spec.name}.{c} is missing")).cast("string"))
        for c in spec.key_columns
    }
    return rows.withColumns(checks)


def quarters_of(rows: DataFrame) -> list[int | None]:
    return [r[0] for r in rows.select(QUARTER).distinct().collect()]  # one value per quarter


def compare_with_table(rows: DataFrame, table: str, quarters: Sequence[int | None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their digest, and the digests that `rows` or the table alone holds, in one join; all quarters or some.

    The table is read bucket by bucket, its digests alone.
    """
    spark = rows.sparkSession
    keyed = with_row_key(rows, table)
    found = unmatched_keys(keyed, held_keys(spark, table, quarters), ROW_KEY, bucket_count(spark, table))
    return keyed, materialise(found, "unmatched")


def append_fresh(rows: DataFrame, table: str, quarters: Sequence[int | None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Append the rows a table does not hold yet; returns them, and the digests that the table alone holds.

    A fingerprint contains its quarter, so the table's other quarters need not be read to find what is fresh.
    """
    keyed, found = compare_with_table(rows, table, quarters)
    # Written first: read lazily, the rows would be fresh no more once appended.
    fresh = materialise(keyed.join(found.filter("in_new").select(ROW_KEY), ROW_KEY, "left_semi"), "fresh")
    append_rows(fresh, table)
    return fresh, found.filter("not in_new").select(ROW_KEY)


def load_fresh(cleaned: DataFrame, spec: TableSpec, replace: bool = False, every_quarter: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Append the rows staging does not hold yet; returns them, and the digests of staging rows the sources lack.

    Only the quarters at hand are read from staging, unless `every_quarter` is to be compared. Running the same load
    again adds nothing. With `replace` the quarters at hand are swapped and nothing is compared.
    """
    table = create_staging(cleaned.sparkSession, spec)
    columns = spec.staging_columns
    checked = _checked_keys(cleaned.select(*columns), spec)
    if replace:
        append_rows(checked, table, replace=True)
        return cleaned.select(*columns), None
    fresh, lone = append_fresh(checked, table, None if every_quarter else quarters_of(cleaned))
    return fresh.select(*columns), lone


def find_redundant(cleaned: DataFrame, spec: TableSpec, lone: DataFrame | None = None) -> DataFrame:
    """Staging rows the sources no longer contain, by their digests if known. They are reported, never deleted."""
    spark = cleaned.sparkSession
    table = f"{STAGING}.{spec.name}"
    if lone is None:
        lone = compare_with_table(cleaned, table)[1].filter("not in_new").select(ROW_KEY)
    held = spark.table(table)
    held = held if ROW_KEY in held.columns else with_row_key(held, table)
    return add_fingerprint(held.join(lone, ROW_KEY, "left_semi").select(*spec.staging_columns), spec.staging_columns)


def run_table(
    spark: SparkSession,
    spec: TableSpec,
    source: str,
    target: str,
    model_file: str | None = None,
    replace: bool = False,
    count_redundant: bool = True,
    read: Callable[[SparkSession, str], DataFrame] = read_grid,
) -> LoadReport:
    """Read `<source>/<sheet>`, load what is new, refresh and publish to `target`.

    A run may be repeated into the same target: exports take the place of earlier ones.
    `count_redundant` compares all of staging with the sources and writes the rows the sources no
    longer hold; leave it out where the sources no longer hold every quarter.
    """
    folder = f"{source}/{spec.sheet}"
    if model_file:
        require_source(list_sources(spark, folder), model_file)
    with job_tables(spark, spec.name):
        grid = materialise(read(spark, folder), f"{spec.name}-grid")
        cleaned = materialise(add_fingerprint(clean(grid, spec), spec.staging_columns), f"{spec.name}-cleaned")

        fresh, lone = load_fresh(cleaned, spec, replace, every_quarter=count_redundant)
        # The summary first: it must follow staging even if an export fails.
        refresh_quarters(spark, spec, None if replace else fresh, quarters_of(cleaned))
        create_public_view(spark, spec)
        export_summary_csv(read_summary(spark, spec), f"{target}/{spec.summary_file}.csv")
        export_csv(cleaned if spec.export_all_rows else fresh, f"{target}/{spec.name}_cleaned.csv")
        redundant = None
        if count_redundant:
            found = materialise(find_redundant(cleaned, spec, lone), f"{spec.name}-redundant")
            export_csv(found, f"{target}/{spec.name}_redundant.csv")
            redundant = found.count()

        per_quarter = {r[QUARTER]: r["row_count"] for r in rows_per_quarter(cleaned).collect()}
        return LoadReport(spec.name, sum(per_quarter.values()), fresh.count(), redundant, per_quarter)


def run_all(
    spark: SparkSession,
    source: str,
    target: str,
    specs: Iterable[TableSpec] | None = None,
    at_once: int = 4,
    **options: object,
) -> list[LoadReport]:
    """Run the table jobs side by side: they share nothing, so the cluster stays busy."""
    chosen = list(SPECS.values() if specs is None else specs)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(lambda spec: run_table(spark, spec, source, target, **options), chosen))


def duplicate_keys(cleaned: DataFrame, spec: TableSpec) -> DataFrame:
    """Entities that occur more than once in a quarter, as after an original and a revised file."""
    keys = [spec.entity_column, QUARTER]
    return cleaned.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)

