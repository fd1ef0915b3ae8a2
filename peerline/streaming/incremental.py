"""Load newly arrived sheets only: the delta load driven by a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peerline.functions.text import add_fingerprint
from peerline.plans.clean import clean
from peerline.plans.job import load_fresh, quarters_of
from peerline.plans.publish import create_public_view, refresh_quarters
from peerline.session import job_tables, materialise
from peerline.sources.grid import CSV_FILES, parse_lines, text_lines
from peerline.specs import TableSpec


def load_arrivals(
    spark: SparkSession,
    spec: TableSpec,
    source: str,
    progress: str,
    files_at_once: int = 1000,
    width: int | None = None,
) -> None:
    """Clean and load every file of `<source>/<sheet>` not seen before, refreshing the summary's quarters as they come.

    `progress` keeps the list of files done. A batch cut off half-way is run
    again, and its rows that were already appended are not fresh any more: each
    row arrives once.
    """

    def load(lines: DataFrame, _batch: int) -> None:
        with job_tables(spark, spec.name):
            grid = materialise(parse_lines(lines, width), f"{spec.name}-arrivals")
            cleaned = add_fingerprint(clean(grid, spec, width), spec.staging_columns)
            cleaned = materialise(cleaned, f"{spec.name}-cleaned")
            fresh, _ = load_fresh(cleaned, spec)
            refresh_quarters(spark, spec, fresh, quarters_of(cleaned))

    files = spark.readStream.option("pathGlobFilter", CSV_FILES).option("maxFilesPerTrigger", files_at_once)
    query = (
        text_lines(files.text(f"{source}/{spec.sheet}"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{progress}/{spec.name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    create_public_view(spark, spec)
