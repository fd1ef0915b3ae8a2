"""Staging and summary tables of the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerline.functions.text import fingerprint, row_key
from peerline.specs import QUARTER, TableSpec

STAGING = "staging"
CORE = "core"
PUBLIC = "public"
ROW_KEY = "row_key"
BUCKETS = 8


def create_keyed_table(
    spark: SparkSession, name: str, schema: T.StructType, quarter: str = QUARTER, buckets: int = BUCKETS
) -> str:
    """Create a table of rows if it is missing, partitioned by quarter; returns its name.

    Every row is stored with the digest of its fingerprint, and the table is cut into `buckets` by it: what is held
    can be compared with new rows bucket by bucket, without a shuffle of the table. Choose as many
    buckets as the largest quarter has GB, or more. Its options make every overwrite touch only the quarters being written.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}, {ROW_KEY} binary) USING parquet OPTIONS ('partitionOverwriteMode' = 'dynamic')"
            f" PARTITIONED BY ({quarter}) CLUSTERED BY ({ROW_KEY}) INTO {buckets} BUCKETS"
        )
    return name


def create_staging(spark: SparkSession, spec: TableSpec, buckets: int = BUCKETS) -> str:
    """Create the staging table if it is missing; returns its name."""
    return create_keyed_table(spark, f"{STAGING}.{spec.name}", spec.staging_schema, buckets=buckets)


def bucket_count(spark: SparkSession, table: str) -> int | None:
    """Buckets of a table, none where it is not cut into any."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return int(found["data_type"]) if found else None


def with_row_key(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the columns and types of `table`, with the digest of all of them in the table's order."""
    schema = rows.sparkSession.table(table).schema
    cast = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name != ROW_KEY))
    return cast.withColumn(ROW_KEY, row_key(fingerprint(cast)))


def held_keys(spark: SparkSession, table: str, quarters: Sequence[int | None] | None = None, quarter: str = QUARTER) -> DataFrame:
    """(row_key) of the rows a table holds; worked out from the row where the table does not store it."""
    held = spark.table(table)
    if quarters is not None:
        held = held.filter(in_quarters(quarters, quarter))
    return (held if ROW_KEY in held.columns else with_row_key(held, table)).select(ROW_KEY)


def in_quarters(quarters: Sequence[int | None], quarter: str = QUARTER) -> Column:
    """A partition filter: other quarters are not even listed."""
    wanted = F.col(quarter).isin([q for q in quarters if q is not None])
    return (wanted | F.col(quarter).isNull()) if None in quarters else wanted


def require_quarter_overwrite(spark: SparkSession, table: str) -> None:
    """Refuse a table on which an overwrite would drop the quarters not being written."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Storage Properties'").first()
    if details is None or "partitionOverwriteMode=dynamic" not in details["data_type"]:
        raise ValueError(f"{table} lacks the option partitionOverwriteMode = dynamic")


def read_staging(spark: SparkSession, spec: TableSpec, quarters: Sequence[int | None] | None = None) -> DataFrame:
    """The staging table in its declared column order, or only some quarters of it.

    The quarter list becomes a partition filter.
    """
    table = spark.table(f"{STAGING}.{spec.name}").select(*spec.staging_columns)
    return table if quarters is None else table.filter(in_quarters(quarters))


def read_summary(spark: SparkSession, spec: TableSpec, schema: str = PUBLIC) -> DataFrame:
    return spark.table(f"{schema}.{spec.summary}")
