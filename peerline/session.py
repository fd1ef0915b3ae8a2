"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "peerline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; `conf` keys use `__` for `.`."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir`, or a part of the warehouse where that is unset.

    Both are places that every executor can reach; a machine's own temporary folder is not.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/working"


_job: contextvars.ContextVar[str | None] = contextvars.ContextVar("job", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the working folder, or under the job's own part of it."""
    return f"{_job.get() or working_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def job_tables(spark: SparkSession, name: str) -> Iterator[None]:
    """Working tables written inside go to one folder, which is dropped at the end and after a failure."""
    folder = f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"
    token = _job.set(folder)
    try:
        yield
    finally:
        _job.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back.

    Used where several branches need the same relation, or where a join must
    know its true size. The written table survives lost executors and is read
    column by column.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
