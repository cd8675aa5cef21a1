"""Session helpers: a local session for tests and benches, and the shared folder for durable results."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_session(cores: str = "8", name: str = "daybook", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; elsewhere a machine-local path would be lost
    with its machine, so an unset folder is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/daybook/{name}-{uuid.uuid4().hex}"


def local_rows(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A small control table from rows at hand, known to the optimizer with its size; empty ones prune plans."""
    if not rows:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return spark.range(1).where(F.lit(False)).select(*nothing)
    columns = [{f.name: row.get(f.name) for f in schema.fields} for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(columns, schema=to_arrow_schema(schema)), schema)


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Everything downstream then sees the same rows however often tasks are re-run, and lost executors cost a
    re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
