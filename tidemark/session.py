"""Session settings and the shared folder that long jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # samples are wide rows: bound the batches sent to Python by size, not only by row count
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # building a wide plan from Python is several times faster without call-site capture
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or fetch) a session with the settings the library expects."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that query results depend on to a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors share one machine, falls back to a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def row_bytes(schema: T.StructType) -> Column:
    """Estimated size of one row in memory."""
    size = F.lit(16 + 8 * len(schema.fields))
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            size = size + 8 * F.coalesce(F.size(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            wrapped = F.to_json(F.struct(column.alias("v")))
            size = size + F.coalesce(F.length(wrapped), F.lit(0))
    return size


def settle_sized(df: DataFrame) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder once and continue from the written table (an action).

    A Parquet table rather than a row checkpoint: it survives lost executors just the same, and
    later reads load only the columns they need. Also gives the table's estimated size in memory
    in bytes, summed while writing.
    """
    path = scratch_path(df.sparkSession, "settled")
    seen = Observation()
    total = F.coalesce(F.sum(row_bytes(df.schema).cast("long")), F.lit(0)).alias("bytes")
    df.observe(seen, total).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["bytes"]


def settle(df: DataFrame) -> DataFrame:
    """``settle_sized`` without the measuring."""
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application settled. Frames built on it can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tidemark")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
