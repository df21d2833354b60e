"""CSV series, market snapshots, plain exports, and small files that change at once."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T


def read_series_csv(
    spark: SparkSession, path: str, infer: bool = True, schema: str | T.StructType | None = None
) -> DataFrame:
    """CSV with a header. Give ``schema`` for large inputs: inference reads the data twice."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", str(infer).lower()).csv(path)


def read_snapshot(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """24-hour statistics: a JSON array of objects, or JSON lines with ``multiline=False``."""
    return (
        spark.read.schema("symbol string, quoteVolume string")
        .option("multiLine", str(multiline).lower())
        .json(path)
    )


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV; ``single_file`` funnels everything through one task and is off by default."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", "true").csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def put_file(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Whether a small file now holds the text. It is written aside and renamed, so readers see all of it or
    nothing; without ``replace`` a file that is already there stays, and only one of several writers succeeds."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    final = hadoop.Path(path)
    system = final.getFileSystem(conf)
    draft = hadoop.Path(final.getParent(), f".{uuid.uuid4().hex}")
    system.mkdirs(final.getParent())
    out = system.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE if replace else kinds.NONE
    try:
        hadoop.FileContext.getFileContext(final.toUri(), conf).rename(system.makeQualified(draft), system.makeQualified(final), how)
        return True
    except Py4JJavaError as failure:
        system.delete(draft, False)
        if replace or "FileAlreadyExists" not in failure.java_exception.getClass().getName():
            raise
        return False


def get_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def paths_of(spark: SparkSession, statuses) -> list[str]:
    """The paths of a listing, in a few calls of the JVM however long it is."""
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
    if found is None or not len(found):
        return []
    plain = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, len(found))
    jvm.java.lang.System.arraycopy(found, 0, plain, 0, len(found))
    return jvm.org.apache.commons.lang3.StringUtils.join(plain, "\n").split("\n")


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if there is no such folder; one listing."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(base):
        return []
    return [found.rpartition("/")[2] for found in paths_of(spark, system.listStatus(base))]


def subfolders(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """The folders named ``{prefix}{number}`` in a folder, by number."""
    tails = ((n.removeprefix(prefix), n) for n in names(spark, path) if n.startswith(prefix))
    return dict(sorted((int(tail), f"{path}/{n}") for tail, n in tails if tail.isdigit()))


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
