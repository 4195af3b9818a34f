"""Report sinks: drift/evaluation reports and the metrics history table.

The metrics history keeps one row per evaluation keyed by its epoch-second
``timestamp`` with scores rounded to 3 decimals.  Appending a timestamp that
is already present fails (the reference's primary-key error).  A timestamp is
claimed by creating its marker file, which the file system lets one writer do, so of two
writers at one time exactly one succeeds; rows written before there were markers are
found by a left-anti join on the key.  History of any size is never collected.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.metrics import SCORE_COLUMNS

HISTORY_SCHEMA = "timestamp long, " + ", ".join(f"{c} double" for c in SCORE_COLUMNS)


def _path(spark: SparkSession, path: str):
    """The path and its file system, as Spark's own readers see them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, fs = _path(spark, path)
    return fs.exists(where)


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """A small file of the driver's (a column list, say); None if it does not exist."""
    where, fs = _path(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    where, fs = _path(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _path(spark, path)
    fs.delete(where, False)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows if its path does not exist.  The path is looked up first: a
    read that fails would leave a Java stack trace in the driver's output."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def write_report(df: DataFrame, path: str) -> None:
    """Small report tables as JSON lines (one file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, HISTORY_SCHEMA)


class DuplicateTimestamp(Exception):
    pass


def claim(spark: SparkSession, folder: str, key: str) -> bool:
    """Create the marker of ``key``; False if it is there already (another writer has the key).

    The store decides: ``FileSystem.create`` without overwriting is atomic on a distributed file system
    (and on object stores that offer conditional puts); on a local disk ``Files.createFile`` is."""
    jvm = spark._jvm
    path, fs = _path(spark, f"{folder.rstrip('/')}/{key}")
    fs.mkdirs(path.getParent())
    try:
        if fs.getUri().getScheme() == "file":
            local = jvm.java.nio.file.Paths.get(path.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            none = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
            jvm.java.nio.file.Files.createFile(local, none)
        else:
            fs.create(path, False).close()
    except Py4JJavaError:
        if fs.exists(path):
            return False
        raise
    return True


def release(spark: SparkSession, folder: str, key: str) -> None:
    remove(spark, f"{folder.rstrip('/')}/{key}")


def append_scores(spark: SparkSession, path: str, scores: DataFrame) -> int:
    """Append rows ``(timestamp, five scores)``; raise if a timestamp exists, and write nothing then.

    The markers of the new timestamps (one per row of an evaluation) are claimed first and
    given back if the rows could not be written."""
    rows = scores.select(
        F.col("timestamp").cast("long"), *[F.round(F.col(c), 3).alias(c) for c in SCORE_COLUMNS]
    )
    stamps = [r["timestamp"] for r in rows.select("timestamp").collect()]  # the rows of one evaluation
    if len(set(stamps)) != len(stamps):
        raise DuplicateTimestamp("two of the new rows have the same timestamp")
    markers, mine = f"{path.rstrip('/')}_keys", []
    try:
        for stamp in stamps:
            if not claim(spark, markers, str(stamp)):
                raise DuplicateTimestamp(f"a score row reuses the timestamp {stamp}")
            mine.append(str(stamp))
        known = read_history(spark, path).select("timestamp")
        if not rows.join(known, "timestamp", "left_semi").isEmpty():
            raise DuplicateTimestamp("score rows reuse an existing timestamp")
        rows.coalesce(1).write.mode("append").parquet(path)
    except Exception:
        for key in mine:
            release(spark, markers, key)
        raise
    return len(stamps)
