"""Document (JSON-lines) form of the sensor table.

``write_documents`` replaces a collection (``mode="overwrite"``) with one
JSON record per row, at most ``batch_size`` records per file, and returns the
row count from a ``df.observe`` metric gathered during the write (no second
pass).  Nulls are written as fields, so a record shows all its columns.
``partition_by`` (say, the label) gives each value a folder of its own; a filter on
it then reads only those folders.

The column names are kept beside the collection (``<path>_columns``).  ``read_documents``
takes them from there, so that a read is one scan: every value is text, the store's
``_id`` is dropped and ``"na"`` becomes NULL.  A record with a field that is not
listed, or one that is no JSON object, is an error naming its file.  A collection that has no list
(another program wrote it) is read with columns taken from the records, one more pass.

Defined cases
- a listed field that a record lacks is NULL;
- partition values are text; NULL stays NULL, an empty string becomes NULL (folder names cannot tell them apart);
- the list is removed before records are replaced and written after them, so a load that
  dies in between leaves a collection without a list, never one with a wrong list;
- appending adds new columns to the list; the partitioning cannot change.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.clean import missing_to_null
from faultline.sources.reports import path_exists, read_bytes, remove, write_bytes


def _list_path(path: str) -> str:
    return f"{path.rstrip('/')}_columns/columns.json"


def listed_columns(spark: SparkSession, path: str) -> dict | None:
    """``{"columns": [...], "partition_by": [...]}`` of a collection; None if nothing is listed."""
    raw = read_bytes(spark, _list_path(path))
    return None if raw is None else json.loads(raw.decode("utf-8"))


def write_documents(
    df: DataFrame, path: str, batch_size: int = 5000, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> int:
    spark, folders = df.sparkSession, list(partition_by)
    known = listed_columns(spark, path) if mode == "append" else None
    if known and known["partition_by"] != folders:
        raise ValueError(f"the collection is partitioned by {known['partition_by']}, not by {folders}")
    unlisted = mode == "append" and known is None and path_exists(spark, path)
    if mode == "overwrite":
        remove(spark, _list_path(path))
    obs = Observation("documents_written")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("maxRecordsPerFile", batch_size)
    writer = writer.option("ignoreNullFields", False)
    (writer.partitionBy(*folders) if folders else writer).json(path)
    if not unlisted:
        before = known["columns"] if known else []
        columns = before + [c for c in df.columns if c not in before]
        write_bytes(spark, _list_path(path), json.dumps({"columns": columns, "partition_by": folders}).encode("utf-8"))
    return int(obs.get["rows"])


def _read_listed(spark: SparkSession, path: str, known: dict) -> DataFrame:
    folders = known["partition_by"]
    fields = [c for c in known["columns"] if c not in folders]
    schema = T.StructType([T.StructField("value", T.StringType())] + [T.StructField(c, T.StringType()) for c in folders])
    lines = spark.read.schema(schema).text(path).filter(F.trim("value") != "")
    keys = F.json_object_keys("value")
    listed = F.array(*[F.lit(c) for c in fields]).cast("array<string>")
    where = F.col("_metadata.file_path")
    parsed = (
        F.when(keys.isNull(), F.raise_error(F.concat(F.lit("not a JSON object in "), where)))
        .when(
            F.size(F.array_except(keys, listed)) > 0,
            F.raise_error(F.concat(F.lit("fields not listed: "), F.concat_ws(", ", F.array_except(keys, listed)), F.lit(" in "), where)),
        )
        .otherwise(F.from_json("value", T.StructType([T.StructField(c, T.StringType()) for c in fields])))
    )
    record = lines.select(parsed.alias("record"), *folders) if fields else lines
    return record.select(*[F.col(c) if c in folders else F.col("record").getField(c).alias(c) for c in known["columns"]])


def read_documents(spark: SparkSession, path: str, id_col: str = "_id") -> DataFrame:
    known = listed_columns(spark, path)
    df = _read_listed(spark, path, known) if known else spark.read.option("primitivesAsString", True).json(path)
    return missing_to_null(df.drop(id_col))
