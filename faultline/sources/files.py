"""File sources and sinks for raw sensor tables.

* ``read_sensor_csv`` - headed CSV, every column as text, ``"na"`` read as NULL.
  Columns are bound by the header of their own file, so files whose columns
  stand in another order give the same rows; files with other columns are an
  error that names them.
* ``read_preamble_csv`` - CSV whose header is the (n+1)-th non-blank line of
  each file (a licence preamble comes first).
* ``write_csv`` / ``write_parquet`` - sinks; callers pass URIs, the job never
  writes over the input it is reading.

A line with more fields than its header is an error that names the file and the line; a
line with fewer has NULLs in the columns it lacks (both as ``pandas.read_csv`` has it).

Headers are read by one task per split that ends after the first lines; the rows are then
read in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.session import ship_package
from faultline.spec import MISSING_TOKEN

_BAD = "_fl_bad"
_TOP_BATCH = 64  # lines that a header task takes at a time


def _csv_names(spark: SparkSession, line: str) -> list[str]:
    """Column names of a header line, quoted names included."""
    row = spark.range(1).select(F.from_csv(F.lit(line), _text_schema(line.count(",") + 1)).alias("r")).first()["r"]
    return [c.strip() for c in row if c is not None]


def _text_schema(n: int) -> str:
    return ", ".join(f"_c{i} STRING" for i in range(n))


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their file and the start of their split."""
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _filled(lines: pa.Array) -> np.ndarray:
    """Which lines are not blank."""
    return pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(pc.fill_null(lines, ""))), 0).to_numpy(zero_copy_only=False)


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The parts of a batch that come from one split of one file: its name, its start, the rows."""
    files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
    a = 0
    for b in range(1, len(files) + 1):
        if b == len(files) or files[b] != files[a] or starts[b] != starts[a]:
            yield files[a], starts[a], batch.slice(a, b - a)
            a = b


def _top_lines(spark: SparkSession, path: str | Sequence[str], n: int) -> dict[str, list[str]]:
    """The first ``n`` non-blank lines of each file: ``n`` short rows per file reach the driver.

    Read in a session of its own, whose scan puts no two files into one task, so a task is
    done as soon as it has its lines, or sees that its split is not a file's first."""
    ship_package(spark)
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_TOP_BATCH))

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            for file, start, rows in _stretches(batch):
                if start == 0 and seen.get(file, 0) < n:
                    first = rows.column("line").filter(pa.array(_filled(rows.column("line")))).slice(0, n - seen.get(file, 0))
                    at = np.arange(len(first), dtype=np.int64) + seen.get(file, 0)
                    seen[file] = seen.get(file, 0) + len(first)
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(first), pa.string()), pa.array(at), first], names=["file", "nth", "line"])
            if len(seen) <= 1 and (start > 0 or seen.get(file, 0) >= n):
                return  # one file in this task: what it has is read

    found: dict[str, list[str]] = {}
    for r in sorted(_lines(own, path).mapInArrow(top, "file string, nth long, line string").collect()):
        found.setdefault(r["file"], []).append(r["line"])
    return found


def _by_header(top: dict[str, list[str]], n: int, path) -> list[tuple[str, list[str]]]:
    """Header lines (the ``n``-th non-blank ones) with their files, by text order."""
    short = sorted(f for f, lines in top.items() if len(lines) < n)
    if short or not top:
        raise ValueError(f"{short[0] if short else path}: fewer than {n} non-blank lines, so no header line")
    out: dict[str, list[str]] = {}
    for file, lines in top.items():
        out.setdefault(lines[n - 1].removeprefix("\ufeff"), []).append(file)
    return sorted(out.items())


def _names(spark: SparkSession, line: str, file: str) -> list[str]:
    names = _csv_names(spark, line)
    if len(set(names)) != len(names):
        raise ValueError(f"{file}: a column name repeats in the header")
    return names


def _no_surplus(n: int, first: Column, file: Column) -> Column:
    """True, or an error if the line kept in ``_BAD`` has more than ``n`` fields.  ``first``, a data
    column, is named because Spark refuses to read that column alone."""
    unquoted = F.regexp_replace(_BAD, r'"(?:[^"\\]|\\.)*"', "")
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(",")))
    message = F.concat(file, F.lit(f": a line has more than {n} fields: "), F.substring(_BAD, 1, 200), F.coalesce(F.substring(first, 1, 0), F.lit("")))
    return F.when(F.col(_BAD).isNotNull() & (commas >= n), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _joined(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    out = parts[0][1]
    for file, df in parts[1:]:
        if set(df.columns) != set(out.columns):
            odd = sorted(set(df.columns) ^ set(out.columns))
            raise ValueError(f"{file}: columns differ from those of other files: {odd}")
        out = out.unionByName(df)
    return out


def read_sensor_csv(spark: SparkSession, path: str | Sequence[str], null_value: str | None = MISSING_TOKEN) -> DataFrame:
    """Headed CSV, every column as text (no inference pass); ``"na"`` is NULL.
    ``clean.clean_sensor_table`` then casts the declared features.

    The column order is that of the first header by text order."""
    parts: list[tuple[str, DataFrame]] = []
    for line, files in _by_header(_top_lines(spark, path, 1), 1, path):
        names = _names(spark, line, files[0])
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BAD]])
        reader = spark.read.schema(schema).options(header=True, columnNameOfCorruptRecord=_BAD, columnPruning=False)
        if null_value is not None:
            reader = reader.option("nullValue", null_value)
        rows = reader.csv(files)
        rows = rows.filter(_no_surplus(len(names), F.col(f"`{names[0]}`"), F.col("_metadata.file_path")))
        parts.append((files[0], rows.select(*[F.col(f"`{n}`") for n in names])))
    return _joined(parts)


def read_preamble_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    header_line: int = 14,
    null_value: str | None = MISSING_TOKEN,
) -> DataFrame:
    """Rows of CSV files whose column names are on non-blank line ``header_line``
    (0-based, like ``pandas.read_csv(header=14)``); all columns as strings.

    Preamble and header must lie in a file's first split.  All files must have
    the same columns."""
    n = header_line + 1
    opts = {"columnNameOfCorruptRecord": _BAD} | ({"nullValue": null_value} if null_value is not None else {})
    parts: list[tuple[str, DataFrame]] = []

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}  # non-blank lines of the files that begin in this task
        for batch in batches:
            for file, start, rows in _stretches(batch):
                keep = _filled(rows.column("line"))
                if start == 0 and seen.get(file, 0) < n:
                    before = seen.get(file, 0)
                    seen[file] = before + int(keep.sum())
                    keep &= np.cumsum(keep) + before > n
                yield rows.select(["line", "file"]).filter(pa.array(keep))

    for line, files in _by_header(_top_lines(spark, path, n), n, path):
        names = _names(spark, line, files[0])
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _BAD]])
        rows = _lines(spark, files).mapInArrow(body, "line string, file string")
        rows = rows.select("file", F.from_csv("line", schema.simpleString(), opts).alias("r")).select("file", "r.*")
        rows = rows.filter(_no_surplus(len(names), F.col(f"`{names[0]}`"), F.col("file")))
        parts.append((files[0], rows.select(*[F.col(f"`{c}`") for c in names])))
    return _joined(parts)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Feature-store snapshot: write once, then read back (the read side is
    what later stages use, so they never recompute the source)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_feature_table(df: DataFrame, path: str, features: list[str], label: str = "label", keys: list[str] = ()) -> None:
    """The dense feature matrix as a named table: keys, features, label last."""
    df.select(*keys, *features, label).write.mode("overwrite").parquet(path)


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
