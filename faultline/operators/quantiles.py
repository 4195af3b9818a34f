"""Exact quantiles of many columns by refining histograms around the wanted ranks.

A double has an order-preserving integer key, so the k-th smallest value is found from its
leading bits downwards: the first pass counts the leading 16 bits of every column's values,
each later pass counts the next bits of the values inside the buckets that hold a wanted
rank.  A bucket of at most ``finish_rows`` values is resolved in the pass after it, so the
usual number of passes is two or three and never more than four.

Rows are counted in the tasks that read them and never sorted or exchanged; a pass shuffles
at most ``65,536`` (or ``finish_rows``) counts for each wanted bucket.  To the driver come one row per column
and one per wanted rank, ``2 x columns x probabilities`` at most, however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.session import shared_table, ship_package

LEVEL_BITS = 16
FINISH_ROWS = 1 << 16
_COUNTS = "bucket int, child long, n long"
_HELD = 1 << 18  # counted pairs a task holds before it sends them on


def order_keys(x: np.ndarray) -> np.ndarray:
    """Signed integers in the order of the doubles ``x`` (both zeros alike; no NaN)."""
    bits = np.ascontiguousarray(x + 0.0, dtype=np.float64).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def key_value(key: int) -> float:
    """The double of one key."""
    k = np.array([key], dtype=np.int64)
    return float((k ^ ((k >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)[0])


@dataclass
class _Open:
    """Buckets to count in one column: sorted prefixes (keys shifted by ``shift``), their
    numbers, and by how many bits the keys inside are shifted when counted."""

    column: int
    shift: int
    prefixes: np.ndarray
    numbers: np.ndarray
    child_shift: np.ndarray


def _children(x: np.ndarray, o: _Open) -> tuple[np.ndarray, np.ndarray]:
    keys = order_keys(x[~np.isnan(x)])
    if o.shift >= 64:  # the whole column is one bucket
        return np.full(len(keys), o.numbers[0], dtype=np.int32), keys >> o.child_shift[0]
    lead = keys >> np.int64(o.shift)
    at = np.minimum(np.searchsorted(o.prefixes, lead), len(o.prefixes) - 1)
    inside = o.prefixes[at] == lead
    at = at[inside]
    return o.numbers[at], keys[inside] >> o.child_shift[at]


def _counter(todo: list[_Open]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["bucket", "child", "n"]

    def combined(held: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(held).group_by(["bucket", "child"]).aggregate([("n", "sum")])
        return t.rename_columns([{"n_sum": "n"}.get(c, c) for c in t.column_names]).select(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            for o in todo:
                x = batch.column(o.column).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
                bucket, child = _children(x, o)
                if len(child):
                    held.append(pa.table([pa.array(bucket, pa.int32()), pa.array(child, pa.int64()), pa.array(np.ones(len(child), np.int64))], names))
                    rows += len(child)
            if rows > _HELD:
                held = [combined(held)]
                rows = held[0].num_rows
                if rows > _HELD // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from combined(held).to_batches()

    return run


def _count(values: DataFrame, todo: list[_Open]) -> DataFrame:
    part = values.mapInArrow(_counter(todo), _COUNTS)
    return part.groupBy("bucket", "child").agg(F.sum("n").alias("n"))


def _locate(counts: DataFrame, ranks: list[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int, int]]:
    """``(bucket, rank)`` -> the child holding that rank, the values before it in the bucket, its values."""
    # At most 65,536 (or finish_rows) children a bucket, so a window over one is bounded.
    upto = F.sum("n").over(Window.partitionBy("bucket").orderBy("child").rowsBetween(Window.unboundedPreceding, 0))
    cum = counts.withColumn("upto", upto)
    want = counts.sparkSession.createDataFrame(ranks, "b int, rank long")
    hit = cum.join(F.broadcast(want), (F.col("bucket") == F.col("b")) & (F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto")))
    rows = hit.select("b", "rank", "child", (F.col("upto") - F.col("n")).alias("before"), "n").collect()  # one per wanted rank
    return {(r["b"], r["rank"]): (r["child"], r["before"], r["n"]) for r in rows}


def values_at_ranks(
    values: DataFrame, n_columns: int, wanted: Callable[[int], Sequence[int]], finish_rows: int = FINISH_ROWS
) -> tuple[list[int], list[dict[int, float]]]:
    """For each of the first ``n_columns`` columns of ``values`` (doubles): how many values it
    has, and the value at each rank (from 0) that ``wanted(size)`` names."""
    shift = 64 - LEVEL_BITS
    whole = [_Open(c, 64, np.zeros(1, np.int64), np.array([c], np.int32), np.array([shift], np.int64)) for c in range(n_columns)]
    counts = shared_table(_count(values, whole), "leading-bits")
    sizes = [0] * n_columns
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per column
        sizes[r["bucket"]] = r["n"]
    found: list[dict[int, float]] = [{} for _ in range(n_columns)]
    # a wanted rank: its column, its rank there, its bucket of this pass and its rank in that bucket
    open_ranks = [(c, k, c, k) for c in range(n_columns) if sizes[c] for k in sorted(set(wanted(sizes[c])))]
    child_shift = {c: shift for c in range(n_columns)}
    while open_ranks:
        at = _locate(counts, sorted({(b, k) for _, _, b, k in open_ranks}))
        inner: dict[tuple[int, int], int] = {}  # (column, prefix) -> values inside
        later = []
        for c, rank, b, k in open_ranks:
            child, before, n = at[(b, k)]
            if child_shift[b] == 0:
                found[c][rank] = key_value(child)
            else:
                inner[(c, child)] = n
                later.append((c, rank, (c, child), k - before))
        number = {p: i for i, p in enumerate(sorted(inner))}
        open_ranks = [(c, rank, number[p], k) for c, rank, p, k in later]
        if not open_ranks:
            break
        child_shift = {number[p]: 0 if n <= finish_rows else shift - LEVEL_BITS for p, n in inner.items()}
        todo = []
        for c in sorted({c for c, _ in inner}):
            own = sorted(p for p in inner if p[0] == c)
            todo.append(
                _Open(c, shift, np.array([p[1] for p in own], np.int64), np.array([number[p] for p in own], np.int32), np.array([child_shift[number[p]] for p in own], np.int64))
            )
        shift -= LEVEL_BITS
        counts = _count(values, todo)
    return sizes, found


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], finish_rows: int = FINISH_ROWS) -> DataFrame:
    """``(column, prob, value)`` for every column and probability, linear between order
    statistics (NULL and NaN ignored; a column without a value has no row)."""
    cols, probs = list(columns), [float(p) for p in probs]
    spark = df.sparkSession
    ship_package(spark)
    # Read by every pass: the columns are written once, not computed again.
    values = shared_table(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]), "values")

    def wanted(n: int) -> list[int]:
        return [k for p in probs for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))]

    sizes, found = values_at_ranks(values, len(cols), wanted, finish_rows)
    rows = []
    for c, name in enumerate(cols):
        for p in probs if sizes[c] else ():
            h = (sizes[c] - 1) * p
            lo, hi = found[c][math.floor(h)], found[c][math.ceil(h)]
            rows.append((name, p, lo + (h - math.floor(h)) * (hi - lo)))
    return spark.createDataFrame(rows, "column string, prob double, value double")
