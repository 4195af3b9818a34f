"""Exact top-k search by distributed histogram selection.

Scores of every query against every vector are integer inner products.  They are
computed block against block with matrix products, and never stored:

1. each task reports, per query, counts of its vectors' scores in coarse bins
   (from the top down, until it has counted k: bins below cannot hold the global
   k-th score);
2. the counts are added up over all tasks, which locates the bin of each query's
   k-th score and the number of scores above it;
3. that bin is split into finer bins, again and again, until a bin is a single
   score: the k-th score itself;
4. one more pass keeps the scores above it, and of those equal to it the smallest
   ids, as many as are needed; no block sends more than k rows for a query,
   however many vectors tie.

Vectors are packed into blocks, dealt over the partitions once, and then stay where they
are.  The queries go to them: groups of at most ``GROUP_ROWS`` queries and ``GROUP_BYTES``
are sent to every task, one group after another, whatever the number of queries.  A pass
shuffles counts only, at most one row per task, query and bin.  A task holds one batch of
blocks and the counts of a group (``GROUP_ROWS * BINS`` 32-bit numbers); the driver
holds a group's vectors and k-th scores.  Each group's result is written before the next one.

Defined cases
- vectors that are null or hold a null or non-finite component take no part;
- vectors shorter than the longest are taken as filled up with zeros;
- a query never finds rows with its own id; ties go to the smaller id;
- rows that repeat an id (as queries or candidates) each count; of equal
  (query, id, score) rows each is returned;
- with fewer than k candidates all are returned; an empty table gives none;
- scores must fit 63 bits; products are exact (doubles where every sum stays
  below 2**53, 64-bit integers otherwise);
- null ids take no part;
- only (id, vector) are read, so extra columns never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import materialize
from faultline.session import checkpoint_dir, ship_package, shuffle_partitions

BLOCK_ROWS = 2048
QUERY_ROWS = 2048
SLICE_ROWS = 256  # queries scored at a time inside a task
GROUP_ROWS = 16384  # queries sent to the tasks at a time
GROUP_BYTES = 64 << 20  # and their bytes; a single block may be larger
BINS = 256
_NO_SCORE = np.iinfo(np.int64).min


def quantise(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector takes no part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    ints = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(vec.isNotNull() & ~bad, ints)


def _blocks(rows: DataFrame, block_rows: int, prefix: str) -> DataFrame:
    """Rows (id, v) packed into blocks: ids and a row-major matrix, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, block_rows):
                part = batch.slice(a, block_rows)
                v = part.column("v")
                width = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                m = np.zeros((len(width), int(width.max(initial=0))), dtype=np.int64)
                row = np.repeat(np.arange(len(width)), width)
                m[row, np.arange(len(flat)) - np.repeat(np.cumsum(width) - width, width)] = flat
                top = int(np.abs(m).max(initial=0))
                m = m.astype("<i4" if top < 2**31 else "<i8")
                ids = part.column("id").to_numpy(zero_copy_only=False).astype("<i8")
                cols = [ids.tobytes(), m.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], pa.binary()) for c in cols]
                    + [pa.array([c], pa.int64()) for c in (m.shape[1], m.itemsize, top)],
                    names=[prefix + c for c in ("ids", "m", "dim", "item", "max")],
                )

    no, n = F.col(f"{prefix}no"), shuffle_partitions(rows.sparkSession)
    spread = F.pmod(F.shiftright(no, 33) + no.bitwiseAND(F.lit((1 << 33) - 1)), F.lit(n)).cast("int")  # blocks in turn
    schema = ", ".join(f"{prefix}{c}" for c in ("ids binary", "m binary", "dim long", "item long", "max long"))
    packed = rows.mapInArrow(run, schema).withColumn(f"{prefix}no", F.monotonically_increasing_id())
    return materialize(packed.repartitionById(n, spread), "blocks")


def _matrix(r, prefix: str, width: int, dtype) -> np.ndarray:
    ids = np.frombuffer(r[f"{prefix}ids"], "<i8")
    out = np.zeros((len(ids), width), dtype=dtype)
    if r[f"{prefix}dim"]:
        out[:, : r[f"{prefix}dim"]] = np.frombuffer(r[f"{prefix}m"], f"<i{r[f'{prefix}item']}").reshape(len(ids), -1)
    return out


def _scores(q, b) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of queries of one cell: first query, vector ids, scores (a row's own id masked)."""
    q_ids, b_ids = np.frombuffer(q["qids"], "<i8"), np.frombuffer(b["bids"], "<i8")
    width = int(max(q["qdim"], b["bdim"]))
    small = int(q["qmax"]) * int(b["bmax"]) * max(width, 1) < 2**53
    dtype = np.float64 if small else np.int64
    qm, bm = _matrix(q, "q", width, dtype), _matrix(b, "b", width, dtype).T
    for a in range(0, len(q_ids), SLICE_ROWS):
        s = (qm[a : a + SLICE_ROWS] @ bm).astype(np.int64)
        s[q_ids[a : a + SLICE_ROWS, None] == b_ids[None, :]] = _NO_SCORE
        yield a, b_ids, s


class _Group:
    """Some query blocks, sent to every task, and what is known of their k-th scores: ``lo`` (the bin
    that holds it starts there) and ``need`` (how many scores are wanted from that bin down)."""

    def __init__(self, blocks: list[dict], k: int, lowest: int) -> None:
        self.blocks = blocks
        self.first = np.cumsum([0, *[len(q["qids"]) // 8 for q in blocks]])
        self.lo = np.full(self.first[-1], lowest, dtype=np.int64)
        self.need = np.full(self.first[-1], k, dtype=np.int64)

    def scores(self, block) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Places of some queries in the group, their ids, ids of the block's vectors, scores."""
        for first, q in zip(self.first, self.blocks):
            q_ids = np.frombuffer(q["qids"], "<i8")
            for a, b_ids, s in _scores(q, block):
                yield slice(first + a, first + a + len(s)), q_ids[a : a + len(s)], b_ids, s


def _groups(ask: DataFrame, group_rows: int, group_bytes: int) -> list[list[int]]:
    """Numbers of the query blocks, in groups of at most so many queries and bytes (or of one block)."""
    groups, rows, size = [], 0, 0
    for r in ask.select("qno", (F.length("qids") / 8).alias("n"), F.length("qm").alias("b")).orderBy("qno").toLocalIterator():
        if not groups or rows + r["n"] > group_rows or size + r["b"] > group_bytes:
            groups.append([])
            rows, size = 0, 0
        groups[-1].append(r["qno"])
        rows, size = rows + r["n"], size + r["b"]
    return groups


def _histogram(base: DataFrame, group: _Group, width: int, bin_width: int) -> DataFrame:
    """Counts of scores by bin of the interval [lo, lo + width) of each query, added up in each task
    over all its vectors; from the top bin down to where ``need`` are counted."""
    shared, bins = base.sparkSession.sparkContext.broadcast(group), -(-width // bin_width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        counts = np.zeros((len(g.lo), bins), dtype=np.int32)
        floor = np.zeros(len(g.lo), dtype=np.int64)  # bins below it cannot hold the k-th score
        for batch in batches:
            for block in batch.to_pylist():
                for at, _, _, s in g.scores(block):
                    bottom = (g.lo[at] + floor[at] * bin_width)[:, None]
                    row, col = np.nonzero((s >= bottom) & (s - g.lo[at, None] < width) & (s != _NO_SCORE))
                    nth = (s[row, col] - g.lo[at][row]) // bin_width
                    h = counts[at]
                    h += np.bincount(row * bins + nth, minlength=h.size).reshape(h.shape).astype(np.int32)
                    reached = h[:, ::-1].cumsum(axis=1)[:, ::-1] >= g.need[at, None]  # true from bin 0 up to the k-th score's
                    floor[at] = np.maximum(reached.sum(axis=1) - 1, 0)
        for a in range(0, len(counts), SLICE_ROWS):
            h = counts[a : a + SLICE_ROWS].astype(np.int64)
            higher = h[:, ::-1].cumsum(axis=1)[:, ::-1] - h
            row, col = np.nonzero((h > 0) & (higher < g.need[a : a + SLICE_ROWS, None]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (a + row, col, h[row, col], g.need[a + row])], names=["qi", "bin", "n", "need"]
            )

    return base.mapInArrow(run, "qi long, bin long, n long, need long")


def _selection(base: DataFrame, group: _Group) -> DataFrame:
    """Scores above each query's k-th, and of each block the smallest ids among those equal to it."""
    shared = base.sparkSession.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for batch in batches:
            for block in batch.to_pylist():
                for at, q_ids, b_ids, s in g.scores(block):
                    kth, need = g.lo[at], g.need[at]
                    row, col = np.nonzero((s > kth[:, None]) & (s != _NO_SCORE))
                    tie_row, tie_col = np.nonzero((s == kth[:, None]) & (s != _NO_SCORE))
                    order = np.lexsort((b_ids[tie_col], tie_row))
                    tie_row, tie_col = tie_row[order], tie_col[order]
                    ties = np.arange(len(tie_row)) - np.searchsorted(tie_row, tie_row) < need[tie_row]
                    row, col = np.concatenate((row, tie_row[ties])), np.concatenate((col, tie_col[ties]))
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x.astype(np.int64)) for x in (at.start + row, q_ids[row], b_ids[col], s[row, col])],
                            names=["qi", "query_id", "id", "score"],
                        )

    return base.mapInArrow(run, "qi long, query_id long, id long, score long")


def _locate(base: DataFrame, group: _Group, width: int) -> None:
    """Refine histograms until ``lo`` is each query's k-th score (or its lowest, with fewer than k)."""
    down = Window.partitionBy("qi").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    while width > 1:
        bin_width = -(-width // BINS)
        found = (
            _histogram(base, group, width, bin_width)
            .groupBy("qi", "bin", "need").agg(F.sum("n").alias("n"))
            .withColumn("more", F.coalesce(F.sum("n").over(down), F.lit(0)))
            .filter("more < need")
            .groupBy("qi").agg(F.min("bin").alias("bin"), F.max("more").alias("more"))
            .toPandas()  # one row per query of the group
        )
        qi = found["qi"].to_numpy()
        group.lo[qi] += found["bin"].to_numpy() * bin_width
        group.need[qi] -= found["more"].to_numpy()
        width = bin_width


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    group_rows: int = GROUP_ROWS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the id column, ``score``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        vectors[id_col].cast("long").alias("id"), quantise(vectors[vec_col], scale).alias("v"), is_query.alias("q")
    ).filter(F.col("v").isNotNull() & F.col("id").isNotNull())
    base = _blocks(rows.select("id", "v"), block_rows, "b")
    ask = _blocks(rows.filter("q").select("id", "v"), query_rows, "q")
    top = ask.agg(F.max("qmax"), F.max("qdim")).first()
    other = base.agg(F.max("bmax"), F.max("bdim")).first()
    if top[0] is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    reach = top[0] * other[0] * min(top[1], other[1])  # no score lies beyond +-reach
    if reach >= 2**62:
        raise ValueError("scores may exceed 63 bits")
    order = Window.partitionBy("qi").orderBy(F.desc("score"), F.asc("id"))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/top-k-{uuid.uuid4().hex}"
    for i, numbers in enumerate(_groups(ask, group_rows, group_bytes)):
        rows_of = ask.filter(F.col("qno").between(numbers[0], numbers[-1])).orderBy("qno").collect()  # at most group_bytes
        group = _Group([r.asDict() for r in rows_of], k, -reach)
        _locate(base, group, 2 * reach + 1)
        ranked = _selection(base, group).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "id", "score").write.parquet(f"{folder}/part={i}")
    found = spark.read.schema("query_id long, rank int, id long, score long").parquet(folder)
    return found.select("query_id", "rank", F.col("id").alias(id_col), "score")
