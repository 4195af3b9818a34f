import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int, rank int, lo string"


def _ints(v):
    return [math.floor(64 * float(np.float32(x))) for x in v]


def _brute(rows, k):
    ok = [(i, _ints(v)) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 20 == 0:
            found = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i))[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 2048, 4096), (16, 3, 7)])  # the second: several groups of queries
def test_matches_brute_force(spark, blocks):
    r = np.random.default_rng(0)
    rows = [(i, r.normal(size=6).astype(np.float32).tolist(), 0, 0, "") for i in range(150)]
    rows += [(200 + i, [0.5] * 6, 0, 0, "") for i in range(90)]  # many equal vectors: ties go to the smaller id
    rows += [(400, None, 0, 0, ""), (420, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, 0, ""), (440, [float("nan")] * 6, 0, 0, ""),
             (460, [float("inf")] + [0.0] * 5, 0, 0, ""), (480, [], 0, 0, ""), (500, [1.0, 2.0], 0, 0, ""), (None, [1.0] * 6, 0, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=20, block_rows=blocks[0], query_rows=blocks[1], group_rows=blocks[2]).collect()
    assert sorted(tuple(x) for x in got) == _brute(rows, 20)


def test_few_candidates_repeated_ids_and_empty_table(spark):
    rows = [(0, [1.0], 0, 0, ""), (1, [2.0], 0, 0, ""), (1, [2.0], 0, 0, ""), (2, [-1.0], 0, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 64 * 128), (0, 2, 1, 64 * 128), (0, 3, 2, -64 * 64)]
    assert topk.top_k(df.filter("vec_id = 0"), F.lit(True)).count() == 0
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_large_values_stay_exact(spark):
    rows = [(0, [1e7, 1.0], 0, 0, ""), (1, [1e7, 1.0], 0, 0, ""), (2, [1e7, 2.0], 0, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") == 0, k=2).collect())
    big = (64 * 10**7) ** 2
    assert got == [(0, 1, 2, big + 64 * 128), (0, 2, 1, big + 64 * 64)]


def test_groups_hold_every_query_block_within_their_bounds(spark):
    ask = spark.createDataFrame([(n, b"x" * 8 * r, b"y" * z) for n, r, z in [(0, 3, 10), (1, 3, 10), (5, 3, 10), (6, 1, 90), (9, 9, 5)]], "qno long, qids binary, qm binary")
    assert topk._groups(ask, 6, 50) == [[0, 1], [5], [6], [9]]
    assert topk._groups(ask.limit(0), 6, 50) == []


def test_vectors_are_not_shuffled_in_a_pass(spark):
    base = topk._blocks(spark.range(300).selectExpr("id", "array(id, id % 7) AS v"), 32, "b")
    ask = topk._blocks(spark.range(0, 300, 20).selectExpr("id", "array(id, id % 7) AS v"), 32, "q")
    group = topk._Group([r.asDict() for r in ask.collect()], 20, -10)
    for df in (topk._histogram(base, group, 1000, 4), topk._selection(base, group)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    counted = topk._histogram(base, group, 1 << 20, 1 << 12)
    assert counted.count() <= len(group.lo) * 256 * base.rdd.getNumPartitions()  # rows shuffled do not depend on the vectors
