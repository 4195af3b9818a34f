"""Distributed running totals and hash-rank cuts equal their windowed definitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from faultline.operators import ranking
from faultline.operators.ranking import hash_rank_cut, running_totals


def test_running_totals_match_window_with_hot_group(spark):
    rng = random.Random(3)
    # group "hot" holds most rows; values unique within a group
    rows = [("hot", float(i), rng.randint(1, 5)) for i in range(3000)]
    rows += [(f"g{g}", float(i), rng.randint(1, 5)) for g in range(5) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, v double, w long").repartition(7)
    got = running_totals(df, ["g"], ["v"], ["w"], num_partitions=16).collect()
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("cum_w", F.sum("w").over(w)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("edge_rows", [65_536, 1])
def test_hash_rank_cut_is_exact(spark, monkeypatch, edge_rows):
    monkeypatch.setattr(ranking, "EDGE_ROWS", edge_rows)  # 1: the boundary prefix is refined by more digits
    rows = [("a" if i % 10 else "b", i) for i in range(5000)] + [("a", 77)] * 30
    df = spark.createDataFrame(rows, "c string, k long").withColumn("h", F.md5((F.col("k") % 1500).cast("string")))
    quota = spark.createDataFrame([("a", 1234), ("b", 0)], "c string, _fl_k long")
    got = sorted(r["k"] for r in hash_rank_cut(df, "c", "h", ["k"], quota).filter("_fl_in").collect())
    w = Window.partitionBy("c").orderBy("h", "k")
    want = sorted(
        r["k"] for r in df.withColumn("rn", F.row_number().over(w)).filter("c = 'a' and rn <= 1234").collect()
    )
    assert got == want


def test_hash_rank_cut_quota_above_size_takes_all(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)], "c string, k long").withColumn(
        "h", F.md5(F.col("k").cast("string"))
    )
    quota = spark.createDataFrame([("a", 500)], "c string, _fl_k long")
    assert hash_rank_cut(df, "c", "h", ["k"], quota).filter("_fl_in").count() == 50


def test_hash_rank_cut_keeps_groups_without_quota(spark):
    df = spark.createDataFrame([("a", i) for i in range(20)] + [("z", i) for i in range(5)], "c string, k long")
    df = df.withColumn("h", F.md5(F.col("k").cast("string")))
    quota = spark.createDataFrame([("a", 7)], "c string, _fl_k long")
    out = hash_rank_cut(df, "c", "h", ["k"], quota).collect()
    assert len(out) == 25
    assert sum(r["_fl_in"] for r in out if r["c"] == "a") == 7
    assert not any(r["_fl_in"] for r in out if r["c"] == "z")


def test_hash_rank_cut_many_groups(spark):
    rows = [(f"g{i % 40}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "c string, k long").withColumn("h", F.md5(F.col("k").cast("string")))
    quota = spark.createDataFrame([(f"g{j}", j * 2) for j in range(40)], "c string, _fl_k long")
    got = {r["k"] for r in hash_rank_cut(df, "c", "h", ["k"], quota).filter("_fl_in").collect()}
    w = Window.partitionBy("c").orderBy("h", "k")
    ranked = df.withColumn("rn", F.row_number().over(w)).join(quota, "c")
    want = {r["k"] for r in ranked.filter(F.col("rn") <= F.col("_fl_k")).collect()}
    assert got == want
