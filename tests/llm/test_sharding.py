import hashlib
from collections import Counter, defaultdict

from faultline.llm import sharding

SCHEMA = "doc_id long, text string, h string, depth int, n_bytes int"


def _rows():
    return [(i, "é" * (i % 40) if i % 9 else None, "", 0, 0) for i in range(500)]


def test_only_oversized_buckets_split(spark):
    got = sharding.assign_shards(spark.createDataFrame(_rows(), SCHEMA), max_bytes=700).collect()
    assert sorted(r.doc_id for r in got) == list(range(500))
    bits = {i: bin(int(hashlib.md5(f"0:{i}".encode()).hexdigest()[:15], 16))[2:].zfill(60) for i in range(500)}
    size = {i: len((t or "").encode()) for i, t, *_ in _rows()}
    total = Counter()
    for i, b in bits.items():
        for d in range(61):
            total[b[:d]] += size[i]
    for r in got:
        assert r.n_bytes == size[r.doc_id] and r.shard_bytes == total[r.shard] <= 700
        assert r.shard == bits[r.doc_id][: r.depth]
        assert r.depth == 0 or total[r.shard[:-1]] > 700  # its parent had to split


def test_equal_keys_and_large_documents(spark):
    rows = [(7, "x" * 100, "", 0, 0)] * 50 + [(8, "y" * 5000, "", 0, 0), (None, "z", "", 0, 0), (None, "z", "", 0, 0)]
    got = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), max_bytes=1000).collect()
    assert len(got) == len(rows)
    load = defaultdict(int)
    for r in got:
        load[r.shard] += r.n_bytes
        if r.doc_id == 7:
            assert r.shard_bytes <= 1000
    assert all(load[r.shard] == r.shard_bytes for r in got)
    large = [r for r in got if r.doc_id == 8]
    assert load[large[0].shard] == 5000  # alone


def test_written_shards(spark, tmp_uri):
    df = spark.createDataFrame(_rows(), SCHEMA)
    directory = sharding.write_shards(df, f"{tmp_uri}/shards", max_bytes=700).collect()
    back = spark.read.option("recursiveFileLookup", False).parquet(f"{tmp_uri}/shards")
    assert sorted(r.doc_id for r in back.collect()) == list(range(500))
    n = {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()}
    assert {("s" + r.shard): r.n_docs for r in directory} == n
    assert set(back.columns) == {*df.columns, "shard"}


def test_empty_table_and_single_shard(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    assert sharding.assign_shards(df.limit(0), 100).count() == 0
    assert {(r.shard, r.depth) for r in sharding.assign_shards(df, 1 << 30).collect()} == {("", 0)}
