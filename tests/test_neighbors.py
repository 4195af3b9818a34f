"""Blocked k-NN, imputation and rebalancing against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import impute, resample
from faultline.operators.neighbors import knn_join


def _points(n, d, seed, missing=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    if missing:
        x[rng.random(size=x.shape) < missing] = np.nan
    return x


def _frame(spark, x, labels=None):
    d = x.shape[1]
    rows = []
    for i, r in enumerate(x):
        vals = [None if np.isnan(v) else float(v) for v in r]
        rows.append((i, *(vals if labels is None else [labels[i], *vals])))
    lab = "" if labels is None else "class string, "
    return spark.createDataFrame(rows, f"k long, {lab}" + ", ".join(f"f{j} double" for j in range(d)))


def test_blocked_knn_equals_brute_force(spark):
    x = _points(300, 4, 1)
    df = _frame(spark, x)
    feats = [f"f{j}" for j in range(4)]
    got = knn_join(df, df, "k", feats, 3, exclude_self=True, block_rows=64).collect()
    got = {(r["q_key"], r["nn_rank"]): r["b_key"] for r in got}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(300):
        order = np.lexsort((np.arange(300), d[i]))[:3]
        for rank, j in enumerate(order, start=1):
            assert got[(i, rank)] == j


def _sk_like_impute(fit, x, k):
    """Reference semantics of nearest-neighbour imputation (uniform weights)."""
    out = x.copy()
    d_all = x.shape[1]
    means = np.nanmean(fit, axis=0)
    for i in range(x.shape[0]):
        for c in np.flatnonzero(np.isnan(x[i])):
            cand = []
            for j in range(fit.shape[0]):
                if np.isnan(fit[j, c]):
                    continue
                both = ~np.isnan(x[i]) & ~np.isnan(fit[j])
                if both.sum() == 0:
                    continue
                dist = np.sqrt(d_all / both.sum() * ((x[i, both] - fit[j, both]) ** 2).sum())
                cand.append((dist, j, fit[j, c]))
            cand.sort()
            out[i, c] = np.mean([v for _, _, v in cand[:k]]) if cand else means[c]
    return out


def test_knn_imputer_matches_definition(spark):
    x = _points(120, 5, 2, missing=0.15)
    df = _frame(spark, x)
    feats = [f"f{j}" for j in range(5)]
    model = impute.KNNImputer(5, block_rows=32).fit(df, "k", feats)
    got = model.transform(df).orderBy("k").select(*feats).toPandas().to_numpy()
    want = _sk_like_impute(x, x, 5)
    assert np.allclose(got, want, equal_nan=False)


def test_knn_imputer_fewer_donors_than_k_and_no_shared_coordinate(spark):
    fit = np.array([[1.0, np.nan], [3.0, np.nan], [np.nan, 10.0]])
    x = np.array([[np.nan, 5.0], [2.0, np.nan]])
    model = impute.KNNImputer(5).fit(_frame(spark, fit), "k", ["f0", "f1"])
    got = model.transform(_frame(spark, x)).orderBy("k").select("f0", "f1").toPandas().to_numpy()
    # row 0 shares no coordinate with donors having f0 -> column mean 2.0; row 1 -> only donor of f1
    assert got[0, 0] == pytest.approx(2.0) and got[1, 1] == pytest.approx(10.0)


def test_smote_balances_and_tomek_removes_links(spark):
    x = _points(200, 3, 3)
    labels = ["pos" if i < 20 else "neg" for i in range(200)]
    df = resample.with_row_id(_frame(spark, x, labels), "k").drop("k")
    feats = ["f0", "f1", "f2"]
    bal = resample.smote_balance(df, "class", feats, k=5, seed=7)
    counts = {r["class"]: r["count"] for r in bal.groupBy("class").count().collect()}
    assert counts == {"pos": 180, "neg": 180}
    # synthetic rows lie on segments between minority rows: inside the minority bounding box
    lo = x[:20].min(axis=0)
    hi = x[:20].max(axis=0)
    syn = bal.filter(F.col("row_id").startswith("s")).select(*feats).toPandas().to_numpy()
    assert ((syn >= lo - 1e-12) & (syn <= hi + 1e-12)).all()
    again = resample.smote_balance(df.repartition(5), "class", feats, k=5, seed=7)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, bal.collect()))
    links = {r["row_id"] for r in resample.tomek_links(df, "class", feats).collect()}
    kept = {r["row_id"] for r in resample.remove_tomek_links(df, "class", feats).collect()}
    assert kept.isdisjoint(links) and len(kept) + len(links) == 200


def test_pruned_knn_equals_brute_force_on_skewed_clusters(spark):
    from faultline.operators.neighbors import knn_join_pruned

    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, (300, 3)), rng.normal(6, 0.3, (60, 3)), rng.normal(-5, 2, (40, 3))])
    df = _frame(spark, x)
    feats = ["f0", "f1", "f2"]
    got = knn_join_pruned(df, df, "k", feats, 4, exclude_self=True, block_rows=32).collect()
    got = {(r["q_key"], r["nn_rank"]): r["b_key"] for r in got}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        for rank, j in enumerate(np.lexsort((np.arange(len(x)), d[i]))[:4], start=1):
            assert got[(i, rank)] == j


def test_pruned_knn_string_keys_with_unvisited_cells(spark):
    """Two far-apart clusters, queries only in one: cells of the other are
    never visited, so some cogroup cells have base rows and no query rows.
    Their empty results must still carry string keys."""
    from faultline.operators.neighbors import knn_join_pruned

    rng = np.random.default_rng(5)
    near = rng.normal(size=(120, 3))
    far = rng.normal(size=(120, 3)) + 1000.0
    base = np.vstack([near, far])
    feats = [f"f{j}" for j in range(3)]
    rows = [(f"b{i}", *map(float, r)) for i, r in enumerate(base)]
    bdf = spark.createDataFrame(rows, "k string, " + ", ".join(f"{c} double" for c in feats))
    qdf = bdf.filter(F.col("f0") < 500)
    got = knn_join_pruned(qdf, bdf, "k", feats, 2, exclude_self=True, block_rows=16).collect()
    got = {(r["q_key"], r["nn_rank"]): r["b_key"] for r in got}
    d = np.sqrt(((near[:, None, :] - base[None, :, :]) ** 2).sum(-1))
    for i in range(near.shape[0]):
        d[i, i] = np.inf
        keys = np.array([f"b{j}" for j in range(base.shape[0])])
        order = np.lexsort((keys, d[i]))[:2]
        for rank, j in enumerate(order, start=1):
            assert got[(f"b{i}", rank)] == f"b{j}"


def test_equal_rows_give_k_neighbours_each(spark):
    """5,000 equal rows: ties are cut by key, and one row is searched for all of them."""
    from faultline.operators.neighbors import knn_join_pruned, top_k_mask

    keys = np.random.default_rng(0).permutation(5000)
    assert (top_k_mask(np.zeros((3, 5000)), 2, keys).sum(axis=1) == 2).all()
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit(1.0).alias("f0"))
    got = {r["q_key"]: r["b_key"] for r in knn_join_pruned(df.filter("k < 50"), df, "k", ["f0"], 1, True).collect()}
    assert got == {i: (0 if i else 1) for i in range(50)}


def test_pruned_knn_single_cell_and_empty_base(spark):
    from faultline.operators.neighbors import knn_join_pruned

    df = _frame(spark, _points(6, 2, 1))
    assert knn_join_pruned(df, df, "k", ["f0", "f1"], 8, exclude_self=True).count() == 30
    assert knn_join_pruned(df, df.limit(0), "k", ["f0", "f1"], 2).count() == 0


def test_smote_rejects_a_minority_of_k_rows(spark):
    df = resample.with_row_id(_frame(spark, _points(11, 2, 1), ["neg"] * 10 + ["pos"]), "k").drop("k")
    with pytest.raises(ValueError):
        resample.smote_balance(df, "class", ["f0", "f1"], k=5)


def test_imputer_takes_nan_as_missing(spark):
    df = spark.createDataFrame([(0, 1.0), (1, float("nan")), (2, 3.0), (3, None)], "k long, a double")
    model = impute.KNNImputer(2).fit(df, "k", ["a"])
    assert model.means == {"a": 2.0}
    assert [r["a"] for r in model.transform(df).orderBy("k").collect()] == [1.0, 2.0, 3.0, 2.0]


def test_full_width_preprocessor_in_a_default_session(spark):
    """163 features: the plans must stay small."""
    import time

    from faultline.operators.preprocess import Preprocessor
    from faultline.spec import TRUCK_SPEC

    feats = list(TRUCK_SPEC.features)
    x = _points(200, len(feats), 8, missing=0.05)
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)], "k long, " + ", ".join(f"{c} double" for c in feats))
    t = time.time()
    out = Preprocessor().fit(df, "k", feats).transform(df).toPandas()
    assert len(out) == 200 and not out.isna().any().any()
    print("163 columns:", time.time() - t)


def _clusters(n_clusters, each, d, seed, missing=0.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n_clusters, d)) * 200
    x = np.concatenate([c + r.normal(size=(each, d)) for c in centres])
    if missing:
        x[r.random(x.shape) < missing] = np.nan
    return x


def _pruned_pairs(spark, x, block_rows, missing, monkeypatch, group_rows=256):
    """Pairs of blocks compared, and blocks, of a self-search."""
    from faultline.operators import neighbors as nb

    monkeypatch.setattr(nb, "GROUP_ROWS", group_rows)
    feats = [f"f{j}" for j in range(x.shape[1])]
    kept = nb._copies(nb._points(_frame(spark, x), "k", feats), 6).cache()
    if missing:
        s = nb.impute_search(nb._copies(nb._points(_frame(spark, x), "k", feats), 1).cache(), kept, x.shape[1], 3, block_rows, np.nanmean(x, axis=0))
    else:
        s = nb.euclidean_search(kept, kept, x.shape[1], 5, block_rows)
    return s.first.count(), s.first.count() + s.later.count()


@pytest.mark.parametrize("missing", [0.0, 0.05])
def test_far_blocks_are_never_sent(spark, monkeypatch, missing):
    """20 clusters: a block meets few blocks of others, and ten times the rows (in ten times
    the clusters; with missing values in the same ones) cost far less than a hundred times the pairs."""
    d = 10 if missing else 4
    blocks, pairs = _pruned_pairs(spark, _clusters(20, 40, d, 1, missing), 32, missing, monkeypatch)
    print("pairs", blocks, pairs)
    assert blocks >= 12 and pairs < blocks * (800 / 32) / 3  # at least 25 base blocks
    more_blocks, more_pairs = _pruned_pairs(spark, _clusters(20, 400, d, 1, missing) if missing else _clusters(200, 40, d, 1), 32, missing, monkeypatch)
    print("pairs of ten times the rows", more_blocks, more_pairs)
    assert more_blocks > 5 * blocks and more_pairs < (80 if missing else 25) * pairs


def test_pruned_imputer_matches_definition_on_clusters(spark, monkeypatch):
    from faultline.operators import neighbors as nb

    monkeypatch.setattr(nb, "GROUP_ROWS", 64)
    monkeypatch.setattr(nb, "HEADS", 3)  # heads are cut into parts
    x = _clusters(6, 30, 4, 5, missing=0.2)
    x[40:60] = x[40]  # equal rows, with missing values
    feats = [f"f{j}" for j in range(4)]
    model = impute.KNNImputer(4, block_rows=8).fit(_frame(spark, x), "k", feats)
    got = model.transform(_frame(spark, x)).orderBy("k").select(*feats).toPandas().to_numpy()
    assert np.allclose(got, _sk_like_impute(x, x, 4))


def test_pruned_search_of_other_rows_in_small_groups(spark, monkeypatch):
    from faultline.operators import neighbors as nb

    monkeypatch.setattr(nb, "GROUP_ROWS", 32)
    monkeypatch.setattr(nb, "HEADS", 2)
    base, queries = _clusters(5, 40, 3, 6), np.concatenate((_clusters(5, 9, 3, 6), np.zeros((4, 3))))
    base[10:30] = base[10]
    feats = ["f0", "f1", "f2"]
    got = nb.knn_join_pruned(_frame(spark, queries), _frame(spark, base), "k", feats, 4, block_rows=8).collect()
    d = np.sqrt(((queries[:, None, :] - base[None, :, :]) ** 2).sum(-1))
    want = {(i, r): int(j) for i in range(len(queries)) for r, j in enumerate(np.lexsort((np.arange(len(base)), d[i]))[:4], 1)}
    assert {(r["q_key"], r["nn_rank"]): r["b_key"] for r in got} == want


def test_rows_are_sent_once_per_tile_not_once_per_block(spark):
    """32 blocks of 4 rows against each other: 1,024 pairs of blocks, but each row goes to two tiles."""
    import pyarrow as pa

    from faultline.operators import neighbors as nb

    rows = spark.createDataFrame([(i // 4, i, [float(i)]) for i in range(128)], "bid long, key long, x array<double>")
    queries = rows.selectExpr("cast(bid as string) as bid", "bid as b", "key", "x", "cast(1 as double) as ub")
    pairs = spark.range(1024).selectExpr("cast(id div 32 as string) as a", "id % 32 as b")

    def cell(qt, bt):
        return pa.table({"q": [qt.num_rows], "b": [bt.num_rows], "met": [len(set(qt["a"].to_pylist())) * len(set(bt["b"].to_pylist()))]})

    got = nb._compare(pairs, queries, rows, cell, "q long, b long, met long").groupBy().sum().first()
    assert got["sum(met)"] == 1024  # every pair of blocks
    assert got["sum(q)"] <= 2 * 128 and got["sum(b)"] <= 2 * 128  # 4,096 each when sent per pair of blocks


def test_pairs_of_tiles_are_not_put_into_one_task(spark):
    """Four pairs of tiles with few bytes: much work, so they stay in tasks of their own."""
    import pyarrow as pa

    from faultline.operators import neighbors as nb

    rows = spark.createDataFrame([(i // 4, i, [float(i)]) for i in range(128)], "bid long, key long, x array<double>")
    queries = rows.selectExpr("cast(bid as string) as bid", "bid as b", "key", "x", "cast(1 as double) as ub")
    pairs = spark.range(1024).selectExpr("cast(id div 32 as string) as a", "id % 32 as b")

    def cell(qt, bt):
        return pa.table({"q": [qt.num_rows]})

    cells = nb._compare(pairs, queries, rows, cell, "q long")
    assert cells.selectExpr("spark_partition_id() as p").distinct().count() > 1
    assert [nb._tile_bits(n) for n in (1, 7, 8, 31, 32, 1000)] == [0, 0, 1, 2, 3, 4]


def _tile_of(x, **more):
    import pyarrow as pa

    from faultline.operators import neighbors as nb

    return pa.table({"key": np.arange(len(x)), "x": nb._lists(x), **more})


_KINDS = {
    "normal": lambda r, n, d: r.normal(size=(n, d)),
    "ties": lambda r, n, d: r.integers(0, 2, size=(n, d)).astype(float),
    "huge": lambda r, n, d: r.normal(size=(n, d)) * 1e150,
    "tiny": lambda r, n, d: r.normal(size=(n, d)) * 1e-150,
    "offset": lambda r, n, d: r.normal(size=(n, d)) * 1e-6 + 1e6,
    "mixed": lambda r, n, d: r.normal(size=(n, d)) * 10.0 ** r.integers(-30, 30, size=(n, 1)),
    "infinite": lambda r, n, d: np.where(r.random((n, d)) < 0.01, np.inf, r.normal(size=(n, d))),
}


@pytest.mark.parametrize("kind", sorted(_KINDS))
@pytest.mark.parametrize("missing", [0.0, 0.1, 0.7])
def test_tile_comparison_finds_what_all_distances_find(kind, missing):
    """Bounds by a matrix product never lose a neighbour, whatever the scale; distances are those of ``distances``."""
    from faultline.operators import neighbors as nb

    r, n, d, k = np.random.default_rng(4), 300, 6, 3
    x, y = _KINDS[kind](r, n, d), _KINDS[kind](r, n, d)
    if missing:
        x[r.random(x.shape) < missing] = np.nan
        y[r.random(y.shape) < missing] = np.nan
    block = np.arange(n) // 70
    with np.errstate(all="ignore"):
        q, j, b, dist, _ = nb._tile_best(_tile_of(x, near=block, ub=np.full(n, np.inf)), _tile_of(y, b=block), d, k, bool(missing))
        all_of = nb.distances(x, y, True)
        want = set()
        for f in range(d) if missing else [0]:
            rows = np.flatnonzero(np.isnan(x[:, f])) if missing else np.arange(n)
            cols = np.flatnonzero(~np.isnan(y[:, f])) if missing else np.arange(n)
            at, to = np.nonzero(nb.top_k_mask(all_of[np.ix_(rows, cols)], k, cols))
            want |= {(int(rows[i]), f, int(cols[c])) for i, c in zip(at, to)}
    assert set(zip(q.tolist(), j.tolist(), b.tolist())) == want
    assert (dist == all_of[q, b]).all()


@pytest.mark.parametrize("missing", [0.0, 0.06])
def test_few_pairs_are_measured_where_no_block_can_be_ruled_out(missing):
    """64 independent dimensions: less than 2 % of the pairs of two blocks are measured one by one."""
    from faultline.operators import neighbors as nb

    x, y = _points(1000, 64, 1, missing), _points(1000, 64, 2, missing)
    rows, _ = nb._candidates(x, y, np.full(1000, np.inf), 5, bool(missing))
    assert 5000 <= len(rows) < (60_000 if missing else 20_000)


def test_pruned_knn_leaves_incomplete_rows_out(spark):
    from faultline.operators.neighbors import knn_join_pruned

    df = spark.createDataFrame([(0, 1.0, 2.0), (1, None, 2.0), (2, 1.5, float("nan")), (3, 4.0, 4.0)], "k long, f0 double, f1 double")
    got = knn_join_pruned(df, df, "k", ["f0", "f1"], 2, exclude_self=True).collect()
    assert {(r["q_key"], r["b_key"]) for r in got} == {(0, 3), (3, 0)}


@pytest.mark.parametrize("missing", [0.0, 0.06])
def test_two_sided_bounds_hold_some_rows_at_a_time(monkeypatch, missing):
    """1,024 unbounded rows and a block of 2,048: no arrays of doubles as large as all their pairs (16 MB each)."""
    import tracemalloc

    from faultline.operators import neighbors as nb

    x, y, ub = _points(1024, 4, 1, missing), _points(2048, 4, 2, missing), np.full(1024, np.inf)
    tracemalloc.start()
    rows, cols = nb._candidates(x, y, ub, 5, bool(missing))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    monkeypatch.setattr(nb, "RANGED", 1 << 30)
    whole = nb._candidates(x, y, ub, 5, bool(missing))
    assert (rows == whole[0]).all() and (cols == whole[1]).all()


def test_search_and_smote_start_no_second_set_of_python_workers(spark, monkeypatch):
    """A local list made a frame by Python's RDDs starts workers (and a daemon) beside those of the Arrow functions."""
    x = _points(300, 2, 5)
    df = resample.with_row_id(_frame(spark, x, ["pos" if i < 70 else "neg" for i in range(300)]), "k").drop("k").cache()
    assert df.count() == 300
    made, real = [], type(spark).createDataFrame

    def create(self, data, *args, **kwargs):
        made.extend(data)
        return real(self, data, *args, **kwargs)

    monkeypatch.setattr(type(spark), "createDataFrame", create)
    kept = resample.smote_tomek(df, "class", ["f0", "f1"], k=5, seed=0, block_rows=32).count()
    df.unpersist()
    assert 0 < kept < 460 and not made


def _old_and_new(spark, monkeypatch, search):
    """``search()`` with tiles sent by pairs, and with broadcast tiles: 2 rounds or more, some tiles at a time."""
    from faultline.operators import neighbors as nb

    compared, real = [], nb._compare

    def compare(*args):
        compared.append(1)
        return real(*args)

    monkeypatch.setattr(nb, "_compare", compare)
    monkeypatch.setattr(nb, "TILES_MET", 1 << 30)
    by_pairs = search()
    assert len(compared) == 2  # within tiles, then all pairs of tiles
    monkeypatch.undo()
    compared.clear()
    monkeypatch.setattr(nb, "_compare", compare)
    monkeypatch.setattr(nb, "COLLECT_BYTES", 20_000)
    monkeypatch.setattr(nb, "ROUND_BYTES", 60_000)
    everywhere = search()
    assert len(compared) == 1  # no rows are sent for the pairs of tiles
    return by_pairs, everywhere


@pytest.mark.parametrize("keys", ["number", "text"])
def test_tiles_that_meet_many_are_broadcast_instead_of_shuffled(spark, monkeypatch, keys):
    """Independent dimensions: every pair of tiles is compared, so rows sent by pairs would grow with the square."""
    from faultline.operators.neighbors import knn_join, knn_join_pruned

    x = _points(400, 24, 7)
    x[30:40], x[200:204] = x[30], x[5]  # ties
    feats = [f"f{i}" for i in range(24)]
    df = _frame(spark, x)
    df = df.withColumn("k", F.col("k").cast("string")) if keys == "text" else df

    def search():
        got = knn_join_pruned(df, df, "k", feats, 3, exclude_self=True, block_rows=8).collect()
        return {(r["q_key"], r["nn_rank"]): (r["b_key"], r["distance"]) for r in got}

    by_pairs, everywhere = _old_and_new(spark, monkeypatch, search)
    want = knn_join(df, df, "k", feats, 3, exclude_self=True).collect()
    assert everywhere == by_pairs and len(everywhere) == 1200
    assert {k: v[0] for k, v in everywhere.items()} == {(r["q_key"], r["nn_rank"]): r["b_key"] for r in want}


def test_broadcast_tiles_serve_other_rows_and_repeated_keys(spark, monkeypatch):
    from faultline.operators.neighbors import knn_join_pruned

    x, q = _points(300, 24, 7), _points(70, 24, 8)
    feats = [f"f{i}" for i in range(24)]
    base, asking = _frame(spark, x).withColumn("k", F.floor(F.col("k") / 2)), _frame(spark, q)

    def search():
        return sorted(knn_join_pruned(asking, base, "k", feats, 3, block_rows=8).select("q_key", "b_key", "distance").collect())

    by_pairs, everywhere = _old_and_new(spark, monkeypatch, search)
    assert everywhere == by_pairs and len(everywhere) == 210


def test_query_tiles_are_not_split_by_bounds(spark):
    """Parts of a block (bounds of 2^-6 and 2^-5) are of one tile: base rows were sent to each of them."""
    from faultline.operators import neighbors as nb

    df = spark.createDataFrame([("35~-6",), ("35~-5",), ("36~1",), ("36-2~-5",)], "a string")
    assert [r[0] for r in df.select(nb._query_tile("a", 4)).collect()] == ["2-", "2-", "2-", "2-2"]


def test_broadcast_tiles_serve_missing_values(spark, monkeypatch):
    x = _points(260, 12, 9, missing=0.1)
    x[30:36] = x[30]
    feats = [f"f{i}" for i in range(12)]
    df = _frame(spark, x)
    model = impute.KNNImputer(4, block_rows=8).fit(df, "k", feats)

    def search():
        return model.transform(df).orderBy("k").select(*feats).toPandas().to_numpy()

    by_pairs, everywhere = _old_and_new(spark, monkeypatch, search)
    assert (by_pairs == everywhere).all()
    assert np.allclose(everywhere, _sk_like_impute(x, x, 4))


def test_imputed_rows_read_twice_are_searched_once(spark):
    """The result holds values that are written: reading it again compares no rows again."""
    x = _points(120, 4, 3, missing=0.2)
    df, feats = _frame(spark, x), [f"f{i}" for i in range(4)]
    out = impute.KNNImputer(3, block_rows=16).fit(df, "k", feats).transform(df)
    plan = out._jdf.queryExecution().toString()
    assert "FlatMapCoGroups" not in plan and "first-found" not in plan
    assert np.allclose(out.orderBy("k").select(*feats).toPandas().to_numpy(), _sk_like_impute(x, x, 3))


@pytest.mark.parametrize("missing", [0.0, 0.06])
def test_rows_with_a_bound_are_measured_against_few_others(missing):
    """Bounded rows before a tile: all pairs within their bounds are found, and few besides."""
    import pyarrow as pa

    from faultline.operators import neighbors as nb

    x, y = _points(200, 64, 1, missing), _points(1000, 64, 2, missing)
    dist = nb.distances(x, y, True)
    ub = np.sort(dist, axis=1)[:, 4]
    facing = nb._Facing(nb._Tile(np.arange(1000) // 300, pa.array(np.arange(1000)), y, bool(missing)), x)
    facing.limit(ub)
    rows, cols = facing.within(np.arange(200), slice(0, 1000))
    assert {*zip(*(v.tolist() for v in np.nonzero(dist <= ub[:, None])))} <= {*zip(rows.tolist(), cols.tolist())}
    assert 1000 <= len(rows) < 1010
