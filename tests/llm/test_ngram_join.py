import random
from math import comb

import numpy as np
import pyarrow as pa
import pytest

from faultline.llm import ngram_join as nj

SCHEMA = "doc_id long, text string, row long, comp string"  # extra columns clash with working names


def _sets(text):
    w = (text or "").split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def _brute(rows):
    sets = [_sets(t) for _, t in rows]
    n = len(rows)
    label, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    ids = {}
    for i in range(n):
        ids.setdefault(label[i], []).append(rows[i][0])
    return sorted((rows[i][0], min(ids[label[i]]), links[i], len(ids[label[i]])) for i in range(n))


def _corpus():
    r = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(12):
        base = r.choices(vocab, k=r.choice([4, 7, 40, 120, 300]))
        for _ in range(r.choice([1, 2, 5, 30])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                words[r.randrange(len(words))] = r.choice(vocab)
            rows.append((k, " ".join(words)))
            k += 1
    passage = " ".join(r.choices(vocab, k=30))
    rows += [(k + i, passage + " " + " ".join(r.choices(vocab, k=60))) for i in range(20)]
    return rows + [(1000, None), (1001, ""), (1002, " \n "), (1003, "one"), (1004, "one"), (1005, "one two")]


@pytest.mark.parametrize("small_blocks", [False, True])
def test_classes_and_links_match_brute_force(spark, monkeypatch, small_blocks):
    if small_blocks:  # large buckets and components are cut into pairs of blocks
        monkeypatch.setattr(nj, "BUCKET_BLOCK", 4)
        monkeypatch.setattr(nj, "VERIFY_BLOCK", 4)
    rows = _corpus()
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in rows], SCHEMA)
    got = sorted(tuple(r) for r in nj.similarity_join(docs).collect())
    assert got == _brute(rows)


def test_keep_one_keeps_smallest_id_and_columns(spark):
    rows = _corpus()
    docs = spark.createDataFrame([(i, t, i * 2, "x") for i, t in rows], SCHEMA)
    kept = nj.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for _, c, _, _ in _brute(rows)}
    got = kept.collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    texts = dict(rows)
    assert all(r.text == texts[r.doc_id] and r.row == 2 * r.doc_id for r in got)


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "a b c d e f g"
    docs = spark.createDataFrame([(1, t, 0, ""), (1, t, 0, ""), (None, t, 0, ""), (2, "x y z", 0, "")], SCHEMA)
    got = sorted((tuple(r) for r in nj.similarity_join(docs).collect()), key=repr)
    assert got == sorted([(1, 1, 2, 3), (1, 1, 2, 3), (None, 1, 2, 3), (2, 2, 0, 1)], key=repr)
    assert sorted((r.doc_id for r in nj.keep_one(docs).collect())) == [1, 2]
    assert nj.similarity_join(docs.limit(0)).count() == 0
    assert nj.keep_one(docs.limit(0)).count() == 0


def test_pruning_bounds_keep_pairs_at_the_threshold():
    need = nj.min_matches()
    assert len(need) == len(nj.STEPS) and need == sorted(need)
    assert need[-1] < 0.75 * nj.HASHES  # far below the expected 103 of 128 matches at 0.8
    assert need[-1] > 0.5 * nj.HASHES  # and unrelated pairs are dropped


def test_ngram_sets_of_short_texts():
    sets = nj.ngram_sets(pa.array(["a b", "a  b", "a b c d e", None, "", "b a"]))
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 1]
    assert sets[0][0] == sets[1][0] != sets[5][0]


def test_pruning_loses_less_than_the_bands():
    """Exact loss of a pair at the threshold: matches after each step are binomial."""
    p = nj.THRESHOLD + (1 - nj.THRESHOLD) / 256
    alive, done, lost = np.ones(1), 0, 0.0
    for upto, least in zip(nj.STEPS, nj.min_matches()):
        k = upto - done
        alive = np.convolve(alive, [comb(k, i) * p**i * (1 - p) ** (k - i) for i in range(k + 1)])
        lost += alive[:least].sum()
        alive[:least], done = 0, upto
    assert lost < (1 - nj.THRESHOLD**nj.BAND_ROWS) ** nj.BANDS


def _large_group(spark, n, seed=3):
    """Representatives of ``n`` near copies of one text, a word of each replaced."""
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(n):
        words = np.arange(200, dtype=np.uint64)
        words[r.integers(200)] = r.integers(1000, 2**40)
        sets.append(np.unique(nj.ngram_hashes(words, np.zeros(200, np.int64), 5)[0]))
    values = nj.minhashes(sets)
    sig, bands = (values & np.uint32(255)).astype(np.uint8), nj.band_keys(values)
    rows = [(i, bytearray(sig[i].tobytes()), bands[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "row long, sig binary, bands array<long>")


def test_a_large_group_sends_few_edges_per_member(spark):
    """Linear in the group, whatever the number of blocks its buckets are cut into."""
    reps = _large_group(spark, 10_000)
    edges = nj.candidate_edges(reps)
    assert edges.count() < 8 * 10_000
    assert {r.comp for r in nj.components(edges).collect()} == {0}


def test_blocks_do_not_make_the_edges_of_a_group_grow(spark, monkeypatch):
    monkeypatch.setattr(nj, "BUCKET_BLOCK", 64)
    per_member = []
    for n in (600, 1200):
        edges = nj.candidate_edges(_large_group(spark, n))
        assert {r.comp for r in nj.components(edges).collect()} == {0}
        per_member.append(edges.count() / n)
    assert max(per_member) < 10 and per_member[1] < 1.3 * per_member[0]


def test_components_of_stars_chains_and_nothing(spark):
    r = random.Random(4)
    chain = list(range(100, 400))
    star = [(1000, 1000 + i) for i in range(1, 300)]
    mixed = chain[:]
    r.shuffle(mixed)
    edges = list(zip(chain, chain[1:])) + star + [(b + 5000, a + 5000) for a, b in zip(mixed, mixed[1:])] + [(7, 7)]
    got = {x.row: x.comp for x in nj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = dict.fromkeys(chain, 100) | dict.fromkeys(range(1000, 1300), 1000) | {c + 5000: 5100 for c in chain}
    assert got == want
    assert nj.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_are_written_by_few_tasks(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        labels = nj.components(spark.createDataFrame([(i, i + 1) for i in range(0, 1000, 2)], "a long, b long"))
        assert {(r.row, r.comp) for r in labels.collect()} == {(i, i - i % 2) for i in range(1000)}
        assert len(labels.inputFiles()) <= nj.EDGE_TASKS
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_long_texts_and_ties(spark):
    r = random.Random(9)
    long = [f"w{r.randrange(3000)}" for _ in range(60_000)]
    near = long[:]
    for k in range(0, 60_000, 150):
        near[k] = "changed"
    five = [["a", "b", "c", "d", "e", "f", "g", "h", str(i)] for i in (1, 2)]  # 4 of 6 n-grams in common
    rows = [(5, " ".join(long)), (4, " ".join(near)), (3, " ".join(long)), (2, "x " * 50_000), (1, "x " * 40_000)]
    rows += [(10 + i, " ".join(w)) for i, w in enumerate(five)]
    got = sorted(tuple(r) for r in nj.similarity_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == _brute(rows)
