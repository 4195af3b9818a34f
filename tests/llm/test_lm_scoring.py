import math
import random
from collections import Counter

import numpy as np
import pytest

from faultline.llm import lm_scoring as lm

SCHEMA = "doc_id long, text string, block long, ids string"


def _brute(rows):
    uni, bi, n = Counter(), Counter(), 0
    for _, t in rows:
        w = (t or "").split()
        uni.update(w)
        bi.update(zip(w, w[1:]))
        n += len(w)
    out = {}
    for i, t in rows:
        w = (t or "").split()
        u, b = Counter(w), Counter(zip(w, w[1:]))
        rest, total = max(n - len(w), 1), 0.0
        for k, x in enumerate(w):
            cx = uni[x] - u[x]
            pair = (w[k - 1], x)
            if k and bi[pair] - b[pair] > 0:
                total += math.log((bi[pair] - b[pair]) / (uni[w[k - 1]] - u[w[k - 1]]))
            elif cx > 0:
                total += math.log(cx / rest * (lm.ALPHA if k else 1))
            else:
                total += math.log(lm.ALPHA**2 / rest)
        out[i] = (len(w), total)
    return out


@pytest.mark.parametrize("block_bytes, range_bytes", [(1 << 20, 1 << 20), (400, 300)])
def test_scores_match_brute_force(spark, block_bytes, range_bytes):
    r = random.Random(3)
    vocab = [f"wö{i}" for i in range(60)]
    rows = [(i, " ".join(r.choices(vocab, k=r.choice([1, 2, 30, 200])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "nowhere else"), (103, rows[5][1]), (104, "the the the the")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3)
    got = {x.doc_id: x for x in lm.score(docs, block_bytes=block_bytes, range_bytes=range_bytes).collect()}
    want = _brute(rows)
    assert got.keys() == want.keys()
    for i, (n, total) in want.items():
        assert got[i].n_words == n
        assert got[i].log_prob == pytest.approx(total, abs=1e-9)
        assert got[i].mean_log_prob == (pytest.approx(total / n) if n else None)


def test_repeated_ids_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", 0, ""), (1, "a b", 0, ""), (None, "c", 0, "")], SCHEMA)
    got = lm.score(docs).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == [("1", 2), ("1", 2), ("None", 1)]
    assert lm.score(docs.limit(0)).count() == 0


def test_packed_arrays_round_trip():
    for a in (np.arange(0, dtype=np.uint64), np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64)):
        assert (lm._stretch(lm._squeeze(a), np.uint64) == a).all()
