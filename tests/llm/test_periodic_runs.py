import hashlib
import random
import re
import zlib

import pyarrow as pa

from faultline.llm import periodic_runs as pr
from faultline.llm.queries import op12_periodic_runs
from tests.conftest import SF_SMALL


def brute_runs(words, min_length=24, min_exponent=3):
    """Every maximal stretch of every lag, kept if no smaller lag is a period of it."""
    out, n = [], len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(min_length, min_exponent * q):
                x = words[start : start + length]
                if not any(x[d:] == x[:-d] for d in range(1, q)):
                    out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    drop = {i for s, ln, q in runs for i in range(s + q, s + ln)}
    listed = "".join(f"{s},{ln},{q}\n" for s, ln, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha(listed), sha(kept))


def random_words(r):
    words = []
    while len(words) < r.choice([0, 10, 60, 300, 600]):
        if r.random() < 0.3:
            words += [r.choice("abcdefgh") for _ in range(r.randint(1, 30))]
        else:
            base = [r.choice("ab" if r.random() < 0.5 else "abcdefg") for _ in range(r.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 32, 33, 64, 65]))]
            if r.random() < 0.3:
                base = base[:3] * 7 + base
            words += (base * 8)[: int(len(base) * r.choice([1.5, 2.9, 3, 3.2, 4, 6]))]
    return words


def test_runs_match_brute_force_on_random_words():
    r = random.Random(11)
    texts = [random_words(r) for _ in range(500)]
    codes, edges = pr._codes(pa.array([" ".join(t) for t in texts]))
    got = pr.find_runs(codes, edges)
    want = {i: b for i, t in enumerate(texts) if (b := brute_runs(t))}
    assert got == want
    assert sum(map(len, want.values())) > 400 and max(q for b in want.values() for *_, q in b) > 64


def test_other_limits_match_brute_force():
    r = random.Random(12)
    texts = [random_words(r) for _ in range(150)]
    codes, edges = pr._codes(pa.array([" ".join(t) for t in texts]))
    for limits in ((6, 3), (40, 4), (3, 3)):
        assert pr.find_runs(codes, edges, *limits) == {i: b for i, t in enumerate(texts) if (b := brute_runs(t, *limits))}


def test_guaranteed_overlap_is_sixteen_words():
    assert pr.guaranteed_overlap() == 16


def test_very_repetitive_text_is_one_run_and_few_extensions(monkeypatch):
    calls = []
    ahead = pr._match_ahead
    monkeypatch.setattr(pr, "_match_ahead", lambda *a: calls.append(1) or ahead(*a))
    codes, edges = pr._codes(pa.array(["a " * 200_000, None, "", "b c " * 50_000 + "d"]))
    assert pr.find_runs(codes, edges) == {0: [(0, 200_000, 1)], 3: [(0, 100_000, 2)]}
    assert len(calls) < 50  # one for each diagonal and level, not for each word


def test_texts_do_not_run_into_one_another():
    codes, edges = pr._codes(pa.array(["x y " * 6, "x y " * 6, "x y " * 12]))
    assert pr.find_runs(codes, edges) == {2: [(0, 24, 2)]}


def test_ties_for_the_strongest_run():
    assert pr.strongest([(50, 60, 20), (10, 24, 8), (10, 30, 10)]) == (10, 24, 8)
    assert pr.strongest([(0, 30, 10), (90, 31, 10)]) == (90, 31, 10)


def test_operator_on_nulls_repeats_empty_table_and_clashing_columns(spark):
    loop = "u v w " * 10
    rows = [(1, "p q " + loop + "z", "a"), (1, "p q " + loop + "z", "a"), (None, None, "b"), (3, " \t\n", "c"), (4, "k l " * 30, "d")]
    df = spark.createDataFrame(rows, "runs long, text string, n_words string")
    out = pr.runs(df, id_col="runs", with_collapsed=True)
    assert out.columns == ["runs", "n_words", "_runs", "collapsed"]
    got = [(r.runs, r.n_words, [tuple(x) for x in r["_runs"]], r.collapsed) for r in out.collect()]
    assert got == [
        (1, 33, [(2, 30, 3)], "p q u v w z"), (1, 33, [(2, 30, 3)], "p q u v w z"),
        (None, 0, [], ""), (3, 0, [], ""), (4, 30, [(0, 30, 1)], "k l"),
    ]
    assert pr.runs(df.limit(0), id_col="runs").count() == 0 and pr.summarize(df.limit(0), id_col="runs").count() == 0


def test_long_text_and_overlapping_runs(spark):
    r = random.Random(3)
    texts = [" ".join(str(r.random()) for _ in range(60_000)) + " e f" * 40, "a b a b a b " * 8 + "a b c " * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    long, short = sorted(map(tuple, pr.summarize(df).collect()))
    assert short[1:] == brute_row(None, texts[1])[1:] and short[1] > 1
    assert long[:6] == (0, 1, 60_000, 80, 2, 40_000)


def test_query_matches_brute_force_on_every_document(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op12_periodic_runs(spark, SF_SMALL).collect())
    assert got == sorted(brute_row(r.doc_id, r.text) for r in docs)
    assert sum(r[1] for r in got) > 10


def test_planted_loops(spark):
    rows = [(i, "a b\tc  d e f g h i j k l m n o p") for i in range(60)] + [(i, None) for i in range(60)] + [(None, "x"), (61, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    out = df.select("doc_id", "text", pr.planted(F.col("doc_id"), F.col("text")).alias("new")).collect()
    for r in out:
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 or not (r.text or "").split():
            assert r.new == r.text
        else:
            w, g = r.text.split(), h // 10
            a, p = g % 16, 1 + (16 - g % 16) // (3 + g % 8)
            assert r.new.split(" ") == [w[i] if i < a else w[a + (i - a) % p] for i in range(16)]
    assert any(r.new != r.text for r in out)
