import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from faultline.llm import spelling as sp


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=2):
    out = []
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        form = min(others, key=lambda x: (-counts[x], x), default=None)
        out.append([w, form if form and counts[form] >= ratio * n else None, None, n, len(others), None])
    forms = {r[0]: r[1] for r in out}
    for r in out:
        root = r[0]
        while forms[root]:
            root = forms[root]
        r[2], r[5] = root, counts[r[1]] if r[1] else None
    return sorted(map(tuple, out))


def brute_counts(rows, modulus=None, min_length=5, min_count=3):
    n = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{i}:{w}".encode())
            if modulus and i is not None and h % modulus == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}


def dense_words(seed, size=300, alphabet="abé"):
    r = random.Random(seed)
    words = {"".join(r.choice(alphabet) for _ in range(r.randint(5, 9))) for _ in range(size)}
    words |= {"a" * k for k in range(5, 12)} | {"b" + "a" * k for k in range(4, 9)}
    return {w: r.choice([3, 3, 4, 6, 12, 25, 60, 200]) for w in words}


def test_composition_matches_brute_force():
    words = sorted(dense_words(1))
    sets = {w: i % 3 for i, w in enumerate(words)}
    rows = sorted((sets[w], w) for w in words)
    cells = np.zeros((len(rows), 12), dtype=np.uint32)
    for i, (_, w) in enumerate(rows):
        cells[i, : len(w)] = [ord(c) for c in w]
    of = np.array([s for s, _ in rows])
    a, b = sp.one_edit_pairs(cells, of, np.full(3, 99))
    got = [(rows[i][1], rows[j][1]) for i, j in zip(a, b)]
    assert len(got) == len(set(got))  # each pair once
    want = {frozenset((v, w)) for s, v in rows for t, w in rows if s == t and near(v, w)}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_automaton_is_minimal_and_numbers_its_words():
    words = ["tap", "taps", "top", "tops"]
    cells = np.zeros((4, 4), dtype=np.uint32)
    for i, w in enumerate(words):
        cells[i, : len(w)] = [ord(c) for c in w]
    m = sp.Acceptor(cells, np.zeros(4, np.int64))
    assert len(m.final) == 5 and len(m.source) == 5  # t, {a, o}, p, s: equal endings are one state
    for i, w in enumerate(words):
        state, row = m.initial, m.base.copy()
        for c in w:
            arc = m.follow(state, np.array([ord(c)]))
            assert arc[0] >= 0
            state, row = m.target[arc], row + m.skip[arc]
        assert m.final[state[0]] and row[0] == i
    assert m.follow(m.initial, np.array([ord("x")]))[0] == -1


@pytest.mark.parametrize("part_words", [1 << 14, 40, 4])
def test_variants_match_brute_force_whatever_the_part_size(spark, part_words):
    counts = dense_words(2)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((tuple(r) for r in sp.variants(df, part_words=part_words).collect()))
    assert got == brute_variants(counts)


def test_a_common_beginning_is_split(spark):
    # A third of all words begin alike and end alike; splitting goes down to one place.
    counts = {f"inter{a}{b}tion": 3 + (i * 7 + j) % 50 for i, a in enumerate("abcdefghij") for j, b in enumerate("abcdefghij")}
    counts |= {f"{a}{b}xyzw": 5 for a in "klmn" for b in "klmn"}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert len(sp.parts(df, part_words=20)) > 1
    assert sorted(tuple(r) for r in sp.variants(df, part_words=20).collect()) == brute_variants(counts)


def test_words_of_the_whole_text_with_slips(spark):
    r = random.Random(5)
    pool = ["Hello", "héllo", "HELLO", "worlds", "it's", "naïve×ment", "Œuvre", "abcde中fghij", "x", "ÉtésÉ", "12ab_cdefg"]
    rows = [(i, " ".join(r.choice(pool) for _ in range(60))) for i in range(200)] + [(None, "Hello worlds"), (3, None), (4, ""), (5, "1 2")]
    rows += [(900, "hello " * 60_000)] * 2
    df = spark.createDataFrame([(*x, "n") for x in rows], "doc_id long, text string, n string")
    for modulus in (None, 7, 97):
        got = {r.word: r.n for r in sp.count_words(df, slip_modulus=modulus).collect()}
        assert got == brute_counts(rows, modulus)


def test_short_words_long_words_and_empty_table(spark):
    long = "q" * 3_000
    counts = {"a": 3, "b": 9, "ab": 20, "c": 3, long: 3, long + "r": 6, "r" + long: 6}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in sp.variants(df).collect()) == brute_variants(counts)
    assert sp.variants(df.limit(0)).count() == 0
    assert sp.count_words(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_roots_follow_long_chains(spark):
    # The form of each word has twice its n: aaaaaaa <- aaaaaab <- aaaaabb ...
    words = ["a" * (12 - k) + "b" * k for k in range(13)]
    counts = {w: 3 * 2 ** (12 - k) for k, w in enumerate(words)}
    got = {r.word: r.root for r in sp.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got == dict.fromkeys(words, "a" * 12)
