import math
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from faultline.llm import quality
from faultline.llm.queries import graded_labels, held_out
from tests.conftest import SF_CHECK

SCHEMA = "doc_id long, text string, grade int, tail_prob string"


def test_held_out_grades(spark):
    docs = spark.read.parquet(f"{SF_CHECK.replace('0.01', '0.1')}/documents.parquet")
    labels = graded_labels(spark.read.parquet(f"{SF_CHECK.replace('0.01', '0.1')}/labels.parquet"))
    model = quality.fit(docs, labels.filter(~held_out(F.col("doc_id"))), n_grades=3)
    assert (np.diff(model.thresholds) > 0).all()
    scored = quality.score(docs, model, keep_from=2).join(labels.filter(held_out(F.col("doc_id"))), "doc_id").toPandas()
    good = scored["grade"] == 2
    assert (scored["kept"] == good).mean() > 0.93
    assert scored.loc[good, "kept"].mean() > 0.97
    assert scored.loc[scored["grade"] == 0, "kept"].mean() < 0.35
    expected = scored.groupby("grade")["expected_grade"].mean()
    assert expected[2] > 1.8 and expected[0] < 1.3 and expected[1] < 1.3


def test_edge_cases(spark):
    text = ["good words here"] * 30 + ["bad words *** there"] * 30
    rows = [(i, t, 2 if t[0] == "g" else 0, "x") for i, t in enumerate(text)]
    docs = spark.createDataFrame(rows + [(None, "good", None, ""), (90, None, None, ""), (91, "", None, ""), (0, "good words here", None, "")], SCHEMA)
    ratings = spark.createDataFrame([(i, g) for i, _, g, _ in rows] + [(None, 1), (500, 1), (3, None)], "doc_id long, grade int")
    model = quality.fit(docs, ratings, n_grades=3)
    got = quality.score(docs, model, keep_from=2).collect()
    assert len(got) == 64
    by = {r.doc_id: r for r in got}
    assert by[0].kept and not by[43].kept and by[0].expected_grade > by[90].expected_grade > by[43].expected_grade
    assert by[90].tail_prob == pytest.approx(by[91].tail_prob)
    assert quality.score(docs.limit(0), model, 2).count() == 0
    none = quality.fit(docs, ratings.limit(0), n_grades=3)
    assert none is None and all(r.kept and r.tail_prob is None for r in quality.score(docs, none, 2).collect())


def test_gradient_reaches_the_likelihood_optimum():
    r = np.random.default_rng(1)
    grades = r.integers(0, 3, 300)
    docs = [np.array([0]) for _ in grades]  # one feature in all: thresholds must reproduce the grades' shares
    m = quality.fit_ordinal(docs, grades, 3, steps=2000)
    tails = m.tails(m.linear(np.arange(300), np.zeros(300, np.int64), 300))[0]
    assert tails == pytest.approx([(grades >= 1).mean(), (grades >= 2).mean()], abs=0.01)


ODD = [
    None, "", " \t\n", "Plain words, plain words", "SHOUTING SHOUTING at you", "(quoted)  \"text\" 12,50$ ... --", "a A Aa AA aA", "\u00c9T\u00c9 \u00e9t\u00e9 \u4f60\u597d",
    "x" * 5000 + " tail", "same " * 4000, "12ab34 [[[[[[[[[[[[[[[[[[[[[[deep", "line\x0bfeed\x0cpage\u00a0joined", "same same", "same same",
]


def _place(mark):
    return xxhash.xxh32(mark.encode()).intdigest() >> (32 - quality.HASH_BITS)


def _brute_places(text):
    """One text's marks, word by word."""
    words = (text or "").split()  # any white space
    out, caps, other, repeat = set(), 0, 0, 0
    for i, w in enumerate(words):
        lead = 0
        while lead < len(w) and (not w[lead].isalnum() or w[lead] == "_" or w[lead].isdigit()):
            lead += 1
        end = len(w)
        while end > lead and (not w[end - 1].isalnum() or w[end - 1] == "_" or w[end - 1].isdigit()):
            end -= 1
        core = w[lead:end]
        if core:
            out.add("w:" + core.lower())
        if w[:lead]:
            out.add("a:" + re.sub(r"\d", "0", w[:lead])[:16])
        if w[end:]:
            out.add("z:" + re.sub(r"\d", "0", w[end:])[:16])
        if len(core) > 1 and core.isupper():
            out.add("caps")
        caps += len(w) > 1 and w.isupper()
        other += not w.rstrip(".,").isalpha()
        repeat += i > 0 and words[i - 1] == w
    for kind, n in (("caps", caps), ("other", other), ("repeat", repeat)):
        out |= {f"{kind}>={least}" for least in quality.SHARES if n / max(len(words), 1) >= least}
    return {_place(m) for m in out}


def test_features_equal_word_by_word_marks():
    doc, place = quality.features(pa.array(ODD, pa.string()))
    for i, text in enumerate(ODD):
        assert set(place[doc == i].tolist()) == _brute_places(text), text and text[:40]
    assert len(set(zip(doc.tolist(), place.tolist()))) == len(doc)


def test_scores_equal_brute_force_with_ties_and_clashing_columns(spark):
    places = sorted(set().union(*map(_brute_places, ODD)))[::2]
    weights = [((i * 7919) % 41 - 20) / 16 for i in range(len(places))]
    model = quality.OrdinalModel(np.array(places), np.array(weights), np.array([0.0, 1.25]))
    at = dict(zip(places, weights))
    rows = [(i % 11, t, i, "clash") for i, t in enumerate(ODD)]  # ids repeat
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for keep_from in (1, 2):
        want = []
        for i, t, *_ in rows:
            eta = sum(at.get(p, 0.0) for p in _brute_places(t))
            tails = [1 / (1 + math.exp(-max(-40, min(40, eta - cut)))) for cut in (0.0, 1.25)]
            want.append((i, round(sum(tails), 9), round(tails[keep_from - 1], 9), tails[keep_from - 1] >= 0.5))
        got = quality.score(docs, model, keep_from).collect()
        assert sorted((r.doc_id, round(r.expected_grade, 9), round(r.tail_prob, 9), r.kept) for r in got) == sorted(want)
    blank = next(r for r in quality.score(docs.filter("text is null"), model, 1).collect())
    assert blank.tail_prob == 0.5 and blank.kept  # a tie at keep_at stays


def test_fit_is_a_minimum_of_the_penalised_likelihood():
    r = np.random.default_rng(8)
    docs = [np.flatnonzero(r.random(6) < 0.5) for _ in range(400)]
    grades = np.clip([int(1 + (3 in d) - (1 in d) + r.integers(-1, 2)) for d in docs], 0, 2)
    l2 = 0.02
    m = quality.fit_ordinal(docs, grades, 3, l2=l2, steps=3000)

    def loss(weights, cuts):
        total = 0.0
        for d, g in zip(docs, grades):
            eta = sum(weights[list(m.places).index(p)] for p in d)
            tail = [1.0, *[1 / (1 + math.exp(c - eta)) for c in cuts], 0.0]
            total -= math.log(tail[g] - tail[g + 1])
        return total / len(docs) + l2 / 200 * sum(w * w for w in weights)

    best = loss(m.weights, m.thresholds)
    for i in range(len(m.weights) + 2):
        for step in (-0.05, 0.05):
            w, c = m.weights.copy(), m.thresholds.copy()
            (w if i < len(w) else c)[i if i < len(w) else i - len(w)] += step
            assert loss(w, c) > best - 1e-6
