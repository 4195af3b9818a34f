import random

import numpy as np
from pyspark.sql import functions as F

from faultline.llm import language_id as li
from faultline.llm.queries import held_out, op10_language_id
from tests.conftest import SF_CHECK


def _brute_phrases(symbols, known):
    """Greedy longest matches against ``known`` (a list of symbol strings), in blocks."""
    n = 0
    for a in range(0, len(symbols), li.BLOCK):
        block, i = symbols[a : a + li.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j <= len(block) and any(block[i:j] in k for k in known):
                j += 1
            i = max(j - 1, i + 1)
            n += 1
    return n


def _norm(text):
    out = "".join(c if c.isalpha() else " " for c in text.lower())
    while "  " in out:
        out = out.replace("  ", " ")
    return out


def test_phrases_match_brute_force():
    r = random.Random(1)
    make = lambda alphabet, n: "".join(r.choices(alphabet, k=n))
    samples = {"xx": [make("abc ", 300), make("abd ", 200)], "yy": [make("aef ", 400)]}
    model = li.Model(samples).build()
    texts = [make("abcdef  .!", r.choice([1, 5, 60, 1300])) for _ in range(25)] + ["ZZZ", "", None, "12 !", "é", "a"]
    phrases, sizes = model.phrases(texts)
    for t, got, size in zip(texts, phrases, sizes):
        norm = _norm(t or "")
        if not any(map(str.isalpha, t or "")):
            assert size == 0 and not got.any()
            continue
        assert size == len(norm)
        # letters outside the sample never match; a match never crosses the end of a sample text
        known = {lang: [_norm(s) for s in samples[lang]] for lang in samples}
        assert got.tolist() == [_brute_phrases(norm, known["xx"]), _brute_phrases(norm, known["yy"])]


def test_every_letter_counts():
    """Hundreds of letters: phrases as by brute force, and every script keeps its language."""
    r = random.Random(2)
    scripts = {"el": (0x3B1, 17), "ja": (0x3042, 80), "ru": (0x430, 32), "xa": (0x4E00, 300), "xb": (0x5000, 300), "xc": (0x20000, 150)}
    alphabet = {lang: [chr(a + i) for i in range(n)] for lang, (a, n) in scripts.items()}
    alphabet["en"] = list("abcdefghijklmnopqrstuvwxyz")
    vocab = {lang: ["".join(r.choices(letters, k=r.randint(1, 4))) for _ in range(80)] for lang, letters in alphabet.items()}
    make = lambda lang, n: " ".join(r.choices(vocab[lang], k=n))
    samples = {lang: [make(lang, 150 if lang == "en" else 250) for _ in range(2)] for lang in vocab}
    model = li.Model(samples).build()
    texts = {lang: [make(lang, 30) for _ in range(3)] for lang in vocab}
    phrases, _ = model.phrases([t for ts in texts.values() for t in ts])
    known = [[_norm(s) for s in samples[lang]] for lang in model.languages]
    want = [[_brute_phrases(_norm(t), k) for k in known] for ts in texts.values() for t in ts]
    assert phrases.tolist() == want
    for lang, ts in texts.items():
        assert model.predict(ts)[0] == [lang] * 3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = op10_language_id(spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    unseen = got[got["held_out"]]
    assert (unseen["lang"] == unseen["lang_pred"]).mean() > 0.98


def test_training_rows_exclude_the_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter(F.col("lang").isNotNull())
    model = li.fit(docs, train=~held_out(F.col("doc_id")))
    seen = {t for ts in model.samples.values() for t in ts}
    trainable = {r.text for r in docs.filter(~held_out(F.col("doc_id"))).collect()}
    assert seen and seen <= trainable
    assert all(sum(map(len, ts)) <= li.SAMPLE_CHARS + li.MAX_CHARS for ts in model.samples.values())


def test_edge_cases(spark):
    rows = [(1, "der hund und die katze " * 20, "de", 0.0), (2, "the dog and the cat " * 20, "en", 0.0), (3, None, "en", 0.0),
            (4, "", None, 0.0), (5, " 12 ?! ", "de", 0.0), (None, "the cat and the dog", None, 0.0), (2, "the dog", "en", 0.0),
            (7, "hund " * 40_000, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = li.fit(docs)
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in li.predict(docs, model).collect()))
    assert got == [(0, "en"), (1, "de"), (2, "en"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (7, "de")]
    kept = li.keep_determined(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 2, 7]
    assert li.predict(docs.limit(0), model).count() == 0
    none = li.fit(docs.limit(0))
    assert none.samples == {} and {(r.lang_pred, r.score) for r in li.predict(docs, none).collect()} == {("und", 0.0)}


def _texts(seed, lang, n, words):
    r = random.Random(f"{seed}{lang}")
    vocab = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 8))) for _ in range(200)]
    return [" ".join(r.choices(vocab, k=words)) for _ in range(n)]


def test_labelled_texts_of_any_length(spark):
    """Titles and books are learned alike; a few letters of label do not win; no letter is no sample."""
    kinds = {"title": (400, 6), "page": (40, 120), "book": (6, 3000)}
    rows = [(lang, t) for lang, (n, words) in kinds.items() for t in _texts(0, lang, n, words)]
    rows += [("tiny", "abc"), ("none", " 12 !"), ("none", None)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = li.fit(docs, sample_chars=10_000)
    assert model.languages == ["book", "page", "tiny", "title"]
    assert all(sum(map(len, ts)) <= 10_000 + li.MAX_CHARS for ts in model.samples.values())
    assert sum(map(len, model.samples["title"])) >= 10_000  # more rows than sample_rows where texts are short
    got = {r.doc_id: r.lang_pred for r in li.predict(docs, model).collect()}
    wrong = [i for i, (lang, _) in enumerate(rows) if got[i] != lang and lang in kinds]
    assert not wrong
