"""Each stage against a brute-force version on its own input."""

from collections import Counter

import corpus_pipeline as cp
from faultline.llm import mixing
from faultline.llm.common import materialize
from tests.conftest import SF_SMALL
from tests.llm.test_ngram_join import _brute as near_classes
from tests.llm.test_packing import _ids


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = spark.createDataFrame(
        [(10_000, None, "en", "src1", 0), (10_001, " 12 ", "en", "src1", 4), (10_002, "", None, None, 0)], docs.schema
    )
    docs = docs.unionByName(extra)
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = materialize(stage(spark, docs, SF_SMALL), "test")
        assert docs.columns == columns
        after = [tuple(r) for r in docs.collect()]
        text = {r[0]: r[1] for r in before}
        if name == "language_id":
            assert sorted(after, key=repr) == sorted((r for r in before if any(map(str.isalpha, r[1] or ""))), key=repr)
        elif name == "exact_dedup":
            best = {}
            for r in before:
                best[r[1]] = max(best.get(r[1], r), r, key=lambda x: x[0])
            assert sorted(after) == sorted(best.values()) and len(after) < len(before)
        elif name == "ngram_join":
            want = {c for _, c, _, _ in near_classes([(r[0], r[1]) for r in before])}
            assert sorted(r[0] for r in after) == sorted(want) and len(after) < len(before)
        else:
            counts = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(before, docs.schema)).collect()}
            assert Counter(r[0] for r in after) == Counter({i: n for i, n in counts.items() if n})
        assert all(text[r[0]] == r[1] for r in after)
    packed = cp.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    want = sum(len(_ids(r[1])) + 1 for r in docs.select("doc_id", "text").collect())
    assert sum(r.length for r in packed) == want
    load = Counter()
    for r in packed:
        load[r.sequence_id] += r.length
    assert max(load.values()) <= 1024


def test_run_reads_documents(spark):
    out = cp.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_corpus_of_short_labelled_texts_is_kept(spark):
    rows = [(i, t, lang, "src1", len(t)) for i, (t, lang) in enumerate([("the dog", "en"), ("der hund", "de"), ("a cat sat", "en")] * 5)]
    docs = spark.createDataFrame(rows + [(99, " 12 ", "en", "src1", 4)], spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema)
    kept = cp.STAGES[0][1](spark, docs, SF_SMALL).collect()
    assert sorted(tuple(r) for r in kept) == rows
