import re
from collections import Counter, defaultdict

import pytest

from faultline.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, rank string, target double"


def _docs(spark):
    rows = []
    for i in range(600):
        src = ["b", "a", "A", None, "é", "tiny"][0 if i % 3 == 0 else i % 6]
        if src == "tiny" and i > 40:
            src = "b"
        rows.append((i, "w " * ((i * 37) % 90) if i % 50 else None, src, 1, "x", 0.5))
    rows.append((9000, "word " * 30_000, "b", 1, "", 0.0))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def _targets(sizes, weights=(3, 1, 2)):
    """Literal water filling over sources by code point, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    pot, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while True:
        level = (pot - sum(2 * sizes[s] for s in order if s not in open_)) / max(sum(w[s] for s in open_), 1)
        above = {s for s in open_ if w[s] * level >= 2 * sizes[s]}
        if not above:
            break
        open_ -= above
        if not open_:
            break
    for s in order:
        target[s] = w[s] * level if s in open_ else 2.0 * sizes[s]
    return target


def test_mix_follows_targets(spark):
    rows, docs = _docs(spark)
    got = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    sizes = defaultdict(int)
    for i, _, s, *_ in rows:
        sizes[s] += size[i]
    want = _targets(sizes)
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_reruns_and_layouts_agree(spark):
    _, docs = _docs(spark)
    a = sorted(tuple(r) for r in mixing.mix(docs).select("doc_id", "taken").collect())
    b = sorted(tuple(r) for r in mixing.mix(docs.repartition(2)).select("doc_id", "taken").collect())
    assert a == b


def test_emit_repeats_rows_and_keeps_columns(spark):
    _, docs = _docs(spark)
    out = mixing.emit(docs)
    assert out.columns == docs.columns
    counts = Counter(r.doc_id for r in out.select("doc_id").collect())
    for r in mixing.mix(docs).collect():
        assert counts[r.doc_id] == r.copies


def test_repeated_ids_empty_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 0, "", 0.0)] * 4 + [(None, None, None, 0, "", 0.0)], SCHEMA)
    got = mixing.mix(docs).collect()
    assert len(got) == 5 and sum(r.taken for r in got if r.source == "s") == 12  # 1.5 times 8 words
    assert [(r.target, r.taken) for r in got if r.source is None] == [(0.0, 0)]
    assert sum(r.doc_id == 1 for r in mixing.emit(docs).collect()) == 6
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.emit(docs.limit(0)).count() == 0


def test_emit_keeps_columns_of_any_name(spark):
    rows = [(i, "w " * (i % 7), "s" if i % 3 else "t", i, f"c{i}", -i, i * 10, "row", "own", "n", "k") for i in range(60)]
    names = "_e long, _n string, _c long, _h long, row_num string, own_row string, n_copies string, copy string"
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}")
    got = mixing.emit(docs)
    assert got.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    by = {r[0]: r for r in rows}
    out = [tuple(r) for r in got.collect()]
    assert all(r == by[r[0]] for r in out)
    assert {i: n for i, n in copies.items() if n} == dict(Counter(r[0] for r in out))
