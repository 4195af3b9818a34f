import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from faultline.llm import packing
from faultline.llm.queries import tokenizer_args

ARGS = tokenizer_args()
HF = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(text):
    return HF.encode(text or "", add_special_tokens=False).ids


PARTS = st.sampled_from([" ", "  ", "\n", "\t", "a", "wörd", "the", "'s", "12", "!!", "é", "\u00a0", "\x1c", "\u3000", "漢", "🙂", "<|endoftext|>", "it's", ".", "\x85", "\r\n"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join), max_size=6))
def test_batch_encoding_equals_the_tokenizer(texts):
    flat, sizes = packing.encode_batch(texts, ARGS["ranks_path"], ARGS["pattern"], ARGS["special"])
    assert sizes.tolist() == [len(_ids(t)) for t in texts]
    assert flat.tolist() == [i for t in texts for i in _ids(t)]


SCHEMA = "doc_id long, text string, length int, piece string, sequence_id string"


def _rows():
    r = random.Random(2)
    rows = [(i, " ".join(r.choices(["alpha", "beta", "gamma", "x."], k=r.choice([0, 1, 5, 80, 300, 1500]))), 0, "", "") for i in range(120)]
    return rows + [(500, None, 0, "", ""), (501, "", 0, "", ""), (502, "word " * 40_000, 0, "", ""), (3, rows[3][1], 0, "", ""), (None, "null id", 0, "", "")]


def test_pieces_round_trip_and_places(spark):
    rows = _rows()
    got = packing.pack(packing.token_pieces(spark.createDataFrame(rows, SCHEMA).repartition(4), **ARGS, keep_ids=True)).collect()
    by_doc, want = defaultdict(list), Counter()
    for r in got:
        own = np.array(r.ids, dtype="<u4")
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.piece, r.start, tuple(r.ids)))
    for i, t, *_ in rows:
        want[(i, tuple(_ids(t) + [packing.END_ID]))] += 1
    for (i, ids), n in want.items():
        cut = len(ids) % 1024
        edges = [0, *range(cut or 1024, len(ids) + 1, 1024)]
        pieces = [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
        for p in pieces:
            assert by_doc[i].count(p) == n
    assert len(got) == sum(len(v) for v in by_doc.values())
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    bins = []  # item by item: decreasing best fit
    for length in sorted((r.length for r in got), reverse=True):
        fits = [b for b in bins if b[0] >= length]
        if fits:
            min(fits)[0] -= length
        else:
            bins.append([1024 - length])
    assert len(places) <= len(bins)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    r = np.random.default_rng(4)
    histogram = {int(k): int(v) for k, v in zip(range(1, 101), r.integers(0, 40, 100))}
    caps = {"max_tokens": 100, "max_docs": 4, "max_attention": 5000}
    plan = packing.plan_bins({k: v for k, v in histogram.items() if k <= 70 and v}, **caps, rule=rule, weights=(1, 1, 1))
    tokens, docs, cost, seen = Counter(), Counter(), Counter(), Counter()
    for length, rank, n, first, offset in plan.tolist():
        assert rank == seen[length]
        seen[length] += n
        for s in range(first, first + n):
            assert tokens[s] == offset
            tokens[s] += length
            docs[s] += 1
            cost[s] += length * length
    assert seen == Counter({k: v for k, v in histogram.items() if k <= 70 and v})
    assert max(tokens.values()) <= 100 and max(docs.values()) <= 4 and max(cost.values()) <= 5000
    with pytest.raises(ValueError):
        packing.plan_bins({71: 1}, **caps)  # 71 squared is above the attention capacity


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert packing.pack(packing.token_pieces(docs, **ARGS)).count() == 0
