import base64
import hashlib
import random

import numpy as np
import public_tokenizers as pt
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from faultline.llm import byte_bpe as bb
from faultline.llm.queries import op11_byte_bpe
from tests.conftest import SF_SMALL

RANKS = pt.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tables():
    return bb.tables(RANKS, pt.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _check(tables, library, texts):
    flat, sizes = tables.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    for text, a, b in zip(texts, ends - sizes, ends):
        assert flat[a:b].tolist() == library.encode_ordinary(text or ""), text[:80]
    assert bytes(tables.decode(flat)) == b"".join((t or "").encode() for t in texts)


def test_minimal_perfect_hash_names_each_entry_once(tables):
    h = tables.hash
    assert sorted(h.entry.tolist()) == list(range(len(tables.tokens)))
    found = h.candidates(bb.word_hashes(tables.column))
    assert found.tolist() == list(range(len(tables.tokens)))
    ids, sizes = tables.encode_pieces(tables.column)
    assert ids.tolist() == list(range(len(tables.tokens))) and (sizes == 1).all()


def test_odd_texts_match_the_library(tables, library):
    texts = ["", None, " ", "  ", "a", " a", "a ", "it's\n\n I'll  go", "x <|endoftext|> y", "\x1c \x1c a b", "a  b 　 c"]
    _check(tables, library, texts + ["z" * 20_000, "long words " * 30_000, "é" * 3_000 + " 中"])
    _check(tables, library, [])


def test_code_points_where_unicode_versions_differ(tables, library):
    odd = tables.patterns[2]
    differing = regex.findall(f"[{odd}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))) if odd else []
    assert differing  # else this test checks nothing
    _check(tables, library, [f"a{c}b {c} 1{c}{c} ,{c}" for c in differing[::5]])


def test_borders_of_texts_are_no_borders_of_words(tables, library):
    r = random.Random(7)
    pool = [" ", "  ", "\n", "a", "of", "'s", " ", " ", "é", "中", "\U0001f600", "7", "."]
    _check(tables, library, ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(5_000)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_texts_match_the_library(tables, library, texts):
    _check(tables, library, texts)


def test_operator_rows_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "the cat's hat", "x"), (1, "the cat's hat", "x"), (None, None, "y"), (2, "", "z"), (3, "zzqj " * 20_000, "w")]
    df = spark.createDataFrame(rows, "ids long, text string, n_tokens string")
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted((tuple(r) for r in bb.round_trip(df, RANKS, pt.PATTERN, id_col="ids").collect()), key=key)
    want = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=key)
    coded = bb.encode(df, RANKS, pt.PATTERN, id_col="ids")
    assert coded.columns == ["ids", "_ids"]
    assert sorted((len(r["_ids"]) for r in coded.collect())) == sorted(w[1] for w in want)
    back = bb.decode(coded, RANKS, pt.PATTERN, id_col="ids", ids_col="_ids")
    assert sorted(bytes(r["bytes"]).decode() for r in back.collect()) == sorted(t or "" for _, t, _ in rows)
    assert bb.round_trip(df.limit(0), RANKS, pt.PATTERN, id_col="ids").count() == 0


def test_query_matches_the_library_on_every_document(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op11_byte_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
