"""Stupid-backoff scoring of documents with counts from the whole corpus.

S(w | v) = c(v w) / c(v) if the pair was seen, else ALPHA * c(w) / N, else ALPHA**2 / N.
A document's own occurrences are taken out of every count, so a text is judged by
the rest of the corpus.  The score is the sum of the log S of its words and their
mean.

The counts are three relations over 64-bit n-gram hashes (words and word pairs):

- documents are packed into blocks of whole texts (written once);
- each block explodes into its distinct n-grams with their counts, the *block
  table* (block, n-gram, count); a frequent n-gram is one row per block, so no
  n-gram is a hot key;
- the block table is partitioned by n-gram hash; the *count table* sums it by
  n-gram, and is joined to it there, which gives each block the corpus counts of its
  n-grams: (block, n-gram, total);
- that comes back to the blocks, where log S is summed per document.

Rows of one (block, hash range) travel together as one packed array in n-gram
order, which is also what the totals are matched by.  This keeps the shuffled
volume at a few bytes an n-gram.

Memory: a task holds one block, or one hash range; the number of ranges follows
the corpus size.

Defined cases
- words are maximal runs of non-white-space; null, empty and blank texts have 0
  words, sum 0 and a null mean;
- a text whose words occur nowhere else gets ALPHA**2 / N for each;
- rows that repeat an id or text are documents of their own (copies vouch for
  each other); null ids are carried through; an empty table gives an empty
  result;
- a corpus of a single document has no other words: its N is taken as 1;
- only (id, text) are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import materialize, mix64, ngram_hashes, split_words, word_hashes
from faultline.session import ship_package

ALPHA = 0.4
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 4 << 20  # corpus bytes per hash range


# -- packed columns ------------------------------------------------------------------------
def _squeeze(a: np.ndarray) -> bytes:
    """An integer array, byte planes apart, compressed; the first 8 bytes are its length."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(a).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _stretch(raw: bytes, dtype) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    planes = pa.decompress(raw[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(dtype).ravel()


def _pack_texts(texts: pa.Array) -> tuple[bytes, bytes, int]:
    col = pc.fill_null(texts.cast(pa.large_string()), "")
    lengths = pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
    data = "".join(col.to_pylist()).encode("utf-8", "surrogatepass")
    return _squeeze(lengths), len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True), len(data)


def _unpack_texts(lengths: bytes, data: bytes) -> pa.Array:
    n = _stretch(lengths, np.int64)
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], size, codec="zstd")
    offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets.tobytes()), raw)


def text_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Written table of blocks of whole texts: ``block``, ``ids``, ``lengths``, ``data``, ``n_bytes``,
    ``n_words``."""
    schema = (
        T.StructType([T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType))])
        .add("lengths", T.BinaryType()).add("data", T.BinaryType()).add("n_bytes", T.LongType()).add("n_words", T.LongType())
    )

    def pack(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        ids, texts = t.column(0), t.column(1)
        ids = ids.chunk(0) if ids.num_chunks else pa.array([], ids.type)
        texts = texts.chunk(0) if texts.num_chunks else pa.array([], texts.type)
        lengths, data, size = _pack_texts(texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([lengths], pa.binary()),
                pa.array([data], pa.binary()),
                pa.array([size], pa.int64()),
                pa.array([len(split_words(texts)[0])], pa.int64()),
            ],
            names=schema.fieldNames(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            bytes_of = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            a = 0
            for b, n in enumerate(bytes_of.tolist(), 1):
                size += n
                if size >= block_bytes:
                    yield pack(pa.Table.from_batches([*held, batch.slice(a, b - a)]))
                    held, size, a = [], 0, b
            if a < batch.num_rows:
                held.append(batch.slice(a))
        if held:
            yield pack(pa.Table.from_batches(held))

    narrow = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return materialize(narrow.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "text-blocks")


# -- n-grams of a block -----------------------------------------------------------------------
class _Grams:
    """N-grams of a block: for every word its document, word key and pair key (the pair
    with the word before it; -1 at the start of a document) as places in ``keys``."""

    def __init__(self, lengths: bytes, data: bytes) -> None:
        texts = _unpack_texts(lengths, data)
        codes, self.doc, vocab = split_words(texts)
        self.n_docs = len(texts)
        words = word_hashes(vocab) if len(vocab) else np.empty(0, np.uint64)
        pair, _ = ngram_hashes(words[codes], self.doc, 2)
        follows = np.zeros(len(codes), dtype=bool)
        follows[1:] = self.doc[1:] == self.doc[:-1]
        one = mix64(words)  # apart from the pairs' hashes
        self.keys, at = np.unique(np.concatenate((one, pair)), return_inverse=True)
        self.word = at[: len(one)][codes]
        self.pair = np.full(len(codes), -1, dtype=np.int64)
        self.pair[follows] = at[len(one) :]

    def counts(self) -> np.ndarray:
        n = np.bincount(self.word, minlength=len(self.keys))
        return n + np.bincount(self.pair[self.pair >= 0], minlength=len(self.keys))

    def own(self, at: np.ndarray) -> np.ndarray:
        """For each word, how often the n-gram ``at`` occurs in its own document."""
        _, inverse, n = np.unique((self.doc << 36) | np.maximum(at, 0), return_inverse=True, return_counts=True)
        return n[inverse]


def log_scores(g: _Grams, total: np.ndarray, n_corpus: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log S per document of a block, and its number of words."""
    n_words = np.bincount(g.doc, minlength=g.n_docs)
    rest = np.maximum(n_corpus - n_words, 1)[g.doc].astype(np.float64)
    word = total[g.word] - g.own(g.word)
    pair = np.where(g.pair >= 0, total[g.pair] - g.own(g.pair), 0)
    context = np.concatenate(([0], word[:-1])) if len(word) else word
    s = np.where(word > 0, ALPHA * word / rest, ALPHA * ALPHA / rest)
    first = g.pair < 0
    s[first & (word > 0)] /= ALPHA  # a first word has no context to back off from
    seen = pair > 0
    s[seen] = pair[seen] / context[seen]
    return np.bincount(g.doc, weights=np.log(s), minlength=g.n_docs), n_words


# -- Spark ---------------------------------------------------------------------------------------
def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """id, ``n_words``, ``log_prob`` (sum of log S), ``mean_log_prob``."""
    ship_package(docs.sparkSession)
    blocks = text_blocks(docs, id_col, text_col, block_bytes)
    size = blocks.agg(F.sum("n_bytes"), F.sum("n_words")).first()
    n_corpus = int(size[1] or 0)
    bits = max(0, int(size[0] or 0) // range_bytes).bit_length()  # 2**bits hash ranges

    def edges(keys: np.ndarray) -> np.ndarray:
        if not bits:
            return np.array([0, len(keys)])
        return np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(keys)]

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                g = _Grams(r["lengths"], r["data"])
                counts, cut = g.counts().astype(np.uint32), edges(g.keys)
                parts = [(i, a, b) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in parts], pa.int64()),
                        pa.array([r["block"]] * len(parts), pa.int64()),
                        pa.array([_squeeze(np.diff(g.keys[a:b], prepend=np.uint64(0))) for _, a, b in parts], pa.binary()),
                        pa.array([_squeeze(counts[a:b]) for _, a, b in parts], pa.binary()),
                    ],
                    names=["range", "block", "grams", "counts"],
                )

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(_stretch(x, np.uint64), dtype=np.uint64) for x in rows["grams"]]
        counts = np.concatenate([_stretch(x, np.uint32) for x in rows["counts"]]).astype(np.int64)
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(place, weights=counts).astype(np.int64)[place]
        cut = np.cumsum([0, *map(len, keys)])
        packed = [_squeeze(sums[a:b]) for a, b in zip(cut, cut[1:])]
        return pd.DataFrame({"block": rows["block"], "range": rows["range"], "totals": packed})

    schema = (
        T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
        .add("n_words", T.LongType()).add("log_prob", T.DoubleType())
    )

    def judge(block: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({id_col: [], "n_words": [], "log_prob": []})
        r = block.iloc[0]
        g = _Grams(r["lengths"], r["data"])
        totals = totals.sort_values("range")
        known = np.concatenate([np.empty(0, np.int64), *[_stretch(x, np.int64) for x in totals["totals"]]])
        logs, n_words = log_scores(g, known, n_corpus)
        return pd.DataFrame({id_col: r["ids"], "n_words": n_words, "log_prob": logs})

    table = blocks.select("block", "lengths", "data").mapInArrow(explode, "range long, block long, grams binary, counts binary")
    known = table.groupBy("range").applyInPandas(total, "block long, range long, totals binary")
    scored = blocks.select("block", "ids", "lengths", "data").groupBy("block").cogroup(known.groupBy("block")).applyInPandas(judge, schema)
    return scored.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))
