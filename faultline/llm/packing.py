"""Best-fit packing of tokenised documents into fixed-size sequences.

1. ``token_pieces`` tokenises whole texts in batches and cuts only documents
   longer than a sequence: into full pieces, the first piece being the shorter
   one.  Per piece it returns its length and a CRC of its ids (or the ids).
2. ``plan_bins`` packs by vector best-fit.  A bin has three capacities: tokens,
   documents and attention cost (sum of squared lengths).  Pieces of equal
   length are interchangeable, so the planner works on the histogram of lengths
   (at most ``max_tokens`` rows, whatever the input) and on groups of bins that
   look the same.  Lengths go in decreasing order; each piece goes to the
   feasible bin with the smallest weighted residual norm (``rule="norm"``) or
   the largest weighted dot-product of item and residual (``rule="dot"``); a
   bin is opened only if none fits.  All capacities hold for every bin.
3. ``pack`` ranks the pieces within their length over the whole cluster and
   looks every piece's place up in the plan.  The packing is global: nothing is
   lost at the edges of partitions, and no length, however frequent, meets in
   one task.

Defined cases
- null text counts as empty: a document of the end token alone;
- a null id is carried through; rows that repeat an id are documents of
  their own;
- an empty table gives an empty result and no bins;
- texts of any length are tokenised whole;
- only (id, text) are read, so extra columns never clash.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import global_rank, materialize
from faultline.session import ship_package

END_ID = 2
MAX_TOKENS = 1024
_SHIFT = 44  # rank bits in the plan's look-up key


# -- tokenising ------------------------------------------------------------------
@functools.lru_cache(maxsize=2)
def _encoder(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    starts_word = np.zeros(max(ranks.values()) + 1, dtype=bool)
    starts_word[[i for b, i in ranks.items() if b[:1] == b" "]] = True
    return enc, starts_word


def encode_batch(texts: list[str], ranks_path: str, pattern: str, special: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of ``texts``, concatenated, and the number of ids of each.

    The pattern never lets a token cross from a non-space into a following
    space, so a text may be cut before each single space between two
    non-white-space characters and the parts encoded alone.  Texts where all
    spaces are of that kind are cut, the distinct parts of the batch are encoded
    once, and the ids are put together again.  Other texts, and texts holding a
    special token, are encoded as they are."""
    enc, starts_word = _encoder(ranks_path, pattern)
    n = len(texts)
    ids: list[np.ndarray | None] = [None] * n
    col = pa.array(texts, pa.large_string())
    odd = pc.or_(
        pc.match_substring_regex(col, r"^ | $|[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}] | [\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"),
        pc.equal(col, ""),
    ).to_numpy(zero_copy_only=False)
    for token in special:
        odd |= pc.match_substring(col, token).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(odd):
        ids[i] = np.asarray(_encode_special(enc, texts[i], special), dtype=np.uint32)
    plain = np.flatnonzero(~odd)
    if len(plain):
        # Every part is encoded with a space in front; a text's first part is given one more
        # look without it below.
        lists = pc.split_pattern(col.take(pa.array(plain)), " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        parts = lists.flatten().dictionary_encode()
        codes = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        vocab = parts.dictionary
        joined = np.asarray(enc.encode_ordinary(" " + " ".join(vocab.to_pylist())), dtype=np.uint32)
        begin = np.flatnonzero(starts_word[joined])
        assert len(begin) == len(vocab)
        length = np.diff(np.append(begin, len(joined)))
        for k, i in enumerate(plain):
            head = enc.encode_ordinary(vocab[codes[first[k]]].as_py())
            c = codes[first[k] + 1 : first[k] + counts[k]]
            ln = length[c]
            total = int(ln.sum())
            at = np.repeat(begin[c] - (np.cumsum(ln) - ln), ln) + np.arange(total)
            ids[i] = np.concatenate((np.asarray(head, dtype=np.uint32), joined[at]))
    sizes = np.fromiter((len(x) for x in ids), np.int64, n)
    return (np.concatenate(ids) if n else np.empty(0, np.uint32)), sizes


def _encode_special(enc, text: str, special: dict[str, int]) -> list[int]:
    """Ids of ``text`` with special tokens' strings as their own ids."""
    for token, i in special.items():
        if token in text:
            out: list[int] = []
            for k, part in enumerate(text.split(token)):
                out += ([i] if k else []) + _encode_special(enc, part, special)
            return out
    return enc.encode_ordinary(text)


def token_pieces(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    special: dict[str, int],
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``)."""
    ship_package(docs.sparkSession)
    fields = [
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + ([T.StructField("ids", T.ArrayType(T.LongType()))] if keep_ids else [])
    slice_rows, slice_bytes = 8192, 16 << 20

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column(1), "").to_pylist()
        flat, sizes = encode_batch(texts, ranks_path, pattern, special)
        out: list[tuple] = []
        kept: list[np.ndarray] = []
        at = 0
        for k, n in enumerate(sizes.tolist()):
            own = np.append(flat[at : at + n], np.uint32(end_id)).astype("<u4")
            at += n
            cut = len(own) % max_tokens
            edges = [0, *range(cut or max_tokens, len(own) + 1, max_tokens)]
            for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                out.append((k, piece, a, b - a, zlib.crc32(own[a:b].tobytes())))
                if keep_ids:
                    kept.append(own[a:b])
        cols = list(zip(*out)) if out else [[]] * 5
        arrays = [
            batch.column(0).take(pa.array(cols[0], pa.int64())),
            pa.array(cols[1], pa.int32()),
            *[pa.array(c, pa.int64()) for c in cols[2:]],
        ] + ([pa.array([x.astype(np.int64) for x in kept], pa.list_(pa.int64()))] if keep_ids else [])
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, slice_rows, slice_bytes):
                yield pieces(part)

    narrow = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("_text"))
    return narrow.mapInArrow(run, T.StructType(fields))


def slices(batch: pa.RecordBatch, text_at: int, max_rows: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of whole rows of about ``max_bytes`` of text (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    a = 0
    while a < batch.num_rows:
        before = ends[a - 1] if a else 0
        b = int(np.searchsorted(ends, before + max_bytes, side="right"))
        b = min(max(b, a + 1), a + max_rows, batch.num_rows)
        yield batch.slice(a, b - a)
        a = b


# -- planning --------------------------------------------------------------------
def plan_bins(
    histogram: dict[int, int],
    max_tokens: int = MAX_TOKENS,
    max_docs: int = MAX_TOKENS,
    max_attention: int = MAX_TOKENS * MAX_TOKENS,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
) -> np.ndarray:
    """Places for ``histogram`` (length -> pieces) as rows
    ``(length, first rank, number, first sequence, offset)``: pieces of that
    length with ranks ``first rank + i`` go to sequences ``first sequence + i``."""
    cap = np.array([max_tokens, max_docs, max_attention], dtype=np.float64)
    w = np.asarray(weights, dtype=np.float64)
    res = np.zeros((1024, 3), dtype=np.int64)  # residual capacities of a group of equal bins
    first = np.zeros(1024, dtype=np.int64)  # its first sequence
    mult = np.zeros(1024, dtype=np.int64)  # how many
    used, n_seq = 0, 0
    out: list[tuple[int, int, int, int, int]] = []

    def add(residual, start: int, count: int) -> None:
        nonlocal used, res, first, mult
        if used == len(mult):
            res, first, mult = np.concatenate((res, np.zeros_like(res))), np.concatenate((first, np.zeros_like(first))), np.concatenate((mult, np.zeros_like(mult)))
        res[used], first[used], mult[used] = residual, start, count
        used += 1

    for length in sorted(histogram, reverse=True):
        item = np.array([length, 1, length * length], dtype=np.int64)
        if length <= 0 or (item > cap).any():
            raise ValueError(f"a piece of {length} tokens does not fit into an empty sequence")
        left, rank = int(histogram[length]), 0
        while left:
            fits = np.flatnonzero((res[:used] >= item).all(axis=1))
            if not len(fits):
                per_bin = int((np.array(cap, dtype=np.int64) // item).min())
                count = -(-left // per_bin)
                add(cap.astype(np.int64), n_seq, count)
                n_seq += count
                continue
            r = res[fits]
            if rule == "norm":
                score = (w * ((r - item) / cap) ** 2).sum(axis=1)
            elif rule == "dot":
                score = -(w * (item / cap) * (r / cap)).sum(axis=1)
            else:
                raise ValueError(f"unknown rule {rule!r}")
            g = int(fits[np.argmin(score)])
            take = min(left, int(mult[g]))
            out.append((length, rank, take, int(first[g]), max_tokens - int(res[g, 0])))
            if take < mult[g]:
                add(res[g].copy(), int(first[g]) + take, int(mult[g]) - take)
                mult[g] = take
            res[g] -= item
            left -= take
            rank += take
    return np.array(out, dtype=np.int64).reshape(-1, 5)


# -- placing ---------------------------------------------------------------------
def pack(
    pieces: DataFrame,
    id_col: str = "doc_id",
    max_tokens: int = MAX_TOKENS,
    **capacities,
) -> DataFrame:
    """``pieces`` (see ``token_pieces``) with ``sequence_id`` and ``offset``."""
    pieces = materialize(pieces, "pieces")
    histogram = {
        int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    }  # one row per length, max_tokens at most
    plan = plan_bins(histogram, max_tokens, **capacities)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    keys = (plan[:, 0] << _SHIFT) + plan[:, 1]
    by_length, total = {}, 0
    for length in sorted(histogram):
        by_length[length] = total  # pieces shorter than this length
        total += histogram[length]
    before = np.zeros(max_tokens + 1, dtype=np.int64)
    before[list(by_length)] = list(by_length.values())
    ranked = global_rank(pieces, ["length", id_col, "piece", "ids_crc32"])
    schema = T.StructType([f for f in pieces.schema.fields]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    names = schema.fieldNames()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() - before[length]
            row = plan[np.searchsorted(keys, (length << _SHIFT) + rank, side="right") - 1]
            arrays = [batch.column(n) for n in names[:-2]]
            arrays += [pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return ranked.mapInArrow(place, schema)
