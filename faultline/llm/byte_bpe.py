"""Byte-level BPE: texts to token ids and back, over a rank file.

Encoding is a two-tier look-up of pre-tokens (the matches of the split pattern):

1. **Whole pre-tokens.** A minimal perfect hash over the vocabulary (hash and
   displace: one slot per entry, none free) gives the one entry a pre-token could
   be, and a comparison of bytes says whether it is.  The look-up is vectorised
   over the distinct pre-tokens of a slice of texts.
2. **Misses** are merged: bytes in a doubly linked list, adjacent pairs in a heap
   by (rank, place), until no pair is in the vocabulary.

Texts are cut before single spaces between two non-white characters, where no
match of the pattern can reach across, so equal parts of a slice are split and
looked up once.  Decoding joins the bytes of the ids; it restores every text.

The tables (rank file, hash, pattern) are built on the driver from the file and
broadcast; their size is that of the vocabulary and does not grow with the data.
Rows are encoded where they are scanned: there is no shuffle.

Defined cases
- null text counts as empty; an empty text has no ids;
- texts of any length are encoded whole; a row is never split over tasks;
- a null id and repeated rows are carried through, row by row;
- an empty table gives an empty result;
- strings of special tokens are ordinary text;
- only (id, text) are read, so extra columns never clash.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faultline.llm.common import fresh_name, mix64, word_hashes
from faultline.llm.packing import slices
from faultline.session import ship_package

SLICE_BYTES, SLICE_ROWS = 16 << 20, 16384
KEPT_MERGES = 400_000  # merged pre-tokens that a worker keeps for later batches, some 200 bytes each
_BUCKETS_IN_5 = 2  # 2.5 keys a bucket
_TRIALS = 64  # displacements tried at once
_ODD = np.uint64(0x9E3779B97F4A7C15)


# -- tier 1: minimal perfect hash ------------------------------------------------------
def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file (base64 token, rank); ranks are 0, 1, 2, ..."""
    with open(path, "rb") as f:
        ranked = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, f))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be 0, 1, 2, ... without a gap")
    tokens = [t for _, t in ranked]
    if len({*tokens}) != len(tokens) or not {bytes([i]) for i in range(256)} <= {*tokens}:
        raise ValueError("tokens must be distinct and hold every single byte")
    return tokens


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: ``slot_of`` maps key i to a slot of its own
    in 0 .. n-1.  Buckets get a displacement each, the largest bucket first; a bucket of one
    key names its slot directly (negative displacement)."""

    def __init__(self, keys: Sequence[bytes]) -> None:
        n = len(keys)
        h = word_hashes(pa.array(keys, pa.binary()))
        if len(np.unique(h)) != n:
            raise ValueError("two keys have the same 64-bit hash")
        buckets = max(1, n * _BUCKETS_IN_5 // 5)
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        count = np.bincount(bucket, minlength=buckets)
        start = np.cumsum(count) - count
        self.n, self.displace = n, np.zeros(buckets, dtype=np.int64)
        self.entry = np.full(n, -1, dtype=np.int64)  # slot -> key
        free = np.ones(n, dtype=bool)
        by_size = np.argsort(-count, kind="stable")
        for b in by_size[count[by_size] > 1]:
            members = order[start[b] : start[b] + count[b]]
            d = np.arange(_TRIALS)
            while True:
                slots = self._slots(h[members][None, :], d[:, None])
                ok = np.flatnonzero(free[slots].all(axis=1))
                ok = [k for k in ok if len({*slots[k].tolist()}) == len(members)]
                if ok:
                    break
                d += _TRIALS
            self.displace[b] = d[ok[0]]
            free[slots[ok[0]]] = False
            self.entry[slots[ok[0]]] = members
        singles, gaps = by_size[count[by_size] == 1], np.flatnonzero(free)
        self.displace[singles] = -1 - gaps
        self.entry[gaps] = order[start[singles]]

    def _slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        return (mix64(h + np.asarray(d).astype(np.uint64) * _ODD + np.uint64(1)) % np.uint64(self.n)).astype(np.int64)

    def candidates(self, h: np.ndarray) -> np.ndarray:
        """For hashes of any strings, the one key each could be."""
        d = self.displace[(h % np.uint64(len(self.displace))).astype(np.int64)]
        return self.entry[np.where(d < 0, -1 - d, self._slots(h, np.maximum(d, 0)))]


# -- tier 2: heap over linked bytes -------------------------------------------------------
def pair_table(tokens: Sequence[bytes]) -> dict[int, int]:
    """Rank of the merged token by ``left id * number of tokens + right id``, for every way a
    token is made of two others."""
    rank_of = {t: i for i, t in enumerate(tokens)}
    out = {}
    for r, t in enumerate(tokens):
        for i in range(1, len(t)):
            a, b = rank_of.get(t[:i]), rank_of.get(t[i:])
            if a is not None and b is not None:
                out[a * len(tokens) + b] = r
    return out


def merge_bytes(ids: list[int], pair: dict[int, int], size: int) -> list[int]:
    """Token ids of a piece given as the ids of its bytes: the adjacent pair of lowest rank, the
    leftmost of equals, is merged until no pair has a rank."""
    n = len(ids)
    rank = [pair.get(a * size + b, -1) for a, b in zip(ids, ids[1:])]  # of the pair that begins here
    rank.append(-1)
    heap = [r * n + i for i, r in enumerate(rank) if r >= 0]
    heapq.heapify(heap)
    after = list(range(1, n + 1))  # where a part ends and the next begins
    before = list(range(-1, n - 1))
    while heap:
        r, i = divmod(heapq.heappop(heap), n)
        if rank[i] != r:
            continue  # one of the two parts has changed since
        j = after[i]
        end = after[i] = after[j]
        ids[i], ids[j], rank[j] = r, -1, -1
        rank[i] = -1
        if end < n:
            before[end] = i
            if (q := pair.get(r * size + ids[end], -1)) >= 0:
                rank[i] = q
                heapq.heappush(heap, q * n + i)
        if (k := before[i]) >= 0:
            rank[k] = q = pair.get(ids[k] * size + r, -1)
            if q >= 0:
                heapq.heappush(heap, q * n + k)
    return [x for x in ids if x >= 0]


# -- the split pattern ----------------------------------------------------------------------
@functools.cache
def _class_gap(name: str) -> tuple[str, str]:
    """Code points that ``regex`` has in a class beyond the encoder library, and the other way
    round, as ranges of a character class: their Unicode versions differ."""
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    theirs = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
    a, b = {*regex.findall(name, every)}, {*bytes(theirs.encode_ordinary(every)).decode()}
    return _ranges(a - b), _ranges(b - a)


def _ranges(chars: set[str]) -> str:
    out: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


def split_patterns(pattern: str) -> tuple[str, str, str]:
    """``pattern``, the same with the classes corrected, and a class of the code points that
    need the corrected (slower) one."""
    exact, odd = pattern, ""
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        more, less = _class_gap(name)
        if more or less:
            kept = rf"[{name}--[{more}]]" if more else name
            exact = exact.replace(name, rf"[{kept}{less}]")
            odd += more + less
    return pattern, exact, odd


# -- encoding a batch -------------------------------------------------------------------------
def cut_places(data: np.ndarray) -> np.ndarray:
    """Positions of single spaces between two characters that are surely not white space.

    White space outside ASCII is U+0085, U+00A0 (lead byte C2), U+1680 (E1), U+2000 to U+205F
    (E2) and U+3000 (E3); characters with these lead bytes never border a cut."""
    p = np.flatnonzero(data == 0x20)
    p = p[(p > 0) & (p < len(data) - 1)]
    left, right = data[p - 1], data[p + 1]
    ascii_ok = np.zeros(256, dtype=bool)
    ascii_ok[0x21:0x7F] = True
    lead_ok = np.zeros(256, dtype=bool)
    lead_ok[0xC3:] = True
    lead_ok[0xE1:0xE4] = False
    two, three, four = (data[np.maximum(p - k, 0)] for k in (2, 3, 4))
    wide_left = (left >= 0x80) & (
        ((two >= 0xC3) & (two < 0xE0))
        | ((two >= 0x80) & (two < 0xC0) & (three >= 0xE0) & (three < 0xF0) & lead_ok[three])
        | ((two >= 0x80) & (two < 0xC0) & (three >= 0x80) & (three < 0xC0) & (four >= 0xF0))
    )
    return p[(ascii_ok[left] | wide_left) & (ascii_ok[right] | lead_ok[right])]


def ragged(starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the elements of lists ``index`` one after another, and the lists' sizes."""
    n = sizes[index]
    first = np.cumsum(n) - n
    return np.repeat(starts[index] - first, n) + np.arange(int(n.sum())), n


class Tables:
    """What a task needs to encode and decode."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens, self.patterns = tokens, split_patterns(pattern)
        self.hash = PerfectHash(tokens)

    @functools.cached_property
    def pair(self) -> dict[int, int]:
        return pair_table(self.tokens)

    @functools.cached_property
    def kept(self) -> dict[bytes, bytes]:
        return {}

    @functools.cached_property
    def single(self) -> np.ndarray:
        """Ids of the single bytes."""
        out = np.zeros(256, dtype=np.int64)
        for i, t in enumerate(self.tokens):
            if len(t) == 1:
                out[t[0]] = i
        return out

    @functools.cached_property
    def column(self) -> pa.Array:
        return pa.array(self.tokens, pa.large_binary())

    @functools.cached_property
    def split(self):
        """Function from a list of texts to the list of their pre-tokens' lists."""
        import regex

        plain, exact, odd = self.patterns
        find, find_exact = regex.compile(plain).findall, regex.compile(exact, regex.V1).findall
        rare = regex.compile(f"[{odd}]").search if odd else None

        def run(texts: list[str]) -> list[list[str]]:
            if rare is None or not rare("".join(texts)):
                return list(map(find, texts))
            return [find_exact(t) if rare(t) else find(t) for t in texts]

        return run

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("tokens", "patterns", "hash")}

    def encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens (large_binary), concatenated, and the number of each."""
        entry = self.hash.candidates(word_hashes(pieces)) if len(pieces) else np.empty(0, np.int64)
        known = pc.equal(self.column.take(pa.array(entry)), pieces).to_numpy(zero_copy_only=False)
        sizes = np.ones(len(pieces), dtype=np.int64)
        misses = np.flatnonzero(~known)
        missed = pa.concat_arrays([pieces.take(pa.array(misses))])
        merged = []
        if len(misses):
            edges = np.frombuffer(missed.buffers()[1], np.int64, len(misses) + 1).tolist()
            bytes_as_ids = self.single[np.frombuffer(missed.buffers()[2], np.uint8, edges[-1])].tolist()
            kept, pair, size = self.kept, self.pair, len(self.tokens)
            for piece, a, b in zip(missed.to_pylist(), edges, edges[1:]):
                if (ids := kept.get(piece)) is None:
                    ids = np.array(merge_bytes(bytes_as_ids[a:b], pair, size), dtype=np.uint32).tobytes()
                    if len(kept) < KEPT_MERGES and len(piece) <= 64:
                        kept[piece] = ids
                merged.append(ids)
        sizes[misses] = [len(m) // 4 for m in merged]
        flat = np.empty(int(sizes.sum()), dtype=np.uint32)
        first = np.cumsum(sizes) - sizes
        flat[first[known]] = entry[known]
        if merged:
            at, _ = ragged(first, sizes, misses)
            flat[at] = np.frombuffer(b"".join(merged), np.uint32)
        return flat, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (nulls: none), concatenated, and the number of each."""
        texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])  # offsets from 0
        edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        begin, stop = int(edges[0]), int(edges[-1])
        if begin == stop:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8, stop)
        # A space that ends or begins a text is no cut: the neighbours belong to other texts.
        cuts = cut_places(data[begin:]) + begin
        inside = np.searchsorted(edges, cuts, side="right")
        cuts = cuts[(edges[inside - 1] < cuts) & (cuts + 1 < edges[np.minimum(inside, len(edges) - 1)])]
        offsets = np.sort(np.concatenate((edges, cuts)), kind="stable")  # two sorted runs
        parts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), texts.buffers()[2])
        parts = parts.dictionary_encode()
        code = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lists = self.split(parts.dictionary.to_pylist())
        pieces = pa.array([p for found in lists for p in found], pa.large_string()).dictionary_encode()
        flat, sizes = self.encode_pieces(pieces.dictionary.cast(pa.large_binary()))
        # pieces -> parts -> texts
        piece = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        at, n = ragged(np.cumsum(sizes) - sizes, sizes, piece)
        flat = flat[at]
        per_part = np.fromiter(map(len, lists), np.int64, len(lists))
        ends = np.concatenate(([0], np.cumsum(n)))
        last = np.cumsum(per_part)
        first = ends[last - per_part]
        at, n = ragged(first, ends[last] - first, code)
        ends = np.concatenate(([0], np.cumsum(n)))
        where = np.searchsorted(offsets, edges)
        return flat[at], ends[where[1:]] - ends[where[:-1]]

    def decode(self, ids: np.ndarray) -> memoryview:
        """The bytes of ``ids``, joined."""
        joined = pa.concat_arrays([self.column.take(pa.array(ids))])
        return memoryview(joined.buffers()[2] or b"")[: int(self.token_bytes[ids].sum())]

    @functools.cached_property
    def token_bytes(self) -> np.ndarray:
        return np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))


def tables(ranks_path: str, pattern: str) -> Tables:
    return Tables(read_ranks(ranks_path), pattern)


# -- on Spark -----------------------------------------------------------------------------------
def _shared(spark: SparkSession, ranks_path: str, pattern: str):
    ship_package(spark)
    return spark.sparkContext.broadcast(tables(ranks_path, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``ids`` (array of int), the token ids of the whole text."""
    shared = _shared(docs.sparkSession, ranks_path, pattern)
    ids_col = fresh_name("ids", [id_col])
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_ROWS, SLICE_BYTES):
                flat, sizes = shared.value.encode(part.column(1))
                edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, ids_col])

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("_text")).mapInArrow(run, schema)


def decode(ids: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``bytes`` (binary), the joined bytes of the ids (a null list: none)."""
    shared = _shared(ids.sparkSession, ranks_path, pattern)
    bytes_col = fresh_name("bytes", [id_col])
    schema = T.StructType([T.StructField(id_col, ids.schema[id_col].dataType), T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            out = [bytes(shared.value.decode(x.values.to_numpy().astype(np.int64))) if x.is_valid else b"" for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_col, bytes_col])

    return ids.select(ids[id_col].alias(id_col), ids[ids_col].cast("array<int>").alias("_ids")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (the bytes decoded from them), lowercase hex.  Encodes and decodes in one pass."""
    shared = _shared(docs.sparkSession, ranks_path, pattern)
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_ROWS, SLICE_BYTES):
                t = shared.value
                flat, sizes = t.encode(part.column(1))
                raw, decoded = memoryview(flat.astype("<u4").tobytes()), t.decode(flat)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                spans = np.concatenate(([0], np.cumsum(t.token_bytes[flat])))[ends]
                ids = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                texts = [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(spans[:-1].tolist(), spans[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                    names=schema.fieldNames(),
                )

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("_text")).mapInArrow(run, schema)
