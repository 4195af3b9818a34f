"""Periodic runs of words in a text (loops such as ``a b c a b c a b c``), found and collapsed.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and length >= max(``min_length``, 3 q) that no neighbouring word extends
keeping period q.  Seed and extend, on the diagonals (lags) of each text:

1. **Minimum guaranteed overlap.** A run of period q matches itself at lag q over
   length - q words, which is at least 16 for q <= 8 (with ``min_length`` 24) and at
   least 2 q otherwise.  So its k-grams recur at lag q for k = 16 if q <= 16, and for k = 32,
   64, ... if q lies in (k/2, k].  Level k indexes the k-grams of a text (the next level's
   are pairs of this level's).
2. **Occurrence pairs.** Only a k-gram and its next occurrence in the same text are
   paired, and only at lags of the level.  That is enough: if a k-gram of a run recurred
   sooner than q <= k, two periods would overlap on so many words (Fine and Wilf) that the
   run's smallest period would be less than q.  So there are at most as many pairs as words,
   not their square, however repetitive the text is.
3. **Extension.** Seeds that follow one another on a diagonal are one seed.  Each is extended
   to both sides, comparing words, unless the per-lag table of what is covered says that
   this stretch of the diagonal is known.  A stretch that is long enough is a run; the lag is
   its smallest period, by the argument of 2.

Each text is handled where it is scanned; nothing is shuffled.  Work and memory are
O(n log n) in a text's words, whole texts of any length included.

Defined cases
- words are maximal runs of characters other than space, tab, line feed, vertical tab,
  form feed and carriage return;
- null, empty and blank texts have no words and no runs;
- runs may overlap; a word is dropped if any run holds it after that run's first q words;
- ties for the strongest run (exact length / period) go to the smallest start, then period;
- a null id and repeated rows are carried through, row by row;
- an empty table gives an empty result;
- only (id, text) are read, so extra columns never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import fresh_name, mix64
from faultline.llm.packing import slices
from faultline.session import ship_package

MIN_LENGTH, MIN_EXPONENT = 24, 3
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES, SLICE_ROWS = 8 << 20, 8192
_STEP = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of the texts one after another, equal for equal words, and the place where
    each text begins (and the last ends)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = lists.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    blank = pc.index(words.dictionary, "").as_py()  # from leading or trailing white space
    if blank >= 0:
        keep = codes != blank
        codes, text = codes[keep], text[keep]
    return codes, np.searchsorted(text, np.arange(len(texts) + 1))


def guaranteed_overlap(min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> int:
    """Words over which every run surely matches itself at the lag of its period, at the least."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def _seeds(grams: np.ndarray, text: np.ndarray, k: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of each k-gram whose next occurrence in its text is ``low`` < lag <= k words on."""
    key = mix64(grams ^ (text.astype(np.uint64) * _STEP))
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    several = np.zeros(len(order), dtype=bool)
    several[1:] |= same
    several[:-1] |= same
    place, group = order[several], ordered[several]
    by = np.lexsort((place, group))
    place, group = place[by], group[by]
    lag = place[1:] - place[:-1]
    ok = (group[1:] == group[:-1]) & (lag > low) & (lag <= k)
    return place[:-1][ok], lag[ok]


def _match_ahead(codes: np.ndarray, i: int, j: int, stop: int) -> int:
    """How many words from ``i`` and ``j`` > ``i`` on are equal, before ``stop`` (of ``j``)."""
    done, width = 0, 64
    while j + done < stop:
        n = min(width, stop - j - done)
        differ = np.flatnonzero(codes[i + done : i + done + n] != codes[j + done : j + done + n])
        if len(differ):
            return done + int(differ[0])
        done, width = done + n, width * 4
    return done


def _match_back(codes: np.ndarray, i: int, j: int, start: int) -> int:
    """How many words before ``i`` and ``j`` > ``i`` are equal, not before ``start`` (of ``i``)."""
    done, width = 0, 64
    while i - done > start:
        n = min(width, i - done - start)
        differ = np.flatnonzero(codes[i - done - n : i - done] != codes[j - done - n : j - done])
        if len(differ):
            return done + n - 1 - int(differ[-1])
        done, width = done + n, width * 4
    return done


def find_runs(
    codes: np.ndarray, edges: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> dict[int, list[Run]]:
    """Runs by text: ``codes`` are the word codes of all texts, text t being
    ``codes[edges[t]:edges[t + 1]]``.  Starts count from the text's first word; sorted by
    start, then period."""
    if min_exponent < 3:
        raise ValueError("runs of fewer than 3 periods are not guaranteed an overlap of 2 periods")
    sizes = np.diff(edges)
    k = overlap = guaranteed_overlap(min_length, min_exponent)
    # Level k needs texts that can hold a run of its shortest period.
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.flatnonzero((sizes >= min_length)[text])
    text, width = text[place], 1
    grams = mix64(codes[place].astype(np.uint64) + _STEP)
    found: dict[int, list[Run]] = {}
    while len(place):
        while width < k:  # k-grams from their two halves, or two overlapping parts
            step = min(width, k - width)
            grams = mix64(grams[:-step] * _STEP + grams[step:] + np.uint64(width + step)) if len(grams) > step else grams[:0]
            inside = text[: len(grams)] == text[step : step + len(grams)]
            # A gram that leaves its text is of no use; its place keeps a value of its own.
            grams = np.where(inside, grams, mix64(place[: len(grams)].astype(np.uint64)))
            width += step
        low = 0 if k == overlap else k // 2
        at, lag = _seeds(grams, text[: len(grams)], k, low)
        _extend(codes, edges, place[at], lag, text[at], found, min_length, min_exponent)
        keep = sizes[text] >= max(min_length, min_exponent * (k + 1))  # the next level's shortest period
        if not keep.all():
            place, text = place[keep], text[keep]
            grams = grams[keep[: len(grams)]]
            # Whole texts are dropped, so neighbours in the array stay neighbours in a text.
        k *= 2
    return {t: sorted(runs, key=lambda r: (r[0], r[2])) for t, runs in found.items()}


def _extend(codes, edges, place, lag, text, found, min_length, min_exponent) -> None:
    """Extend the seeds to runs; ``found`` gets them by text."""
    if not len(place):
        return
    by = np.lexsort((place, lag, text))
    place, lag, text = place[by], lag[by], text[by]
    head = np.ones(len(place), dtype=bool)
    head[1:] = (place[1:] != place[:-1] + 1) | (lag[1:] != lag[:-1]) | (text[1:] != text[:-1])
    covered: dict[tuple[int, int], int] = {}  # (text, lag): the diagonal is known before this word
    for p, d, t in zip(place[head].tolist(), lag[head].tolist(), text[head].tolist()):
        if p < covered.get((t, d), -1):
            continue
        begin, stop = int(edges[t]), int(edges[t + 1])
        start = p - _match_back(codes, p, p + d, begin)
        end = p + d + _match_ahead(codes, p, p + d, stop)
        covered[t, d] = end - d
        if end - start >= max(min_length, min_exponent * d):
            found.setdefault(t, []).append((start - begin, end - start, d))


def strongest(runs: list[Run]) -> Run:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    best = runs[0]
    for r in runs[1:]:
        a, b = r[1] * best[2], best[1] * r[2]
        if a > b or (a == b and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Mask of the words that no run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


RUN_TYPE = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
)
_ARROW_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _per_batch(batch: pa.RecordBatch, min_length: int, min_exponent: int) -> Iterator[tuple[pa.RecordBatch, dict[int, list[Run]], np.ndarray]]:
    for part in slices(batch, 1, SLICE_ROWS, SLICE_BYTES):
        codes, edges = _codes(part.column(1))
        yield part, find_runs(codes, edges, min_length, min_exponent), np.diff(edges)


def runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    with_collapsed: bool = False,
) -> DataFrame:
    """Per row: id, ``n_words``, ``runs`` (array of start, length, period, by start and then period)
    and, if asked for, ``collapsed``: the kept words joined by one space."""
    ship_package(docs.sparkSession)
    names = ["n_words", "runs", *["collapsed"] * with_collapsed]
    names = [fresh_name(n, [id_col]) for n in names]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    for name, kind in zip(names, (T.LongType(), RUN_TYPE, T.StringType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found, sizes in _per_batch(batch, min_length, min_exponent):
                lists = [[dict(zip(("start", "length", "period"), r)) for r in found.get(t, [])] for t in range(part.num_rows)]
                arrays = [part.column(0), pa.array(sizes), pa.array(lists, _ARROW_RUN)]
                if with_collapsed:
                    texts = part.column(1).to_pylist()
                    arrays.append(pa.array([collapse(x, found.get(t, [])).decode() for t, x in enumerate(texts)], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("_text")).mapInArrow(run, schema)


def collapse(text: str | None, found: list[Run]) -> bytes:
    """The kept words of ``text`` joined by one space, in UTF-8."""
    words = (text or "").encode().split()  # bytes split at the six ASCII white-space characters only
    if found:
        words = compress(words, kept_words(len(words), found).tolist())
    return b" ".join(words)


def summarize(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """Per row: id, ``n_runs``, the strongest run (``start``, ``length``, ``period``, ``exponent_milli``; nulls
    without a run), ``runs_sha256`` (of ``start,length,period`` lines) and ``collapsed_sha256``."""
    ship_package(docs.sparkSession)
    longs = ["n_runs", "start", "length", "period", "exponent_milli"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    for name in longs:
        schema = schema.add(name, T.LongType())
    schema = schema.add("runs_sha256", T.StringType()).add("collapsed_sha256", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found, _ in _per_batch(batch, min_length, min_exponent):
                best = [strongest(found[t]) if t in found else (None,) * 3 for t in range(part.num_rows)]
                start, length, period = zip(*best) if best else ((), (), ())
                listed = ["".join(f"{a},{b},{c}\n" for a, b, c in found.get(t, [])) for t in range(part.num_rows)]
                texts = part.column(1).to_pylist()
                columns = [
                    [len(found.get(t, [])) for t in range(part.num_rows)],
                    start, length, period,
                    [None if p is None else 1000 * n // p for n, p in zip(length, period)],
                ]
                hashes = [
                    [hashlib.sha256(x.encode()).hexdigest() for x in listed],
                    [hashlib.sha256(collapse(x, found.get(t, []))).hexdigest() for t, x in enumerate(texts)],
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in columns], *[pa.array(h, pa.string()) for h in hashes]],
                    names=schema.fieldNames(),
                )

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("_text")).mapInArrow(run, schema)


def planted(id_col: Column, text: Column) -> Column:
    """``text`` with a loop in one of ten rows: with h = crc32 of the id's decimal digits,
    g = floor(h / 10) and n words, if h % 10 = 0 and n > 0, word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).  Other
    texts, and rows with a null id, stay as they are."""
    h = F.crc32(id_col.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def looped(words: Column) -> Column:
        n = F.size(words).cast("long")

        def at(gn: Column) -> Column:
            a, count = gn["g"] % gn["n"], gn["n"]
            p = F.lit(1) + F.floor((count - a) / (F.lit(3) + gn["g"] % 8))
            place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
            return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.get(words, place(i).cast("int"))), " ")

        # n is used many times: a one-element array names it once
        return F.transform(F.array(F.struct(g.alias("g"), n.alias("n"))), at)[0]

    split = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    new = F.transform(F.array(split), lambda words: F.when(F.size(words) > 0, looped(words)).otherwise(text))[0]
    return F.when((h % 10 == 0) & text.isNotNull(), new).otherwise(text)
