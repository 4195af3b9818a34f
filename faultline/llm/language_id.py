"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built from labelled text; it recognises
every substring of that text.  A document is parsed against each automaton into
longest matches: walk while the automaton has a transition, and where it has none
close the phrase and start the next one at the root.  The number of phrases,
normalised by length, estimates the cross entropy; the language that needs the
fewest wins.  Languages whose sample is smaller know fewer substrings, so
phrases are weighted with the log of the sample's length; a letter that the
sample does not have also costs the log of the number of symbols, so that a
language with a few letters of sample does not win by its small weight.

Every letter of the samples is a symbol of its own, however many there are.  The
transitions are kept sparsely, in a hash table without collisions, so a language
takes space by its sample and not by the alphabet.

Texts are read whole, as lower-case letters with every run of other characters
turned into one space.  They are parsed in blocks of ``BLOCK`` characters, each
block starting a new phrase for all languages alike, so that a task parses
thousands of blocks side by side with array operations.

The fit uses a bounded sample of the labelled rows.  Every labelled text with a
letter may be drawn, whatever its length; of a longer one the first ``MAX_CHARS``
characters.  Rows are drawn by a hash, for each language about ``sample_rows`` or,
where texts are short, as many as hold about twice ``sample_chars`` characters.
Then texts are taken up to ``sample_chars`` characters in hash order, whole ones
before the starts of longer ones.  The automata follow from the sample; their size
is bounded by it (below 2 * ``sample_chars`` states a language).  The sample is
sent to the tasks, and each Python worker builds the automata once.

Defined cases
- null text, or text without a letter: ``und`` with score 0;
- ties go to the language that comes first by code point;
- no labelled rows: every document is ``und`` with score 0;
- null labels and labelled texts without a letter are not learned; repeated rows are predicted alike;
- an empty table gives an empty result;
- only id, text and (for the fit) the label are read, so extra columns never
  clash; a prediction sees the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import fresh_name
from faultline.llm.packing import slices
from faultline.session import ship_package

UNDETERMINED = "und"
SAMPLE_ROWS = 300
SAMPLE_CHARS = 120_000
MAX_CHARS = 8_000  # of a labelled text
BLOCK = 512  # characters parsed in one run
LANES = 2048  # blocks parsed side by side
_MIX = np.uint64(0x9E3779B97F4A7C15)  # spreads keys over the high bits


# -- text to symbols -----------------------------------------------------------------
def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; everything but letters is 32, runs of it once."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    cp = np.where(_is_letter(cp), cp, np.uint32(32))
    keep = np.ones(len(cp), dtype=bool)
    keep[1:] = (cp[1:] != 32) | (cp[:-1] != 32)
    return cp[keep]


_LETTER = np.array([chr(i).isalpha() for i in range(0x10000)])


def _is_letter(cp: np.ndarray) -> np.ndarray:
    low = _LETTER[np.minimum(cp, 0xFFFF)]
    high = cp > 0xFFFF
    if high.any():
        low = low.copy()
        low[high] = [chr(c).isalpha() for c in cp[high].tolist()]
    return low


# -- automata --------------------------------------------------------------------------
def suffix_automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of ``symbols``: from state (0: the root), by
    symbol, to state."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    state = np.repeat(np.arange(len(nxt)), [len(d) for d in nxt])
    by = np.fromiter((c for d in nxt for c in d), np.int64, len(state))
    to = np.fromiter((t for d in nxt for t in d.values()), np.int64, len(state))
    return state, by, to


class _Parser:
    """Transitions of an automaton with the restart folded in.

    States are carried times the number of symbols, so state + symbol is a
    transition's key.  A key's bucket (its mixed high bits) names an odd
    multiplier under which the bucket's keys fall on free slots: one look tells
    whether the transition is there.  Where it is not, a phrase starts with the
    symbol.  The root (0) has no entries: it is left by starting a phrase, and is
    only met at the start and after a symbol that the sample does not have, which
    is a phrase of its own."""

    def __init__(self, symbols: list[int], width: int) -> None:
        state, by, to = suffix_automaton(symbols)
        state, by, to = (x[by > 0] for x in (state, by, to))  # symbol 0 never continues a match
        root = state == 0
        self.restart = np.zeros(width, dtype=np.int64)  # where a phrase that starts with the symbol leads
        self.restart[by[root]] = to[root] * width
        self._place(state[~root] * width + by[~root], to[~root] * width)

    def _place(self, keys: np.ndarray, to: np.ndarray) -> None:
        bits = max(int(2 * len(keys)).bit_length(), 3)
        slot_shift, bucket_shift = np.uint64(64 - bits), np.uint64(64 - bits + 2)
        mixed = keys.astype(np.uint64) * _MIX
        bucket = (mixed >> bucket_shift).astype(np.int64)
        self.slot_shift, self.bucket_shift = slot_shift, bucket_shift
        self.odd = np.ones(1 << (bits - 2), dtype=np.uint64)
        self.keys = np.full(1 << bits, -1)  # -1: free
        self.to = np.zeros(1 << bits, dtype=np.int64)
        r = np.random.default_rng(17)
        size = np.bincount(bucket, minlength=len(self.odd))
        for n in range(int(size.max(initial=0)), 0, -1):  # the largest buckets while most slots are free
            left = np.flatnonzero(size[bucket] == n)
            while len(left):
                b = bucket[left]
                odd = r.integers(0, 2**63, len(self.odd), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                slot = ((mixed[left] * odd[b]) >> slot_shift).astype(np.int64)
                claim = np.zeros(len(self.keys), dtype=np.int64)
                claim[slot] = keys[left]
                bad = (claim[slot] != keys[left]) | (self.keys[slot] >= 0)
                failed = np.bincount(b[bad], minlength=len(self.odd)) > 0
                ok = ~failed[b]
                self.keys[slot[ok]], self.to[slot[ok]] = keys[left[ok]], to[left[ok]]
                self.odd[b[ok]] = odd[b[ok]]
                left = left[~ok]

    def step(self, state: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and where a phrase starts."""
        key = state + codes
        mixed = key.view(np.uint64) * _MIX
        mixed *= self.odd.take((mixed >> self.bucket_shift).view(np.int64))
        mixed >>= self.slot_shift
        slot = mixed.view(np.int64)
        starts = self.keys.take(slot) != key
        return np.where(starts, self.restart.take(codes), self.to.take(slot)), starts


@dataclass
class Model:
    """Labelled sample texts by language, and what follows from them."""

    samples: dict[str, list[str]]
    languages: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.languages = sorted(self.samples)

    def build(self) -> "Model":
        texts = {lang: [_letters(t) for t in self.samples[lang]] for lang in self.languages}
        every = np.concatenate([np.empty(0, np.uint32), *[t for ts in texts.values() for t in ts]])
        letters = np.unique(every[every != 32])
        self.symbol = np.zeros(0x110000, dtype=np.int32)  # 0: no sample has it; 1: space; 2..: letters
        self.symbol[32] = 1
        self.symbol[letters] = np.arange(2, 2 + len(letters))
        self.parsers, self.weight, self.literal = [], [], np.log2(2 + len(letters))
        for lang in self.languages:
            joined: list[int] = []
            for t in texts[lang]:
                joined += self.symbol[t].tolist() + [0]  # symbol 0 parts the texts
            self.parsers.append(_Parser(joined, 2 + len(letters)))
            self.weight.append(np.log2(max(len(joined), 2)))
        return self

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per (text, language) and symbols per text (0: no letter)."""
        phrases, _, sizes = self._parse(texts)
        return phrases, sizes

    def _parse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases and symbols that the language's sample does not have, both per (text,
        language), and symbols per text (0: no letter)."""
        symbols = [self.symbol[_letters(t or "")] for t in texts]
        has_letter = np.fromiter((any(map(str.isalpha, t or "")) for t in texts), bool, len(texts))
        sizes = np.where(has_letter, np.fromiter(map(len, symbols), np.int64, len(texts)), 0)
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        flat = np.concatenate([np.empty(0, np.int32), *[s for s, n in zip(symbols, sizes) if n]])
        absent = np.zeros_like(out)
        ends = np.cumsum(sizes)
        for j, parser in enumerate(self.parsers):
            upto = np.append(0, np.cumsum(parser.restart.take(flat) == 0))
            absent[:, j] = upto[ends] - upto[ends - sizes]
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.repeat(np.cumsum(sizes) - sizes, blocks) + BLOCK * (
            np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        )
        length = np.minimum(BLOCK, np.repeat(np.cumsum(sizes), blocks) - first)
        order = np.argsort(-length, kind="stable")  # longest first: the lanes still running come first
        padded = np.concatenate((flat, np.zeros(BLOCK, np.int32)))
        for a in range(0, len(order), LANES):
            lanes = order[a : a + LANES]
            n = length[lanes]
            codes = padded[first[lanes][:, None] + np.arange(n[0])[None, :]].T.astype(np.int64, order="C")
            running = np.searchsorted(-n, -np.arange(n[0]), side="left")  # lanes longer than the position
            for j, parser in enumerate(self.parsers):
                state = np.zeros(len(lanes), dtype=np.int64)
                count = np.zeros(len(lanes), dtype=np.int32)
                for i in range(int(n[0])):
                    r = running[i]
                    state[:r], starts = parser.step(state[:r], codes[i, :r])
                    count[:r] += starts
                out[:, j] += np.bincount(owner[lanes], weights=count, minlength=len(texts)).astype(np.int64)
        return out, absent, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (1 - phrases of the best / of the second) per text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        phrases, absent, sizes = self._parse(texts)
        cost = phrases * np.asarray(self.weight)[None, :] + absent * self.literal
        best = cost.argmin(axis=1)
        if len(self.languages) > 1:
            two = np.partition(cost, 1, axis=1)[:, :2]
            score = 1 - two[:, 0] / np.maximum(two[:, 1], 1e-9)
        else:
            score = np.ones(len(texts))
        known = sizes > 0
        langs = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
        return langs, np.where(known, score, 0.0)


# -- Spark --------------------------------------------------------------------------------
def fit(
    docs: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
    seed: int = 5,
) -> Model:
    """Sample labelled rows (where ``train`` holds).  What reaches the driver is about
    ``sample_rows`` texts of at most ``MAX_CHARS`` characters per language, or twice
    ``sample_chars`` characters where that is more."""
    h = F.pmod(F.xxhash64(F.lit(seed), docs[id_col], docs[text_col]), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = docs.filter(docs[lang_col].isNotNull() & (F.lit(True) if train is None else train)).select(
        docs[lang_col].cast("string").alias("lang"),
        F.substring(docs[text_col], 1, MAX_CHARS).alias("text"),
        (F.length(docs[text_col]) > MAX_CHARS).alias("cut"),
        h.alias("h"),
    ).filter(F.col("text").rlike("\\p{L}"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()  # one row per language
    if not sizes:
        return Model({})
    shares = {r["lang"]: min(1.0, max(sample_rows / r["n"], 2 * sample_chars / r["chars"])) for r in sizes}
    share = F.create_map(*[x for lang, part in shares.items() for x in (F.lit(lang), F.lit(part))])
    picked = rows.filter(F.col("h") < F.element_at(share, F.col("lang"))).collect()
    samples: dict[str, list[str]] = {}
    left = dict.fromkeys(shares, sample_chars)
    for r in sorted(picked, key=lambda r: (r["lang"], r["cut"], r["h"], r["text"])):
        if left[r["lang"]] > 0:
            samples.setdefault(r["lang"], []).append(r["text"])
            left[r["lang"]] -= len(r["text"])
    return Model(samples)


_BUILT: dict[str, Model] = {}


def _built(key: str, samples: dict[str, list[str]]) -> Model:
    """The worker's model, built once and kept for the tasks that follow."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Model(samples).build()
    return _BUILT[key]


def predict(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    out_cols: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """id, ``lang_pred``, ``score``; with ``carry`` all columns of ``docs`` instead of the id
    (``out_cols`` must then be new names)."""
    import uuid

    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model.samples)  # bounded by the fit's parameters
    key = uuid.uuid4().hex
    names = docs.columns if carry else [id_col]
    schema = T.StructType([docs.schema[c] for c in names])
    schema = schema.add(out_cols[0], T.StringType()).add(out_cols[1], T.DoubleType())
    text_at = names.index(text_col) if carry else len(names)
    sent = docs.select(*[docs[c] for c in names], *([] if carry else [docs[text_col].alias("_text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_at, 8192, 8 << 20):
                langs, score = _built(key, shared.value).predict(part.column(text_at).to_pylist())
                arrays = [part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=schema.fieldNames()
                )

    return sent.mapInArrow(run, schema)


def keep_determined(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is determined, with the columns of ``docs``."""
    names = [fresh_name(c, docs.columns) for c in ("lang_pred", "score")]
    judged = predict(docs, model, id_col, text_col, carry=True, out_cols=tuple(names))
    return judged.filter(F.col(names[0]) != UNDETERMINED).drop(*names)
