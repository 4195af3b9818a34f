"""Quality classifier: ordinal cumulative-link regression on hashed text.

Graded ratings 0 < 1 < ... < K-1 are modelled by one weight vector over hashed text
features, shared by all grades, and ordered thresholds:
P(grade <= k) = sigmoid(threshold_k - weights . features).  A document gets its
expected grade and the tail probability P(grade >= ``keep_from``); it is kept if
the tail probability is at least ``keep_at``.

Features are the distinct marks of a text's white-space words: the letters in lower
case, the run of other characters behind or before them, and whether it is all
capitals.  Marks of the whole text say which of the ``SHARES`` are reached by the
words in capitals, the words with other characters and the words that repeat the word
before them.  All are hashed into ``2**HASH_BITS`` places.

The fit uses a bounded sample: the ``sample_rows`` labelled rows with the smallest
hash.  Tasks turn their texts into features; the regression on this sample
runs on the driver.  Places that occur in fewer than ``MIN_DOCS`` sampled documents, or
in a smaller share of them than ``MIN_SHARE``, have weight 0.

Defined cases
- null, empty and blank texts have no features: the thresholds alone decide;
- labels with a null id or grade, or whose document is missing, are not used;
  repeated labels count as often as they occur;
- without usable labels every document gets null results and is kept;
- null ids are carried through, repeated rows are scored alike, an empty table
  gives an empty result;
- only (id, text) are read, so extra columns never clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import split_words
from faultline.llm.packing import slices
from faultline.session import ship_package

HASH_BITS = 20
MIN_DOCS, MIN_SHARE = 5, 0.00125
SAMPLE_ROWS = 16_000
SHARES = (0.02, 0.05, 0.1, 0.2, 0.4)
_PARTS = re.compile(r"^([\W\d_]*)(.*?)([\W\d_]*)$", re.S)


def _marks(word: str) -> list[str]:
    if word.isalpha():  # most words
        caps = len(word) > 1 and word.isupper()
        return ["w:" + word.lower(), "caps"] if caps else ["w:" + word.lower()]
    before, core, behind = _PARTS.match(word).groups()
    out = ["w:" + core.lower()] if core else []
    out += ["a:" + re.sub(r"\d", "0", before)[:16]] if before else []
    out += ["z:" + re.sub(r"\d", "0", behind)[:16]] if behind else []
    return out + ["caps"] if len(core) > 1 and core.isupper() else out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, place) pairs of a batch, sorted by document."""
    from xxhash import xxh32_intdigest

    codes, doc, vocab = split_words(texts)
    marks = [[xxh32_intdigest(m) >> (32 - HASH_BITS) for m in _marks(w)] for w in vocab.to_pylist()]
    n = np.fromiter(map(len, marks), np.int64, len(marks))
    flat = np.fromiter((p for ms in marks for p in ms), np.int64, int(n.sum()))
    first = np.cumsum(n) - n
    shape = np.zeros((2, len(vocab)), dtype=bool)
    for i, w in enumerate(vocab.to_pylist()):
        shape[0, i], shape[1, i] = len(w) > 1 and w.isupper(), not w.rstrip(".,").isalpha()
    repeats = np.zeros(len(codes), dtype=bool)
    repeats[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    n_words = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
    whole: list[np.ndarray] = []
    for kind, hit in (("caps", shape[0][codes]), ("other", shape[1][codes]), ("repeat", repeats)):
        share = np.bincount(doc, weights=hit, minlength=len(texts)) / n_words
        for least in SHARES:
            mark = xxh32_intdigest(f"{kind}>={least}") >> (32 - HASH_BITS)
            whole.append((np.flatnonzero(share >= least) << HASH_BITS) | mark)
    seen = np.unique((doc << 32) | codes)  # a word counts once per document
    doc, codes = seen >> 32, seen & 0xFFFFFFFF
    k = n[codes]
    place = flat[np.repeat(first[codes] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
    pairs = np.unique(np.concatenate(((np.repeat(doc, k) << HASH_BITS) | place, *whole)))
    return pairs >> HASH_BITS, pairs & ((1 << HASH_BITS) - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    places: np.ndarray  # sorted places with a weight
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def linear(self, doc: np.ndarray, place: np.ndarray, n_docs: int) -> np.ndarray:
        dense = np.zeros(1 << HASH_BITS)
        dense[self.places] = self.weights
        return np.bincount(doc, weights=dense[place], minlength=n_docs)

    def tails(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... per document."""
        return _sigmoid(eta[:, None] - self.thresholds[None, :])


def fit_ordinal(
    docs: list[np.ndarray], grades: np.ndarray, n_grades: int, l2: float = 0.02, rate: float = 0.05, steps: int = 200
) -> OrdinalModel:
    """Penalised maximum likelihood by Adam over the sampled documents' places."""
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    place = np.concatenate([np.empty(0, np.int32), *docs])
    places, counts = np.unique(place, return_counts=True)
    places = places[counts >= max(MIN_DOCS, MIN_SHARE * len(docs))]
    at = np.searchsorted(places, place)
    known = at < len(places)
    known[known] = places[at[known]] == place[known]
    doc, at = doc[known], at[known]
    n, p = len(docs), len(places)
    # thresholds start at the grades' log odds; the gaps between them stay positive
    below = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / n, 1e-3, 1 - 1e-3)
    start = np.log(below / (1 - below))
    theta = np.concatenate((np.zeros(p), start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, cut = theta[:p], np.concatenate((theta[p : p + 1], theta[p] + np.cumsum(np.exp(theta[p + 1 :]))))
        eta = np.bincount(doc, weights=w[at], minlength=n)
        edge = np.concatenate(([-np.inf], cut, [np.inf]))
        with np.errstate(over="ignore"):
            hi, lo = _sigmoid(edge[grades + 1] - eta), _sigmoid(edge[grades] - eta)
        hi[grades == n_grades - 1], lo[grades == 0] = 1.0, 0.0
        prob = np.maximum(hi - lo, 1e-9)
        g_eta = 1 - hi - lo  # of the negative log likelihood
        g_cut = np.zeros(n_grades - 1)
        np.add.at(g_cut, grades[grades < n_grades - 1], -(hi * (1 - hi) / prob)[grades < n_grades - 1])
        np.add.at(g_cut, grades[grades > 0] - 1, (lo * (1 - lo) / prob)[grades > 0])
        later = g_cut[::-1].cumsum()[::-1]  # each gap moves all cuts from it on
        grad = np.concatenate((np.bincount(at, weights=g_eta[doc], minlength=p) + l2 * n / 100 * w, later[:1], later[1:] * np.exp(theta[p + 1 :]))) / n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    cut = np.concatenate((theta[p : p + 1], theta[p] + np.cumsum(np.exp(theta[p + 1 :]))))
    return OrdinalModel(places, theta[:p], cut)


def fit(
    docs: DataFrame,
    ratings: DataFrame,
    n_grades: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 3,
) -> OrdinalModel | None:
    """Fit on the ``sample_rows`` ratings with the smallest hash of their id."""
    ship_package(docs.sparkSession)
    usable = ratings.filter(ratings[id_col].isNotNull() & ratings[grade_col].isNotNull())
    picked = (
        usable.select(ratings[id_col].alias("_rated"), ratings[grade_col].cast("int").alias("_grade"))
        .orderBy(F.xxhash64(F.lit(seed), "_rated"), "_rated", "_grade").limit(sample_rows)
    )  # bounded: sample_rows rows of an id and a grade
    texts = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text")).join(
        F.broadcast(picked), F.col("_id") == F.col("_rated")
    ).select("_grade", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 8192, 8 << 20):
                doc, place = features(part.column(1))
                lists = np.split(place.astype("<i4"), np.searchsorted(doc, np.arange(1, part.num_rows)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.tobytes() for x in lists], pa.binary())], names=["grade", "places"]
                )

    rows = texts.mapInArrow(run, "grade int, places binary").collect()  # the sample
    if not rows:
        return None
    rows.sort(key=lambda r: (r["grade"], r["places"]))
    grades = np.array([r["grade"] for r in rows], dtype=np.int64)
    return fit_ordinal([np.frombuffer(r["places"], "<i4") for r in rows], grades, n_grades)


def score(
    docs: DataFrame,
    model: OrdinalModel | None,
    keep_from: int,
    keep_at: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, ``expected_grade``, ``tail_prob`` (P(grade >= keep_from)), ``kept``."""
    ship_package(docs.sparkSession)
    if model is None:
        null = F.lit(None).cast("double")
        return docs.select(docs[id_col].alias(id_col), null.alias("expected_grade"), null.alias("tail_prob"), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**HASH_BITS weights
    schema = (
        T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
        .add("expected_grade", T.DoubleType()).add("tail_prob", T.DoubleType()).add("kept", T.BooleanType())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 8192, 8 << 20):
                doc, place = features(part.column(1))
                tails = shared.value.tails(shared.value.linear(doc, place, part.num_rows))
                tail = tails[:, keep_from - 1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= keep_at)],
                    names=schema.fieldNames(),
                )

    return docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text")).mapInArrow(run, schema)
