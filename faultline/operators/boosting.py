"""Second-order boosted trees with a default direction for missing values.

Binary classification with logistic loss, regularised as the common gradient-boosting
libraries are: a row's gradient is ``g = p - y`` and its Hessian ``h = p (1 - p)``; a split's gain is
``GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda)``, a leaf's weight
``-G / (H + lambda) * learning_rate``.  Rows that miss the split's feature go to the side that gains
more.

How it runs on Spark:

- Feature values are replaced once by their bins between quantile cuts (one byte string a
  row), and the binned rows are written.
- Each level of the trees is one pass: a task adds up gradients and Hessians per (model,
  node, feature, bin) over its rows, so that what is shuffled follows the number of cells, not
  of rows.  The cells of a node and feature meet in one task, which finds their best split.
  Only the best split of each node reaches the driver.
- Several models (candidates of a search, each on all rows but one fold's) are grown in
  the same passes.
- Gradients are summed as integers of 2^-24, so sums, and with them the trees, do not depend on how
  the rows are partitioned or in which order tasks end.
- Margins are kept with the rows: every ``WRITE_EVERY`` trees the rows are written again with
  the margins so far; in between a task adds the newest trees' leaves on the way.

Ties between splits go to the smaller feature, then the smaller cut, then default right.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.scaling import exact_quantiles
from faultline.session import shared_table, ship_package, shuffle_partitions

SCALE = 1 << 24
WRITE_EVERY = 8
MIN_GAIN = 1e-6
MISSING_BIN = 255

DEFAULTS = {
    "n_estimators": 100,
    "learning_rate": 0.3,
    "max_depth": 6,
    "reg_lambda": 1.0,
    "gamma": 0.0,
    "min_child_weight": 1.0,
    "max_bins": 64,
}


@dataclass
class Tree:
    """Nodes by heap number (root 1, children 2i and 2i + 1): ``split`` has
    ``(feature, cut number, default left)`` of inner nodes, ``leaf`` the weights."""

    split: dict[int, tuple[int, int, bool]] = field(default_factory=dict)
    leaf: dict[int, float] = field(default_factory=dict)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row of ``bins`` is, so far."""
        at = np.ones(len(bins), dtype=np.int64)
        frontier = [1] if 1 in self.split else []
        while frontier:
            below = []
            for node in frontier:
                f, cut, left = self.split[node]
                rows = np.flatnonzero(at == node)
                b = bins[rows, f]
                goes_left = np.where(b == MISSING_BIN, left, b < cut)
                at[rows] = 2 * node + ~goes_left
                below += [c for c in (2 * node, 2 * node + 1) if c in self.split]
            frontier = below
        return at

    def weights(self, bins: np.ndarray) -> np.ndarray:
        at = self.nodes(bins)
        known = np.array(sorted(self.leaf), dtype=np.int64)
        value = np.array([self.leaf[n] for n in known.tolist()])
        return value[np.searchsorted(known, at)]

    def to_json(self) -> str:
        return json.dumps({"split": self.split, "leaf": self.leaf})

    @classmethod
    def from_json(cls, text: str) -> "Tree":
        t = json.loads(text)
        split = {int(n): (int(f), int(c), bool(left)) for n, (f, c, left) in t["split"].items()}
        return cls(split, {int(n): w for n, w in t["leaf"].items()})


@dataclass
class BoostedTrees:
    """A fitted model: the cuts of each feature, the trees, and the margin they start from."""

    features: list[str]
    cuts: list[list[float]]
    trees: list[Tree]
    start: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margin of each row of ``x`` (NaN: missing); above 0 means class 1."""
        bins = to_bins(x, self.cuts)
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += t.weights(bins)
        return out

    def predict(self, df: DataFrame, out: str = "prediction", probability: str | None = None) -> DataFrame:
        """``df`` with hard 0/1 predictions (and the probability of class 1, if asked for)."""
        ship_package(df.sparkSession)
        nan = F.lit(float("nan"))
        x = F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in self.features])
        keep = df.schema.fields
        names = [f.name for f in keep]
        width, model = len(self.features), self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                m = model.margins(b.column("_fl_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)) if b.num_rows else np.empty(0)
                arrays = [b.column(n) for n in names] + [pa.array((m > 0).astype(np.int32))]
                if probability:
                    arrays.append(pa.array(1.0 / (1.0 + np.exp(-m))))
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, out, *[probability] * bool(probability)])

        schema = T.StructType([*keep, T.StructField(out, T.IntegerType())])
        if probability:
            schema = schema.add(probability, T.DoubleType())
        return df.withColumn("_fl_x", x).mapInArrow(run, schema)

    def rows(self) -> list[tuple]:
        """One row per node: tree, node, feature, cut (infinite beyond the last), default left, weight."""
        out = []
        for i, t in enumerate(self.trees):
            for node, (f, cut, left) in t.split.items():
                value = self.cuts[f][cut - 1] if cut <= len(self.cuts[f]) else math.inf
                out.append((i, node, self.features[f], cut, value, left, None))
            out += [(i, node, None, None, None, None, w) for node, w in t.leaf.items()]
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        """The trees as a table, one row per node (bounded by trees and depth)."""
        schema = "tree int, node long, feature string, cut_no int, cut double, default_left boolean, weight double"
        return spark.createDataFrame(self.rows(), schema)


def to_bins(x: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin of each value: the number of cuts not above it; ``MISSING_BIN`` for NaN."""
    out = np.empty(x.shape, dtype=np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.searchsorted(np.asarray(c), x[:, f], side="right")
    out[np.isnan(x)] = MISSING_BIN
    return out


def quantile_cuts(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Distinct inner quantiles of each feature: at most ``max_bins - 1`` values per feature reach the driver."""
    if not 2 <= max_bins < MISSING_BIN:
        raise ValueError(f"max_bins must lie in 2 .. {MISSING_BIN - 1}")
    q = exact_quantiles(df, features, [i / max_bins for i in range(1, max_bins)])
    by: dict[str, set[float]] = {c: set() for c in features}
    for r in q.collect():
        if r["value"] is not None:
            by[r["column"]].add(r["value"])
    return [sorted(by[c]) for c in features]


@dataclass
class Spec:
    """One model to grow: parameters, and the fold it does not learn from (None: all rows)."""

    params: Mapping
    hold_out: int | None = None

    def get(self, name: str):
        return self.params.get(name, DEFAULTS[name])


def fit_many(df: DataFrame, features: Sequence[str], label_col: str, specs: Sequence[Spec], fold_col: str | None = None) -> list[BoostedTrees]:
    """Models of ``specs``, grown together.  ``label_col`` holds 0 and 1.  The bins, which know no
    labels, come from all rows, those of held-out folds included."""
    spark, feats = df.sparkSession, list(features)
    ship_package(spark)
    bins = {s.get("max_bins") for s in specs}
    if len(bins) != 1:
        raise ValueError("models grown together share max_bins")
    for s in specs:
        if s.get("reg_lambda") < 0 or s.get("max_depth") < 1:
            raise ValueError("reg_lambda must not be negative and max_depth must be 1 or more")
    cuts = quantile_cuts(df, feats, bins.pop())
    data = _binned(df, feats, label_col, fold_col, cuts, len(specs))
    written = [0] * len(specs)  # trees whose leaves are in the written margins
    models = [BoostedTrees(feats, cuts, []) for _ in specs]
    for t in range(max(s.get("n_estimators") for s in specs)):
        growing = [i for i, s in enumerate(specs) if t < s.get("n_estimators")]
        for i in growing:
            models[i].trees.append(Tree())
        nodes = {i: [1] for i in growing}
        for depth in range(max(specs[i].get("max_depth") for i in growing) + 1):
            active = {i: n for i, n in nodes.items() if n}
            if not active:
                break
            best = _best_splits(data, models, specs, active, written, len(feats))
            nodes = {}
            for i, own in active.items():
                tree, s = models[i].trees[-1], specs[i]
                nodes[i] = []
                for node in own:
                    found = best.get((i, node))
                    g, h = (found["g"], found["h"]) if found else (0, 0)
                    gain = found["gain"] if found else None
                    if depth < s.get("max_depth") and gain is not None and gain > max(s.get("gamma"), MIN_GAIN):
                        tree.split[node] = (found["feature"], found["cut"], found["left"])
                        nodes[i] += [2 * node, 2 * node + 1]
                    else:
                        tree.leaf[node] = -(g / SCALE) / (h / SCALE + s.get("reg_lambda")) * s.get("learning_rate") if h else 0.0
        if (t + 1) % WRITE_EVERY == 0:
            data = _with_margins(data, models, written)
            written = [len(m.trees) for m in models]
    return models


def fit(df: DataFrame, features: Sequence[str], label_col: str, params: Mapping | None = None) -> BoostedTrees:
    return fit_many(df, features, label_col, [Spec(dict(params or {}))])[0]


def _binned(df: DataFrame, feats: list[str], label_col: str, fold_col: str | None, cuts: list[list[float]], n_models: int) -> DataFrame:
    """Written rows: ``bins`` (a byte per feature), ``y``, ``fold`` and ``margin`` (one per model)."""
    nan = F.lit(float("nan"))
    x = F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in feats])
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(-1)
    width = len(feats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = to_bins(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width), cuts) if b.num_rows else []
            margin = pa.array([[0.0] * n_models] * b.num_rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in m], pa.binary()), b.column("y"), b.column("fold"), margin], names=["bins", "y", "fold", "margin"]
            )

    narrow = df.select(x.alias("x"), F.col(label_col).cast("int").alias("y"), fold.alias("fold"))
    return shared_table(narrow.mapInArrow(run, "bins binary, y int, fold int, margin array<double>"), "binned")


def _batch(b: pa.RecordBatch, models: list[BoostedTrees], written: list[int], upto: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bins and margins of a batch, with the trees that the written margins lack."""
    bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(b.num_rows, -1)
    margin = b.column("margin").flatten().to_numpy().reshape(b.num_rows, len(models)).copy()
    for i, m in enumerate(models):
        for tree in m.trees[written[i] : upto[i]]:
            margin[:, i] += tree.weights(bins)
    return bins, margin


def _with_margins(data: DataFrame, models: list[BoostedTrees], written: list[int]) -> DataFrame:
    upto = [len(m.trees) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, margin = _batch(b, models, written, upto)
                edges = np.arange(b.num_rows + 1, dtype=np.int32) * len(models)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(margin.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("bins"), b.column("y"), b.column("fold"), lists], names=["bins", "y", "fold", "margin"])

    return shared_table(data.mapInArrow(run, data.schema), "binned")


def _best_splits(
    data: DataFrame, models: list[BoostedTrees], specs: Sequence[Spec], active: dict[int, list[int]], written: list[int], width: int
) -> dict[tuple[int, int], dict]:
    """For each active node: its sums ``g`` and ``h`` and its best split, by one pass over the rows."""
    slot = {(i, n): k for k, (i, n) in enumerate((i, n) for i, own in active.items() for n in own)}
    upto = [len(m.trees) - (i in active) for i, m in enumerate(models)]
    held = [s.hold_out for s in specs]
    cells = 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(slot) * width * cells), dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            bins, margin = _batch(b, models, written, upto)
            y, fold = b.column("y").to_numpy(), b.column("fold").to_numpy()
            for i, own in active.items():
                p = 1.0 / (1.0 + np.exp(-margin[:, i]))
                g = np.rint((p - y) * SCALE).astype(np.int64)
                h = np.rint(p * (1.0 - p) * SCALE).astype(np.int64)
                at = models[i].trees[-1].nodes(bins)
                place = np.full(max(own) + 1, -1, dtype=np.int64)
                place[own] = [slot[i, n] for n in own]
                row = np.where(at <= max(own), place[np.minimum(at, max(own))], -1)
                use = np.flatnonzero((row >= 0) & (fold != held[i] if held[i] is not None else True))
                cell = (row[use, None] * width + np.arange(width)[None, :]) * cells + bins[use]
                for k, v in enumerate((g, h)):
                    np.add.at(sums[k], cell.ravel(), np.repeat(v[use], width))
        some = np.flatnonzero(sums[1])
        rest, bin_no = np.divmod(some, cells)
        node, feature = np.divmod(rest, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (node, feature, bin_no, sums[0][some], sums[1][some])], names=["slot", "feature", "bin", "g", "h"]
        )

    per_task = data.mapInArrow(run, "slot long, feature long, bin long, g long, h long")
    limits = {slot[i, n]: (float(specs[i].get("reg_lambda")), float(specs[i].get("min_child_weight"))) for i, own in active.items() for n in own}
    splits = best_split_rows(per_task, limits)
    names = {k: name for name, k in slot.items()}
    return {names[r["slot"]]: r.asDict() for r in splits.collect()}  # one row per node


def best_split_rows(cells: DataFrame, limits: dict[int, tuple[float, float]]) -> DataFrame:
    """Per ``slot``: ``g``, ``h``, and of its best split ``gain`` (null: none), ``feature``, ``cut``, ``left``.

    One shuffle brings the cells of a node and feature together; ``limits`` has lambda and the
    least Hessian of each node."""
    lam_of = np.array([limits[k][0] for k in range(len(limits))])
    least_of = np.array([limits[k][1] for k in range(len(limits))])

    def best(slot, feature, bins, g, h) -> pa.RecordBatch:
        order = np.lexsort((bins, feature, slot))
        slot, feature, bins, g, h = (v[order] for v in (slot, feature, bins, g, h))
        head = np.flatnonzero(np.append(True, (slot[1:] != slot[:-1]) | (feature[1:] != feature[:-1]) | (bins[1:] != bins[:-1])))
        g, h = np.add.reduceat(g, head), np.add.reduceat(h, head)  # cells of several tasks
        slot, feature, bins = slot[head], feature[head], bins[head]
        start = np.flatnonzero(np.append(True, (slot[1:] != slot[:-1]) | (feature[1:] != feature[:-1])))
        size = np.diff(np.append(start, len(slot)))
        lam, least, gone = lam_of[slot], least_of[slot], bins == MISSING_BIN

        def spread(v):
            """Sum of the node and feature, running sum, and sum of the rows that miss the feature."""
            run = np.cumsum(v)
            before = np.repeat(run[start] - v[start], size)
            missing = np.repeat(np.add.reduceat(np.where(gone, v, 0), start), size)
            return np.repeat(np.add.reduceat(v, start), size), (run - before) / SCALE, missing / SCALE

        (gs, gl, gm), (hs, hl, hm) = spread(g), spread(h)
        found = []
        for left in (False, True):
            a, b = (gl + gm, hl + hm) if left else (gl, hl)
            c, d = gs / SCALE - a, hs / SCALE - b
            ok = ~gone & (b >= least) & (d >= least) & (b > 0) & (d > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = a * a / (b + lam) + c * c / (d + lam) - (gs / SCALE) * (gs / SCALE) / (hs / SCALE + lam)
            found.append((slot[ok], gain[ok], feature[ok], bins[ok] + 1, np.full(int(ok.sum()), left)))
        own, gain, f, cut, left = (np.concatenate(v) for v in zip(*found))
        by = np.lexsort((left, cut, f, -gain, own))
        by = by[np.append(True, own[by][1:] != own[by][:-1])] if len(by) else by
        slots, at = np.unique(slot, return_index=True)
        where = np.searchsorted(slots, own[by])
        gains, fs, cuts, lefts = (np.zeros(len(slots), dtype=t) for t in (np.float64, np.int64, np.int64, bool))
        gains[where], fs[where], cuts[where], lefts[where] = gain[by], f[by], cut[by], left[by]
        none = np.ones(len(slots), dtype=bool)
        none[where] = False
        split = [pa.array(v, mask=none) for v in (-gains, fs, cuts, lefts)]
        return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(gs[at]), pa.array(hs[at]), *split], names=_SPLIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            t = pa.Table.from_batches(rows)
            yield best(*(t.column(c).to_numpy() for c in ("slot", "feature", "bin", "g", "h")))

    dealt = cells.repartition(shuffle_partitions(cells.sparkSession), "slot", "feature")
    per = dealt.mapInArrow(run, "slot long, g long, h long, minus double, feature long, cut long, left boolean")
    first = F.min(F.when(F.col("minus").isNotNull(), F.struct("minus", "feature", "cut", "left"))).alias("s")
    out = per.groupBy("slot").agg(F.max("g").alias("g"), F.max("h").alias("h"), first)
    return out.select("slot", "g", "h", (-F.col("s.minus")).alias("gain"), F.col("s.feature").alias("feature"), F.col("s.cut").alias("cut"), F.col("s.left").alias("left"))


_SPLIT = ["slot", "g", "h", "minus", "feature", "cut", "left"]
