"""Similarity self-join on word n-grams (Jaccard) with Bayesian candidate pruning.

1. Every text becomes its set of distinct n-gram hashes (64 bits), 128 MinHash
   values, and a class key (128-bit hash of the set).  Texts with the same set
   are one class; from here on one representative stands for all of them.
2. Representatives are bucketed by 32 bands of 4 MinHash values.  A pair with
   similarity 0.8 misses all bands with probability (1 - 0.8**4)**32 = 5e-8.
   Buckets of one are dropped before signatures are sent anywhere.
3. In each bucket the pairs compare their MinHash values (8 bits of each) step
   by step.  After n values with m matches, the pair is dropped once the
   posterior probability of reaching the threshold (uniform prior) is below
   ``tolerance``.  By the binomial law a pair at 0.8 is pruned with probability
   5.6e-9, in all buckets alike, so bands and pruning together lose 5.3e-8 of
   such pairs.  A bucket reports a spanning forest of its surviving pairs,
   never the pairs.  A large bucket is cut into blocks: first each block reports its
   forest; then pairs of blocks compare only members that those forests, taken over all
   buckets, have not connected yet, and report only what connects them.
4. Connected components of those forests bring possible partners together.
   Inside a component all pairs are verified exactly on their sets, block
   against block; each block pair reports link counts and a spanning forest.
5. Components of the verified links are the near-duplicate classes.

Buckets and components of any size are cut into blocks of bounded size and
handled as block pairs, so a large group is spread over many tasks and no task
holds more than two blocks.  No step emits rows in number of pairs.

Defined cases
- words are maximal runs of non-white-space; texts of 1 to n-1 words have one
  n-gram, the whole text's words;
- null, empty and blank texts have no n-grams: no links, classes of their own;
- rows that repeat an id or a text count as documents of their own;
- a null id is carried through; a class of null ids only has a null class id;
- an empty table gives an empty result;
- only (id, text) are read by the join, so extra columns never clash;
  ``keep_one`` returns the input's columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import materialize, ngram_hashes, split_words, word_hashes
from faultline.llm.packing import slices
from faultline.session import ship_package, shuffle_partitions

NGRAM = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
TOLERANCE = 1e-9  # pruning then loses less than the bands
STEPS = (16, 32, 64, 96, 128)
BUCKET_BLOCK = 2048  # members of a bucket compared with one another in a task
VERIFY_BLOCK = 256
VERIFY_BYTES = 8 << 20  # text of one block
EDGE_ROWS = 8192  # edges worth a task and a file
EDGE_TASKS = 8  # tasks for fewer edges


# -- sets and signatures -----------------------------------------------------------------
def ngram_sets(texts: pa.Array, n: int = NGRAM) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    codes, doc, vocab = split_words(texts)
    words = word_hashes(vocab)[codes] if len(vocab) else np.empty(0, np.uint64)
    grams, owner = ngram_hashes(words, doc, n)
    count = np.bincount(doc, minlength=len(texts))
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    first = np.cumsum(count) - count
    out = []
    for i in range(len(texts)):
        if count[i] >= n:
            out.append(np.unique(grams[edges[i] : edges[i + 1]]))
        elif count[i]:
            k = int(count[i])
            out.append(ngram_hashes(words[first[i] : first[i] + k], np.zeros(k, np.int64), k)[0] + np.uint64(k))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    return r.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1), r.integers(0, 2**32, HASHES, dtype=np.uint32)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """(set, HASHES) MinHash values; sets must not be empty."""
    a, b = _permutations()
    out = np.empty((len(sets), HASHES), dtype=np.uint32)
    i = 0
    while i < len(sets):  # runs of sets of about 2**17 values
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= 1 << 17):
            total += len(sets[j])
            j += 1
        flat = np.concatenate(sets[i:j])
        x = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[i : j - 1]])
        for k in range(HASHES):
            out[i:j, k] = np.minimum.reduceat(x * a[k] + b[k], starts)
        i = j
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """(set, BANDS) 64-bit keys of the bands."""
    v = values.reshape(len(values), BANDS, BAND_ROWS).astype(np.uint64)
    keys, _ = ngram_hashes(v.ravel(), np.repeat(np.arange(v.shape[0] * BANDS), BAND_ROWS), BAND_ROWS)
    return (keys.reshape(len(values), BANDS) * np.uint64(BANDS * 2 + 1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, others: tuple[str, ...] = ()) -> DataFrame:
    """Written table: ``row``, the input's columns as ``c0`` (id), ``c1`` (text), ``c2`` ..., and
    ``cls``, ``sig``, ``bands``; rows without n-grams have null ``cls``."""
    from xxhash import xxh3_128_digest

    ship_package(docs.sparkSession)
    names = [id_col, text_col, *others]
    schema = T.StructType(
        [
            *[T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(names)],
            T.StructField("cls", T.BinaryType()),
            T.StructField("sig", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 8192, 8 << 20):
                sets = ngram_sets(part.column(1))
                full = [i for i, s in enumerate(sets) if len(s)]
                values = minhashes([sets[i] for i in full])
                keys = band_keys(values)
                low = (values & np.uint32(255)).astype(np.uint8)
                cls, sig, bands = [[None] * len(sets) for _ in range(3)]
                for k, i in enumerate(full):
                    cls[i], sig[i], bands[i] = xxh3_128_digest(sets[i].tobytes()), low[k].tobytes(), keys[k]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cls, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=schema.fieldNames(),
                )

    rows = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)]).mapInArrow(run, schema)
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "signatures")


# -- Bayesian pruning --------------------------------------------------------------------
def min_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, bits: int = 8) -> list[int]:
    """For each of STEPS, the least number of matches at which the posterior
    probability of similarity >= threshold is at least ``tolerance``.

    Two 8-bit values match with probability s + (1 - s) / 256 at similarity s; the
    prior over s is uniform."""
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 2**bits
    out = []
    for n in STEPS:
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            like = np.exp(log - log.max())
            if like[s >= threshold].sum() >= tolerance * like.sum():
                out.append(m)
                break
    return out


def surviving(sig: np.ndarray, one: int, others: np.ndarray, need: list[int]) -> np.ndarray:
    """Which of ``others`` are still candidates of ``one`` after all steps."""
    matches = np.zeros(len(others), dtype=np.int32)
    done = 0
    for upto, least in zip(STEPS, need):
        matches += (sig[others, done:upto] == sig[one, done:upto]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        if not keep.all():
            others, matches = others[keep], matches[keep]
            if not len(others):
                return others
        done = upto
    return others


class _Forest:
    """Connected components of a small index set; labels are smallest members."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, one: int, others: np.ndarray) -> None:
        found = np.unique(np.append(self.label[others], self.label[one]))
        if len(found) > 1:
            self.label[np.isin(self.label, found[1:])] = found[0]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal ``keys`` of a sorted stream, one table per key."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        if not t.num_rows:
            continue
        change = np.zeros(t.num_rows - 1, dtype=bool)
        for k in keys:
            v = t.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), t.num_rows]
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield t.slice(a, b - a)
        rest = t.slice(cuts[-2])
    if rest is not None and rest.num_rows:
        yield rest


def _own_block(n_blocks: Column) -> Column:
    """The block of a member, by a hash of the row alone: in buckets of about one size the same
    members meet again, in order of their rows, so they report mostly the same edges."""
    return F.pmod(F.xxhash64("row"), n_blocks).cast("int")


def _block_pairs(members: DataFrame, key: str, n_blocks: Column) -> DataFrame:
    """Members replicated to the pairs of blocks they meet in: columns ``bi`` <= ``bj``
    and ``own`` (the member's block)."""
    m = members.withColumn("nb", n_blocks.cast("int")).withColumn("own", _own_block(n_blocks))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return m.withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other")).drop("other", "nb")


def _deal(cells: DataFrame, key: str) -> DataFrame:
    """Pairs of blocks dealt to tasks by a number: those of one key go to tasks one after another,
    so that a large key is spread evenly."""
    n = shuffle_partitions(cells.sparkSession)
    number = F.pmod(F.xxhash64(key), F.lit(n)) + F.expr("bj * (bj + 1L) div 2 + bi")
    return cells.repartitionById(n, F.pmod(number, F.lit(n)).cast("int")).sortWithinPartitions(key, "bi", "bj")


def _pairs_of(one: int, own: np.ndarray, bi: int, bj: int) -> np.ndarray:
    """Members that ``one`` meets in this pair of blocks (each pair of members once)."""
    if bi == bj:
        return np.arange(one + 1, len(own))
    return np.flatnonzero(own == bj) if own[one] == bi else np.empty(0, np.int64)


def _forest_edges(rows: np.ndarray, forest: _Forest) -> tuple[np.ndarray, np.ndarray]:
    away = np.flatnonzero(forest.label != np.arange(len(rows)))
    return rows[away], rows[forest.label[away]]


def _sigs(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(t.num_rows, HASHES)


def candidate_edges(reps: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Written table of edges (``a``, ``b``) that connect what the pairs surviving in any bucket connect."""
    need = min_matches(threshold, tolerance)
    banded = reps.select("row", F.explode("bands").alias("key"))
    shared = materialize(banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    blocks = F.ceil(F.col("n") / BUCKET_BLOCK)

    def members(buckets: DataFrame) -> DataFrame:
        return banded.join(buckets, "key").join(reps.select("row", "sig"), "row")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for t in _runs(batches, ["key", "own"]):
            if t.num_rows < 2:
                continue
            rows, sig = t.column("row").to_numpy(), _sigs(t)
            forest = _Forest(len(rows))
            for one in range(len(rows)):
                left = surviving(sig, one, np.arange(one + 1, len(rows)), need)
                if len(left):
                    forest.join(one, left)
            a, b = _forest_edges(rows, forest)
            out_a.append(a)
            out_b.append(b)
            if len(out_a) >= 4096:
                yield _edge_batch(out_a, out_b)
                out_a, out_b = [], []
        if out_a:
            yield _edge_batch(out_a, out_b)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, ["key", "bi", "bj"]):
            rows, own, sig = t.column("row").to_numpy(), t.column("own").to_numpy(), _sigs(t)
            _, group = np.unique(t.column("comp").to_numpy(), return_inverse=True)
            forest = _Forest(int(group.max()) + 1)
            bi, bj = t.column("bi")[0].as_py(), t.column("bj")[0].as_py()
            theirs = np.flatnonzero(own == bj)
            out_a, out_b = [], []
            for one in np.flatnonzero(own == bi):
                apart = theirs[forest.label[group[theirs]] != forest.label[group[one]]]
                left = surviving(sig, one, apart, need) if len(apart) else apart
                if len(left):
                    _, first = np.unique(forest.label[group[left]], return_index=True)
                    out_a.append(np.full(len(first), rows[one]))
                    out_b.append(rows[left[first]])
                    forest.join(int(group[one]), group[left])
            if out_a:
                yield _edge_batch(out_a, out_b)

    cells = members(shared).select("key", _own_block(blocks).alias("own"), "row", "sig")
    dealt = cells.repartition(shuffle_partitions(reps.sparkSession), "key", "own").sortWithinPartitions("key", "own", "row")
    edges = materialize(dealt.mapInArrow(within, "a long, b long").distinct(), "candidates")
    large = shared.filter(F.col("n") > BUCKET_BLOCK)
    if large.isEmpty():
        return edges
    known = components(edges)
    apart = members(large).join(known, "row", "left").withColumn("comp", F.coalesce("comp", "row"))
    pairs = _block_pairs(apart, "key", blocks).filter("bi < bj").select("key", "bi", "bj", "own", "row", "comp", "sig")
    more = _deal(pairs, "key").mapInArrow(across, "a long, b long").distinct()
    return materialize(edges.union(more), "candidates")


def _edge_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components: (``row``, ``comp``), comp being the smallest row.

    By contraction: each row points to its smallest neighbour, pointers are doubled until
    they name the root of their tree, and the edges are put between the roots.  Loops and
    repeated edges go, and every tree has two rows or more, so the rows left at least halve
    in each round; the edges of a star are gone after one.  Each table is written by as many
    tasks as its edges are worth, and nothing but their number reaches the driver."""
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    tasks = _edge_tasks(edges)
    edges = materialize(edges.distinct().coalesce(tasks), "edges")
    trees: list[tuple[DataFrame, int]] = []
    while not trees or not edges.isEmpty():
        tasks = _edge_tasks(edges)
        ends = edges.select(F.col("a").alias("row"), F.col("b").alias("near")).union(edges.select("b", "a"))
        tree = _roots(ends.groupBy("row").agg(F.least(F.min("near"), F.col("row")).alias("comp")), tasks)
        root_a, root_b = (tree.select(F.col("row").alias(c), F.col("comp").alias(f"root_{c}")) for c in "ab")
        joined = edges.join(root_a, "a").join(root_b, "b").filter("root_a <> root_b")
        edges = joined.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
        edges = materialize(edges.distinct().coalesce(tasks), "edges")
        trees.append((tree, tasks))
    labels, _ = trees.pop()
    while trees:  # a root of an earlier round is a row of the next, or its component is done
        up = labels.select(F.col("row").alias("comp"), F.col("comp").alias("up"))
        tree, tasks = trees.pop()
        known = tree.join(up, "comp", "left").select("row", F.coalesce("up", "comp").alias("comp"))
        labels = materialize(known.coalesce(tasks), "labels")
    return labels


def _edge_tasks(edges: DataFrame) -> int:
    return min(shuffle_partitions(edges.sparkSession), max(EDGE_TASKS, -(-edges.count() // EDGE_ROWS)))


def _roots(pointers: DataFrame, tasks: int) -> DataFrame:
    """(``row``, ``comp``) with comp the end of the row's chain of pointers, by doubling."""
    now = materialize(pointers.coalesce(tasks), "pointers")
    while True:
        up = now.select(F.col("row").alias("comp"), F.col("comp").alias("up"))
        moved = F.col("up") != F.col("comp")
        doubled = now.join(up, "comp").select("row", F.col("up").alias("comp"), moved.alias("moved"))
        nxt = materialize(doubled.coalesce(tasks), "pointers")
        if nxt.filter("moved").isEmpty():
            return nxt.select("row", "comp")
        now = nxt.select("row", "comp")


# -- exact verification --------------------------------------------------------------------
def verified_links(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``members``: (``comp``, ``row``, ``text``, ``size``).  Rows (``a``, ``b``, ``links``): a link count
    of row ``a`` (b null) or a spanning edge of the verified links (links 0)."""
    per = members.groupBy("comp").agg(F.count("*").alias("m"), F.sum(F.octet_length("text")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("m") / VERIFY_BLOCK), F.ceil(F.col("bytes") / VERIFY_BYTES))
    cells = _block_pairs(members.join(per, "comp"), "comp", blocks).select("comp", "bi", "bj", "own", "row", "size", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, ["comp", "bi", "bj"]):
            if t.num_rows < 2:
                continue
            rows, own, size = (t.column(c).to_numpy() for c in ("row", "own", "size"))
            bi, bj = t.column("bi")[0].as_py(), t.column("bj")[0].as_py()
            sets = ngram_sets(t.column("text").combine_chunks())
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            starts = np.cumsum(n) - n
            grams, codes = np.unique(np.concatenate(sets), return_inverse=True)
            mark = np.zeros(len(grams), dtype=np.int64)
            links = np.zeros(len(rows), dtype=np.int64)
            forest = _Forest(len(rows))
            for one in range(len(rows)):
                others = _pairs_of(one, own, bi, bj)
                others = others[np.minimum(n[others], n[one]) >= threshold * np.maximum(n[others], n[one])]
                if not len(others):
                    continue
                own_codes = codes[starts[one] : starts[one] + n[one]]
                mark[own_codes] = 1
                if len(others) * 4 < len(rows):
                    common = np.array([mark[codes[starts[o] : starts[o] + n[o]]].sum() for o in others])
                else:
                    common = np.add.reduceat(mark[codes], starts)[others]
                mark[own_codes] = 0
                hit = others[common / (n[others] + n[one] - common) >= threshold]
                if len(hit):
                    links[one] += size[hit].sum()
                    links[hit] += size[one]
                    forest.join(one, hit)
            a, b = _forest_edges(rows, forest)
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((rows[linked], a)), pa.int64()),
                    pa.array([None] * len(linked) + b.tolist(), pa.int64()),
                    pa.array(np.concatenate((links[linked], np.zeros(len(a), np.int64))), pa.int64()),
                ],
                names=["a", "b", "links"],
            )

    return _deal(cells, "comp").mapInArrow(run, "a long, b long, links long")


# -- the join --------------------------------------------------------------------------------
def _joined(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(``row``, ``id``, ``class_row``, ``n_links``) for every row of ``signatures``."""
    grouped = rows.filter("cls is not null").groupBy("cls").agg(F.min("row").alias("rep"), F.count("*").alias("size"))
    classes = materialize(grouped, "classes")
    reps = rows.select("row", "sig", "bands").join(classes.select(F.col("rep").alias("row"), "size"), "row")
    reps = materialize(reps, "reps")
    near = components(candidate_edges(reps, threshold, tolerance))
    # written: few rows beside the texts, and their size tells Spark how to fetch the texts
    near = materialize(near.join(reps.select("row", "size"), "row"), "near")
    members = near.join(rows.select("row", F.col("c1").alias("text")), "row")
    found = materialize(verified_links(members, threshold), "links")
    final = components(found.filter("b is not null").select("a", "b"))
    links = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    classes = classes.join(final.select(F.col("row").alias("rep"), "comp"), "rep", "left").join(links, "rep", "left")
    out = rows.select("row", F.col("c0").alias("id"), "cls").join(classes, "cls", "left").select(
        "row",
        "id",
        F.coalesce("comp", "rep", "row").alias("class_row"),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("size") - 1, F.lit(0)).alias("n_links"),
    )
    return materialize(out, "joined")


def similarity_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per input row: id, ``class_id`` (smallest id among all documents connected
    by links), ``n_links`` (other documents with similarity >= threshold) and ``class_size``."""
    rows = _joined(signatures(docs, id_col, text_col), threshold, tolerance)
    # written, so that the join below has exchanges of its own, which Spark can split where a class is large
    sizes = rows.groupBy("class_row").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    classes = materialize(sizes, "class-sizes")
    return rows.join(classes, "class_row").select(F.col("id").alias(id_col), "class_id", "n_links", "class_size")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The input with one row of each near-duplicate class: the one with the smallest id."""
    others = tuple(c for c in docs.columns if c not in (id_col, text_col))
    rows = signatures(docs, id_col, text_col, others)
    joined = _joined(rows, threshold, tolerance)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first")
    several = materialize(joined.groupBy("class_row").agg(F.count("*").alias("n"), first).filter("n > 1"), "several")
    # The rows to drop are the smaller part: only they are looked for among the texts.
    dropped = joined.select("row", "class_row").join(several.select("class_row", F.col("first.row").alias("kept")), "class_row")
    dropped = materialize(dropped.filter("row <> kept").select("row"), "dropped")
    at = {c: f"c{i}" for i, c in enumerate([id_col, text_col, *others])}
    return rows.join(dropped, "row", "left_anti").select(*[F.col(at[c]).alias(c) for c in docs.columns])
