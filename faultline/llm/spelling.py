"""Spelling variant grouping: words that differ by one code point, by finite-state composition.

1. ``count_words`` counts the words of all texts: maximal runs of letters, lower-cased in
   A-Z only.  Counts are summed per slice of texts before they are shuffled.
2. Pairs one edit apart are the pairs that *acceptor o one-edit transducer o acceptor* accepts,
   the acceptor being the minimal acyclic automaton of the vocabulary.  A path first copies (both
   acceptors are in one state), edits once, and copies on.  The machine is enumerated in
   parts, one per initial state: a part fixes the length ``s`` of the shorter word, an interval
   [lo, hi) of places for the edit, and the code points both words share before and behind it
   (the first ``lo``, the last ``s - hi``).  Its initial state is the one reached by the shared code
   points.  Two intervals, the halves of the word, cover all edits, so a word is in four parts
   (as a shorter and as a longer word); the edit's place (the first difference) says
   which part reports a pair, and each pair is reported once.
3. A part of more than ``part_words`` words is split: its interval is halved, and so on, down to one
   place, where the words differ in that place alone and number at most about the square of the
   alphabet.  No part, however common a beginning or ending is, grows with the data.
4. A task builds one automaton for many parts: a state is a set of endings, so equal endings of
   any part are one state, and each part has an initial state of its own.  The composition is
   enumerated breadth-first over arrays of state pairs.  Words are numbered by counting along
   the paths.  Per word a part returns its number of near words and its best form, not the pairs.
5. Forms are followed by pointer doubling; n at least doubles at each step, so the chains
   are shorter than 64 steps.

Defined cases
- null, empty and wordless texts have no words; an empty table gives an empty result;
- words of any length are handled whole;
- ties for the form: the smallest word in code-point order;
- rows that repeat an id or a text are counted row by row; a null id is no id: its words are
  counted, and no code point of theirs is deleted;
- only (id, text) are read, so extra columns never clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import materialize, mix64
from faultline.llm.packing import slices
from faultline.session import ship_package, shuffle_partitions

MIN_LENGTH, MIN_COUNT, MIN_RATIO = 5, 3, 2
PART_WORDS = 1 << 14  # more words than this in a part: it is split
BATCH_CELLS = 1 << 20  # code points (padded) that a task puts into one automaton, or one part
SLICE_BYTES, SLICE_ROWS = 8 << 20, 16384
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# -- words ----------------------------------------------------------------------------------
def letter_runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased: (code, text) of each and the
    vocabulary.  In UTF-8 these letters are the ASCII letters and C3 with the byte behind it."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    table = np.full(256, 0x20, dtype=np.uint8)
    for c in range(26):
        table[0x41 + c] = table[0x61 + c] = 0x61 + c
    table[0xC3] = 0xC3
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8, int(edges[-1]))
    data = table[raw]
    behind = np.flatnonzero(raw[:-1] == 0xC3) + 1
    data[behind] = raw[behind]
    clean = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(edges), pa.py_buffer(data))
    lists = pc.ascii_split_whitespace(clean)
    words = lists.flatten().dictionary_encode()
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    blank = pc.index(words.dictionary, "").as_py()
    if blank >= 0:
        code, text = code[code != blank], text[code != blank]
    return code, text, words.dictionary


def slip_hashes(ids: list, code: np.ndarray, text: np.ndarray, vocab: list[bytes]) -> np.ndarray:
    """crc32 of ``<id>:<word>`` for each word of each text, from one crc32 per text and length and
    one per word: crc(a + b) = crc(b) ^ crc(zeros after a) ^ crc(zeros), all of b's length."""
    sizes, of = np.unique(np.fromiter(map(len, vocab), np.int64, len(vocab)), return_inverse=True)
    heads = [zlib.crc32(f"{i}:".encode()) for i in ids]
    shifted = np.empty((len(sizes), len(heads)), dtype=np.uint32)
    for row, n in enumerate(sizes.tolist()):
        zeros = bytes(n)
        plain = zlib.crc32(zeros)
        shifted[row] = [zlib.crc32(zeros, h) ^ plain for h in heads]
    own = np.fromiter(map(zlib.crc32, vocab), np.uint32, len(vocab))
    return shifted[of[code], text] ^ own[code]


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slip_modulus: int | None = None,
) -> DataFrame:
    """(``word``, ``n``): words of at least ``min_length`` code points and ``min_count`` occurrences.

    With ``slip_modulus`` m, a word is misspelt on purpose where m divides h, the crc32 of
    ``<id>:<word>``: its code point h % length is deleted."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_ROWS, SLICE_BYTES):
                code, text, words = letter_runs(part.column(1))
                if not len(code):
                    continue
                extra, extra_n = [], []
                if slip_modulus:
                    vocab = words.cast(pa.large_binary()).to_pylist()
                    has_id = np.asarray(part.column(0).is_valid())
                    h = slip_hashes(part.column(0).to_pylist(), code, text, vocab)
                    slips = (h % np.uint32(slip_modulus) == 0) & has_id[text]
                    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
                    what = code[slips] * (int(length.max()) + 1) + h[slips] % length[code[slips]]
                    what, extra_n = np.unique(what, return_counts=True)
                    c, at = np.divmod(what, int(length.max()) + 1)
                    extra = [w[:i] + w[i + 1 :] for w, i in zip(words.take(pa.array(c)).to_pylist(), at.tolist())]
                    code = code[~slips]
                n = np.bincount(code, minlength=len(words))
                some = np.flatnonzero(n)
                column = pa.concat_arrays([words.take(pa.array(some)), pa.array(extra, pa.large_string())])
                counts = np.concatenate((n[some], np.asarray(extra_n, dtype=np.int64)))
                long = pc.greater_equal(pc.utf8_length(column), min_length)
                yield pa.RecordBatch.from_arrays(
                    [column.filter(long).cast(pa.string()), pa.array(counts).filter(long)], names=["word", "n"]
                )

    found = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# -- automaton -----------------------------------------------------------------------------------
class Acceptor:
    """Minimal acyclic automaton of several sets of words, each with an initial state of its own.

    ``cells`` are the words' code points, padded with 0; rows are sorted by (set, word) and
    distinct.  A state is a set of endings; it is known by two sums of 64-bit hashes of
    them.  Arcs are sorted by (state, code point); ``skip`` of an arc counts the words of
    its state that come before those behind the arc, so the sum along a path numbers the words."""

    def __init__(self, cells: np.ndarray, sets: np.ndarray) -> None:
        rows, width = cells.shape
        length = (cells != 0).sum(axis=1)
        differ = cells[1:] != cells[:-1]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp = np.concatenate(([-1], np.where(sets[1:] != sets[:-1], -1, lcp)))
        ending = [np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)]  # hash of each row's ending
        keys, first, counts, final, parents, chars = [], [], [], [], [], []
        below: np.ndarray | None = None  # rows where the nodes one level down begin
        total = 0
        for d in range(width, -1, -1):
            if d < width:
                c = cells[:, d].astype(np.uint64)
                for k, m in enumerate((_A, _B)):
                    ending[k] = np.where(c != 0, mix64(ending[k] * m + c), ending[k])
            start = np.flatnonzero((lcp < d) & (length >= d))
            if not len(start):
                continue
            # The node's rows are a range: up to the next row that leaves its path.
            leaves = np.flatnonzero(lcp < d)
            stop = np.append(leaves, rows)[np.searchsorted(leaves, start, side="right")]
            sums = []
            for e, m in zip(ending, (_A, _B)):
                run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(e + m))))
                sums.append(run[stop] - run[start])
            keys.append(np.stack(sums, axis=1))
            if below is not None:
                up = np.searchsorted(start, below, side="right") - 1
                parents.append(total + up)
                chars.append(cells[below, d])
            first.append(start)
            counts.append(stop - start)
            final.append(length[start] == d)
            total += len(start)
            below = start
        # Levels were added from the longest words' ends upwards, so the children of level i are
        # the nodes of level i - 1, and the last level is the initial states.
        key = np.concatenate(keys)
        order = np.lexsort((key[:, 1], key[:, 0]))
        new = np.ones(total, dtype=bool)
        new[1:] = (key[order][1:] != key[order][:-1]).any(axis=1)
        state = np.empty(total, dtype=np.int64)
        state[order] = np.cumsum(new) - 1
        chosen = order[new]  # a node for each state
        first, final = np.concatenate(first), np.concatenate(final)
        self.final = final[chosen]
        self.initial, self.base = state[total - len(below) :], below
        child = np.arange(sum(map(len, parents)))  # all nodes but the initial ones have a parent
        parent = np.concatenate(parents) if parents else np.empty(0, np.int64)
        char = np.concatenate(chars).astype(np.int64) if chars else np.empty(0, np.int64)
        is_chosen = np.zeros(total, dtype=bool)
        is_chosen[chosen] = True
        arcs = np.flatnonzero(is_chosen[parent])
        by = arcs[np.lexsort((char[arcs], state[parent[arcs]]))]
        self.source, self.char, self.target = state[parent[by]], char[by], state[child[by]]
        self.skip = first[child[by]] - first[parent[by]]
        n = len(chosen)
        self.arcs = np.bincount(self.source, minlength=n)
        self.at = np.cumsum(self.arcs) - self.arcs
        self._key = self.source * (1 << 21) + self.char

    def step(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs out of ``states``: (place in ``states``, arc)."""
        n = self.arcs[states]
        first = np.cumsum(n) - n
        return np.repeat(np.arange(len(states)), n), np.repeat(self.at[states] - first, n) + np.arange(int(n.sum()))

    def follow(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The arc of each state on each code point, -1 if none."""
        key = states * (1 << 21) + chars
        i = np.minimum(np.searchsorted(self._key, key), max(len(self._key) - 1, 0))
        return np.where(self._key[i] == key, i, -1) if len(self._key) else np.full(len(key), -1)


def one_edit_pairs(cells: np.ndarray, sets: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of the same set that the composition accepts: b is a with the code point at one
    place replaced, or with one code point inserted before that place; the place, the first at
    which they differ, is below ``places[set]``.  Each pair once; of a replacement a < b."""
    m = Acceptor(cells, sets)
    limit = places[sets[m.base]]
    state, row = m.initial, m.base
    out_a, out_b = [], []
    # Pairs after the edit, by the code point the left word must not go on with (-1: any).
    left, right, a, b, bar = (np.empty(0, np.int64) for _ in range(5))
    depth = 0
    while len(state) or len(left):
        # Copying after the edit: both sides take the same code point.
        done = m.final[left] & m.final[right]
        out_a.append(a[done])
        out_b.append(b[done])
        i, arc = m.step(left)
        go = m.char[arc] != bar[i]
        i, arc = i[go], arc[go]
        other = m.follow(right[i], m.char[arc])
        ok = other >= 0
        i, arc, other = i[ok], arc[ok], other[ok]
        nxt = [(m.target[arc], m.target[other], a[i] + m.skip[arc], b[i] + m.skip[other], np.full(len(i), -1))]
        # The edit, and copying before it.
        i, arc = m.step(state)
        can = limit[i] > depth
        ii, x = i[can], arc[can]
        # insertion: only the right side moves
        nxt.append((state[ii], m.target[x], row[ii], row[ii] + m.skip[x], m.char[x]))
        # replacement: the two sides take different arcs of the state, in order
        later = m.at[state[ii]] + m.arcs[state[ii]] - 1 - x
        first = np.cumsum(later) - later
        k = np.repeat(np.arange(len(x)), later)
        y = x[k] + 1 + np.arange(int(later.sum())) - first[k]
        nxt.append((m.target[x[k]], m.target[y], row[ii[k]] + m.skip[x[k]], row[ii[k]] + m.skip[y], np.full(len(k), -1)))
        # An insertion starts its copying one step later than a replacement does, which is of no
        # account: each pair of states stands for itself.
        left, right, a, b, bar = (np.concatenate(c) for c in zip(*nxt))
        state, row, limit = m.target[arc], row[i] + m.skip[arc], limit[i]
        keep = limit > depth + 1
        state, row, limit = state[keep], row[keep], limit[keep]
        depth += 1
    return np.concatenate(out_a), np.concatenate(out_b)


# -- parts -----------------------------------------------------------------------------------------
def _part_key(frame: DataFrame) -> DataFrame:
    """``frame`` (``word``, ``n``, ``s``, ``lo``, ``hi``) with ``part``: what names the initial state."""
    tail = F.greatest(F.col("s") - F.col("hi"), F.lit(0))
    return frame.withColumn(
        "part",
        F.concat_ws(
            " ", "s", "lo", "hi", F.expr("substring(word, 1, lo)"),
            F.when(tail > 0, F.expr("right(word, s - hi)")).otherwise(""),
        ),
    )


def _split_intervals(frame: DataFrame) -> DataFrame:
    """Each row twice, with the two halves of its interval."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
    return _part_key(frame.select("word", "n", "s", F.explode(halves).alias("x")).select("word", "n", "s", "x.lo", "x.hi"))


def parts(words: DataFrame, part_words: int = PART_WORDS) -> list[DataFrame]:
    """(``part``, ``word``, ``n``, ``s``, ``lo``, ``hi``): tables whose parts have 2 to ``part_words`` words."""
    length = F.length("word")
    both = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("s"))
    # Places 0 .. s: an insertion may come after the last code point of the shorter word.
    whole = both.withColumn("lo", F.lit(0)).withColumn("hi", F.col("s") + 1)
    frame, out = materialize(_split_intervals(whole), "spelling-parts"), []
    while True:
        sizes = frame.groupBy("part").agg(F.count("*").alias("m"), F.first("hi").alias("hi"), F.first("lo").alias("lo"))
        large = (F.col("m") > part_words) & (F.col("hi") > F.col("lo") + 1)
        wide = materialize(sizes.filter(large).select("part"), "spelling-large")
        if wide.isEmpty():
            out.append(frame)
            return out
        out.append(frame.join(wide, "part", "left_anti"))
        frame = materialize(_split_intervals(frame.join(wide, "part")), "spelling-parts")


def _near(rows: pa.Table) -> pa.RecordBatch | None:
    """Per word of whole parts (sorted by part): near words and the best of them."""
    codes = rows.column("part").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    s, lo, hi = (rows.column(c).to_numpy().astype(np.int64) for c in ("s", "lo", "hi"))
    words = rows.column("word").combine_chunks()
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # What is left between the shared code points: the automaton is that of these middles.
    size = length - lo - np.maximum(s - hi, 0)
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    cells = np.zeros((len(s), max(int(size.max()), 1)), dtype=np.uint32)
    inside = np.arange(cells.shape[1])[None, :] < size[:, None]
    begin = np.cumsum(length) - length + lo
    cells[inside] = flat[(begin[:, None] + np.arange(cells.shape[1])[None, :])[inside]]
    order = np.lexsort((*cells.T[::-1], codes))
    cells, sets = cells[order], codes[order]
    a, b = one_edit_pairs(cells, sets, _by_set(sets, (hi - lo)[order]))
    a, b = order[a], order[b]
    short = np.minimum(length[a], length[b]) == s[a]  # two words of length s + 1 belong to another part
    a, b = a[short], b[short]
    if not len(a):
        return None
    one, two = np.concatenate((a, b)), np.concatenate((b, a))
    n = rows.column("n").to_numpy()
    rank = pc.rank(words, tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)
    by = np.lexsort((rank[two], -n[two], one))
    one, two = one[by], two[by]
    head = np.flatnonzero(np.append(True, one[1:] != one[:-1]))
    near = np.diff(np.append(head, len(one)))
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(one[head])), pa.array(near), pa.array(-n[two[head]]), words.take(pa.array(two[head]))],
        names=["word", "near", "minus_n", "form"],
    )


def _by_set(sets: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(int(sets.max()) + 1, dtype=np.int64)
    out[sets] = values
    return out


def _enumerate(frame: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            whole = _whole_parts(t)
            yield from _in_batches(t.slice(0, whole))
            rest = t.slice(whole)
        if rest is not None:
            yield from _in_batches(rest)

    dealt = frame.select("part", "word", "n", "s", "lo", "hi").repartition(shuffle_partitions(frame.sparkSession), "part")
    return dealt.sortWithinPartitions("s", "part").mapInArrow(run, "word string, near long, minus_n long, form string")


def _ends(t: pa.Table) -> np.ndarray:
    """Rows behind which a part ends, but for the last."""
    code = t.column("part").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(code[1:] != code[:-1]) + 1


def _whole_parts(t: pa.Table) -> int:
    """Rows of ``t`` before its last part, which may go on in the next batch."""
    ends = _ends(t) if t.num_rows else []
    return int(ends[-1]) if len(ends) else 0


def _in_batches(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near words of whole parts, some parts at a time."""
    if not t.num_rows:
        return
    bounds = np.concatenate(([0], _ends(t), [t.num_rows]))
    several = np.diff(bounds) > 1
    first, last = bounds[:-1][several], bounds[1:][several]
    if not len(first):
        return
    take = np.concatenate([np.arange(a, b) for a, b in zip(first, last)])
    t = t.take(pa.array(take))
    ends = np.cumsum(last - first)
    widest = t.column("s").to_numpy().astype(np.int64)  # sorted by s: close to the batch's widest
    a = 0
    while a < t.num_rows:
        most = max(1, BATCH_CELLS // (int(widest[a]) + 2))
        k = int(np.searchsorted(ends, a + most, side="right"))
        b = int(ends[max(k - 1, 0)])
        if b <= a:
            b = int(ends[k])
        out = _near(t.slice(a, b - a))
        if out is not None:
            yield out
        a = b


# -- variants ------------------------------------------------------------------------------------------
def near_words(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(``word``, ``n_near``, ``form``, ``form_n``) of the words that have near words: how many, and the
    one of largest n (ties: smallest in code-point order)."""
    ship_package(words.sparkSession)
    found: DataFrame | None = None
    for frame in parts(words, part_words):
        some = _enumerate(frame)
        found = some if found is None else found.unionByName(some)
    best = F.min(F.struct("minus_n", "form"))
    out = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return out.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus_n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) for ``forms`` (``word``, ``form``): what the last form of each chain is."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("up"))
        nxt = now.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved"))
        nxt = materialize(nxt, "spelling-roots")
        if nxt.filter("moved").isEmpty():
            return nxt.select("word", "root")
        now = nxt.select("word", "root")


def variants(words: DataFrame, min_ratio: int = MIN_RATIO, part_words: int = PART_WORDS) -> DataFrame:
    """Per word of ``words`` (``word``, ``n``): ``form`` (null if its best near word has less than
    ``min_ratio`` times the word's n), ``root``, ``n``, ``n_near``, ``form_n``."""
    words = materialize(words.select("word", "n"), "spelling-words")
    near = words.join(near_words(words, part_words), "word", "left")
    strong = F.col("form_n") >= F.lit(min_ratio) * F.col("n")
    near = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("form")).alias("form"),
        F.when(strong, F.col("form_n")).alias("form_n"),
    )
    near = materialize(near, "spelling-near")
    found = roots(near.filter("form is not null"))
    return near.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
