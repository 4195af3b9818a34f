"""Mixing sources to target weights by systematic sampling.

Every source gets a target amount (words).  Its rate is target / size; a
document's expected copies are that rate, their prefix sums within the source
run over the documents in ``(size, hash)`` order, one offset in [0, 1) per source
is added, and a document is emitted once for each integer its interval crosses.
Ordering by size makes the words taken follow the target to about the size of
one large document.

Targets: ``share`` of all sizes is dealt out by weight; a source stops at
``max_repeat`` times its size and the excess is dealt out again among the rest,
until none is above.  The rate is then at most ``max_repeat``, so no document
is emitted more often than that.

Everything is DataFrame operations.  Ranks come from a range partitioning on
``(source, size, hash)``, so a source holding a third of all rows is spread
over many tasks, and copies have different hashes.

Defined cases
- null text has size 0; a null source is a source of its own, ordered last;
- a source whose documents are all of size 0 has target 0 and emits nothing;
- rows that repeat a doc_id are documents of their own;
- an empty table gives an empty result;
- the working table has only (id, source, size), so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import fresh_name, global_rank, materialize, seeded_unit

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of maximal runs of anything but ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, max_repeat: float) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``n_docs``, ``first_rank``, ``target``.

    ``sized`` has (source, size).  Sources are ranked by code point, null last;
    weights repeat over that order.  Each round of the capping is one aggregate
    over the source table; rounds end when no share is above its cap."""
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    src = global_rank(src, [F.col("source").isNull(), F.col("source")], "src_rank")
    n = len(weights)
    weight = F.array(*[F.lit(int(w)) for w in weights])
    src = src.withColumn("weight", F.element_at(weight, (F.col("src_rank") % n + 1).cast("int")))
    src = materialize(src, "sources")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    pot = share * total
    cap = F.col("source_size") * F.lit(float(max_repeat))
    level = 0.0
    capped_before = -1
    # A source once at its cap stays there (the level only rises), so the set
    # of capped sources is given by the level and grows until it is stable.
    while True:
        at_cap = F.col("weight") * F.lit(level) >= cap
        row = src.agg(
            F.count(F.when(at_cap, 1)).alias("n_capped"),
            F.sum(F.when(at_cap, F.col("source_size"))).alias("capped"),
            F.sum(F.when(~at_cap, F.col("weight"))).alias("open_weight"),
        ).first()
        if row["n_capped"] == capped_before or not row["open_weight"]:
            break
        capped_before = row["n_capped"]
        level = (pot - max_repeat * (row["capped"] or 0)) / row["open_weight"]
    target = F.least(F.col("weight") * F.lit(level), cap)
    return src.select("source", "source_size", "n_docs", "src_rank", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_repeat: float = 2.0,
    seed: int = 17,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: id, the columns in ``carry``, ``source``, ``size``, ``source_size``, ``target``,
    ``copies`` (times the mix emits it) and ``taken`` (= copies * size)."""
    sized = docs.select(
        docs[id_col].alias(id_col),
        *[docs[c] for c in carry],
        docs[source_col].cast("string").alias("source"),
        word_count(docs[text_col]).alias("size"),
    )
    # written first: the range partitioning below samples its input and then reads it again
    hashed = materialize(sized.withColumn("h", seeded_unit(seed, F.col(id_col))), "sized")
    # Ranks over all rows in source order; a source's own ranks start at its smallest.
    ranked = global_rank(hashed, [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("h"), F.col(id_col), *carry])
    ranked = materialize(ranked, "ranked-docs")
    targets = source_targets(ranked.select("source", "size"), weights, share, max_repeat)
    first = ranked.groupBy(F.col("source").alias("s")).agg(F.min("rank").alias("first_rank"))
    targets = materialize(
        targets.join(first, F.col("source").eqNullSafe(F.col("s"))).select(
            F.col("source").alias("s"),
            "source_size",
            "target",
            "first_rank",
            seeded_unit(f"{seed}:offset", F.col("src_rank")).alias("offset"),
        ),
        "targets",
    )
    joined = ranked.join(targets, F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    i = (F.col("rank") - F.col("first_rank")).cast("double")
    copies = F.floor(F.col("offset") + rate * (i + 1)) - F.floor(F.col("offset") + rate * i)
    return joined.withColumn("copies", copies.cast("long")).select(
        id_col,
        *carry,
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def emit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw
) -> DataFrame:
    """The mixed table: each row of ``docs`` repeated by its number of copies.

    The rows get a number of their own, written with them, so that ids which
    repeat are matched to their own counts."""
    num = fresh_name("row_num", docs.columns)
    keyed = materialize(docs.withColumn(num, F.monotonically_increasing_id()), "numbered")
    own, copies, copy = (fresh_name(c, [*docs.columns, num]) for c in ("own_row", "n_copies", "copy"))
    counts = mix(keyed, id_col, text_col, source_col, carry=(num,), **kw)
    counts = counts.filter(F.col("copies") > 0).select(F.col(num).alias(own), F.col("copies").alias(copies))
    taken = keyed.join(counts, keyed[num] == counts[own])
    return taken.select(*[keyed[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy)).drop(copy)
