"""Seeded class-aware sampling, stratified splitting and unions.

Row choice is a pure function of ``md5(seed:key)``: the same rows come out for
any partitioning and after any task retry.  Exact-count variants rank rows
inside each class with ``ranking.hash_rank_cut``: a histogram of hash
prefixes plus an exact rank of one boundary bucket per class, so a class
holding most of the rows never lands in one task and the data itself is
never shuffled; per-class counts are a tiny aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.hashing import seeded_md5
from faultline.operators.ranking import hash_histogram, hash_rank_cut, histogram_counts
from faultline.spec import NEGATIVE, POSITIVE

_H = "_fl_h"


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    return df.groupBy(label_col).agg(F.count("*").alias("n_class"))


def take_first_by_hash(
    df: DataFrame,
    label_col: str,
    keys: Sequence[str],
    seed: int,
    quota: Callable[[DataFrame], DataFrame],
    out: str = "_fl_in",
) -> DataFrame:
    """Flag the first ``_fl_k`` rows of each class in ``md5(seed:key)`` order.

    ``quota`` turns the class sizes ``(label_col, n_class)`` into ``(label_col,
    _fl_k)``; sizes and cuts come from one histogram pass."""
    hashed = df.withColumn(_H, seeded_md5(seed, *keys))
    hist = hash_histogram(hashed, label_col, _H)
    quotas = quota(histogram_counts(hist, label_col))
    return hash_rank_cut(hashed, label_col, _H, list(keys), quotas, out=out, hist=hist).drop(_H)


def downsample(
    df: DataFrame,
    label_col: str,
    keys: Sequence[str],
    ratio: float = 0.3,
    seed: int = 42,
    keep_class: str = POSITIVE,
    sample_class: str = NEGATIVE,
    exact: bool = True,
) -> DataFrame:
    """All ``keep_class`` rows plus a ``ratio`` share of ``sample_class`` rows.

    ``exact``: exactly ``round_half_even(ratio * n)`` rows (pandas'
    ``sample(frac=...)`` size) chosen by hash rank.  Otherwise a Bernoulli
    ``sampleBy`` pass with no ranking shuffle; its count is only expected.
    Rows of other classes are dropped, as in the reference.
    """
    if not exact:
        return df.filter(F.col(label_col).isin(keep_class, sample_class)).sampleBy(
            label_col, {keep_class: 1.0, sample_class: ratio}, seed
        )
    def quota(counts: DataFrame) -> DataFrame:
        n = F.when(F.col(label_col) == keep_class, F.col("n_class")).otherwise(F.bround(F.lit(ratio) * F.col("n_class"), 0))
        return counts.select(label_col, n.cast("long").alias("_fl_k"))

    pool = df.filter(F.col(label_col).isin(keep_class, sample_class))
    return take_first_by_hash(pool, label_col, keys, seed, quota).filter(F.col("_fl_in")).drop("_fl_in")


def shuffle_rows(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Seeded row order (a distributed range sort); only for order-sensitive sinks."""
    return df.orderBy(seeded_md5(seed, *keys), *keys)


def stratified_split(
    df: DataFrame,
    label_col: str,
    keys: Sequence[str],
    test_size: float = 0.2,
    seed: int = 1,
    out: str = "split",
) -> DataFrame:
    """Tag every row ``train`` or ``test``, stratified by class.

    Sizes follow scikit-learn: ``n_test = ceil(test_size * n)``; the training
    quota ``n - n_test`` is shared over classes by largest remainder of
    ``quota * n_class / n`` (ties to the smaller class name, where
    scikit-learn breaks them at random).  Within a class the lowest hash
    ranks go to train.  Disjoint and complete by construction.  A class with a
    single row is an error, as in scikit-learn.
    """
    def quota(counts: DataFrame) -> DataFrame:
        least = counts.agg(F.min("n_class")).first()[0]
        if least is not None and least < 2:
            raise ValueError("a class with a single row cannot be split")
        whole = Window.partitionBy(F.lit(0))  # one row per class
        return (
            counts.withColumn("_n", F.sum("n_class").over(whole))
            .withColumn("_n_train", F.col("_n") - F.ceil(F.lit(test_size) * F.col("_n")))
            .withColumn("_cont", (F.col("_n_train") * F.col("n_class")) / F.col("_n"))
            .withColumn("_fl", F.floor("_cont"))
            .withColumn("_need", F.col("_n_train") - F.sum("_fl").over(whole))
            .withColumn(
                "_order",
                F.row_number().over(whole.orderBy(F.desc(F.col("_cont") - F.col("_fl")), F.col(label_col))),
            )
            .select(
                label_col,
                (F.col("_fl") + F.when(F.col("_order") <= F.col("_need"), 1).otherwise(0)).cast("long").alias("_fl_k"),
            )
        )

    tagged = take_first_by_hash(df, label_col, keys, seed, quota)
    return tagged.withColumn(out, F.when(F.col("_fl_in"), "train").otherwise("test")).drop("_fl_in")


def train_test_frames(split_df: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    train = split_df.filter(F.col(split_col) == "train").drop(split_col)
    test = split_df.filter(F.col(split_col) == "test").drop(split_col)
    return train, test


def union_frames(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name; ``allow_missing`` fills absent columns with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def sample_by_fraction(df: DataFrame, label_col: str, fractions: Mapping[str, float], seed: int = 42) -> DataFrame:
    """Bernoulli per-class sample (no shuffle)."""
    return df.sampleBy(label_col, dict(fractions), seed)
