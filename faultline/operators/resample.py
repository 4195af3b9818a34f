"""Class rebalancing: synthetic minority rows (SMOTE) and Tomek-link removal.

SMOTE grows the minority class to the majority's size.  Each minority row
produces ``floor(n_new / n_min)`` synthetic rows, plus one more for the
first ``n_new mod n_min`` rows in ``md5(seed:key)`` order (a balanced,
seeded allocation; the reference draws rows at random without a seed).  A
synthetic row ``j`` of row ``x`` interpolates towards one of ``x``'s ``k``
nearest minority neighbours chosen by ``md5``: ``x + u * (nn - x)`` with
``u`` a seeded uniform in [0, 1).  A minority class of ``k`` rows or fewer is an
error: it cannot be balanced with ``k`` neighbours.

Tomek links are mutual nearest neighbours with different labels; both rows
of every link are removed.

Rows carry a string ``row_id``: originals keep their key as text, synthetic
rows are ``s<key>:<j>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.hashing import seeded_md5, seeded_uniform
from faultline.operators.neighbors import DEFAULT_BLOCK_ROWS, knn_join_pruned
from faultline.operators.ranking import hash_rank_cut
from faultline.session import cut_lineage

ROW_ID = "row_id"


def with_row_id(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(ROW_ID, F.col(key).cast("string"))


def smote(
    df: DataFrame,
    label_col: str,
    features: Sequence[str],
    minority: str,
    n_target: int,
    k: int = 5,
    seed: int = 0,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Synthetic minority rows ``(row_id, label, *features)`` bringing the
    minority class (``df`` must carry ``row_id``) up to ``n_target`` rows."""
    feats = list(features)
    mino = df.filter(F.col(label_col) == minority).select(ROW_ID, *feats)
    n_min = mino.count()
    n_new = n_target - n_min
    spark = df.sparkSession
    empty = spark.createDataFrame([], f"{ROW_ID} string, {label_col} string, " + ", ".join(f"{c} double" for c in feats))
    if n_new <= 0:
        return empty
    if n_min <= k:
        raise ValueError(f"class {minority!r} has {n_min} rows; {k} neighbours need at least {k + 1}")
    base, extra = divmod(n_new, n_min)
    quota = spark.range(1).select(F.lit("m").alias("_fl_grp"), F.lit(extra).cast("long").alias("_fl_k"))
    counted = hash_rank_cut(
        mino.withColumn("_fl_grp", F.lit("m")).withColumn("_fl_h", seeded_md5(seed, F.lit("alloc"), F.col(ROW_ID))),
        "_fl_grp", "_fl_h", [ROW_ID], quota,
    )
    per_row = counted.select(
        ROW_ID, *feats, (F.lit(base) + F.when(F.col("_fl_in"), 1).otherwise(0)).alias("_fl_n")
    ).filter(F.col("_fl_n") > 0)
    draws = per_row.select(ROW_ID, *feats, F.explode(F.sequence(F.lit(1), F.col("_fl_n"))).alias("_fl_j"))
    draws = draws.withColumn(
        "_fl_pick", (F.floor(seeded_uniform(seed, F.lit("nn"), F.col(ROW_ID), F.col("_fl_j")) * k) + 1).cast("int")
    ).withColumn("_fl_u", seeded_uniform(seed, F.lit("step"), F.col(ROW_ID), F.col("_fl_j")))
    nn = knn_join_pruned(mino, mino, ROW_ID, feats, k, exclude_self=True, block_rows=block_rows)
    nn = nn.select(F.col("q_key").alias(ROW_ID), F.col("nn_rank").alias("_fl_pick"), F.col("b_key").alias("_fl_nb"))
    nbr = mino.select(F.col(ROW_ID).alias("_fl_nb"), *[F.col(c).alias(f"_fl_n_{c}") for c in feats])
    joined = draws.join(nn, [ROW_ID, "_fl_pick"]).join(nbr, "_fl_nb")
    return joined.select(
        F.concat(F.lit("s"), F.col(ROW_ID), F.lit(":"), F.col("_fl_j").cast("string")).alias(ROW_ID),
        F.lit(minority).alias(label_col),
        *[(F.col(c) + F.col("_fl_u") * (F.col(f"_fl_n_{c}") - F.col(c))).alias(c) for c in feats],
    )


def smote_balance(
    df: DataFrame, label_col: str, features: Sequence[str], k: int = 5, seed: int = 0,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Original rows plus synthetic rows for the smallest class (the
    ``sampling_strategy="minority"`` setting), all with ``row_id``."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    row = counts.agg(F.min(F.struct("n", F.col(label_col).alias("c"))).alias("least"), F.max("n").alias("most")).first()
    if row["most"] is None:
        return df.select(ROW_ID, label_col, *features)
    synth = smote(df, label_col, features, row["least"]["c"], row["most"], k, seed, block_rows)
    return df.select(ROW_ID, label_col, *features).unionByName(synth)


def tomek_links(
    df: DataFrame, label_col: str, features: Sequence[str], block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """``(row_id, label, partner)`` for every row in a Tomek link.

    The 1-NN table is read once: each ``(row, nearest)`` edge is keyed by its
    unordered endpoints, and an edge seen from both ends is a mutual pair."""
    nn = knn_join_pruned(df, df, ROW_ID, features, 1, exclude_self=True, block_rows=block_rows).select("q_key", "b_key")
    labels = df.select(ROW_ID, label_col)
    edges = (
        nn.join(labels.withColumnRenamed(ROW_ID, "q_key").withColumnRenamed(label_col, "_fl_lq"), "q_key")
        .join(labels.withColumnRenamed(ROW_ID, "b_key").withColumnRenamed(label_col, "_fl_lb"), "b_key")
        .select(
            F.least("q_key", "b_key").alias("_fl_a"),
            F.greatest("q_key", "b_key").alias("_fl_b"),
            (F.col("_fl_lq") != F.col("_fl_lb")).alias("_fl_diff"),
        )
    )
    pairs = edges.groupBy("_fl_a", "_fl_b").agg(F.count("*").alias("_fl_n"), F.max("_fl_diff").alias("_fl_diff"))
    links = pairs.filter((F.col("_fl_n") == 2) & F.col("_fl_diff"))
    ends = links.select(
        F.explode(F.array(F.struct(F.col("_fl_a").alias(ROW_ID), F.col("_fl_b").alias("partner")),
                          F.struct(F.col("_fl_b").alias(ROW_ID), F.col("_fl_a").alias("partner")))).alias("e")
    ).select("e.*")
    return ends.join(labels, ROW_ID).select(ROW_ID, label_col, "partner")


def remove_tomek_links(
    df: DataFrame, label_col: str, features: Sequence[str], block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    links = tomek_links(df, label_col, features, block_rows).select(ROW_ID)
    return df.join(links, ROW_ID, "left_anti")


def smote_tomek(
    df: DataFrame, label_col: str, features: Sequence[str], k: int = 5, seed: int = 0,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """SMOTE to balance, then drop both rows of every Tomek link."""
    balanced = cut_lineage(smote_balance(df, label_col, features, k, seed, block_rows))
    return remove_tomek_links(balanced, label_col, features, block_rows)
