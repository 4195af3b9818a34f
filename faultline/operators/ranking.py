"""Exact per-group running totals and hash-rank cuts without a per-group task.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task,
so one hot group (a class holding a third of the rows, a sensor column with
billions of distinct readings) becomes one straggler.

``running_totals`` range-partitions ``(group, order)`` instead, which splits
a hot group over many partitions.  Each partition computes local running sums;
a tiny table of per-(partition, group) totals (at most ``P + G - 1`` rows for
``P`` partitions and ``G`` groups) supplies each partition's starting offset.
Both branches must see the same partitions, so the ranged rows are written
once and both read what is written.

``hash_rank_cut`` answers "is this row among the first k of its class by
``md5(seed:key)``" exactly, using a histogram of hash prefixes (uniform, so
no bucket can be hot) and ranking only the one boundary bucket per class to
find the class's cut point.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.session import shared_table, shuffle_partitions

_PID = "_fl_pid"


def running_totals(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    sum_cols: Sequence[str],
    prefix: str = "cum_",
    num_partitions: int | None = None,
    groups_bounded: bool = False,
) -> DataFrame:
    """Add ``prefix + c`` = inclusive running sum of ``c`` within each group in
    ``order_cols`` order, for every ``c`` in ``sum_cols``.

    The result has only the group, order and sum columns (pre-aggregate and
    join other columns back if needed).  ``order_cols`` should make rows
    unique within a group (ties land in the same partition but their
    relative order is arbitrary).  Set
    ``groups_bounded`` when the number of groups is known to be small (e.g. a
    fixed column list): the offset table is then broadcast; otherwise AQE
    chooses the join from measured sizes.
    """
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    spark = df.sparkSession
    n_parts = num_partitions or shuffle_partitions(spark)
    narrow = df.select(*dict.fromkeys([*group_cols, *order_cols, *sum_cols]))
    order_exprs = [F.col(c) for c in order_cols]
    ranged = narrow.repartitionByRange(n_parts, *[F.col(c) for c in group_cols], *order_exprs).withColumn(
        _PID, F.spark_partition_id()
    )
    ranged = shared_table(ranged, "ranged")
    totals = ranged.groupBy(_PID, *group_cols).agg(*[F.sum(c).alias(f"_fl_t_{c}") for c in sum_cols])
    w_before = (
        Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    ).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(_PID).alias("_fl_opid"),
        *[F.col(c).alias(f"_fl_g_{c}") for c in group_cols],
        *[F.coalesce(F.sum(f"_fl_t_{c}").over(w_before), F.lit(0)).alias(f"_fl_o_{c}") for c in sum_cols],
    )
    if groups_bounded:
        offsets = F.broadcast(offsets)
    cond = ranged[_PID] == offsets["_fl_opid"]
    for c in group_cols:
        cond = cond & ranged[c].eqNullSafe(offsets[f"_fl_g_{c}"])
    joined = ranged.join(offsets, cond, "inner")
    w_run = Window.partitionBy(_PID, *group_cols).orderBy(*order_exprs).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return joined.select(
        *[F.col(c) for c in narrow.columns],
        *[(F.col(f"_fl_o_{c}") + F.sum(c).over(w_run)).alias(prefix + c) for c in sum_cols],
    )


def number_rows(df: DataFrame, out: str) -> DataFrame:
    """Append each row's 0-based place in ``df``'s order (an ordered frame).

    The ordered rows are written once; a row's place is its position in its
    partition plus the rows of the partitions before it (one row per partition)."""
    kept = shared_table(df.withColumn("_fl_mid", F.monotonically_increasing_id()), "ordered")
    kept = kept.withColumn(_PID, F.shiftright("_fl_mid", 33))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept.groupBy(_PID).agg(F.count("*").alias("_fl_n")).select(
        _PID, F.coalesce(F.sum("_fl_n").over(before), F.lit(0)).alias("_fl_before")
    )
    place = F.col("_fl_before") + F.col("_fl_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.join(F.broadcast(offsets), _PID).select(*df.columns, place.alias(out))


# A boundary bucket of more rows than this is split by four more hash digits.
EDGE_ROWS = 65_536
PREFIX_DIGITS = 4


def hash_histogram(df: DataFrame, group_col: str, hash_col: str) -> DataFrame:
    """Rows per class and hash prefix (``_fl_p``, ``_fl_nb``), written once.

    It is the one pass that class counts and rank cuts both come from."""
    prefix = F.substring(F.col(hash_col), 1, PREFIX_DIGITS).alias("_fl_p")
    hist = df.select(F.col(group_col).alias("_fl_g"), prefix).groupBy("_fl_g", "_fl_p").agg(F.count("*").alias("_fl_nb"))
    return shared_table(hist, "histogram")


def histogram_counts(hist: DataFrame, group_col: str) -> DataFrame:
    """Class sizes ``(group_col, n_class)`` from ``hash_histogram``."""
    return hist.groupBy(F.col("_fl_g").alias(group_col)).agg(F.sum("_fl_nb").alias("n_class"))


def _boundary(hist: DataFrame, quota: DataFrame) -> DataFrame:
    """Per class the prefix in which its quota ends: ``_fl_g, _fl_p, _fl_need, _fl_nb``.
    A class whose quota is 0 or reaches its size has no boundary."""
    w = Window.partitionBy("_fl_g").orderBy("_fl_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_fl_upto", F.sum("_fl_nb").over(w))
    q = quota.withColumnRenamed("_fl_g", "_fl_q")
    before = F.col("_fl_upto") - F.col("_fl_nb")
    return cum.join(q, F.col("_fl_g").eqNullSafe(F.col("_fl_q"))).filter(
        (before < F.col("_fl_k")) & (F.col("_fl_k") <= F.col("_fl_upto"))
    ).select("_fl_g", "_fl_p", (F.col("_fl_k") - before).alias("_fl_need"), "_fl_nb")


def hash_rank_cut(
    df: DataFrame,
    group_col: str,
    hash_col: str,
    tie_cols: Sequence[str],
    quota: DataFrame,
    out: str = "_fl_in",
    hist: DataFrame | None = None,
) -> DataFrame:
    """Flag rows whose rank within ``group_col`` by ``(hash_col, *tie_cols)``
    is at most the group's quota.

    ``hash_col`` must be a hex digest (uniform); ``quota`` has columns
    ``(group_col, _fl_k)`` with one row per group (a group without a row
    gets quota 0).  Exact, deterministic and free of per-group tasks:

    1. the histogram of hash prefixes (one pass) tells in which prefix each
       group's quota ends;
    2. a narrow pass (group, hash and tie columns) ranks only the rows of those
       prefixes, which gives each group's last accepted row, its cut point.  A
       prefix with more than ``EDGE_ROWS`` rows is first split by further
       digits, so the ranked rows per group stay bounded;
    3. the rows themselves are compared with their group's cut point in the
       scan's own stage; they are not shuffled.
    """
    hist = hash_histogram(df, group_col, hash_col) if hist is None else hist
    quota = shared_table(
        quota.select(F.col(group_col).alias("_fl_g"), F.col("_fl_k").cast("long").alias("_fl_k")), "quota"
    )
    key = df.select(
        F.col(group_col).alias("_fl_kg"), F.col(hash_col).alias("_fl_kh"),
        F.struct(F.col(hash_col).alias("h"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_cols)]).alias("_fl_row"),
    )
    digits = PREFIX_DIGITS
    edge = shared_table(_boundary(hist, quota), "boundary")

    def inside(edge: DataFrame, digits: int) -> DataFrame:
        e = edge.select("_fl_g", F.col("_fl_p").alias("_fl_at"), "_fl_need")
        on = F.col("_fl_kg").eqNullSafe(F.col("_fl_g")) & (F.substring("_fl_kh", 1, digits) == F.col("_fl_at"))
        return key.join(e, on)

    while (edge.agg(F.max("_fl_nb")).first()[0] or 0) > EDGE_ROWS and digits < 32:
        finer = F.substring("_fl_kh", 1, digits + PREFIX_DIGITS).alias("_fl_p")
        hist = inside(edge, digits).groupBy("_fl_g", finer).agg(F.count("*").alias("_fl_nb"))
        digits += PREFIX_DIGITS
        edge = shared_table(_boundary(hist, edge.select("_fl_g", F.col("_fl_need").alias("_fl_k"))), "boundary")
    w_edge = Window.partitionBy("_fl_kg").orderBy("_fl_row")
    cut = (
        inside(edge, digits).withColumn("_fl_r", F.row_number().over(w_edge)).filter("_fl_r <= _fl_need")
        .groupBy("_fl_g").agg(F.max("_fl_row").alias("_fl_cut"))
    )
    plan = quota.filter("_fl_k > 0").join(cut.withColumnRenamed("_fl_g", "_fl_g2"), F.col("_fl_g").eqNullSafe(F.col("_fl_g2")), "left")
    plan = shared_table(plan.select("_fl_g", "_fl_cut", F.lit(True).alias("_fl_some")), "cuts")  # one row per group
    t = df.join(plan, df[group_col].eqNullSafe(plan["_fl_g"]), "left")
    row = F.struct(F.col(hash_col).alias("h"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_cols)])
    flag = F.when(F.col("_fl_some").isNull(), False).when(F.col("_fl_cut").isNull(), True).otherwise(row <= F.col("_fl_cut"))
    return t.select(*[df[c] for c in df.columns], flag.alias(out))
