"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on views named after the driver's tables.  The SQL is the
straightforward single-node formulation (global windows, quadratic
neighbour joins) of what the Spark plans compute in a distributed way.
"""

from __future__ import annotations

from faultline.operators.training import sample_grid
from faultline.plans import fixtures as fx

D = 6  # rounding digits, as in catalog.DIGITS
KEYS = ", ".join(fx.SENSOR_KEYS)
KEY_TEXT = ", ".join(f"CAST({k} AS VARCHAR)" for k in fx.SENSOR_KEYS)


def _finish(sql: str) -> str:
    """Expand ``ROUNDX(x, d)`` into ``(round(x, d) + 0.0)``: DuckDB can round a
    small negative to -0.0 where Spark gives 0.0; adding 0.0 makes it +0.0."""
    out, i = [], 0
    while True:
        j = sql.find("ROUNDX(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth = j + len("ROUNDX("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append("(round(" + _finish(sql[j + len("ROUNDX("):k - 1]) + ") + 0.0)")
        i = k


def _masked(c: str) -> str:
    return (
        f"CASE WHEN substr(md5(concat_ws(':', 'na', '{c}', {KEY_TEXT})), 1, 1) = '0' "
        f"THEN 'na' ELSE CAST({c} AS VARCHAR) END AS {c}"
    )


SENSOR_RAW = f"""
SELECT {KEYS},
       CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 'pos' ELSE 'neg' END AS class,
       {", ".join(_masked(c) for c in fx.SENSOR_MEASURES)}
FROM lineitem
"""

SENSOR_CLEAN = f"""
SELECT {KEYS}, class,
       {", ".join(f"CAST(nullif({c}, 'na') AS DOUBLE) AS {c}" for c in fx.SENSOR_MEASURES)}
FROM ({SENSOR_RAW}) raw
"""


def split_sql(source: str, seed: int = 1, test_size: float = 0.2, keys: list[str] | None = None) -> str:
    """Rows of ``source`` plus ``split``, mirroring sampling.stratified_split."""
    keys = keys or list(fx.SENSOR_KEYS)
    key_list = ", ".join(keys)
    key_text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"""
WITH src AS ({source}),
counts AS (SELECT class, count(*) AS n_class FROM src GROUP BY class),
a0 AS (SELECT class, n_class, sum(n_class) OVER () AS n FROM counts),
a1 AS (SELECT *, n - ceil(CAST({test_size} AS DOUBLE) * n) AS n_train FROM a0),
a2 AS (SELECT *, (n_train * n_class) / n AS cont FROM a1),
a3 AS (SELECT *, floor(cont) AS fl FROM a2),
a4 AS (SELECT *, n_train - sum(fl) OVER () AS need,
              row_number() OVER (ORDER BY cont - fl DESC, class) AS ord FROM a3),
alloc AS (SELECT class, CAST(fl + CASE WHEN ord <= need THEN 1 ELSE 0 END AS BIGINT) AS train_k FROM a4),
ranked AS (SELECT src.*, row_number() OVER (
              PARTITION BY class ORDER BY md5(concat_ws(':', '{seed}', {key_text})), {key_list}) AS rn
           FROM src)
SELECT ranked.* EXCLUDE (rn), CASE WHEN rn <= train_k THEN 'train' ELSE 'test' END AS split
FROM ranked JOIN alloc USING (class)
"""


def _ks_chain(prefix: str, base: str, cur: str, cols: list[str], vtype: str, propagate: bool) -> str:
    long_parts = []
    for side, src in ((0, base), (1, cur)):
        for c in cols:
            v = f"CAST({c} AS {vtype})"
            if vtype == "DOUBLE":
                v = f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"
            long_parts.append(f"SELECT '{c}' AS col, {v} AS value, {side} AS side FROM {src}")
    long_sql = "\nUNION ALL ".join(long_parts)
    d_expr = "d.d_statistic"
    if propagate:
        d_expr = "CASE WHEN s.null_base + s.null_current = 0 THEN d.d_statistic END"
    return f"""
{prefix}_long AS ({long_sql}),
{prefix}_counts AS (SELECT col, value, count(*) FILTER (WHERE side = 0) AS c1,
                           count(*) FILTER (WHERE side = 1) AS c2 FROM {prefix}_long GROUP BY col, value),
{prefix}_stats AS (SELECT col,
    CAST(coalesce(sum(c1) FILTER (WHERE value IS NOT NULL), 0) AS BIGINT) AS n_base,
    CAST(coalesce(sum(c2) FILTER (WHERE value IS NOT NULL), 0) AS BIGINT) AS n_current,
    CAST(coalesce(sum(c1) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS null_base,
    CAST(coalesce(sum(c2) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS null_current
  FROM {prefix}_counts GROUP BY col),
{prefix}_cum AS (SELECT col, value,
    sum(c1) OVER (PARTITION BY col ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_c1,
    sum(c2) OVER (PARTITION BY col ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_c2
  FROM {prefix}_counts WHERE value IS NOT NULL),
{prefix}_d AS (SELECT c.col, max(abs(CAST(cum_c1 AS DOUBLE) / n_base - CAST(cum_c2 AS DOUBLE) / n_current)) AS d_statistic
  FROM {prefix}_cum c JOIN {prefix}_stats s USING (col) GROUP BY c.col),
{prefix}_rep AS (SELECT s.*, {d_expr} AS d_statistic FROM {prefix}_stats s LEFT JOIN {prefix}_d d USING (col))
"""


def ks_sql(base: str, cur: str, numeric: list[str], textual: list[str] = (), propagate: bool = False,
           threshold: float = 0.05) -> str:
    """Drift report SQL; ``base``/``cur`` are SELECTs (wrapped as CTEs)."""
    chains = []
    reps = []
    if numeric:
        chains.append(_ks_chain("kn", "ks_base", "ks_cur", numeric, "DOUBLE", propagate))
        reps.append("SELECT * FROM kn_rep")
    if textual:
        chains.append(_ks_chain("kt", "ks_base", "ks_cur", list(textual), "VARCHAR", propagate))
        reps.append("SELECT * FROM kt_rep")
    return f"""
WITH ks_base AS ({base}), ks_cur AS ({cur}),
{",".join(chains)},
rep AS ({" UNION ALL ".join(reps)}),
en AS (SELECT *, sqrt(greatest(round_even((CAST(n_base AS DOUBLE) * CAST(n_current AS DOUBLE)) / CAST(n_base + n_current AS DOUBLE), 0), 1.0)) AS se FROM rep),
lam AS (SELECT *, (se + 0.12 + 0.11 / se) * d_statistic AS lam FROM en),
pv AS (SELECT *, CASE WHEN n_base > 0 AND n_current > 0 THEN
          CASE WHEN lam IS NULL THEN NULL WHEN lam < 0.2 THEN 1.0
               ELSE greatest(0.0, least(1.0, 2.0 * list_sum(list_transform(range(1, 101),
                      lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END)
                                * exp(CAST(-2.0 AS DOUBLE) * k * k * lam * lam))))) END END AS p_value
       FROM lam)
SELECT col AS "column", n_base, n_current, null_base, null_current,
       ROUNDX(d_statistic, {D}) AS d_statistic, ROUNDX(p_value, {D}) AS p_value,
       coalesce(p_value < {threshold}, false) AS drift_status
FROM pv
"""


MEASURE_LIST = list(fx.SENSOR_MEASURES)

DRIFT_LINEITEM = ks_sql(
    f"SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{fx.DRIFT_CUTOFF}'",
    f"SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{fx.DRIFT_CUTOFF}'",
    MEASURE_LIST,
)

DRIFT_PROFILE = f"SELECT \"column\", n_base, n_current, null_base, null_current, drift_status FROM ({DRIFT_LINEITEM})"

DRIFT_EVENTS = ks_sql(
    f"SELECT * FROM events WHERE ts < TIMESTAMP '{fx.EVENTS_CUTOFF}'",
    f"SELECT * FROM events WHERE ts >= TIMESTAMP '{fx.EVENTS_CUTOFF}'",
    ["value"],
    ["event_type"],
)

_HALF = f"substr(md5(concat_ws(':', 'half', {KEY_TEXT})), 1, 1) IN ('0','1','2','3','4','5','6','7')"
DRIFT_SHIFTED = ks_sql(
    f"SELECT * FROM lineitem WHERE NOT ({_HALF})",
    f"SELECT * REPLACE (l_discount + 0.01 AS l_discount) FROM lineitem WHERE {_HALF}",
    MEASURE_LIST,
)

_SPLIT_CLEAN = split_sql(SENSOR_CLEAN)
DRIFT_SENSOR_PROPAGATE = ks_sql(
    f"SELECT * FROM ({_SPLIT_CLEAN}) WHERE split = 'train'",
    f"SELECT * FROM ({_SPLIT_CLEAN}) WHERE split = 'test'",
    MEASURE_LIST,
    ["class"],
    propagate=True,
)

SENSOR_CLEAN_Q = f"""
SELECT *, CAST(CASE WHEN class = 'neg' THEN 0 WHEN class = 'pos' THEN 1 END AS INTEGER) AS label
FROM ({SENSOR_CLEAN})
"""

_SPLIT_RAW = split_sql(SENSOR_RAW)


def _violations_for(frame: str) -> str:
    parts = [
        f"SELECT '{frame}' AS frame, 'column_count' AS \"check\", 'expected 6 columns, found 9' AS detail",
        f"SELECT '{frame}', 'missing_numeric_column', 'sensor_x'",
    ]
    for c in fx.SENSOR_MEASURES:
        parts.append(
            f"SELECT '{frame}', 'non_numeric_values', '{c}: ' || CAST(n AS VARCHAR) FROM ("
            f"SELECT count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS n "
            f"FROM sp WHERE split = '{frame}') WHERE n > 0"
        )
    return "\nUNION ALL ".join(parts)


SCHEMA_VIOLATIONS = f"""
WITH sp AS ({_SPLIT_RAW})
{_violations_for('train')}
UNION ALL
{_violations_for('test')}
"""

DOWNSAMPLE_SENSOR = f"""
WITH s AS ({SENSOR_RAW}),
neg AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '42', {KEY_TEXT})), {KEYS}) AS rn
        FROM s WHERE class = 'neg'),
k AS (SELECT CAST(round_even(CAST(0.3 AS DOUBLE) * count(*), 0) AS BIGINT) AS k FROM s WHERE class = 'neg')
SELECT * FROM s WHERE class = 'pos'
UNION ALL
SELECT neg.* EXCLUDE (rn) FROM neg, k WHERE rn <= k.k
"""

SPLIT_SENSOR = f"SELECT {KEYS}, class, split FROM ({_SPLIT_RAW})"

_SCORES = f"""
  ROUNDX(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), {D}) AS f1_score,
  ROUNDX(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), {D}) AS precision_score,
  ROUNDX(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), {D}) AS recall_score,
  ROUNDX(1.0 - (CAST(fp + fn AS DOUBLE)) / nullif((CAST(tp + fn AS DOUBLE) * (tn + fn) + CAST(tn + fp AS DOUBLE) * (tp + fp)) / (tp + fp + fn + tn), 0), {D}) AS cohen_kappa_score,
  ROUNDX((CAST(tp AS DOUBLE) / nullif(tp + fn, 0) + CAST(tn AS DOUBLE) / nullif(tn + fp, 0)) / 2.0, {D}) AS roc_auc_score
"""


def _counts(t: str, p: str) -> str:
    return f"""
  CAST(count(*) FILTER (WHERE {t} = 1 AND {p} = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE {t} = 0 AND {p} = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE {t} = 1 AND {p} = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE {t} = 0 AND {p} = 0) AS BIGINT) AS tn"""


CLASSIFICATION_METRICS = f"""
WITH c AS (SELECT {_counts('toxic', '1 - quality')} FROM labels)
SELECT tp, fp, fn, tn, {_SCORES} FROM c
"""

_SCALER_FIT = f"""
WITH tr AS (SELECT * FROM ({_SPLIT_CLEAN}) WHERE split = 'train'),
q AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS col, quantile_cont({c}, 0.25) AS q_lo, quantile_cont({c}, 0.5) AS center, "
    f"quantile_cont({c}, 0.75) AS q_hi FROM tr" for c in fx.SENSOR_MEASURES)})
SELECT col AS "column", center, CASE WHEN q_hi - q_lo < {10 * 2.220446049250313e-16!r} THEN 1.0 ELSE q_hi - q_lo END AS scale
FROM q
"""

ROBUST_SCALER_FIT = f"""SELECT "column", ROUNDX(center, {D}) AS center, ROUNDX(scale, {D}) AS scale FROM ({_SCALER_FIT})"""

ROBUST_SCALE = f"""
WITH p AS ({_SCALER_FIT}), c AS ({SENSOR_CLEAN})
SELECT {KEYS},
  {", ".join(
      f"ROUNDX((c.{m} - (SELECT center FROM p WHERE \"column\" = '{m}')) / (SELECT scale FROM p WHERE \"column\" = '{m}'), {D}) AS {m}"
      for m in fx.SENSOR_MEASURES)}
FROM c
"""

VF = list(fx.VEC_FEATURES)
NF = len(VF)
UNIT = "CAST(4503599627370496 AS DOUBLE)"


def _unit(*parts: str) -> str:
    return f"CAST(CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 13) AS BIGINT) AS DOUBLE) / {UNIT}"


VEC_WIDE = f"""
SELECT vec_id, CASE WHEN label = 0 THEN 'pos' ELSE 'neg' END AS class,
       {", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS f{i}" for i in range(1, NF + 1))}
FROM embeddings
"""

VEC_MISSING = f"""
SELECT vec_id, class,
       {", ".join(f"CASE WHEN substr(md5(concat_ws(':', 'miss', '{c}', CAST(vec_id AS VARCHAR))), 1, 1) = '0' THEN NULL ELSE {c} END AS {c}" for c in VF)}
FROM ({VEC_WIDE})
"""

_ss = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0)" for c in VF)
_nsh = " + ".join(f"CAST((r.{c} - d.{c}) IS NOT NULL AS INTEGER)" for c in VF)

KNN_IMPUTE = f"""
WITH vm AS ({VEC_MISSING}),
don AS (SELECT * FROM ({split_sql("SELECT * FROM vm", keys=["vec_id"])}) WHERE split = 'train'),
recv AS (SELECT * FROM vm WHERE {" OR ".join(f"{c} IS NULL" for c in VF)}),
pr AS (SELECT r.vec_id AS rid, d.vec_id AS did, {_ss} AS ss, {_nsh} AS nsh,
              {", ".join(f"d.{c} AS v_{c}, r.{c} IS NULL AS m_{c}" for c in VF)}
       FROM recv r CROSS JOIN don d),
dd AS (SELECT *, CASE WHEN nsh > 0 THEN sqrt(CAST({NF} AS DOUBLE) / nsh * ss) END AS dist FROM pr),
cand AS ({" UNION ALL ".join(f"SELECT rid, '{c}' AS col, did, dist, v_{c} AS val FROM dd WHERE m_{c} AND v_{c} IS NOT NULL AND dist IS NOT NULL" for c in VF)}),
top AS (SELECT *, row_number() OVER (PARTITION BY rid, col ORDER BY dist, did) AS r FROM cand),
imp AS (SELECT rid, col, avg(val) AS v FROM top WHERE r <= 5 GROUP BY rid, col),
means AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in VF)} FROM don)
SELECT vm.vec_id, vm.class,
       {", ".join(f"ROUNDX(coalesce(vm.{c}, i_{c}.v, means.{c}), {D}) AS {c}" for c in VF)}
FROM vm CROSS JOIN means
{" ".join(f"LEFT JOIN imp i_{c} ON i_{c}.rid = vm.vec_id AND i_{c}.col = '{c}'" for c in VF)}
"""

VEC_ROWS = f"SELECT CAST(vec_id AS VARCHAR) AS row_id, class, {', '.join(VF)} FROM ({VEC_WIDE})"


def smote_sql(rows: str, seed: int = 0, k: int = 5, feats: list[str] = VF) -> str:
    """Original rows plus synthetic minority rows (mirrors resample.smote_balance)."""
    return f"""
WITH vr AS ({rows}),
cnt AS (SELECT class, count(*) AS n FROM vr GROUP BY class),
par AS (SELECT (SELECT class FROM cnt ORDER BY n, class LIMIT 1) AS mclass,
               (SELECT max(n) FROM cnt) - (SELECT min(n) FROM cnt) AS n_new,
               (SELECT min(n) FROM cnt) AS n_min),
par2 AS (SELECT *, n_new // n_min AS base, n_new % n_min AS extra, {k} AS k_eff FROM par),
mino AS (SELECT vr.* FROM vr, par2 WHERE vr.class = par2.mclass AND par2.n_new > 0 AND par2.n_min > {k}),
alloc AS (SELECT mino.*, row_number() OVER (ORDER BY md5(concat_ws(':', '{seed}', 'alloc', row_id)), row_id) AS ar FROM mino),
per_row AS (SELECT alloc.*, base + CASE WHEN ar <= extra THEN 1 ELSE 0 END AS nj, k_eff FROM alloc, par2),
draws AS (SELECT per_row.*, j FROM per_row, LATERAL (SELECT unnest(range(1, nj + 1)) AS j) WHERE nj > 0),
draws2 AS (SELECT *, CAST(floor(({_unit(f"'{seed}'", "'nn'", "row_id", "CAST(j AS VARCHAR)")}) * k_eff) + 1 AS INTEGER) AS pick,
                  {_unit(f"'{seed}'", "'step'", "row_id", "CAST(j AS VARCHAR)")} AS u
           FROM draws),
mp AS (SELECT a.row_id AS q, b.row_id AS b, sqrt({" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in feats)}) AS dist
       FROM mino a JOIN mino b ON a.row_id <> b.row_id),
nn AS (SELECT q, b, row_number() OVER (PARTITION BY q ORDER BY dist, b) AS rk FROM mp),
synth AS (SELECT 's' || d.row_id || ':' || CAST(d.j AS VARCHAR) AS row_id, d.class,
                 {", ".join(f"d.{c} + d.u * (m.{c} - d.{c}) AS {c}" for c in feats)}
          FROM draws2 d JOIN nn ON nn.q = d.row_id AND nn.rk = d.pick JOIN mino m ON m.row_id = nn.b)
SELECT row_id, class, {", ".join(feats)} FROM vr
UNION ALL
SELECT row_id, class, {", ".join(feats)} FROM synth
"""


def tomek_sql(rows: str, feats: list[str] = VF) -> str:
    """``(row_id, class, partner)`` for rows in a Tomek link of ``rows``."""
    return f"""
WITH tr AS ({rows}),
pd AS (SELECT a.row_id AS q, b.row_id AS b, sqrt({" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in feats)}) AS dist
       FROM tr a JOIN tr b ON a.row_id <> b.row_id),
n1 AS (SELECT q, b FROM (SELECT q, b, row_number() OVER (PARTITION BY q ORDER BY dist, b) AS rk FROM pd) WHERE rk = 1)
SELECT x.q AS row_id, lq.class, x.b AS partner
FROM n1 x JOIN n1 y ON x.b = y.q AND y.b = x.q
JOIN tr lq ON lq.row_id = x.q JOIN tr lb ON lb.row_id = x.b
WHERE lq.class <> lb.class
"""


SMOTE = f"SELECT row_id, class, {', '.join(f'ROUNDX({c}, {D}) AS {c}' for c in VF)} FROM ({smote_sql(VEC_ROWS)})"
TOMEK_LINKS = tomek_sql(VEC_ROWS)
SMOTE_TOMEK = f"""
WITH bal AS ({smote_sql(VEC_ROWS)}),
links AS ({tomek_sql("SELECT * FROM bal")})
SELECT row_id, class, {', '.join(f'ROUNDX({c}, {D}) AS {c}' for c in VF)}
FROM bal WHERE row_id NOT IN (SELECT row_id FROM links)
"""

_LAB_SPLIT = split_sql("SELECT doc_id, toxic AS class, 1 - quality AS y_pred FROM labels", keys=["doc_id"])


def _score_cols(prefix: str, tp: str, fp: str, fn: str, tn: str) -> str:
    return f"""
  coalesce(2.0 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0) AS {prefix}f1_score,
  coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fp}, 0), 0) AS {prefix}precision_score,
  coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0), 0) AS {prefix}recall_score,
  1.0 - (CAST({fp} + {fn} AS DOUBLE)) / nullif((CAST({tp} + {fn} AS DOUBLE) * ({tn} + {fn}) + CAST({tn} + {fp} AS DOUBLE) * ({tp} + {fp})) / ({tp} + {fp} + {fn} + {tn}), 0) AS {prefix}cohen_kappa_score,
  (CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0) + CAST({tn} AS DOUBLE) / nullif({tn} + {fp}, 0)) / 2.0 AS {prefix}roc_auc_score"""


ADEQUACY_GATES = f"""
WITH sp AS ({_LAB_SPLIT}),
c AS (SELECT split, {_counts('class', 'y_pred')} FROM sp GROUP BY split),
s AS (SELECT split, {_score_cols('', 'tp', 'fp', 'fn', 'tn')} FROM c),
w AS (SELECT max(f1_score) FILTER (WHERE split = 'train') AS train_f1_score,
             max(roc_auc_score) FILTER (WHERE split = 'train') AS train_roc_auc_score,
             max(f1_score) FILTER (WHERE split = 'test') AS test_f1_score,
             max(roc_auc_score) FILTER (WHERE split = 'test') AS test_roc_auc_score FROM s)
SELECT ROUNDX(train_f1_score, {D}) AS train_f1_score, ROUNDX(train_roc_auc_score, {D}) AS train_roc_auc_score,
       ROUNDX(test_f1_score, {D}) AS test_f1_score, ROUNDX(test_roc_auc_score, {D}) AS test_roc_auc_score,
       ROUNDX(abs(train_f1_score - test_f1_score), {D}) AS f1_gap,
       coalesce(train_f1_score > 0.6 AND train_roc_auc_score > 0.7, false) AS adequate,
       coalesce(abs(train_f1_score - test_f1_score) <= 0.05, false) AS fit_ok,
       coalesce(train_f1_score > 0.6 AND train_roc_auc_score > 0.7 AND abs(train_f1_score - test_f1_score) <= 0.05, false) AS passed
FROM w
"""

_CC_COLS = ["f1_score", "precision_score", "recall_score", "cohen_kappa_score", "roc_auc_score"]
CHAMPION_CHALLENGER = f"""
WITH sc AS (SELECT l.toxic AS y_true, 1 - l.quality AS tp_, CASE WHEN l.quality = 0 AND d.n_chars < 1500 THEN 1 ELSE 0 END AS bp_
            FROM labels l LEFT JOIN documents d USING (doc_id)),
c AS (SELECT {_counts('y_true', 'tp_').replace(' AS tp', ' AS t_tp').replace(' AS fp', ' AS t_fp').replace(' AS fn', ' AS t_fn').replace(' AS tn', ' AS t_tn')},
             {_counts('y_true', 'bp_').replace(' AS tp', ' AS b_tp').replace(' AS fp', ' AS b_fp').replace(' AS fn', ' AS b_fn').replace(' AS tn', ' AS b_tn')}
      FROM sc),
s AS (SELECT {_score_cols('trained_', 't_tp', 't_fp', 't_fn', 't_tn')}, {_score_cols('best_', 'b_tp', 'b_fp', 'b_fn', 'b_tn')} FROM c)
SELECT {", ".join(f"ROUNDX(trained_{m}, {D}) AS trained_{m}" for m in _CC_COLS)},
       {", ".join(f"ROUNDX(best_{m}, {D}) AS best_{m}" for m in _CC_COLS)},
       ROUNDX(trained_f1_score - best_f1_score, {D}) AS improved_f1_score,
       ROUNDX(trained_roc_auc_score - best_roc_auc_score, {D}) AS improved_roc_auc_score,
       coalesce(trained_f1_score - best_f1_score > 0.02 OR trained_roc_auc_score - best_roc_auc_score > 0.02, false) AS is_model_accepted
FROM s
"""

DRIFT_VERDICT = f"""
SELECT coalesce(bool_and(NOT drift_status), true) AS no_drift,
       CAST(count(*) FILTER (WHERE drift_status) AS BIGINT) AS n_drifted,
       CAST(count(*) AS BIGINT) AS n_columns
FROM ({DRIFT_LINEITEM})
"""

DECODED_PREDICTIONS = """
SELECT CASE WHEN 1 - quality = 0 THEN 'neg' WHEN 1 - quality = 1 THEN 'pos' END AS class, doc_id, quality, toxic
FROM labels
"""

# -- twins of plans/roundtrips.py --------------------------------------------------------
CUSTOMER_RAW = """
SELECT CASE WHEN c_nationkey < 3 THEN 'pos' ELSE 'neg' END AS class, CAST(c_custkey AS VARCHAR) AS aa_000,
       CASE WHEN c_acctbal < 0 THEN 'na' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS ab_000,
       CAST(c_nationkey AS VARCHAR) AS br_000
FROM customer
"""
CUSTOMER_NULL = f"SELECT class, aa_000, nullif(ab_000, 'na') AS ab_000, br_000 FROM ({CUSTOMER_RAW})"
FEW = VF[:4]

def imputed_sql(rows: str, don: str) -> str:
    """``rows`` (vec_id, class, features with NULLs) imputed from the rows of ``don`` (k = 5)."""
    ss = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0)" for c in VF)
    nsh = " + ".join(f"CAST((r.{c} - d.{c}) IS NOT NULL AS INTEGER)" for c in VF)
    return f"""
WITH vm AS MATERIALIZED ({rows}), don AS MATERIALIZED ({don}),
pr AS MATERIALIZED (SELECT r.vec_id AS rid, d.vec_id AS did, {ss} AS ss, {nsh} AS nsh FROM vm r CROSS JOIN don d),
dd AS MATERIALIZED (SELECT rid, did, sqrt(CAST({NF} AS DOUBLE) / nsh * ss) AS dist FROM pr WHERE nsh > 0),
gone AS (SELECT vec_id AS rid, unnest(range(0, {NF})) AS j, unnest([{", ".join(VF)}]) AS x FROM vm),
have AS (SELECT vec_id AS did, unnest(range(0, {NF})) AS j, unnest([{", ".join(VF)}]) AS x FROM don),
cand AS (SELECT g.rid, g.j, dd.did, dd.dist, h.x AS val FROM gone g JOIN dd USING (rid) JOIN have h ON h.did = dd.did AND h.j = g.j
         WHERE g.x IS NULL AND h.x IS NOT NULL),
top AS (SELECT *, row_number() OVER (PARTITION BY rid, j ORDER BY dist, did) AS r FROM cand),
imp AS (SELECT rid, map_from_entries(list((j, v))) AS m FROM (SELECT rid, j, avg(val) AS v FROM top WHERE r <= 5 GROUP BY rid, j) GROUP BY rid),
means AS (SELECT {", ".join(f"avg({c}) AS m_{c}" for c in VF)} FROM don)
SELECT vm.vec_id, vm.class, {", ".join(f"coalesce(vm.{c}, imp.m[{j}], m_{c}) AS {c}" for j, c in enumerate(VF))}
FROM vm CROSS JOIN means LEFT JOIN imp ON imp.rid = vm.vec_id
"""


def preprocessed_sql(rows: str, don: str) -> str:
    """``rows`` imputed from ``don`` and scaled by the quantiles of the imputed rows that ``don`` holds."""
    return f"""
WITH filled AS MATERIALIZED ({imputed_sql(rows, don)}),
tr AS (SELECT * FROM filled WHERE vec_id IN (SELECT vec_id FROM ({don}))),
q AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in VF)} FROM tr)
SELECT vec_id, class, {", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} < 2.220446049250313e-15 THEN 1.0 ELSE s_{c} END AS {c}" for c in VF)}
FROM filled, q
"""


_VEC_TRAIN = f"SELECT * EXCLUDE (split) FROM ({split_sql(VEC_MISSING, keys=['vec_id'])}) WHERE split = 'train'"
PREPROCESS_STATE = f"""
SELECT vec_id, class, {", ".join(f"ROUNDX({c}, {D}) AS {c}" for c in VF)} FROM ({preprocessed_sql(VEC_MISSING, _VEC_TRAIN)})
"""


def trees_sql(rows: str, params: dict, train: str = "true", cut_rows: str = "tr") -> str:
    """CTEs that grow trees on the ``rows`` (vec_id, class, features) for which ``train`` holds, with
    bins from the rows for which ``cut_rows`` holds.  They end with ``scored`` (vec_id, y, tr, m: the margin) and ``nodes`` (tree, node, feature, cut_no, default_left, weight)."""
    eta, depth, rounds, bins = (params[k] for k in ("learning_rate", "max_depth", "n_estimators", "max_bins"))
    s = "16777216.0::DOUBLE"
    out = [
        f"rws AS MATERIALIZED (SELECT *, CASE WHEN class = 'pos' THEN 1 ELSE 0 END AS y, ({train}) AS tr FROM ({rows}))",
        f"lng AS MATERIALIZED (SELECT vec_id, tr, unnest(range(0, {NF})) AS f, unnest([{', '.join(VF)}]) AS x FROM rws)",
        f"cuts AS (SELECT f, list_sort(list_distinct(quantile_cont(x, [{', '.join(str(i / bins) for i in range(1, bins))}]))) AS c"
        f" FROM lng WHERE {cut_rows} AND x IS NOT NULL GROUP BY f)",
        "binned AS MATERIALIZED (SELECT vec_id, f, CASE WHEN x IS NULL THEN 255 ELSE len(list_filter(c, lambda v: v <= x)) END AS b"
        " FROM lng JOIN cuts USING (f))",
        "m0 AS (SELECT vec_id, y, tr, 0.0::DOUBLE AS m FROM rws)",
    ]
    nodes = []
    for t in range(rounds):
        out.append(
            f"n{t}_0 AS MATERIALIZED (SELECT vec_id, tr, 1 AS node, CAST(round((p - y) * {s}) AS BIGINT) AS g, CAST(round(p * (1.0 - p) * {s}) AS BIGINT) AS h"
            f" FROM (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-m)) AS p FROM m{t}))"
        )
        for d in range(depth):
            at = f"{t}_{d}"
            out += [
                f"h{at} AS (SELECT node, f, b, sum(g) AS g, sum(h) AS h FROM n{at} JOIN binned USING (vec_id) WHERE tr AND node >= {2 ** d} GROUP BY node, f, b)",
                f"w{at} AS (SELECT node, f, b, sum(g) OVER nf / {s} AS g, sum(h) OVER nf / {s} AS h,"
                f" sum(g) OVER up / {s} AS gl, sum(h) OVER up / {s} AS hl,"
                f" coalesce(sum(g) FILTER (WHERE b = 255) OVER nf, 0) / {s} AS gm, coalesce(sum(h) FILTER (WHERE b = 255) OVER nf, 0) / {s} AS hm"
                f" FROM h{at} WINDOW nf AS (PARTITION BY node, f), up AS (PARTITION BY node, f ORDER BY b ROWS UNBOUNDED PRECEDING))",
                f"s{at} AS (SELECT node, f, b, lft, g, h, gl + CASE WHEN lft THEN gm ELSE 0 END AS gl, hl + CASE WHEN lft THEN hm ELSE 0 END AS hl"
                f" FROM w{at}, (VALUES (false), (true)) v(lft) WHERE b < 255)",
                f"g{at} AS (SELECT *, gl * gl / (hl + 1.0) + (g - gl) * (g - gl) / (h - hl + 1.0) - g * g / (h + 1.0) AS gain"
                f" FROM s{at} WHERE hl >= 1.0 AND h - hl >= 1.0)",
                f"b{at} AS MATERIALIZED (SELECT node, f, b + 1 AS cut, lft FROM g{at} WHERE gain > 1e-6"
                f" QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b, lft) = 1)",
                f"n{t}_{d + 1} AS MATERIALIZED (SELECT n.vec_id, n.tr, n.g, n.h, CASE WHEN s.node IS NULL THEN n.node"
                f" WHEN CASE WHEN x.b = 255 THEN s.lft ELSE x.b < s.cut END THEN 2 * n.node ELSE 2 * n.node + 1 END AS node"
                f" FROM n{at} n LEFT JOIN b{at} s ON s.node = n.node LEFT JOIN binned x ON x.vec_id = n.vec_id AND x.f = s.f)",
            ]
            nodes.append(f"SELECT {t} AS tree, node, f, cut, lft, NULL::DOUBLE AS weight FROM b{at}")
        out += [
            f"l{t} AS MATERIALIZED (SELECT node, -(sum(g) / {s}) / (sum(h) / {s} + 1.0) * {eta}::DOUBLE AS w FROM n{t}_{depth} WHERE tr GROUP BY node)",
            f"m{t + 1} AS MATERIALIZED (SELECT r.vec_id, r.y, r.tr, r.m + l.w AS m FROM m{t} r JOIN n{t}_{depth} n USING (vec_id) JOIN l{t} l USING (node))",
        ]
        nodes.append(f"SELECT {t}, node, NULL, NULL, NULL, w FROM l{t}")
    out += [f"scored AS (SELECT * FROM m{rounds})", "nodes AS (" + " UNION ALL ".join(nodes) + ")"]
    return ",\n".join(out)


_PREDICTION = "CAST(CASE WHEN m > 0 THEN 1 ELSE 0 END AS INTEGER)"
_CLASS = "CASE WHEN y = 1 THEN 'pos' ELSE 'neg' END"
GBT_PREDICT = f"""
WITH {trees_sql(split_sql(VEC_WIDE, keys=["vec_id"]), fx.TREES, "split = 'train'")}
SELECT vec_id, {_CLASS} AS class, CAST(y AS INTEGER) AS label, {_PREDICTION} AS prediction FROM scored WHERE NOT tr
"""
GBT_SCORED_ROWS = f"""
WITH {trees_sql(VEC_MISSING, fx.TREES)}
SELECT vec_id, {_CLASS} AS class, CAST(y AS INTEGER) AS label, {_PREDICTION} AS prediction,
       ROUNDX(1.0::DOUBLE / (1.0::DOUBLE + exp(-m)), {D}) AS probability FROM scored
"""
GBT_NODES = f"""
WITH {trees_sql(VEC_MISSING, fx.TREES)}
SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS BIGINT) AS node, coalesce('f' || CAST(f + 1 AS VARCHAR), '') AS feature,
       CAST(coalesce(cut, 0) AS INTEGER) AS cut_no, coalesce(lft, false) AS default_left, ROUNDX(coalesce(weight, 0), {D}) AS weight
FROM nodes
"""
_READY = preprocessed_sql(VEC_MISSING, VEC_MISSING)
SENSOR_MODEL = f"""
WITH {trees_sql(_READY, fx.TREES)}
SELECT s.vec_id, {_CLASS} AS class, {_PREDICTION} AS prediction, {", ".join(f"ROUNDX({c}, {D}) AS {c}" for c in VF[:2])}
FROM scored s JOIN rws r USING (vec_id, y)
"""
BATCH_SCORING = f"""
WITH {trees_sql(_READY, fx.TREES)}
SELECT CASE WHEN m > 0 THEN 'pos' ELSE 'neg' END AS class, {", ".join(f"ROUNDX(v.{c}, {D}) AS {c}" for c in VF)}
FROM scored JOIN ({VEC_MISSING}) v USING (vec_id)
"""


def _search_accuracy() -> str:
    points = sample_grid(fx.SEARCH_GRID, 2, 1)
    folds = f"""
SELECT *, CASE WHEN rn <= n // 3 THEN 0 WHEN rn <= n * 2 // 3 THEN 1 ELSE 2 END AS fold FROM (
  SELECT *, row_number() OVER (PARTITION BY class ORDER BY md5(concat_ws(':', '1', CAST(vec_id AS VARCHAR))), vec_id) AS rn,
         count(*) OVER (PARTITION BY class) AS n FROM ({VEC_MISSING}))"""
    parts = []
    for i, p in enumerate(points):
        for k in range(3):
            parts.append(
                f"SELECT {i} AS candidate, avg(CASE WHEN (m > 0) = (y = 1) THEN 1.0::DOUBLE ELSE 0.0 END) AS a FROM"
                f" (WITH {trees_sql(folds, p, f'fold <> {k}', 'true')} SELECT * FROM scored WHERE NOT tr)"
            )
    known = ", ".join(f"({i}, {p['learning_rate']}::DOUBLE, {p['max_depth']}, {p['n_estimators']})" for i, p in enumerate(points))
    return f"""
WITH acc AS (SELECT candidate, sum(a) / 3 AS a FROM ({" UNION ALL ".join(parts)}) GROUP BY candidate)
SELECT learning_rate, max_depth, n_estimators, ROUNDX(a, {D}) AS cv_accuracy, row_number() OVER (ORDER BY a DESC, candidate) = 1 AS chosen
FROM acc JOIN (VALUES {known}) p(candidate, learning_rate, max_depth, n_estimators) USING (candidate)
"""


_SCORES3 = _SCORES.replace(f", {D})", ", 3)")
METRICS_HISTORY = f"""
WITH a AS (SELECT 1700000000 AS timestamp, {_counts('toxic', '1 - quality')} FROM labels
           UNION ALL SELECT 1700000001, {_counts('toxic', 'toxic')} FROM labels)
SELECT CAST(timestamp AS BIGINT) AS timestamp, {_SCORES3} FROM a
"""
SHUFFLED_ROWS = """
SELECT c_custkey, row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(c_custkey AS VARCHAR))), c_custkey) - 1 AS place
FROM customer
"""
SMOTE_TOMEK_OVERLAP = f"""
WITH bal AS ({smote_sql(f"SELECT CAST(vec_id AS VARCHAR) AS row_id, class, {', '.join(FEW)} FROM ({VEC_WIDE})", feats=FEW)}),
links AS ({tomek_sql("SELECT * FROM bal", FEW)})
SELECT row_id, class, {', '.join(f'ROUNDX({c}, {D}) AS {c}' for c in FEW)}
FROM bal WHERE row_id NOT IN (SELECT row_id FROM links)
"""
SEARCH_FOLDS = f"""
WITH v AS (SELECT CASE WHEN class = 'pos' THEN 1.0 ELSE 0.0 END AS label FROM ({VEC_WIDE})),
c AS (SELECT CAST(label AS DOUBLE) AS label, count(*) AS n FROM v GROUP BY label)
SELECT label, CAST(i AS INTEGER) AS fold, CAST(n * (i + 1) // 3 - n * i // 3 AS BIGINT) AS n FROM c, range(0, 3) r(i)
"""
REGISTRY_ENTRIES = f"""
WITH c AS (SELECT {_counts('toxic', '1 - quality')} FROM labels), s AS (SELECT {_SCORES} FROM c)
SELECT CAST(20 AS BIGINT) AS version, f1_score, roc_auc_score, false AS had_model, true AS has_model,
       CAST(20 AS BIGINT) AS newest_run FROM s
"""
# A row's key is the md5 of its columns in name order and a number among equal rows (here: 1).
ETL_JOB = f"""
WITH raw AS ({CUSTOMER_RAW}),
k AS (SELECT *, md5(concat_ws(chr(31), aa_000, ab_000, br_000, class)) || ':1' AS row_key FROM raw),
neg AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '42', row_key)), row_key) AS rn,
               round_even(CAST(0.3 AS DOUBLE) * count(*) OVER (), 0) AS quota FROM k WHERE class = 'neg'),
kept AS (SELECT class, aa_000, ab_000, br_000 FROM raw WHERE class = 'pos'
         UNION ALL SELECT class, aa_000, ab_000, br_000 FROM neg WHERE rn <= quota)
SELECT class, aa_000, nullif(ab_000, 'na') AS ab_000, br_000, count(*) OVER () AS n_loaded FROM kept
"""

ROUNDTRIPS: dict[str, str] = {
    "preamble_csv": CUSTOMER_NULL,
    "headed_csv": CUSTOMER_NULL,
    "documents_replaced": f"SELECT *, count(*) OVER () AS n_written FROM ({CUSTOMER_NULL})",
    "feature_store": CUSTOMER_NULL,
    "feature_matrix": f"""SELECT vec_id, CAST(CASE WHEN class = 'pos' THEN 1 ELSE 0 END AS INTEGER) AS label, {NF} AS width,
        ROUNDX({" + ".join(f"{c} * {i}" for i, c in enumerate(VF, 1))}, 6) AS weighted FROM ({VEC_WIDE})""",
    "drift_report_file": DRIFT_LINEITEM,
    "metrics_history": METRICS_HISTORY,
    "strict_drop": f"SELECT class, aa_000, ab_000 FROM ({CUSTOMER_RAW})",
    "lenient_drop": f"SELECT class, aa_000, ab_000 FROM ({CUSTOMER_NULL})",
    "features_target": f"""SELECT CAST(aa_000 AS DOUBLE) AS aa_000, CAST(ab_000 AS DOUBLE) AS ab_000,
        CAST(CASE WHEN class = 'pos' THEN 1 ELSE 0 END AS INTEGER) AS label FROM ({CUSTOMER_NULL})""",
    "class_rows": f"SELECT * FROM ({CUSTOMER_RAW}) WHERE class = 'pos'",
    "union_missing": f"SELECT class, aa_000, CASE WHEN class = 'pos' THEN ab_000 END AS ab_000, br_000 FROM ({CUSTOMER_RAW})",
    "shuffled_rows": SHUFFLED_ROWS,
    "scoring_violations": f"""
SELECT 'input' AS frame, 'column_count' AS "check", 'expected 3 columns, found 4' AS detail
UNION ALL SELECT 'input', 'missing_numeric_column', 'zz_000'
UNION ALL SELECT 'input', 'non_numeric_values', 'ab_000: ' || CAST(n AS VARCHAR) FROM (
  SELECT count(*) FILTER (WHERE TRY_CAST(ab_000 AS DOUBLE) IS NULL) AS n FROM ({CUSTOMER_RAW})) WHERE n > 0""",
    "preprocess_state": PREPROCESS_STATE,
    "smote_tomek_overlap": SMOTE_TOMEK_OVERLAP,
    "search_folds": SEARCH_FOLDS,
    "gbt_scored_rows": GBT_SCORED_ROWS,
    "gbt_nodes": GBT_NODES,
    "sensor_model": SENSOR_MODEL,
    "search_accuracy": _search_accuracy(),
    "registry_entries": REGISTRY_ENTRIES,
    "batch_scoring": BATCH_SCORING,
    "etl_job": ETL_JOB,
}

_RAW_ORACLE: dict[str, str] = {
    **ROUNDTRIPS,
    "drift_lineitem": DRIFT_LINEITEM,
    "drift_profile": DRIFT_PROFILE,
    "drift_events": DRIFT_EVENTS,
    "drift_shifted": DRIFT_SHIFTED,
    "drift_sensor_propagate": DRIFT_SENSOR_PROPAGATE,
    "drift_verdict": DRIFT_VERDICT,
    "sensor_clean": SENSOR_CLEAN_Q,
    "decoded_predictions": DECODED_PREDICTIONS,
    "schema_violations": SCHEMA_VIOLATIONS,
    "downsample_sensor": DOWNSAMPLE_SENSOR,
    "split_sensor": SPLIT_SENSOR,
    "classification_metrics": CLASSIFICATION_METRICS,
    "robust_scaler_fit": ROBUST_SCALER_FIT,
    "robust_scale": ROBUST_SCALE,
    "knn_impute": KNN_IMPUTE,
    "gbt_predict": GBT_PREDICT,
    "smote": SMOTE,
    "tomek_links": TOMEK_LINKS,
    "smote_tomek": SMOTE_TOMEK,
    "adequacy_gates": ADEQUACY_GATES,
    "champion_challenger": CHAMPION_CHALLENGER,
}

ORACLE: dict[str, str] = {k: _finish(v) for k, v in _RAW_ORACLE.items()}
