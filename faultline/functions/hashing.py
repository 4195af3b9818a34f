"""Seeded, partition-independent pseudo-randomness from row keys.

``rand()`` and ``monotonically_increasing_id()`` depend on how rows are
partitioned, so a re-run (or a lost executor) could pick different rows.  An
md5 of ``seed:key`` is a pure function of the row, gives the same answer in
Spark SQL and in DuckDB, and lets SQL oracles check sampling exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits = 52 bits, exactly representable in a double.
_HEX_DIGITS = 13
_SCALE = float(1 << (4 * _HEX_DIGITS))


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_string(*cols) -> Column:
    """Colon-joined string form of the key columns (integers/strings only)."""
    return F.concat_ws(":", *[_as_col(c).cast("string") for c in cols])


def seeded_md5(seed, *cols) -> Column:
    """``md5('<seed>:<k1>:<k2>...')`` as a 32-char hex string."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_as_col(c).cast("string") for c in cols]))


def hex_to_unit(hex_col: Column) -> Column:
    """First 52 bits of a hex digest mapped to a double in [0, 1)."""
    return F.conv(F.substring(hex_col, 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(_SCALE)


def seeded_uniform(seed, *cols) -> Column:
    """Deterministic U[0,1) draw per (seed, key)."""
    return hex_to_unit(seeded_md5(seed, *cols))


def seeded_int(seed, n: Column | int, *cols) -> Column:
    """Deterministic integer in [0, n) per (seed, key)."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    return F.floor(seeded_uniform(seed, *cols) * n_col).cast("long")
