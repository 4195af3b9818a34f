"""Label encoding (``neg``/``pos`` <-> 0/1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.spec import LABEL_CODES


def encode_label(col: str | Column, codes: dict[str, int] | None = None, strict: bool = True) -> Column:
    """Map label strings to integer codes.

    Unknown values raise at run time when ``strict`` (the reference fails later
    when it casts to int); otherwise they become NULL.
    """
    codes = codes or LABEL_CODES
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, code in codes.items():
        expr = (F.when(c == name, F.lit(code)) if expr is None else expr.when(c == name, F.lit(code)))
    if strict:
        expr = expr.when(c.isNull(), F.lit(None).cast("int")).otherwise(
            F.raise_error(F.concat(F.lit("unknown label value: "), c.cast("string"))).cast("int")
        )
    return expr.cast("int")


def decode_label(col: str | Column, codes: dict[str, int] | None = None, strict: bool = True) -> Column:
    """Map integer (or double) predictions back to label strings.

    Unknown codes raise at run time when ``strict``, else they become NULL."""
    codes = codes or LABEL_CODES
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, code in codes.items():
        expr = (F.when(c == code, F.lit(name)) if expr is None else expr.when(c == code, F.lit(name)))
    if strict:
        expr = expr.when(c.isNull(), F.lit(None).cast("string")).otherwise(
            F.raise_error(F.concat(F.lit("unknown label code: "), c.cast("string"))).cast("string")
        )
    return expr
