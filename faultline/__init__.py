"""faultline: Spark-native preparation, checking and scoring of wide sensor tables
with a rare failure label.

Every operator takes and returns Spark DataFrames; nothing is collected to the
driver except bounded summaries (per-column statistics, per-class counts).
"""

from faultline.session import checkpoint_dir, get_session
from faultline.spec import TRUCK_SPEC, ColumnSpec

__all__ = ["TRUCK_SPEC", "ColumnSpec", "checkpoint_dir", "get_session"]
