"""Column specification for a wide sensor table.

A ``ColumnSpec`` drives the strict/lenient drops, the column-count checks and
the feature list of every operator; nothing else hard-codes column names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values: the truck-sensor layout (label column, 163 numeric
# features in file order, 7 columns dropped at ingestion). ---------------------
TRUCK_LABEL = "class"
TRUCK_FEATURES = """
aa_000 ac_000 ad_000 ae_000 af_000 ag_000 ag_001 ag_002 ag_003 ag_004 ag_005 ag_006 ag_007
ag_008 ag_009 ah_000 ai_000 aj_000 ak_000 al_000 am_0 an_000 ao_000 ap_000 aq_000 ar_000
as_000 at_000 au_000 av_000 ax_000 ay_000 ay_001 ay_002 ay_003 ay_004 ay_005 ay_006 ay_007
ay_008 ay_009 az_000 az_001 az_002 az_003 az_004 az_005 az_006 az_007 az_008 az_009 ba_000
ba_001 ba_002 ba_003 ba_004 ba_005 ba_006 ba_007 ba_008 ba_009 bb_000 bc_000 bd_000 be_000
bf_000 bg_000 bh_000 bi_000 bj_000 bk_000 bl_000 bm_000 bs_000 bt_000 bu_000 bv_000 bx_000
by_000 bz_000 ca_000 cb_000 cc_000 cd_000 ce_000 cf_000 cg_000 ch_000 ci_000 cj_000 ck_000
cl_000 cm_000 cn_000 cn_001 cn_002 cn_003 cn_004 cn_005 cn_006 cn_007 cn_008 cn_009 co_000
cp_000 cq_000 cs_000 cs_001 cs_002 cs_003 cs_004 cs_005 cs_006 cs_007 cs_008 cs_009 ct_000
cu_000 cv_000 cx_000 cy_000 cz_000 da_000 db_000 dc_000 dd_000 de_000 df_000 dg_000 dh_000
di_000 dj_000 dk_000 dl_000 dm_000 dn_000 do_000 dp_000 dq_000 dr_000 ds_000 dt_000 du_000
dv_000 dx_000 dy_000 dz_000 ea_000 eb_000 ec_00 ed_000 ee_000 ee_001 ee_002 ee_003 ee_004
ee_005 ee_006 ee_007 ee_008 ee_009 ef_000 eg_000
""".split()
TRUCK_DROP = "br_000 bq_000 bp_000 ab_000 cr_000 bo_000 bn_000".split()
# Label values and their integer codes.
NEGATIVE, POSITIVE = "neg", "pos"
LABEL_CODES = {NEGATIVE: 0, POSITIVE: 1}
# Literal that marks a missing reading in the raw files.
MISSING_TOKEN = "na"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnSpec:
    """Declared layout of a sensor table.

    ``features`` are the numeric columns (cast to double), ``label`` the
    string class column, ``drop`` columns removed at ingestion and ``keys``
    the columns that identify a row (needed for seeded sampling and
    neighbour search; the raw files have no business key).
    """

    features: tuple[str, ...]
    label: str = TRUCK_LABEL
    drop: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    extra: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        """Columns of a training table: label then features."""
        return [self.label, *self.features]

    def n_columns(self, with_label: bool = True) -> int:
        return len(self.features) + (1 if with_label else 0)

    def schema(self, with_label: bool = True) -> T.StructType:
        fields = [T.StructField(self.label, T.StringType())] if with_label else []
        fields += [T.StructField(c, T.DoubleType()) for c in self.features]
        return T.StructType(fields)

    def raw_schema(self, with_label: bool = True) -> T.StructType:
        """All-string schema of the raw CSV/JSON form, drop columns included."""
        names = ([self.label] if with_label else []) + list(self.features) + list(self.drop)
        return T.StructType([T.StructField(c, T.StringType()) for c in names])

    def with_keys(self, *keys: str) -> "ColumnSpec":
        return ColumnSpec(self.features, self.label, self.drop, tuple(keys), self.extra)


TRUCK_SPEC = ColumnSpec(features=tuple(TRUCK_FEATURES), label=TRUCK_LABEL, drop=tuple(TRUCK_DROP))
