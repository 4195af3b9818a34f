"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


ROW_GROUP_BYTES = 8 << 20  # of tables shared between jobs


def get_session(
    master: str | None = None,
    app_name: str = "faultline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized to the data (~128-256 MB per
    partition), which AQE coalesces further at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, reading it from the session.

    ``spark.checkpoint.dir`` (or an already set SparkContext checkpoint dir) wins.
    Only a local-mode session without one gets a fresh temporary folder; on a
    cluster a machine-local folder would be wrong, so we refuse instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running jobs that cut lineage"
            )
        configured = tempfile.mkdtemp(prefix="faultline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Like a checkpoint it cuts lineage, and the planner knows the size of what
    it reads (a small table is broadcast, a large one is not) and prunes columns.  Small row
    groups let many tasks read what few tasks wrote."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``faultline`` importable by Python workers (pandas UDFs refer to
    its functions by module), once per application.  Same mechanism as
    ``--py-files``: Spark distributes the zip to every executor."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    submitted = sc.getConf().get("spark.submit.pyFiles", "") or ""
    if any(os.path.basename(f).startswith("faultline") for f in submitted.split(",") if f):
        _SHIPPED.add(app)  # already on every executor via --py-files
        return
    # The zip is only a file the driver uploads (as spark-submit does with
    # --py-files); no job reads or writes this folder.
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="faultline-pkg-"), "faultline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
