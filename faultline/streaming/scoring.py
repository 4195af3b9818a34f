"""Scoring of sensor files as they arrive (Structured Streaming).

New CSV files dropped into ``input_dir`` are scored with the latest
registered model and its own preprocessor.  Each micro-batch reuses the batch
scoring transform through ``foreachBatch`` and writes to a per-batch folder in
overwrite mode, so a replayed batch after a failure rewrites the same output
(exactly-once results with the checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from faultline.operators.preprocess import PreprocessorModel
from faultline.operators.registry import ModelRegistry
from faultline.plans.jobs import score_frame
from faultline.sources.files import read_sensor_csv
from faultline.spec import ColumnSpec


def start_scoring_stream(
    spark: SparkSession,
    input_dir: str,
    spec: ColumnSpec,
    registry_root: str,
    out_dir: str,
    checkpoint: str,
    max_files_per_trigger: int = 10,
) -> StreamingQuery:
    model, prep_path, version = ModelRegistry(spark, registry_root).load_latest()
    prep = PreprocessorModel.load(spark, prep_path, spec.features) if prep_path else None
    # The stream delivers files; a micro-batch reads them with the batch reader, so
    # columns are bound by each file's own header and checked against the spec.
    stream = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(input_dir)
        .select("path")
    )

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())  # at most max_files_per_trigger
        if not paths:
            return
        out = score_frame(read_sensor_csv(batch.sparkSession, paths), spec, model, prep, materialise=True)
        out.write.mode("overwrite").option("header", True).csv(f"{out_dir.rstrip('/')}/batch={epoch_id}")

    return (
        stream.writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(f"sensor_scoring_v{version}")
        .start()
    )
