"""Incremental platinum ingest (C1 + S9) as a Structured Streaming job.

A delivery is a folder of files that holds whole months; a corrected month is sent again, whole, in a new
folder.  A micro-batch tells which deliveries have files in it; their folders are then read whole, so a delivery that is split over
micro-batches is complete in the last of them, and a month of many files keeps all its rows.  Of several deliveries of one month
in a batch the newest counts.  The rows are cleaned, recoded and rolled up like the batch ETL and written with
dynamic partition overwrite, so only the months present in the batch are replaced.  The stream's checkpoint
(offsets and commit log) must live in shared storage; a restarted query resumes after the last committed batch, and a replayed
batch rewrites the same months with the same rows.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Params
from ..plans import platinum
from ..sources import sinks
from ..sources.dims import Dims
from ..sources.ingest import RAW_CLASS_SCHEMA


def _latest_delivery_per_month(files: DataFrame) -> DataFrame:
    """The rows of each month's newest delivery (by its newest file; ties to the last folder name)."""
    b = files.select("*", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_DELIVERY"),
                     F.col("_metadata.file_modification_time").alias("_MTIME"))
    # one row per month and delivery of the batch: a month's rows never meet in one reducer
    each = b.groupBy("PERIODO", "_DELIVERY").agg(F.max("_MTIME").alias("_M"))
    newest = each.groupBy("PERIODO").agg(F.max(F.struct("_M", "_DELIVERY")).alias("_N")).select(
        "PERIODO", F.col("_N._DELIVERY").alias("_DELIVERY"))
    return b.join(newest, ["PERIODO", "_DELIVERY"], "left_semi").drop("_DELIVERY", "_MTIME", "_metadata")


def start_monthly_ingest(spark: SparkSession, landing: str, root: str, version: str, dims: Dims,
                         checkpoint: str, params: Params = DEFAULT, fmt: str = "parquet",
                         available_now: bool = True) -> StreamingQuery:
    """Start the ingest stream from ``landing`` into ``{root}/prog_acad/version={version}``."""
    stream = (spark.readStream.schema(RAW_CLASS_SCHEMA).format(fmt)
              .option("maxFilesPerTrigger", 64).option("recursiveFileLookup", "true").load(landing)
              .select("*", F.col("_metadata").alias("_metadata")))

    def write_batch(batch: DataFrame, _batch_id: int) -> None:
        folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
        # at most maxFilesPerTrigger names
        folders = [r.folder for r in batch.select(folder).distinct().collect()]
        if not folders:
            return
        files = (spark.read.schema(RAW_CLASS_SCHEMA).format(fmt).load([unquote(f) for f in folders])
                 .select("*", F.col("_metadata").alias("_metadata")))
        cells = platinum.facts_rollup(_latest_delivery_per_month(files), dims, params)
        sinks.write_by_period(cells, root, version)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
