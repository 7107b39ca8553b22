"""Session helpers.

On a cluster the session comes from the platform with ``spark.checkpoint.dir``
pointing at a shared folder; we only read it.  ``local_session`` is for tests
and the bench, and sets its own checkpoint folder only when none is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(total_cores: int, target_partition_mb: int = 128) -> dict[str, str]:
    """Settings for a large cluster: shuffle width from the core count, AQE sizing the partitions.

    ``spark.sql.shuffle.partitions`` is an upper bound that AQE coalesces down to
    ``target_partition_mb`` per partition; scans split files at the same size; skewed
    partitions (five times the median and over 256 MB) are split by AQE.
    """
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "cohortcast") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("COHORTCAST_DRIVER_MEMORY", "16g"))
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, bench) without that setting gets a scratch
    folder of its own; on a cluster a missing setting is an error, never a
    machine-local folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="cohortcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back: the lineage ends there (it survives
    executor loss), nothing is computed twice, and later scans read only the columns that they need."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/layer-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
