"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, cores: int) -> int:
    """Enough shuffle partitions to keep each near 128 MB, and every core busy."""
    return max(cores, -(-shuffle_bytes // TARGET_SHUFFLE_BYTES))


def recommended_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings the plans in this package are written for.

    AQE merges small partitions at run time, so the partition count is sized for the
    largest shuffle. Hot keys are split by the skew join rule, for which the joins that
    can meet them are laid out.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions_for(shuffle_bytes, cores)),
        "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.compress": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a folder of the warehouse is used, which all executors
    reach as well. A folder of one machine would be lost with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(folder)
    return folder
