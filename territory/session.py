"""Session settings that follow the size of the input."""

from __future__ import annotations

from pyspark.sql import SparkSession

MB = 1 << 20
SCAN_BYTES = 256 * MB
SHUFFLE_BYTES = 192 * MB


def scale_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for an input of ``input_bytes`` on ``cores`` executor cores.

    Shuffle partitions hold about 192 MB each, at least two per core up to the
    cores' worth of work there is; adaptive execution merges those that turn
    out small and splits those that a hot key makes large. Scans use larger
    splits only when there are enough of them to keep all cores busy.
    """
    by_size = -(-input_bytes // SHUFFLE_BYTES)
    partitions = max(1, by_size, 2 * cores)
    per_core = max(16 * MB, input_bytes // max(1, 2 * cores))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(min(SCAN_BYTES, per_core)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def tune(spark: SparkSession, input_bytes: int, cores: int | None = None) -> SparkSession:
    """Apply ``scale_conf`` to a running session."""
    cores = cores or spark.sparkContext.defaultParallelism
    for key, value in scale_conf(input_bytes, cores).items():
        spark.conf.set(key, value)
    return spark


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path, on any Hadoop file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(target).getLength()
