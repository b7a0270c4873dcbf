"""Session construction and the shared working folder."""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours wants; a cluster-provided value always wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # A query's shuffle files go when it ends, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Half as many bytes as lz4's on disk.
    "spark.io.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Keyed streaming state (one row per album) lies on the executors' disks, not in their heap, takes no more room there than
# its rows need, and a batch's changes are what it adds to the checkpoint.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Write options of Parquet layers. Texts with common beginnings, as neighbouring ids have, are
# stored as differences (version 2 pages).
PARQUET = {"compression": "zstd", "parquet.writer.version": "v2"}


def get_session(master: str | None = None, cores: int | None = None,
                shuffle_partitions: int | None = None, app: str = "chartlake",
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session. Without an explicit ``master`` the
    launcher's master (spark-submit / cluster configuration) is kept; only
    when none is configured does the session run on ``local[cores]``."""
    from pyspark import SparkConf
    launched = SparkConf()                       # what spark-submit or the cluster configured
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    elif not launched.contains("spark.master"):
        b = b.master(f"local[{cores or os.cpu_count() or 8}]")
    conf = {k: v for k, v in (DEFAULT_CONF | STATE_CONF).items() if not launched.contains(k)}
    if shuffle_partitions and not launched.contains("spark.sql.shuffle.partitions"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drop_shuffle_files(spark: SparkSession) -> None:
    """Let the session's queries remove their shuffle files when they end, unless the launcher
    said otherwise: layers written one after the other would keep those of all of them on disk."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, DEFAULT_CONF[key])


def state_on_disk(spark: SparkSession) -> None:
    """Keep the keyed state of streams started from now on on disk (``STATE_CONF``), unless the launcher or the session said
    otherwise: in memory it grows with the keys. A checkpoint keeps the store that it was begun with."""
    if spark.conf.get(next(iter(STATE_CONF)), None) is None:
        for key, value in STATE_CONF.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a cluster run. Initial shuffle partitions: about
    ``target_partition_bytes`` of input each, at least 2 per core. AQE coalesces
    small partitions to the advisory size and splits skewed ones (5x the median
    and above 256 MiB). Pass the result as ``extra`` to ``get_session`` (or as
    spark-submit --conf)."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared working folder: ``spark.checkpoint.dir`` from the
    session, or the checkpoint folder set on its context. Where neither is set a
    local session (tests) gets a folder of its own; on a cluster that is an error,
    since executors would not share it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        cd = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = cd.get() if cd.isDefined() else None
    if not d:
        d = _own_dir(spark.sparkContext.master)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _own_dir(master: str) -> str:
    if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return tempfile.mkdtemp(prefix="chartlake-")
