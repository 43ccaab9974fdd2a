"""Session settings and the shared working folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. All of them can be changed on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Documents are many times as large as the rows they are made of behind a shuffle, and are sorted there.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # HotSpot leaves methods above 8000 bytes uncompiled. Wide nested projections exceed
    # that as one generated method; without the fusion they are split into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keyed state outgrows executor heaps long before it outgrows local disks.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch commits its changes, not a snapshot of the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Dedup emits rows as they arrive, so an empty batch would only evict state early.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build(app: str = "tradeloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; `extra` holds further `spark.*` settings."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that somebody else started."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where that is unset, it lies beside the warehouse, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-work").rstrip("/")
