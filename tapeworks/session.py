"""Session settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.files.ignoreCorruptFiles": "true",  # truncated gzips give the rows before the break
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",  # day stays a string
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, partitions: int = 8, name: str = "tapeworks", memory: str = "4g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name).config("spark.sql.shuffle.partitions", partitions)
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", memory).config("spark.ui.showConsoleProgress", "false")
    return configure(builder.config(map=SETTINGS).getOrCreate())
