"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "partatlas", **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # The operators do much work per byte, so small partitions are worth keeping.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables in storage that all executors share.

    That is whatever ``spark.checkpoint.dir`` names, else the checkpoint folder of
    the context, else the warehouse. Never a folder of one machine.
    """
    shared = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    For a result that several later steps need: it is computed once, and the
    stored copy survives the loss of executors.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled, whatever size Spark takes it for.

    A plan judges a table by the files behind it. Names cut into their pieces are many
    times that, and a broadcast of them would pass through the driver.
    """
    return df.hint("merge")
