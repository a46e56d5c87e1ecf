"""Session helpers: UTC time zone, AQE, a reliable checkpoint directory."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings every job here relies on.

    * ``spark.sql.session.timeZone=UTC``: trade and release times are UTC.
    * AQE on, with skew-join splitting (hot accounts / days).
    * A reliable checkpoint directory. The cluster names it in
      ``spark.checkpoint.dir``; only a local master may leave it unset (tests)
      and gets a fresh scratch folder.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="quantspark-ckpt-")
        sc.setCheckpointDir(configured)
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder (nothing is created)."""
    prepare_session(spark)
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back: later passes read the columns they
    need, and neither recompute it nor hold it in the executors' memory."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def get_spark(master: str | None = None, app: str = "quantspark",
              shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("QS_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)
