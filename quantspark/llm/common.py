"""Shared helpers: table access, lineage cuts in the cluster's shared folder, column names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.session import prepare_session

# ASCII white space as the contracts define it (fixed value).
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


ARROW_ROWS = 1000


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings of the Arrow-batched operators: batches of at most ``ARROW_ROWS`` rows, so that a
    worker holds a few megabytes of documents at a time."""
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint folder."""
    tuned(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured or spark.sparkContext.getCheckpointDir()


def stored_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``stored`` and the folder of its files, for ``dropped``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as a Parquet table in the shared folder and read it back.

    Unlike a cached frame it survives lost executors, and unlike an RDD
    checkpoint it is compressed and column-pruned on later reads.
    """
    return stored_at(df)[0]


def dropped(spark: SparkSession, path: str) -> None:
    """Delete the files of a frame of ``stored_at``, once nothing reads it or a frame derived from it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, every action and write deletes its own shuffle files when it ends.  Spark otherwise keeps them
    until the driver happens to collect garbage, so that an iteration piles up the shuffles of all its rounds."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def input_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column, by one aggregation (0 for an empty table)."""
    return int(df.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other code point unchanged."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n (a null key counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")
