"""Sources and sinks (A1-A11): CSV landing, Parquet tables, parameterised SQL.

A "warehouse" is a folder (local, HDFS, object store) with one Parquet
directory per table.  Tables that are written per experiment are
partitioned by ``experiment_id`` and overwritten dynamically, so one
experiment never rewrites another.  All other tables are kept as snapshots: a
refresh writes a new folder and marks it complete, and readers take the newest
complete one, so a table can be refreshed from itself and a job that fails
leaves the old rows.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from quantspark.schemas import TABLES, TRADES

# Accepted text layouts of trade timestamps (fixed values).
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss",
                     "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd")
PARTITIONED = {"predictions": ["experiment_id"], "walk_forward_results": ["experiment_id"]}


def parse_timestamp(col) -> "F.Column":
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in TIMESTAMP_FORMATS])


def _trade_columns(names: list[str]) -> list[str]:
    """Stripped header names; unknown or repeated ones are an error."""
    names = [c.strip() for c in names]
    known = {f.name for f in TRADES.fields}
    unknown = [c for c in names if c not in known]
    if unknown or len(set(names)) != len(names):
        raise ValueError(f"trade log columns not understood: {unknown or names}")
    return names


def _by_header(spark: SparkSession, path) -> list[list[str]]:
    """Files of equal header lines.  A header is a line all of whose fields are column names, which no trade is."""
    known = F.array(*[F.lit(f.name) for f in TRADES.fields])
    fields = F.transform(F.split("value", ","), lambda c: F.trim(F.trim(c), F.lit('"')))
    heads = (spark.read.text(path).select("value", fields.alias("names"), F.col("_metadata.file_path").alias("file"))
             .filter(F.forall("names", lambda c: F.array_contains(known, c))).select("value", "file").distinct().collect())
    found: dict[str, list[str]] = {}
    for r in heads:                                        # one row a file
        found.setdefault(r["value"], []).append(r["file"])
    return [sorted(files) for _, files in sorted(found.items())]


def read_trades_csv(spark: SparkSession, path, rejects: bool = False, mixed_headers: bool = False) -> DataFrame:
    """A1: trade-log CSV, columns bound by the names in its header.

    A file without ``id`` numbers its rows in file order (by monotonic ids);
    other missing columns are NULL; an unknown column is an error.  Rows with
    a value that does not parse (numbers, timestamps) or with too few or many
    fields raise an error when they are read, or with ``rejects=True`` are
    returned instead of the trades: their line and the columns at fault.

    The files of a folder must share one header: another one is an error when
    it is read.  With ``mixed_headers=True`` each file is read by its own
    header, at the price of one more scan that looks for header lines (only
    files with an ``id`` column may then differ, since row numbers would clash).
    """
    if mixed_headers:
        groups = _by_header(spark, path)
        if len(groups) > 1:
            parts = [read_trades_csv(spark, files, rejects) for files in groups]
            if any("id" not in spark.read.option("header", True).csv(files[0]).columns for files in groups):
                raise ValueError("files with different headers need an id column")
            return reduce(DataFrame.unionByName, parts)
    # The header names the columns; no schema is inferred from the rows.
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    names = _trade_columns(raw.columns)
    wanted = {f.name: f.dataType for f in TRADES.fields}
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*raw.columns, "_corrupt_record"]])
    # enforceSchema off: a file whose header names other columns, or another order, is an error.
    rows = (spark.read.schema(texts).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path).toDF(*names, "_corrupt_record"))

    def value(c):
        x = F.when(F.trim(c) != "", F.trim(c))
        return parse_timestamp(x) if c == "timestamp" else x.try_cast(wanted[c])

    parsed = rows.select("*", F.struct(*[value(c).alias(c) for c in names]).alias("_v"))
    faults = F.array_compact(F.array(
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("line")),
        *[F.when((F.trim(c) != "") & F.col(f"_v.{c}").isNull(), F.lit(c)) for c in names]))
    parsed = parsed.withColumn("_faults", faults)
    if rejects:
        return parsed.filter(F.size("_faults") > 0).select(
            F.coalesce("_corrupt_record", F.to_json(F.struct(*names))).alias("line"), F.col("_faults").alias("columns"))
    # Checked inside the scan: a bad row fails the job that reads it.
    checked = F.when(F.size("_faults") == 0, F.col("_v")).otherwise(F.raise_error(F.concat(
        F.lit("unreadable trade ("), F.array_join("_faults", ","), F.lit("): "),
        F.coalesce("_corrupt_record", F.to_json(F.struct(*names))))).cast(T.NullType()))
    out = parsed.select(checked.alias("_v"))
    number = F.monotonically_increasing_id() + 1
    return out.select(*[(F.col(f"_v.{c}") if c in names else number if c == "id" else F.lit(None)).cast(t).alias(c)
                        for c, t in wanted.items()])


def read_macro_csv(spark: SparkSession, path: str, series_id: str | None = None, start: str | None = None,
                   end: str | None = None, source: str = "FRED") -> DataFrame:
    """A9 + B1-B4: two-column (date, value) series files, '.' = missing.

    Without ``series_id`` the id is the file name (one file per series), so a
    whole folder of series is one scan.
    """
    from quantspark.plans.macro import drop_null_values, filter_dates, normalise
    df = (spark.read.option("header", True).option("nullValue", ".")
          .schema("date date, value double").csv(path))
    sid = F.lit(series_id) if series_id else F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    df = df.withColumn("series_id", sid)
    return normalise(drop_null_values(filter_dates(df, start, end)), None, source)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


_SNAPSHOT = re.compile(r"snapshot-(\d+)-[0-9a-f]+")
_COMPLETE = "_COMPLETE"


def _files(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path, local or in any store Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _snapshots(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the complete snapshots of a table, oldest first."""
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory()]
    found = sorted((int(m[1]), m[0]) for m in map(_SNAPSHOT.fullmatch, names) if m)
    return [(n, f"{path}/{x}") for n, x in found if fs.exists(_files(spark, f"{path}/{x}/{_COMPLETE}")[1])]


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """Where a table's rows are now: its newest complete snapshot, or its own folder if it has none."""
    path = table_path(root, name)
    complete = _snapshots(spark, path)
    return complete[-1][1] if complete else path


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A2: full-table scan (Catalyst prunes columns and pushes filters).  Tables of the data model are read
    with their schema, so an empty partitioned table is a table too."""
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(current_path(spark, root, name))


def _refresh(df: DataFrame, path: str) -> None:
    """Write ``df`` as the table's next snapshot and mark it complete; only then is it read.

    The snapshot before stays until the refresh after this one, for jobs that
    still read it; older ones are deleted.
    """
    spark = df.sparkSession
    old = _snapshots(spark, path)
    target = f"{path}/snapshot-{(old[-1][0] if old else 0) + 1:06d}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(target)
    fs, mark = _files(spark, f"{target}/{_COMPLETE}")
    fs.create(mark, False).close()
    for _, folder in old[:-1]:
        fs.delete(_files(spark, folder)[1], True)


def write_table(df: DataFrame, root: str, name: str, mode: str = "append",
                partition_by: Iterable[str] | None = None) -> None:
    """A4/A5: append / overwrite / error if exists.

    A partitioned table overwrites the partitions that ``df`` holds.  Any other
    table gets a new snapshot, so ``df`` may read the table that it refreshes
    and a failing job changes nothing.
    """
    mode = {"replace": "overwrite", "fail": "errorifexists"}.get(mode, mode)
    parts = list(partition_by) if partition_by is not None else PARTITIONED.get(name, [])
    spark = df.sparkSession
    if parts:
        w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
        w.parquet(table_path(root, name))
    elif mode == "append":
        df.write.mode("append").parquet(current_path(spark, root, name))
    elif mode == "errorifexists" and _snapshots(spark, table_path(root, name)):
        raise ValueError(f"table exists: {name}")
    elif mode == "overwrite":
        _refresh(df, table_path(root, name))
    else:
        df.write.mode(mode).parquet(table_path(root, name))


def rewrite_rows(spark: SparkSession, root: str, name: str, where: Column, changes: dict[str, Column] | None = None) -> None:
    """Update (``changes``) or delete (no changes) the rows for which ``where`` is true, as a refresh of the
    table from itself."""
    rows = read_table(spark, root, name)
    hit = F.coalesce(where, F.lit(False))
    if name in PARTITIONED:
        raise ValueError(f"{name} is written by experiment: overwrite the experiment instead")
    if changes is None:
        out = rows.filter(~hit)
    else:
        out = rows.select(*[F.when(hit, changes[c]).otherwise(F.col(c)).cast(t).alias(c) if c in changes else F.col(c)
                            for c, t in rows.dtypes])
    write_table(out, root, name, "overwrite")


def fetch(df: DataFrame, limit: int) -> list[tuple]:
    """At most ``limit`` rows on the driver (fetchone: 1)."""
    return [tuple(r) for r in df.limit(limit).collect()]


def sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """A3: parameterised SELECT (named parameters ``:name``) over temp views."""
    for k, v in (views or {}).items():
        v.createOrReplaceTempView(k)
    return spark.sql(text, args=args or None)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the table can be read.  Only "no such path" means absent; any other error is raised."""
    try:
        read_table(spark, root, name).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def row_count(spark: SparkSession, root: str, name: str) -> int:
    return read_table(spark, root, name).count()


def append_rows(spark: SparkSession, root: str, name: str, rows: list[tuple]) -> None:
    """Small inserts (e.g. an experiment record) with the table's schema."""
    write_table(spark.createDataFrame(rows, TABLES[name]), root, name, "append")


def initialize_schema(spark: SparkSession, root: str) -> None:
    """Create every table empty (if missing) with its schema."""
    for name, schema in TABLES.items():
        if not table_exists(spark, root, name):
            write_table(spark.createDataFrame([], schema), root, name, "errorifexists")


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A10: report sinks (csv with header / json / parquet), overwritten."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 partitions: int | None = None) -> dict:
    """Options for ``spark.read.format('jdbc')`` / ``df.write.format('jdbc')`` (needs a
    JDBC driver on the classpath; parallel reads split ``partition_column`` into ranges)."""
    o = {"url": url, "dbtable": table}
    if user:
        o["user"] = user
    if password:
        o["password"] = password
    if partition_column:
        o.update({"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                  "numPartitions": str(partitions or 8)})
    return o
