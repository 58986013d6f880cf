"""Layer tables on Parquet: typed scans, partitioned writes, upserts, audit.

Paths are plain strings for Spark's readers and writers (``/x``, ``file:///x``,
``hdfs://...``, ``s3a://...``); existence is asked of the Hadoop file system of
the path, never of the driver's disk.  Tables are partitioned by zone and month
(``_month`` is technical and not returned by ``scan_layer``).  An upsert writes
what it computes to the shared checkpoint folder first and then replaces the
touched partitions only (dynamic partition overwrite): a job that fails before
the replacement leaves the table as it was, and since an upsert is idempotent a
retry after it gives the same table.  One writer per table at a time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.timecols import hour_floor
from loadcast.schemas import BRONZE_SCHEMA, KEY
from loadcast.session import work_dir

MONTH = "_month"
MOST_LITERALS = 1000  # partition values that may travel as literals of a filter
FOLDERS_A_TASK = 16   # partitions that one task writes, if they are small
SMALL_PARTITION = 1_000_000  # rows

EVENTS_READ_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scan_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a layer; the technical month partition is left out."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path).drop(MONTH)


def events_as_bronze(ev: DataFrame) -> DataFrame:
    return ev.select(hour_floor("ts").alias("timestamp_utc"), F.col("event_type").alias("country"),
                     F.lit("actual").alias("kind"), F.col("value").alias("load_mw"),
                     F.col("ts").alias("ingested_at"), "event_id")


def _stamped(df: DataFrame, ingested_at=None) -> DataFrame:
    return df if ingested_at is None else df.withColumn("ingested_at", F.lit(ingested_at).cast("timestamp_ntz"))


def _null_keys(df: DataFrame) -> F.Column:
    """Names of the required columns that are null in a row."""
    required = [f.name for f in BRONZE_SCHEMA.fields if not f.nullable]
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))


def bronze_typed(df: DataFrame, ingested_at=None) -> DataFrame:
    """Apply the fixed bronze schema: NaN -> NULL, stamp ingested_at, enforce
    types.  Rows without a required value go to ``bronze_rejects``."""
    df = _stamped(df, ingested_at)
    df = df.withColumn("load_mw", F.when(F.isnan("load_mw"), None).otherwise(F.col("load_mw")).cast("double"))
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE_SCHEMA.fields])
    df = df.filter(F.size(_null_keys(df)) == 0)
    # ``to`` checks names and types; key non-nullness is enforced by the filter
    return df.to(T.StructType([T.StructField(f.name, f.dataType, True) for f in BRONZE_SCHEMA.fields]))


def bronze_rejects(df: DataFrame, ingested_at=None) -> DataFrame:
    """The rows that ``bronze_typed`` leaves out, with the columns they lack."""
    df = _stamped(df, ingested_at)
    lacking = _null_keys(df)
    return df.withColumn("reason", F.concat(F.lit("null:"), F.array_join(lacking, ","))).filter(F.size(lacking) > 0)


def overwrite_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("country",),
                          sort_within: Sequence[str] = ("timestamp_utc",), obs: Observation | None = None) -> str:
    """Full replace, partitioned; rows sorted by time inside each file.

    The result is computed and written to the shared checkpoint folder before
    the live table is touched, so a failing computation leaves it in place.  A
    rebalance on the partition columns lets AQE split a large zone over several
    tasks (and merge small ones)."""
    spark = df.sparkSession
    staged = f"{work_dir(spark, 'staged')}/t"
    _observed(df, obs).write.parquet(staged)
    (spark.read.parquet(staged).hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_within)
     .write.mode("overwrite").partitionBy(*partition_by).parquet(path))
    return path


def write_counted(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ("country",)) -> tuple[str, int]:
    """Write and return the row count observed during the write (no second scan)."""
    obs = Observation("rows_written")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path, int(obs.get["rows"])


def _observed(df: DataFrame, obs: Observation | None) -> DataFrame:
    return df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs is not None else df


def _by_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(ts, "yyyy-MM"))


def dealt(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Stored ``rows`` dealt by partition for a write: some folders a task, so
    that the time of a task does not grow with the number of partitions (a
    rebalance merges small ones by bytes, up to all of them in one task); where a
    partition is large a rebalance splits it."""
    n, most = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.max("n")).first()
    if n and most > SMALL_PARTITION:
        return rows.hint("rebalance", *parts)
    return rows.repartition(max(1, math.ceil(n / FOLDERS_A_TASK)), *parts)


def create_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("country",), obs: Observation | None = None,
                 ts: str = "timestamp_utc") -> str:
    """First write of a table, staged first.  Pass an ``Observation`` to get the
    written row count without a second scan."""
    parts, staged = [*partition_by, MONTH], f"{work_dir(df.sparkSession, 'created')}/t"
    _by_month(df, ts).write.parquet(staged)
    rows = df.sparkSession.read.parquet(staged)
    _observed(dealt(rows, parts), obs).write.mode("append").partitionBy(*parts).parquet(path)
    return path


def upsert(spark: SparkSession, source: DataFrame, path: str, key: Sequence[str] = tuple(KEY),
           partition_by: Sequence[str] = ("country",), obs: Observation | None = None, ts: str = "timestamp_utc") -> str:
    """Insert-or-replace ``source`` rows into the table at ``path`` on ``key``
    (which includes the partition columns and the time).

    Source rows must be unique per key (dedup first); the source is evaluated
    once.  Only partitions that it touches are read, merged (left anti join on
    the key: a shuffle join, never a broadcast of an unbounded side), staged
    and replaced.  ``obs`` counts the rows of the table afterwards.  Applying
    the same source twice gives the same table.
    """
    key, parts = list(key), [*partition_by, MONTH]
    if not exists(spark, path):
        return create_table(source, path, partition_by, obs, ts)
    folder = work_dir(spark, "upsert")
    cols = source.columns
    _by_month(source, ts).write.parquet(f"{folder}/source")
    batch = spark.read.parquet(f"{folder}/source")
    touched = batch.select(*parts).distinct()
    old = pruned_to(spark.read.parquet(path), touched).select(*cols, MONTH)
    merged = old.join(batch.select(*key), key, "left_anti").unionByName(batch.select(*cols, MONTH))
    merged.write.parquet(f"{folder}/merged")
    (dealt(spark.read.parquet(f"{folder}/merged"), parts).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
    if obs is not None:
        spark.read.parquet(path).observe(obs, F.count(F.lit(1)).alias("rows")).agg(F.count(F.lit(1))).collect()
    return path


def pruned_to(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the partitions in ``wanted`` (its columns).  Values prune the
    scan as literals while they are few (checked); the join decides anyway."""
    for c in wanted.columns:
        values = [r[0] for r in wanted.select(c).distinct().limit(MOST_LITERALS + 1).collect()]
        if len(values) <= MOST_LITERALS:
            table = table.filter(F.col(c).isin(values))
    return table.join(wanted, wanted.columns, "left_semi")


def scan_partitions(spark: SparkSession, path: str, wanted: DataFrame, schema: T.StructType) -> DataFrame:
    """The wanted (zone, month) partitions of a layer, months included; a table
    that does not exist has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return pruned_to(spark.read.schema(schema).parquet(path), wanted)


def replace_partitions(rows: DataFrame, path: str, touched: DataFrame, sort_within: Sequence[str] = ()) -> None:
    """Put stored ``rows`` in the place of the touched partitions (columns of
    ``touched``, in order); a touched partition without rows goes."""
    spark, parts = rows.sparkSession, touched.columns
    out = dealt(rows, parts)
    if sort_within:
        out = out.sortWithinPartitions(*parts, *sort_within)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    gone = touched.distinct().join(rows.select(*parts).distinct(), parts, "left_anti")
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for r in gone.toLocalIterator():  # rare; one folder each
        p = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/")] + [utils.getPartitionPathString(c, r[c]) for c in parts]))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def append_log(df: DataFrame, path: str, partition_by: Sequence[str] = ("country",)) -> str:
    """Append-only raw log (bronze as documented: immutable)."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return path
