"""File sources and sinks: CSV / JSON / Parquet readers with explicit schemas,
the ingest step (raw layer landed as Parquet), its manifest, and result sinks.
"""
from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources import schemas
from touchline.sources.tables import RawTables


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read one source file (or directory) with an explicit schema.

    The format follows the suffix: ``.csv`` (header, empty field -> NULL),
    ``.json`` (a top-level array of flat objects; not splittable, so land it as
    Parquet once), ``.jsonl``/``.ndjson`` (one object per line, splittable) and
    anything else as Parquet.
    """
    lower = path.rstrip("/").lower()
    reader = spark.read.schema(schema)
    if lower.endswith(".csv"):
        df = (reader.option("header", True).option("mode", "FAILFAST")
              .option("dateFormat", "yyyy-MM-dd").csv(path))
    elif lower.endswith(".json"):
        df = reader.option("multiLine", True).option("mode", "FAILFAST").json(path)
    elif lower.endswith(".jsonl") or lower.endswith(".ndjson"):
        df = reader.option("mode", "FAILFAST").json(path)
    else:
        df = spark.read.parquet(path)
    return conform(df, schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's own file system for ``path`` has it (local paths, and any
    scheme that Spark reads: ``file://``, ``hdfs://``, object stores)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def missing_sources(spark: SparkSession, data_dir: str, names: dict[str, str] | None = None) -> list[str]:
    """Paths of required source files that do not exist (checked all at once)."""
    names = names or {k: v[0] for k, v in schemas.SOURCES.items()}
    paths = [os.path.join(data_dir, f) for f in names.values()]
    return [p for p in paths if not path_exists(spark, p)]


def load_sources(spark: SparkSession, data_dir: str,
                 file_names: dict[str, str] | None = None) -> RawTables:
    """Load the four raw sources from ``data_dir``; fail before reading anything
    if any required file is missing, naming all of them."""
    file_names = {k: v[0] for k, v in schemas.SOURCES.items()} | (file_names or {})
    missing = missing_sources(spark, data_dir, file_names)
    if missing:
        raise FileNotFoundError("missing source files: " + ", ".join(missing))
    frames = {
        name: read_source(spark, os.path.join(data_dir, file_names[name]), schemas.SOURCES[name][1])
        for name in schemas.SOURCES
    }
    return RawTables(
        campaign_metadata=frames["raw_campaign_metadata"],
        content_performance=frames["raw_content_performance"],
        user_signups=frames["raw_user_signups"],
        portfolio_revenue=frames["raw_portfolio_revenue"],
        provenance=dict(file_names),
    )


def manifest(raw: RawTables) -> DataFrame:
    """One row per raw table: (table_name, source_file, row_count).

    Each count is a partial+final aggregate over its table; the four one-row
    results are unioned (no driver round trip).
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
          .select(F.lit(name).alias("table_name"),
                  F.lit(raw.provenance.get(name, "")).alias("source_file"),
                  F.col("row_count").cast("bigint").alias("row_count"))
        for name, df in raw.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] | None = None) -> None:
    """Idempotent full-refresh table sink (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


USER_KEYED = ("raw_user_signups", "raw_portfolio_revenue")


def write_bucketed(spark: SparkSession, df: DataFrame, path: str, table: str, key: str,
                   buckets: int, watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Write ``df`` as a Parquet table bucketed and sorted by ``key`` at ``path``
    (registered in the session catalog as ``table``) and return it read back
    through the catalog, so joins on ``key`` between tables with the same bucket
    count need no shuffle. Rows meet by bucket first: one file per bucket. A key
    with a large share of the rows stays in one bucket; leave such tables
    unbucketed, where AQE splits the join. ``watch`` may observe the rows as they
    are written."""
    (watch(df.repartition(buckets, key)).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def ingest(spark: SparkSession, raw: RawTables, out_dir: str, bucket_users: int | None = None,
           database: str = "touchline_raw") -> tuple[RawTables, DataFrame]:
    """Land the raw layer as Parquet under ``out_dir`` and return the re-read
    tables plus the ingest manifest (row counts observed during the writes).

    With ``bucket_users=N`` the two user-keyed tables (signups, revenue) are
    landed bucketed by ``user_id`` into N buckets: every later join on user_id
    between them and models derived from them (the fact, the journey, the
    orphan-revenue check) reads co-located buckets instead of shuffling.
    """
    if bucket_users:
        db_path = os.path.join(out_dir, f"_{database}.db")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{db_path}'")
    landed, counts = {}, {}
    for name, df in raw.items():
        path = os.path.join(out_dir, name)
        # the row count is observed while writing: no second scan for the manifest
        obs = Observation(name)

        def watch(rows: DataFrame, obs: Observation = obs) -> DataFrame:
            return rows.observe(obs, F.count(F.lit(1)).alias("rows"))

        if bucket_users and name in USER_KEYED:
            landed[name] = write_bucketed(spark, df, path, f"{database}.{name}", "user_id", bucket_users, watch)
        else:
            write_table(watch(df), path)
            landed[name] = spark.read.parquet(path)
        counts[name] = obs.get["rows"]
    tables = RawTables(
        campaign_metadata=landed["raw_campaign_metadata"],
        content_performance=landed["raw_content_performance"],
        user_signups=landed["raw_user_signups"],
        portfolio_revenue=landed["raw_portfolio_revenue"],
        provenance=dict(raw.provenance),
    )
    observed = spark.createDataFrame(
        [(name, tables.provenance.get(name, ""), int(counts[name])) for name, _ in tables.items()],
        "table_name string, source_file string, row_count bigint")
    return tables, observed


def write_result_csv(df: DataFrame, path: str, one_file: bool = True) -> None:
    """Result-set sink: CSV with a header.  ``one_file`` only for results whose
    size is bounded (by channels, companies and months): it funnels the rows
    through one task.  Otherwise the parts keep the result's order by name."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)
