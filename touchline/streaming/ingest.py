"""Incremental ingest of source drops with Structured Streaming.

The batch ingest (:func:`touchline.sources.files.ingest`) rebuilds the raw
layer from scratch.  When source files keep arriving in a landing folder, the
same raw tables can be maintained incrementally: a file-source stream with the
source's explicit schema appends each new file's rows to the Parquet raw table
exactly once (the checkpoint records which files were taken).  Rows are copied
faithfully, like the batch ingest: no cleaning, no de-duplication.

With ``available_now`` (default) a call processes everything that arrived since
the last call and stops, which suits a scheduled batch; without it the query
keeps running and picks files up as they land.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from touchline.plans.warehouse import shared_dir
from touchline.sources import schemas
from touchline.sources.files import conform


def read_stream(spark: SparkSession, name: str, directory: str, fmt: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the files of raw table ``name`` in ``directory``."""
    file_name, schema = schemas.SOURCES[name]
    fmt = fmt or ("json" if file_name.endswith(".json") else "csv")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd")
    elif fmt == "json":
        reader = reader.option("multiLine", True).option("mode", "FAILFAST")  # each file is one JSON array
    elif fmt == "jsonl":
        fmt, reader = "json", reader.option("mode", "FAILFAST")
    return conform(reader.format(fmt).load(directory), schema)


def land(stream: DataFrame, table_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the stream to a Parquet table; the checkpoint makes it exactly-once."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(table_path)


def ingest_new_files(spark: SparkSession, landing: dict[str, str], out_dir: str,
                     checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Take the files that arrived in each landing folder since the last run and
    append them to ``out_dir/<raw table>``; waits for the available-now runs."""
    checkpoint_root = checkpoint_root or os.path.join(shared_dir(spark), "touchline-stream")
    queries = {}
    for name, directory in landing.items():
        q = land(read_stream(spark, name, directory), os.path.join(out_dir, name),
                 os.path.join(checkpoint_root, name))
        queries[name] = q
    for q in queries.values():
        q.awaitTermination()
    return queries
