"""Streaming arrival of JSON files into versioned tables: each file once, all that is there, then stop.

The file source knows files by name; content that is replaced under its name is left to the batch ingest, which goes by
content hash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.sources.json_scan import SOURCE, checked, lineage, typed
from siltstone.store.table import VersionedTable


def _stream(spark: SparkSession, globs: Sequence[str], files_per_batch: int):
    glob = globs[0] if len(globs) == 1 else "{" + ",".join(globs) + "}"
    return spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)


def stream_files(spark: SparkSession, folder: str, schema: str, globs: Sequence[str] = ("*.json",), multiline: bool = True, files_per_batch: int = 100) -> DataFrame:
    """New JSON files of a folder that any of the globs matches, with their names."""
    rows = _stream(spark, globs, files_per_batch).schema(schema).option("multiLine", multiline).json(folder)
    return rows.select("*", F.col("_metadata.file_name").alias(SOURCE))


def stream_records(spark: SparkSession, folder: str, schema: str, globs: Sequence[str], batch_id: str, files_per_batch: int = 100) -> DataFrame:
    """New files, each one array, as typed records with the rescue column and lineage; a stream knows no content hash."""
    whole = _stream(spark, globs, files_per_batch).option("wholetext", True).text(folder)
    rows = typed(whole.select(F.try_parse_json("value").alias("v"), F.col("_metadata.file_name").alias(SOURCE)), schema)
    return rows.select("*", *lineage(F.lit(None), batch_id))


def into_table(stream: DataFrame, table: VersionedTable, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, check: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Append what is there to the table, one version for each micro-batch, and stop.

    A micro-batch that is replayed after a crash is recognised by its number, which the table keeps as a property.
    """

    def write(batch: DataFrame, number: int) -> None:
        done = int(table.properties().get("stream_batch", -1)) if table.exists() else -1
        if number <= done:
            return
        table.append(transform(batch) if transform else batch, check)
        table.set_properties(stream_batch=str(number))

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def arrive(spark: SparkSession, folder: str, globs: Sequence[str], schema: str, table: VersionedTable, checkpoint: str, batch_id: str) -> None:
    """Land all files with new names and wait until they are there."""
    into_table(stream_records(spark, folder, schema, globs, batch_id), table, checkpoint, check=checked).awaitTermination()
