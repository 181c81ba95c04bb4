"""Nested JSON files, each one top-level array, by a pinned schema, with what does not fit kept in a rescue column.

A file is parsed to one variant and exploded to records, so that a bad value or an unknown field concerns its own record
only. ``_rescued_data`` is null for records that fit; otherwise it is the record's JSON text. Files are read once: one that
is not a JSON array gives a single row without a record, which ``checked`` finds in what was written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources.files import RawFile

RESCUED, SOURCE, HASH, BATCH, INGESTED = "_rescued_data", "_source_file", "_file_hash", "_batch_id", "_ingested_at"
#: The rescued text of a file that is not a JSON array.
NO_ARRAY = "not a JSON array"


class UnreadableFile(ValueError):
    """A file is not a JSON array."""


def typed(whole: DataFrame, schema: str, keep: Sequence[str] = (SOURCE,)) -> DataFrame:
    """Records of frames (v, ...) that have a file's content as a variant; works on streams as well."""
    struct = T.StructType.fromDDL(schema)
    # An empty array has no records; what is no array has one that is null, as no item of an array is (a JSON null is a
    # variant). So nothing about a file is asked of its content again for each of its records.
    items = F.coalesce(F.expr("try_variant_get(v, '$', 'array<variant>')"), F.array(F.lit(None).cast("variant")))
    one = whole.select(*keep, F.explode(items).alias("_value"))
    text = one.select(*keep, F.col("_value").isNotNull().alias("_array"), F.to_json("_value").alias("_text"))
    parsed = text.withColumn("_r", F.from_json("_text", T.StructType([*struct.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    extra = F.size(F.array_except(F.json_object_keys("_text"), F.array(*[F.lit(f.name) for f in struct]))) > 0
    rescued = F.when(~F.col("_array"), NO_ARRAY).when(F.col("_r._bad").isNotNull() | F.coalesce(extra, F.lit(True)), F.coalesce("_text", F.lit("null")))
    return parsed.select(*[F.col(f"_r.{f.name}").alias(f.name) for f in struct], rescued.alias(RESCUED), *keep)


def records(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """Typed records of the files, with ``_rescued_data`` and ``_source_file``."""
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "v").json(list(paths))
    return typed(whole.select("v", F.col("_metadata.file_name").alias(SOURCE)), schema)


def lineage(digest: Column, batch_id: str) -> list[Column]:
    """The columns that say where a row comes from, besides the name of its file."""
    return [digest.cast("string").alias(HASH), F.lit(batch_id).alias(BATCH), F.current_timestamp().alias(INGESTED)]


def read_sources(spark: SparkSession, sources: Sequence[RawFile], schema: str, batch_id: str) -> DataFrame | None:
    """All files in one scan, with name, hash, batch and time; None without files."""
    if not sources:
        return None
    rows = records(spark, [f.path for f in sources], schema)
    names = spark.createDataFrame([(f.name, f.digest) for f in sources], "_name string, _digest string")
    named = rows.join(F.broadcast(names), F.col(SOURCE) == F.col("_name"))  # as many rows as files
    return named.select(*rows.columns, *lineage(F.col("_digest"), batch_id))


def checked(landed: DataFrame) -> None:
    """An error that names the files among landed rows that are not a JSON array."""
    bad = [r[0] for r in landed.filter(F.col(RESCUED) == NO_ARRAY).select(SOURCE).distinct().orderBy(SOURCE).collect()]
    if bad:
        raise UnreadableFile(f"not a JSON array: {', '.join(bad)}")
