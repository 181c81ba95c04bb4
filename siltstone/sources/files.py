"""Raw files by content: what is there, and what of it has not been ingested. All of it goes through Hadoop file systems."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.config import SOURCES, PipelineConfig
from siltstone.schema import INGEST_LOG_DDL

#: Files above this are hashed as a stream, since the scan of whole files holds each in memory.
SCANNED_BYTES = 512 << 20


@dataclass(frozen=True)
class RawFile:
    kind: str
    path: str
    digest: str
    size: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[1]


def _hadoop(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, config: PipelineConfig, kind: str) -> dict[str, int]:
    """Paths and sizes of the files of a kind, in order of path; an error if there is none."""
    found: dict[str, int] = {}
    for pattern in SOURCES[kind]:
        path, system = _hadoop(spark, f"{str(config.raw_dir).rstrip('/')}/{pattern}")
        found |= {s.getPath().toString(): s.getLen() for s in system.globStatus(path) or ()}
    if not found:
        raise FileNotFoundError(f"no {kind} files ({', '.join(SOURCES[kind])}) in {config.raw_dir}")
    return dict(sorted(found.items()))


def first_release(spark: SparkSession, config: PipelineConfig, kind: str) -> str:
    """The one file of a kind that a first release has; of several names the earlier one counts."""
    names = [p.replace("*", "") for p in SOURCES[kind]]
    there = {p.rsplit("/", 1)[1]: p for p in listed(spark, config, kind)}
    if not there.keys() & set(names):
        raise FileNotFoundError(f"none of {', '.join(names)} in {config.raw_dir}")
    return there[min(there.keys() & set(names), key=names.index)]


def content_hashes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, source_file, file_hash, byte_size) by a distributed scan, a task for each few files."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), F.sha2("content", 256).alias("file_hash"), F.col("length").alias("byte_size"))


def stream_hash(spark: SparkSession, place: str) -> str:
    """SHA-256 of a file of any size, read as a stream in the JVM of the driver."""
    path, system = _hadoop(spark, place)
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def describe(spark: SparkSession, config: PipelineConfig) -> list[RawFile]:
    """Every raw file that is there, with its content's hash; one row for each file reaches the driver."""
    sizes = {kind: listed(spark, config, kind) for kind in SOURCES}
    small = [p for found in sizes.values() for p, n in found.items() if n <= SCANNED_BYTES]
    digests = {r["source_file"]: r["file_hash"] for r in content_hashes(spark, small).select("source_file", "file_hash").collect()} if small else {}
    return [RawFile(kind, p, digests[p.rsplit("/", 1)[1]] if n <= SCANNED_BYTES else stream_hash(spark, p), n) for kind, found in sizes.items() for p, n in found.items()]


def pending(present: DataFrame, log: DataFrame) -> DataFrame:
    """Files (source_file, file_hash, ...) whose content is not the one last ingested under their name.

    Only the latest entry of a name counts, so that going back to earlier content is a change too.
    """
    newest = F.row_number().over(Window.partitionBy("source_file").orderBy(F.col("batch_id").desc(), F.col("ingested_at").desc()))
    last = log.withColumn("_n", newest).filter("_n = 1").select("source_file", "file_hash")
    return present.join(last, ["source_file", "file_hash"], "left_anti")


def not_ingested(spark: SparkSession, present: Iterable[RawFile], log: DataFrame) -> list[RawFile]:
    present = list(present)
    frame = spark.createDataFrame([(i, f.name, f.digest) for i, f in enumerate(present)], "i int, source_file string, file_hash string")
    return [present[r["i"]] for r in pending(frame, log).orderBy("i").collect()]


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INGEST_LOG_DDL)


def log_rows(spark: SparkSession, taken: Iterable[RawFile], batch_id: str, counts: dict[str, int]) -> DataFrame:
    now = datetime.now(UTC)
    return spark.createDataFrame([(f.name, f.digest, f.kind, f.size, counts.get(f.name, 0), batch_id, now) for f in taken], INGEST_LOG_DDL)


def rows_by_file(landed: DataFrame, batch_id: str) -> DataFrame:
    """(source_file, rows) of one batch."""
    return landed.filter(F.col("_batch_id") == batch_id).groupBy(F.col("_source_file").alias("source_file")).agg(F.count(F.lit(1)).alias("rows"))


def new_batch_id() -> str:
    """UTC time to the microsecond; sorts as text."""
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
