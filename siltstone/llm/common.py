"""Pieces that several corpus operators share: scratch storage, ranking, text rules."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from contextlib import contextmanager, suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = "\\x20\\x09-\\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is made only in local mode, where the session names none."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="siltstone-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the Hadoop file system that owns it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession, label: str):
    """A fresh shared folder that is removed at the end; nothing lazy may outlive the block."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_path(spark, path)


def tidy(run):
    """``run`` over a Python task's batches; at its end, memory that the worker has freed goes back to the system.

    Workers live on between tasks, and so would the largest chunk that any of their tasks has ever held.
    """

    def whole(batches):
        with suppress(OSError, AttributeError):  # not every C library has these
            # M_MMAP_THRESHOLD: arrays of 4 MB and more go back as soon as they are freed.
            ctypes.CDLL(None).mallopt(-3, 4 << 20)
        try:
            yield from run(batches)
        finally:
            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return whole


#: Checkpoint folders made inside the open ``steps`` blocks, innermost last.
_steps: list[list[str]] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Inside a ``steps`` block the files go at its end, else with the last reference, if the session cleans checkpoints.
    """
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _steps:
        _steps[-1].append(_file(out))
    return out


def _file(written_down: DataFrame) -> str:
    """The folder of a frame that ``cut`` gave."""
    # The plan of a frame that was checkpointed is a scan whose second field is what was checkpointed.
    return written_down._jdf.queryExecution().analyzed().productElement(1).getCheckpointFile().get()


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``cut`` gave inside the open block and that nothing needs any more."""
    path = _file(df)
    if _steps and path in _steps[-1]:
        _steps[-1].remove(path)
        delete_path(df.sparkSession, path)


@contextmanager
def steps(spark: SparkSession):
    """Delete what ``cut`` writes inside the block at its end. The block gets a function that writes a result down so that
    it outlives the block; nothing else that is lazy may."""
    mine: list[str] = []
    _steps.append(mine)

    def result(df: DataFrame) -> DataFrame:
        out = cut(df)
        outer = _steps[-2] if len(_steps) > 1 else []
        outer.append(mine.pop())
        return out

    try:
        yield result
    finally:
        _steps.remove(mine)
        for path in mine:
            delete_path(spark, path)


def sweep(spark: SparkSession) -> None:
    """Let Spark remove the shuffle and checkpoint files that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; the quick path takes texts that hold ASCII only."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dense_rank_in(df: DataFrame, keys: list[str], order: Column, rows: int, name: str, per_bucket: int = 20_000) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in the order of a hash of ``order``.

    No key is gathered in one task: rows fall into hash buckets of about ``per_bucket``; counts by (key, bucket) are
    summed up to offsets, and only within a bucket are rows sorted. Equal rows get different numbers.
    """
    buckets = max(1, -(-rows // per_bucket))
    mix = F.xxhash64(order, F.lit(name))
    dealt = df.withColumn("_mix", mix).withColumn("_bucket", F.pmod(F.shiftright("_mix", 20), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_mix", order)
    ranked = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    on = [ranked["_bucket"] == offsets["_b"], *(ranked[k].eqNullSafe(offsets[f"_k{i}"]) for i, k in enumerate(keys))]
    joined = ranked.join(offsets, on).withColumn(name, (F.col("_from") + F.col("_in")).cast("long"))
    return joined.drop("_mix", "_bucket", "_in", "_from", "_b", *(f"_k{i}" for i in range(len(keys))))


#: A filter in front of a join has at most so many bits, in words of 64 bits: that bounds its broadcast.
FILTER_BITS = 1 << 26


def filter_bits(keys: int) -> int:
    """Bits of a filter for so many keys: 16 for each, within bounds."""
    return min(FILTER_BITS, 1 << max(12, (16 * keys).bit_length()))


def filter_words(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """A Bloom filter of one hash over a column: (word, mask) of the words of 64 bits that are not empty."""
    places = keys.selectExpr(f"pmod(xxhash64({column}), {bits}L) AS _p")
    return places.groupBy(F.expr("shiftright(_p, 6)").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(_p & 63 AS INT))")).alias("_mask"))


def marked(rows: DataFrame, column: str, words: DataFrame, bits: int, name: str) -> DataFrame:
    """``rows`` with a boolean that is false only where the key is in no filter word; the words are broadcast."""
    found = rows.withColumn("_p", F.expr(f"pmod(xxhash64({column}), {bits}L)")).join(F.broadcast(words), F.expr("shiftright(_p, 6)") == F.col("_word"), "left")
    return found.withColumn(name, F.expr("(shiftright(coalesce(_mask, 0L), CAST(_p & 63 AS INT)) & 1) = 1")).drop("_p", "_word", "_mask")


def sieve(rows: DataFrame, column: str, wanted: DataFrame, wanted_column: str) -> DataFrame:
    """``rows`` without most of those whose key is not among the wanted ones; none that is wanted is lost."""
    bits = filter_bits(wanted.count())
    return marked(rows, column, filter_words(wanted, wanted_column, bits), bits, "_maybe").filter("_maybe").drop("_maybe")


def light(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` (narrow, and written down) to be broadcast where its rows, which are counted, are at most so many."""
    return F.broadcast(df) if df.count() <= rows else df


def keep_ids(docs: DataFrame, ids: DataFrame, how: str, column: str = "doc_id") -> DataFrame:
    """Semi or anti join on an id."""
    ids = light(ids.select(F.col(column).alias("_id")))
    return docs.join(ids, docs[column].eqNullSafe(ids["_id"]), how)


LONG, INT, STRING, DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
