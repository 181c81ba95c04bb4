"""Exact dedup by a log-structured merge index of digests; DataFrame and SQL functions only.

A memtable holds at most ``memtable_rows`` rows of one task. It is flushed as a sorted run of (SHA-256, id) with a Bloom
filter; no row moves for that. Compaction merges ``fanout`` runs into one of the next level, all runs of a level in one job,
and so on until one run is left; a merged run has, for each digest, its smallest and largest identifier and its number of
rows. Batches that come later are flushed and merged with what is there.

Every run has a filter beside it, and a look-up reads the filters first and opens a run only for digests that pass. A row is
a hit if its digest has several rows; only hits are joined with the index, the others pass by the filter of the digests
that have several rows. The texts behind hits are compared byte by byte, and digests that different texts share are split
by text.

Defined cases: a null text counts as empty, a text of any length is hashed and compared whole. A row without id takes part;
it stays only if its whole group has no id. Rows that repeat an id and a text (ties) each count for the size and get the
same answer. An id with several texts is answered once for each text. An empty table gives an empty result. Other columns
are ignored, whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import ascii_lower, cut, delete_path, filter_bits, filter_words, marked, scratch, sieve, steps, table


def normal(text: Column) -> Column:
    """Null as empty; A-Z in lower case."""
    return ascii_lower(F.coalesce(text, F.lit("")))


RUN = "digest binary, run long, lo long, hi long, n long"


class DigestIndex:
    """Runs of digests under ``path``. ``rows`` are the flushed rows, ``levels`` the folders of merged runs, lowest first.

    ``digest_bytes`` shortens the key, which only serves tests of the path that separates colliding texts.
    """

    def __init__(self, spark: SparkSession, path: str, digest_bytes: int = 32, memtable_rows: int = 500_000, fanout: int = 16):
        self.spark, self.path, self.digest_bytes, self.memtable_rows, self.fanout = spark, path.rstrip("/"), digest_bytes, memtable_rows, fanout
        self.flushed: list[str] = []
        self.fresh: list[str] = []
        self.levels: list[str] = []
        self.written = 0

    def _write(self, df: DataFrame, column: str, kind: str) -> str:
        self.written += 1
        path = f"{self.path}/{kind}-{self.written}"
        filters = {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.expected.ndv#{column}": str(self.memtable_rows), "parquet.bloom.filter.max.bytes": str(1 << 19), "maxRecordsPerFile": str(self.memtable_rows)}
        df.write.options(**filters).parquet(path)
        return path

    def _key(self) -> Column:
        return F.col("sha") if self.digest_bytes >= 32 else F.substring("sha", 1, self.digest_bytes)

    def flush(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> None:
        """Write each task's share of ``docs`` as sorted runs of at most ``memtable_rows``."""
        rows = docs.select(docs[id_column].cast("long").alias("id"), F.unhex(F.sha2(normal(docs[text_column]), 256)).alias("sha"))
        run = self._write(rows.sortWithinPartitions("sha", "id"), "sha", "memtables")
        self.flushed.append(run)
        self.fresh.append(run)

    def rows(self) -> DataFrame:
        """Every flushed row."""
        return self.spark.read.schema("id long, sha binary").parquet(*self.flushed)

    def _runs(self, path: str) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(path)

    def compact(self) -> DataFrame:
        """Merge runs level by level, ``fanout`` into one, until one run is left; returns it.

        A flushed file is a run. Runs are named by numbers, and those whose numbers agree but for the last digit to the
        base ``fanout`` meet.
        """
        if not self.levels and not self.fresh:
            return self.spark.createDataFrame([], "digest binary, lo long, hi long, n long")
        parts = None
        if self.fresh:
            names = self.spark.read.schema("id long, sha binary").parquet(*self.fresh).select(F.xxhash64(F.col("_metadata.file_path")).alias("file"), F.col("id").alias("lo"), F.col("id").alias("hi"), F.lit(1).cast("long").alias("n"), self._key().alias("digest"))
            files = len(self.spark.read.schema("id long, sha binary").parquet(*self.fresh).inputFiles())
            # Run numbers by a hash of the file's name: about ``fanout`` runs meet in each group.
            groups = max(1, -(-files // self.fanout))
            parts, runs = names.select("digest", F.pmod("file", F.lit(groups)).alias("run"), "lo", "hi", "n"), groups
        old = self.levels[-1] if self.levels else None
        if old:
            before = self._runs(old).select("digest", F.lit(0).cast("long").alias("run"), "lo", "hi", "n")
            parts, runs = (before, 1) if parts is None else (parts.unionByName(before), runs)
        while True:
            merged = parts.groupBy("run", "digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
            # Sorted by digest in each file: a file of a merged run covers the digests of one hash range.
            path = self._write(merged.select("digest", "run", "lo", "hi", "n").sortWithinPartitions("run", "digest"), "digest", f"level{len(self.levels) + 1}")
            self.levels.append(path)
            if runs == 1:
                break
            runs = max(1, -(-runs // self.fanout))
            parts = self._runs(path).withColumn("run", F.pmod("run", F.lit(runs)))
        for lower in self.levels[:-1]:
            delete_path(self.spark, lower)
        self.levels, self.fresh = self.levels[-1:], []
        return self.merged()

    def merged(self) -> DataFrame:
        return self._runs(self.levels[-1]).drop("run")

    def _filtered(self, rows: DataFrame, run: DataFrame) -> DataFrame:
        """``rows`` (digest) with ``maybe``: whether the filter of the digests of ``run`` lets them pass."""
        bits = filter_bits(run.count())
        return marked(rows, "digest", filter_words(run, "digest", bits), bits, "maybe")

    def seen(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """(id, lo, hi, n) of the rows of a batch whose text is in the index already."""
        rows = docs.select(docs[id_column].cast("long").alias("id"), F.unhex(F.sha2(normal(docs[text_column]), 256)).alias("sha")).withColumn("digest", self._key())
        run = self.merged()
        return self._filtered(rows, run).filter("maybe").join(run, "digest").select("id", "lo", "hi", "n")

    def resolve(self, keep: str = "smallest") -> DataFrame:
        """(id, sha, digest, keep_id, group_size) for every flushed row, as the digests say."""
        # Written down, so that the rows of a digest that very many rows have can be split over tasks when they are joined.
        several = cut(self.merged().filter("n > 1").select("digest", F.col("lo" if keep == "smallest" else "hi").alias("keep_id"), F.col("n").alias("group_size")))
        rows = self._filtered(self.rows().withColumn("digest", self._key()), several)
        alone = rows.filter("NOT maybe").select("id", "sha", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
        there = several.withColumnRenamed("digest", "d")
        hits = rows.filter("maybe").join(there, F.col("digest") == F.col("d"), "left")
        single = F.col("d").isNull()
        hits = hits.select("id", "sha", "digest", F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.when(single, 1).otherwise(F.col("group_size")).cast("long").alias("group_size"))
        return alone.unionByName(hits)


def _split_digests(docs: DataFrame, hits: DataFrame, digest_bytes: int, id_column: str, text_column: str) -> DataFrame:
    """Digests of hits whose texts are not all the same bytes. Most texts that are no hits stay out of the shuffle."""
    texts = docs.select(docs[id_column].cast("long").alias("text_id"), docs[text_column].alias("raw"))
    found = sieve(texts, "text_id", hits, "id").select(normal(F.col("raw")).alias("norm"))
    digest = F.substring(F.unhex(F.sha2("norm", 256)), 1, digest_bytes).alias("digest")
    return found.groupBy(digest).agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).filter("lo != hi").select("digest")


def _texts(docs: DataFrame, hits: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The normalised texts of some rows (id, sha, digest)."""
    texts = sieve(docs.select(docs[id_column].cast("long").alias("text_id"), docs[text_column].alias("raw")), "text_id", hits, "id")
    # Rows may repeat an id: the digest says which text a hit means.
    found = texts.join(hits, texts["text_id"].eqNullSafe(hits["id"])).withColumn("norm", normal(F.col("raw")))
    return found.filter(F.unhex(F.sha2("norm", 256)) == F.col("sha")).select("id", "sha", "digest", "norm")


def exact_groups(docs: DataFrame, keep: str = "smallest", id_column: str = "doc_id", text_column: str = "text", digest_bytes: int = 32, memtable_rows: int = 500_000, fanout: int = 16) -> DataFrame:
    """One row (doc_id, keep_id, group_size, kept, text_sha256) for each row of ``docs``.

    ``keep`` says whether the smallest or the largest id of equal texts stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    with steps(spark) as result:
        with scratch(spark, "digest-index") as path:
            index = DigestIndex(spark, path, digest_bytes, memtable_rows, fanout)
            index.flush(docs, id_column, text_column)
            index.compact()
            answer = cut(index.resolve(keep))
        split = cut(_split_digests(docs, answer.filter("group_size > 1"), digest_bytes, id_column, text_column))
        if not split.isEmpty():
            answer = _separate(docs, answer, split, keep, id_column, text_column)
        return result(answer.select(
            F.col("id").alias("doc_id"), "keep_id", "group_size",
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        ))


def _separate(docs: DataFrame, answer: DataFrame, split: DataFrame, keep: str, id_column: str, text_column: str) -> DataFrame:
    """Group the rows of digests that several texts share by the texts themselves."""
    rows = answer.join(split, "digest", "left_semi")
    hits = rows.select("id", "sha", "digest").distinct()
    texts = _texts(docs, hits, id_column, text_column).select("id", "sha", "norm")
    best = F.min("id") if keep == "smallest" else F.max("id")
    groups = texts.groupBy("norm").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    of_row = texts.distinct().join(groups, "norm").select("id", "sha", "keep_id", "group_size")
    again = rows.select(F.col("id").alias("row_id"), F.col("sha").alias("row_sha"), "digest").join(of_row, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_sha") == F.col("sha")))
    return answer.join(split, "digest", "left_anti").select("id", "sha", "digest", "keep_id", "group_size").unionByName(again.select("id", "sha", "digest", "keep_id", "group_size"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its equal texts: the largest id."""
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""
