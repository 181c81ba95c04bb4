"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before has left, whole, and its decisions take effect:

1. toxicity: documents with a score of 0.5 or more go;
2. exact dedup: one document of each group of texts that are equal but for the case of A-Z stays, the smallest id;
3. near-dedup: one document of each group of near copies stays (shingles of five words, similarity 0.8), the smallest id;
4. substring dedup: words in windows of 20 that start earlier elsewhere are cut out; no row goes, texts without a repeat
   stay as they are (a null text becomes an empty one), in others the words that stay are joined by one space and
   ``n_chars`` is counted anew;
5. packing: what is left is tokenised and packed into sequences of at most 2048 ids.

All but the last return the columns of ``documents``. Rows without an id are never dropped as near copies.

Defined cases, in each stage: null and empty texts are documents without words; they are kept unless they are exact copies of
one another, and give the end id alone. Texts of any length are taken whole. Of rows that tie, with equal texts or sets, the
smallest id stays; rows that repeat id and text are one document in stages 2 and 3. An empty table goes through all stages
and gives no pieces; without labels nothing is toxic (every score is a quarter).
Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import exact_dedup, near_dedup, packing, substring_dedup, toxicity
from siltstone.llm.common import cut, keep_ids, scratch, steps, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn("_toxicity", toxicity.score_column(machine, docs["text"]))
    return scored.filter(F.col("_toxicity") < 0.5).drop("_toxicity")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    answer = exact_dedup.exact_groups(docs, keep="smallest")
    if answer.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return keep_ids(docs, answer.filter("NOT kept"), "left_anti")
    # Ids repeat: rows are told apart by their texts, and of rows with one id and text one stays.
    stay = answer.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    marked = docs.withColumn("_digest", F.sha2(exact_dedup.normal(docs["text"]), 256))
    found = marked.join(stay, marked["doc_id"].eqNullSafe(stay["_id"]) & (F.col("_digest") == F.col("_sha")), "left_semi")
    return found.dropDuplicates(["doc_id", "_digest"]).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(docs, k=5, num=80, den=100)
    return keep_ids(docs, cut(groups.filter("NOT kept").select("doc_id")), "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = substring_dedup.remove_repeats(docs, carry=others, verbatim=True)
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept")} | {c: F.col(f"carried.{c}") for c in others}
    if "n_chars" in made:
        made["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(made["n_chars"])
    return rows.select(*[made[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: No stage but the second can be stated in SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; between them, Parquet in the shared folder."""
    with scratch(spark, "pipeline") as path:
        docs = table(spark, sf_dir, "documents")
        for i, (_, stage) in enumerate(STAGES[:-1]):
            with steps(spark):  # what the stage has written down on its way
                docs = written(stage(spark, docs, sf_dir), f"{path}/{i}")
        return cut(STAGES[-1][1](spark, docs, sf_dir))
