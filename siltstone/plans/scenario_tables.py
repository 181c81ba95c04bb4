"""Scenario data made of the driver's conversations, for queries that run the engine itself, and the same in SQL.

A conversation is a scenario and its turns are products. Planted are products without label or feature, scenarios on one
side only, products labelled twice, values out of bounds, missing confidences, unknown fields and bad values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.plans.registry import table
from siltstone.schema import COSTS, MEASURES

#: Measures that are not just the text's length plus their place in the list: (in Spark's and DuckDB's SQL).
OWN = {"circ_orig": "CAST(n % 7 AS DOUBLE)", "health": "CAST(turn AS DOUBLE)", "gwp": "CAST(-n AS DOUBLE)", "compressive_strength": "CAST(5 + n % 160 AS DOUBLE)", "water_to_cement_ratio": "CAST(0.2 AS DOUBLE) + (n % 10) / CAST(10 AS DOUBLE)", "density": "CAST(1200 + n % 1900 AS DOUBLE)"}
VALUES = {m: OWN.get(m, f"CAST(n + {i} AS DOUBLE)") for i, m in enumerate(MEASURES)} | dict(zip(COSTS, ("CAST(turn AS DOUBLE)", "CAST(2 AS DOUBLE)", "CAST(3.5 AS DOUBLE)"), strict=True))
ID = "CASE conv_id % 4 WHEN 0 THEN 'control_gwp_' || conv_id WHEN 1 THEN 'control_archfinish_slump_' || conv_id WHEN 2 THEN 'expert_' || conv_id ELSE CAST(conv_id AS STRING) END"
PREF = "CASE WHEN n % 37 = 0 THEN CAST(1.4 AS DOUBLE) ELSE (n % 101) / CAST(100 AS DOUBLE) END"
CONF = "CASE WHEN n % 41 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END"
#: Files that a scenario's records are in, of each kind.
FILES = 3
#: Turns in a file, of either kind: some 9 MB of features, 2 MB of labels.
PART_TURNS = 20_000
HAS_FEATURES, HAS_LABELS, LABELLED, TWICE = "conv_id % 17 <> 3", "conv_id % 19 <> 4", "(turn + conv_id) % 13 <> 5", "conv_id % 9 = 0"
TYPE = "CASE WHEN scenario_id LIKE 'control%' THEN 'control_synthetic' WHEN scenario_id LIKE 'expert%' THEN 'expert_annotated' ELSE 'llm_generated' END"

#: Common table expressions: t (turns), l (flat labels), f (flat features), joined, gated.
SQL = f"""
t AS (SELECT conv_id, turn, role, length(coalesce(text, '')) AS n, {ID} AS scenario_id FROM conversations),
l0 AS (SELECT *, 0 AS again FROM t WHERE {HAS_LABELS} AND {LABELLED} UNION ALL SELECT *, 1 FROM (SELECT * FROM t WHERE {HAS_LABELS} AND {LABELLED} AND {TWICE} QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1)),
l AS (SELECT conv_id, scenario_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY again, turn) - 1 AS INTEGER) AS label_ordinal, 'prod_' || turn AS id_prod, {PREF} AS pref, {CONF} AS conf, role AS reason FROM l0),
f AS (SELECT conv_id, scenario_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS alternative_ordinal, 'prod_' || turn AS id_prod, role, n, {', '.join(f'{v} AS {m}' for m, v in VALUES.items())} FROM t WHERE {HAS_FEATURES}),
sets AS (SELECT coalesce(a.scenario_id, b.scenario_id) AS scenario_id, coalesce(a.s = b.s, false) AS same FROM (SELECT scenario_id, list_sort(list(DISTINCT id_prod)) AS s FROM l GROUP BY 1) a FULL JOIN (SELECT scenario_id, list_sort(list(DISTINCT id_prod)) AS s FROM f GROUP BY 1) b ON a.scenario_id = b.scenario_id),
joined AS (SELECT coalesce(l.scenario_id, f.scenario_id) AS scenario_id, coalesce(l.id_prod, f.id_prod) AS id_prod, label_ordinal, alternative_ordinal, pref, conf, l.scenario_id IS NOT NULL AS has_label, f.scenario_id IS NOT NULL AS has_feature, {', '.join(VALUES)} FROM l FULL JOIN f ON l.scenario_id = f.scenario_id AND l.id_prod = f.id_prod),
gated AS (SELECT j.*, {TYPE.replace('scenario_id', 'j.scenario_id')} AS source_type, list_sort(list_filter([CASE WHEN pref NOT BETWEEN 0 AND 1 THEN 'pref_out_of_bounds' END, CASE WHEN conf NOT BETWEEN 0 AND 1 THEN 'conf_out_of_bounds' END,
  CASE WHEN has_label AND pref IS NULL THEN 'pref_missing' END, CASE WHEN has_label AND conf IS NULL THEN 'conf_missing' END, CASE WHEN count(*) OVER (PARTITION BY j.scenario_id, id_prod) > 1 THEN 'duplicate_scenario_product' END,
  CASE WHEN NOT same THEN 'scenario_product_set_mismatch' END, CASE WHEN NOT has_feature THEN 'missing_feature_row' END, CASE WHEN NOT has_label THEN 'missing_label_row' END,
  CASE WHEN compressive_strength NOT BETWEEN 5 AND 150 THEN 'compressive_strength_out_of_range' END, CASE WHEN water_to_cement_ratio NOT BETWEEN 0.2 AND 1 THEN 'water_to_cement_ratio_out_of_range' END, CASE WHEN density NOT BETWEEN 1200 AND 3000 THEN 'density_out_of_range' END], lambda x: x IS NOT NULL)) AS r
  FROM joined j JOIN sets s ON j.scenario_id = s.scenario_id)"""


def _turns(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").selectExpr("conv_id", "turn", "role", "length(coalesce(text, '')) AS n")
    return rows.withColumn("id", F.expr(ID)).withColumn("file", F.expr(f"CAST(conv_id % {FILES} AS INT)"))


def landed_labels(spark: SparkSession, d: str) -> DataFrame:
    """Records as they land: (conv_id, file, id, labelled_alternatives)."""
    entry = F.struct("turn", F.struct(F.expr("'prod_' || turn").alias("id_prod"), F.expr(PREF).alias("pref"), F.expr(CONF).alias("conf"), F.col("role").alias("reason")).alias("l"))
    packed = _turns(spark, d).filter(f"{HAS_LABELS} AND {LABELLED}").groupBy("conv_id", "file", "id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["l"]).alias("a"))
    return packed.select("conv_id", "file", "id", F.when(F.expr(TWICE), F.concat("a", F.slice("a", 1, 1))).otherwise(F.col("a")).alias("labelled_alternatives"))


def landed_features(spark: SparkSession, d: str) -> DataFrame:
    """(conv_id, file, id, stakeholder_preference, situations, alternatives)."""
    measures = [F.expr(VALUES[m]).alias(m) for m in MEASURES]
    measures.insert(MEASURES.index("b") + 1, F.struct(*[F.expr(VALUES[c]).alias(c) for c in COSTS]).alias("c"))
    entry = F.struct("turn", F.col("role"), F.expr("'size_' || n % 3").alias("s"), F.struct(F.expr("'prod_' || turn").alias("id_prod"), *measures).alias("a"))
    packed = _turns(spark, d).filter(HAS_FEATURES).groupBy("conv_id", "file", "id").agg(F.array_sort(F.collect_list(entry)).alias("x"))
    return packed.select("conv_id", "file", "id", F.col("x.role").alias("stakeholder_preference"), F.col("x.s").alias("situations"), F.col("x.a").alias("alternatives"))


def in_bronze(records: DataFrame, batch: str = "b1") -> DataFrame:
    """Records with the lineage that flattening wants, without a trip through files."""
    return records.withColumn("_source_file", F.concat(F.lit("file_"), "file")).withColumn("_batch_id", F.lit(batch)).drop("conv_id", "file")


def parts(spark: SparkSession, d: str) -> int:
    """Into how many files each of the ``FILES`` is to be dealt, so that none has many more than ``PART_TURNS`` turns."""
    return max(1, -(-table(spark, d, "conversations").count() // (FILES * PART_TURNS)))


def put_files(spark: SparkSession, records: DataFrame, folder: str, stem: str, parts: int = 1, folders: bool = False) -> None:
    """Write records (file, conv_id, ...) as files, each one JSON array: ``<stem>_<file>.json``.

    With several ``parts``, that many files take the place of one: ``<stem>_<file>_<part>.json``, or with ``folders``, the
    same name in a folder for each part. A record is in the same part whenever the number of parts is the same.
    """
    fields = [c for c in records.columns if c not in ("file", "conv_id")]
    drafts = f"{folder}-drafts-{stem}"
    dealt = records.withColumn("part", F.pmod(F.xxhash64("conv_id"), F.lit(parts)))
    dealt.groupBy("file", "part").agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value")).write.partitionBy("file", "part").text(drafts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(drafts).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(folder))
    for found in system.globStatus(hadoop.Path(f"{drafts}/file=*/part=*/part-*")) or ():
        file, part = (x.split("=")[1] for x in found.getPath().toString().split("/")[-3:-1])
        target = hadoop.Path(f"{folder}/{part}/{stem}_{file}.json" if folders else f"{folder}/{stem}_{file}{f'_{part}' if parts > 1 else ''}.json")
        system.mkdirs(target.getParent())
        system.delete(target, False)
        system.rename(found.getPath(), target)
    system.delete(hadoop.Path(drafts), True)
