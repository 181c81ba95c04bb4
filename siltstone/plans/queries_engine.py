"""Queries that run the engine itself over scenario data: landing, flattening, gate, limits, whole builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.config import BOUNDS, LABELS, LIMITS, SOURCES, PipelineConfig
from siltstone.functions import correlation
from siltstone.functions.provenance import CORRECTED
from siltstone.operators import diff, gate, unnest
from siltstone.operators.join import joined_scenarios
from siltstone.plans import pipeline, versions
from siltstone.plans.queries_tables import settled, workspace
from siltstone.plans.registry import Register, table
from siltstone.plans.scenario_tables import FILES, HAS_FEATURES, SQL, TYPE, VALUES, in_bronze, landed_features, landed_labels, parts, put_files
from siltstone.schema import GOLD, GOLD_CHECKS, LABELS_DDL, MEASURES, REJECTED, SILVER_FEATURES, SILVER_KEYS, SILVER_LABELS, SILVER_SITUATION, SILVER_STAKEHOLDER
from siltstone.sources import files
from siltstone.sources.json_scan import read_sources
from siltstone.store.table import VersionedTable, violations
from siltstone.streaming.ingest import arrive

R = Register()
QUERIES, ORACLES = R.queries, R.oracles
WITH = f"WITH {SQL} "


def flat(spark, d):
    """The four flat frames."""
    return unnest.silver(in_bronze(landed_labels(spark, d)), in_bronze(landed_features(spark, d)))


def gated(spark, d):
    return pipeline.gated(flat(spark, d), PipelineConfig(), CORRECTED)


def joined_text(name):
    return F.array_join(name, "|")


# ---- landing


def put_odd_labels(spark, d, folder, **dealt):
    """Arrays as they are, except where the text of one stands instead."""
    rows = landed_labels(spark, d).filter("conv_id % 11 <> 1").withColumn("note", F.when(F.expr("conv_id % 11 = 0"), F.lit("seen")))
    put_files(spark, rows, folder, "labelled_alternatives_a", **dealt)
    bad = landed_labels(spark, d).filter("conv_id % 11 = 1").select("conv_id", "file", "id", F.lit("no array").alias("labelled_alternatives"))
    put_files(spark, bad, folder, "labelled_alternatives_b", **dealt)
    put_files(spark, landed_features(spark, d), folder, "frozen_dataset", **dealt)


ODD = f"{WITH.rstrip()}, r AS (SELECT DISTINCT conv_id, scenario_id FROM l), odd AS (SELECT scenario_id AS id, conv_id, CASE WHEN conv_id % 11 = 1 THEN NULL ELSE (SELECT count(*) FROM l WHERE l.conv_id = r.conv_id) END AS labels, CASE conv_id % 11 WHEN 0 THEN 'unknown field' WHEN 1 THEN 'bad value' END AS rescued, 'labelled_alternatives_' || CASE WHEN conv_id % 11 = 1 THEN 'b' ELSE 'a' END || '_' || (conv_id % {FILES}) || '.json' AS _source_file FROM r)"


def why_rescued():
    return F.when(F.get_json_object("_rescued_data", "$.note").isNotNull(), "unknown field").when(F.col("_rescued_data").isNotNull(), "bad value")


@R.add("scan_json_nested", f"{ODD} SELECT id, labels, rescued FROM odd")
def scan_json_nested(spark, d):
    """Nested files scanned by their pinned schema; records with unknown fields or bad values are rescued, others are not touched."""
    with workspace(spark) as path:
        put_odd_labels(spark, d, f"{path}/raw", parts=parts(spark, d))
        config = PipelineConfig(raw_dir=f"{path}/raw")
        present = [f for f in files.describe(spark, config) if f.kind == LABELS]
        rows = read_sources(spark, present, LABELS_DDL, "b1")
        size = F.when(F.col("labelled_alternatives").isNotNull(), F.size("labelled_alternatives")).cast("long")
        return settled(rows.select("id", size.alias("labels"), why_rescued().alias("rescued")))


@R.add("provenance_columns", f"{ODD} SELECT id, _source_file, 'b7' AS _batch_id, true AS hash_is_right FROM odd")
def provenance_columns(spark, d):
    """What a landed row says of its origin; its hash is compared with one made from the file's stream."""
    with workspace(spark) as path:
        put_odd_labels(spark, d, f"{path}/raw")
        present = [f for f in files.describe(spark, PipelineConfig(raw_dir=f"{path}/raw")) if f.kind == LABELS]
        again = spark.createDataFrame([(f.name, files.stream_hash(spark, f.path)) for f in present], "name string, digest string")
        rows = read_sources(spark, present, LABELS_DDL, "b7")
        both = rows.join(F.broadcast(again), F.col("_source_file") == F.col("name"))
        return settled(both.select("id", "_source_file", "_batch_id", (F.col("_file_hash") == F.col("digest")).alias("hash_is_right")))


@R.add("stream_records", f"{ODD} SELECT id, labels, rescued, _source_file, true AS no_hash FROM odd")
def stream_records(spark, d):
    """The same records arriving by a stream, with rescue column and lineage; files of one name come from several folders."""
    with workspace(spark) as path:
        put_odd_labels(spark, d, f"{path}/raw", parts=parts(spark, d), folders=True)
        landed = VersionedTable(spark, f"{path}/bronze")
        arrive(spark, f"{path}/raw/*", SOURCES[LABELS], LABELS_DDL, landed, f"{path}/progress", "b1")
        size = F.when(F.col("labelled_alternatives").isNotNull(), F.size("labelled_alternatives")).cast("long")
        return settled(landed.read().select("id", size.alias("labels"), why_rescued().alias("rescued"), "_source_file", F.col("_file_hash").isNull().alias("no_hash")))


@R.add("content_hash", "SELECT sha256(n_name) AS file_hash, CAST(octet_length(encode(n_name)) AS BIGINT) AS byte_size, 2 AS ways FROM nation")
def content_hash(spark, d):
    """The names of nations as files of their own, hashed by the scan and as streams."""
    names = [r["n_name"] for r in table(spark, d, "nation").select("n_name").collect()]
    with workspace(spark) as path:
        hadoop = spark._jvm.org.apache.hadoop.fs
        system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        paths = [f"{path}/{i}.txt" for i in range(len(names))]
        for place, name in zip(paths, names, strict=True):
            out = system.create(hadoop.Path(place), False)
            out.write(name.encode())
            out.close()
        scanned = files.content_hashes(spark, paths).select("file_hash", "byte_size")
        streamed = spark.createDataFrame([(files.stream_hash(spark, p),) for p in paths], "file_hash string")
        both = scanned.select("file_hash").union(streamed).groupBy("file_hash").agg(F.count(F.lit(1)).cast("int").alias("ways"))
        return settled(scanned.join(both, "file_hash"))


@R.add("group_count", f"{WITH} SELECT 'file_' || (conv_id % {FILES}) AS source_file, count(DISTINCT conv_id) AS \"rows\" FROM l GROUP BY 1")
def group_count(spark, d):
    """Landed rows by file, of one of two batches."""
    landed = in_bronze(landed_labels(spark, d))
    return files.rows_by_file(landed.unionByName(in_bronze(landed_labels(spark, d), "b2")), "b2")


def landings(spark, d):
    """Labels landed three times: all; the second file again with half of its scenarios; some of the first in a third file."""
    all_ = in_bronze(landed_labels(spark, d), "b1")
    half = in_bronze(landed_labels(spark, d).filter("file = 1 AND conv_id % 2 = 0"), "b2")
    moved = in_bronze(landed_labels(spark, d).filter("file = 0 AND conv_id % 5 = 0").withColumn("file", F.lit(9)), "b3")
    return all_.unionByName(half).unionByName(moved)


LANDED = f"{WITH.rstrip()}, s AS (SELECT DISTINCT conv_id, scenario_id AS id FROM l), landed AS (SELECT id, conv_id, 'file_' || (conv_id % {FILES}) AS f, 'b1' AS b FROM s UNION ALL SELECT id, conv_id, 'file_1', 'b2' FROM s WHERE conv_id % {FILES} = 1 AND conv_id % 2 = 0 UNION ALL SELECT id, conv_id, 'file_9', 'b3' FROM s WHERE conv_id % {FILES} = 0 AND conv_id % 5 = 0), newest AS (SELECT *, dense_rank() OVER (PARTITION BY f ORDER BY b DESC) AS r FROM landed), cur AS (SELECT *, dense_rank() OVER (PARTITION BY id ORDER BY b DESC, f DESC) AS k FROM newest WHERE r = 1)"


@R.add("latest_version_per_key", f"{LANDED} SELECT id, f AS _source_file, b AS _batch_id FROM cur WHERE k = 1")
def latest_version_per_key(spark, d):
    """The newest landing of each file, and of a scenario in several files the newest copy."""
    return unnest.current_rows(landings(spark, d)).select("id", "_source_file", "_batch_id")


@R.add("filter_isin", f"{LANDED} SELECT id, b AS _batch_id FROM landed WHERE f IN ('file_1', 'file_9')")
def filter_isin(spark, d):
    """Landed rows of some files."""
    names = spark.createDataFrame([("file_1",), ("file_9",)], "name string")
    return unnest.of_files(landings(spark, d), names).select("id", "_batch_id")


# ---- flattening


@R.add("project_struct_fields", f"{WITH} SELECT scenario_id, label_ordinal, id_prod, pref, conf, reason, 'file_' || (conv_id % {FILES}) AS _source_file, 'b1' AS _batch_id, {TYPE} AS source_type FROM l")
def project_struct_fields(spark, d):
    return flat(spark, d)[SILVER_LABELS]


@R.add("flatten_nested_struct", f"{WITH} SELECT scenario_id, alternative_ordinal, id_prod, {', '.join(f'round({v}, 9) AS {v}' for v in VALUES)} FROM f")
def flatten_nested_struct(spark, d):
    return flat(spark, d)[SILVER_FEATURES].select("scenario_id", "alternative_ordinal", "id_prod", *[F.round(v, 9).alias(v) for v in VALUES])


@R.add("posexplode_array", f"{WITH} SELECT scenario_id, alternative_ordinal AS stakeholder_ordinal, role AS stakeholder_preference FROM f")
def posexplode_array(spark, d):
    return flat(spark, d)[SILVER_STAKEHOLDER].select("scenario_id", "stakeholder_ordinal", "stakeholder_preference")


@R.add("posexplode_struct_array", f"{WITH} SELECT scenario_id, alternative_ordinal, id_prod, 'size_' || (n % 3) AS situation FROM f")
def posexplode_struct_array(spark, d):
    """Alternatives and situations exploded by position, side by side."""
    frames = flat(spark, d)
    a = frames[SILVER_FEATURES].select("scenario_id", "alternative_ordinal", "id_prod")
    s = frames[SILVER_SITUATION].select(F.col("scenario_id").alias("s"), "situation_ordinal", "situation")
    return a.join(s, (F.col("scenario_id") == F.col("s")) & (F.col("alternative_ordinal") == F.col("situation_ordinal"))).drop("s", "situation_ordinal")


# ---- join and gate


@R.add("joined_scenarios", f"{WITH.rstrip()}, s AS (SELECT scenario_id, array_to_string(list_sort(list(DISTINCT role)), '|') AS people, array_to_string(list_sort(list(DISTINCT 'size_' || (n % 3))), '|') AS places FROM f GROUP BY 1) SELECT j.scenario_id, id_prod, label_ordinal, alternative_ordinal, has_label, has_feature, {TYPE.replace('scenario_id', 'j.scenario_id')} AS source_type, people, places FROM joined j LEFT JOIN s ON j.scenario_id = s.scenario_id")
def joined(spark, d):
    f = flat(spark, d)
    rows = joined_scenarios(f[SILVER_LABELS], f[SILVER_FEATURES], f[SILVER_STAKEHOLDER], f[SILVER_SITUATION], CORRECTED)
    return rows.select("scenario_id", "id_prod", "label_ordinal", "alternative_ordinal", F.col("_has_label").alias("has_label"), F.col("_has_feature").alias("has_feature"), "source_type", joined_text("stakeholder_preferences").alias("people"), joined_text("situations").alias("places"))


@R.add("reasons_array", f"{WITH} SELECT scenario_id, id_prod, label_ordinal, array_to_string(r, '|') AS reasons FROM gated")
def reasons_array(spark, d):
    return gated(spark, d).select("scenario_id", "id_prod", "label_ordinal", joined_text(gate.REASONS).alias("reasons"))


@R.add("duplicate_rows_window", f"{WITH} SELECT scenario_id, id_prod, label_ordinal FROM gated WHERE list_contains(r, 'duplicate_scenario_product')")
def duplicate_rows_window(spark, d):
    return gated(spark, d).filter(F.array_contains(gate.REASONS, gate.DUPLICATE)).select("scenario_id", "id_prod", "label_ordinal")


@R.add("gate_passed", f"{WITH} SELECT scenario_id, id_prod, label_ordinal, alternative_ordinal, pref, conf, source_type, gwp FROM gated WHERE len(r) = 0")
def gate_passed(spark, d):
    return gate.split_on_gate(gated(spark, d))[0].select("scenario_id", "id_prod", "label_ordinal", "alternative_ordinal", "pref", "conf", "source_type", "gwp")


@R.add("gate_rejected", f"{WITH} SELECT scenario_id, id_prod, label_ordinal, alternative_ordinal, array_to_string(r, '|') AS reasons FROM gated WHERE len(r) > 0")
def gate_rejected(spark, d):
    return gate.split_on_gate(gated(spark, d))[1].select("scenario_id", "id_prod", "label_ordinal", "alternative_ordinal", joined_text(gate.REASONS).alias("reasons"))


@R.add("gold_flagship", f"{WITH} SELECT scenario_id, id_prod, label_ordinal, alternative_ordinal, source_type, pref, gwp, array_to_string(r, '|') AS reasons, CAST(len(r) AS BIGINT) AS n_reasons FROM gated")
def gold_flagship(spark, d):
    """Landed records flattened, joined, gated and given reasons."""
    return gated(spark, d).select("scenario_id", "id_prod", "label_ordinal", "alternative_ordinal", "source_type", "pref", "gwp", joined_text(gate.REASONS).alias("reasons"), F.size(gate.REASONS).cast("long").alias("n_reasons"))


@R.add("gate_summary", f"{WITH} SELECT reason, count(*) AS count FROM (SELECT unnest(r) AS reason FROM gated) GROUP BY 1")
def gate_summary(spark, d):
    return gate.gate_summary(gate.split_on_gate(gated(spark, d))[1])


@R.add("gate_fraction", f"{WITH} SELECT count(*) FILTER (len(r) = 0) AS passed_rows, count(*) FILTER (len(r) > 0) AS rejected_rows, CAST(0 AS BIGINT) AS unknown_rows, round(count(*) FILTER (len(r) > 0) / count(*), 6) AS rejected_share FROM gated")
def gate_fraction(spark, d):
    return gate.gate_counts(gated(spark, d)).withColumn("rejected_share", F.round("rejected_share", 6))


@R.add("gate_limits", f"{WITH} SELECT 'rejected_share' AS measure, round(count(*) FILTER (len(r) > 0) / count(*), 6) AS value, 0.01 AS most FROM gated HAVING count(*) FILTER (len(r) > 0) / count(*) > 0.01")
def gate_limits(spark, d):
    """The limits that the run is beyond."""
    return gate.beyond(gate.gate_counts(gated(spark, d)), LIMITS).withColumn("value", F.round("value", 6))


@R.add("topk_rejected", f"{WITH} SELECT scenario_id, id_prod, label_ordinal FROM gated WHERE len(r) > 0 ORDER BY scenario_id, id_prod, label_ordinal NULLS FIRST LIMIT 20")
def topk_rejected(spark, d):
    return gate.first_rejected(gate.split_on_gate(gated(spark, d))[1]).select("scenario_id", "id_prod", "label_ordinal")


@R.add("range_rules", f"{WITH} SELECT scenario_id, id_prod, {', '.join(f'{c} NOT BETWEEN {BOUNDS[c][0]} AND {BOUNDS[c][1]} AS {c}_out' for c in BOUNDS if c in MEASURES)} FROM f")
def range_rules(spark, d):
    return flat(spark, d)[SILVER_FEATURES].select("scenario_id", "id_prod", *[gate.outside(c, *BOUNDS[c]).alias(f"{c}_out") for c in BOUNDS if c in MEASURES])


@R.add("check_constraint_violations", f"{WITH.rstrip()}, g AS (SELECT *, label_ordinal IS NOT NULL AND alternative_ordinal IS NOT NULL AS o FROM gated) SELECT 'pref_in_range' AS name, count(*) FILTER (NOT (pref IS NOT NULL AND pref BETWEEN 0 AND 1)) AS n FROM g UNION ALL SELECT 'conf_in_range', count(*) FILTER (NOT (conf IS NOT NULL AND conf BETWEEN 0 AND 1)) FROM g UNION ALL SELECT 'source_type_known', 0 UNION ALL SELECT 'ordinals_present', count(*) FILTER (NOT o) FROM g")
def check_constraint_violations(spark, d):
    """How often rows before the gate would break the checks of gold."""
    return violations(gated(spark, d), GOLD_CHECKS)


CORR = "round(covar_samp(pref, {v}) FILTER (pref IS NOT NULL AND {v} IS NOT NULL) / nullif(stddev_samp(pref) FILTER ({v} IS NOT NULL) * stddev_samp({v}) FILTER (pref IS NOT NULL), 0), 6) AS {v}"


@R.add("group_corr_by_axis", f"{WITH} SELECT regexp_extract(scenario_id, '^control_([a-z][a-z_]*[a-z])_\\d+$', 1) AS axis, count(*) AS \"rows\", {', '.join(CORR.format(v=v) for v in correlation.EXPECTED)} FROM gated WHERE source_type = 'control_synthetic' GROUP BY 1")
def group_corr_by_axis(spark, d):
    found = correlation.by_axis(gated(spark, d))
    return found.select("axis", "rows", *[F.round(v, 6).alias(v) for v in correlation.EXPECTED])


@R.add("topk_distinct", f"{WITH} SELECT DISTINCT scenario_id, 0.0 AS before, pref + 1 AS after FROM l WHERE label_ordinal = 0 AND pref + 1 <> 0 ORDER BY 1, 2, 3 LIMIT 10")
def topk_distinct(spark, d):
    """The first scenarios whose value differs between two snapshots."""
    new = flat(spark, d)[SILVER_LABELS].filter("label_ordinal = 0").withColumn("pref", F.col("pref") + 1)
    rows = diff.version_diff(new.withColumn("pref", F.lit(0.0)), new, ["scenario_id", "id_prod"], "pref")
    return diff.moved(rows, "scenario_id", 10)


# ---- whole builds


def put_raw(spark, d, folder, where="true", names=("labelled_alternatives", "frozen_dataset")):
    n = parts(spark, d)
    put_files(spark, landed_labels(spark, d).filter(where), folder, names[0], n)
    put_files(spark, landed_features(spark, d).filter(where), folder, names[1], n)


def unjudged(labels):
    """Records with judgements out of bounds."""
    return labels.withColumn("labelled_alternatives", F.transform("labelled_alternatives", lambda x: x.withField("pref", F.lit(2.0))))


STAGE = "SELECT '{stage}' AS stage, {skipped} AS skipped, {changed} AS changed, (SELECT count(*) FROM l WHERE {where}) AS labels, (SELECT count(*) FROM f WHERE {where}) AS features, (SELECT count(*) FROM gated WHERE len(r) = 0 AND {here}) AS gold, (SELECT count(*) FROM gated WHERE len(r) > 0 AND {here}) AS rejected"
HERE = "scenario_id IN (SELECT scenario_id FROM t WHERE {where})"
SOME, REST = f"conv_id % {FILES} <> 2", f"conv_id % {FILES} = 2"
BUILDS = " UNION ALL ".join([
    STAGE.format(stage="first", skipped="false", changed="CAST(NULL AS BIGINT)", where=SOME, here=HERE.format(where=SOME)),
    STAGE.format(stage="none", skipped="true", changed="CAST(0 AS BIGINT)", where=SOME, here=HERE.format(where=SOME)),
    STAGE.format(stage="next", skipped="false", changed=f"(SELECT count(DISTINCT conv_id) FROM t WHERE {REST} AND ({HAS_FEATURES} OR conv_id IN (SELECT conv_id FROM l)))", where="true", here="true"),
])


AGAIN = f"SELECT 'replaced', false, (SELECT count(DISTINCT conv_id) FROM l WHERE conv_id % {FILES} = 0), (SELECT count(*) FROM l), (SELECT count(*) FROM f), (SELECT count(*) FROM gated WHERE len(r) = 0 AND NOT (label_ordinal IS NOT NULL AND {HERE.format(where=f'conv_id % {FILES} = 0')})), (SELECT count(*) FROM gated WHERE len(r) > 0 OR (label_ordinal IS NOT NULL AND {HERE.format(where=f'conv_id % {FILES} = 0')}))"


@R.add("pipeline_stages", f"{WITH} {BUILDS} UNION ALL {AGAIN}")
def pipeline_stages(spark, d):
    """First load, nothing new, further files, and a file that is landed again with other values, as whole runs."""
    with workspace(spark) as path:
        config = PipelineConfig(raw_dir=f"{path}/raw", lakehouse_dir=f"{path}/lake").for_fixtures()
        found = []

        def run(stage):
            result = pipeline.run_pipeline(spark, config)
            ids = None if result.changed is None else result.changed.count()
            counts = result.counts()
            found.append((stage, result.skipped, ids, counts[SILVER_LABELS], counts[SILVER_FEATURES], counts[GOLD], counts[REJECTED]))

        put_raw(spark, d, config.raw_dir, SOME)
        run("first")
        run("none")
        put_raw(spark, d, config.raw_dir, REST)
        run("next")
        put_files(spark, unjudged(landed_labels(spark, d).filter("file = 0")), config.raw_dir, "labelled_alternatives", parts(spark, d))
        run("replaced")
        return settled(spark.createDataFrame(found, "stage string, skipped boolean, changed long, labels long, features long, gold long, rejected long"))


@R.add("version_diff_transitions", f"{WITH.rstrip()}, moved AS (SELECT DISTINCT scenario_id, id_prod, {TYPE} AS after, CASE WHEN regexp_matches(scenario_id, '^control_(archfinish|cost|density|fwu|gwp|health|wdp)_\\d+$') THEN 'control_synthetic' ELSE 'llm_generated' END AS before FROM gated WHERE len(r) = 0) SELECT before, after, count(*) AS \"rows\", count(DISTINCT scenario_id) AS \"groups\" FROM moved WHERE before <> after GROUP BY 1, 2")
def version_diff_transitions(spark, d):
    """Two whole builds, by the first guess of the classifier and by the right one, and what moved between their versions."""
    with workspace(spark) as path:
        config = PipelineConfig(raw_dir=f"{path}/raw", lakehouse_dir=f"{path}/lake").for_fixtures()
        put_raw(spark, d, config.raw_dir)
        return settled(versions.reclassify(spark, config).transitions)


@R.add("table_counts", f"{WITH} SELECT '{SILVER_LABELS}' AS name, count(*) AS n FROM l UNION ALL SELECT '{SILVER_FEATURES}', count(*) FROM f UNION ALL SELECT '{SILVER_STAKEHOLDER}', count(*) FROM f UNION ALL SELECT '{SILVER_SITUATION}', count(*) FROM f")
def table_counts(spark, d):
    return pipeline.counted({n: f for n, f in flat(spark, d).items() if n in SILVER_KEYS}).select("name", "n")
