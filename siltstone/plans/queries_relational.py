"""Queries without tables of our own: ids, joins, aggregates, statistics, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import correlation, provenance
from siltstone.operators import diff, gate, join, profile
from siltstone.plans.registry import Register, table
from siltstone.sources.files import empty_log, pending
from siltstone.store.table import match

R = Register()
QUERIES, ORACLES = R.queries, R.oracles


# ---- ids

IDS = """
ids AS (SELECT CASE event_id % 5 WHEN 0 THEN 'control_' || event_type || '_slump_' || event_id WHEN 1 THEN 'expert_' || event_id WHEN 2 THEN CAST(event_id AS VARCHAR)
  WHEN 3 THEN '  control_gwp_' || event_id || ' ' ELSE 'weird-' || event_id END AS id, event_id FROM events)"""
CLASS_SQL = r"CASE WHEN regexp_matches(trim(id), '^control_[a-z][a-z_]*[a-z]_\d+$') THEN 'control_synthetic' WHEN regexp_matches(trim(id), '^expert_\d+$') THEN 'expert_annotated' WHEN regexp_matches(trim(id), '^\d+$') THEN 'llm_generated' ELSE 'unknown' END"


def ids(spark, d):
    """Ids of every family, made from events."""
    n = F.col("event_id").cast("string")
    kind = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("control_"), "event_type", F.lit("_slump_"), n)).when(F.col("event_id") % 5 == 1, F.concat(F.lit("expert_"), n)).when(F.col("event_id") % 5 == 2, n)
    kind = kind.when(F.col("event_id") % 5 == 3, F.concat(F.lit("  control_gwp_"), n, F.lit(" "))).otherwise(F.concat(F.lit("weird-"), n))
    return table(spark, d, "events").select(kind.alias("id"), "event_id")


@R.add("classify_ids", f"WITH {IDS} SELECT {CLASS_SQL} AS source_type, count(*) AS n FROM ids GROUP BY 1")
def classify_ids(spark, d):
    return ids(spark, d).withColumn("source_type", provenance.CORRECTED("id")).groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))


@R.add("classify_ids_naive", rf"WITH {IDS} SELECT CASE WHEN regexp_matches(trim(id), '^control_(archfinish|cost|density|fwu|gwp|health|wdp)_\d+$') THEN 'control_synthetic' ELSE 'llm_generated' END AS source_type, count(*) AS n FROM ids GROUP BY 1")
def classify_ids_naive(spark, d):
    return ids(spark, d).withColumn("source_type", provenance.TAXONOMIES["naive"]("id")).groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))


@R.add("regexp_axis", rf"WITH {IDS} SELECT regexp_extract(trim(id), '^control_([a-z][a-z_]*[a-z])_\d+$', 1) AS axis, count(*) AS n FROM ids GROUP BY 1")
def regexp_axis(spark, d):
    return ids(spark, d).groupBy(provenance.axis_column("id").alias("axis")).agg(F.count(F.lit(1)).alias("n"))


def shifted_labels(spark, d):
    """Labels with ids five up, so that either side of a join has rows without a partner."""
    return table(spark, d, "labels").withColumn("doc_id", F.col("doc_id") + 5)



@R.add("full_outer_presence", "SELECT coalesce(l.doc_id, d.doc_id) AS doc_id, l.doc_id IS NOT NULL AS has_label, d.doc_id IS NOT NULL AS has_document, coalesce(lang, 'unknown') AS lang FROM (SELECT doc_id + 5 AS doc_id FROM labels) l FULL JOIN documents d ON l.doc_id = d.doc_id")
def full_outer_presence(spark, d):
    left, right = shifted_labels(spark, d).select("doc_id"), table(spark, d, "documents").select("doc_id", "lang")
    return join.presence_join(left, right, ["doc_id"], "has_label", "has_document").withColumn("lang", F.coalesce("lang", F.lit("unknown")))


@R.add("null_safe_key_match", "SELECT a.c_custkey, b.s_suppkey FROM (SELECT c_custkey, nullif(c_nationkey, 3) AS k FROM customer) a JOIN (SELECT s_suppkey, nullif(s_nationkey, 3) AS k FROM supplier) b ON a.k IS NOT DISTINCT FROM b.k")
def null_safe_key_match(spark, d):
    a = table(spark, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("a"))
    b = table(spark, d, "supplier").select("s_suppkey", F.nullif("s_nationkey", F.lit(3)).alias("b"))
    return a.join(b, match([a["a"]], [b["b"]])).select("c_custkey", "s_suppkey")


@R.add("scope_semi_join", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def scope_semi_join(spark, d):
    scope = table(spark, d, "orders").filter("o_totalprice > 100000").select("o_custkey")
    return join.in_scope(table(spark, d, "customer").select("c_custkey", "c_name"), scope, "c_custkey")


@R.add("pending_anti_join", "SELECT c_name AS source_file, CAST(c_nationkey AS VARCHAR) AS file_hash FROM customer c WHERE NOT EXISTS (SELECT 1 FROM (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) o WHERE o.n = 1 AND o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O')")
def pending_anti_join(spark, d):
    """Customers as files; the last order of a customer tells whether the file's content was ingested."""
    present = table(spark, d, "customer").select(F.col("c_name").alias("source_file"), F.col("c_nationkey").cast("string").alias("file_hash"), "c_custkey")
    orders = table(spark, d, "orders").join(present, F.col("o_custkey") == F.col("c_custkey"))
    log = orders.select("source_file", F.when(F.col("o_orderstatus") == "O", F.col("file_hash")).otherwise("other").alias("file_hash"), F.col("o_orderkey").alias("batch_id"), F.lit(0).alias("ingested_at"))
    return pending(present.select("source_file", "file_hash"), log)


SETS = "sets AS (SELECT coalesce(l.source, r.source) AS source, l.s AS a, r.s AS b FROM (SELECT source, list_sort(list(DISTINCT doc_id)) AS s FROM labelled GROUP BY 1) l FULL JOIN (SELECT source, list_sort(list(DISTINCT doc_id)) AS s FROM documents WHERE n_chars > 300 GROUP BY 1) r ON l.source = r.source)"


@R.add("product_set_mismatch", f"WITH labelled AS (SELECT d.source, d.doc_id FROM documents d JOIN labels USING (doc_id)), {SETS} SELECT source, array_to_string(a, '|') AS label_products, array_to_string(b, '|') AS feature_products, coalesce(a = b, false) AS products_match FROM sets")
def product_set_mismatch(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id", "n_chars")
    labelled = docs.join(table(spark, d, "labels").select("doc_id"), "doc_id")
    sets = gate.product_sets(labelled, docs.filter("n_chars > 300"), "source", "doc_id")
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "|").alias(c)
    return sets.select("source", text("label_products"), text("feature_products"), "products_match")


@R.add("rollup_arrays_left_join", "SELECT c_custkey, array_to_string(t, '|') AS types FROM customer LEFT JOIN (SELECT user_id, list_sort(list(DISTINCT event_type)) AS t FROM events WHERE event_type IS NOT NULL GROUP BY 1) e ON c_custkey = user_id")
def rollup_arrays_left_join(spark, d):
    types = join.rolled_up(table(spark, d, "events"), "user_id", "event_type", "t")
    return table(spark, d, "customer").join(types, F.col("c_custkey") == F.col("user_id"), "left").select("c_custkey", F.array_join("t", "|").alias("types"))


# ---- aggregates and windows


@R.add("source_mix", 'SELECT event_type, count(*) AS "rows", count(DISTINCT user_id) AS "groups" FROM events GROUP BY 1')
def source_mix(spark, d):
    return diff.source_mix(table(spark, d, "events"), "event_type", "user_id")


CORR = "covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)"
PRICE, TAX = CORR.format(a="l_quantity", b="l_extendedprice"), CORR.format(a="l_quantity", b="l_tax")


@R.add("group_corr", f"SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag, count(*) AS n, round({PRICE}, 6) AS price, round({TAX}, 6) AS tax FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())")
def group_corr(spark, d):
    found = correlation.grouped(table(spark, d, "lineitem"), "l_returnflag", "l_quantity", ["l_extendedprice", "l_tax"])
    return found.select("l_returnflag", F.col("rows").alias("n"), F.round("l_extendedprice", 6).alias("price"), F.round("l_tax", 6).alias("tax"))


@R.add("safe_corr_zero_variance", f"SELECT l_linestatus, {CORR.format(a='l_quantity', b='k')} AS flat, round({CORR.format(a='l_quantity', b='l_discount')}, 6) AS discount FROM (SELECT *, 1.0 AS k FROM lineitem) GROUP BY 1")
def safe_corr_zero_variance(spark, d):
    rows = table(spark, d, "lineitem").withColumn("k", F.lit(1.0))
    return rows.groupBy("l_linestatus").agg(correlation.safe_corr("l_quantity", "k").alias("flat"), F.round(correlation.safe_corr("l_quantity", "l_discount"), 6).alias("discount"))


@R.add("correlation_verdicts", f"SELECT g AS source_type, n, CASE WHEN c IS NULL THEN 'NO DATA' WHEN n < 30 THEN 'TOO FEW' WHEN abs(c) < 0.05 THEN 'FLAT' WHEN c > 0 THEN 'OK' ELSE 'WRONG SIGN' END AS verdict, CASE WHEN c IS NULL THEN 'NO DATA' WHEN n < 30 THEN 'TOO FEW' WHEN abs(c) < 0.05 THEN 'FLAT' WHEN c < 0 THEN 'OK' ELSE 'WRONG SIGN' END AS reverse FROM (SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS g, count(*) AS n, {PRICE} AS c FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ()))")
def correlation_verdicts(spark, d):
    found = correlation.grouped(table(spark, d, "lineitem"), "l_returnflag", "l_quantity", ["l_extendedprice"])
    c, n = F.col("l_extendedprice"), F.col("rows")
    return found.select(F.col("l_returnflag").alias("source_type"), n.alias("n"), correlation.verdict_column(c, n, "positive").alias("verdict"), correlation.verdict_column(c, n, "negative").alias("reverse"))


# ---- gate


# ---- profile


@R.add("profile_lengths", "SELECT count(*) AS count, min(n) AS min, max(n) AS max, round(avg(n), 3) AS mean FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id)")
def profile_lengths(spark, d):
    packed = table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    return profile.length_stats(packed, F.col("n"))


@R.add("profile_length_histogram", "SELECT n AS size, count(*) AS \"rows\" FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id) GROUP BY 1")
def profile_length_histogram(spark, d):
    packed = table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    return profile.length_histogram(packed, F.col("n"))


COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@R.add("profile_numeric_ranges", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS present, round(min({c}) + 0.0, 4) AS min, round(max({c}) + 0.0, 4) AS max, round(avg({c}), 4) AS mean FROM lineitem" for c in COLUMNS))
def profile_numeric_ranges(spark, d):
    return profile.numeric_ranges(table(spark, d, "lineitem"), COLUMNS)


@R.add("profile_duplicates", "SELECT l_orderkey, count(*) AS \"rows\" FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 20")
def profile_duplicates(spark, d):
    return profile.duplicates(table(spark, d, "lineitem"), "l_orderkey", 20)


@R.add("profile_key_presence", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS present FROM labels" for c in ("doc_id", "quality", "toxic")))
def profile_key_presence(spark, d):
    return profile.key_presence(table(spark, d, "labels"))


@R.add("profile_id_taxonomy", rf"WITH {IDS} SELECT regexp_replace(id, '\d+', '<n>', 'g') AS pattern, CASE WHEN regexp_matches(split_part(id, '_', 1), '^\d+$') THEN '<numeric>' ELSE split_part(id, '_', 1) END AS prefix, count(*) AS n, min(id) AS example FROM ids GROUP BY 1, 2")
def profile_id_taxonomy(spark, d):
    return profile.id_taxonomy(ids(spark, d), "id").withColumnRenamed("rows", "n")


@R.add("profile_cross_file", "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'left_only' WHEN a.doc_id IS NULL THEN 'right_only' ELSE 'both' END AS side, coalesce(a.s = b.s, false) AS same_items FROM (SELECT doc_id + 5 AS doc_id, list_sort(list(DISTINCT toxic)) AS s FROM labels GROUP BY 1) a FULL JOIN (SELECT doc_id, list_sort(list(DISTINCT CAST(n_chars > 1000 AS INTEGER))) AS s FROM documents GROUP BY 1) b ON a.doc_id = b.doc_id")
def profile_cross_file(spark, d):
    left = shifted_labels(spark, d).select("doc_id", F.col("toxic").alias("item"))
    right = table(spark, d, "documents").select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("item"))
    return profile.cross_file(left, right, "doc_id", "item")


@R.add("empty_typed_relation", "SELECT '' AS source_file, '' AS file_hash, '' AS source_kind, CAST(0 AS BIGINT) AS byte_size, CAST(0 AS BIGINT) AS row_count, '' AS batch_id, TIMESTAMP '2000-01-01' AS ingested_at WHERE false")
def empty_typed_relation(spark, d):
    return empty_log(spark)
