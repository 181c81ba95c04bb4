"""The incremental build: land what is new, flatten it, find what moved, gate it, merge it.

Gold notes which silver versions it has seen. A run that died half-way, or silver that was changed by hand, is therefore
caught up with by the next run, and only a run with nothing new anywhere is skipped. Limits are checked on the staged
rows before gold is committed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.config import FEATURES, LABELS, SOURCES, PipelineConfig
from siltstone.functions.provenance import CORRECTED, Classifier
from siltstone.operators import gate, unnest
from siltstone.operators.diff import source_mix
from siltstone.operators.join import in_scope, joined_scenarios
from siltstone.plans.layout import open_table
from siltstone.schema import BRONZE_FEATURES, BRONZE_LABELS, BRONZE_LOG, FEATURES_DDL, GOLD, GOLD_CHECKS, GOLD_COLUMNS, GOLD_KEYS, LABELS_DDL, LINEAGE, REJECTED, SILVER_FEATURES, SILVER_KEYS, SILVER_LABELS, SILVER_SITUATION, SILVER_STAKEHOLDER
from siltstone.sources import files
from siltstone.sources.json_scan import checked, read_sources
from siltstone.store.table import AFTER, BEFORE, DELETE, INSERT, VersionGone, VersionedTable
from siltstone.streaming.ingest import arrive

CONSUMED = "consumed_silver_versions"
#: Staged rows of a gated run, in the lakehouse, from which both outputs are read, and the scenarios that changed.
STAGED, STAGED_SCOPE = "_staged_gold", "_staged_scope"
LANDING = {LABELS: (BRONZE_LABELS, LABELS_DDL), FEATURES: (BRONZE_FEATURES, FEATURES_DDL)}


@dataclass
class PipelineResult:
    """What a run did; ``changed`` is a frame of scenario ids, or None for a whole build."""

    spark: SparkSession
    config: PipelineConfig
    batch_id: str
    ingested: list[files.RawFile] = field(default_factory=list)
    changed: DataFrame | None = None
    skipped: bool = False
    gate: dict[str, float] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return open_table(self.spark, self.config, name).read()

    def changed_ids(self) -> list[str] | None:
        """The changed scenarios on the driver, for reports on small runs."""
        return None if self.changed is None else sorted(r[0] for r in self.changed.collect())

    def counts(self) -> dict[str, int]:
        tables = {n: open_table(self.spark, self.config, n) for n in (BRONZE_LABELS, BRONZE_FEATURES, *SILVER_KEYS, GOLD, REJECTED)}
        found = counted({n: t.read() for n, t in tables.items() if t.exists()})
        return {r["name"]: r["n"] for r in found.orderBy("place").collect()}


def counted(frames: dict[str, DataFrame]) -> DataFrame:
    """(place, name, n) of some frames, in one job."""
    ones = [f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("place"), F.lit(name).alias("name"), "n") for i, (name, f) in enumerate(frames.items())]
    return reduce(DataFrame.unionByName, ones)


def _table(spark: SparkSession, config: PipelineConfig, name: str) -> VersionedTable:
    return open_table(spark, config, name)


def ingest(spark: SparkSession, config: PipelineConfig, batch_id: str) -> list[files.RawFile]:
    """Land the files that are new or replaced. Rows are appended before the log, so a crash reads a file again.

    With a checkpoint folder, files with new names arrive by a stream, and what it has not brought, by content.
    """
    log = _table(spark, config, BRONZE_LOG)
    seen = log.read() if log.exists() else files.empty_log(spark)
    todo = files.not_ingested(spark, files.describe(spark, config), seen)
    counts: dict[str, int] = {}
    for kind, (name, schema) in LANDING.items():
        mine = [f for f in todo if f.kind == kind]
        landed = _table(spark, config, name)
        if mine and config.checkpoint_dir:
            arrive(spark, str(config.raw_dir), SOURCES[kind], schema, landed, f"{config.checkpoint_dir}/{kind}", batch_id)
            counts |= _counts(landed, batch_id)
            mine = [f for f in mine if f.name not in counts]
        rows = read_sources(spark, mine, schema, batch_id)
        if rows is not None:
            landed.append(rows, checked)
            counts |= _counts(landed, batch_id)
    if todo:
        log.append(files.log_rows(spark, todo, batch_id, counts))
    return todo


def _counts(landed: VersionedTable, batch_id: str) -> dict[str, int]:
    if not landed.exists():
        return {}
    return {r["source_file"]: r["rows"] for r in files.rows_by_file(landed.read(), batch_id).collect()}


def build_silver(spark: SparkSession, config: PipelineConfig, classifier: Classifier, only: list[files.RawFile] | None) -> None:
    """Flatten the current rows (of the files in ``only``, if given) into the silver tables, each by its own scope.

    Scenarios without an id are left in bronze.
    """
    landed = {n: unnest.current_rows(_table(spark, config, n).read().filter("id IS NOT NULL")) for n in (BRONZE_LABELS, BRONZE_FEATURES)}
    if only is not None:
        names = spark.createDataFrame([(f.name,) for f in only], "name string")
        landed = {n: unnest.of_files(df, names) for n, df in landed.items()}
    origin = {SILVER_LABELS: BRONZE_LABELS}
    for name, rows in unnest.silver(landed[BRONZE_LABELS], landed[BRONZE_FEATURES], classifier).items():
        table = _table(spark, config, name)
        if only is None or not table.exists():
            table.overwrite(rows)
        else:
            # The scope is what was landed, so that a scenario whose array is empty now loses its rows.
            scope = landed[origin.get(name, BRONZE_FEATURES)].select(F.col("id").alias("scenario_id"))
            table.merge_scoped(rows, SILVER_KEYS[name], scope)


def silver_versions(spark: SparkSession, config: PipelineConfig) -> dict[str, int]:
    tables = {n: _table(spark, config, n) for n in SILVER_KEYS}
    return {n: t.latest() for n, t in tables.items() if t.exists()}


def changed_scenarios(spark: SparkSession, config: PipelineConfig, since: dict[str, int] | None) -> DataFrame | None:
    """Ids of scenarios that differ from the silver versions ``since``; None if that can't be told."""
    if since is None or set(since) != set(SILVER_KEYS):
        return None
    found = None
    for name, keys in SILVER_KEYS.items():
        table = _table(spark, config, name)
        try:
            rows = table.changes(since[name], table.latest(), keys)
        except VersionGone:
            return None
        if not config.lineage_counts_as_change:
            # A change of lineage alone has equal rows before and after.
            values = [c for c in rows.columns if c not in (*LINEAGE, "_change_type")]
            rows = rows.groupBy(*values).agg(F.count(F.lit(1)).alias("_n"), F.max("_change_type").alias("_t")).filter("_n = 1")
            # What is left of an update may be its row before alone: either way its scenario has changed.
            rows = rows.withColumn("_change_type", F.when(F.col("_t") == BEFORE, AFTER).otherwise(F.col("_t")))
        ids = changed_keys(rows, "scenario_id")
        found = ids if found is None else found.union(ids)
    return found.distinct()


def changed_keys(changes: DataFrame, key: str) -> DataFrame:
    """The distinct keys that rows of a change feed have after a change, or had before they went."""
    return changes.filter(F.col("_change_type").isin(INSERT, AFTER, DELETE)).select(key).distinct()


def gated(frames: dict[str, DataFrame], config: PipelineConfig, classifier: Classifier) -> DataFrame:
    """Joined and gated rows of the four flat frames, with their reasons."""
    joined = joined_scenarios(frames[SILVER_LABELS], frames[SILVER_FEATURES], frames[SILVER_STAKEHOLDER], frames[SILVER_SITUATION], classifier)
    sets = gate.product_sets(frames[SILVER_LABELS], frames[SILVER_FEATURES])
    return gate.with_reasons(joined, sets, config.thresholds).select(*GOLD_COLUMNS, gate.REASONS)


def build_gold(spark: SparkSession, config: PipelineConfig, classifier: Classifier, scope: DataFrame | None, seen: dict[str, int]) -> dict[str, float]:
    """Stage, check limits, then commit rejected and passed rows; gold notes the silver versions in the same commit chain."""
    staged = VersionedTable(spark, config.under(STAGED))
    # Inputs are cut to the scope, which the optimizer can't do below a full join.
    inputs = {n: in_scope(_table(spark, config, n).read(), scope, "scenario_id") for n in SILVER_KEYS}
    staged.overwrite(gated(inputs, config, classifier))
    rows = staged.read()
    counts = gate.enforce(gate.gate_counts(rows), config.limits)
    passed, rejected = gate.split_on_gate(rows)
    for name, part in ((REJECTED, rejected), (GOLD, passed)):
        table = _table(spark, config, name)
        if scope is None or not table.exists():
            table.overwrite(part)
        else:
            # Rejected rows may repeat a key: their scope is replaced.
            table.merge_scoped(part, GOLD_KEYS, scope)
    gold = _table(spark, config, GOLD)
    gold.add_constraints(GOLD_CHECKS)
    gold.set_properties(**{CONSUMED: json.dumps(seen)})
    return counts


def run_pipeline(spark: SparkSession, config: PipelineConfig | None = None, classifier: Classifier = CORRECTED, full_refresh: bool = False) -> PipelineResult:
    config = config or PipelineConfig()
    result = PipelineResult(spark, config, files.new_batch_id())
    result.ingested = ingest(spark, config, result.batch_id)
    gold = _table(spark, config, GOLD)
    before = json.loads(gold.properties().get(CONSUMED, "null")) if gold.exists() else None
    missing = set(SILVER_KEYS) - set(silver_versions(spark, config))
    if full_refresh or missing:
        build_silver(spark, config, classifier, None)
    elif result.ingested or _behind(spark, config):
        build_silver(spark, config, classifier, _unflattened(spark, config))
    _note_flattened(spark, config)
    now = silver_versions(spark, config)
    if before == now and not full_refresh:
        result.skipped, result.changed = True, spark.createDataFrame([], "scenario_id string")
        return result
    scope = None if full_refresh else changed_scenarios(spark, config, before)
    if scope is not None:
        # Written once: the inputs and both merges read it.
        staged = VersionedTable(spark, config.under(STAGED_SCOPE))
        staged.overwrite(scope)
        scope = staged.read()
    result.gate = build_gold(spark, config, classifier, scope, now)
    result.changed = scope
    return result


def _behind(spark: SparkSession, config: PipelineConfig) -> bool:
    """Whether files were logged that silver has not taken in: a run died between the two."""
    return bool(_unflattened(spark, config))


def _unflattened(spark: SparkSession, config: PipelineConfig) -> list[files.RawFile]:
    mark = _table(spark, config, SILVER_LABELS).properties().get("flattened_batch", "")
    rows = _table(spark, config, BRONZE_LOG).read().filter(F.col("batch_id") > mark).collect()
    names = {r["source_file"]: r for r in rows}
    return [files.RawFile(r["source_kind"], f"{config.raw_dir}/{n}", r["file_hash"], r["byte_size"]) for n, r in sorted(names.items())]


def _note_flattened(spark: SparkSession, config: PipelineConfig) -> None:
    """Silver's labels table remembers the last batch it has taken in."""
    last = _table(spark, config, BRONZE_LOG).read().agg(F.max("batch_id")).first()[0] or ""
    table = _table(spark, config, SILVER_LABELS)
    if table.properties().get("flattened_batch") != last:
        table.set_properties(flattened_batch=last)


def run_report(result: PipelineResult, top: int = 20) -> str:
    """Batch, files, scenarios, counts, reasons, first rejected rows and mix, as text."""
    ids = result.changed_ids()
    lines = [f"batch {result.batch_id}", f"files ingested: {', '.join(s.name for s in result.ingested) or 'none'}"]
    lines.append("nothing new: skipped" if result.skipped else f"scenarios rebuilt: {'all' if ids is None else len(ids)}")
    lines += [f"  {n:<30}{c:>12,}" for n, c in result.counts().items()]
    rejected, gold = result.table(REJECTED), result.table(GOLD)
    lines += ["rejections:"] + [f"  {r['reason']:<40}{r['count']:>8}" for r in gate.gate_summary(rejected).collect()]
    lines += [f"  {r['scenario_id']}/{r['id_prod']}: {', '.join(r[gate.REASONS])}" for r in gate.first_rejected(rejected, top).collect()]
    lines += ["mix:"] + [f"  {r['source_type']:<24}{r['rows']:>10}{r['groups']:>10}" for r in source_mix(gold, "source_type", "scenario_id").collect()]
    return "\n".join(lines)


def print_run_report(result: PipelineResult) -> None:
    print(run_report(result))
