"""Where each table of a lakehouse is, by what its rows are bucketed, and how it shows in Spark's catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.config import PipelineConfig
from siltstone.schema import BRONZE_FEATURES, BRONZE_LABELS, BRONZE_LOG, GOLD, REJECTED, SILVER_KEYS
from siltstone.store.table import VersionedTable

SCOPED = {*SILVER_KEYS, GOLD, REJECTED}
TABLES = (BRONZE_LABELS, BRONZE_FEATURES, BRONZE_LOG, *SILVER_KEYS, GOLD, REJECTED)


def open_table(spark: SparkSession, config: PipelineConfig, name: str) -> VersionedTable:
    return VersionedTable(spark, config.under(name), "scenario_id" if name in SCOPED else None, config.buckets, config.bucket_rows)


def publish(spark: SparkSession, config: PipelineConfig, schema: str) -> DataFrame:
    """Make a schema with a view of each table's current version; returns what the catalogue shows of it.

    A view is of one version; publish again after a build. Folders that a view names are kept as long as versions are.
    """
    quoted = lambda *names: ".".join(f"`{n.replace('`', '``')}`" for n in names)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")
    for name in TABLES:
        table = open_table(spark, config, name)
        if not table.exists():
            continue
        m = table.manifest()
        columns = ", ".join(quoted(c) for c in table.schema().names)
        parts = [f"SELECT {columns} FROM {quoted('parquet', f'{table.root}/{f["path"]}')}" for f in m["folders"]]
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(schema, name)} AS {' UNION ALL '.join(parts)}" if parts else f"CREATE OR REPLACE VIEW {quoted(schema, name)} AS SELECT * FROM VALUES (NULL) AS t(_none) WHERE false")
    return spark.sql(f"SHOW TABLES IN {quoted(schema)}")
