"""Every operator as a query over the driver's tables, with SQL for the same rows."""

from __future__ import annotations

from siltstone.plans import queries_engine as engine
from siltstone.plans import queries_relational as relational
from siltstone.plans import queries_tables as tables

QUERIES = {**relational.QUERIES, **tables.QUERIES, **engine.QUERIES}
ORACLES = {**relational.ORACLES, **tables.ORACLES, **engine.ORACLES}
