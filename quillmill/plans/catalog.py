"""Registry of the named queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill.plans import authoring, flows, items, more, patching, records, records_chain, relational, repairs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return relational.QUERIES | items.QUERIES | more.QUERIES | authoring.QUERIES | flows.QUERIES | records.QUERIES | records_chain.QUERIES | repairs.QUERIES | patching.QUERIES


def oracle_sql() -> dict[str, str]:
    return relational.ORACLES | items.ORACLES | more.ORACLES | authoring.ORACLES | flows.ORACLES | records.ORACLES | records_chain.ORACLES | repairs.ORACLES | patching.ORACLES
