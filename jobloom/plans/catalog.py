"""The whole catalogue. Importing the parts fills the registry."""

from __future__ import annotations

from pyspark.sql import SparkSession

from jobloom.plans import catalog_classify, catalog_feeds, catalog_graph, catalog_records  # noqa: F401
from jobloom.plans.registry import ORACLES, QUERIES


def queries():
    def in_utc(run):
        def call(spark: SparkSession, sf_dir: str):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        return call

    return {name: in_utc(run) for name, run in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
