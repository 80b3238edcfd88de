"""The registered queries: a Spark job on the driver tables and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job under its function name."""

    def add(job: Job) -> Job:
        QUERIES[job.__name__] = job
        if sql is not None:
            ORACLES[job.__name__] = sql
        return job

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load() -> tuple[dict[str, Job], dict[str, str]]:
    from weftline.plans import catalog_landed, catalog_links, catalog_records, catalog_sources, catalog_vectors  # noqa: F401

    return QUERIES, ORACLES
