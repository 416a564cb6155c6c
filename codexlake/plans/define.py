"""Registration of a query beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Definitions(dict):
    """name to (function of (spark, sf_dir), SQL or None). golden holds those over rows given in the code: tests, no queries."""

    def __init__(self):
        super().__init__()
        self.golden = {}

    def example(self, sql: str):
        def put(run):
            self.golden[run.__name__] = (run, sql)
            return run

        return put

    def add(self, sql: str | None = None):
        def put(run):
            self[run.__name__] = (run, sql)
            return run

        return put
