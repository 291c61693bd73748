"""Registry of queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where the same result can be said in SQL."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over as many partitions as the session asks for; as they are read if it asks for none.

    ``noticeloom.read.partitions`` is for runs on tables of a single file, such as tests and the bench.
    Large tables are split by ``spark.sql.files.maxPartitionBytes`` and need no shuffle.
    """
    wanted = df.sparkSession.conf.get("noticeloom.read.partitions", None)
    return df.repartition(int(wanted)) if wanted else df
