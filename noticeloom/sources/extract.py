"""Incremental pulls from source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.lookup import listed, unknown
from noticeloom.operators.ranking import number_wide


def pull_all(source: DataFrame, order: list[str]) -> DataFrame:
    return source.orderBy(*order)


def pull_new(source: DataFrame, target: DataFrame, time: str) -> DataFrame:
    """Rows newer than the newest of the target; an empty target takes all."""
    newest = target.agg(F.max(time)).scalar()
    return source.filter(newest.isNull() | (F.col(time) > newest))


def pull_missing(source: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key the target does not hold; a null key in the target hides nothing."""
    return unknown(source, target, key)


def in_batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Batch numbers of ``size`` rows in ``order`` (unique); the last batch may be short."""
    return number_wide(df, order, "_rn").withColumn("batch", F.floor((F.col("_rn") - 1) / size)).drop("_rn")


def write_batches(df: DataFrame, folder: str) -> None:
    """One folder of JSON lines per batch."""
    df.repartition("batch").write.partitionBy("batch").json(folder)


def pending_tags(tables: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Complete but untagged ids of (table, task, frame)."""
    parts = [
        df.filter(F.col("classify_type").isNull() & (F.col("is_full_data") == 1)).select(
            "id", F.lit(table).alias("table"), F.lit(task).alias("task")
        )
        for table, task, df in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_value_sample(df: DataFrame, column: str, used: DataFrame, order: str, n: int) -> DataFrame:
    """First ``n`` rows without a value in ``column`` whose md5 is in no dataset yet."""
    return unknown(df.filter(F.col(column).isNull()), used, "md5").orderBy(order).limit(n)


def rows_by_id(spark: SparkSession, df: DataFrame, ids: list, key: str = "id") -> DataFrame:
    """Rows of an id list, which travels as a frame instead of a literal of any length."""
    wanted = spark.createDataFrame([(i,) for i in ids], df.select(key).schema)
    return listed(df, wanted, key)


def select_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """SQL over the given frames by name."""
    return spark.sql(sql, **tables) if tables else spark.sql(sql)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A database table read in ``parts`` key ranges; needs the database's driver jar."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, **options)
        .load()
    )
