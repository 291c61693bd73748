"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.session import fresh_folder

SPACE = " \t\n\x0b\f\r"  # the bytes [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"
ROW = "__llm_row"


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and fixes the rows for later passes."""
    spark = df.sparkSession
    folder = fresh_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def with_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with a unique number per row, which also tells repeated rows and null ids apart."""
    return stored(df.withColumn(ROW, F.monotonically_increasing_id()), name)


def text_of(name: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))
