"""Category tags for pending notices and their column update."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.text import clean_html, fingerprint
from noticeloom.operators.curate import best_category
from noticeloom.operators.lookup import listed


def tag_notices(pending: DataFrame, source: DataFrame, gold: DataFrame, with_cats: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(table, id, classify_type) of pending ids.

    ``pending`` and ``source`` carry (table, id); ``with_cats`` adds a category-to-score map ``cats``;
    ``gold`` holds (md5, classify_type) and wins where the text is known.
    """
    rows = source.filter(F.col("detail_content").isNotNull()).transform(listed, pending, ["table", "id"])
    rows = rows.withColumn("text", clean_html(F.col("detail_content"))).withColumn("md5", fingerprint(F.col("text")))
    known = gold.groupBy("md5").agg(F.max("classify_type").alias("_gold"))
    return (
        with_cats(rows)
        .join(known, "md5", "left")
        .select("table", "id", F.coalesce("_gold", best_category(F.col("cats"))).alias("classify_type"))
    )
