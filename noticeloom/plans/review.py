"""Human against machine annotation, from corpora to review table and category splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.text import text_link
from noticeloom.operators.compare import comparison_report, with_review_flags
from noticeloom.operators.curate import category_splits, cats_by_error
from noticeloom.operators.spans import span_rows


def review_table(human: DataFrame, machine: DataFrame, meta: DataFrame, registry: DataFrame, task: str, base_url: str) -> DataFrame:
    """Comparison rows with links and the answers of earlier reviews.

    ``human`` and ``machine`` hold (md5, text, label); ``meta`` (md5, source, project_id);
    ``registry`` reviewed rows with fingerprints.
    """

    def rows(df: DataFrame) -> DataFrame:
        return span_rows(df, ["md5"]).withColumnRenamed("label_type", "label")

    report = comparison_report(rows(human), rows(machine), "md5").withColumn("task", F.lit(task))
    shown = F.coalesce(F.nullif("ai_label", F.lit("")), "human_label")
    report = report.join(meta, "md5", "left").withColumns(
        {
            "url": text_link(F.col("source"), shown),
            "document_url": F.concat(
                F.lit(base_url + "/projects/"), F.col("project_id").cast("string"), F.lit("/sequence-labeling?page=1&q="), F.col("md5")
            ),
        }
    )
    return with_review_flags(report.drop("source", "project_id"), registry, "checked_md5")


def review_categories(corpus: DataFrame, report: DataFrame, wrong_types: list[str], seed: str) -> DataFrame:
    """Documents marked needed by their errors, balanced and split."""
    return category_splits(cats_by_error(corpus, report, "md5", wrong_types), "md5", seed)
