"""Notices to the business table and the winners table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.text import cap, clean_html, fingerprint, word_content
from noticeloom.functions.values import DATE_COLUMNS, MONEY, amount_fallback, money, parse_times
from noticeloom.operators import notices as N
from noticeloom.operators.spans import gold_override, span_texts

CONTRACT_DROPS = ["winning_bidder", "amount", "contract_term", "agency", "bid_section_name"]


def load_notices(
    notices: DataFrame,
    origin: str,
    gold: DataFrame,
    with_spans: Callable[[DataFrame], DataFrame],
    as_of_year: int,
    text_limit: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Parent rows and, for bids, winner rows of one origin table.

    ``with_spans`` adds the ``label`` column to a frame with ``text``; ``gold`` holds (md5, label).
    ``text_limit`` cuts the texts that are annotated, and only if given; the md5 is the whole text's.
    A notice without spans keeps null label columns and gets its flag by the same rule as others.
    """
    _, task = N.route_of(origin)
    rows = notices.drop(*CONTRACT_DROPS) if task == "contract" else notices
    rows = rows.drop("update_time").withColumns(
        {"result_detail": word_content(F.col("detail_content")), "text": clean_html(F.col("detail_content"))}
    )
    rows = rows.withColumn("md5", fingerprint(F.col("text")))
    if text_limit is not None:
        rows = rows.withColumn("text", cap(F.col("text"), text_limit))
    rows = gold_override(with_spans(rows), gold, "md5", "label")
    rows = rows.withColumn("_labels", span_texts(F.col("text"), F.col("label")))
    cleaned = N.apply_units(N.clean_labels(F.col("_labels"), task, as_of_year))
    rows = rows.withColumn("_values", N.label_map(cleaned, F.lit(task == "bid")))

    source = N.MONEY_COLUMN.get(task)
    raw = F.col(source).cast("string") if source else F.lit("")
    rows = rows.withColumn("_money", money(F.coalesce(raw, F.lit(""))))
    winners = N.winner_rows(rows, origin, "_values", "_money") if task == "bid" else None

    parents = N.widen(rows, task, "_values")
    if source:
        extracted = F.col(source).try_cast("decimal(24,6)")
        parents = parents.withColumn(source, amount_fallback(F.col("_money"), extracted).cast(MONEY))
    if task == "bid":
        parents = parents.withColumn("winning_bidder", N.winners_text(F.col("_labels")))
    if origin in N.FLAGGED_TABLES:
        names = F.transform("_labels", lambda x: x["label"])
        parents = parents.withColumn("is_full_data", N.is_full(task, names))
    as_json = F.to_json(F.transform("_labels", lambda x: F.create_map(x["label"], x["value"])))
    parents = parents.withColumn("labels", as_json).drop(
        "_labels", "_values", "_money", "label", "md5", "text", "detail_content"
    )
    return parse_times(parents, DATE_COLUMNS[task]), winners
