"""Annotators: span prediction over Arrow batches with a pluggable model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import SPAN_TYPE, empty
from noticeloom.operators.terms import term_hits

Spans = list[tuple[int, int, str]]
Annotator = Callable[[list[str]], list[Spans]]


def annotate(df: DataFrame, make: Callable[[], Annotator], text: str = "text", label: str = "label") -> DataFrame:
    """Texts to spans by a model.

    ``make`` runs once per task and returns a function from a list of texts to a list of span lists;
    only the text column is held by pandas per Arrow batch, and rows keep their partitions.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for batch in batches:
            found = model([t or "" for t in batch])
            yield pd.Series([[{"start": s, "end": e, "label": n} for s, e, n in spans] for spans in found])

    predict = F.pandas_udf(run, SPAN_TYPE)  # type: ignore[call-overload]
    return df.withColumn(label, predict(F.col(text)))


def term_matcher(terms: list[tuple[str, str]]) -> Callable[[], Annotator]:
    """Annotator that finds every occurrence of (label, term) pairs in one pass over the text.

    Occurrences of one term do not overlap each other, those of different terms may.
    """

    def make() -> Annotator:
        if not terms:
            return lambda texts: [[] for _ in texts]
        labels: dict[str, list[str]] = {}
        for label, term in terms:
            labels.setdefault(term, []).append(label)
        automaton = ahocorasick.Automaton()
        for term in labels:
            automaton.add_word(term, term)
        automaton.make_automaton()

        def by_automaton(texts: list[str]) -> list[Spans]:
            out = []
            for text in texts:
                free: dict[str, int] = {}
                spans = []
                for last, term in automaton.iter(text):
                    start = last + 1 - len(term)
                    if start >= free.get(term, 0):
                        free[term] = last + 1
                        spans.extend((start, last + 1, label) for label in labels[term])
                out.append(sorted(spans))
            return out

        return by_automaton

    return make


def annotate_with_terms(df: DataFrame, terms: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Spans of a (label, term) table of any size, on the rows of their texts.

    Occurrences are found by :func:`noticeloom.operators.terms.term_hits`, which carries no text; they come
    to the rows by the text's digest, so a row's spans depend on its text alone, whatever its id.
    """
    keyed = df.withColumn("_text_key", F.md5(text))
    hits = term_hits(keyed, terms, ["_text_key"], text)
    spans = hits.groupBy(F.col("_text_key").alias("_key")).agg(F.collect_set(F.struct("start", "end", "label")).alias("_spans"))
    joined = keyed.join(spans, F.col("_text_key") == F.col("_key"), "left")
    return joined.withColumn(label, F.coalesce(F.sort_array("_spans"), empty(SPAN_TYPE))).drop("_text_key", "_key", "_spans")
