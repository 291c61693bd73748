"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in the tasks and sums them by (language, bucket); the matrix of
log-probabilities has ``buckets x languages`` numbers whatever the corpus holds, and only it is
broadcast. Scoring is a map over the texts without a shuffle: the n-grams of a batch are one array of
buckets, gathered from the matrix and summed per text.

The model may be fitted on a bounded sample: ``sample_rows`` rows of each language in hash order (a
documented limit of the fit; every text is scored, and whole).

Defined results: a null text or one without a letter gives ``und`` with score 0, as does a model
trained on nothing; equal texts get equal results; ties go to the language first in order; a very long
text is scored in slices of ``SLICE`` characters whose sums are added; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import columns_of

UNKNOWN = "und"
BUCKET_BITS = 16
ORDERS = (1, 2, 3)
SAMPLE_ROWS = 5000
SMOOTHING = 0.5
SLICE = 1 << 18
BATCH_CHARS = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _buckets(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each n the buckets of all n-grams of the code points."""
    gram = np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        gram = (gram[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(n)) * _MULTIPLIER
        if n in ORDERS:
            yield n, ((gram ^ (gram >> np.uint64(29))) * _MULTIPLIER >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)


def _slices(text: str) -> Iterator[tuple[str, int]]:
    """The text in slices that overlap by the longest n-gram less one, and how much each overlaps."""
    over = max(ORDERS) - 1
    for start in range(0, max(len(text) - over, 1), SLICE - over):
        yield text[start : start + SLICE], over if start else 0


def _seen(over: int, n: int) -> int:
    """How many n-grams a slice begins with that the slice before it has counted."""
    return max(over - n + 1, 0)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities (buckets x languages), and the log-priors as the last row.

    Rows with a null language or text are left out; the priors are those of all labelled rows.
    """
    labelled = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.lit("language")).alias("h"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    languages = sorted(sizes)
    place = {lang: i for i, lang in enumerate(languages)}
    # The hash as a number from 0 to 1 against each language's share.
    point = F.shiftrightunsigned("h", 11) / float(1 << 53)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample_rows / sizes[lang]))]) if languages else None
    matrix = np.zeros(((1 << BUCKET_BITS) + 1, len(languages)))
    if not languages:
        return [], matrix

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for piece, over in _slices(text):
                    for n, found in _buckets(_codes(piece)):
                        np.add.at(held[place[lang]], found[_seen(over, n) :], 1)
        where = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(where[0]), pa.array(where[1]), pa.array(held[where])], names=["lang", "bucket", "n"])

    sample = labelled.filter(point < F.element_at(share, F.col("lang"))).select("lang", "text")
    counts = sample.mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most buckets x languages rows
    matrix[found["bucket"], found["lang"]] = found["n"]
    matrix[:-1] = np.log(matrix[:-1] + SMOOTHING) - np.log((matrix[:-1] + SMOOTHING).sum(axis=0))
    total = sum(sizes.values())
    matrix[-1] = [np.log(sizes[lang] / total) for lang in languages]
    return languages, matrix


def score_batch(texts: list[str | None], languages: list[str], matrix: np.ndarray) -> tuple[list[str], list[float]]:
    """Language and its posterior for each text."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    pieces = [(i, p, over) for i, t in enumerate(texts) if languages and has_letter(t) for p, over in _slices(t)]
    sums = {i: matrix[-1].astype(np.float64) for i, _, _ in pieces}
    start = 0
    while start < len(pieces):
        end, held = start, 0
        while end < len(pieces) and held < BATCH_CHARS:
            held += len(pieces[end][1])
            end += 1
        codes = [_codes(p) for _, p, _ in pieces[start:end]]
        sizes = np.array([len(c) for c in codes])
        ends = np.cumsum(sizes)
        for n, found in _buckets(np.concatenate(codes)):
            # n-grams that cross into the next text are summed apart and left out
            bounds = np.stack([ends - sizes, np.maximum(ends - n + 1, ends - sizes)], axis=1)
            rows = matrix[found]
            for (i, _, over), (a, b) in zip(pieces[start:end], bounds.tolist()):
                a += _seen(over, n)
                if b > a:
                    sums[i] = sums[i] + rows[a:b].sum(axis=0, dtype=np.float64)
        start = end
    for i, logs in sums.items():
        odds = np.exp(logs - logs.max())
        best = int(np.argmax(logs))
        names[i], scores[i] = languages[best], float(odds[best] / odds.sum())
    return names, scores


def identify(df: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``df`` with the predicted language and its posterior; no shuffle. Names must be new to ``df``."""
    languages, matrix = model
    shared = df.sparkSession.sparkContext.broadcast((languages, matrix.astype(np.float32)))

    @F.pandas_udf("lang string, score double")
    def predict(texts):
        import pandas as pd

        names, scores = score_batch([None if t is None or t != t else t for t in texts], *shared.value)
        return pd.DataFrame({"lang": names, "score": scores})

    found = "__llm_language"
    return df.withColumn(found, predict(F.col(text_col))).withColumns({lang_name: F.col(f"{found}.lang"), score_name: F.col(f"{found}.score")}).drop(found)


def keep_known(df: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose language was told with a posterior of ``min_score``; the rest are rejected."""
    lang, score = "__llm_lang", "__llm_score"
    found = identify(df, model, text_col, lang, score)
    return found.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).select(columns_of(df))
