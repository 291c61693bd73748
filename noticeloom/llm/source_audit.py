"""How far the sources of each language differ in their words, by chunk factorization.

A task counts the white-space chunks of its documents and brings home one row per chunk and language: how
many documents hold it, their rows while they are fewer than ``least_docs``, and the occurrences by group
(language and source). Chunks meet over the cluster, each globally distinct chunk is cut into terms once, and
its terms are joined back to its counts. A term lies inside one chunk, since no white space is part of one.

Documents of a term are not the sum over its chunks ("Ship" and "ship," may stand in one document), so
they are bounded: at least the documents of the most frequent chunk, at most the sum. Only terms whose
bounds lie on both sides of ``least_docs`` need their documents told apart, and each of their chunks has
fewer than ``least_docs`` of them, whose rows are at hand. So no row per document and word is shuffled.

Sums over all kept terms for a pair of sources take the terms that both have from a join, and the others
from each source's histogram of counts, since a term with no occurrence has one and the same share.

Defined results: null text, language and source are empty strings; each row of the table is a document,
also where ids repeat; a group without terms has its pairs; a language with one source has no pairs;
where no term is kept all pairs have the value 0; an empty table gives an empty result; other columns are
not read. Counts are exact in 38 digits; shares are held in 64 bits. Groups are told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm.common import stored, text_of

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_DOCS = 10
TOP = 10
ONE = 1_000_000_000  # shares are in parts of this
HELD_WORDS = 3_000_000  # a task hands its counts on when it holds this many chunks, repeats counted
HELD_BYTES = 48 << 20
COUNTS = "lang string, chunk binary, docs long, rows array<long>, spread array<long>"


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of a sorted array begins, and its length."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(keys)])


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(values))


def counted(held: list[pa.RecordBatch], least_docs: int) -> pa.RecordBatch:
    """Counts over whole documents: a row per chunk and language, with pairs of group and occurrences in ``spread``."""
    table = pa.Table.from_batches(held)
    words = pc.ascii_split_whitespace(table["text"].combine_chunks().cast(pa.string(), safe=False))
    lengths, flat = pc.list_value_length(words).to_numpy(zero_copy_only=False), words.flatten()
    doc = np.repeat(np.arange(len(lengths)), lengths)
    some = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty piece
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[some]
    langs = table["lang"].combine_chunks().dictionary_encode()
    lang, group, row = langs.indices.to_numpy(zero_copy_only=False), table["gid"].to_numpy(), table["row"].to_numpy()

    pair = np.sort(doc[some] << 32 | code)
    at, n = _runs(pair)
    doc, code = pair[at] >> 32, pair[at] & 0xFFFFFFFF
    own = lang[doc].astype(np.int64) << 32 | code
    order = np.lexsort((group[doc], own))
    own, doc, n = own[order], doc[order], n[order]
    starts, docs = _runs(own)
    first = np.r_[True, (own[1:] != own[:-1]) | (group[doc][1:] != group[doc][:-1])] if len(own) else np.zeros(0, bool)
    by_group = np.flatnonzero(first)
    sums = np.add.reduceat(n, by_group) if len(by_group) else n
    groups = np.add.reduceat(first.astype(np.int64), starts) if len(starts) else docs
    spread = np.column_stack([group[doc[by_group]], sums]).astype(np.int64).reshape(-1)
    few = docs < least_docs
    columns = [
        langs.dictionary.take(pa.array(own[starts] >> 32)),
        coded.dictionary.take(pa.array(own[starts] & 0xFFFFFFFF)).cast(pa.binary()),
        pa.array(docs.astype(np.int64)),
        _lists(np.where(few, docs, 0), row[doc][np.repeat(few, docs)].astype(np.int64)),
        _lists(2 * groups, spread),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "docs", "rows", "spread"])


def chunk_counts(docs: DataFrame, least_docs: int) -> DataFrame:
    """Counts of each task: ``lang, chunk, docs, rows, spread``; ``docs`` has ``lang, gid, text, row``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, size = [], 0, 0
        for batch in batches:
            some = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)
            cuts, total = [0], 0
            for i, length in enumerate(some.tolist()):  # a batch of long texts is taken in parts
                total += length
                if total > HELD_BYTES // 2:
                    cuts.append(i + 1)
                    total = 0
            for start, stop in zip(cuts, [*cuts[1:], len(some)]):
                if stop == start:
                    continue
                held.append(batch.slice(start, stop - start))
                size += int(some[start:stop].sum())
                words += int(some[start:stop].sum()) // 5
                if words > HELD_WORDS or size > HELD_BYTES:
                    yield counted(held, least_docs)
                    held, words, size = [], 0, 0
        if held:
            yield counted(held, least_docs)

    return docs.mapInArrow(count, COUNTS)


def cut_chunks(partial: DataFrame, least_docs: int) -> DataFrame:
    """``lang, lang_docs, terms, rows, spread``: the tasks' counts with each chunk's terms.

    One row of a chunk and language holds the number of its documents, the others null; rows of documents
    are left where there are fewer than ``least_docs``. Everything about a chunk happens where its hash puts
    it, after one shuffle of the tasks' counts.
    """
    in_order = Window.partitionBy("chunk").orderBy("lang")
    by_chunk = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_lang = Window.partitionBy("chunk", "lang")
    terms = F.regexp_extract_all(F.translate(F.col("chunk").cast("string"), UPPER, LOWER), F.lit(TERM), F.lit(0))
    rows = partial.repartition("chunk").withColumns({"nth": F.row_number().over(in_order), "seen": F.sum("docs").over(by_lang)})
    rows = rows.withColumn("cut", F.when(F.col("nth") == 1, terms))
    # A chunk's first row has its terms; the first of a language is the one whose place is the language's least.
    rows = rows.withColumns({"terms": F.first("cut").over(by_chunk), "least": F.min("nth").over(by_lang)}).filter(F.size("terms") > 0)
    return rows.select(
        "lang", "terms", "spread", F.when(F.col("nth") == F.col("least"), F.col("seen")).alias("lang_docs"),
        F.when(F.col("seen") < least_docs, F.col("rows")).alias("rows"),
    )


def kept_terms(cut: DataFrame, least_docs: int) -> DataFrame:
    """``lang, term`` of the terms in at least ``least_docs`` documents of their language."""
    once = cut.filter(F.col("lang_docs").isNotNull()).select("lang", "lang_docs", F.explode(F.array_distinct("terms")).alias("term"))
    bounds = once.groupBy("lang", "term").agg(F.max("lang_docs").alias("low"), F.sum("lang_docs").alias("high"))
    bounds = stored(bounds.filter(F.col("high") >= least_docs), "audit-bounds")
    doubtful = bounds.filter(F.col("low") < least_docs).select("lang", "term")
    rare = cut.filter(F.col("rows").isNotNull()).select("lang", "rows", F.explode(F.array_distinct("terms")).alias("term"))
    seen = rare.join(doubtful, ["lang", "term"]).select("lang", "term", F.explode("rows").alias("row")).distinct()
    told = seen.groupBy("lang", "term").agg(F.count("*").alias("docs")).filter(F.col("docs") >= least_docs).select("lang", "term")
    return stored(bounds.filter(F.col("low") >= least_docs).select("lang", "term").unionByName(told), "audit-kept")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(ONE * (count + 2) / (total + 2 * terms))`` without rounding."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(ONE)
    return 1 + F.call_function("div", wide, (total + 2 * terms).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: each source against each other of its language, and its ``top`` terms.

    Part ``pair`` sums the gaps of two sources over all kept terms; part ``term`` lists terms that a source
    uses more than its language does.
    """
    lang, source, text = text_of(lang_col), text_of(source_col), text_of(text_col)
    docs = df.select(lang.alias("lang"), source.alias("source"), text.alias("text")).withColumn("gid", F.xxhash64("lang", "source"))
    rows = docs.select("lang", "gid", F.col("text").cast("binary").alias("text"), F.monotonically_increasing_id().alias("row"))
    cut = stored(cut_chunks(chunk_counts(rows, least_docs), least_docs), "audit-chunks")
    kept = kept_terms(cut, least_docs)
    found = cut.select("lang", "spread", F.explode("terms").alias("term")).join(kept, ["lang", "term"])
    halves = F.transform(F.sequence(F.lit(0), F.size("spread") - 1, F.lit(2)), lambda i: F.struct(F.get("spread", i).alias("gid"), F.get("spread", i + 1).alias("n")))
    found = found.select("lang", "term", F.explode(halves).alias("g")).groupBy("g.gid", "lang", "term").agg(F.sum("g.n").alias("n"))
    found = stored(found, "audit-found")

    whole = found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = stored(whole.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "audit-langs")
    totals = found.groupBy("gid").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    groups = docs.select("lang", "source", "gid").distinct().join(totals, "gid", "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "own", "v", "lang_total"])
    zero = F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).otherwise(F.lit(0))
    groups = stored(groups.withColumn("p0", zero), "audit-groups")
    cells = found.join(whole, ["lang", "term"]).join(groups.drop("own", "lang"), "gid").withColumns(
        {"p": share(F.col("n"), F.col("total"), F.col("v")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("v"))}
    )
    cells = stored(cells.select("gid", "lang", "source", "term", "p", "p0", "q"), "audit-cells")

    terms = cells.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    ranking = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= top)
    pairs = pair_values(cells, groups).withColumn("rank", F.row_number().over(ranking))
    return pairs.unionByName(terms)


def pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, part, item, value`` for each two sources of a language."""
    def side(s: str, df: DataFrame, *columns: str) -> DataFrame:
        return df.select("lang", *[F.col(c).alias(f"{c}_{s}") for c in columns])

    place = ["lang", "gid_a", "gid_b"]
    a, b = (side(s, groups, "gid", "source", "p0", "own", "v") for s in "ab")
    base = gap(F.col("p0_a"), F.col("p0_b"))
    pairs = a.join(b, "lang").filter(F.col("gid_a") < F.col("gid_b"))
    pairs = stored(pairs.withColumn("rest", F.when(F.col("v_a") > 0, (F.col("v_a") - F.col("own_a") - F.col("own_b")) * base).otherwise(F.lit(0))), "audit-pairs")

    both = cells.select("lang", "term", F.col("gid").alias("gid_a"), F.col("p").alias("p_a"), F.col("p0").alias("p0_a")).join(
        cells.select("lang", "term", F.col("gid").alias("gid_b"), F.col("p").alias("p_b"), F.col("p0").alias("p0_b")), ["lang", "term"]
    ).filter(F.col("gid_a") < F.col("gid_b"))
    met = gap(F.col("p_a"), F.col("p_b")) - gap(F.col("p_a"), F.col("p0_b")) - gap(F.col("p0_a"), F.col("p_b")) + base
    sums = both.groupBy(*place).agg(F.sum(met).alias("value"))

    histogram = stored(cells.groupBy("lang", "gid", "p").agg(F.count("*").alias("terms")), "audit-histogram")
    for own, other in ("ab", "ba"):
        hist = histogram.select("lang", F.col("gid").alias(f"gid_{own}"), "p", "terms")
        alone = pairs.select(*place, f"p0_{other}").join(hist, ["lang", f"gid_{own}"])
        sums = sums.unionByName(alone.groupBy(*place).agg(F.sum(gap(F.col("p"), F.col(f"p0_{other}")) * F.col("terms")).alias("value")))
    sums = sums.unionByName(pairs.select(*place, F.col("rest").alias("value"))).groupBy(*place).agg(F.sum("value").alias("value"))
    named = sums.join(pairs.select(*place, "source_a", "source_b"), place)
    ways = F.explode(F.array(*[F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba")]))
    return named.select("lang", "value", ways.alias("r")).select("lang", "r.source", F.lit("pair").alias("part"), "r.item", "value")
