"""Span operators on annotated documents.

A document is one row with its text and an array of half-open spans in code points. Work on the
spans of one document stays inside its row, so these operators need no shuffle; only results that
are one row per span or per window are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind, empty, index_range, items, lower_bound, running_totals, total, unnest

CHUNK = 500
CHUNK_PAD = 20
WINDOW = 600
STRIDE = 300
CONTEXT = 200


def span(start: Column, end: Column, label: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), label.alias("label"))


def occurrences(text: Column, term: Column, pattern: Column, label: Column) -> Column:
    """Spans of every occurrence of ``term``, from the lengths of the pieces between them."""
    width = F.length(term)

    def place(ends: Column) -> Column:
        return F.transform(
            index_range(F.size(ends) - 1),
            lambda i: span(F.get(ends, i) + i * width, F.get(ends, i) + (i + 1) * width, label),
        )

    lengths = F.transform(F.split(text, pattern, -1), F.length)
    return bind(bind(lengths, running_totals), place)


def phrase_spans(text: Column, terms: list[tuple[str, str]]) -> Column:
    """Spans of all (label, term) pairs in reading order.

    One split per term that the text holds, so this is for dictionaries of tens of terms; longer ones
    go through :func:`noticeloom.operators.annotate.annotate_with_terms`.
    """
    listed = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(term).alias("term"),
                F.lit("\\Q" + term.replace("\\E", "\\E\\\\E\\Q") + "\\E").alias("pattern"),
            )
            for label, term in terms
        ]
    )
    present = F.filter(listed, lambda t: F.contains(text, t["term"]))
    found = F.transform(present, lambda t: occurrences(text, t["term"], t["pattern"], t["label"]))
    return F.sort_array(F.flatten(found))


def phrase_documents(df: DataFrame, terms: list[str], number: int, text="text", id_col="id", label="其他") -> DataFrame:
    """First ``number`` documents in id order with the spans of the given terms."""
    head = df.orderBy(id_col).limit(number)
    return head.withColumn("label", phrase_spans(F.col(text), [(label, t) for t in terms]))


def gold_override(df: DataFrame, gold: DataFrame, key="md5", label="label", gold_label="label") -> DataFrame:
    """Labels replaced by the human ones where the document is known; one gold row per key."""
    known = gold.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(F.col(gold_label).alias("v")))["v"].alias("_gold"))
    joined = df.join(known, df[key] == known["_key"], "left")
    return joined.withColumn(label, F.coalesce("_gold", label)).drop("_key", "_gold")


def span_texts(text: Column, spans: Column) -> Column:
    """The (label, value) list of a document."""
    return F.transform(
        spans,
        lambda s: F.struct(s["label"].alias("label"), F.substr(text, s["start"] + 1, s["end"] - s["start"]).alias("value")),
    )


def span_rows(df: DataFrame, keep: list[str], text="text", label="label") -> DataFrame:
    """One row per span with its text and length.

    The span's text is cut inside the row, so exploded rows do not carry the whole document.
    """
    cut = F.transform(
        label,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["label"].alias("label_type"),
            F.substr(F.col(text), s["start"] + 1, s["end"] - s["start"]).alias("value"),
        ),
    )
    return unnest(df, keep, cut, "_span", "pos").select(*keep, "pos", "_span.*").withColumn("label_len", F.length("value"))


def bare_spans(df: DataFrame, keep: list[str], label="label") -> DataFrame:
    """One narrow row per span, without text."""
    return unnest(df, keep, label, "_span", "pos").select(
        *keep, "pos", F.col("_span.start").alias("start"), F.col("_span.end").alias("end"), F.col("_span.label").alias("label")
    )


def context_windows(df: DataFrame, keep: list[str], labels: list[str] | None = None, reach: int = CONTEXT, text="text", label="label") -> DataFrame:
    """One row per span: the text around it and the span moved into that text."""
    picked = F.col(label) if labels is None else F.filter(label, lambda s: s["label"].isin(labels))

    def window(s: Column, length: Column) -> Column:
        low, high = F.greatest(s["start"] - reach, F.lit(0)), F.least(s["end"] + reach, length)
        return F.struct(
            F.substr(F.col(text), low + 1, high - low).alias("text"),
            F.array(span(s["start"] - low, s["end"] - low, s["label"])).alias("label"),
            low.alias("s_start"),
            high.alias("s_end"),
        )

    windows = bind(F.length(text), lambda length: F.transform(picked, lambda s: window(s, length)))
    return unnest(df, keep, windows, "_w").select(*keep, "_w.*")


def replace_from_windows(df: DataFrame, windows: DataFrame, labels: list[str], id_col="id", label="label") -> DataFrame:
    """Corrected windows back into their documents: spans of ``labels`` are replaced as a set.

    Documents without a window keep their spans.
    """
    moved = windows.select(
        F.col(id_col).alias("_id"),
        F.transform(
            F.filter(label, lambda s: s["label"].isin(labels)),
            lambda s: span(s["start"] + F.col("s_start"), s["end"] + F.col("s_start"), s["label"]),
        ).alias("_new"),
    )
    moved = moved.groupBy("_id").agg(F.array_distinct(F.flatten(F.collect_list("_new"))).alias("_new"))
    kept = F.filter(label, lambda s: ~s["label"].isin(labels))
    return (
        df.join(moved, df[id_col] == moved["_id"], "left")
        .withColumn(label, F.when(F.col("_id").isNull(), F.col(label)).otherwise(F.sort_array(F.concat(kept, "_new"))))
        .drop("_id", "_new")
    )


def spans_inside(spans: Column, bounds: Column, make) -> Column:
    """``make(bound, its spans)`` for each (start, end) of ``bounds``: the spans fully inside, in list order, re-based.

    Spans are ordered by start once; a bound looks only at those that start in it.
    """
    kind = "array<struct<start:int,pos:int,end:int,label:string>>"
    placed = F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), i.alias("pos"), s["end"].alias("end"), s["label"].alias("label")))

    def per_bound(ordered: Column, starts: Column) -> Column:
        def one(b: Column) -> Column:
            first, stop = lower_bound(starts, b["start"]), lower_bound(starts, b["end"] + 1)
            own = F.filter(items(ordered, first, stop, lambda s: F.struct(s["pos"], s["start"], s["end"], s["label"])), lambda s: s["end"] <= b["end"])
            return make(b, F.transform(F.array_sort(own), lambda s: span(s["start"] - b["start"], s["end"] - b["start"], s["label"])))

        return F.transform(bounds, one)

    return bind(
        F.array_sort(F.coalesce(placed.cast(kind), empty(kind))),
        lambda ordered: bind(F.transform(ordered, lambda s: s["start"]), lambda starts: per_bound(ordered, starts)),
    )


def spans_touching(spans: Column, bounds: Column, make) -> Column:
    """``make(bound, its spans)`` for each of the ordered, disjoint ``bounds``: spans that overlap it, clipped and re-based.

    Each span finds its first and last bound by bisection and is listed under those between.
    """
    kind = "array<struct<of:int,pos:int,start:int,end:int,label:string>>"

    def list_all(starts: Column, ends: Column) -> Column:
        def one(s: Column, pos: Column) -> Column:
            first, stop = lower_bound(ends, s["start"] + 1), lower_bound(starts, s["end"])
            places = F.when(stop > first, F.sequence(first, stop - 1)).otherwise(empty("array<int>"))
            return F.transform(places, lambda i: F.struct(i.alias("of"), pos.alias("pos"), s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label")))

        return F.array_sort(F.flatten(F.transform(spans, one)).cast(kind))

    def per_bound(listed: Column, of: Column) -> Column:
        def one(b: Column, i: Column) -> Column:
            def clipped(s: Column) -> Column:
                return span(F.greatest(s["start"], b["start"]) - b["start"], F.least(s["end"], b["end"]) - b["start"], s["label"])

            return make(b, items(listed, lower_bound(of, i), lower_bound(of, i + 1), clipped))

        return F.transform(bounds, one)

    borders = lambda name: F.transform(bounds, lambda b: b[name])
    listed = bind(borders("start"), lambda starts: bind(borders("end"), lambda ends: list_all(starts, ends)))
    return bind(F.coalesce(listed, empty(kind)), lambda every: bind(F.transform(every, lambda s: s["of"]), lambda of: per_bound(every, of)))


def chunk_borders(length: Column, spans: Column, size: int = CHUNK, pad: int = CHUNK_PAD) -> Column:
    """Borders every ``size`` characters; one that would cut a span moves ``pad`` past the span's end.

    A move shifts all later borders. One pass over the spans in order merges those that overlap and finds
    the moves; the borders between two moves are an arithmetic sequence, kept as its first and last. The state
    is never cast, which would copy it for every span.
    """
    def settled(acc: Column, start: Column, end: Column) -> Column:
        """The state with its merged span done, and ``start, end`` as the next one."""
        runs = F.greatest(F.floor((acc["start"] - acc["next"]) / size) + 1, F.lit(0)).cast("int")
        border = acc["next"] + runs * size
        cut = (border > acc["start"]) & (border < acc["end"])
        run = F.struct(acc["next"].alias("first"), (border - size).alias("last"))
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            F.when(cut, acc["end"] + pad).otherwise(border).alias("next"),
            F.when(runs > 0, F.concat(acc["runs"], F.array(run))).otherwise(acc["runs"]).alias("runs"),
        )

    def step(acc: Column, s: Column) -> Column:
        wider = F.struct(acc["start"].alias("start"), F.greatest(acc["end"], s["end"]).alias("end"), acc["next"].alias("next"), acc["runs"].alias("runs"))
        return F.when(s["start"] < acc["end"], wider).otherwise(settled(acc, s["start"], s["end"]))

    def finish(acc: Column) -> Column:
        runs = F.when(
            acc["next"] < length,
            F.concat(acc["runs"], F.array(F.struct(acc["next"].alias("first"), (length - 1).cast("int").alias("last")))),
        ).otherwise(acc["runs"])
        inner = F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"], F.lit(size))))
        return F.concat(F.array(F.lit(0)), F.filter(inner, lambda b: b < length), F.array(length.cast("int")))

    none = F.lit(-1)
    start = F.struct(none.alias("start"), none.alias("end"), F.lit(size).alias("next"), empty("array<struct<first:int,last:int>>").alias("runs"))
    return F.aggregate(F.sort_array(spans), start, step, lambda acc: bind(settled(acc, none, none), finish))


PIECE = 256  # characters of a text's pieces from which chunks are cut


def chunk_documents(df: DataFrame, keep: list[str], size: int = CHUNK, pad: int = CHUNK_PAD, text="text", label="label") -> DataFrame:
    """Contiguous chunks of about ``size`` characters that cut no span; chunks without a span are left out.

    Documents shorter than ``size`` stay whole, spans or not.
    """
    length = F.length(text)
    borders = F.when(length < size, F.array(F.lit(0), length)).otherwise(chunk_borders(length, F.col(label), size, pad))

    def chunk(b: Column, own: Column) -> Column:
        return F.struct(b["start"].alias("chunk_start"), b["text"].alias("text"), own.alias("label"))

    def cut(pieces: Column, start: Column, end: Column) -> Column:
        """The text between two places from the pieces it touches; cutting the whole text would read it from its start."""
        first, stop = F.floor(start / PIECE).cast("int"), F.ceil(end / PIECE).cast("int")
        return F.substr(F.array_join(items(pieces, first, stop, lambda p: p), ""), start - first * PIECE + 1, end - start)

    def bounds(at: Column, pieces: Column) -> Column:
        return F.transform(
            index_range(F.size(at) - 1),
            lambda i: F.struct(F.get(at, i).alias("start"), F.get(at, i + 1).alias("end"), cut(pieces, F.get(at, i), F.get(at, i + 1)).alias("text")),
        )

    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), 0)
    chunks = bind(bind(pieces, lambda p: bind(borders, lambda at: bounds(at, p))), lambda found: spans_inside(F.col(label), found, chunk))
    rows = unnest(df, [*keep, (length < size).alias("_short")], chunks, "_c", "chunk").select(*keep, "_short", "chunk", "_c.*")
    return rows.filter((F.size("label") > 0) | F.col("_short")).drop("_short")


def chunk_export(chunks: DataFrame, keep: list[str]) -> DataFrame:
    """Export rows: the chunk's text followed by one ``[start, end],label`` cell per span."""
    cells = F.transform("label", lambda s: F.format_string("[%d, %d],%s", s["start"], s["end"], s["label"]))
    return chunks.select(*keep, F.concat(F.array("text"), cells).alias("cells"))


def sliding_windows(df: DataFrame, keep: list[str], width: int = WINDOW, stride: int = STRIDE, text="text", label="label") -> DataFrame:
    """Windows of ``width`` every ``stride`` characters with the spans fully inside them.

    ``width`` is a multiple of ``stride``: the text is cut into strides once and a window joins the
    pieces it covers, which reads a long text once and not once per window.
    """
    if width % stride:
        raise ValueError("width must be a multiple of stride")
    cover = width // stride

    def window(pieces: Column, i: Column) -> Column:
        start = i * stride
        own = [F.coalesce(F.get(pieces, i + k), F.lit("")) for k in range(cover)]

        def build(cut: Column) -> Column:
            return F.struct(start.cast("int").alias("start"), (start + F.length(cut)).cast("int").alias("end"), cut.alias("text"))

        return bind(F.concat(*own), build)

    def row(b: Column, own: Column) -> Column:
        end = (b["start"] + width).cast("int")
        return F.struct(b["start"].alias("start"), end.alias("end"), b["text"].alias("text"), own.alias("label"))

    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{stride}}}"), 0)
    cut = bind(pieces, lambda p: F.transform(index_range(F.size(p)), lambda i: window(p, i)))
    windows = bind(cut, lambda found: spans_inside(F.col(label), found, row))
    return unnest(df, keep, windows, "_w").select(*keep, "_w.*")


def stitch_windows(windows: DataFrame, key: list[str]) -> DataFrame:
    """Documents rebuilt from their windows; spans seen in two windows are kept once.

    The group is one document, so its size is that of the row it came from.
    """
    piece = F.struct("start", "text", F.transform("label", lambda s: span(s["start"] + F.col("start"), s["end"] + F.col("start"), s["label"])).alias("label"))
    parts = windows.groupBy(*key).agg(F.sort_array(F.collect_list(piece)).alias("_parts"))
    own_text = F.transform(
        "_parts",
        lambda p, i: F.when(i == F.size("_parts") - 1, p["text"]).otherwise(
            F.substr(p["text"], F.lit(1), F.get("_parts", i + 1)["start"] - p["start"])
        ),
    )
    return parts.select(
        *key,
        F.array_join(own_text, "").alias("text"),
        F.sort_array(F.array_distinct(F.flatten(F.transform("_parts", lambda p: p["label"])))).alias("label"),
    )


def trim_span_edges(text: Column, spans: Column) -> Column:
    """Starts moved right and ends moved left over white space; a span of white space only is dropped."""

    def trim(s: Column) -> Column:
        return bind(
            F.substr(text, s["start"] + 1, s["end"] - s["start"]),
            lambda v: span(
                s["start"] + F.length(F.regexp_extract(v, r"(?U)^(\s*)", 1)),
                s["end"] - F.length(F.regexp_extract(v, r"(?U)(\s*)$", 1)),
                s["label"],
            ),
        )

    return F.filter(F.transform(spans, trim), lambda s: s["start"] < s["end"])


def sentences(text: Column, stops: str = "。") -> Column:
    """(start, end, text) of each non-blank sentence: cut after a stop character and at line ends, true offsets."""

    def place(pieces: Column, ends: Column) -> Column:
        return F.transform(
            pieces,
            lambda p, i: F.struct(
                (F.get(ends, i) - F.length(p)).cast("int").alias("start"),
                (F.get(ends, i) - F.when(F.endswith(p, F.lit("\n")), F.lit(1)).otherwise(F.lit(0))).cast("int").alias("end"),
                F.rtrim(p, F.lit("\n")).alias("text"),
            ),
        )

    located = bind(
        F.split(text, f"(?<=[{stops}\n])", -1),
        lambda pieces: bind(bind(F.transform(pieces, F.length), running_totals), lambda ends: place(pieces, ends)),
    )
    return F.filter(located, lambda s: F.trim(F.translate(s["text"], "\n\r\t", "   ")) != "")


def sentence_rows(df: DataFrame, keep: list[str], stops: str = "。", text="text", label="label", labelled_only: bool = True) -> DataFrame:
    """One row per sentence with the spans that overlap it, clipped to it and re-based."""

    def row(sent: Column, own: Column) -> Column:
        return F.struct(sent["start"].alias("start"), sent["text"].alias("text"), own.alias("label"))

    found = bind(sentences(F.col(text), stops), lambda sents: spans_touching(F.col(label), sents, row))
    rows = unnest(df, keep, found, "_s", "sentence").select(*keep, "sentence", "_s.*")
    return rows.filter(F.size("label") > 0) if labelled_only else rows


def duplicate_labels(df: DataFrame, keep: list[str], exempt: list[str], label="label") -> DataFrame:
    """Label types a document carries more than once."""
    return (
        unnest(df, keep, F.transform(label, lambda s: s["label"]), "label_type")
        .filter(~F.col("label_type").isin(exempt))
        .groupBy(*keep, "label_type")
        .count()
        .filter("count > 1")
    )


def overlapping_spans(spans: DataFrame, key: str, cell: int = 64) -> DataFrame:
    """Pairs of overlapping or touching spans with differing labels, in both orders.

    ``spans`` has one row per span. Each span is filed under every ``cell`` characters it covers and
    a pair is reported in the cell where the later of the two starts, so no other pairs are formed
    and a long document spreads over many (document, cell) groups.
    """

    def filed(side: str) -> DataFrame:
        cells = F.sequence(F.floor(F.col("start") / cell).cast("int"), F.floor(F.col("end") / cell).cast("int"))
        return spans.select(
            F.col(key).alias(f"{side}_{key}"),
            F.col("start").alias(f"{side}_start"),
            F.col("end").alias(f"{side}_end"),
            F.col("label").alias(f"{side}_label"),
            F.explode(cells).alias(f"{side}_cell"),
        )

    a, b = filed("a"), filed("b")
    same_group = (a[f"a_{key}"] == b[f"b_{key}"]) & (a["a_cell"] == b["b_cell"])
    meet = (F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) & (F.col("a_label") != F.col("b_label"))
    here = F.floor(F.greatest("a_start", "b_start") / cell) == F.col("a_cell")
    return a.join(b, same_group & meet & here).select(
        F.col(f"a_{key}").alias(key), "a_start", "a_end", "a_label", "b_start", "b_end", "b_label"
    )


def is_valid(s: Column, length: Column) -> Column:
    return F.coalesce((s["start"] >= 0) & (s["start"] < s["end"]) & (s["end"] <= length), F.lit(False))


def split_valid(df: DataFrame, keep: list[str], text="text", label="label") -> tuple[DataFrame, DataFrame]:
    """Documents with their in-range spans, and the rejected spans one per row."""
    length = F.length(text)
    good = df.withColumn(label, F.filter(label, lambda s: is_valid(s, length)))
    bad = unnest(df, keep, F.filter(label, lambda s: ~is_valid(s, length)), "_span").select(*keep, "_span.*")
    return good, bad


def span_groups(spans: Column, key: str) -> Column:
    """Spans kept under a named group, so overlapping annotations can live side by side."""
    return F.create_map(F.lit(key), spans)


def span_count(spans: Column) -> Column:
    return total(F.transform(spans, lambda _: F.lit(1)))
