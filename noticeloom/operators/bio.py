"""Character tags from spans and spans from tags, inside one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import SPAN_TYPE, bind, empty, index_range, items, lower_bound, overlap_free, total, unnest
from noticeloom.operators.spans import span

SLICE = 500
OUTSIDE = "O"
IGNORED = -100


def _painted(length: Column, pieces: Column) -> Column:
    """Tags of a text from ordered, disjoint pieces (start, end, first, label)."""

    def gap(i: Column, start: Column) -> Column:
        before = F.when(i == 0, F.lit(0)).otherwise(F.get(pieces, i - 1)["end"])
        return F.array_repeat(F.lit(OUTSIDE), start - before)

    body = F.flatten(
        F.transform(
            pieces,
            lambda p, i: F.concat(
                gap(i, p["start"]),
                F.array(F.concat(F.when(p["first"], F.lit("B-")).otherwise(F.lit("I-")), p["label"])),
                F.array_repeat(F.concat(F.lit("I-"), p["label"]), p["end"] - p["start"] - 1),
            ),
        )
    )
    tail = F.when(F.size(pieces) > 0, length - F.try_element_at(pieces, F.lit(-1))["end"]).otherwise(length)
    return F.concat(body, F.array_repeat(F.lit(OUTSIDE), tail.cast("int")))


def _resolved(spans: Column) -> Column:
    """Disjoint pieces of overlapping spans: at each character the later span of the list wins."""
    edges = F.sort_array(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["end"])))))

    def pieces(cuts: Column) -> Column:
        def at(i: Column) -> Column:
            winner = F.try_element_at(
                F.filter(spans, lambda s: (s["start"] <= F.get(cuts, i)) & (s["end"] > F.get(cuts, i))), F.lit(-1))
            return F.struct(
                F.get(cuts, i).alias("start"),
                F.get(cuts, i + 1).alias("end"),
                (winner["start"] == F.get(cuts, i)).alias("first"),
                winner["label"].alias("label"),
            )

        return F.filter(F.transform(index_range(F.size(cuts) - 1), at), lambda p: p["label"].isNotNull())

    return bind(edges, pieces)


def tag_pieces(spans: Column) -> Column:
    """What the tags of a text are painted from: ordered, disjoint (start, end, first, label).

    A piece is tagged ``I-x`` throughout, from a ``B-x`` on if it is ``first``; the rest of the text is ``O``.
    """
    plain = F.transform(
        F.sort_array(spans),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(True).alias("first"), s["label"].alias("label")),
    )
    return F.when(overlap_free(spans), plain).otherwise(_resolved(spans))


def bio_tags(length: Column, spans: Column) -> Column:
    """``B-x`` / ``I-x`` / ``O`` per character; spans without overlap take a one-pass route."""
    return bind(tag_pieces(spans), lambda p: _painted(length, p))


def piece_spans(pieces: Column) -> Column:
    """:func:`tag_spans` of the tags painted from pieces, by the pieces alone."""

    def opens(p: Column, k: Column) -> Column:
        return p["first"] | (k == 0) | (F.get(pieces, k - 1)["end"] != p["start"])

    def run(first: Column, last: Column) -> Column:
        own = F.transform(F.sequence(first, last), lambda k: F.get(pieces, k))

        def commonest(own: Column) -> Column:
            def chars(label: Column) -> Column:
                return total(F.transform(F.filter(own, lambda p: p["label"] == label), lambda p: p["end"] - p["start"]))

            labels = F.array_distinct(F.transform(own, lambda p: p["label"]))
            return F.array_max(F.transform(labels, lambda x, i: F.struct(chars(x).alias("n"), (-i).alias("i"), x.alias("k"))))["k"]

        label = F.when(first == last, F.get(pieces, first)["label"]).otherwise(bind(own, commonest))
        return span(F.get(pieces, first)["start"], F.get(pieces, last)["end"], label)

    def runs(at: Column) -> Column:
        return F.transform(at, lambda k, i: run(k, F.coalesce(F.get(at, i + 1), F.size(pieces)) - 1))

    return bind(F.filter(index_range(F.size(pieces)), lambda k: opens(F.get(pieces, k), k)), runs)


def same_tags(length: Column, one: Column, other: Column) -> Column:
    """Characters of a text that two lists of pieces give the same tag, ``O`` included."""

    def covered(pieces: Column) -> Column:
        return total(F.transform(pieces, lambda p: p["end"] - p["start"]))

    def gain(a: Column, b: Column) -> Column:
        """Of two pieces that meet: the characters in both, and those of them with the same tag."""
        low, both = F.greatest(a["start"], b["start"]), F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"])
        heads = (a["first"] & (a["start"] == low)) != (b["first"] & (b["start"] == low))
        return both + F.when(a["label"] == b["label"], both - heads.cast("int")).otherwise(F.lit(0))

    def met(starts: Column, ends: Column) -> Column:
        def of_piece(a: Column) -> Column:
            return total(items(other, lower_bound(ends, a["start"] + 1), lower_bound(starts, a["end"]), lambda b: gain(a, b)))

        return total(F.transform(one, of_piece))

    starts, ends = F.transform(other, lambda b: b["start"]), F.transform(other, lambda b: b["end"])
    return length - covered(one) - covered(other) + bind(starts, lambda s: bind(ends, lambda e: met(s, e)))


def tag_vocabulary(labels: Column) -> Column:
    """``['O', 'B-x', 'I-x', ...]`` of a label list."""
    return F.concat(
        F.array(F.lit(OUTSIDE)),
        F.flatten(F.transform(labels, lambda x: F.array(F.concat(F.lit("B-"), x), F.concat(F.lit("I-"), x)))),
    )


def tag_ids(tags: Column, vocabulary: list[str]) -> Column:
    """Tag positions in the vocabulary."""
    known = F.array(*[F.lit(t) for t in vocabulary])
    return F.transform(tags, lambda t: (F.array_position(known, t) - 1).cast("int"))


def tag_rows(df: DataFrame, keep: list[str], text="text", tags="tags") -> DataFrame:
    """One row per character with its tag."""
    chars = F.split(text, "")
    return unnest(df, keep, F.arrays_zip(chars.alias("ch"), F.col(tags).alias("tag")), "_c", "pos").select(
        *keep, "pos", F.col("_c.ch").alias("ch"), F.col("_c.tag").alias("tag")
    )


def _kind(tag: Column) -> Column:
    return F.upper(F.substring(tag, 1, 1))


def tag_spans(tags: Column) -> Column:
    """Runs of tags as spans: a run starts at B, or at I after O; its type is its most frequent type.

    Of equally frequent types the one met first wins. Untagged characters are read once; the rest of
    the work is on the tagged places alone.
    """

    def of_row(row: Column) -> Column:
        places = F.filter(index_range(F.size(row)), lambda i: F.get(row, i) != OUTSIDE)

        def runs(at: Column) -> Column:
            def opens(place: Column, k: Column) -> Column:
                return (_kind(F.get(row, place)) == "B") | (k == 0) | (F.get(at, k - 1) != place - 1)

            def closes(place: Column, k: Column) -> Column:
                after = F.get(at, k + 1)
                return after.isNull() | (after != place + 1) | (_kind(F.get(row, after)) == "B")

            return F.arrays_zip(F.filter(at, opens).alias("s"), F.filter(at, closes).alias("e"))

        def typed(run: Column) -> Column:
            types = F.transform(F.sequence(run["s"], run["e"]), lambda i: F.substr(F.get(row, i), F.lit(3)))

            def commonest(own: Column) -> Column:
                ranked = F.transform(
                    F.array_distinct(own),
                    lambda k, i: F.struct(F.size(F.filter(own, lambda t: t == k)).alias("n"), (-i).alias("i"), k.alias("k")),
                )
                return F.array_max(ranked)["k"]

            return span(run["s"], run["e"] + 1, bind(types, commonest))

        return F.transform(bind(places, runs), typed)

    return bind(tags, of_row)


def token_slices(tags: Column, size: int = SLICE) -> Column:
    """Tagged characters as token predictions with offsets inside their ``size`` slice."""
    return bind(
        tags,
        lambda row: F.transform(
            F.filter(index_range(F.size(row)), lambda i: F.get(row, i) != OUTSIDE),
            lambda i: F.struct(
                F.floor(i / size).cast("int").alias("slice"),
                (i % size).alias("start"),
                (i % size + 1).alias("end"),
                F.get(row, i).alias("entity"),
            ),
        ),
    )


def merge_tokens(tokens: Column, size: int = SLICE) -> Column:
    """Token predictions to spans: offsets moved by their slice; B opens, I of the same label extends.

    The first token opens a span whatever its tag is, and the last open span is kept.
    """

    def merged(moved: Column) -> Column:
        opens = F.filter(index_range(F.size(moved)), lambda i: (i == 0) | (_kind(F.get(moved, i)["entity"]) == "B"))

        def close(first: Column, k: Column) -> Column:
            last = F.coalesce(F.get(opens, k + 1), F.size(moved))
            head = F.get(moved, first)
            label = F.substr(head["entity"], F.lit(3))
            own = F.filter(F.sequence(first, last - 1), lambda i: F.substr(F.get(moved, i)["entity"], F.lit(3)) == label)
            return span(head["start"], F.get(moved, F.try_element_at(own, F.lit(-1)))["end"], label)

        return F.transform(opens, close)

    moved = F.transform(
        tokens,
        lambda t: F.struct(
            (t["start"] + t["slice"] * size).alias("start"), (t["end"] + t["slice"] * size).alias("end"), t["entity"].alias("entity")
        ),
    )
    return F.when(F.size(tokens) > 0, bind(moved, merged)).otherwise(empty(SPAN_TYPE))


def tag_windows(df: DataFrame, keep: list[str], max_len: int, length: Column, text="data", tags="label") -> DataFrame:
    """Even windows of at most ``max_len`` tags that overlap their neighbours by the room left over.

    ``text`` and ``tags`` are arrays of one item per character.
    """
    parts = length / F.lit(max_len).cast("double") + 1
    every = F.floor(length / parts)
    room = F.floor((max_len - every) / 2)
    count = F.floor(parts).cast("int")
    rows = df.withColumns({"_every": every.cast("int"), "_room": room.cast("int"), "_count": count, "_n": length})
    rows = rows.withColumn("window", F.explode(index_range(F.col("_count"))))
    first, last = F.col("window") == 0, F.col("window") == F.col("_count") - 1
    lo, hi, room_ = F.col("window") * F.col("_every"), (F.col("window") + 1) * F.col("_every"), F.col("_room")
    start = F.when(first, lo).when(last, lo - 2 * room_).otherwise(lo - room_)
    end = F.when(first, hi + 2 * room_).when(last, hi).otherwise(hi + room_)
    rows = rows.withColumns(
        {"start": F.greatest(start, F.lit(0)).cast("int"), "end": F.least(end, F.col("_n")).cast("int")}
    )
    size = F.greatest(F.col("end") - F.col("start"), F.lit(0))
    return rows.select(
        *keep,
        "window",
        "start",
        "end",
        F.slice(text, F.col("start") + 1, size).alias(text),
        F.slice(tags, F.col("start") + 1, size).alias(tags),
    )
