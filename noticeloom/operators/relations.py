"""Span candidates, entity pairs, relation truths and relation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind, running_totals, unnest
from noticeloom.operators.ranking import running_offsets, sample_by_hash

# Label pairs that form a relation and the relation types of news views.
NER_PAIRS = [("中标单位", "中标金额"), ("中标金额", "中标金额单位")]
CONCEPT, VIEW = "概念解释", "实体观点"
EVENT_FIELDS = {"event": "实体事件", "time": "实体时间", "place": "实体地点"}


def span_candidates(scores: DataFrame, doc: str, threshold: float, min_length: int, max_length: int) -> DataFrame:
    """Token spans whose start and end scores reach ``threshold``, with a length in the bounds.

    Starts are filed under their own cell of ``max_length`` tokens and the next, ends under theirs,
    so only pairs within reach meet.
    """
    if max_length <= 0:
        raise ValueError("without max_length use span_candidate_ranges, which lists no pairs")
    starts = scores.filter(F.col("start_score") >= threshold).select(
        F.col(doc).alias("_d"),
        F.col("token").alias("start"),
        F.explode(F.array(F.floor(F.col("token") / max_length), F.floor(F.col("token") / max_length) + 1)).alias("_c"),
    )
    ends = scores.filter(F.col("end_score") >= threshold).select(
        doc, F.col("token").alias("last"), F.floor(F.col("token") / max_length).alias("cell")
    )
    size = F.col("last") - F.col("start") + 1
    near = size.between(max(min_length, 1), max_length)
    return starts.join(ends, (starts["_d"] == ends[doc]) & (starts["_c"] == ends["cell"]) & near).select(
        doc, "start", (F.col("last") + 1).alias("end")
    )


def span_candidate_ranges(scores: DataFrame, doc: str, threshold: float, min_length: int) -> DataFrame:
    """Candidates without a length bound, one row per start: how many ends lie far enough behind it.

    The ends of a start are the last ``n_ends`` ends of its document, so the rows and the list of
    ends say all pairs without listing them.
    """
    reach = max(min_length, 1) - 1
    starts = scores.filter(F.col("start_score") >= threshold).select(
        doc, (F.col("token") + reach).alias("at"), F.col("token").alias("start"), F.lit(0).alias("is_end")
    )
    ends = scores.filter(F.col("end_score") >= threshold).select(
        doc, F.col("token").alias("at"), F.lit(None).cast("int").alias("start"), F.lit(1).alias("is_end")
    )
    behind = Window.partitionBy(doc).orderBy(F.desc("at"), F.desc("is_end")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        starts.unionByName(ends)
        .withColumn("n_ends", F.sum("is_end").over(behind))
        .filter("is_end = 0")
        .select(doc, "start", "n_ends")
    )


def flags_at(length: Column, places: Column) -> Column:
    """0/1 per place of a text, 1 at the given places; built from the runs between them, without a look-up per place."""

    def runs(kept: Column) -> Column:
        def run(place: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(kept, i - 1)).otherwise(-1)
            return F.concat(F.array_repeat(F.lit(0), place - before - 1), F.array(F.lit(1)))

        last = F.coalesce(F.try_element_at(kept, F.lit(-1)), F.lit(-1))
        return F.flatten(F.concat(F.transform(kept, run), F.array(F.array_repeat(F.lit(0), length - last - 1))))

    inside = F.filter(places, lambda p: (p >= 0) & (p < length))
    return bind(F.array_sort(F.array_distinct(inside)), runs)


def boundary_truth(df: DataFrame, keep: list[str], length: Column, label: str = "label") -> DataFrame:
    """For each token whether a span starts there and whether one ends with it: one row per token, no shuffle."""
    starts = flags_at(length, F.transform(label, lambda s: s["start"]))
    ends = flags_at(length, F.transform(label, lambda s: s["end"] - 1))
    flags = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("is_start"), b.alias("is_end")))
    return unnest(df, keep, flags, "_f", "token").select(*keep, "token", "_f.*")


def near_pairs(entities: DataFrame, doc: str, max_length: int) -> DataFrame:
    """Ordered pairs of differing entities whose starts are at most ``max_length`` apart; 0 gives none.

    A band join: one side is filed under the cells its band touches, so far pairs never meet.
    """
    cell = F.floor(F.col("start") / max(max_length, 1))
    left = entities.select(
        F.col(doc).alias("_d"), F.col("pos").alias("from_pos"), F.col("start").alias("from_start"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("_c"),
    )
    right = entities.select(doc, F.col("pos").alias("to_pos"), F.col("start").alias("to_start"), cell.alias("_cell"))
    if max_length <= 0:
        right = right.limit(0)
    near = (F.abs(F.col("from_start") - F.col("to_start")) <= max_length) & (F.col("from_pos") != F.col("to_pos"))
    return left.join(right, (left["_d"] == right[doc]) & (left["_c"] == right["_cell"]) & near).select(
        doc, "from_pos", "to_pos", "from_start", "to_start"
    )


def relation_types(relations: DataFrame) -> DataFrame:
    return relations.select("type").distinct()


def relation_truth(pairs: DataFrame, relations: DataFrame, doc: str, types: list[str]) -> DataFrame:
    """Truth of every type for each candidate pair, as one map per pair.

    Pairs come from :func:`near_pairs`; a true relation whose pair is no candidate is kept too.
    """
    known = relations.groupBy(doc, "from_pos", "to_pos").agg(F.collect_set("type").alias("_types"))
    names = F.array(*[F.lit(t) for t in types])
    seen = F.coalesce(F.col("_types"), F.array().cast("array<string>"))
    truth = F.map_from_arrays(names, F.transform(names, lambda t: F.when(F.array_contains(seen, t), 1.0).otherwise(0.0)))
    keys = [doc, "from_pos", "to_pos"]
    return pairs.select(*keys).join(known, keys, "full").select(*keys, truth.alias("truth"))


def number_entities(spans: Column, first: int = 1) -> Column:
    """Entities of one document with ids in order."""
    return F.transform(
        spans,
        lambda s, i: F.struct(
            (i + first).alias("id"), s["label"].alias("label"), s["start"].alias("start_offset"), s["end"].alias("end_offset")
        ),
    )


def entity_format(df: DataFrame, n: int, seed: str, id_col="id", text="text", label="label") -> DataFrame:
    """``n`` documents in hash order with entities numbered from 0."""
    return sample_by_hash(df.select(id_col, text, label), id_col, n, seed).select(
        id_col, text, number_entities(F.col(label), 0).alias("entities")
    )


def relation_blocks(df: DataFrame, doc: str, label="label", pairs: list[tuple[str, str]] = NER_PAIRS) -> DataFrame:
    """Relations between label pairs of a document, one row per from-entity.

    The entity is related to every entity of ``to_label`` in its document, in order; their relation
    ids run from ``first_id``. Nothing is multiplied out: :func:`expand_blocks` does it on demand.
    """
    spans = F.col(label)

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["label"] == name))

    sizes = {to: count(to) for _, to in pairs}

    def fan_out(s: Column) -> Column:
        n = F.lit(0)
        for source, to in pairs:
            n = F.when(s["label"] == source, F.col(f"_n_{to}")).otherwise(n)
        return n

    counted = df.select(doc, label, *[n.alias(f"_n_{to}") for to, n in sizes.items()])
    counted = counted.withColumn("_fan", F.transform(spans, fan_out))
    rows = bind(
        running_totals(F.col("_fan")),
        lambda upto: F.transform(
            spans,
            lambda s, i: F.struct(
                (i + 1).alias("from_id"),
                s["label"].alias("from_label"),
                F.get(F.col("_fan"), i).alias("n"),
                (F.get(upto, i) - F.get(F.col("_fan"), i) + 1).alias("first_id"),
            ),
        ),
    )
    target = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    return (
        unnest(counted, [doc], F.filter(rows, lambda r: r["n"] > 0), "_r")
        .select(doc, "_r.*")
        .withColumn("to_label", F.element_at(target, F.col("from_label")))
        .withColumn("type", F.concat_ws("-", "from_label", "to_label"))
    )


def expand_blocks(blocks: DataFrame, df: DataFrame, doc: str, label="label") -> DataFrame:
    """One row per relation of the given blocks."""
    ranked = (
        unnest(df, [doc], label, "_s", "pos")
        .select(doc, (F.col("pos") + 1).alias("to_id"), F.col("_s.label").alias("to_label"))
        .withColumn("k", F.row_number().over(Window.partitionBy(doc, "to_label").orderBy("to_id")))
    )
    steps = blocks.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return steps.join(ranked, [doc, "to_label", "k"]).select(
        doc, (F.col("first_id") + F.col("k") - 1).cast("int").alias("id"), "from_id", "to_id", "type"
    )


def last_ids(df: DataFrame) -> DataFrame:
    """Highest entity and relation id of a labelled corpus."""
    return df.agg(
        F.max(F.array_max(F.transform("entities", lambda e: e["id"]))).alias("ent_id"),
        F.max(F.array_max(F.transform("relations", lambda r: r["id"]))).alias("rel_id"),
    )


def label_relations(df: DataFrame, doc: str, ent_id: int, rel_id: int, threshold: float = 0.5, label="label", scores="scores") -> DataFrame:
    """Documents with globally numbered entities and the relations scored above ``threshold``.

    ``scores`` is an array of (from_pos, to_pos, type, score). Ids continue from the given ones in
    document order, by running offsets instead of a sort in one task.
    """
    kept = df.withColumn("_kept", F.filter(scores, lambda r: r["score"] > threshold))
    sizes = kept.select(doc, F.size(label).alias("_ne"), F.size("_kept").alias("_nr"))
    offsets = running_offsets(sizes, [doc], {"_ne": "_oe", "_nr": "_or"}).select(doc, "_oe", "_or")
    base = F.col("_oe") + ent_id
    entities = F.transform(
        label,
        lambda s, i: F.struct(
            (base + i).alias("id"), s["label"].alias("label"), s["start"].alias("start_offset"), s["end"].alias("end_offset")
        ),
    )
    relations = F.transform(
        "_kept",
        lambda r, i: F.struct(
            (F.col("_or") + rel_id + i).alias("id"),
            (base + r["from_pos"]).alias("from_id"),
            (base + r["to_pos"]).alias("to_id"),
            r["type"].alias("type"),
        ),
    )
    return (
        kept.join(offsets, doc)
        .withColumns({"entities": entities, "relations": relations})
        .drop("_kept", "_oe", "_or")
    )


def relation_views(df: DataFrame, doc: str, text="text") -> dict[str, DataFrame]:
    """Concepts, views and events of a relation corpus.

    An event is one row per (document, source entity); a later value replaces an earlier one.
    """
    names = F.map_from_entries(
        F.transform(
            "entities",
            lambda e: F.struct(e["id"], F.substr(F.col(text), e["start_offset"] + 1, e["end_offset"] - e["start_offset"])),
        )
    )
    rows = unnest(df, [doc, names.alias("_names")], "relations", "r", "pos").select(
        doc,
        "pos",
        F.col("r.type").alias("type"),
        F.col("r.from_id").alias("from_id"),
        F.element_at("_names", F.col("r.from_id")).alias("from_text"),
        F.element_at("_names", F.col("r.to_id")).alias("to_text"),
    )
    field = {
        name: F.max_by(F.when(F.col("type") == kind, F.col("to_text")), F.when(F.col("type") == kind, F.col("pos"))).alias(name)
        for name, kind in EVENT_FIELDS.items()
    }
    return {
        "concepts": rows.filter(F.col("type") == CONCEPT).select(doc, F.col("from_text").alias("concept"), F.col("to_text").alias("explation")),
        "views": rows.filter(F.col("type") == VIEW).select(doc, F.col("from_text").alias("ent"), F.col("to_text").alias("view")),
        "events": rows.filter(~F.col("type").isin(CONCEPT, VIEW))
        .groupBy(doc, "from_id")
        .agg(F.max_by("from_text", "pos").alias("ent"), *field.values()),
    }
