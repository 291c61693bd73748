"""Precision, recall and F of spans, relations and tags; text overlap and embedding similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind, empty, unnest
from noticeloom.operators.bio import piece_spans, same_tags, tag_spans
from noticeloom.operators.ranking import number_rows

ALL_TYPES = "ALL"
BLOCK = 1024  # rows of a batch in one matrix
SIDES = 32  # blocks along a batch, until they have MOST rows
MOST = 8192  # rows of a block; its products are made STRIP rows at a time
STRIP = 256


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def with_prf(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "p": _ratio(tp, tp + fp),
            "r": _ratio(tp, tp + fn),
            "f": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def span_scores(gold: DataFrame, pred: DataFrame, doc: str, labelled: bool = True) -> DataFrame:
    """Exact-match scores per type and over all.

    Both sides are stacked and grouped by span, so the match needs one shuffle and no join.
    """
    key = [doc, "start", "end"] + (["label"] if labelled else [])

    def side(df: DataFrame, in_gold: int) -> DataFrame:
        return df.select(*key, F.lit(in_gold).alias("in_gold"))

    return stacked_scores(side(gold, 1).unionByName(side(pred, 0)), key, labelled)


def stacked_scores(stacked: DataFrame, key: list[str], labelled: bool = True) -> DataFrame:
    """Scores of spans of both sides in one frame, told apart by ``in_gold``."""
    seen = stacked.groupBy(*key).agg(F.max("in_gold").alias("g"), (1 - F.min("in_gold")).alias("p"))
    label = F.col("label") if labelled else F.lit(ALL_TYPES)
    per_type = seen.groupBy(label.alias("item")).agg(
        F.sum(F.col("g") * F.col("p")).alias("tp"),
        F.sum((1 - F.col("g")) * F.col("p")).alias("fp"),
        F.sum(F.col("g") * (1 - F.col("p"))).alias("fn"),
    )
    if not labelled:
        return with_prf(per_type)
    totals = per_type.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).select(F.lit(ALL_TYPES).alias("item"), "tp", "fp", "fn")
    return with_prf(per_type.unionByName(totals))


def relation_scores(gold: DataFrame, pred: DataFrame, key: list[str], threshold: float, strict: bool = False) -> DataFrame:
    """Micro scores of relation predictions at a threshold.

    A missed relation counts when it was predicted below the threshold; ``strict`` also counts
    relations that were not predicted at all.
    """
    stacked = gold.select(*key, F.lit(1).alias("g"), F.lit(None).cast("double").alias("s")).unionByName(
        pred.select(*key, F.lit(0).alias("g"), F.col("score").cast("double").alias("s"))
    )
    seen = stacked.groupBy(*key).agg(F.max("g").alias("g"), F.max("s").alias("s"))
    hit = F.col("s") >= threshold
    missed = (F.col("s") < threshold) | F.col("s").isNull() if strict else F.col("s") < threshold

    def count(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return with_prf(
        seen.agg(
            count(hit & (F.col("g") == 1)).alias("tp"),
            count(hit & (F.col("g") == 0)).alias("fp"),
            count(missed & (F.col("g") == 1)).alias("fn"),
        )
    )


def tag_scores(df: DataFrame, doc: str, gold="gold_tags", pred="pred_tags", ignored: str = "-100") -> DataFrame:
    """Accuracy of tags and exact-match scores of the spans they form; ignored gold tags are left out."""
    g, p = F.col(gold), F.col(pred)
    kept_gold = F.when(F.array_contains(g, ignored), F.filter(g, lambda t: t != ignored)).otherwise(g)
    kept_pred = F.when(F.array_contains(g, ignored), F.filter(p, lambda t, i: F.get(g, i) != ignored)).otherwise(p)
    used = df.select(doc, kept_gold.alias("_g"), kept_pred.alias("_p"))
    same = F.size(F.filter(F.zip_with("_g", "_p", lambda a, b: a == b), lambda same: same))
    return _scores_with_accuracy(used, doc, F.size("_g"), same, tag_spans(F.col("_g")), tag_spans(F.col("_p")))


def piece_scores(df: DataFrame, doc: str, length: str, gold: str, pred: str) -> DataFrame:
    """:func:`tag_scores` of tags that are given by the pieces they are painted from, without a tag per character."""
    g, p = F.col(gold), F.col(pred)
    return _scores_with_accuracy(df, doc, F.col(length), same_tags(F.col(length), g, p), piece_spans(g), piece_spans(p))


def _scores_with_accuracy(df: DataFrame, doc: str, n: Column, same: Column, gold: Column, pred: Column) -> DataFrame:
    """Scores of the spans of both sides, and the share ``same / n`` over all rows.

    A row's counts go along as one more row without a side, so the work on a row is done once.
    """

    def side(spans: Column, in_gold: int) -> Column:
        return F.transform(
            spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["label"].alias("label"), F.lit(in_gold).alias("in_gold"))
        )

    nothing = F.lit(None)
    counts = F.struct(
        n.cast("int").alias("start"), same.cast("int").alias("end"), nothing.cast("string").alias("label"), nothing.cast("int").alias("in_gold")
    )
    stacked = unnest(df, [doc], F.concat(F.array(counts), side(gold, 1), side(pred, 0)), "_s").select(doc, "_s.*")
    seen = stacked.groupBy(doc, "start", "end", "label").agg(
        F.max("in_gold").alias("g"), (1 - F.min("in_gold")).alias("p"), F.count("*").alias("c")
    )

    def over_rows(column: str) -> Column:
        return F.sum(F.when(F.col("g").isNull(), F.col(column) * F.col("c")))

    overall = seen.agg(
        F.sum(F.col("g") * F.col("p")).alias("tp"),
        F.sum((1 - F.col("g")) * F.col("p")).alias("fp"),
        F.sum(F.col("g") * (1 - F.col("p"))).alias("fn"),
        over_rows("start").alias("n"),
        over_rows("end").alias("same"),
    )
    return with_prf(overall).select(
        F.col("p").alias("precision"), F.col("r").alias("recall"), F.col("f").alias("f1"), (F.col("same") / F.col("n")).alias("accuracy")
    )


def words(text: Column) -> Column:
    """Lower-case letter and digit runs."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def overlap_scores(pairs: DataFrame, pred: str, ref: str, n: int) -> DataFrame:
    """Mean n-gram overlap F of text pairs x 100 and mean generated length in words.

    Both texts of a pair stand in one row, so its n-grams are counted there and only sums are shuffled.
    """

    def grams(column: str, is_pred: int) -> Column:
        def listed(w: Column) -> Column:
            each = F.transform(
                F.sequence(F.lit(1), F.size(w) - (n - 1)),
                lambda i: F.struct(F.array_join(F.slice(w, i, n), " ").alias("gram"), F.lit(is_pred).alias("p")),
            )
            return F.when(F.size(w) >= n, each).otherwise(empty("array<struct<gram:string,p:int>>"))

        return bind(words(F.col(column)), listed)

    def hits(both: Column) -> Column:
        """Common n-grams with their repeats: the sorted list of both sides is read once."""
        start = F.struct(F.lit(None).cast("string").alias("gram"), F.lit(0).alias("p"), F.lit(0).alias("r"), F.lit(0).alias("hit"))

        def step(acc: Column, x: Column) -> Column:
            same = acc["gram"].eqNullSafe(x["gram"])
            done = F.least(acc["p"], acc["r"])
            return F.struct(
                x["gram"].alias("gram"),
                (F.when(same, acc["p"]).otherwise(0) + x["p"]).alias("p"),
                (F.when(same, acc["r"]).otherwise(0) + 1 - x["p"]).alias("r"),
                (acc["hit"] + F.when(same, 0).otherwise(done)).alias("hit"),
            )

        return F.aggregate(F.array_sort(both), start, step, lambda acc: acc["hit"] + F.least(acc["p"], acc["r"]))

    counted = pairs.select(
        F.size(words(F.col(pred))).alias("len"),
        bind(F.concat(grams(pred, 1), grams(ref, 0)), lambda both: F.struct(hits(both).alias("hit"), F.size(both).alias("n"))).alias("g"),
    )
    fscore = F.coalesce(_ratio(2 * F.col("g.hit"), F.col("g.n")), F.lit(0.0))
    return counted.agg(
        F.round(F.avg(fscore) * 100, 4).alias(f"rouge{n}"), F.round(F.avg("len"), 4).alias("gen_len"), F.count("*").alias("pairs")
    )


def common_length(some: list[str], others: list[str]) -> int:
    """Length of the longest common subsequence: a bit per word of ``others``, all moved at once for each word of ``some``."""
    masks: dict[str, int] = {}
    for i, w in enumerate(others):
        masks[w] = masks.get(w, 0) | 1 << i
    every = (1 << len(others)) - 1
    free = every  # bits of words that no subsequence has used
    for w in some:
        used = free & masks.get(w, 0)
        free = ((free + used) | (free - used)) & every
    return len(others) - free.bit_count()


def sequence_overlap(pairs: DataFrame, pred: str, ref: str) -> DataFrame:
    """Mean F of the longest common word sequence of text pairs x 100 (``rougeL``) and mean generated length in words."""

    @F.pandas_udf("int")
    def common(some: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([common_length(list(a), list(b)) for a, b in zip(some, others)], dtype="int32")

    both = [F.coalesce(words(F.col(c)), empty("array<string>")).alias(name) for c, name in ((pred, "p"), (ref, "r"))]
    counted = pairs.select(*both).withColumn("hit", common("p", "r"))
    fscore = F.coalesce(_ratio(2 * F.col("hit"), F.size("p") + F.size("r")), F.lit(0.0))
    return counted.agg(F.round(F.avg(fscore) * 100, 4).alias("rougeL"), F.round(F.avg(F.size("p")), 4).alias("gen_len"), F.count("*").alias("pairs"))


def batch_similarity(df: DataFrame, batch: Column, id_col: str, vector: str, temperature: float = 0.05, block: int = BLOCK, loss: bool = True) -> DataFrame:
    """Per text the closest other text of its batch and the contrastive loss of the batch.

    Text i of n, by id, belongs with text (i + n/2) mod n. Batches may have any size: rows are numbered over the
    cluster and dealt over blocks of ``block`` rows, of more in large batches, so that a row is copied to ``SIDES``
    pairs of blocks or, beyond ``SIDES * MOST`` rows, to one per ``MOST`` rows. Each pair of blocks is one group's
    matrix products, ``STRIP`` rows at a time, and what a row brings home from each (its best, and its sum of
    exponents beside their largest) is merged. Without ``loss`` no exponents are taken. A null batch is a batch. A vector of zeros has the similarity 0 to all; rows whose vector is null or holds a null
    take no part; vectors of a batch have one length.
    """
    def score(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(others):
            return pd.DataFrame({c: [] for c in ("_rn", "batch", "_id", "nearest", "similarity", "_q", "_top", "_sum", "_partner")})
        own, others = own.sort_values("_rn"), others.sort_values("_rn")

        def unit(v: pd.Series) -> np.ndarray:
            x = np.stack(v.to_numpy()).astype(np.float64)
            return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)

        right, ids, theirs = unit(others["_v"]).T, others["_id"].to_numpy(), others["_rn"].to_numpy()
        left, every = unit(own["_v"]), own["_rn"].to_numpy()
        firsts, counts = own["_first"].to_numpy(), own["_n"].to_numpy()

        def strip(at: slice) -> pd.DataFrame:
            mine, rows = every[at], np.arange(len(every[at]))
            sim = left[at] @ right
            me = np.searchsorted(theirs, mine)
            here = (me < len(theirs)) & (theirs[np.minimum(me, len(theirs) - 1)] == mine)
            sim[rows[here], me[here]] = -np.inf
            best = sim.argmax(axis=1)
            most = sim[rows, best]
            some = np.isfinite(most)  # a batch of one has no other
            part = {
                "_rn": mine, "batch": own["batch"].to_numpy()[at], "_id": own["_id"].to_numpy()[at], "nearest": known(ids[best], some),
                "similarity": known(most, some), "_q": others["_q"].to_numpy()[0],
            }
            if not loss:
                return pd.DataFrame(part | {"_top": None, "_sum": None, "_partner": None})
            logits, top = sim / temperature, most / temperature
            total = np.exp(logits - np.where(some, top, 0)[:, None]).sum(axis=1)
            first, n = firsts[at], counts[at]
            wanted = first + (mine - first + n // 2) % n
            place = np.searchsorted(theirs, wanted)
            held = (place < len(theirs)) & (theirs[np.minimum(place, len(theirs) - 1)] == wanted) & (wanted != mine)
            partner = np.where(held, logits[rows, np.minimum(place, len(theirs) - 1)], np.nan)
            return pd.DataFrame(part | {"_top": known(top, some), "_sum": known(total, some), "_partner": known(partner, held)})

        def known(values, where):
            return [v if ok else None for v, ok in zip(values.tolist(), where)]

        return pd.concat([strip(slice(i, i + STRIP)) for i in range(0, len(left), STRIP)])

    sound = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull())
    rows = df.filter(sound).select(batch.cast("bigint").alias("batch"), F.col(id_col).cast("bigint").alias("_id"), F.col(vector).alias("_v"))
    numbered = number_rows(rows, ["batch", "_id"], "_rn")
    sizes = numbered.groupBy(F.col("batch").alias("_batch")).agg(F.min("_rn").alias("_first"), F.count("*").alias("_n"))
    placed = numbered.join(sizes, F.col("batch").eqNullSafe(F.col("_batch"))).drop("_batch")
    rows_of = F.greatest(F.lit(block), F.least(F.lit(MOST), F.ceil(F.col("_n") / SIDES)))
    inside = F.floor((F.col("_rn") - F.col("_first")) / rows_of)
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / rows_of)))
    left = placed.withColumn("_p", inside).withColumn("_q", all_blocks)
    right = placed.select(*[F.col(c).alias(c) for c in placed.columns]).withColumn("_q", inside).withColumn("_p", all_blocks)
    keys = ["_first", "_p", "_q"]
    schema = "_rn bigint, batch bigint, _id bigint, nearest bigint, similarity double, _q bigint, _top double, _sum double, _partner double"
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, schema)

    merged = parts.groupBy("_rn", "batch", "_id").agg(
        F.max_by(F.struct("nearest", "similarity"), F.struct("similarity", -F.col("_q"))).alias("_best"),
        F.collect_list(F.struct("_top", "_sum")).alias("_parts"),  # one per block of the batch
        F.max("_top").alias("_top"), F.max("_partner").alias("_partner"),
    )
    closest = merged.select("batch", F.col("_id").alias(id_col), "_best.nearest", "_best.similarity", "_top", "_parts", "_partner")
    if not loss:
        return closest.drop("_top", "_parts", "_partner")
    total = F.aggregate("_parts", F.lit(0.0), lambda t, x: t + F.coalesce(x["_sum"] * F.exp(x["_top"] - F.col("_top")), F.lit(0.0)))
    value = F.when(F.col("_top").isNotNull(), F.col("_top") + F.log(total) - F.col("_partner"))
    return closest.select("batch", id_col, "nearest", "similarity", value.alias("loss"))


def label_accuracy(gold: DataFrame, pred: DataFrame, doc: str) -> DataFrame:
    """Matched (text, type) pairs over the gold count per type; repeated pairs multiply.

    Rows carry the document, ``label_type`` and ``value``. Equal spans are counted first, so the
    multiplied pairs are a product of two counts and never listed.
    """

    def side(df: DataFrame, is_gold: int) -> DataFrame:
        return df.select(doc, "label_type", "value", F.lit(is_gold).alias("_g"), F.lit(1 - is_gold).alias("_p"))

    counted = side(gold, 1).unionByName(side(pred, 0)).groupBy(doc, "label_type", "value").agg(
        F.sum("_g").alias("g"), F.sum("_p").alias("p")
    )
    return (
        counted.groupBy("label_type")
        .agg(F.sum("g").alias("gold_count"), F.sum(F.col("g") * F.col("p")).alias("right_count"))
        .filter("gold_count > 0")
        .withColumn("accuracy", F.col("right_count") / F.col("gold_count"))
    )


def metrics_table(records: DataFrame) -> DataFrame:
    """Nested metric records as (task, date, item, metric, value) rows."""
    overall = records.select(
        "task",
        "date",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(item).alias("item"), F.lit(metric).alias("metric"), F.col(column).alias("value"))
                    for item, metric, column in (
                        ("总体", "p", "ents_p"),
                        ("总体", "r", "ents_r"),
                        ("总体", "f", "ents_f"),
                        ("速度", "speed", "speed"),
                    )
                ]
            )
        ).alias("m"),
    ).select("task", "date", "m.*")
    per_type = records.select("task", "date", F.explode("ents_per_type").alias("item", "_m")).select(
        "task", "date", "item", F.explode("_m").alias("metric", "value")
    )
    return overall.unionByName(per_type)
