"""Human against machine annotation: error classes, rule analysis, reviewed corrections.

Inputs are narrow span rows ``(doc, pos, start, end, label)`` of the two sides. Work is per document
through grouping and ordered windows; partners are found by position or type, never by pairing every
human span with every machine span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind, lower_bound, unnest
from noticeloom.operators.ranking import distinct_first
from noticeloom.operators.spans import span

HUMAN, MACHINE = "人", "机器"

# Names of the error classes.
WRONG_TYPE, WRONG_TYPE_ANSWER = "机器错标类别", "机器错标类别答案"
WRONG_PLACE, WRONG_PLACE_ANSWER = "机器错标位置", "机器错标位置答案"
MISSED_ANSWER, EXTRA, EXTRA_FIX = "机器漏标答案", "机器多标", "机器多标修正"
HUMAN_TWICE, MACHINE_TWICE = "人标签重复", "机器标签重复"
AI_MISSED, AI_EXTRA, AI_WRONG, AI_WRONG_PLACE, TWICE = "AI漏标", "AI多标", "AI错标", "AI错标位置", "手工重复标注"
TYPE_NOTE, KIND_NOTE = "错误类型", "错误种类"
REACH = 200  # characters shown on both sides of a span
NEAR_BY_POSITION = 10
NEAR_BY_TYPE = 5
# The messages of the rule analysis; {n} is the number of characters.
RULE_MESSAGES = {
    "label_back_space": "标签和预测结果相同，但是标签后面有空格",
    "machine_back_space": "标签和预测结果相同，但是预测后面有空格",
    "machine_front_space": "标签和预测结果相同，但是预测前面有空格",
    "label_front_space": "标签和预测结果相同，但是标签前面有空格",
    "other_place": "标签和预测结果相同，但是标注位置不同",
    "back_less": "预测后面少标{n}个字符",
    "back_more": "预测后面多标{n}个字符",
    "front_less": "预测前面少标{n}个字符",
    "front_more": "预测前面多标{n}个字符",
    "unknown": "未分析成功",
}

CHECKED_COLUMNS = ["task", "md5", "human_start", "human_end", "human_label", "ai_start", "ai_end", "ai_label", "label_type"]
HUMAN_COLUMNS = ["task", "md5", "human_start", "human_end", "human_label"]


def _stack(human: DataFrame, machine: DataFrame, doc: str) -> DataFrame:
    """Both sides stacked, each span marked with whether the other side has it too."""

    def side(df: DataFrame, is_human: int) -> DataFrame:
        return df.select(doc, "pos", "start", "end", "label", F.lit(is_human).alias("is_human"))

    both = side(human, 1).unionByName(side(machine, 0))
    same = Window.partitionBy(doc, "start", "end", "label")
    return both.withColumn("agreed", F.min("is_human").over(same) != F.max("is_human").over(same))


def _rows(df: DataFrame, doc: str, wrong_type: str | Column, labeler: str, start="start", end="end", label="label") -> DataFrame:
    kind = F.lit(wrong_type) if isinstance(wrong_type, str) else wrong_type
    return df.select(
        doc, kind.alias("wrong_type"), F.lit(labeler).alias("labeler"),
        F.col(start).alias("start"), F.col(end).alias("end"), F.col(label).alias("label"),
    )


def compare_by_position(human: DataFrame, machine: DataFrame, doc: str, near: int = NEAR_BY_POSITION) -> DataFrame:
    """A human span the machine lacks is held against the first machine span that starts at or after it.

    Where none does, the document's last machine span is used. Same borders: wrong type; starts less
    than ``near`` apart: wrong place; else missed. Machine spans neither agreed nor used are extra.
    """
    both = _stack(human, machine, doc)
    m = F.when(F.col("is_human") == 0, F.struct("start", "end", "label", "pos"))
    # Read backwards, machine spans before the human span of the same start, the first of equals last.
    backwards = (
        Window.partitionBy(doc)
        .orderBy(F.desc("start"), F.asc("is_human"), F.desc("pos"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    whole = Window.partitionBy(doc)
    matched = (
        both.withColumn("_m", m)
        .withColumn("_next", F.last("_m", ignorenulls=True).over(backwards))
        .withColumn("_last", F.max_by("_m", F.when(F.col("is_human") == 0, F.col("pos"))).over(whole))
        .withColumn("_hit", F.coalesce("_next", "_last"))
    )
    same_place = (F.col("start") == F.col("_hit.start")) & (F.col("end") == F.col("_hit.end"))
    kind = (
        F.when(F.col("_hit").isNull(), F.lit("missed"))
        .when(same_place, F.lit("type"))
        .when(F.abs(F.col("start") - F.col("_hit.start")) < near, F.lit("place"))
        .otherwise(F.lit("missed"))
    )
    lacking = matched.filter((F.col("is_human") == 1) & ~F.col("agreed")).withColumn("_kind", kind)
    used = lacking.filter(F.col("_kind") != "missed")
    answer = (
        F.when(F.col("_kind") == "type", F.lit(WRONG_TYPE_ANSWER))
        .when(F.col("_kind") == "place", F.lit(WRONG_PLACE_ANSWER))
        .otherwise(F.lit(MISSED_ANSWER))
    )
    machine_kind = F.when(F.col("_kind") == "type", F.lit(WRONG_TYPE)).otherwise(F.lit(WRONG_PLACE))
    held = used.select(doc, "_hit.start", "_hit.end", "_hit.label", F.lit(1).alias("_used")).distinct()
    extra = (
        both.filter((F.col("is_human") == 0) & ~F.col("agreed"))
        .join(held, [doc, "start", "end", "label"], "left_anti")
    )
    return (
        _rows(lacking, doc, answer, HUMAN)
        .unionByName(_rows(used, doc, machine_kind, MACHINE, "_hit.start", "_hit.end", "_hit.label"))
        .unionByName(_rows(extra, doc, EXTRA, MACHINE))
    )


def review_rows(rows: DataFrame, docs: DataFrame, doc: str, text: str = "text", reach: int = REACH, with_kind: bool = False) -> DataFrame:
    """Comparison rows with the text around the span and the span's place in it.

    ``text`` has ``reach`` characters on both sides and a last line that names the type, and the error class
    ``with_kind``; ``label`` holds the span moved into the window, ``s_start`` and ``s_end`` are the window's
    place in the document. Windows are cut inside the document's row; a row does not carry its document.
    """
    each = F.struct("wrong_type", "labeler", "start", "end", "label")
    listed = rows.groupBy(doc).agg(F.collect_list(each).alias("_rows"))

    def window(r: Column) -> Column:
        def cut(at: Column) -> Column:
            note = [F.lit("\n" + TYPE_NOTE), r["label"], *([F.lit(KIND_NOTE), r["wrong_type"]] if with_kind else [])]
            own = F.substr(F.col(text), at["s"] + 1, at["e"] - at["s"])
            return F.struct(
                r["wrong_type"].alias("wrong_type"), r["labeler"].alias("labeler"), r["label"].alias("label_type"),
                F.concat(own, *note).alias("text"), F.array(span(r["start"] - at["s"], r["end"] - at["s"], r["label"])).alias("label"),
                at["s"].alias("s_start"), at["e"].alias("s_end"),
            )

        place = F.struct(F.greatest(r["start"] - reach, F.lit(0)).alias("s"), F.least(r["end"] + reach, F.length(text)).alias("e"))
        return bind(place, cut)

    joined = docs.select(doc, text).join(listed, doc)
    return unnest(joined, [doc], F.transform("_rows", window), "_w").select(doc, "_w.*")


def compare_by_type(human: DataFrame, machine: DataFrame, doc: str) -> DataFrame:
    """A human span the machine lacks is held against the machine's first span of the same type.

    Repeats of a type on either side are reported, and machine spans neither agreed nor used.
    """
    both = _stack(human, machine, doc)
    typed = Window.partitionBy(doc, "label")
    first_machine = F.min_by(
        F.when(F.col("is_human") == 0, F.struct("start", "end", "label")), F.when(F.col("is_human") == 0, F.col("pos"))
    ).over(typed)
    nth = F.row_number().over(Window.partitionBy(doc, "label", "is_human").orderBy("pos"))
    marked = both.withColumns({"_hit": first_machine, "_nth": nth})
    lacking = marked.filter((F.col("is_human") == 1) & ~F.col("agreed"))
    placed, missed = lacking.filter(F.col("_hit").isNotNull()), lacking.filter(F.col("_hit").isNull())
    held = placed.select(doc, "_hit.start", "_hit.end", "_hit.label").distinct()
    extra = (
        both.filter((F.col("is_human") == 0) & ~F.col("agreed"))
        .join(held, [doc, "start", "end", "label"], "left_anti")
    )
    parts = [
        _rows(marked.filter("is_human = 1 AND _nth > 1"), doc, HUMAN_TWICE, HUMAN),
        _rows(marked.filter("is_human = 0 AND _nth > 1"), doc, MACHINE_TWICE, MACHINE),
        _rows(placed, doc, WRONG_PLACE, MACHINE, "_hit.start", "_hit.end", "_hit.label"),
        _rows(placed, doc, WRONG_PLACE_ANSWER, HUMAN),
        _rows(missed, doc, MISSED_ANSWER, HUMAN),
        _rows(extra, doc, EXTRA, MACHINE),
        _rows(extra, doc, EXTRA_FIX, HUMAN),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rule_analysis(h_start: Column, h_end: Column, h_text: Column, a_start: Column, a_end: Column, a_text: Column) -> Column:
    """How two spans of one text differ: white space at an edge, or so many characters at one side."""
    front, back = h_start - a_start, h_end - a_end

    def blank(column: Column) -> Column:
        return F.regexp_replace(column, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")

    def says(message: str, n: Column | None = None) -> Column:
        text = F.lit(RULE_MESSAGES[message])
        return text if n is None else F.replace(text, F.lit("{n}"), n.cast("string"))

    same_text = blank(h_text) == blank(a_text)
    by_space = (
        F.when((front == 0) & (back >= 1), says("label_back_space"))
        .when((front == 0) & (back <= -1), says("machine_back_space"))
        .when((front >= 1) & (back == 0), says("machine_front_space"))
        .when((front <= -1) & (back == 0), says("label_front_space"))
        .otherwise(says("other_place"))
    )

    return (
        F.when(same_text, by_space)
        .when((front == 0) & (back >= 1), says("back_less", back))
        .when((front == 0) & (back <= -1), says("back_more", -back))
        .when((front >= 1) & (back == 0), says("front_less", front))
        .when((front <= -1) & (back == 0), says("front_more", -front))
        .otherwise(says("unknown"))
    )


def comparison_report(human: DataFrame, machine: DataFrame, doc: str, near: int = NEAR_BY_TYPE) -> DataFrame:
    """Report rows per document and type: repeated by hand, missed, extra, wrong or misplaced.

    Span rows carry ``value`` (their text) as well. A wrong human span is shown with the machine span
    of its type that starts nearest to it; ``n_candidates`` says how many the machine has.
    :func:`comparison_blocks` lists them all.
    """

    def side(df: DataFrame, is_human: int) -> DataFrame:
        return df.select(doc, "pos", "start", "end", "label", "value", F.lit(is_human).alias("is_human"))

    def listed(is_human: int, *fields: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("is_human") == is_human, F.struct(*fields))))

    # One grouping brings a type's spans of a document together; all else is bisection in their lists, so a task
    # holds its spans once. Of machine spans with one start the first counts.
    both = side(human, 1).unionByName(side(machine, 0)).groupBy(doc, F.col("label").alias("label_type")).agg(
        listed(1, "pos", "start", "end", "value").alias("_h"), listed(0, "start", "pos", "end", "value").alias("_m")
    )
    first_of_start = F.filter("_m", lambda m, i: (i == 0) | (F.get(F.col("_m"), i - 1)["start"] != m["start"]))
    both = both.withColumns({"_near": first_of_start, "_places": F.sort_array(F.transform("_m", _place))})
    both = both.withColumn("_starts", F.transform("_near", lambda m: m["start"]))

    def nearest(start: Column) -> Column:
        def of(k: Column) -> Column:
            before, after = F.get(F.col("_near"), k - 1), F.get(F.col("_near"), k)
            closer = before.isNull() | (after["start"] - start < start - before["start"])
            return F.when(after.isNotNull() & closer, after).otherwise(before)

        return bind(lower_bound(F.col("_starts"), start), of)

    def agreed(h: Column) -> Column:
        return F.coalesce(F.get(F.col("_places"), lower_bound(F.col("_places"), _place(h))) == _place(h), F.lit(False))

    def report(kind: Column, h: Column | None, a: Column | None) -> Column:
        def field(of: Column | None, name: str, as_type: str) -> Column:
            return F.lit(None).cast(as_type) if of is None else of[name]

        return F.struct(
            kind.alias("wrong_type"),
            field(h, "start", "int").alias("human_start"),
            field(h, "end", "int").alias("human_end"),
            field(h, "value", "string").alias("human_label"),
            field(a, "start", "int").alias("ai_start"),
            field(a, "end", "int").alias("ai_end"),
            field(a, "value", "string").alias("ai_label"),
        )

    def held_against(h: Column) -> Column:
        def against(hit: Column) -> Column:
            kind = F.when(F.abs(hit["start"] - h["start"]) < near, F.lit(AI_WRONG_PLACE)).otherwise(F.lit(AI_WRONG))
            return report(kind, h, hit)

        return bind(nearest(h["start"]), against)

    no_machine, no_human = F.size("_m") == 0, F.size("_h") == 0

    def classes(h: Column, i: Column) -> Column:
        return F.array(
            F.when(i == 1, report(F.lit(TWICE), F.get(F.col("_h"), 0), h)),
            F.when(no_machine, report(F.lit(AI_MISSED), h, None)).when(~agreed(h), held_against(h)),
        )

    extra = F.transform(F.filter("_m", lambda _: no_human), lambda m: report(F.lit(AI_EXTRA), None, m))
    keep = [doc, "label_type", F.size("_m").cast("bigint").alias("n_candidates")]
    rows = unnest(both, keep, F.concat(F.flatten(F.transform("_h", classes)), extra), "_r").select(doc, "label_type", "_r.*", "n_candidates")
    analysis = rule_analysis(*(F.col(f"{who}_{what}") for who in ("human", "ai") for what in ("start", "end", "label")))
    alone = F.col("wrong_type").isin(AI_MISSED, AI_EXTRA)
    shown = rows.withColumn("rule_analysis", F.when(alone, F.col("wrong_type")).otherwise(analysis))
    return shown.select(*[c for c in rows.columns if c != "n_candidates"], "rule_analysis", "n_candidates")


def _place(span_: Column) -> Column:
    """Start and end of a span as one number."""
    return span_["start"].cast("bigint") * (1 << 32) + span_["end"]


def comparison_blocks(human: DataFrame, machine: DataFrame, doc: str) -> DataFrame:
    """Per document and type with a wrong human span: all its wrong human spans and all machine spans.

    Every human span of ``human_spans`` has every span of ``machine_spans`` as a candidate; the two lists
    say so in the size of the spans, where rows of pairs would take their product.
    """
    spans = [F.struct("start", "end", "value").alias("span"), "label", "start", "end"]
    both = human.select(doc, *spans, F.lit(1).alias("is_human")).unionByName(machine.select(doc, *spans, F.lit(0).alias("is_human")))
    same = Window.partitionBy(doc, "start", "end", "label")
    agreed = F.min("is_human").over(same) != F.max("is_human").over(same)
    wrong = F.when((F.col("is_human") == 1) & ~F.col("agreed"), F.col("span"))
    listed = both.withColumn("agreed", agreed).groupBy(doc, F.col("label").alias("label_type")).agg(
        F.sort_array(F.collect_list(wrong)).alias("human_spans"),
        F.sort_array(F.collect_list(F.when(F.col("is_human") == 0, F.col("span")))).alias("machine_spans"),
    )
    return listed.filter((F.size("human_spans") > 0) & (F.size("machine_spans") > 0))


def row_fingerprint(columns: list[str]) -> Column:
    """md5 of columns as text, kept apart by a separator, null as empty."""
    return F.md5(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def with_fingerprints(df: DataFrame) -> DataFrame:
    return df.withColumns({"checked_md5": row_fingerprint(CHECKED_COLUMNS), "human_md5": row_fingerprint(HUMAN_COLUMNS)})


def merge_reviewed(registry: DataFrame, reviewed: DataFrame, order: list[str]) -> DataFrame:
    """Rows reviewed as correct joined to the registry, one per fingerprint, the registry's first."""
    fresh = with_fingerprints(reviewed).filter(F.upper("is_human_correct") == "Y")
    stacked = registry.withColumn("_src", F.lit(0)).unionByName(fresh.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return distinct_first(stacked, ["checked_md5"], ["_src", *order]).drop("_src")


def with_review_flags(report: DataFrame, registry: DataFrame, order: str) -> DataFrame:
    """Review answers looked up by human and by checked fingerprint, the registry's first match."""

    def first_answer(key: str, name: str) -> DataFrame:
        return registry.groupBy(F.col(key)).agg(F.min_by("is_human_correct", order).alias(name))

    rows = with_fingerprints(report.drop("is_human_correct", "is_checked"))
    return rows.join(first_answer("human_md5", "is_human_correct"), "human_md5", "left").join(
        first_answer("checked_md5", "is_checked"), "checked_md5", "left"
    )


def apply_corrections(df: DataFrame, fixes: DataFrame, id_col: str, label="label", kinds: list[str] | None = None) -> DataFrame:
    """Reviewed answers into the corpus: the first span of ``label_type`` is deleted or replaced.

    A fix has (id, wrong_type, label_type, new_start, new_end); null borders delete the span.
    """
    kinds = kinds or [HUMAN_TWICE, WRONG_PLACE_ANSWER, MISSED_ANSWER, EXTRA_FIX]
    chosen = (
        fixes.filter(F.col("wrong_type").isin(kinds))
        .groupBy(F.col(id_col).alias("_id"), "label_type")
        .agg(F.min(F.struct("new_start", "new_end")).alias("_f"))
        .groupBy("_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("label_type", "_f"))).alias("_fixes"))
    )
    spans = F.col(label)
    labels = F.filter(F.transform(spans, lambda s: s["label"]), lambda name: name.isNotNull())
    kinds_of = F.array_distinct(labels)
    # The first place of each type, found once per type and not once per span.
    first = bind(
        F.transform(spans, lambda s: s["label"]),
        lambda own: bind(kinds_of, lambda names: F.map_from_arrays(names, F.transform(names, lambda k: F.array_position(own, k).cast("int") - 1))),
    )

    def corrected(places: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            fix = F.element_at(F.col("_fixes"), s["label"])
            return (
                F.when(fix.isNull() | (F.element_at(places, s["label"]) != i), s)
                .when(fix["new_start"].isNull(), F.lit(None))
                .otherwise(span(fix["new_start"], fix["new_end"], s["label"]))
            )

        return F.filter(F.transform(spans, one), lambda s: s.isNotNull())

    joined = df.join(chosen, df[id_col] == chosen["_id"], "left")
    fixed = bind(first, corrected)
    return joined.withColumn(label, F.when(F.col("_fixes").isNull(), spans).otherwise(fixed)).drop("_id", "_fixes")
