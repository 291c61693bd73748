"""Counts, filters, unions, categories and registries of annotated corpora."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import unnest
from noticeloom.operators.ranking import balance_and_split, distinct_first, hash_order, sample_by_hash, split_by_hash

NEEDED, NOT_NEEDED, OTHER = "需要", "不需要", "其他"
TARGET_LABELS = ["报名开始时间", "报名结束时间", "预算", "开标时间"]
TAG_THRESHOLD = 0.7
SAMPLE_THRESHOLD = 0.9
SAMPLE_MIN_LENGTH = 500

# Districts and wording of the residence notices.
RESIDENCE = r"居住于(锦江区|青羊区|双流区|龙泉驿区|新都区|金牛区|温江区|高新区|成华区|天府新区|武侯区)(.*?)，系(.*?)。"


def label_counts(df: DataFrame, label="label") -> DataFrame:
    """Spans per label type."""
    return unnest(df, [], F.transform(label, lambda s: s["label"]), "label_type").groupBy("label_type").count()


def category_counts(df: DataFrame, cats="cats") -> DataFrame:
    """Documents per positive category."""
    return df.select(F.explode(cats).alias("cat", "flag")).filter(F.col("flag") > 0).groupBy("cat").count()


def group_counts(df: DataFrame, keys: list[str], counted: str, name: str = "n") -> DataFrame:
    """Non-null values per group."""
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, most frequent first."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column)


def joined_labels(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Distinct labels of a group as one comma-separated text, sorted.

    Equal labels collapse before the shuffle, so the group holds the label set and not its rows.
    """
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(label)), ",").alias(label))


def split_labels(text: Column) -> Column:
    return F.sort_array(F.array_distinct(F.split(text, ",")))


def ids_by_file(df: DataFrame, file: str, id_col: str, block: int = 1000) -> DataFrame:
    """Ids listed by file in blocks of ``block`` consecutive ids, so no list grows with a file."""
    return (
        df.groupBy(file, F.floor(F.col(id_col) / block).alias("block"))
        .agg(F.sort_array(F.collect_list(id_col)).alias("ids"))
    )


def rows_of_files(df: DataFrame, listed: DataFrame, file: str, id_col: str) -> DataFrame:
    """Rows whose (file, id) is listed."""
    wanted = listed.select(file, F.explode("ids").alias(id_col))
    return df.join(wanted, [file, id_col], "left_semi")


def residence_records(df: DataFrame, date: str, text: str, pattern: str = RESIDENCE) -> DataFrame:
    """District, estate and circumstance of each matching line."""
    lines = unnest(df, [F.col(date).alias("date")], F.split(text, "\n"), "line").filter(F.col("line").rlike(pattern))
    return lines.select(
        "date", *[F.regexp_extract("line", pattern, i + 1).alias(name) for i, name in enumerate(("district", "estate", "circumstance"))]
    )


def best_category(cats: Column) -> Column:
    """Category with the highest score, the first of equals."""
    ranked = F.transform(F.map_entries(cats), lambda e, i: F.struct(e["value"].alias("v"), (-i).alias("i"), e["key"].alias("k")))
    return F.array_max(ranked)["k"]


def tags_above(cats: Column, threshold: float = TAG_THRESHOLD) -> Column:
    """Categories scored above the threshold, or the catch-all one."""
    hits = F.map_keys(F.map_filter(cats, lambda _, v: v > threshold))
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(OTHER)))


def one_hot(labels: Column, universe: list[str] | Column) -> Column:
    """0/1 per category of the universe, a list or an array column."""
    names = universe if isinstance(universe, Column) else F.array(*[F.lit(u) for u in universe])
    return F.map_from_arrays(names, F.transform(names, lambda u: F.array_contains(labels, u).cast("int")))


def label_universe(df: DataFrame, label: str) -> Column:
    """The distinct labels of a column in order, as an array to add to each row; nothing comes to the driver."""
    return df.agg(F.array_sort(F.collect_set(label))).scalar()


def need_cats(flag: Column) -> Column:
    yes = F.coalesce(flag, F.lit(False)).cast("int")
    return F.create_map(F.lit(NEEDED), yes, F.lit(NOT_NEEDED), 1 - yes)


def cats_by_label(spans: Column, targets: list[str] = TARGET_LABELS) -> Column:
    """Needed when any span has a target label."""
    return need_cats(F.exists(spans, lambda s: s["label"].isin(targets)))


def cats_by_disagreement(human: Column, machine: Column) -> Column:
    """Needed when the two span sets differ in either direction."""

    def keys(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws("|", s["start"], s["end"], s["label"]))

    a, b = keys(human), keys(machine)
    return need_cats((F.size(F.array_except(a, b)) > 0) | (F.size(F.array_except(b, a)) > 0))


def cats_by_error(df: DataFrame, report: DataFrame, key: str, wrong_types: list[str]) -> DataFrame:
    """Needed when the document has a report row of one of the given error types."""
    hit = report.filter(F.col("wrong_type").isin(wrong_types)).groupBy(key).agg(F.lit(True).alias("_hit"))
    return df.join(hit, key, "left").withColumn("cats", need_cats(F.col("_hit"))).drop("_hit")


def category_splits(df: DataFrame, key: str, seed: str, cats="cats", share: float = 0.8) -> DataFrame:
    """Balanced needed / not needed classes, split into train and dev."""
    flagged = df.withColumn("_need", F.element_at(F.col(cats), NEEDED))
    return balance_and_split(flagged, key, "_need", share, seed, "dataset").drop("_need")


def upload_columns(df: DataFrame, labels: list[str], text="text", label="label") -> DataFrame:
    """Upload form: text with its md5 mark, span count and the joined texts per label."""
    from noticeloom.functions.text import add_md5_mark

    def values(name: str) -> Column:
        own = F.filter(label, lambda s: s["label"] == name)
        return F.array_join(F.transform(own, lambda s: F.substr(F.col(text), s["start"] + 1, s["end"] - s["start"])), ",")

    columns = {name: values(name) for name in labels}
    return df.withColumns({"label_counts": F.size(label), **columns}).withColumn(text, add_md5_mark(F.col(text), F.col("md5")))


def export_columns(df: DataFrame, labels: list[str], text="text") -> DataFrame:
    """Back from the upload form."""
    from noticeloom.functions.text import drop_md5_mark

    return df.drop("label_counts", *labels).withColumn(text, drop_md5_mark(F.col(text)))


def project_id(dataset: Column, train_id: int, dev_id: int) -> Column:
    """Project of a dataset name ``task_train`` / ``task_dev``."""
    part = F.get(F.split(dataset, "_"), 1)
    return F.when(part == "train", F.lit(train_id)).when(part == "dev", F.lit(dev_id)).otherwise(F.lit(0))


def document_url(base: str, project: Column, md5: Column, kind: str = "sequence-labeling") -> Column:
    return F.concat(F.lit(base + "/projects/"), project.cast("string"), F.lit(f"/{kind}?page=1&q="), md5)


def table_task(table: Column) -> Column:
    """Task of a table name: result tables hold bids, others tenders."""
    return F.when(F.contains(table, F.lit("result")), F.lit("bid")).otherwise(F.lit("tender"))


def origin_table(table: Column) -> Column:
    return F.replace(table, F.lit("final"), F.lit("test"))


def keys_of_maps(df: DataFrame, column: str) -> DataFrame:
    """Union of the keys of a map column."""
    return unnest(df, [], F.map_keys(column), "key").distinct()


def tag_columns(df: DataFrame, key: str, label: str) -> DataFrame:
    """Category list joined by commas beside the key."""
    return df.select(key, F.array_join(label, ",").alias("cats"))


def summary_pairs(df: DataFrame, source: str, target: str, prefix: str, limit: int | None = None, order: str | None = None) -> DataFrame:
    """Text pairs without nulls, the source prefixed; optionally only the first ``limit``."""
    pairs = df.filter(F.col(source).isNotNull() & F.col(target).isNotNull() & (F.col(source) != "") & (F.col(target) != ""))
    pairs = pairs.withColumn(source, F.concat(F.lit(prefix), source))
    return pairs.orderBy(order).limit(limit) if limit else pairs


def length_between(df: DataFrame, text: str, low: int, high: int) -> DataFrame:
    return df.withColumn("len", F.length(text)).filter((F.col("len") > low) & (F.col("len") < high))


def labelled_only(df: DataFrame, label="label") -> DataFrame:
    return df.filter(F.size(label) > 0)


def keyword_labels(df: DataFrame, rules: list[tuple[str, str]], columns: list[str], keep: list[str]) -> DataFrame:
    """One row per (document, label, column) whose column holds a keyword of the label."""
    hits = [
        F.when(F.contains(F.col(c), F.lit(word)), F.struct(F.lit(label).alias("label"), F.lit(c).alias("column"), F.lit(word).alias("keyword")))
        for label, word in rules
        for c in columns
    ]
    return unnest(df, keep, F.array_compact(F.array(*hits)), "_h").select(*keep, "_h.*")


def without_keywords(df: DataFrame, rules: list[tuple[str, str]], column: str) -> DataFrame:
    """Rows that hold none of the keywords."""
    hit = reduce(lambda a, b: a | b, [F.contains(F.col(column), F.lit(word)) for _, word in rules])
    return df.filter(~hit)


def train_dev_union(train: DataFrame, dev: DataFrame, task: str) -> DataFrame:
    """Both parts with dataset and task columns."""
    return (
        train.withColumn("dataset", F.lit(f"{task}_train"))
        .unionByName(dev.withColumn("dataset", F.lit(f"{task}_dev")), allowMissingColumns=True)
        .withColumn("task", F.lit(task))
    )


def combine(datasets: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), datasets)


def replace_task(registry: DataFrame, fresh: DataFrame, task: str) -> DataFrame:
    """A registry with the rows of ``task`` replaced."""
    return registry.filter(F.col("task").isNull() | (F.col("task") != task)).unionByName(fresh, allowMissingColumns=True)


def of_dataset(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("dataset") == name)


def of_task(df: DataFrame, task: str, column: str = "task", part: bool = False) -> DataFrame:
    return df.filter(F.contains(F.col(column), F.lit(task)) if part else F.col(column) == task)


def add_to_registry(registry: DataFrame, fresh: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Registry and new rows, one per key, the registry's own first."""
    stacked = registry.withColumn("_src", F.lit(0)).unionByName(fresh.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return distinct_first(stacked, [key], ["_src", *order]).drop("_src")


def model_sample(df: DataFrame, key: str, score: str, text: str, n: int, seed: str) -> DataFrame:
    """``n`` long documents with a high score, in hash order."""
    picked = df.filter((F.col(score) >= SAMPLE_THRESHOLD) & (F.length(text) > SAMPLE_MIN_LENGTH))
    return sample_by_hash(picked, key, n, seed)


def spot_check(df: DataFrame, key: str, n: int, seed: str, text="text", label="label") -> DataFrame:
    """One span each of ``n`` documents, both drawn by hash."""
    drawn = F.array_min(
        F.transform(label, lambda s: F.struct(F.md5(F.concat_ws("|", F.lit(seed), s["start"], s["end"], s["label"])).alias("h"), s.alias("s")))
    )["s"]
    docs = sample_by_hash(labelled_only(df, label), key, n, seed)
    return docs.select(key, text, drawn.alias("_s")).select(
        key, F.expr(f"substring({text}, _s.start + 1, _s.end - _s.start)").alias("value"), F.col("_s.label").alias("label")
    )


def annotated_import(df: DataFrame, spans: Column, key: str, task: str, registry: DataFrame, seed: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Annotate, split, mark for export and renew the task's registry rows: (corpus, registry)."""
    annotated = df.withColumn("label", spans)
    parted = split_by_hash(annotated, key, share, seed, "dataset", (f"{task}_train", f"{task}_dev")).withColumn("task", F.lit(task))
    return parted, replace_task(registry, parted.select(*registry.columns), task)


def same_answer(human: Column, machine: Column, ordered: bool = True) -> Column:
    """Whether two label lists agree, as lists or as sets."""
    return (human == machine) if ordered else (F.sort_array(F.array_distinct(human)) == F.sort_array(F.array_distinct(machine)))


def in_hash_order(df: DataFrame, key: str, seed: str) -> DataFrame:
    """The whole table in a fixed random order."""
    return df.withColumn("_h", hash_order(F.col(key), seed)).orderBy("_h").drop("_h")
