"""Queries of counts, categories, sampling, registries and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import text as T
from noticeloom.operators import curate as C
from noticeloom.operators import lookup as L
from noticeloom.operators import ranking as K
from noticeloom.operators import spans as S
from noticeloom.operators.intervals import overlap_totals
from noticeloom.operators.notices import ROUTES, routes, tag_routes
from noticeloom.plans.catalog import query, table
from noticeloom.plans.data import GOLD, PRED, SEED, annotated, documents, spans_sql
from noticeloom.plans.q_clean import fractions
from noticeloom.plans.q_spans import GOLD_SQL

BOTH = f"WITH {spans_sql(GOLD, 'gold')}, {spans_sql(PRED, 'pred')}"
LANGS = ["de", "en", "es", "fr", "it"]
KEYWORDS = [("施工", "this"), ("施工", "pour"), ("监理", "nicht"), ("设计", "avec"), ("EPC", "with the")]
KEYWORD_SQL = "k(label, word) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in KEYWORDS) + ")"


@query("agg1_label_counts", f"{GOLD_SQL} SELECT label AS label_type, count(*) AS count FROM spans GROUP BY 1")
def agg1(spark, folder):
    return C.label_counts(annotated(spark, folder))


def _cats(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return docs.withColumn("cats", C.one_hot(F.array(F.col("lang"), F.when(F.col("n_chars") > 2000, F.lit("it"))), LANGS))


@query(
    "agg2_category_counts",
    "SELECT lang AS cat, count(*) AS count FROM documents GROUP BY 1 UNION ALL SELECT 'it', count(*) FROM documents WHERE n_chars > 2000",
)
def agg2(spark, folder):
    return C.category_counts(_cats(spark, folder))


@query(
    "prj24_one_hot",
    """SELECT doc_id, (lang = 'de')::INT AS de, (lang = 'en')::INT AS en, (lang = 'es')::INT AS es, (lang = 'fr')::INT AS fr FROM documents""",
)
def prj24(spark, folder):
    docs = table(spark, folder, "documents")
    known = docs.withColumn("universe", C.label_universe(docs, "lang"))
    hot = known.select("doc_id", C.one_hot(F.array("lang"), F.col("universe")).alias("cats"))
    return hot.select("doc_id", *[F.element_at("cats", c).alias(c) for c in ("de", "en", "es", "fr")])


@query("prj28_key_discovery", "SELECT DISTINCT lang AS key FROM documents UNION SELECT DISTINCT source FROM documents")
def prj28(spark, folder):
    entries = table(spark, folder, "documents").select(F.create_map("lang", F.lit(1), "source", F.lit(1)).alias("m"))
    return C.keys_of_maps(entries, "m")


@query("agg4_value_counts", "SELECT source, count(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY 1")
def agg4(spark, folder):
    return C.value_counts(table(spark, folder, "documents"), "source")


@query(
    "agg5_joined_labels",
    f"""WITH {KEYWORD_SQL} SELECT doc_id, string_agg(label, ',' ORDER BY label) AS label FROM (SELECT DISTINCT d.doc_id, k.label FROM documents d JOIN k ON contains(d.text, k.word)) GROUP BY 1""",
)
def agg5(spark, folder):
    hits = C.keyword_labels(documents(spark, folder), KEYWORDS, ["text"], ["doc_id"])
    return C.joined_labels(hits, ["doc_id"], "label")


@query(
    "agg6_ids_by_file",
    "SELECT source, doc_id // 1000 AS block, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY 1, 2",
)
def agg6(spark, folder):
    listed = C.ids_by_file(table(spark, folder, "documents").select("source", "doc_id"), "source", "doc_id")
    return listed.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query("agg6_rows_of_files", "SELECT doc_id, source, md5(text) AS md5 FROM documents WHERE lang = 'en'")
def agg6_rows(spark, folder):
    docs = documents(spark, folder)
    listed = C.ids_by_file(docs.filter("lang = 'en'").select("source", "doc_id"), "source", "doc_id")
    return C.rows_of_files(docs, listed, "source", "doc_id").select("doc_id", "source", F.md5("text").alias("md5"))


@query(
    "agg7_completion",
    """WITH p AS (SELECT 'tender' AS task, 'orders' AS origin, 'lineitem' AS target, (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS t, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS d
UNION ALL SELECT 'bid', 'documents', 'labels', (SELECT count(*) FROM documents), (SELECT count(*) FROM labels), (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
UNION ALL SELECT 'bid', 'customer', 'orders', (SELECT count(*) FROM customer), (SELECT count(*) FROM orders), (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))),
a AS (SELECT * FROM p UNION ALL SELECT task, task || '_test_total', task || '_final_total', sum(o), sum(t), sum(d) FROM p GROUP BY task)
SELECT task, origin, target, CAST(o AS BIGINT) AS origin_count, CAST(t AS BIGINT) AS target_count, CAST(d AS BIGINT) AS a_not_b, CAST(o - t AS BIGINT) AS diff, t::DOUBLE / o AS ratio FROM a""",
)
def agg7(spark, folder):
    def ids(name: str, column: str) -> DataFrame:
        return table(spark, folder, name).select(F.col(column).alias("id"))

    return L.completion(
        [
            ("tender", "orders", "lineitem", ids("orders", "o_orderkey"), ids("lineitem", "l_orderkey")),
            ("bid", "documents", "labels", ids("documents", "doc_id"), ids("labels", "doc_id")),
            ("bid", "customer", "orders", ids("customer", "c_custkey"), ids("orders", "o_custkey")),
        ]
    )


ANSWERS = """h AS (SELECT doc_id, string_agg(label, ',' ORDER BY pos) AS a, string_agg(DISTINCT label, ',' ORDER BY label) AS s FROM gold GROUP BY 1),
m AS (SELECT doc_id, string_agg(label, ',' ORDER BY pos) AS a, string_agg(DISTINCT label, ',' ORDER BY label) AS s FROM pred GROUP BY 1)"""


@query(
    "agg9_same_answer",
    f"""{BOTH}, {ANSWERS} SELECT d.doc_id, coalesce(h.a, '') = coalesce(m.a, '') AS is_same, coalesce(h.s, '') = coalesce(m.s, '') AS is_same_set FROM documents d LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)""",
)
def agg9(spark, folder):
    docs = annotated(spark, folder).withColumn("ai", S.phrase_spans(F.col("text"), PRED))
    names = docs.select(
        "doc_id", F.transform("label", lambda s: s["label"]).alias("h"), F.transform("ai", lambda s: s["label"]).alias("m")
    )
    return names.select(
        "doc_id",
        C.same_answer(F.col("h"), F.col("m")).alias("is_same"),
        C.same_answer(F.col("h"), F.col("m"), False).alias("is_same_set"),
    )


SCORE_SQL = "(CAST(('0x' || substring(md5({0} || source), 1, 2)) AS INTEGER) / 255.0::DOUBLE)"
CAT_NAMES = ["货物", "工程", "服务"]


def category_scores(df: DataFrame, source: str = "source") -> DataFrame:
    """Category scores of a document, from its source."""

    def score(name: str) -> F.Column:
        return F.conv(F.substring(F.md5(F.concat(F.lit(name), F.col(source))), 1, 2), 16, 10).cast("double") / 255

    return df.withColumn("cats", F.create_map(*[x for n in CAT_NAMES for x in (F.lit(n), score(n))]))


@query(
    "agg10_best_category",
    f"""WITH s AS (SELECT doc_id, {', '.join(SCORE_SQL.format("'" + n + "'") + f' AS s{i}' for i, n in enumerate(CAT_NAMES))} FROM documents)
SELECT doc_id, CASE WHEN s0 >= s1 AND s0 >= s2 THEN '货物' WHEN s1 >= s2 THEN '工程' ELSE '服务' END AS classify_type,
 CASE WHEN s0 > 0.7 OR s1 > 0.7 OR s2 > 0.7 THEN concat_ws(',', CASE WHEN s0 > 0.7 THEN '货物' END, CASE WHEN s1 > 0.7 THEN '工程' END, CASE WHEN s2 > 0.7 THEN '服务' END) ELSE '其他' END AS tags FROM s""",
)
def agg10(spark, folder):
    docs = category_scores(table(spark, folder, "documents").select("doc_id", "source"))
    return docs.select(
        "doc_id", C.best_category(F.col("cats")).alias("classify_type"), F.array_join(C.tags_above(F.col("cats")), ",").alias("tags")
    )


@query(
    "prj25_cats_by_label",
    f"{GOLD_SQL} SELECT d.doc_id, (EXISTS (SELECT 1 FROM spans s WHERE s.doc_id = d.doc_id AND s.label IN ('报名开始时间', '报名结束时间', '预算', '开标时间')))::INT AS need FROM documents d",
)
def prj25(spark, folder):
    docs = annotated(spark, folder)
    return docs.select("doc_id", F.element_at(C.cats_by_label(F.col("label")), C.NEEDED).alias("need"))


DIFFER = """diff AS (SELECT doc_id FROM (SELECT doc_id, "start", "end", label FROM gold EXCEPT SELECT doc_id, "start", "end", label FROM pred) UNION SELECT doc_id FROM (SELECT doc_id, "start", "end", label FROM pred EXCEPT SELECT doc_id, "start", "end", label FROM gold))"""


@query("prj25_cats_by_disagreement", f"{BOTH}, {DIFFER} SELECT doc_id, (doc_id IN (SELECT doc_id FROM diff))::INT AS need FROM documents")
def prj25_disagreement(spark, folder):
    docs = annotated(spark, folder).withColumn("ai", S.phrase_spans(F.col("text"), PRED))
    cats = C.cats_by_disagreement(F.col("label"), F.col("ai"))
    return docs.select("doc_id", F.element_at(cats, C.NEEDED).alias("need"))


@query(
    "prj25_cats_by_error",
    f"""{BOTH}, np AS (SELECT DISTINCT doc_id, label FROM pred) SELECT doc_id, (doc_id IN (SELECT g.doc_id FROM gold g ANTI JOIN np ON np.doc_id = g.doc_id AND np.label = g.label))::INT AS need FROM documents""",
)
def prj25_error(spark, folder):
    from noticeloom.operators.compare import AI_MISSED
    from noticeloom.plans.q_evaluate import cmp3

    docs = C.cats_by_error(table(spark, folder, "documents").select("doc_id"), cmp3(spark, folder), "doc_id", [AI_MISSED])
    return docs.select("doc_id", F.element_at("cats", C.NEEDED).alias("need"))


@query(
    "prj27_table_names",
    "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'bid' ELSE 'tender' END AS task, 'test_' || source || CASE WHEN doc_id % 2 = 0 THEN '_result' ELSE '' END AS origin FROM documents",
)
def prj27(spark, folder):
    name = F.concat(F.lit("final_"), "source", F.when(F.col("doc_id") % 2 == 0, F.lit("_result")).otherwise(F.lit("")))
    return table(spark, folder, "documents").select("doc_id", C.table_task(name).alias("task"), C.origin_table(name).alias("origin"))


@query(
    "prj31_tag_columns",
    f"{GOLD_SQL} SELECT md5(d.text) AS md5, count(*) AS n, max(t.cats) AS cats FROM documents d LEFT JOIN (SELECT doc_id, string_agg(label, ',' ORDER BY pos) AS cats FROM spans GROUP BY 1) t USING (doc_id) GROUP BY 1",
)
def prj31(spark, folder):
    docs = annotated(spark, folder).select(T.fingerprint(F.col("text")).alias("md5"), F.transform("label", lambda s: s["label"]).alias("label"))
    tags = C.tag_columns(docs, "md5", "label")
    return tags.groupBy("md5").agg(F.count("*").alias("n"), F.nullif(F.max("cats"), F.lit("")).alias("cats"))


ROUTE_SQL = "r(origin, target, task) AS (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in ROUTES) + ")"
NAMES = [a for a, _, _ in ROUTES] + ["test_unknown"]


@query(
    "prj32_routed_rows",
    f"WITH {ROUTE_SQL}, d AS (SELECT doc_id, {NAMES!r}[doc_id % 10 + 1] AS origin FROM documents) SELECT d.doc_id, r.target, r.task, r.task || 'cats' AS tag_task FROM d JOIN r USING (origin)",
)
def prj32(spark, folder):
    name = F.get(F.array(*[F.lit(n) for n in NAMES]), (F.col("doc_id") % 10).cast("int"))
    docs = table(spark, folder, "documents").select("doc_id", name.alias("origin"))
    tagged = tag_routes(spark).withColumnsRenamed({"table": "target", "task": "tag_task"})
    return docs.join(F.broadcast(routes(spark)), "origin").join(F.broadcast(tagged), "target").select("doc_id", "target", "task", "tag_task")


@query("flt2_labelled_only", f"{GOLD_SQL} SELECT DISTINCT doc_id FROM spans")
def flt2(spark, folder):
    return C.labelled_only(annotated(spark, folder)).select("doc_id")


@query(
    "flt3_keyword_labels",
    f"""WITH {KEYWORD_SQL} SELECT d.doc_id, k.label, c.name AS "column", k.word AS keyword FROM documents d, k, (VALUES ('text'), ('source')) c(name) WHERE contains(CASE c.name WHEN 'text' THEN d.text ELSE d.source END, k.word)""",
)
def flt3(spark, folder):
    return C.keyword_labels(documents(spark, folder), KEYWORDS, ["text", "source"], ["doc_id"])


@query(
    "flt3_without_keywords",
    f"WITH {KEYWORD_SQL} SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM k WHERE contains(d.text, k.word))",
)
def flt3_none(spark, folder):
    return C.without_keywords(documents(spark, folder), KEYWORDS, "text").select("doc_id")


@query(
    "set1_train_dev_union",
    "SELECT doc_id, CASE WHEN lang <> 'en' THEN 'tender_dev' ELSE 'tender_train' END AS dataset, 'tender' AS task FROM documents",
)
def set1(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return C.train_dev_union(docs.filter("lang = 'en'"), docs.filter("lang <> 'en'"), "tender").drop("lang")


@query(
    "set2_replace_task",
    "SELECT doc_id, lang AS task, n_chars FROM documents WHERE lang <> 'en' UNION ALL SELECT d.doc_id, 'en', l.quality FROM documents d JOIN labels l USING (doc_id) WHERE lang = 'en'",
)
def set2(spark, folder):
    registry = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("task"), "n_chars")
    fresh = registry.filter("task = 'en'").join(table(spark, folder, "labels"), "doc_id").select(
        "doc_id", "task", F.col("quality").cast("bigint").alias("n_chars")
    )
    return C.replace_task(registry, fresh, "en")


@query("set3_of_dataset", "SELECT doc_id, 'tender_train' AS dataset FROM documents WHERE lang = 'en'")
def set3(spark, folder):
    return C.of_dataset(set1(spark, folder), "tender_train").select("doc_id", "dataset")


CUT_SQL = "WITH r AS (SELECT *, row_number() OVER (ORDER BY md5('{seed}' || doc_id)) AS rn, count(*) OVER () AS n FROM documents)"


@query("sam1_exact_split", CUT_SQL.format(seed=SEED) + " SELECT doc_id, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'dev' END AS part FROM r")
def sam1(spark, folder):
    return K.split_by_hash(table(spark, folder, "documents").select("doc_id"), "doc_id", 0.8, SEED)


@query(
    "sam1_share_split",
    f"SELECT doc_id, CASE WHEN CAST(('0x' || substring(md5('{SEED}' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.7 THEN 'train' ELSE 'dev' END AS part FROM documents",
)
def sam1_share(spark, folder):
    return K.split_by_share(table(spark, folder, "documents").select("doc_id"), "doc_id", 0.7, SEED)


@query("sam1_sample", f"SELECT doc_id FROM documents ORDER BY md5('{SEED}' || doc_id) LIMIT 100")
def sam1_sample(spark, folder):
    return K.sample_by_hash(table(spark, folder, "documents").select("doc_id"), "doc_id", 100, SEED)


@query(
    "sam2_balance_and_split",
    f"""WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('{SEED}' || doc_id)) AS rn FROM labels), m AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM labels GROUP BY quality))
SELECT doc_id, quality, CASE WHEN rn <= floor(m * 0.8::DOUBLE) THEN 'train' ELSE 'dev' END AS part FROM r, m WHERE rn <= m""",
)
def sam2(spark, folder):
    return K.balance_and_split(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.8, SEED)


@query(
    "sam2_category_splits",
    f"""{GOLD_SQL}, f AS (SELECT doc_id, (doc_id IN (SELECT doc_id FROM spans WHERE label = '开标时间'))::INT AS need FROM documents),
r AS (SELECT doc_id, need, row_number() OVER (PARTITION BY need ORDER BY md5('{SEED}' || doc_id)) AS rn FROM f), m AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM f GROUP BY need))
SELECT doc_id, need, CASE WHEN rn <= floor(m * 0.8::DOUBLE) THEN 'train' ELSE 'dev' END AS dataset FROM r, m WHERE rn <= m""",
)
def sam2_categories(spark, folder):
    docs = annotated(spark, folder).select("doc_id", C.cats_by_label(F.col("label")).alias("cats"))
    return C.category_splits(docs, "doc_id", SEED).select("doc_id", F.element_at("cats", C.NEEDED).alias("need"), "dataset")


@query(
    "sam3_model_sample",
    f"SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality >= 0.9 AND length(text) > 500 ORDER BY md5('{SEED}' || doc_id) LIMIT 50",
)
def sam3(spark, folder):
    docs = documents(spark, folder).join(table(spark, folder, "labels"), "doc_id")
    return C.model_sample(docs, "doc_id", "quality", "text", 50, SEED).select("doc_id")


@query(
    "set4_annotated_import",
    CUT_SQL.format(seed=SEED) + f""", {spans_sql(GOLD)}, c AS (SELECT doc_id, count(*) AS k FROM spans GROUP BY 1)
SELECT doc_id, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'tender_train' ELSE 'tender_dev' END AS dataset, 'tender' AS task, CAST(coalesce(k, 0) AS INTEGER) AS spans FROM r LEFT JOIN c USING (doc_id)""",
)
def set4(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    registry = spark.createDataFrame([], "doc_id bigint, dataset string, task string")
    corpus, _ = C.annotated_import(docs, S.phrase_spans(F.col("text"), GOLD), "doc_id", "tender", registry, SEED)
    return corpus.select("doc_id", "dataset", "task", F.size("label").alias("spans"))


@query(
    "set4_registry_renewal",
    CUT_SQL.format(seed=SEED) + """ SELECT doc_id, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'tender_train' ELSE 'tender_dev' END AS dataset, 'tender' AS task FROM r
UNION ALL SELECT doc_id, 'old', 'bid' FROM documents WHERE lang = 'en' AND doc_id % 2 = 1""",
)
def set4_registry(spark, folder):
    """The registry after an import: the task's old rows are gone, those of other tasks stay."""
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    task = F.when(F.col("doc_id") % 2 == 1, F.lit("bid")).otherwise(F.lit("tender"))
    registry = docs.filter("lang = 'en'").select("doc_id", F.lit("old").alias("dataset"), task.alias("task"))
    _, renewed = C.annotated_import(docs.drop("lang"), S.phrase_spans(F.col("text"), GOLD), "doc_id", "tender", registry, SEED)
    return renewed


@query(
    "ded1_add_to_registry",
    "SELECT md5, arg_min(doc_id, src * 1000000000 + doc_id) AS doc_id FROM (SELECT md5(text) AS md5, doc_id, 0 AS src FROM documents WHERE lang <> 'en' UNION ALL SELECT md5(text), doc_id, 1 FROM documents) GROUP BY 1",
)
def ded1_registry(spark, folder):
    docs = documents(spark, folder).select(T.fingerprint(F.col("text")).alias("md5"), "doc_id", "lang")
    return C.add_to_registry(docs.filter("lang <> 'en'").drop("lang"), docs.drop("lang"), "md5", ["doc_id"])


@query("jn1_with_meta", "SELECT d.doc_id, l.quality, l.toxic, d.source FROM labels l JOIN documents d USING (doc_id) WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL AND d.source IS NOT NULL")
def jn1(spark, folder):
    return L.with_meta(table(spark, folder, "labels"), table(spark, folder, "documents").select("doc_id", "source"), "doc_id")


@query(
    "jn2_universe_counts",
    f"{GOLD_SQL} SELECT u.label_type, c.n AS count FROM (SELECT DISTINCT lang AS label_type FROM documents UNION SELECT DISTINCT label FROM spans) u LEFT JOIN (SELECT label, count(*) AS n FROM spans GROUP BY 1) c ON c.label = u.label_type",
)
def jn2(spark, folder):
    counts = agg1(spark, folder)
    universe = table(spark, folder, "documents").select(F.col("lang").alias("label_type")).union(counts.select("label_type")).distinct()
    return L.universe_counts(universe, counts, "label_type")


@query("jn3_unknown", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def jn3(spark, folder):
    known = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.unknown(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), known, "o_orderkey")


@query("jn4_listed", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def jn4(spark, folder):
    return L.listed(table(spark, folder, "documents").select("doc_id", "source"), table(spark, folder, "labels"), "doc_id")


@query(
    "jn6_first_match",
    "SELECT c_custkey, f.o AS first_order FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS o FROM orders GROUP BY 1) f ON f.o_custkey = c_custkey",
)
def jn6(spark, folder):
    side = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return L.first_match(table(spark, folder, "customer").select("c_custkey"), side, "c_custkey", "o_orderkey", "o_orderkey", "first_order")


@query(
    "jn7_join_on_id",
    f"{BOTH} SELECT d.doc_id, (SELECT count(*) FROM gold g WHERE g.doc_id = d.doc_id) AS human, (SELECT count(*) FROM pred p WHERE p.doc_id = d.doc_id) AS machine FROM documents d",
)
def jn7(spark, folder):
    human = annotated(spark, folder).select("doc_id", F.size("label").cast("bigint").alias("human"))
    machine = annotated(spark, folder, PRED).select("doc_id", F.size("label").cast("bigint").alias("machine"))
    return human.join(machine, "doc_id")


@query(
    "jn9_best_named",
    "SELECT max_by(p_partkey, (f, p_partkey)) AS p_partkey, max(f) AS fraction FROM (SELECT p_partkey, p_retailprice / (p_size * 28.35::DOUBLE) AS f FROM part WHERE p_brand = 'Brand#2' AND p_size > 0)",
)
def jn9(spark, folder):
    parts = table(spark, folder, "part")
    named = parts.filter(F.col("p_brand") == "Brand#2").select("p_partkey")
    return L.best_named(named, fractions(parts), "p_partkey", "fraction")


@query(
    "prj24_category_counts",
    "SELECT lang AS cat, count(*) AS count FROM documents GROUP BY 1",
)
def cats_scalar(spark, folder):
    docs = table(spark, folder, "documents")
    known = docs.withColumn("universe", C.label_universe(docs, "lang"))
    hot = known.select(C.one_hot(F.array("lang"), F.col("universe")).alias("cats"))
    return C.category_counts(hot)


@query(
    "jn8_overlapping_intervals",
    """WITH o AS (SELECT o_custkey % 50 AS k, datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS s, CASE WHEN o_orderkey % 500 = 1 THEN 1500 ELSE 1 END AS n FROM orders),
l AS (SELECT l_partkey % 50 AS k, datediff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS s, CASE WHEN l_orderkey % 900 = 1 THEN 2500 ELSE l_linenumber END AS n FROM lineitem)
SELECT o.k, count(*) AS pairs, CAST(sum(least(o.s + o.n, l.s + l.n) - greatest(o.s, l.s)) AS BIGINT) AS days
FROM o JOIN l ON o.k = l.k AND o.s < l.s + l.n AND l.s < o.s + o.n GROUP BY 1""",
)
def jn8_intervals(spark, folder):
    """Spans of one day and of years in both tables: days that orders and deliveries have in common."""
    def days(column):
        return F.datediff(F.to_date(column), F.lit("1990-01-01")).cast("long")

    orders = table(spark, folder, "orders").select(
        (F.col("o_custkey") % 50).alias("k"), days("o_orderdate").alias("start"), F.when(F.col("o_orderkey") % 500 == 1, 1500).otherwise(1).alias("n")
    )
    items = table(spark, folder, "lineitem").select(
        (F.col("l_partkey") % 50).alias("k"), days("l_shipdate").alias("r_start"), F.when(F.col("l_orderkey") % 900 == 1, 2500).otherwise(F.col("l_linenumber")).alias("m")
    )
    left = orders.select("k", "start", (F.col("start") + F.col("n")).alias("end"))
    right = items.select("k", "r_start", (F.col("r_start") + F.col("m")).alias("r_end"))
    return overlap_totals(left, right, ["k"], top=9).withColumnRenamed("common", "days")
