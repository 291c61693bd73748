"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm import (
    exact_dedup, language_id, mixing, near_dedup, packing, paragraph_sketch, prefix_free, secrets, source_audit, surrogates, top_k,
    url_filter, whitening,
)

SURROGATE_KEY = "surrogates of the query"  # a job of one's own brings a key of its own
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_pack_sequences")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary_path())


@query(
    "op2_near_dedup",
    r"""WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.n + b.n - i)),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1) c USING (doc_id)""",
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.components(table(spark, folder, "documents"), words=4)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def held_out() -> Column:
    """Documents that language training must not see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(~held_out()))
    return language_id.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query(
    "op4_top_k",
    """WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.top_k(table(spark, folder, "embeddings"))


@query("op5_pii_surrogates")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY, count_col="n_replaced")


@query("op6_secret_scan")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "nth", "before", F.sha2("value", 256).alias("value_sha256"), "score")


@query("op7_mix_sources")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


@query(
    "op8_exact_dedup",
    r"""WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS cps, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY cps DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def _url_sql() -> str:
    host = r"translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = r"coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
    terms = ", ".join(f"('{t}', {w})" for t, w in url_filter.VOCABULARY.items())
    return rf"""WITH rules(h, p, v) AS (VALUES {rules}), terms(term, weight) AS (VALUES {terms}),
u AS (SELECT page_id, {host} AS host, {path} AS path, lower(url) AS low FROM pages),
fit AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM u JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1),
hits AS (
  SELECT page_id, sum(weight) AS weight FROM u JOIN terms
  ON regexp_matches(low, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)') GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN weight >= {url_filter.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit USING (page_id) LEFT JOIN hits USING (page_id)"""


@query("op9_url_filter", _url_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages")).drop("weight")


@query(
    "op10_remove_repeats",
    """WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
j AS (SELECT doc_id, n, hx, unnest(range(0, n, 64)) AS j FROM h),
c AS (SELECT doc_id, n, j, substring(hx, 2 * j + 1, 228) AS c FROM j),
p AS (SELECT doc_id, j + k AS i, substring(c, 2 * k + 1, 100) AS g FROM (SELECT *, unnest(range(0, 64)) AS k FROM c) WHERE j + k <= n - 50),
m AS (SELECT g, min(doc_id) AS low FROM p GROUP BY 1),
w AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM p JOIN m USING (g) WHERE low < doc_id),
r AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM w),
s AS (SELECT doc_id, min(i) AS s, max(i) + 50 AS e FROM r GROUP BY doc_id, run),
b AS (SELECT *, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS pe FROM s),
k AS (
  SELECT doc_id, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans,
         string_agg(substring(hx, 2 * pe + 1, 2 * (s - pe)), '' ORDER BY s) || any_value(substring(hx, 2 * last + 1)) AS kept
  FROM (SELECT *, max(e) OVER (PARTITION BY doc_id) AS last FROM b) JOIN h USING (doc_id) GROUP BY 1)
SELECT h.doc_id, h.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.kept, h.hx))) AS kept_sha256
FROM h LEFT JOIN k USING (doc_id)""",
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_free.remove_repeats(table(spark, folder, "documents"))


def _audit_sql() -> str:
    az = f"'{source_audit.UPPER}', '{source_audit.LOWER}'"
    return rf"""WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), {az}), '{source_audit.TERM}') AS ts FROM documents),
t AS MATERIALIZED (SELECT row, lang, source, unnest(ts) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10),
l AS (SELECT lang, count(*) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY 1),
c AS MATERIALIZED (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS (
  SELECT lang, source, coalesce(CAST(any_value(s.total) AS HUGEINT), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2) s USING (lang, source) GROUP BY 1, 2),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // (g.total + 2 * l.v) AS p,
         1 + 1000000000 * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM g JOIN kept k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(any_value(s.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source GROUP BY 1, 2, 3, 4),
u AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 10"""


@query("op11_source_audit", _audit_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.divergence(table(spark, folder, "documents"))


@query("op12_version_fingerprints")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_sketch.version_fingerprints(table(spark, folder, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
