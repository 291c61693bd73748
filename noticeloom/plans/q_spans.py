"""Queries of the span, tag and relation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import unnest
from noticeloom.operators import bio as B
from noticeloom.operators import relations as R
from noticeloom.operators import spans as S
from noticeloom.operators.annotate import annotate, annotate_with_terms, term_matcher
from noticeloom.operators.terms import term_hits
from noticeloom.operators.tokens import merged_tokens, token_spans
from noticeloom.plans.catalog import query, table
from noticeloom.plans.data import GOLD, GOLD_LABELS, PRED, SEED, annotated, documents, quoted, spans_sql, with_md5

SPANS = spans_sql(GOLD)
GOLD_SQL = f"WITH {SPANS}"
BOTH_SQL = f"WITH {spans_sql(GOLD, 'gold')}, {spans_sql(PRED, 'pred')}"
VALUE = 'substring(d.text, s."start" + 1, s."end" - s."start")'
TRIMMED_GOLD = GOLD_LABELS[:3]


def rows_out(df: DataFrame, *keep: str) -> DataFrame:
    """Exploded spans of a result, for comparison."""
    return unnest(df, list(keep), "label", "_s").select(*keep, "_s.*")


@query("spn1_annotate_dictionary", f'{GOLD_SQL} SELECT doc_id, "start", "end", label FROM spans')
def spn1(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return rows_out(annotate(docs, term_matcher(GOLD)), "doc_id")


@query(
    "spn1_annotate_term_table",
    """WITH parts AS (SELECT d.doc_id, b.item_id, b.text AS term, string_split(d.text, b.text) AS p FROM documents d JOIN benchmark b ON contains(d.text, b.text)),
lens AS (SELECT doc_id, item_id, term, length(unnest(p)) AS n, unnest(range(len(p))) AS i, len(p) AS k FROM parts),
placed AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, item_id ORDER BY i) + i * length(term) AS s FROM lens)
SELECT doc_id, CAST(s AS INTEGER) AS "start", CAST(s + length(term) AS INTEGER) AS "end", 'item_' || item_id AS label FROM placed WHERE i < k - 1""",
)
def spn1_terms(spark, folder):
    terms = table(spark, folder, "benchmark").select(
        F.concat(F.lit("item_"), F.col("item_id").cast("string")).alias("label"), F.col("text").alias("term")
    )
    return term_hits(documents(spark, folder).select("doc_id", "text"), terms, ["doc_id"])


@query(
    "spn1_annotated_rows",
    """SELECT d.doc_id, count(DISTINCT b.item_id) AS items FROM documents d LEFT JOIN benchmark b ON contains(d.text, b.text) GROUP BY 1""",
)
def spn1_rows(spark, folder):
    """Every document with the number of benchmark passages that it holds."""
    terms = table(spark, folder, "benchmark").select(F.col("item_id").cast("string").alias("label"), F.col("text").alias("term"))
    rows = annotate_with_terms(documents(spark, folder).select("doc_id", "text"), terms)
    return rows.select("doc_id", F.size(F.array_distinct(F.transform("label", lambda s: s["label"]))).cast("long").alias("items"))


@query("spn2_phrase_spans", f'{GOLD_SQL} SELECT doc_id, pos, "start", "end", label FROM spans')
def spn2(spark, folder):
    return S.bare_spans(annotated(spark, folder), ["doc_id"]).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "spn2_phrase_documents",
    f"""WITH head AS (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100), {spans_sql([('其他', 'this'), ('其他', 'pour')], source='head')}
SELECT doc_id, "start", "end", label FROM spans""",
)
def spn2_documents(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return rows_out(S.phrase_documents(docs, ["this", "pour"], 100, id_col="doc_id"), "doc_id")


@query(
    "spn3_gold_override",
    f"""{BOTH_SQL}, known AS (SELECT doc_id FROM labels)
SELECT g.doc_id, g."start", g."end", g.label FROM gold g WHERE md5((SELECT text FROM documents d WHERE d.doc_id = g.doc_id)) IN (SELECT md5(text) FROM documents JOIN known USING (doc_id))
UNION ALL SELECT p.doc_id, p."start", p."end", p.label FROM pred p WHERE md5((SELECT text FROM documents d WHERE d.doc_id = p.doc_id)) NOT IN (SELECT md5(text) FROM documents JOIN known USING (doc_id))""",
)
def spn3(spark, folder):
    pred = with_md5(annotated(spark, folder, PRED))
    gold = with_md5(annotated(spark, folder)).join(table(spark, folder, "labels"), "doc_id", "left_semi").select("md5", "label")
    return rows_out(S.gold_override(pred, gold), "doc_id")


@query(
    "spn4_span_values",
    f"""{GOLD_SQL} SELECT s.doc_id, md5(d.text) AS md5, d.source AS dataset, s.label AS label_type, {VALUE} AS value, s."start", s."end", length({VALUE}) AS label_len
FROM spans s JOIN documents d USING (doc_id)""",
)
def spn4(spark, folder):
    df = with_md5(annotated(spark, folder, GOLD, "source")).withColumnRenamed("source", "dataset")
    rows = S.span_rows(df, ["doc_id", "md5", "dataset"])
    return rows.drop("pos").withColumn("label_len", F.col("label_len").cast("bigint"))


WINDOWED = """windowed AS (SELECT s.doc_id, s.label, s."start" AS a, s."end" AS b, greatest(s."start" - 200, 0) AS s_start, least(s."end" + 200, length(d.text)) AS s_end, d.text
 FROM spans s JOIN documents d USING (doc_id))"""


@query(
    "spn5_context_windows",
    f"""{GOLD_SQL}, {WINDOWED} SELECT doc_id, label, a - s_start AS "start", b - s_start AS "end", CAST(s_start AS INTEGER) AS s_start, CAST(s_end AS INTEGER) AS s_end,
 md5(substring(text, s_start + 1, s_end - s_start)) AS text_md5 FROM windowed WHERE label IN ('中标单位', '中标金额', '中标金额单位')""",
)
def spn5(spark, folder):
    rows = S.context_windows(annotated(spark, folder), ["doc_id"], TRIMMED_GOLD)
    return rows_out(rows.withColumn("text_md5", F.md5("text")), "doc_id", "s_start", "s_end", "text_md5")


@query(
    "spn6_replace_from_windows",
    f"""{GOLD_SQL} SELECT DISTINCT doc_id, CASE WHEN label = '中标单位' THEN "start" + 1 ELSE "start" END AS "start", "end", label FROM spans""",
)
def spn6(spark, folder):
    docs = annotated(spark, folder)
    fixed = S.context_windows(docs, ["doc_id"], ["中标单位"])
    fixed = fixed.withColumn("label", F.transform("label", lambda s: S.span(s["start"] + 1, s["end"], s["label"])))
    return rows_out(S.replace_from_windows(docs.select("doc_id", "label"), fixed, ["中标单位"], "doc_id"), "doc_id")


def chunk_sql(size: int, result: str | None = None) -> str:
    """The border walk, one border at a time: ``size`` on, or 20 past a merged span it would cut."""
    result = result or f"""SELECT c.doc_id, CAST(c.chunk AS INTEGER) AS chunk, CAST(c.b AS INTEGER) AS chunk_start, CAST(c.e - c.b AS INTEGER) AS n, md5(substring(d.text, c.b + 1, c.e - c.b)) AS text_md5, CAST(coalesce(h.spans, 0) AS INTEGER) AS spans
FROM bounds c JOIN docs d USING (doc_id) LEFT JOIN held h ON h.doc_id = c.doc_id AND h.chunk = c.chunk WHERE h.spans > 0 OR c.n < {size}"""
    return f"""WITH RECURSIVE {SPANS},
prior AS (SELECT doc_id, "start", "end", max("end") OVER (PARTITION BY doc_id ORDER BY "start", "end", label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen, row_number() OVER (PARTITION BY doc_id ORDER BY "start", "end", label) AS rn FROM spans),
grp AS (SELECT *, sum(CASE WHEN seen IS NULL OR "start" >= seen THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY rn) AS isle FROM prior),
isles AS (SELECT doc_id, isle, min("start") AS s, max("end") AS e FROM grp GROUP BY 1, 2),
docs AS (SELECT doc_id, text, length(text) AS n FROM documents),
walk(doc_id, n, b, fixed) AS (
  SELECT doc_id, n, {size}, false FROM docs WHERE n >= {size}
  UNION ALL
  SELECT w.doc_id, w.n, CASE WHEN i.e IS NOT NULL THEN i.e + 20 ELSE w.b + {size} END, i.e IS NULL
  FROM walk w LEFT JOIN isles i ON i.doc_id = w.doc_id AND i.s < w.b AND w.b < i.e WHERE w.b < w.n),
firm AS (SELECT w.doc_id, w.n, w.b FROM walk w LEFT JOIN isles i ON i.doc_id = w.doc_id AND i.s < w.b AND w.b < i.e WHERE w.b < w.n AND i.e IS NULL),
cuts AS (SELECT doc_id, n, 0 AS b FROM docs UNION ALL SELECT * FROM firm),
bounds AS (SELECT doc_id, n, b, coalesce(lead(b) OVER (PARTITION BY doc_id ORDER BY b), n) AS e, row_number() OVER (PARTITION BY doc_id ORDER BY b) - 1 AS chunk FROM cuts),
held AS (SELECT c.doc_id, c.chunk, count(*) AS spans, string_agg('[' || (s."start" - c.b) || ', ' || (s."end" - c.b) || '],' || s.label, chr(9) ORDER BY s.pos) AS cells
 FROM bounds c JOIN spans s ON s.doc_id = c.doc_id AND s."start" >= c.b AND s."end" <= c.e GROUP BY 1, 2)
{result}"""


@query("spn7_chunks", chunk_sql(500))
def spn7(spark, folder):
    chunks = S.chunk_documents(annotated(spark, folder), ["doc_id"])
    return chunks.select("doc_id", "chunk", "chunk_start", F.length("text").alias("n"), F.md5("text").alias("text_md5"), F.size("label").alias("spans"))


@query("spn7_chunks_long", chunk_sql(4800))
def spn7_long(spark, folder):
    chunks = S.chunk_documents(annotated(spark, folder), ["doc_id"], size=4800)
    return chunks.select("doc_id", "chunk", "chunk_start", F.length("text").alias("n"), F.md5("text").alias("text_md5"), F.size("label").alias("spans"))


@query(
    "src17_chunk_export",
    chunk_sql(
        500,
        """SELECT c.doc_id, CAST(c.chunk AS INTEGER) AS chunk, md5(concat_ws(chr(9), substring(d.text, c.b + 1, c.e - c.b), h.cells)) AS cells_md5, CAST(coalesce(h.spans, 0) + 1 AS INTEGER) AS n
FROM bounds c JOIN docs d USING (doc_id) LEFT JOIN held h ON h.doc_id = c.doc_id AND h.chunk = c.chunk WHERE h.spans > 0 OR c.n < 500""",
    ),
)
def src17(spark, folder):
    cells = S.chunk_export(S.chunk_documents(annotated(spark, folder), ["doc_id"]), ["doc_id", "chunk"])
    return cells.select("doc_id", "chunk", F.md5(F.array_join("cells", "\t")).alias("cells_md5"), F.size("cells").alias("n"))


SLIDING = """w AS (SELECT doc_id, text, length(text) AS n, unnest(range(0, length(text), 300)) AS ws FROM documents),
inside AS (SELECT w.doc_id, w.ws, s."start" - w.ws AS a, s."end" - w.ws AS b, s.label FROM w JOIN spans s ON s.doc_id = w.doc_id AND s."start" >= w.ws AND s."end" <= least(w.ws + 600, w.n))"""


@query(
    "spn8_sliding_windows",
    f"""{GOLD_SQL}, {SLIDING}, c AS (SELECT doc_id, ws, count(*) AS spans, sum(a) AS starts FROM inside GROUP BY 1, 2)
SELECT w.doc_id, CAST(w.ws AS INTEGER) AS "start", md5(substring(w.text, w.ws + 1, 600)) AS text_md5, CAST(coalesce(c.spans, 0) AS INTEGER) AS spans, CAST(coalesce(starts, 0) AS INTEGER) AS starts
FROM w LEFT JOIN c ON c.doc_id = w.doc_id AND c.ws = w.ws""",
)
def spn8(spark, folder):
    rows = S.sliding_windows(annotated(spark, folder), ["doc_id"])
    starts = F.aggregate("label", F.lit(0), lambda acc, s: acc + s["start"])
    return rows.select("doc_id", "start", F.md5("text").alias("text_md5"), F.size("label").alias("spans"), starts.alias("starts"))


@query(
    "spn9_stitch_windows",
    f"""{GOLD_SQL}, {SLIDING}, k AS (SELECT DISTINCT doc_id, ws + a AS a, ws + b AS b, label FROM inside),
c AS (SELECT doc_id, count(*) AS n, sum(a) AS starts FROM k GROUP BY 1)
SELECT d.doc_id, md5(d.text) AS text_md5, CAST(coalesce(c.n, 0) AS INTEGER) AS spans, CAST(coalesce(c.starts, 0) AS INTEGER) AS starts
FROM documents d LEFT JOIN c USING (doc_id) WHERE length(d.text) > 0""",
)
def spn9(spark, folder):
    docs = S.stitch_windows(S.sliding_windows(annotated(spark, folder), ["doc_id"]), ["doc_id"])
    starts = F.aggregate("label", F.lit(0), lambda acc, s: acc + s["start"])
    return docs.select("doc_id", F.md5("text").alias("text_md5"), F.size("label").alias("spans"), starts.alias("starts"))


@query(
    "spn10_trim_edges",
    f"""WITH {spans_sql([('a', 'nicht '), ('b', ' of the '), ('c', 'dans ')])}
SELECT s.doc_id, CAST(s."start" + length(v) - length(ltrim(v)) AS INTEGER) AS "start", CAST(s."end" - length(v) + length(rtrim(v)) AS INTEGER) AS "end", label
FROM (SELECT s.*, {VALUE} AS v FROM spans s JOIN documents d USING (doc_id)) s""",
)
def spn10(spark, folder):
    docs = annotated(spark, folder, [("a", "nicht "), ("b", " of the "), ("c", "dans ")])
    return rows_out(docs.withColumn("label", S.trim_span_edges(F.col("text"), F.col("label"))), "doc_id")


def tags_sql(terms: list[tuple[str, str]], p: str = "") -> str:
    """CTEs ending in ``tagged(doc_id, i, tag)``, all names after the prefix ``p``."""
    return f"""{spans_sql(terms, p + 'spans')},
{p}chars AS (SELECT doc_id, unnest(range(length(text))) AS i FROM documents),
{p}covered AS (SELECT doc_id, unnest(range("start", "end")) AS i, pos, "start", label FROM {p}spans),
{p}won AS (SELECT doc_id, i, arg_max(CASE WHEN i = "start" THEN 'B-' ELSE 'I-' END || label, pos) AS tag FROM {p}covered GROUP BY 1, 2),
{p}tagged AS (SELECT c.doc_id, c.i, coalesce(w.tag, 'O') AS tag FROM {p}chars c LEFT JOIN {p}won w ON w.doc_id = c.doc_id AND w.i = c.i)"""


TAGS_SQL = tags_sql(GOLD)


def tagged(spark, folder, terms=GOLD) -> DataFrame:
    return annotated(spark, folder, terms).withColumn("tags", B.bio_tags(F.length("text"), F.col("label")))


@query(
    "spn11_bio_tags",
    f"""WITH {TAGS_SQL} SELECT doc_id, md5(string_agg(tag, ',' ORDER BY i)) AS tags_md5, count(*) AS n, CAST(sum(CASE WHEN tag LIKE 'B-%' THEN 1 ELSE 0 END) AS INTEGER) AS begins FROM tagged GROUP BY 1""",
)
def spn11(spark, folder):
    return tagged(spark, folder).select(
        "doc_id", F.md5(F.array_join("tags", ",")).alias("tags_md5"), F.size("tags").cast("bigint").alias("n"),
        F.size(F.filter("tags", lambda t: F.startswith(t, F.lit("B-")))).alias("begins"),
    )


@query("spn11_tag_counts", f"WITH {TAGS_SQL} SELECT tag, count(*) AS n FROM tagged GROUP BY 1")
def spn11_counts(spark, folder):
    return unnest(tagged(spark, folder), [], "tags", "tag").groupBy("tag").agg(F.count("*").alias("n"))


def runs_sql(p: str = "") -> str:
    """CTEs ending in ``runs(doc_id, start, end, label)`` over the tags of the same prefix."""
    return f"""{p}r AS (SELECT doc_id, i, tag, CASE WHEN tag LIKE 'B-%' OR (tag LIKE 'I-%' AND coalesce(lag(tag) OVER o, 'O') = 'O') THEN 1 ELSE 0 END AS opens FROM {p}tagged WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
{p}g AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM {p}r),
{p}t AS (SELECT doc_id, run, substring(tag, 3) AS label, count(*) AS n, min(i) AS first, max(i) AS last FROM {p}g WHERE tag <> 'O' GROUP BY 1, 2, 3),
{p}runs AS (SELECT doc_id, run, CAST(min(first) AS INTEGER) AS "start", CAST(max(last) + 1 AS INTEGER) AS "end", arg_max(label, n * 1000000 - first) AS label FROM {p}t GROUP BY 1, 2)"""


RUNS_SQL = runs_sql()


def _token_rows(spark, folder):
    return B.tag_rows(tagged(spark, folder), ["doc_id"])


@query("spn12_token_rows", f'WITH {TAGS_SQL}, {RUNS_SQL} SELECT doc_id, "start", "end", label FROM runs')
def spn12_rows(spark, folder):
    """The same spans from one row per character, in cells that a long document fills many of."""
    return token_spans(_token_rows(spark, folder), ["doc_id"], cell=64)


@query("spn12_tag_spans", f'WITH {TAGS_SQL}, {RUNS_SQL} SELECT doc_id, "start", "end", label FROM runs')
def spn12(spark, folder):
    return rows_out(tagged(spark, folder).withColumn("label", B.tag_spans(F.col("tags"))).select("doc_id", "label"), "doc_id")


SPN13_SQL = f"""WITH {TAGS_SQL}, tok AS (SELECT doc_id, i, tag, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM tagged WHERE tag <> 'O'),
g AS (SELECT *, sum(CASE WHEN rn = 1 OR tag LIKE 'B-%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM tok),
h AS (SELECT doc_id, run, min(i) AS first, arg_min(substring(tag, 3), i) AS label FROM g GROUP BY 1, 2)
SELECT h.doc_id, CAST(h.first AS INTEGER) AS "start", CAST(max(g.i) + 1 AS INTEGER) AS "end", h.label
FROM h JOIN g ON g.doc_id = h.doc_id AND g.run = h.run AND substring(g.tag, 3) = h.label GROUP BY 1, 2, 4"""


@query("spn13_token_rows", SPN13_SQL)
def spn13_rows(spark, folder):
    return merged_tokens(_token_rows(spark, folder), ["doc_id"], cell=64)


@query("spn13_merge_tokens", SPN13_SQL)
def spn13(spark, folder):
    docs = tagged(spark, folder).select("doc_id", B.token_slices(F.col("tags")).alias("tokens"))
    return rows_out(docs.withColumn("label", B.merge_tokens(F.col("tokens"))), "doc_id")


@query(
    "spn14_tag_windows",
    """WITH p AS (SELECT doc_id, text, length(text) AS n, length(text) / 510.0::DOUBLE + 1 AS divs FROM documents),
q AS (SELECT *, floor(n / divs) AS ev, floor((510 - floor(n / divs)) / 2) AS room FROM p),
w AS (SELECT *, unnest(range(CAST(floor(divs) AS BIGINT))) AS i FROM q),
b AS (SELECT doc_id, text, n, i AS "window", greatest(CASE WHEN i = 0 THEN 0 WHEN i = floor(divs) - 1 THEN i * ev - 2 * room ELSE i * ev - room END, 0) AS s,
 least(CASE WHEN i = 0 THEN ev + 2 * room WHEN i = floor(divs) - 1 THEN (i + 1) * ev ELSE (i + 1) * ev + room END, n) AS e FROM w)
SELECT doc_id, CAST("window" AS INTEGER) AS "window", CAST(s AS INTEGER) AS "start", CAST(e AS INTEGER) AS "end", md5(substring(text, CAST(s AS BIGINT) + 1, CAST(e - s AS BIGINT))) AS text_md5 FROM b""",
)
def spn14(spark, folder):
    docs = tagged(spark, folder).select("doc_id", F.split("text", "").alias("data"), F.col("tags").alias("label"))
    rows = B.tag_windows(docs, ["doc_id"], 510, F.size("label"))
    return rows.select("doc_id", "window", "start", "end", F.md5(F.array_join("data", "")).alias("text_md5"))


@query(
    "spn15_tag_vocabulary",
    f"""{GOLD_SQL}, l AS (SELECT label, row_number() OVER (ORDER BY label) AS k FROM (SELECT DISTINCT label FROM spans))
SELECT 0 AS id, 'O' AS tag UNION ALL SELECT 2 * k - 1, 'B-' || label FROM l UNION ALL SELECT 2 * k, 'I-' || label FROM l""",
)
def spn15(spark, folder):
    spans = S.bare_spans(annotated(spark, folder), ["doc_id"])
    labels = spans.select("label").distinct().agg(F.sort_array(F.collect_set("label")).alias("labels"))
    return labels.select(F.posexplode(B.tag_vocabulary(F.col("labels"))).alias("id", "tag"))


SENTENCES = """cut AS (SELECT doc_id, string_split(replace(replace(text, '.', '.' || chr(1)), chr(10), chr(10) || chr(1)), chr(1)) AS p FROM documents),
piece AS (SELECT doc_id, unnest(p) AS t, unnest(range(len(p))) AS i FROM cut),
placed AS (SELECT doc_id, t, i, sum(length(t)) OVER (PARTITION BY doc_id ORDER BY i) - length(t) AS a FROM piece),
sent AS (SELECT doc_id, i, a, a + length(t) - CASE WHEN ends_with(t, chr(10)) THEN 1 ELSE 0 END AS b, rtrim(t, chr(10)) AS t,
 row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS sentence FROM placed WHERE trim(translate(t, chr(10) || chr(13) || chr(9), '   ')) <> '')"""


@query(
    "spn16_sentence_spans",
    f"""{GOLD_SQL}, {SENTENCES} SELECT x.doc_id, CAST(x.sentence AS INTEGER) AS sentence, CAST(x.a AS INTEGER) AS at, md5(x.t) AS text_md5,
 CAST(greatest(s."start", x.a) - x.a AS INTEGER) AS "start", CAST(least(s."end", x.b) - x.a AS INTEGER) AS "end", s.label
FROM sent x JOIN spans s ON s.doc_id = x.doc_id AND s."start" < x.b AND s."end" > x.a""",
)
def spn16(spark, folder):
    rows = S.sentence_rows(annotated(spark, folder), ["doc_id"], ".")
    rows = rows.withColumns({"at": F.col("start"), "text_md5": F.md5("text")})
    return rows_out(rows, "doc_id", "sentence", "at", "text_md5")


@query(
    "spn16_conversation_sentences",
    f"""WITH c AS (SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations), {SENTENCES.replace('FROM documents', 'FROM c')}
SELECT doc_id, CAST(sentence AS INTEGER) AS sentence, CAST(a AS INTEGER) AS at, md5(t) AS text_md5 FROM sent""",
)
def spn16_conversations(spark, folder):
    turns = table(spark, folder, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    turns = turns.withColumn("label", F.array().cast("array<struct<start:int,end:int,label:string>>"))
    rows = S.sentence_rows(turns, ["doc_id"], ".", labelled_only=False)
    return rows.select("doc_id", "sentence", F.col("start").alias("at"), F.md5("text").alias("text_md5"))


@query(
    "spn17_duplicate_labels",
    f"{GOLD_SQL} SELECT doc_id, label AS label_type, count(*) AS count FROM spans WHERE label <> '中标单位' GROUP BY 1, 2 HAVING count(*) > 1",
)
def spn17(spark, folder):
    return S.duplicate_labels(annotated(spark, folder), ["doc_id"], ["中标单位"])


@query(
    "spn18_overlapping_spans",
    f"""{GOLD_SQL} SELECT a.doc_id, a."start" AS a_start, a."end" AS a_end, a.label AS a_label, b."start" AS b_start, b."end" AS b_end, b.label AS b_label
FROM spans a JOIN spans b ON a.doc_id = b.doc_id AND a.label <> b.label AND a."start" <= b."end" AND b."start" <= a."end" """,
)
def spn18(spark, folder):
    return S.overlapping_spans(S.bare_spans(annotated(spark, folder), ["doc_id"]), "doc_id")


def _shifted(spark, folder) -> DataFrame:
    """Spans moved so that some leave their text."""
    df = annotated(spark, folder)
    return df.withColumn("label", F.transform("label", lambda s, i: S.span(s["start"] - i * 10, s["end"] + i * 40, s["label"])))


SHIFTED_SQL = f"""{GOLD_SQL}, moved AS (SELECT s.doc_id, CAST("start" - pos * 10 AS INTEGER) AS "start", CAST("end" + pos * 40 AS INTEGER) AS "end", label, length(d.text) AS n FROM spans s JOIN documents d USING (doc_id))"""


@query("spn19_valid_spans", f'{SHIFTED_SQL} SELECT doc_id, "start", "end", label FROM moved WHERE "start" >= 0 AND "start" < "end" AND "end" <= n')
def spn19(spark, folder):
    return rows_out(S.split_valid(_shifted(spark, folder), ["doc_id"])[0], "doc_id")


@query("spn19_rejected_spans", f'{SHIFTED_SQL} SELECT doc_id, "start", "end", label FROM moved WHERE NOT ("start" >= 0 AND "start" < "end" AND "end" <= n)')
def spn19_rejected(spark, folder):
    return S.split_valid(_shifted(spark, folder), ["doc_id"])[1]


@query("spn20_span_groups", f"{GOLD_SQL} SELECT doc_id, 'sc' AS key, count(*) AS spans FROM spans GROUP BY 1")
def spn20(spark, folder):
    groups = annotated(spark, folder).select("doc_id", F.explode(S.span_groups(F.col("label"), "sc")).alias("key", "spans"))
    return groups.select("doc_id", "key", F.size("spans").cast("bigint").alias("spans")).filter("spans > 0")


def boundary_scores(spark, folder) -> DataFrame:
    """Scores per word of every text: high where a word looks like a start or an end."""
    words = unnest(documents(spark, folder), ["doc_id"], F.split("text", r"[ \n]+", -1), "word", "token")
    point = lambda x: F.conv(F.substring(F.md5(x), 1, 2), 16, 10).cast("double") / 255
    return words.select(
        "doc_id", "token", point(F.col("word")).alias("start_score"), point(F.reverse(F.col("word"))).alias("end_score")
    )


SCORES_SQL = """words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS token FROM (SELECT doc_id, string_split_regex(text, '[ \\n]+') AS w FROM documents)),
scores AS (SELECT doc_id, token, CAST(('0x' || substring(md5(word), 1, 2)) AS INTEGER) / 255.0::DOUBLE AS s, CAST(('0x' || substring(md5(reverse(word)), 1, 2)) AS INTEGER) / 255.0::DOUBLE AS e FROM words)"""


@query(
    "spn21_span_candidates",
    # Document and token are one key, so that no plan can join on the document alone.
    f"""WITH {SCORES_SQL.replace("scores AS (", "scores AS MATERIALIZED (")}, a AS MATERIALIZED (
  SELECT doc_id || ':' || (token + unnest(range(1, 6))) AS place, doc_id, token FROM scores WHERE s >= 0.9),
b AS MATERIALIZED (SELECT doc_id || ':' || token AS place, token FROM scores WHERE e >= 0.9)
SELECT doc_id, CAST(a.token AS INTEGER) AS "start", CAST(b.token + 1 AS INTEGER) AS "end" FROM a JOIN b USING (place)""",
)
def spn21(spark, folder):
    return R.span_candidates(boundary_scores(spark, folder), "doc_id", 0.9, 2, 6)


@query(
    "spn21_candidate_ranges",
    f"""WITH {SCORES_SQL}, u AS (SELECT doc_id, token AS place, token AS st, 0 AS is_end FROM scores WHERE s >= 0.35 UNION ALL SELECT doc_id, token, NULL, 1 FROM scores WHERE e >= 0.35),
w AS (SELECT *, sum(is_end) OVER (PARTITION BY doc_id ORDER BY place DESC, is_end DESC ROWS UNBOUNDED PRECEDING) AS n FROM u)
SELECT doc_id, CAST(st AS INTEGER) AS "start", CAST(n AS BIGINT) AS n_ends FROM w WHERE is_end = 0""",
)
def spn21_ranges(spark, folder):
    return R.span_candidate_ranges(boundary_scores(spark, folder), "doc_id", 0.35, 0)


@query(
    "spn22_boundary_truth",
    f"""{GOLD_SQL}, chars AS (SELECT doc_id, unnest(range(length(text))) AS token FROM documents),
f AS (SELECT c.doc_id, c.token, EXISTS (SELECT 1 FROM spans s WHERE s.doc_id = c.doc_id AND s."start" = c.token) AS st, EXISTS (SELECT 1 FROM spans s WHERE s.doc_id = c.doc_id AND s."end" - 1 = c.token) AS en FROM chars c)
SELECT doc_id, count(*) AS tokens, CAST(sum(st::INT) AS BIGINT) AS starts, CAST(sum(en::INT) AS BIGINT) AS ends, CAST(sum(CASE WHEN st AND en THEN 1 ELSE 0 END) AS BIGINT) AS both FROM f GROUP BY 1""",
)
def spn22(spark, folder):
    docs = annotated(spark, folder)
    flags = R.boundary_truth(docs, ["doc_id"], F.length("text"))
    return flags.groupBy("doc_id").agg(
        F.count("*").alias("tokens"), F.sum("is_start").alias("starts"), F.sum("is_end").alias("ends"),
        F.sum(F.col("is_start") * F.col("is_end")).alias("both"),
    )


NEAR_SQL = """near AS (SELECT a.doc_id, a.pos AS from_pos, b.pos AS to_pos, a."start" AS from_start, b."start" AS to_start, a.label AS from_label, b.label AS to_label
 FROM spans a JOIN spans b ON a.doc_id = b.doc_id AND a.pos <> b.pos AND abs(a."start" - b."start") <= 100)"""


@query(
    "spn23_near_pairs",
    f"{GOLD_SQL}, {NEAR_SQL} SELECT doc_id, CAST(from_pos AS INTEGER) AS from_pos, CAST(to_pos AS INTEGER) AS to_pos, from_start, to_start FROM near",
)
def spn23(spark, folder):
    return R.near_pairs(S.bare_spans(annotated(spark, folder), ["doc_id"]), "doc_id", 100)


def neighbour_scores(spans: F.Column) -> F.Column:
    """Relation scores between each span and the next one of its document."""
    kinds = F.array(*[F.lit(t) for t in ("概念解释", "实体观点", "实体事件", "实体时间", "实体地点")])
    last = F.size(spans) - 1
    return F.when(
        last > 0,
        F.transform(
            F.slice(spans, F.lit(1), last),
            lambda s, i: F.struct(
                i.alias("from_pos"),
                (i + 1).alias("to_pos"),
                F.get(kinds, s["start"] % 5).alias("type"),
                ((s["end"] % 10) / F.lit(10.0)).alias("score"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<from_pos:int,to_pos:int,type:string,score:double>>"))


REL_SQL = """rel AS (SELECT doc_id, pos AS from_pos, pos + 1 AS to_pos, ['概念解释', '实体观点', '实体事件', '实体时间', '实体地点']["start" % 5 + 1] AS type, ("end" % 10) / 10.0::DOUBLE AS score
 FROM (SELECT *, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS nx FROM spans) WHERE nx IS NOT NULL)"""
TYPES = ["概念解释", "实体观点", "实体事件", "实体时间", "实体地点"]


def scored(spark, folder) -> DataFrame:
    return annotated(spark, folder).withColumn("scores", neighbour_scores(F.col("label")))


def relation_rows(spark, folder) -> DataFrame:
    return unnest(scored(spark, folder), ["doc_id"], "scores", "r").select("doc_id", "r.*")


@query(
    "spn24_relation_truth",
    f"""{GOLD_SQL}, {NEAR_SQL}, {REL_SQL}, t(type) AS (VALUES {', '.join(f'({quoted(t)})' for t in TYPES)}),
p AS (SELECT doc_id, from_pos, to_pos FROM near UNION SELECT doc_id, from_pos, to_pos FROM rel)
SELECT p.doc_id, CAST(p.from_pos AS INTEGER) AS from_pos, CAST(p.to_pos AS INTEGER) AS to_pos, t.type, CASE WHEN r.doc_id IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS truth
FROM p, t LEFT JOIN rel r ON r.doc_id = p.doc_id AND r.from_pos = p.from_pos AND r.to_pos = p.to_pos AND r.type = t.type""",
)
def spn24(spark, folder):
    pairs = R.near_pairs(S.bare_spans(annotated(spark, folder), ["doc_id"]), "doc_id", 100)
    truth = R.relation_truth(pairs, relation_rows(spark, folder), "doc_id", TYPES)
    return truth.select("doc_id", "from_pos", "to_pos", F.explode("truth").alias("type", "truth"))


@query(
    "spn25_relation_blocks",
    f"""{GOLD_SQL}, n AS (SELECT doc_id, label, count(*) AS n FROM spans GROUP BY 1, 2), pair(a, b) AS (VALUES ('中标单位', '中标金额'), ('中标金额', '中标金额单位')),
f AS (SELECT s.doc_id, s.pos + 1 AS from_id, s.label AS from_label, p.b AS to_label, n.n FROM spans s JOIN pair p ON p.a = s.label JOIN n ON n.doc_id = s.doc_id AND n.label = p.b)
SELECT doc_id, CAST(from_id AS INTEGER) AS from_id, from_label, to_label, CAST(n AS INTEGER) AS n, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY from_id) - n + 1 AS INTEGER) AS first_id, from_label || '-' || to_label AS type FROM f""",
)
def spn25(spark, folder):
    return R.relation_blocks(annotated(spark, folder), "doc_id")


@query(
    "spn26_entity_format",
    f"""{GOLD_SQL}, drawn AS (SELECT doc_id, text FROM documents ORDER BY md5('{SEED}' || doc_id) LIMIT 200)
SELECT d.doc_id, CAST(s.pos AS INTEGER) AS id, s.label, s."start" AS start_offset, s."end" AS end_offset FROM drawn d JOIN spans s USING (doc_id)""",
)
def spn26(spark, folder):
    out = R.entity_format(annotated(spark, folder), 200, SEED, "doc_id")
    return unnest(out, ["doc_id"], "entities", "e").select("doc_id", "e.*")


@query(
    "spn27_label_relations",
    f"""{GOLD_SQL}, {REL_SQL}, ne AS (SELECT doc_id, count(*) AS n FROM spans GROUP BY 1), off AS (SELECT doc_id, sum(n) OVER (ORDER BY doc_id) - n + 1001 AS base FROM ne),
kept AS (SELECT *, row_number() OVER (ORDER BY doc_id, from_pos) + 5000 AS id FROM rel WHERE score > 0.5)
SELECT k.doc_id, CAST(k.id AS BIGINT) AS id, CAST(o.base + k.from_pos AS BIGINT) AS from_id, CAST(o.base + k.to_pos AS BIGINT) AS to_id, k.type FROM kept k JOIN off o USING (doc_id)""",
)
def spn27(spark, folder):
    rows = R.label_relations(scored(spark, folder).select("doc_id", "label", "scores"), "doc_id", 1001, 5001)
    return unnest(rows, ["doc_id"], "relations", "r").select("doc_id", "r.*")


def relation_corpus(spark, folder) -> DataFrame:
    """Documents with entities numbered from 0 and their relations scored above one half."""
    df = scored(spark, folder)
    relations = F.transform(
        F.filter("scores", lambda r: r["score"] > 0.5),
        lambda r, i: F.struct(i.alias("id"), r["from_pos"].alias("from_id"), r["to_pos"].alias("to_id"), r["type"].alias("type")),
    )
    return df.withColumns({"entities": R.number_entities(F.col("label"), 0), "relations": relations})


VIEW_SQL = f"""{GOLD_SQL}, {REL_SQL}, v AS (SELECT r.doc_id, r.from_pos, r.type, substring(d.text, a."start" + 1, a."end" - a."start") AS ft, substring(d.text, b."start" + 1, b."end" - b."start") AS tt
 FROM rel r JOIN documents d USING (doc_id) JOIN spans a ON a.doc_id = r.doc_id AND a.pos = r.from_pos JOIN spans b ON b.doc_id = r.doc_id AND b.pos = r.to_pos WHERE r.score > 0.5)"""


@query("piv1_concepts", f"{VIEW_SQL} SELECT doc_id, ft AS concept, tt AS explation FROM v WHERE type = '概念解释'")
def piv1_concepts(spark, folder):
    return R.relation_views(relation_corpus(spark, folder), "doc_id")["concepts"]


@query("piv1_views", f"{VIEW_SQL} SELECT doc_id, ft AS ent, tt AS \"view\" FROM v WHERE type = '实体观点'")
def piv1_views(spark, folder):
    return R.relation_views(relation_corpus(spark, folder), "doc_id")["views"]


@query(
    "piv1_events",
    f"""{VIEW_SQL} SELECT doc_id, CAST(from_pos AS INTEGER) AS from_id, any_value(ft) AS ent, max(CASE WHEN type = '实体事件' THEN tt END) AS event,
 max(CASE WHEN type = '实体时间' THEN tt END) AS "time", max(CASE WHEN type = '实体地点' THEN tt END) AS place FROM v WHERE type NOT IN ('概念解释', '实体观点') GROUP BY 1, 2""",
)
def piv1_events(spark, folder):
    return R.relation_views(relation_corpus(spark, folder), "doc_id")["events"]


@query(
    "sam4_spot_check",
    f"""{GOLD_SQL}, docs AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM spans) ORDER BY md5('{SEED}' || doc_id) LIMIT 100),
r AS (SELECT s.*, row_number() OVER (PARTITION BY s.doc_id ORDER BY md5('{SEED}|' || s."start" || '|' || s."end" || '|' || s.label)) AS rn FROM spans s JOIN docs USING (doc_id))
SELECT s.doc_id, {VALUE} AS value, s.label FROM r s JOIN documents d USING (doc_id) WHERE rn = 1""",
)
def sam4(spark, folder):
    from noticeloom.operators.curate import spot_check

    return spot_check(annotated(spark, folder), "doc_id", 100, SEED)
