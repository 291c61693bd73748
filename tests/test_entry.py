import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = ["flagship_page_labels", "prj1_clean_html", "spn2_phrase_spans", "spn7_chunks", "spn12_tag_spans", "eva1_span_scores", "cmp3_comparison_report", "sam2_balance_and_split", "ext4_batches", "flow_notice_winners"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def norm(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([round(float(r[i]), 6) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    rel = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    assert norm(df.collect(), df.columns) == norm(rel.fetchall(), columns)


def test_registry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["prj1_clean_html", "prj1_clean_html_short", "prj2_standard_documents", "prj3_strip_tags_plain", "prj5_word_content"])
def test_references_without_semicolon_as_in_the_sql(spark, tmp_path, name):
    title = "a&amp;&amp; b&amp"
    rows = [
        (1, "https://x.org/1", f"<title>{title}</title><h1>{title}</h1><p>c &lt; d</p>"),
        (2, "https://x.org/2", "<p>t&quot</p>&copy;&middot &am &a<p>&amp;amp;</p>&amp;lt;&"),
    ]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    rel = c.execute(entry.oracle_sql()[name])
    assert norm(df.collect(), df.columns) == norm(rel.fetchall(), [d[0] for d in rel.description])


@pytest.mark.parametrize("name", ["prj1_clean_html", "prj1_clean_html_short", "prj3_strip_tags_plain", "prj5_word_content"])
def test_other_references_and_null_pages_as_in_the_sql(spark, tmp_path, name):
    rows = [
        (1, "https://x.org/1", "<p>a&nbsp;b&#39;c&eacute;d&#x41;</p>&amp;nbsp;&quot;e&lt;"),
        (2, "https://x.org/2", None),
        (3, "https://x.org/3", "<p>&amp;copy;&copy;&Copy;&#169;</p>"),
    ]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    rel = c.execute(entry.oracle_sql()[name])
    assert norm(df.collect(), df.columns) == norm(rel.fetchall(), [d[0] for d in rel.description])
