"""The pipeline stage by stage against what each stage promises."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from noticeloom.llm.common import stored

from .samples import documents, rows
from .test_exact_dedup import brute as same_texts
from .test_near_dedup import brute as near_texts

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    data = rows(n=40)
    docs = documents(spark, data)
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER), "test")
        out[name] = docs
        if name != "pack_sequences":
            assert docs.columns == columns
    lettered = [r for r in data if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter(r["text"] for r in out["language_id"].collect()) == Counter(t for _, t, *_ in lettered)
    kept = {(i, digest) for i, _, _, kept, digest in same_texts(lettered) if kept}
    assert out["exact_dedup"].count() == len(kept)
    distinct = [(r["doc_id"], r["text"], "", "") for r in out["exact_dedup"].collect()]
    assert sorted(r["doc_id"] or -1 for r in out["near_dedup"].collect()) == sorted(i or -1 for i, _, _, k in near_texts(distinct, 5) if k)
    copies = Counter(r["doc_id"] for r in out["mix_sources"].collect())
    assert set(copies.values()) <= {1, 2} and set(copies) <= {r["doc_id"] for r in out["near_dedup"].collect()}
    packed = out["pack_sequences"].collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies


def test_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "test")
    assert docs.count() == 0


def test_registered(spark):
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", ["op2_near_dedup", "op10_remove_repeats"])
def test_queries_on_the_small_tables(spark, name):
    data = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    from .test_prefix_free import brute as repeats

    want = near_texts(data, 4) if name.startswith("op2") else repeats(data)
    from .samples import key

    assert sorted(map(tuple, entry.queries()[name](spark, FOLDER).collect()), key=key) == want
