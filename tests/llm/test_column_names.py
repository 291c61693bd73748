"""Columns with dots and backticks in their names pass every operator that returns the columns of its input."""

from noticeloom.llm import exact_dedup, language_id, mixing, near_dedup, surrogates

from .samples import documents, rows


def test_names_pass(spark):
    docs = documents(spark, rows(n=12)).withColumnsRenamed({"n": "meta.lang", "h": "a`b", "size": "meta"})
    assert {"meta.lang", "a`b", "meta"} <= set(docs.columns)
    made = {
        "exact": exact_dedup.exact_dedup(docs),
        "near": near_dedup.near_dedup(docs),
        "mix": mixing.mix(docs),
        "known": language_id.keep_known(docs, language_id.train(docs)),
        "surrogates": surrogates.replace_entities(docs, "k"),
    }
    for name, df in made.items():
        assert df.columns == docs.columns, name
        assert all(r["meta.lang"] == "x" and r["a`b"] == "x" for r in df.collect()), name
