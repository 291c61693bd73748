"""URL verdicts: host and path rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

The automaton counts each term once per URL, and only where no letter or digit touches it. A URL is
blocked when the weights of its distinct terms reach ``threshold``: a strict term alone does, a soft
term takes a second one. Rules and vocabulary are parameters of the job, held by each task; a URL needs
no other row, so nothing is shuffled and a host with any share of the rows costs no more than others.

Defined results: a null or scheme-less URL has empty host and path, fits no rule and is matched as it
stands (null has no hits and is allowed); repeated rows are judged alike; an empty table gives an empty
result. Only ``id_col`` and ``url_col`` are read, so other columns cannot clash. Among rules of equal
length, block wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = ["porn", "xxx", "viagra", "casino", "spam", "malware", "phishing", "warez", "escort", "pills"]
SOFT = ["adult", "bet", "bonus", "cheap", "cracked", "dating", "farm", "free", "gambling", "hot", "jackpot", "loan", "loans", "lottery", "payday", "poker", "replica", "sex", "sexy", "slots", "torrent", "win", "winner"]
THRESHOLD = 2
VOCABULARY = {**dict.fromkeys(STRICT, THRESHOLD), **dict.fromkeys(SOFT, 1)}
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def automaton(vocabulary: dict[str, int]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def weight_of(text: str, found) -> int:
    """Sum of the weights of the distinct terms in ``text`` (lower case) that stand between borders."""
    hits = {}
    for end, (term, weight) in found.iter(text):
        start = end - len(term) + 1
        if (start == 0 or text[start - 1] not in _ALNUM) and (end + 1 == len(text) or text[end + 1] not in _ALNUM):
            hits[term] = weight
    return sum(hits.values())


def rule_of(host: str, path: str, rules: dict[str, list[tuple[str, str]]]) -> tuple[str, str] | None:
    """The longest fitting rule as (rule, verdict): the host's own and those of its parent domains are tried."""
    best, name = None, host
    while name:
        for start, verdict in rules.get(name, ()):
            if path.startswith(start):
                best = max(best or (0, False, "", ""), (len(name) + len(start), verdict == "block", name + start, verdict))
        name = name.partition(".")[2]
    return best and best[2:]


def judge_urls(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] = RULES,
    vocabulary: dict[str, int] = VOCABULARY, threshold: int = THRESHOLD,
) -> DataFrame:
    """Per row: ``id_col, host, path, rule, verdict, weight``; ``weight`` is the vocabulary's."""
    by_host: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append((path, verdict))
    url = F.col(url_col)
    parts = df.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), F.translate(url, UPPER, LOWER).alias("url"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(vocabulary) if vocabulary else None
        for b in batches:
            hosts, paths, urls = (b.column(i).to_pylist() for i in (1, 2, 3))
            fits = [rule_of(h, p, by_host) for h, p in zip(hosts, paths)]
            weights = [weight_of(u, found) if u and found else 0 for u in urls]
            verdicts = [f[1] if f else "block" if w >= threshold else "allow" for f, w in zip(fits, weights)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([f and f[0] for f in fits], pa.string()), pa.array(verdicts, pa.string()), pa.array(weights, pa.int64())],
                names=["id", "host", "path", "rule", "verdict", "weight"],
            )

    schema = f"id {df.schema[id_col].dataType.simpleString()}, host string, path string, rule string, verdict string, weight long"
    return parts.mapInArrow(judge, schema).withColumnRenamed("id", id_col)
