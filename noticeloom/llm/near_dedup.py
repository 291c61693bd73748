"""Near duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Two small collections of ``side`` keys are drawn per set, each key of two minimum hashes. The tables of
the search are all pairs of a key of one collection and a key of the other: ``side ** 2`` tables of four
hashes for ``4 * side`` hash functions. A key that no other set shares cannot be part of a shared pair,
so single keys are counted first and only pairs of shared keys are formed.

Sets that are equal are one class from the start. A table's members are not paired with each other: each
is held against the table's centre, the member that meets most others, on the full sets of both texts.
What a member lacks of its centre and what it adds are kept; members linked to the centre are one
component. Any other member still needs its links to the rest of the centre's group: sizes of full
intersections follow from the differences, so blocks of a group are compared as matrices in a task,
without a row per pair and without the texts. No link of a table is dropped to bound a group.
Components come from label propagation with short cuts over tables in the shared folder.

A pair at exactly the wanted similarity of 0.8 is missed with a probability of about 2 * (1 - 0.64) ** side.
Shingles are told apart by a 64-bit hash.

Defined results: a text without words, or null, is an empty set, linked with nothing; a text of fewer
words than a shingle is one shingle; in :func:`components` rows with a null id are linked with nothing, have
a null component and are kept, as in the SQL, and a component is named by its smallest id; :func:`near_dedup`
tells documents apart by id and text and rows without an id by their row, links them all and keeps one
document of each component; rows that repeat an id and a text are one document and are kept or dropped together; an
empty table gives an empty result; other columns are untouched whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import ROW, columns_of, stored, text_of, with_rows

NUMBER = "__llm_number"
WORDS = 5
PERCENT = 80
SIDE = 10
MEMO_WORDS = 300_000
CHUNK = 1 << 16
BLOCK_ROWS = 1024  # members of a group in one block
_ODD = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HASHES = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Shingles:
    """The set of a text's word shingles as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.words, self.memo = words, {}

    def of(self, text: bytes) -> np.ndarray:
        found = text.lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        for w in set(found).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
        n = min(self.words, len(h))
        total = np.full(len(h) - n + 1, np.uint64(n))
        for i in range(n):
            total = total + _mixed(h[i : len(h) - n + 1 + i] * _ODD[i])
        return np.unique(_mixed(total))


def collections(sets: list[np.ndarray], side: int) -> np.ndarray:
    """For each non-empty set its ``2 * side`` keys, each of two minimum hashes."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    every = np.concatenate(sets)
    out = np.zeros((len(sets), 2 * side), np.uint64)
    for j in range(4 * side):
        lows = np.minimum.reduceat((every ^ _HASHES[0, j]) * _HASHES[1, j], starts)
        out[:, j // 2] = _mixed(out[:, j // 2] + lows + np.uint64(j // 2 + 1))
    return out


def signatures(df: DataFrame, id_col: str, text_col: str, words: int, side: int) -> DataFrame:
    """``id, text_key, n, set_key, a, b``: a set's size and digest, and its two collections of keys."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            sets = [shingles.of(t) for t in batch.column(2).to_pylist()]
            keys = np.zeros((len(sets), 2 * side), np.uint64)
            some, held = [], 0
            for i, s in enumerate([*sets, None]):
                if some and (s is None or held > CHUNK):
                    keys[some] = collections([sets[k] for k in some], side)
                    some, held = [], 0
                if s is not None and len(s):
                    some.append(i)
                    held += len(s)
            both = pa.array(keys.view(np.int64).reshape(-1))
            lists = pa.FixedSizeListArray.from_arrays(both, 2 * side).cast(pa.list_(pa.int64()))
            digests = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), lists],
                names=["id", "text_key", "n", "set_key", "keys"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("text_key"), text_of(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(sign, "id long, text_key long, n long, set_key binary, keys array<long>")


def text_key(text_col: str) -> Column:
    return F.xxhash64(text_of(text_col))


def _tables(classes: DataFrame) -> DataFrame:
    """``cid, n, key`` of the tables' shared keys, from single keys that more than one class has."""
    single = classes.select("cid", F.explode("keys").alias("key"))
    shared = single.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key")
    own = single.join(stored(shared, "near-shared").hint("merge"), "key", "left_semi").groupBy("cid").agg(F.collect_set("key").alias("shared"))
    half = F.size("keys") / 2
    first, second = (F.array_intersect(F.slice("keys", start, half.cast("int")), "shared") for start in (F.lit(1), (half + 1).cast("int")))
    keys = F.flatten(F.transform(first, lambda x: F.transform(second, lambda y: F.xxhash64(x, y))))
    pairs = stored(classes.join(own, "cid").select("cid", "n", F.explode(keys).alias("key")), "near-pairs")
    several = pairs.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    return stored(pairs.join(stored(several, "near-several").hint("merge"), "key"), "near-tables")


def _similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _differences(stars: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Each star ``x, y`` on full sets: whether it is linked, and in groups of ``several`` how x differs from its centre y.

    ``lacks`` has a bit for each shingle of the centre, ``adds`` the shingles of x that the centre has not.
    """
    named = classes.select("cid", "id", "text_key")
    pairs = stars
    for side in "xy":
        pairs = pairs.join(named.select(F.col("cid").alias(side), F.col("id").alias(f"id_{side}"), F.col("text_key").alias(f"text_key_{side}")), side)
    pairs = stored(pairs, "near-stars")
    needed = pairs.select(F.explode(F.array(*[F.struct(F.col(f"id_{s}").alias("id"), F.col(f"text_key_{s}").alias("text_key")) for s in "xy"])).alias("r"))
    needed = stored(needed.select("r.*").distinct(), "near-needed")
    # What is needed grows with the input, so it is never broadcast, however small it is.
    one = texts.join(needed.hint("merge"), ["id", "text_key"], "left_semi")
    one = stored(one.groupBy("id", "text_key").agg(F.any_value("text").alias("text")), "near-texts")  # repeated rows have one text

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, recent = Shingles(words), OrderedDict()

        def set_of(cid: int, text: bytes) -> np.ndarray:
            found = recent.pop(cid, None)
            if found is None:
                found = shingles.of(text)
            recent[cid] = found
            if len(recent) > 32:
                recent.popitem(last=False)
            return found

        for batch in batches:
            xs, ys, several, tx, ty = (batch.column(i).to_pylist() for i in range(5))
            cols = [[] for _ in range(5)]
            for x, y, more, own, centre in zip(xs, ys, several, tx, ty):
                sx, sy = set_of(x, own), set_of(y, centre)
                held = np.isin(sy, sx, assume_unique=True)
                both = int(held.sum())
                adds = np.setdiff1d(sx, sy, assume_unique=True) if more else sx[:0]
                linked = 100 * both >= percent * (len(sx) + len(sy) - both)
                for c, v in zip(cols, (linked, len(sx), len(sy), np.packbits(~held).tobytes() if more else b"", adds.tobytes())):
                    c.append(v)
            kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["x", "y", "several", "linked", "n", "n_centre", "lacks", "adds"],
            )

    for side in "xy":
        text = one.select(F.col("id").alias(f"id_{side}"), F.col("text_key").alias(f"text_key_{side}"), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(text.hint("merge"), [f"id_{side}", f"text_key_{side}"])
    schema = "x long, y long, several boolean, linked boolean, n long, n_centre long, lacks binary, adds binary"
    return pairs.select("x", "y", "several", "text_x", "text_y").mapInArrow(differ, schema)


def _shared_counts(some: np.ndarray, flags: np.ndarray, width: int = 2048) -> np.ndarray:
    """For rows ``some`` against all rows: in how many columns both have a flag."""
    total = np.zeros((len(some), len(flags)), np.float32)
    for at in range(0, flags.shape[1], width):
        part = flags[:, at : at + width].astype(np.float32)
        total += part[some] @ part.T
    return total


def links_within(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of the members of one block, or between two, that are not linked to the centre both."""
    some = np.flatnonzero(~group["linked"].to_numpy())
    ids, own, n = (group[c].to_numpy() for c in ("x", "own", "n"))
    m, n_centre = len(group), int(group["n_centre"].iloc[0])
    lacks = np.stack([np.unpackbits(np.frombuffer(b, np.uint8), count=n_centre) for b in group["lacks"]])
    adds = [np.frombuffer(b, np.uint64) for b in group["adds"]]
    tokens, place, seen = np.unique(np.concatenate(adds), return_inverse=True, return_counts=True)
    column = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)[place]  # only what two members add can be common
    row = np.repeat(np.arange(m), [len(x) for x in adds])
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    missing = lacks.sum(axis=1, dtype=np.int64)
    both = n_centre - missing[some][:, None] - missing[None, :] + _shared_counts(some, lacks)
    for at in range(0, int((seen > 1).sum()), 2048):
        a, b = np.searchsorted(column, [at, at + 2048])
        flags = np.zeros((m, 2048), np.uint8)
        flags[row[a:b], column[a:b] - at] = 1
        both += _shared_counts(some, flags)
    linked = 100 * both >= percent * (n[some][:, None] + n[None, :] - both)
    linked &= ids[some][:, None] != ids[None, :]
    if len(np.unique(own)) > 1:
        linked &= own[some][:, None] != own[None, :]
    x, y = np.nonzero(linked)
    return pd.DataFrame({"x": ids[some[x]], "y": ids[y]})


def _rest(different: DataFrame, percent: int) -> DataFrame:
    """Links between members of a centre's group of which one at least is not linked to the centre."""
    groups = different.filter("several").groupBy("y").agg(F.count("*").alias("members"), F.count(F.when(~F.col("linked"), 1)).alias("loose"))
    groups = stored(groups.filter("loose > 0 and members > 1").select("y", F.ceil(F.col("members") / BLOCK_ROWS).alias("blocks")), "near-groups")
    own = different.filter("several").join(groups, "y").withColumn("own", F.pmod(F.xxhash64("x"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = own.withColumn("other", other).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def links(group: pd.DataFrame) -> pd.DataFrame:
        return links_within(group, percent)

    kept = dealt.select("y", "low", "high", "own", "x", "linked", "n", "n_centre", "lacks", "adds")
    return kept.groupBy("y", "low", "high").applyInPandas(links, "x long, y long").distinct()


def _components(links: DataFrame) -> DataFrame:
    """``cid, comp`` of all classes that a link touches; ``comp`` is the smallest class reachable.

    Labels move along links and jump to their label's label, so long chains fold up in a few turns.
    """
    edges = stored(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "near-edges")
    labels = stored(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("comp")).withColumnRenamed("x", "cid"), "near-labels")
    while True:
        met = edges.join(labels, edges["y"] == labels["cid"]).groupBy("x").agg(F.min("comp").alias("met"))
        moved = labels.join(met, labels["cid"] == met["x"]).select("cid", "comp", F.least("comp", "met").alias("low"))
        roots = labels.select(F.col("cid").alias("low"), F.col("comp").alias("root"))
        nearer = stored(moved.join(roots, "low", "left").select("cid", F.least("low", "root").alias("comp"), (F.least("low", "root") < F.col("comp")).alias("changed")), "near-labels")
        changed = nearer.filter("changed").limit(1).count()
        labels = nearer.drop("changed")
        if not changed:
            return labels


def components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, side: int = SIDE,
) -> DataFrame:
    """Per row ``id, text_key, n_shingles, component_id, kept``."""
    signed = stored(signatures(df, id_col, text_col, words, side), "near-signatures")
    sets = signed.filter(F.col("id").isNotNull() & F.col("set_key").isNotNull())
    grouped = sets.groupBy("set_key").agg(F.min(F.struct("id", "text_key", "n", "keys")).alias("r"))
    classes = stored(grouped.select(F.monotonically_increasing_id().alias("cid"), "set_key", "r.*"), "near-classes")
    texts = df.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("text_key"), text_of(text_col).cast("binary").alias("text"))
    texts = texts.filter(F.col("id").isNotNull())

    members = _tables(classes)
    met = members.groupBy("cid").agg(F.sum("members").alias("met"))
    ranked = stored(members.join(met, "cid"), "near-ranked")
    centre = F.max(F.struct("met", (-F.col("cid")).alias("no"), "n"))
    centres = stored(ranked.groupBy("key").agg(centre.alias("c")).select("key", (-F.col("c.no")).alias("y"), F.col("c.n").alias("n_y")), "near-centres")
    star = ranked.join(centres, "key").filter(F.col("cid") != F.col("y"))
    star = stored(star.select(F.col("cid").alias("x"), "y", _similar_sizes(F.col("n"), F.col("n_y"), percent).alias("alike")).distinct(), "near-star")
    groups = star.groupBy("y").agg((F.count("*") > 1).alias("several"))
    star = star.join(groups, "y").filter(F.col("several") | F.col("alike")).drop("alike")
    different = stored(_differences(star, classes, texts, words, percent), "near-differences")
    links = different.filter("linked").select("x", "y").unionByName(_rest(different, percent))
    labels = _components(stored(links, "near-links"))

    found = classes.select("set_key", "cid", "id").join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    smallest = found.groupBy("comp").agg(F.min("id").alias("component_id"))
    by_set = stored(found.join(smallest, "comp").select("set_key", "component_id"), "near-found")
    out = signed.join(by_set.withColumnRenamed("set_key", "of"), F.col("set_key") == F.col("of"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select("id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with a number per document: of its id and text, or of its row where the id is null."""
    named = df.filter(F.col(id_col).isNotNull()).withColumn(NUMBER, F.xxhash64(F.col(id_col).cast("long"), text_key(text_col)))
    unnamed = with_rows(df.filter(F.col(id_col).isNull()), "near-unnamed")
    return named.unionByName(unnamed.withColumn(NUMBER, F.xxhash64(F.lit("unnamed"), ROW)).drop(ROW))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay: one document of each component, the one with the smallest id; a null id comes last."""
    numbered = _numbered(df, id_col, text_col)
    ids = numbered.select(F.col(NUMBER).alias("no"), F.col(id_col).cast("long").alias("own")).distinct()
    found = components(numbered, NUMBER, text_col, **options).select(F.col("id").alias("no"), F.col("component_id").alias("component")).distinct()
    members = stored(found.join(ids, "no"), "near-members")
    first = members.groupBy("component").agg(F.min(F.struct(F.col("own").isNull().alias("last"), "own", "no")).alias("first"))
    dropped = members.join(first.select(F.col("first.no").alias("no")), "no", "left_anti").select(F.col("no").alias("__llm_no"))
    return numbered.join(dropped, F.col(NUMBER) == F.col("__llm_no"), "left_anti").select(columns_of(df))
