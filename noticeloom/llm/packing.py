"""Best-fit packing of token sequences by exact-complement hashing.

How many sequences hold which lengths depends only on the counts of lengths, and there are at most
``budget`` of those. So the plan is made from a histogram of fixed size: for each length from the
longest down, the gap it leaves is looked up in the sums of single lengths, pairs and triples, and a
combination that fills it exactly is consumed as often as the counts allow. Each step uses up a
length, so the plan stays small whatever the corpus holds. What is left goes by best fit, also in runs
of equal lengths.

Tokenising is a map. A piece's rank among the pieces of its length comes from counts per block (one
map task's rows) and length; the plan gives each rank its sequence and offset. No rows are gathered:
a length held by a third of all pieces is ranked block by block.

Defined results: a null or empty text is the end token alone; a null id is packed like any other;
repeated rows are packed each; a text longer than the budget is cut into full pieces and a last one;
an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm.common import stored

BUDGET = 4096
END = 1
MEMO_WORDS = 400_000  # words a worker remembers; the memory is emptied beyond it
_SIMPLE = re.compile("[a-zß-öø-ÿ]+")  # lower-case letters no normalisation changes
_POINTS = frozenset(b".,;:!?")


def ids_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens:
    """Token ids of a text as little-endian bytes, word by word.

    The tokenizer lower-cases and never joins across white space, so a text's ids are those of its
    words. A word of plain letters is one unit of the vocabulary's model; any other word, and a text
    that may hold a special token, goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; a pool of threads only costs memory
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        # How the vocabulary writes a letter's bytes.
        self.written = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(ord("a"), 256) if _SIMPLE.fullmatch(chr(c))}
        self.memo: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [ids_bytes(e.ids) for e in found]

    def _learn(self, words: set[bytes]) -> None:
        memo, odd = self.memo, []
        for w in words:
            stem, tail = (w[:-1], w[-1:]) if w[-1] in _POINTS else (w, b"")
            letters = stem.decode()
            if _SIMPLE.fullmatch(letters):
                ids = memo.get(stem)
                if ids is None:
                    ids = memo[stem] = ids_bytes([t.id for t in self.model.tokenize(letters.translate(self.written))])
                if tail:
                    memo[w] = ids + memo[tail]
            elif w not in memo:
                odd.append(w)
        memo.update(zip(odd, self._whole([w.decode() for w in odd])))

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 100):
            if len(self.memo) > MEMO_WORDS or not self.memo:
                self.memo = {bytes([p]): self._whole([chr(p)])[0] for p in _POINTS}
            some = texts[at : at + 100]
            words = [[] if "<|" in t else t.encode().lower().split() for t in some]
            self._learn(set().union(*words).difference(self.memo))
            get = self.memo.__getitem__
            out += [self._whole([t])[0] if "<|" in t else b"".join(map(get, found)) for t, found in zip(some, words)]
        return out


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One per worker process, kept for its next tasks."""
    return WordTokens(path)


def tokenised(df: DataFrame, path: str, id_col: str, text_col: str, budget: int, with_ids: bool) -> DataFrame:
    """Pieces with ``block, nth``: the writing task and the place among its pieces of that length."""
    id_type = df.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(path)
        seen: dict[int, int] = defaultdict(int)
        block = TaskContext.get().partitionId()
        end = ids_bytes([END])
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            rows, cols = [], [[] for _ in range(6)]
            for i, raw in enumerate(words.encode(texts)):
                raw += end
                for piece, at in enumerate(range(0, len(raw), 4 * budget)):
                    part = raw[at : at + 4 * budget]
                    n = len(part) // 4
                    rows.append(i)
                    for c, v in zip(cols, (piece, at // 4, n, zlib.crc32(part), seen[n], part if with_ids else None)):
                        c.append(v)
                    seen[n] += 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            names = ["id", "piece", "start", "length", "ids_crc32", "nth", "ids", "block"]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), *arrays, pa.array([block] * len(rows), pa.int64())], names=names)

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long, nth long, ids binary, block long"
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


class Complements:
    """Counts of lengths, and the combinations of one to three of them with a wanted sum."""

    def __init__(self, counts: dict[int, int], budget: int):
        self.left = np.zeros(budget + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def _pair(self, total: int, top: int) -> tuple[int, int] | None:
        """Two lengths of at most ``top`` with that sum, as unequal as can be."""
        low = np.arange(max(1, total - top), total // 2 + 1)
        if len(low) == 0:
            return None
        hits = np.flatnonzero((self.left[low] > 0) & (self.left[total - low] > 0) & ((2 * low != total) | (self.left[low] > 1)))
        return (total - int(low[hits[0]]), int(low[hits[0]])) if len(hits) else None

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """The combination with the longest member that fills the gap: a single, a pair, or a triple."""
        if self.left[gap] > 0:
            return (gap,)
        if pair := self._pair(gap, gap - 1):
            return pair
        for first in (np.flatnonzero(self.left[1 : max(gap - 1, 1)]) + 1)[::-1].tolist():
            if 3 * first < gap:
                break
            self.left[first] -= 1
            pair = self._pair(gap - first, first)
            self.left[first] += 1
            if pair:
                return (first, *pair)
        return None

    def take(self, lengths: tuple[int, ...]) -> int:
        """Consume the combination as often as the counts allow."""
        times = min(int(self.left[n]) // lengths.count(n) for n in set(lengths))
        for n in lengths:
            self.left[n] -= times
        return times


def plan(counts: dict[int, int], budget: int = BUDGET) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in order, how many such sequences)."""
    index, patterns = Complements(counts, budget), []
    for length in range(budget, 0, -1):
        while index.left[length] > 0:
            index.left[length] -= 1
            rest = index.filling(budget - length) if length < budget else ()
            index.left[length] += 1
            if rest is None:
                break
            patterns.append(((length, *rest), index.take((length, *rest))))
    # Best fit of what is left: open sequences by room, each room a list of [lengths, how many].
    rooms: dict[int, list[list]] = defaultdict(list)
    order: list[int] = []
    for length in range(budget, 0, -1):
        n = int(index.left[length])
        while n:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                lengths, times, room = (), n, budget
            else:
                room = order[at]
                lengths, held = rooms[room].pop()
                times = min(held, n)
                if held > times:
                    rooms[room].append([lengths, held - times])
                if not rooms[room]:
                    del order[at]
            if times == n and not lengths and budget // length > 1:  # new sequences take several at once
                each = min(budget // length, n)
                times, grown = n // each, (length,) * each
                n -= times * each
            else:
                grown = (*lengths, length)
                n -= times
            left = room - sum(grown) + sum(lengths)
            if not rooms[left]:
                bisect.insort(order, left)
            rooms[left].append([grown, times])
    return patterns + [(tuple(lengths), times) for held in rooms.values() for lengths, times in held]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence and offset of each run of ranks."""
    used: dict[int, int] = defaultdict(int)
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    first = 0
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            runs[n].append((used[n], first, offset))
            used[n] += times
            offset += n
        first += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*found)) for n, found in runs.items()}


def pack(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET, with_ids: bool = False,
) -> DataFrame:
    """Per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset`` and, if wanted, its ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers. ``path`` names the tokenizer's file on every machine.
    """
    pieces = stored(tokenised(df, path, id_col, text_col, budget, with_ids), "packing-pieces")
    by_block = stored(pieces.groupBy("block", "length").agg(F.count("*").alias("n")), "packing-counts")
    totals = {r["length"]: r["n"] for r in by_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `budget` rows
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_block.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    # Never broadcast: there is a row per block and length, so the table grows with the input.
    ranked = pieces.join(offsets.hint("merge"), ["block", "length"]).withColumn("rank", F.col("earlier") + F.col("nth"))
    table = df.sparkSession.sparkContext.broadcast(places(plan(totals, budget)))  # bounded by the budget, not the rows

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths, ranks):
        import pandas as pd

        n, r = lengths.to_numpy(), ranks.to_numpy()
        out = np.zeros((2, len(n)), np.int64)
        for length in np.unique(n).tolist():
            here = np.flatnonzero(n == length)
            start, first, offset = table.value[length]
            run = np.searchsorted(start, r[here], "right") - 1
            out[0, here], out[1, here] = first[run] + r[here] - start[run], offset[run]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    found = ranked.withColumn("place", place("length", "rank"))
    kept = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"]
    return found.select(*kept, *(["ids"] if with_ids else []))
