"""Repeated byte strings by prefix-free parsing of the corpus.

Rolling hashes choose triggers: the smallest 16-byte hash of each window of ``length`` bytes. Equal
windows have equal triggers, so a repeat never falls between phrases. A phrase is all the text whose
windows share a trigger, and the parse of a document is its list of phrases. Neither the suffix array of
the dictionary nor that of the parse is built and nothing is combined into corpus order; groups of equal
hashes stand in for both, for only equality is asked for and a phrase that came before stands for all its
windows at once. So the corpus is settled in three rounds, each over far fewer entries than the one before:

1. triggers: a window whose trigger no other document has is not repeated;
2. phrases with a shared trigger, and the 33-byte strings to either side of it, one of which any
   repeated window holds: a phrase that a smaller document has is covered whole;
3. windows: those of the phrases that are left, each by the hash of its first ``length`` bytes.

A round is one exchange: each block of documents sends its distinct entries, sorted, in one row per
bucket of hashes, and gets two bits per entry back. An entry in a third of all documents is one number
per block. Order within a bucket is that of 64-bit fingerprints of the entries, not of their bytes:
equal strings are neighbours in either order, and bytes would have to travel. Two different strings
count as one with a probability of about n * n / 2 ** 65 among n entries.

Blocks of texts are compressed once and kept in the partitions of their number, so a round moves its
bits only.

Defined results: a null text is empty, with nothing removed; texts shorter than ``length`` are never
touched; only strictly smaller ids cover, so rows that repeat an id leave each other alone; a null id
sorts last and covers nothing; very long texts are parsed in segments, whose windows are all looked at;
an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import stored, text_of

LENGTH = 50
GRAM = 16
BLOCK_BYTES = 1 << 20
SEGMENT = 1 << 18
BUCKET_BYTES = 32 << 20  # text per bucket of an exchange
LEAST_BUCKETS = 96
LAST_ID = np.iinfo(np.int64).max
OTHER, SMALLER = 1, 2  # bits of an answer: in another block's documents; in a smaller document
_BASE = 0x9E3779B97F4A7C15
PACK, UNPACK = zstandard.ZstdCompressor(3), zstandard.ZstdDecompressor()
_TAGS = {name: np.uint64(i) for i, name in enumerate(("trigger", "left", "right", "phrase", "window", "key"), 1)}


def _mixed(x: np.ndarray, tag: str) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + _TAGS[tag]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(31))


def rolling(text: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """For each size the hash of every substring of that size, by doubling."""
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    whole, n = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD), 1
    parts = dict.fromkeys(sizes, (None, 0))
    while True:
        for size in sizes:
            if size & n:  # append this power of two to what the size has so far
                held, done = parts[size]
                if held is None:
                    parts[size] = whole, n
                else:
                    m = len(text) - done - n + 1
                    parts[size] = held[:m] * power(n) + whole[done : done + m], done + n
        if 2 * n > max(sizes):
            return {size: held for size, (held, _) in parts.items()}
        whole = whole[: len(whole) - n] * power(n) + whole[n:]
        n *= 2


def _spread(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each run of ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        x = best(x[:-n], x[n:])
        n *= 2
    return best(x[: len(x) - (width - n)], x[width - n :]) if n < width else x


class Parse:
    """Phrases of one segment: trigger places, and each phrase's first and last window."""

    def __init__(self, text: np.ndarray, length: int):
        width = length - GRAM + 1
        self.half = (length - GRAM) // 2
        self.side = self.half + GRAM  # 33 of 50
        hashes = rolling(text, [GRAM, self.side, length])
        grams, self.sides, self.windows = _mixed(hashes[GRAM], "trigger"), hashes[self.side], hashes[length]
        low = _spread(grams, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        places = np.flatnonzero(_spread(np.concatenate([edge, low, edge]), width, np.maximum) == grams)
        # The first window whose smallest hash stands at the place; of equal hashes the rightmost counts.
        start, open_ = np.maximum(places - width + 1, 0), np.arange(len(places))
        while len(open_ := open_[low[start[open_]] != grams[places[open_]]]):
            start[open_] += 1
        kept = np.r_[start[1:] != start[:-1], True]
        self.first, self.trigger = start[kept], places[kept]
        self.last = np.r_[self.first[1:] - 1, len(low) - 1]
        self.key = _mixed(grams[self.trigger], "key")  # triggers have small hashes; their keys go to all buckets alike
        self.doc = np.zeros(len(self.first), np.int64)

    def within(self, at: int, starts: np.ndarray, ends: np.ndarray) -> Parse:
        """Phrases cut to the windows inside one document; ``at`` is the segment's place, ``ends`` the last windows'.

        Windows that cross into the next document outnumber those of a phrase, so no phrase has two documents.
        """
        first, last = self.first + at, self.last + at
        doc = np.searchsorted(starts, first, "right") - 1
        doc = np.where(first <= ends[doc], doc, np.searchsorted(starts, last, "right") - 1)
        first, last = np.maximum(first, starts[doc]), np.minimum(last, ends[doc])
        kept = first <= last
        self.first, self.last, self.trigger, self.key, self.doc = first[kept] - at, last[kept] - at, self.trigger[kept], self.key[kept], doc[kept]
        return self

    def phrases(self, some: np.ndarray) -> np.ndarray:
        a, b = self.first[some], self.last[some]
        return _mixed((self.windows[a] * np.uint64(_BASE) + self.windows[b]) * np.uint64(_BASE) + (b - a).astype(np.uint64), "phrase")

    def lefts(self, some: np.ndarray) -> np.ndarray:
        """The string to the left of the trigger; a phrase with no window that far left has none (0)."""
        at = self.trigger[some] - self.half
        return np.where(self.first[some] <= at, _mixed(self.sides[np.maximum(at, 0)], "left"), np.uint64(0))

    def rights(self, some: np.ndarray) -> np.ndarray:
        at = self.trigger[some]
        return np.where(self.last[some] > at - self.half, _mixed(self.sides[np.minimum(at, len(self.sides) - 1)], "right"), np.uint64(0))


class Distinct:
    """Entries (hash, document) of a block as distinct hashes with their smallest and largest document."""

    def __init__(self, hashes: np.ndarray, ids: np.ndarray, buckets: int):
        order = np.argsort(hashes)
        hashes, sorted_ids = hashes[order], ids[order]
        new = np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)]
        starts = np.flatnonzero(new)
        self.hashes = hashes[starts]
        self.low, self.high = (f.reduceat(sorted_ids, starts) if len(starts) else sorted_ids for f in (np.minimum, np.maximum))
        self.bucket = (self.hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # ranges of hashes
        self.group = np.zeros(len(order), np.int64)  # of each entry as given
        self.group[order] = np.cumsum(new) - 1
        self.ids = ids

    def rows(self, block: int, with_ids: bool) -> Iterator[tuple]:
        if len(self.hashes):
            cuts = np.r_[0, np.flatnonzero(self.bucket[1:] != self.bucket[:-1]) + 1, len(self.hashes)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                ids = PACK.compress(self.low[a:b].tobytes()) if with_ids else b""
                yield int(self.bucket[a]), block, self.hashes[a:b].tobytes(), ids, np.packbits(self.low[a:b] != self.high[a:b]).tobytes()

    def answers(self, bits: dict[int, bytes] | None) -> np.ndarray:
        """Two bits for each entry as given: what other blocks hold, and what this one does."""
        found = np.zeros(len(self.hashes), np.uint8)
        if len(self.hashes):
            cuts = np.r_[0, np.flatnonzero(self.bucket[1:] != self.bucket[:-1]) + 1, len(self.hashes)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                two = np.unpackbits(np.frombuffer(bits[int(self.bucket[a])], np.uint8), count=2 * (b - a))
                found[a:b] = two[0::2] * OTHER + two[1::2] * SMALLER
            found |= np.where(self.low != self.high, OTHER, 0).astype(np.uint8)
        each = found[self.group]
        return np.where(self.ids > self.low[self.group], each | SMALLER | OTHER, each)


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: for each entry of each block, whether another block has it, and with a smaller document."""
    hashes = [np.frombuffer(x, np.uint64) for x in rows["hashes"]]
    sizes = [len(x) for x in hashes]
    every, ids = np.concatenate(hashes), np.concatenate([np.frombuffer(UNPACK.decompress(x), np.int64) if x else np.zeros(n, np.int64) for x, n in zip(rows["ids"], sizes)])
    several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["several"], sizes)])
    order = np.argsort(every)
    ranked = every[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    counts = np.diff(np.r_[starts, len(every)])
    group = np.zeros(len(every), np.int64)
    group[order] = np.repeat(np.arange(len(starts)), counts)
    low = np.minimum.reduceat(ids[order], starts)
    other = (counts[group] > 1) | (several > 0)
    two = np.stack([other, low[group] < ids], axis=1).astype(np.uint8)
    ends = np.cumsum(sizes)
    return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "bits": [np.packbits(two[e - n : e]).tobytes() for e, n in zip(ends, sizes)]})


class Block:
    """Texts of one block in segments that overlap by a window less one byte."""

    def __init__(self, packed: bytes, length: int):
        raw = UNPACK.decompress(packed)
        n = int.from_bytes(raw[:8], "little")
        self.ids, self.sizes = (np.frombuffer(raw, np.int64, n, 8 + 8 * n * i) for i in range(2))
        self.known = np.frombuffer(raw, np.uint8, n, 8 + 16 * n).astype(bool)
        self.text = np.frombuffer(raw, np.uint8, offset=8 + 17 * n)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.length = length

    def segments(self) -> list[tuple[int, Parse]]:
        """Place of each segment in the block's text, and its phrases."""
        step, ends = SEGMENT - self.length + 1, self.starts + self.sizes - self.length
        places = range(0, max(len(self.text) - self.length + 1, 0), step)
        return [(at, Parse(self.text[at : at + SEGMENT], self.length).within(at, self.starts, ends)) for at in places]


def pack_block(docs: list[tuple]) -> bytes:
    ids = np.array([LAST_ID if i is None else i for i, _ in docs], np.int64)
    sizes = np.array([len(t) for _, t in docs], np.int64)
    known = np.array([i is not None for i, _ in docs], np.uint8)
    raw = b"".join([len(docs).to_bytes(8, "little"), ids.tobytes(), sizes.tobytes(), known.tobytes(), *(t for _, t in docs)])
    return PACK.compress(raw)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, count, docs, held = TaskContext.get().partitionId(), 0, [], 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([(part << 33) + count], pa.int64()), pa.array([pack_block(docs)], pa.binary())], names=["block", "packed"])

    for batch in batches:
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            docs.append(pair)
            held += len(pair[1])
            if held >= BLOCK_BYTES:
                yield row()
                count, docs, held = count + 1, [], 0
    if docs:
        yield row()


def _entries(block: Block, buckets: int, answers: list[dict[int, bytes]]) -> tuple[Distinct | None, np.ndarray]:
    """The block's entries of the next round, and the windows (by first byte) known to be covered.

    ``answers`` are those of the rounds before; the entries they answer are made again.
    """
    covered = np.zeros(len(block.text) + 1, np.int32)  # +1 where covered bytes start, -1 behind them
    parsed = block.segments()
    if not parsed:
        return Distinct(np.zeros(0, np.uint64), np.zeros(0, np.int64), buckets), covered
    ids = block.ids[np.concatenate([p.doc for _, p in parsed])]
    first = Distinct(np.concatenate([p.key for _, p in parsed]), ids, buckets)
    if not answers:
        return first, covered
    shared = first.answers(answers[0]) & OTHER > 0
    cuts = np.cumsum([0] + [len(p.first) for _, p in parsed])
    some = [np.flatnonzero(shared[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    three = [np.concatenate([make(p, s) for (_, p), s in zip(parsed, some)]) for make in (Parse.phrases, Parse.lefts, Parse.rights)]
    kept = ids[shared]
    second = Distinct(np.concatenate(three), np.tile(kept, 3), buckets)
    if len(answers) == 1:
        return second, covered
    got = second.answers(answers[1]).reshape(3, -1)
    whole = got[0] & SMALLER > 0
    left, right = (got[1] & OTHER > 0) & (three[1] != 0), (got[2] & OTHER > 0) & (three[2] != 0)
    hashes, owners, places, at = [], [], [], 0
    for (start, p), s in zip(parsed, some):
        mine = slice(at, at + len(s))
        at += len(s)
        a, b, mid = p.first[s], p.last[s], p.trigger[s] - p.half + 1
        done = whole[mine]
        np.add.at(covered, start + a[done], 1)
        np.add.at(covered, start + b[done] + block.length, -1)
        for low, high, wanted in ((a, np.minimum(b, mid - 1), left[mine]), (np.maximum(a, mid), b, right[mine])):
            use = wanted & ~done & (low <= high)
            n = (high - low + 1)[use]
            where = np.repeat(low[use] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            hashes.append(_mixed(p.windows[where], "window"))
            owners.append(np.repeat(block.ids[p.doc[s[use]]], n))
            places.append(start + where)
    third = Distinct(np.concatenate(hashes), np.concatenate(owners), buckets)
    if len(answers) == 3:
        hit = np.concatenate(places)[third.answers(answers[2]) & SMALLER > 0]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + block.length, -1)
    return third, covered


def _gathered(batch: pa.RecordBatch, row: int, rounds: int) -> list[dict[int, bytes]]:
    return [{x["bucket"]: x["bits"] for x in batch.column(f"round{r}")[row].as_py() or []} for r in range(rounds)]


def _send(batches: Iterator[pa.RecordBatch], length: int, buckets: int, rounds: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            entries, _ = _entries(Block(batch.column("packed")[k].as_py(), length), buckets, _gathered(batch, k, rounds))
            rows = list(entries.rows(batch.column("block")[k].as_py(), rounds > 0))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    names=["bucket", "block", "hashes", "ids", "several"],
                )


def _finish(batches: Iterator[pa.RecordBatch], length: int, buckets: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            block = Block(batch.column("packed")[k].as_py(), length)
            _, covered = _entries(block, buckets, _gathered(batch, k, 3))
            gone = np.cumsum(covered[:-1]) > 0
            cols = [[] for _ in range(6)]
            for i, known, start, n in zip(block.ids.tolist(), block.known.tolist(), block.starts.tolist(), block.sizes.tolist()):
                mine = gone[start : start + n]
                left = block.text[start : start + n][~mine].tobytes()
                spans = int((mine[1:] & ~mine[:-1]).sum()) + bool(n and mine[0])
                for c, v in zip(cols, (i if known else None, n, int(mine.sum()), spans, hashlib.sha256(left).hexdigest(), left if with_text else None)):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Per row ``id_col, n_bytes, n_removed, n_spans, kept_sha256``, and the bytes ``kept`` if wanted.

    Each byte goes that a ``length``-byte string covers which also starts in a document with a smaller id.
    """
    if length <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    rows = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).cast("binary").alias("text"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = rows.mapInArrow(_blocks, "block long, packed binary").repartition(parts, "block").persist(StorageLevel.DISK_ONLY)
    buckets = max(LEAST_BUCKETS, math.ceil(blocks.count() * BLOCK_BYTES / BUCKET_BYTES))
    carried = blocks
    for turn in range(3):
        sent = carried.mapInArrow(partial(_send, length=length, buckets=buckets, rounds=turn), "bucket long, block long, hashes binary, ids binary, several binary")
        met = sent.groupBy("bucket").applyInPandas(_meet, "block long, bucket long, bits binary")
        answers = stored(met.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"round{turn}")), f"repeats-round{turn}")
        carried = carried.join(answers, "block", "left")
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    out = stored(carried.mapInArrow(partial(_finish, length=length, buckets=buckets, with_text=with_text), schema).withColumnRenamed("id", id_col), "repeats-found")
    blocks.unpersist()
    return out if with_text else out.drop("kept")
