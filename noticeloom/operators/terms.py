"""Occurrences of a term table of any size, found in the texts and matched by joins.

Two bitmaps of fixed size are filled from the terms in tasks and merged: one over the hashes of their first
``GRAM`` characters, one over the hashes of whole terms. They travel to the texts. A text's prefix hashes
give the hash of any part of it in one step, so every place is tested against the first bitmap, and what
passes against the second one for each length that terms have. What is left are nearly always true
occurrences; they meet the term table by their own text, which settles them and brings the labels. So the
shuffle carries hits and not texts or grams, and terms that share a beginning never try each other's texts.

A fuller bitmap lets more candidates through and loses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 8  # characters by which a place is looked at first; shorter terms by themselves
GRAM_BITS, TERM_BITS = 22, 24  # bits of the two maps, as powers of two: half a megabyte and two
CHUNK = 1 << 18  # characters of a text that are hashed at a time
HIT = "array<struct<start:int,end:int,term:string>>"
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _codes(text: str) -> np.ndarray:
    """Code points, spread over 64 bits."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    points *= np.uint64(0xD6E8FEB86659FD93)
    return points ^ (points >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(0, n - 1), base, np.uint64)])[:n]


class Prefixes:
    """Hashes of all parts of a text: sums of code points times powers, shifted back to a common power."""

    def __init__(self, size: int):
        self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def of(self, codes: np.ndarray) -> np.ndarray:
        return np.r_[np.uint64(0), np.cumsum(codes * self.up[: len(codes)], dtype=np.uint64)]

    def parts(self, sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        h = (sums[starts + length] - sums[starts]) * self.down[starts] + np.uint64(length)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _place(hashes: np.ndarray, bits: int, turn: int) -> np.ndarray:
    """The first or the second bit of hashes in a map."""
    return (hashes * np.uint64(_BASE) if turn else hashes) >> np.uint64(64 - bits)


def _held(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1


class Known:
    """What the texts are told about the terms: both maps, and the lengths of terms."""

    def __init__(self, grams: np.ndarray, whole: np.ndarray, lengths: list[int]):
        self.grams, self.whole = grams, whole
        self.short = [n for n in lengths if n < GRAM]
        self.long = [n for n in lengths if n >= GRAM]
        self.most = max(lengths, default=1)
        self.prefixes = Prefixes(CHUNK + self.most)

    def hits(self, text: str) -> list[tuple[int, int, str]]:
        """Likely occurrences; those of one term do not overlap each other."""
        return self.hits_of([text])[0]

    def hits_of(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """Likely occurrences in each text. Short texts are hashed together, so a length costs a step per chunk and not per text."""
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        for pieces in self._chunks(texts):
            self._search(pieces, found)
        return [self._apart(text, sorted(places)) for text, places in zip(texts, found)]

    def _chunks(self, texts: list[str]) -> Iterator[list[tuple[int, int, str]]]:
        """Texts as lists of (text, place in it, piece) of bounded length; the pieces of a long text reach into the next one."""
        held, size = [], 0
        for i, text in enumerate(texts):
            if len(text) > CHUNK:
                yield from ([(i, at, text[at : at + CHUNK + self.most - 1])] for at in range(0, len(text), CHUNK))
                continue
            if size + len(text) > CHUNK:
                yield held
                held, size = [], 0
            if text:
                held.append((i, 0, text))
                size += len(text)
        if held:
            yield held

    def _search(self, pieces: list[tuple[int, int, str]], found: list[list[tuple[int, int]]]) -> None:
        sums = self.prefixes.of(_codes("".join(piece for *_, piece in pieces)))
        ends = np.cumsum([len(piece) for *_, piece in pieces])
        room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(ends[-1])  # characters from a place to the end of its text
        starts = np.arange(min(CHUNK, len(room)))
        near = self._tested(sums, room, starts, GRAM, self.grams, GRAM_BITS) if self.long else starts[:0]
        for length, some in [(n, starts) for n in self.short] + [(n, near) for n in self.long if len(near)]:
            for place in self._tested(sums, room, some, length, self.whole, TERM_BITS).tolist():
                k = int(np.searchsorted(ends, place, "right"))
                i, at, piece = pieces[k]
                found[i].append((at + place - int(ends[k]) + len(piece), length))

    @staticmethod
    def _apart(text: str, places: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
        free: dict[str, int] = {}
        out = []
        for start, length in places:
            term = text[start : start + length]
            if start >= free.get(term, 0):
                free[term] = start + length
                out.append((start, start + length, term))
        return out

    def _tested(self, sums: np.ndarray, room: np.ndarray, starts: np.ndarray, length: int, words: np.ndarray, bits: int) -> np.ndarray:
        inside = starts[room[starts] >= length]
        hashes = self.prefixes.parts(sums, inside, length)
        for turn in range(2):  # the second bit is asked for what the first one let through
            kept = _held(words, _place(hashes, bits, turn))
            inside, hashes = inside[kept], hashes[kept]
        return inside


def known_terms(terms: DataFrame) -> Known:
    """The maps of a table with ``term``, no longer than their fixed size on the driver, and its lengths."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.zeros(1 << (bits - 6), np.uint64) for bits in (GRAM_BITS, TERM_BITS)]
        lengths: set[int] = set()
        for batch in batches:
            for term in batch.column(0).to_pylist():
                codes, n = _codes(term), len(term)
                prefixes = Prefixes(n)
                sums = prefixes.of(codes)
                lengths.add(n)
                wanted = [(1, n, TERM_BITS)] + ([(0, GRAM, GRAM_BITS)] if n >= GRAM else [])
                for which, length, bits in wanted:
                    own = prefixes.parts(sums, np.zeros(1, np.int64), length)
                    for place in (int(_place(own, bits, turn)[0]) for turn in range(2)):
                        maps[which][place >> 6] |= np.uint64(1 << (place & 63))
        kinds, words, values = [np.full(len(lengths), 2)], [np.array(sorted(lengths), np.int64)], [np.zeros(len(lengths), np.int64)]
        for which, words_of in enumerate(maps):
            some = np.flatnonzero(words_of)
            kinds.append(np.full(len(some), which))
            words.append(some)
            values.append(words_of[some].view(np.int64))
        columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in (kinds, words, values)]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "word", "value"])

    merged = terms.select("term").mapInArrow(fill, "kind long, word long, value long")
    rows = merged.groupBy("kind", "word").agg(F.bit_or("value").alias("value")).toArrow()  # at most the words of both maps, and the lengths
    kind, word, value = (rows[c].to_numpy() for c in ("kind", "word", "value"))
    maps = []
    for which, bits in enumerate((GRAM_BITS, TERM_BITS)):
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[word[kind == which]] = value[kind == which].view(np.uint64)
        maps.append(words)
    return Known(*maps, sorted(word[kind == 2].tolist()))


def term_hits(df: DataFrame, terms: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Rows ``keep, start, end, label`` of every occurrence of a (label, term) table; empty terms never occur.

    Occurrences of one term do not overlap each other, those of different terms may.
    """
    clean = terms.select("label", "term").filter(F.length("term") > 0).distinct()
    known = df.sparkSession.sparkContext.broadcast(known_terms(clean))  # of fixed size, but for the lengths

    @F.pandas_udf(HIT)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = known.value.hits_of([x or "" for x in batch])
            yield pd.Series([[{"start": s, "end": e, "term": t} for s, e, t in hits] for hits in found])

    found = df.select(*keep, F.explode(find(F.col(text))).alias("_hit")).select(*keep, "_hit.*")
    return found.join(clean, "term").select(*keep, "start", "end", "label")
