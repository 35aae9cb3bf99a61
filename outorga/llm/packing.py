"""Best-fit packing of token sequences by patterns.

Lengths are put on a grid. Patterns of one to three lengths that fill a sequence exactly are listed, and
how often each should be used is fitted to the histogram of lengths by non-negative least squares. The fit
is rounded to what the histogram can serve and filled with exact lengths, the longest of each grid length first;
lengths left over are packed best-fit by their exact lengths, longest first, as counts, into the space that the
patterns leave and into further sequences, several of one length together. All that is planned is a bounded table
of patterns (at most one row for each length up to the limit); the pieces are then numbered within their length, in
parallel, and each takes the place that the plan has for its number.

Defined results: a null text counts as empty, and an empty one is a piece with the end token alone;
repeated documents are packed each for itself; a null doc_id stays null; an empty table gives an empty result.
Extra columns are not looked at.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.llm.common import stored

LIMIT = 4096
GRID = 512
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal int"
DEALS = 4096  # pieces are dealt round to so many hands, so that no group to be numbered need be large
HAND = 5_000  # pieces of one length that are numbered together, about
CHARS = 2_000_000  # characters tokenized at a time
WORDS = 1_200_000  # words a worker remembers


class Known(dict):
    """Numbers of words; a word met for the first time gets the next one and is noted as new."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        k = self[word] = len(self)
        self.new.append(word)
        return k


class Encoder:
    """Ids of texts, by a dictionary of words between white space. The tokenizer never joins across white
    space, so a text's ids are those of its words; texts with separators that only Python takes for white
    space go through the tokenizer whole."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = "\x01"
        (self.mark_id,) = self._ids(self.mark)
        self._forget()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.known = Known()
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self) -> None:
        words, self.known.new = self.known.new, []
        ids, sizes, at = [], [], 0
        while at < len(words):
            if self.mark in words[at]:
                ids.append(np.array(self._ids(words[at]), np.uint32))
                sizes.append(np.array([len(ids[-1])]))
                at += 1
                continue
            run = words[at : at + 500]
            run = run[: next((k for k, w in enumerate(run) if self.mark in w), len(run))]
            got = np.array(self._ids(f" {self.mark} ".join(run) + f" {self.mark}"), np.uint32)
            sizes.append(np.diff(np.r_[-1, np.flatnonzero(got == self.mark_id)]) - 1)
            ids.append(got[got != self.mark_id])
            at += len(run)
        sizes = np.concatenate(sizes).astype(np.int64)
        self.starts = np.r_[self.starts, len(self.flat) + np.r_[0, np.cumsum(sizes)[:-1]]]
        self.sizes, self.flat = np.r_[self.sizes, sizes], np.concatenate([self.flat, *ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without an end."""
        odd = [any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        parts = [[] if o else t.split() for o, t in zip(odd, texts)]
        if len(self.known) > WORDS:
            self._forget()
        cuts = np.cumsum([0, *map(len, parts)])
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, cuts[-1])
        if self.known.new:
            self._learn()
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        flat = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - sizes), sizes)]
        cuts = np.r_[0, ends][cuts]
        return [np.array(self._ids(t), np.uint32) if o else flat[cuts[i] : cuts[i + 1]] for i, (o, t) in enumerate(zip(odd, texts))]


@cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def _chunks(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > CHARS:
            yield ids[first : i + 1], texts[first : i + 1]
            first, size = i + 1, 0
    yield ids[first:], texts[first:]


def pieces(documents: DataFrame, path: str, limit: int = LIMIT, end: int = END_ID) -> DataFrame:
    """Pieces of at most ``limit`` tokens of each document's ids and the end token, with a checksum of the ids
    and ``deal``, a number that goes round."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, n = encoder(path).encode, 0
        for batch in batches:
            for ids, texts in _chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc_id, tokens in zip(ids, encode(texts)):
                    tokens = np.append(tokens, end).astype("<u4")
                    for k, start in enumerate(range(0, len(tokens), limit)):
                        part = tokens[start : start + limit]
                        rows.append((doc_id, k, start, len(part), zlib.crc32(part.tobytes()), n % DEALS))
                        n += 1
                if rows:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in PIECES.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def fitted(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of one to three grid lengths that fill a sequence, with the repeats that the least-squares fit
    gives them, none more than ``counts`` (by grid length, from 0) can serve."""
    top = len(counts) - 1
    there = np.flatnonzero(counts)
    have = counts > 0
    a, b = np.meshgrid(there, there, indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = top - a - b
    pairs = c == 0
    triples = (c >= b) & (c <= top) & have[np.clip(c, 0, top)]
    pad = top + 1  # stands for no further length
    shapes = np.concatenate([
        np.array([[top, pad, pad]] * int(have[top]), int).reshape(-1, 3), np.c_[a[pairs], b[pairs], np.full(pairs.sum(), pad)], np.c_[a, b, c][triples]])
    if not len(shapes):
        return []
    # long lengths must be met; short ones find a place among the rest
    weight = np.append(0.1 + np.arange(top + 1) / top, 0.0)
    target = np.append(counts, 0) * weight
    x, chosen, active = np.zeros(len(shapes)), [], np.zeros(len(shapes), bool)

    def matrix(which: list[int]) -> np.ndarray:
        m = np.zeros((top + 2, len(which)))
        for k in range(3):
            np.add.at(m, (shapes[which, k], np.arange(len(which))), 1)
        return m * weight[:, None]

    for _ in range(3 * top):  # active sets
        left = (target - matrix(chosen) @ x[chosen]) * weight if chosen else target * weight
        gain = np.where(active, -np.inf, left[shapes].sum(1))
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * max(target.max(), 1):
            break
        chosen.append(best)
        active[best] = True
        while chosen:
            m = matrix(chosen)
            z = np.linalg.solve(m.T @ m + 1e-9 * np.eye(len(chosen)), m.T @ target)
            if (z > 0).all():
                x[chosen] = z
                break
            old = x[chosen]
            falling = z <= 0
            step = np.min(old[falling] / np.maximum(old[falling] - z[falling], 1e-12))
            x[chosen] = old + step * (z - old)
            gone = {c for c, f in zip(chosen, falling) if f and x[c] <= 1e-9}
            if not gone:
                gone = {chosen[int(np.argmin(z))]}
            for c in gone:
                x[c], active[c] = 0, False
            chosen = [c for c in chosen if c not in gone]
    rest, out = counts.copy(), []
    for j in sorted(chosen, key=lambda j: -x[j]):
        shape = tuple(int(v) for v in shapes[j] if v != pad)
        n = min([int(round(x[j])), *[int(rest[v]) // shape.count(v) for v in set(shape)]])
        if n > 0:
            out.append((shape, n))
            for v in shape:
                rest[v] -= n
    return out


#: Sequences alike: (length, copies) of what they hold, and how many there are.
Shapes = list[tuple[tuple[tuple[int, int], ...], int]]


def exact(patterns: list[tuple[tuple[int, ...], int]], counts: np.ndarray, unit: int) -> tuple[Shapes, np.ndarray]:
    """Patterns of grid lengths, cut into runs of exact lengths, and what is left of ``counts`` (by exact length)."""
    rest, out = counts.copy(), []
    longest = np.arange(len(counts) // unit + 2) * unit  # where to look next below each grid length
    for pattern, n in patterns:
        while n:
            used: dict[int, int] = {}
            for v in pattern:
                length = int(longest[v])
                while rest[length] <= used.get(length, 0):
                    length -= 1
                if not used:
                    longest[v] = length
                used[length] = used.get(length, 0) + 1
            times = min(n, *[int(rest[length]) // k for length, k in used.items()])
            for length, k in used.items():
                rest[length] -= times * k
            out.append((tuple(used.items()), times))
            n -= times
    return out, rest


def best_fit(counts: np.ndarray, started: Shapes = ()) -> Shapes:
    """Pack the lengths in ``counts`` longest first, each where the least space is left, many at once: into the
    sequences that are ``started``, then into new ones, as many copies to a sequence as it has room for."""
    top = len(counts) - 1
    groups: dict[int, Shapes] = {}
    for shape, n in started:
        groups.setdefault(top - sum(length * k for length, k in shape), []).append((shape, n))
    spaces = sorted(groups)

    def put(space: int, shape: tuple[tuple[int, int], ...], n: int) -> None:
        if space not in groups:
            insort(spaces, space)
        groups.setdefault(space, []).append((shape, n))

    for length in range(top, 0, -1):
        n = int(counts[length])
        while n:
            at = bisect_left(spaces, length)
            space = spaces[at] if at < len(spaces) else top
            fit = space // length
            if at < len(spaces):
                shape, free = groups[space].pop()
                if not groups[space]:
                    del groups[space], spaces[at]
            else:
                shape, free = (), -(-n // fit)
            full = min(free, n // fit)
            if full:
                put(space - fit * length, (*shape, (length, fit)), full)
                n -= full * fit
            if full < free and n:  # the last ones share a sequence
                put(space - n * length, (*shape, (length, n)), 1)
                full, n = full + 1, 0
            if full < free:
                put(space, shape, free - full)
    return [x for group in groups.values() for x in group]


def plan(counts: np.ndarray, unit: int) -> Shapes:
    """Shapes of exact lengths and repeats that take up ``counts`` (by exact length, from 0) exactly."""
    grid = np.zeros(-(-len(counts) // unit) + 1, np.int64)
    np.add.at(grid, -(-np.arange(len(counts)) // unit), counts)
    started, rest = exact(fitted(grid[: (len(counts) - 1) // unit + 1]), counts, unit)
    return best_fit(rest, started)


def packed(pieces: DataFrame, limit: int = LIMIT, grid: int = GRID) -> DataFrame:
    """The (stored) pieces with sequence_id and offset."""
    spark = pieces.sparkSession
    size = F.col("length").cast("int")
    histogram = pieces.groupBy(size.alias("size")).count().collect()  # at most ``limit`` rows
    counts = np.zeros(limit + 1, np.int64)
    for r in histogram:
        counts[r["size"]] = r["count"]
    runs, first = {}, 0
    for shape, n in plan(counts, -(-limit // grid)):  # per length: place in a shape, copies, first sequence, repeats
        slot = 0
        for length, copies in shape:
            runs.setdefault(length, []).append((slot, copies, first, n))
            slot += copies
        first += n
    table = []
    for length in sorted(runs):
        rank = 0
        for slot, copies, sequence, n in runs[length]:
            table.append(((length << 40) + rank, slot, copies, sequence))
            rank += n * copies
    keys, slots, copies_, firsts = np.array(table, np.int64).reshape(-1, 4).T

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            key = (f["size"].to_numpy(np.int64) << 40) + f["rank"].to_numpy(np.int64)
            at = np.searchsorted(keys, key, "right") - 1
            far = key - keys[at]
            yield f.drop(columns=["size", "rank"]).assign(sequence_id=firsts[at] + far // copies_[at], slot=slots[at] + far % copies_[at])

    # how many hands the pieces of a length are numbered in: at most ``limit`` rows
    hands = spark.createDataFrame([(n, min(DEALS, -(-int(counts[n]) // HAND))) for n in np.flatnonzero(counts).tolist()], "size int, hands int")
    rows = pieces.withColumn("size", size).join(F.broadcast(hands), "size").withColumn("hand", F.col("deal") % F.col("hands"))
    before = rows.groupBy("size", "hand").count().select(
        F.col("size").alias("_s"), F.col("hand").alias("_h"),
        (F.sum("count").over(W.partitionBy("size").orderBy("hand")) - F.col("count")).alias("before"))
    one = W.partitionBy("size", "hand").orderBy("doc_id", "piece", "deal")
    ranked = rows.withColumn("n", F.row_number().over(one)).join(before, (F.col("size") == F.col("_s")) & (F.col("hand") == F.col("_h")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "size", (F.col("before") + F.col("n") - 1).alias("rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, slot long"
    ahead = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return ranked.mapInPandas(place, schema).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
        F.coalesce(F.sum("length").over(ahead), F.lit(0).cast("long")).alias("offset"))


def pack(documents: DataFrame, path: str, limit: int = LIMIT, grid: int = GRID) -> DataFrame:
    """Pack the documents, tokenized once."""
    return packed(stored(pieces(documents, path, limit)), limit, grid)
