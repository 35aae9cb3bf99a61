"""Line dedup by a sharded minimal perfect hash.

Every line gets the digest of its key (white space stripped, A-Z lower-cased). The distinct digests are counted, cut
into shards of about ``SHARD`` keys, and each shard becomes one row: a minimal perfect hash (levels of bits, a key sits
on the first level where it is alone) that numbers its keys from 0, and three arrays in that order: a fingerprint of
32 bits, the number of documents, the owner (smallest doc_id). Documents carry 16 bytes a line; each digest probes the
arrays of its shard, so no line text is joined or shuffled. Probes and shards stream through a task in order of
shards: a task holds one shard, however many probes come. The lines that are so common that their probes would fill a
task (each more than 1/``COMMON`` of all lines, so at most ``COMMON`` of them) are answered from a small index that
every task has. Only decisions (row, line) meet the texts again.

Defined results: a document is a doc_id, its rows may repeat; null ids are one document that comes last. Null or empty
text is one empty line. A line of a key in at least ``least`` rows and in another document with a smaller id goes.
Equal rows get equal results, an empty table none. Extra columns, of whatever name, travel in ``_row``. One text is
one row in a task, so its length is bounded by that row alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.llm.common import ascii_lower, importable, once, packed, stored

SHARD = 1 << 17
COMMON = 100_000
#: White space that is stripped from both ends of a line.
BLANK = " \t\n\x0b\x0c\r"
SHORTEST = 10
#: Null doc_ids stand behind all others.
LAST = (1 << 63) - 1
#: Bits of a level for each key that has no place yet.
GAMMA = 1.7

INDEX = "shard long, sizes array<int>, bits binary, fingerprints binary, documents binary, owners binary"
STREAM = "shard long, kind int, hi long, lo long, doc long, row long, line int"


def _mixed(hi: np.ndarray, lo: np.ndarray, level: int) -> np.ndarray:
    """64 bits of a key that differ from level to level."""
    with np.errstate(over="ignore"):
        x = hi.view(np.uint64) * np.uint64(2 * level + 0x9E3779B97F4A7C15) + (lo.view(np.uint64) ^ np.uint64(level << 7))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers n keys of 128 bits from 0 to n - 1; for any other key the number is -1 or that of a member."""

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.sizes, self.words = [int(s) for s in sizes], np.frombuffer(bits, np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(hi):
            if len(sizes) == 64:
                raise ValueError("keys of a shard repeat")
            size = -(-int(GAMMA * len(hi) + 1) // 64) * 64
            place = (_mixed(hi, lo, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").tobytes())
            sizes.append(size)
            rest = ~alone[place]
            hi, lo = hi[rest], lo[rest]
        return cls(sizes, b"".join(levels))

    def numbers(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out = np.full(len(hi), -1, np.int64)
        left, start = np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes):
            at = start + (_mixed(hi[left], lo[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            under = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[here]] = (self.before[at >> 6] + under)[here]
            left, start = left[~here], start + size
        return out


class Shard:
    """Arrays of one shard in the order of its perfect hash."""

    def __init__(self, row: dict) -> None:
        self.hash = PerfectHash(row["sizes"], row["bits"])
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint32)
        self.documents = np.frombuffer(row["documents"], np.uint32)
        self.owners = np.frombuffer(row["owners"], np.int64)

    def known(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, is a member) of each key, a member by its fingerprint."""
        place = self.hash.numbers(hi, lo)
        if not len(self.owners):
            return place, np.zeros(len(hi), bool)
        return place, (place >= 0) & (self.fingerprints[place] == _fingerprint(lo))

    def drops(self, place: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
        return (self.documents[place] >= least) & (self.owners[place] != doc)


def _fingerprint(lo: np.ndarray) -> np.ndarray:
    return (lo & 0xFFFFFFFF).astype(np.uint32)


def _shard_row(hi, lo, documents, owners) -> dict:
    hashed = PerfectHash.build(hi, lo)
    order = np.empty(len(hi), np.int64)
    order[hashed.numbers(hi, lo)] = np.arange(len(hi))
    return {
        "sizes": hashed.sizes, "bits": hashed.words.tobytes(), "fingerprints": _fingerprint(lo[order]).tobytes(),
        "documents": np.minimum(documents[order], 0xFFFFFFFF).astype(np.uint32).tobytes(),
        "owners": owners[order].astype(np.int64).tobytes()}


def _build(table: pa.Table) -> pa.Table:
    column = {c: table.column(c).to_numpy() for c in ("hi", "lo", "documents", "owner")}
    row = _shard_row(column["hi"], column["lo"], column["documents"], column["owner"])
    return pa.Table.from_pylist([{"shard": table.column("shard")[0].as_py(), **row}], schema=_arrow(INDEX))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _lines(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hi, lo, place of the row in the batch, number of the line) of all lines of a batch that have a key."""
    blobs = batch.column("lines").to_pylist()
    sizes = np.fromiter((len(b) // 16 for b in blobs), np.int64, len(blobs))
    pairs = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
    row = np.repeat(np.arange(len(blobs)), sizes)
    line = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    has = (pairs != 0).any(axis=1)
    return pairs[has, 0].copy(), pairs[has, 1].copy(), row[has], line[has]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different key of a batch once, with its documents, its lines and the smallest doc_id."""
    for batch in batches:
        hi, lo, row, _ = _lines(batch)
        if not len(hi):
            continue
        doc = batch.column("doc").to_numpy()[row]
        order = np.lexsort((row, lo, hi))
        hi, lo, row, doc = hi[order], lo[order], row[order], doc[order]
        new = np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])
        first = np.flatnonzero(new)
        fresh = np.concatenate([[True], row[1:] != row[:-1]]) | new
        yield pa.record_batch(
            [hi[first], lo[first], np.add.reduceat(fresh.astype(np.int64), first),
             np.diff(np.append(first, len(hi))), np.minimum.reduceat(doc, first)],
            names=["hi", "lo", "documents", "n", "owner"])


def _probes(common: dict, shards: int, least: int):
    """Lines to probes of their shard (kind 1), or to decisions (kind 2) where the common lines answer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Shard(common)
        for batch in batches:
            hi, lo, at, line = _lines(batch)
            doc, row = batch.column("doc").to_numpy()[at], batch.column("row").to_numpy()[at]
            place, member = index.known(hi, lo)
            kind = np.where(member, 2, 1).astype(np.int32)
            if len(index.owners):
                keep = ~member | index.drops(np.where(member, place, 0), doc, least)
            else:
                keep = np.ones(len(hi), bool)
            shard = np.where(member, row, hi) % shards
            columns = [shard, kind, hi, lo, doc, row, line.astype(np.int32)]
            yield pa.record_batch([c[keep] for c in columns], schema=_arrow(STREAM))

    return run


def _answers(least: int):
    """Shards (kind 0) and probes (kind 1) in order of shards to decisions (row, line); kind 2 are decisions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, index = None, None
        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            column = {c: batch.column(c).fill_null(0).to_numpy() for c in ("hi", "lo", "doc", "row", "line")}
            drop = kind == 2
            cuts = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                if kind[a] == 0:
                    number = shard[a]
                    index = Shard({c: batch.column(c)[int(a)].as_py() for c in
                                   ("sizes", "bits", "fingerprints", "documents", "owners")})
                elif kind[a] == 1:
                    keys = [column[c][a:b] for c in ("hi", "lo", "doc")]
                    place, member = index.known(*keys[:2]) if number == shard[a] else (None, np.zeros(1, bool))
                    if not member.all():
                        raise ValueError(f"shard {shard[a]} lacks a line that was counted")
                    drop[a:b] = index.drops(place, keys[2], least)
            yield pa.record_batch([column["row"][drop], column["line"][drop]], names=["row", "line"])

    return run


def _digests(text: Column) -> Column:
    """16 bytes for each line: the digest of its key, zeros where the key is too short to count."""
    def digest(line: Column) -> Column:
        key = F.btrim(line, F.lit(BLANK))
        return F.when(F.length(key) >= SHORTEST, F.md5(key)).otherwise("0" * 32)

    return F.unhex(F.array_join(F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n"), digest), ""))


def repeated_lines(documents: DataFrame, least: int = 2, shard: int = SHARD, common: int = COMMON) -> DataFrame:
    """(doc_id, digest, dropped) of the rows that lose lines: digest of the text, numbers of the lines that go."""
    spark = importable(documents.sparkSession)
    rows = stored(documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("doc_id"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"),
        _digests(F.col("text")).alias("lines"), F.monotonically_increasing_id().alias("row")))
    lines = rows.select("doc", "row", "lines")
    keys = stored(
        lines.mapInArrow(_counted, "hi long, lo long, documents long, n long, owner long")
        .groupBy("hi", "lo").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"), F.min("owner").alias("owner")))
    size = keys.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    hot = F.col("n") > size["n"] // common + shard // 64
    most = keys.filter(hot).select("hi", "lo", "documents", "owner").toArrow()
    common_row = _shard_row(*(most.column(c).to_numpy().copy() for c in most.column_names))
    shards = max(1, -(-size["keys"] // shard))
    index = stored(
        keys.filter(~hot).select(F.pmod("hi", F.lit(shards)).alias("shard"), "hi", "lo", "documents", "owner")
        .groupBy("shard").applyInArrow(_build, INDEX))
    probes = lines.mapInArrow(_probes(common_row, shards, least), STREAM)
    stream = (
        probes.unionByName(index.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        .repartition("shard").sortWithinPartitions("shard", "kind"))
    decided = stream.mapInArrow(_answers(least), "row long, line int").groupBy("row").agg(F.collect_set("line").alias("dropped"))
    return decided.join(rows.select("row", "doc_id", "digest"), "row").select("doc_id", "digest", "dropped").dropDuplicates(["doc_id", "digest"])


def deduplicated(documents: DataFrame, least: int = 2, **sizes: int) -> DataFrame:
    """Each row as ``_row`` with n_lines, n_dropped and ``kept``, its text without the lines that went."""
    dropped = stored(repeated_lines(documents.select("doc_id", "text"), least, **sizes)).select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("dropped").alias("_dropped"))
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    rows = packed(documents).withColumn("_text", F.unhex(F.md5(text)))
    joined = rows.join(dropped, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_digest")), "left")
    split = once(joined, "_lines", F.split(text, "\n"))
    n = F.size("_lines")
    stay = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), "_dropped"), lambda i: F.get("_lines", i))
    return split.select(
        "_row", n.cast("long").alias("n_lines"), F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_dropped").isNull(), text).otherwise(F.array_join(stay, "\n")).alias("kept"))
