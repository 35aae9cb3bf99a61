"""Source divergence audit with late string materialisation.

A task counts the terms of its documents under numbers of its own and writes two kinds of rows to the shared folder:
cells (lang, source, digest, occurrences, documents), where the digest has 64 bits, and its dictionary (digest, term).
Only cells are shuffled, so whatever a term's length, a row is fixed in width. Digests in enough documents
are candidates; the dictionary rows of these alone are read back, and the least and the greatest string of a digest
tell whether it stands for one term. Where they differ the digest is split: its terms are counted again under their
own strings. Terms are joined to the ranked cells at the end, for the rows that are kept.

Sums over all terms for every two sources of a language are taken in blocks: a task gets the cells of some thousand
terms for one or two tiles of sources, fills a matrix, and returns one partial sum for each pair; terms that neither
source of the tiles has are added by one product. (The result lists every pair, so pairs of sources exist by contract;
no pair of documents or rows does.)

Defined results: null text, lang and source are ''. Rows are documents, repeated ones count as often as they occur.
A group without kept terms gets value 0 for every other source. Ties go by the item's UTF-8 bytes. An empty table
gives no rows. Extra columns are not looked at; a very long text is one row of one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.llm.common import importable, stored

LEAST_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
#: Terms and sources of one matrix of partial sums.
BLOCK, TILE = 1 << 14, 256
#: Words counted at a time, and cells held before a task writes them.
WORDS, CELLS = 1 << 20, 1 << 22
#: Letters of ASCII in lower case and all bytes of other characters; everything else parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
CELL = "lang string, source string, digest long, n long, docs long, term string"


class Numbered(dict):
    """Numbers for keys, in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


class Tally:
    """Occurrences and documents of every (group, term) of the documents given so far."""

    def __init__(self, bits: int, named: bool) -> None:
        self.bits, self.named = bits, named
        self.clear()

    def clear(self) -> None:
        self.terms, self.groups, self.cells, self.held = Numbered(), Numbered(), [], 0
        self.words, self.sizes, self.group = [], [], []

    def add(self, lang: str, source: str, text: bytes) -> None:
        terms = text.translate(LETTERS).split()
        self.words.append(np.fromiter(map(self.terms.__getitem__, terms), np.int64, len(terms)))
        self.sizes.append(len(terms))
        self.group.append(self.groups[lang, source])
        self.held += len(terms)
        if self.held >= WORDS:
            self.fold()

    def fold(self) -> None:
        """Words to cells (group, term, n, docs), one for each different group and term."""
        if self.held:
            many, group = len(self.terms), np.array(self.group)
            in_doc = np.repeat(np.arange(len(self.sizes)), self.sizes) * many + np.concatenate(self.words)
            in_doc, n = np.unique(in_doc, return_counts=True)
            self.cells.append((group[in_doc // many] << 32 | in_doc % many, n, np.ones(len(n), np.int64)))
            self.merge(len(self.cells) - 1)
        self.words, self.sizes, self.group, self.held = [], [], [], 0

    def merge(self, start: int) -> None:
        key, n, docs = (np.concatenate(c) for c in zip(*self.cells[start:]))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.cells[start:] = [(key[first], np.add.reduceat(n[order], first), np.add.reduceat(docs[order], first))]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Cells, dictionary and one row for each group; the tally is empty afterwards."""
        self.fold()
        names = ["lang", "source", "digest", "n", "docs", "term"]
        groups = pa.array([g[0] for g in self.groups], pa.string()), pa.array([g[1] for g in self.groups], pa.string())
        if len(self.groups):
            yield pa.record_batch([*groups, *[pa.nulls(len(self.groups), pa.int64())] * 3, pa.nulls(len(self.groups), pa.string())], names=names)
        if self.cells:
            self.merge(0)
            key, n, docs = self.cells[0]
            terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
            mask = (1 << self.bits) - 1
            digests = np.fromiter((xxhash.xxh64_intdigest(t) & mask for t in self.terms), np.uint64, len(terms)).view(np.int64)
            for at in range(0, len(key), 1 << 16):
                part = slice(at, at + (1 << 16))
                group, term = key[part] >> 32, key[part] & 0xFFFFFFFF
                text = terms.take(pa.array(term)) if self.named else pa.nulls(len(term), pa.string())
                yield pa.record_batch([*[g.take(pa.array(group)) for g in groups], digests[term], n[part], docs[part], text], names=names)
            if not self.named:
                for at in range(0, len(terms), 1 << 16):
                    text = terms.slice(at, 1 << 16)
                    empty = [pa.nulls(len(text), pa.string())] * 2, [pa.nulls(len(text), pa.int64())] * 2
                    yield pa.record_batch([*empty[0], digests[at : at + (1 << 16)], *empty[1], text], names=names)
        self.clear()


def _tallied(documents: DataFrame, bits: int, named: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(bits, named)
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(langs, sources, texts):
                tally.add(lang, source, text.as_py())
                if sum(len(c[0]) for c in tally.cells) >= CELLS:
                    yield from tally.rows()
        yield from tally.rows()

    empty = F.lit("")
    return documents.select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")]).mapInArrow(run, CELL)


def _kept(cells: DataFrame, term: list[str], least: int) -> DataFrame:
    """Cells of terms in at least ``least`` documents of their language, with the language's count ``m``. One shuffle:
    sums and totals are taken where the rows of a (lang, term) are."""
    whole = W.partitionBy("lang", *term)
    summed = cells.repartition("lang", *term).groupBy("lang", *term, "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.withColumn("m", F.sum("n").over(whole)).withColumn("df", F.sum("docs").over(whole)).filter(F.col("df") >= least).drop("docs", "df")


def _share(count: Column | str, total: str, terms: str) -> Column:
    """p of a count: exact, products may pass 64 bits."""
    count = F.col(count) if isinstance(count, str) else count
    top = ((count.cast("decimal(20,0)") + 2) * F.lit(SCALE)).cast("decimal(38,0)")
    bottom = (F.col(total).cast("decimal(20,0)") + 2 * F.col(terms)).cast("decimal(22,0)")
    return F.when(F.col(terms) > 0, F.lit(1).cast("long") + F.call_function("div", top, bottom))


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(table: pa.Table) -> pa.Table:
    """Partial sums for the pairs of sources of one or two tiles over the terms of one block."""
    sources = table.column("source").combine_chunks().dictionary_encode()
    names, source = sources.dictionary, sources.indices.to_numpy()
    tile = np.zeros(len(names), np.int64)
    tile[source] = table.column("tile").to_numpy()
    zero = np.zeros(len(names), np.int64)
    zero[source] = table.column("p0").fill_null(0).to_numpy()
    cell = table.column("p").is_valid().to_numpy()
    held = table.filter(pa.array(cell))
    _, term = np.unique(held.column("digest").to_numpy(), return_inverse=True)
    if held.column("split").null_count < held.num_rows:
        split = held.column("split").combine_chunks().dictionary_encode()
        _, term = np.unique(term * (len(split.dictionary) + 1) + split.indices.fill_null(-1).to_numpy() + 1, return_inverse=True)
    seen = int(term.max()) + 1 if len(term) else 0
    p = np.tile(zero, (seen, 1))
    p[term, source[cell]] = held.column("p").to_numpy()
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    # by name, so that a pair has one direction in every block, in whatever order the rows arrive
    by_name = pc.sort_indices(names).to_numpy()
    left, right = by_name[tile[by_name] == first], by_name[tile[by_name] == second]
    out = []
    for k, i in enumerate(left):
        others = right[right != i] if first != second else left[k + 1 :]
        a, b = p[:, [i]], p[:, others]
        sums = ((a - b) ** 2 // np.maximum(a + b, 1)).sum(axis=0)
        out.append((np.full(len(others), i), others, sums))
    a, b, sums = (np.concatenate([o[c] for o in out]).astype(np.int64) if out else np.zeros(0, np.int64) for c in range(3))
    n = len(a)
    return pa.table({
        "lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()), "a": names.take(pa.array(a)), "b": names.take(pa.array(b)),
        "value": sums, "seen": np.full(n, seen), "pa": zero[a], "pb": zero[b]})


def _pairs(cells: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """(lang, source, item, value) for every two different sources of a language."""
    sizes = groups.groupBy("lang").agg(F.max("terms").alias("terms"), F.count(F.lit(1)).alias("sources"))
    tiles, blocks = F.ceil(F.col("sources") / tile), F.greatest(F.lit(1), F.ceil(F.col("terms") / block))
    grid = groups.join(sizes.drop("terms"), "lang").select(
        "lang", "source", "terms", "p0", blocks.alias("blocks"), tiles.alias("tiles"), F.pmod(F.xxhash64("source"), tiles).alias("tile"))
    stubs = grid.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    counted = cells.select("lang", "source", "digest", "split", "p").join(grid, ["lang", "source"]).withColumn(
        "block", F.pmod(F.xxhash64("digest"), F.col("blocks")))
    both = stubs.unionByName(counted, allowMissingColumns=True).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other"))
    dealt = both.select("*", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"))
    sums = dealt.select("lang", "source", "tile", "p0", "digest", "split", "p", "first", "second", "block").groupBy(
        "lang", "first", "second", "block").applyInArrow(
        _pair_sums, "lang string, a string, b string, value long, seen long, pa long, pb long")
    pairs = sums.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("value", "seen")], *[F.max(c).alias(c) for c in ("pa", "pb")])
    rest = (F.col("terms") - F.col("seen")) * _distance(F.col("pa"), F.col("pb"))
    value = F.when(F.col("terms") > 0, F.col("value") + rest).otherwise(0).cast("long")
    ends = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))])
    return pairs.join(sizes, "lang").select("lang", value.alias("value"), F.explode(ends).alias("e")).select("lang", "e.source", "e.item", "value")


def audit(
    documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, bits: int = 64, block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from every other one of its language, and the
    ``top`` terms that set it apart from its language. ``bits`` is the width of the digests."""
    documents = importable(documents.sparkSession) and documents.select("lang", "source", "text")
    tallied = stored(_tallied(documents, bits))
    counted = tallied.filter(F.col("n").isNotNull()).select("lang", "source", "digest", "n", "docs")
    kept = stored(_kept(counted, ["digest"], least)).withColumn("split", F.lit(None).cast("string"))
    words = tallied.filter(F.col("term").isNotNull()).select("digest", "term")
    names = stored(words.join(kept.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(
        F.min("term").alias("lowest"), F.max("term").alias("highest")))
    shared = names.filter(F.col("lowest") != F.col("highest")).select("digest")
    if not shared.isEmpty():
        again = _tallied(documents, bits, named=True).filter(F.col("n").isNotNull()).join(shared, "digest", "left_semi")
        parted = _kept(again.withColumnRenamed("term", "split"), ["digest", "split"], least)
        kept = stored(kept.join(shared, "digest", "left_anti").unionByName(parted))

    sizes = kept.groupBy("lang").agg(F.count_distinct("digest", F.coalesce("split", F.lit(""))).alias("terms"), F.sum("n").alias("whole"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = tallied.filter(F.col("digest").isNull()).select("lang", "source").distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "terms", "whole"])
    groups = stored(groups.withColumn("p0", _share(F.lit(0), "total", "terms")))
    cells = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "digest", "split", _share("n", "total", "terms").alias("p"), _share("m", "whole", "terms").alias("q"))

    of_group = W.partitionBy("lang", "source")
    far = cells.filter("p > q").select("lang", "source", "digest", "split", _distance(F.col("p"), F.col("q")).alias("value"))
    best = far.withColumn("r", F.rank().over(of_group.orderBy(F.desc("value")))).filter(F.col("r") <= top)
    terms = best.join(names, "digest").select(
        "lang", "source", F.lit("term").alias("part"), F.coalesce("split", "lowest").alias("item"), "value")
    pairs = _pairs(cells, groups, block, tile).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(of_group.orderBy(F.desc("value"), F.asc("item"))))

    return ranked(terms).filter(F.col("rank") <= top).unionByName(ranked(pairs))
