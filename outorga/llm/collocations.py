"""Phrase collocations by HAT-trie counting.

Documents become blocks of word numbers (a few million words, pieces parted by 0, one row each). A phrase can only
occur ``least`` times if its parts do, so words are counted first, then pairs of frequent words, then phrases of three
and four words whose neighbours all are frequent pairs. What is frequent goes back only to the blocks that hold it, so
a task never has more than one block and the frequent words and pairs of that block: nothing is broadcast. Once the
frequent words are known, blocks are written anew in their ids, 0 for all other words.

Inside a block phrases are counted by a HAT-trie: hash containers under a shallow trie of word ids. A container covers
a range of first words; one that outgrows ``CAPACITY`` bursts, into two ranges, or, where it holds one first word
only, into a node for that word with containers over ranges of the next word. A trie that outgrows ``BUDGET`` spills
whole subtrees, the largest first, as sorted runs. A key is two ids of 32 bits: (word, word) for pairs, and under the
frequent pair that a longer phrase starts with, (pair, word) or (pair, pair). Runs are merged by Spark, dealt by the
prefix of two words for pairs and by the whole phrase for longer ones; as a phrase comes once from a run, a phrase or
first word that is everywhere brings no more than one row from each run.

Defined results: null text is empty, null lang ``und``. Repeated rows count as often as they occur. Ties go by phrase in
UTF-8 order. An empty table, or one without frequent phrases, gives no rows. Extra columns are not looked at. A very
long text is cut between blocks at the end of a piece; one piece stays in one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.llm.common import importable, stored
from outorga.operators.keys import dense_ids

LEAST, TOP, LONGEST = 30, 2000, 4
#: Words of a block, entries of a container before it bursts, entries of a trie before it spills.
BLOCK, CAPACITY, BUDGET = 6 << 20, 1 << 14, 1 << 19
#: Keys that are put into a trie, bytes of text that are cut into words, and rows of a run at a time.
CHUNK, SLICE, ROWS = 1 << 18, 1 << 20, 1 << 16
#: A-Z in lower case, ends of pieces as a full stop, tab as a space.
PIECES = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
WORD = (1 << 32) - 1
BLOCKS = "block long, tokens binary, size int, lang string, word string, local int, n long"


class Container(dict):
    """Hash container: key to count."""

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        before, get = len(self), self.get
        for key, n in zip(keys.tolist(), counts.tolist()):
            self[key] = get(key, 0) + n
        return len(self) - before

    def sorted(self) -> list[tuple[np.ndarray, np.ndarray]]:
        keys = np.fromiter(self.keys(), np.int64, len(self))
        counts = np.fromiter(self.values(), np.int64, len(self))
        order = np.argsort(keys)
        return [(keys[order], counts[order])]


class HatTrie:
    """A node of the trie: children over ranges of one id of the key, the first (``shift`` 32) or the next (0)."""

    def __init__(self, shift: int = 32, capacity: int = CAPACITY) -> None:
        self.shift, self.capacity = shift, capacity
        self.starts, self.children, self.size = [0], [Container()], 0

    def _ids(self, keys: np.ndarray) -> np.ndarray:
        return keys >> self.shift & WORD

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Add different keys in ascending order; returns how many are new."""
        cuts = np.concatenate([[0], np.searchsorted(self._ids(keys), self.starts[1:]), [len(keys)]])
        new = 0
        for k in reversed(np.flatnonzero(np.diff(cuts))):
            new += self.children[k].add(keys[cuts[k] : cuts[k + 1]], counts[cuts[k] : cuts[k + 1]])
            self._burst(k)
        self.size += new
        return new

    def _burst(self, k: int) -> None:
        child = self.children[k]
        if isinstance(child, HatTrie) or len(child) <= self.capacity:
            return
        [(keys, counts)] = child.sorted()
        ids = self._ids(keys)
        middle = ids[len(ids) // 2]
        if middle == ids[0]:
            middle = ids[np.searchsorted(ids, middle, "right") % len(ids)]
        if middle == ids[0]:  # one id only: a node for it, and containers for the ids around it
            if self.shift:
                node, one = HatTrie(0, self.capacity), int(middle)
                node.add(keys, counts)
                parts = [(self.starts[k], Container()), (one, node), (one + 1, Container())]
                parts = parts[self.starts[k] == one :]
                if self.starts[k + 1 : k + 2] == [one + 1]:
                    parts.pop()
                self.starts[k : k + 1], self.children[k : k + 1] = [start for start, _ in parts], [part for _, part in parts]
            return
        at = np.searchsorted(ids, middle)
        halves = Container(), Container()
        halves[0].add(keys[:at], counts[:at])
        halves[1].add(keys[at:], counts[at:])
        self.starts[k : k + 1] = [self.starts[k], int(middle)]
        self.children[k : k + 1] = halves
        self._burst(k + 1)
        self._burst(k)

    def sorted(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [run for child in self.children for run in child.sorted()]

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, as sorted runs, until ``keep`` entries are left."""
        def entries(k: int) -> int:
            child = self.children[k]
            return child.size if isinstance(child, HatTrie) else len(child)

        for k in sorted(range(len(self.children)), key=entries, reverse=True):
            if self.size <= keep:
                break
            self.size -= entries(k)
            parts = self.children[k].sorted()
            self.children[k] = Container()
            yield tuple(np.concatenate(c) for c in zip(*parts))


def _runs(chunks: Iterable[np.ndarray], capacity: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted runs (keys, counts) of the keys of one block, which come in chunks."""
    trie = HatTrie(32, capacity)
    for keys in chunks:
        if len(keys):
            trie.add(*np.unique(keys, return_counts=True))
        if trie.size > budget:
            yield from trie.spill(budget // 2)
    if trie.size:
        yield tuple(np.concatenate(c) for c in zip(*trie.sorted()))


class Index(dict):
    """Numbers of the words of one language in a block; languages share the counter, 0 ends a piece."""

    def __init__(self, numbers: Iterator[int]) -> None:
        super().__init__({b".": 0})
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        self[word] = number = next(self.numbers)
        return number


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Words and ends of pieces, of about ``SLICE`` bytes of text at a time."""
    text = text.translate(PIECES).replace(b".", b" . ")
    start = 0
    while start < len(text):
        end = text.find(b" ", start + SLICE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end
    yield [b"."]


def _blocked(words: int):
    """Documents to blocks of numbers, and the words of each block with their counts."""

    def flush(block: int, indexes: dict[str, Index], tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
        raw, size = _packed(tokens)
        counts = np.bincount(tokens, minlength=1 + max(max(index.values()) for index in indexes.values()))
        for lang, index in indexes.items():
            names = pa.array(list(index)[1:], pa.binary()).cast(pa.string())
            local = np.fromiter(index.values(), np.int32, len(index))[1:]
            here = counts[local] > 0  # the last words may belong to the next block
            names, local = names.filter(pa.array(here)), local[here]
            for at in range(0, len(local), ROWS):
                part, n = slice(at, at + ROWS), len(local[at : at + ROWS])
                yield pa.record_batch(
                    [np.full(n, block), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.array([lang] * n, pa.string()),
                     names.slice(at, ROWS), local[part], counts[local[part]]], names=[c.split()[0] for c in BLOCKS.split(", ")])
        yield pa.record_batch(
            [pa.array([block]), pa.array([raw]), pa.array([size], pa.int32()),
             pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64())],
            names=[c.split()[0] for c in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        indexes, tokens, held, numbers = {}, [], 0, count(1)
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())
            for lang, text in zip(langs, texts):
                for part in _words(text.as_py()):
                    if lang not in indexes:
                        indexes[lang] = Index(numbers)
                    index = indexes[lang]
                    tokens.append(np.fromiter(map(index.__getitem__, part), np.int32, len(part)))
                    held += len(part)
                    ends = np.flatnonzero(tokens[-1] == 0) if held >= words else ()
                    if len(ends):
                        tokens[-1] = tokens[-1][: ends[-1] + 1]
                        carried = part[ends[-1] + 1 :]
                        yield from flush(block, indexes, np.concatenate(tokens))
                        block, numbers = block + 1, count(1)
                        indexes = {lang: Index(numbers)}
                        tokens = [np.fromiter(map(indexes[lang].__getitem__, carried), np.int32, len(carried))]
                        held = len(carried)
        if held:
            yield from flush(block, indexes, np.concatenate(tokens))

    return run


def _streamed(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """For each block what is known of it, then its words, one block after the other."""
    stream = blocks.select("block", F.lit(1).alias("kind"), "tokens", "size")
    stream = stream.unionByName(known.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return stream.repartition("block").sortWithinPartitions("block", "kind")


def _packed(words: np.ndarray) -> tuple[bytes, int]:
    raw = words.astype(np.int32).tobytes()
    return pa.compress(raw, "zstd", asbytes=True), len(raw)


def _unpacked(row: pa.RecordBatch) -> np.ndarray:
    size = row.column("size")[0].as_py()
    return np.frombuffer(pa.decompress(row.column("tokens")[0].as_py(), decompressed_size=size, codec="zstd", asbytes=True), np.int32)


def _by_block(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(block, what is known of it by column, its words) from a stream in order of blocks."""
    current, known = None, []
    for batch in batches:
        block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (kind[1:] != kind[:-1]), [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if block[a] != current:
                current, known = block[a], []
            part = batch.slice(a, b - a)
            if kind[a] == 0:
                known.append([part.column(c).to_numpy() for c in columns])
            else:
                none = [np.zeros(0, np.int64)] * len(columns)
                yield int(current), [np.concatenate(c) for c in zip(*known or [none])], _unpacked(part)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in the ids of frequent words, 0 for all others."""
    for block, (local, number), words in _by_block(batches, ["local", "id"]):
        to = np.zeros(int(words.max()) + 1, np.int32)
        to[local] = number
        raw, size = _packed(to[words])
        yield pa.record_batch([pa.array([block]), pa.array([raw]), pa.array([size], pa.int32())], names=["block", "tokens", "size"])


def _pair_runs(capacity: int, budget: int):
    """Coded blocks to sorted runs (block, key, n) of pairs of frequent words."""

    def keys(words: np.ndarray) -> Iterator[np.ndarray]:
        for at in range(0, len(words) - 1, CHUNK):
            first, second = words[at : at + CHUNK], words[at + 1 : at + CHUNK + 1]
            both = (first[: len(second)] > 0) & (second > 0)
            yield first[: len(second)][both].astype(np.int64) << 32 | second[both]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                block = row.column("block")[0].as_py()
                for key, n in _runs(keys(_unpacked(row)), capacity, budget):
                    for at in range(0, len(key), ROWS):
                        part = key[at : at + ROWS]
                        yield pa.record_batch([np.full(len(part), block), part, n[at : at + ROWS]], names=["block", "key", "n"])

    return run


def _phrase_runs(capacity: int, budget: int):
    """Coded blocks and their frequent pairs to sorted runs (high, low, n) of phrases of three and four words."""

    def nodes(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """For each place the number of the frequent pair that starts there, -1 for none."""
        out = np.full(len(words), -1, np.int32)
        for at in range(0, len(words) - 1, CHUNK):
            second = words[at + 1 : at + CHUNK + 1]
            pair = words[at : at + len(second)].astype(np.int64) << 32 | second
            found = np.minimum(np.searchsorted(frequent, pair), len(frequent) - 1)
            out[at : at + len(pair)] = np.where(frequent[found] == pair, found, -1)
        return out

    def threes(words: np.ndarray, node: np.ndarray) -> Iterator[np.ndarray]:
        for at in range(0, len(words), CHUNK):
            here = at + np.flatnonzero((node[at : at + CHUNK][: len(node) - 1 - at] >= 0) & (node[at + 1 : at + CHUNK + 1] >= 0))
            yield node[here].astype(np.int64) << 32 | words[here + 2]

    def fours(node: np.ndarray) -> Iterator[np.ndarray]:
        for at in range(0, len(node) - 2, CHUNK):
            third = node[at + 2 : at + CHUNK + 2]
            here = at + np.flatnonzero((node[at : at + len(third)] >= 0) & (node[at + 1 : at + 1 + len(third)] >= 0) & (third >= 0))
            yield node[here].astype(np.int64) << 32 | node[here + 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (frequent,), words in _by_block(batches, ["key"]):
            frequent = np.unique(frequent)
            if not len(frequent):
                continue
            node = nodes(words, frequent)
            for chunks, ends in ((threes(words, node), None), (fours(node), frequent)):
                for key, n in _runs(chunks, capacity, budget):
                    for at in range(0, len(key), ROWS):
                        part = key[at : at + ROWS]
                        rest = part & WORD
                        yield pa.record_batch([frequent[part >> 32], rest << 32 if ends is None else ends[rest], n[at : at + ROWS]], names=["high", "low", "n"])

    return run


def _cut(ids: Column, a: Column, l: Column, r: Column) -> Column:
    """Score of one cut: floor(2000000 a / (l + r)), exact."""
    return F.call_function("div", (a.cast("decimal(20,0)") * 2_000_000).cast("decimal(38,0)"), (l.cast("decimal(20,0)") + r).cast("decimal(22,0)"))


def phrase_counts(
    documents: DataFrame, least: int = LEAST, block: int = BLOCK, capacity: int = CAPACITY, budget: int = BUDGET,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals: lang, n), (vocabulary: id, lang, word), (counts: ids, f) of all phrases of one to four words that occur
    at least ``least`` times in their language; ids are the ids of their words."""
    importable(documents.sparkSession)
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    made = stored(texts.mapInArrow(_blocked(block), BLOCKS))
    blocks = made.filter(F.col("size").isNotNull()).select("block", "tokens", "size")
    words = made.filter(F.col("local").isNotNull()).select("block", "lang", "word", "local", "n")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))

    # The rows of a word meet once: they get its count, and the first of its places in blocks as its name.
    of_word = W.partitionBy("lang", "word")
    first = F.min(F.struct("block", "local")).over(of_word)
    seen = words.withColumns({"f": F.sum("n").over(of_word), "first": first}).filter(F.col("f") >= least)
    is_first = (F.col("block") == F.col("first.block")) & (F.col("local") == F.col("first.local"))
    seen = stored(seen.select(
        "block", "local", F.col("first.block").alias("b"), F.col("first.local").alias("l"),
        *[F.when(is_first, F.col(c)).alias(c) for c in ("lang", "word", "f")]))
    frequent = seen.filter(F.col("word").isNotNull()).select("b", "l", "lang", "word", "f")
    vocabulary = stored(dense_ids(frequent, "id", ["lang", "word"], unique=True).join(frequent, ["lang", "word"]))
    if not vocabulary.filter(F.col("id") > (1 << 31) - 1).isEmpty():
        raise ValueError("more than 2^31 frequent words")
    known = seen.join(vocabulary.select("b", "l", "id"), ["b", "l"]).select("block", "local", "id")
    coded = stored(_streamed(blocks, known).mapInArrow(_coded, "block long, tokens binary, size int"))

    run = coded.mapInArrow(_pair_runs(capacity, budget), "block long, key long, n long")
    merged = run.withColumn("f", F.sum("n").over(W.partitionBy("key"))).filter(F.col("f") >= least)
    pairs = stored(merged.select("block", "key", "f"))

    longer = _streamed(coded, pairs.select("block", "key")).mapInArrow(_phrase_runs(capacity, budget), "high long, low long, n long")
    longer = longer.groupBy("high", "low").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)

    def both(c: str) -> list[Column]:
        return [F.shiftrightunsigned(c, 32), F.col(c).bitwiseAND(F.lit(WORD))]

    counts = (
        vocabulary.select(F.array("id").alias("ids"), "f")
        .unionByName(pairs.groupBy("key").agg(F.max("f").alias("f")).select(F.array(*both("key")).alias("ids"), "f"))
        .unionByName(longer.select(F.filter(F.array(*both("high"), *both("low")), lambda i: i > 0).alias("ids"), "f")))
    return totals, vocabulary, stored(counts)


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    totals, vocabulary, counts = phrase_counts(documents.select("lang", "text"), least, **sizes)
    phrases = counts.filter(F.size("ids") > 1).withColumnRenamed("f", "a")
    ids, size = F.col("ids"), F.size("ids")

    def part(name: str, count_name: str) -> DataFrame:
        return counts.select(F.col("ids").alias(name), F.col("f").alias(count_name))

    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "ids", "a", "k", F.slice(ids, F.lit(1), F.col("k")).alias("left"), F.slice(ids, F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(part("left", "l"), "left").join(part("right", "r"), "right")
    lowest = F.min(F.struct(_cut(ids, F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("ids", "a").agg(lowest.alias("cut")).select("ids", "a", "cut.score", "cut.l", "cut.r")

    def inside(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.slice(ids, at, F.lit(n)))

    nested = F.array_distinct(F.when(size == 3, inside(2)).otherwise(F.concat(inside(2), inside(3))))
    holders = phrases.filter(size > 2).select(F.explode(nested).alias("ids"), "a").groupBy("ids").agg(F.max("a").alias("over"))
    held = 100 * F.col("over").cast("decimal(20,0)") >= 80 * F.col("a").cast("decimal(20,0)")
    open_phrases = scored.join(holders, "ids", "left").filter(~F.coalesce(held, F.lit(False))).drop("over")

    first = vocabulary.select(F.col("id").alias("first"), "lang")
    in_lang = open_phrases.withColumn("first", F.col("ids")[0]).join(first, "first")
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    likely = in_lang.withColumn("r_", F.rank().over(best)).filter(F.col("r_") <= top).drop("r_", "first")
    spelt = (
        likely.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(vocabulary.select("id", "word"), "id")
        .groupBy("lang", "ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase")))
    ranked = likely.join(spelt, ["lang", "ids"]).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))).cast("long"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
