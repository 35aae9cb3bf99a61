"""Near duplicates: exact Jaccard join on word shingles by token combinations.

Texts with the same set of shingles are one class. Of sets whose Jaccard likeness reaches the threshold, prefixes
in any one order of shingles, the least prefix extended by l, share at least l shingles. From this follow

- which classes can have a partner at all: those with l prefix shingles, in the order of hashes, that some other
  class has too. Only their whole sets are kept;
- stars: in a few turns, each class is compared with one class for each of three of its shingles. Verified
  links make preliminary components, so that groups of near copies need no pairs among themselves;
- the rest, exactly: shingles found in two or more components are rare (in few classes) or frequent. A rare one is
  a key by itself, frequent ones are keys in combinations of two out of the same token class (hash modulo g;
  two sets that share g + 1 of them share two in one of the g). Classes of different components that meet in a key
  are a candidate if the key lies in the prefixes that the sizes of these two call for, which are much shorter than
  those that any partner might call for. Candidates are verified on their whole sets.

Defined results: a null or wordless text has an empty set, is linked with nothing and is its own component;
repeated documents are in one component; a null doc_id is no candidate for the smallest; an empty table gives an
empty result. Extra columns are not looked at (``distinct`` passes them through).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.llm.common import packed, stored, unpacked

WIDTH = 5
PERCENT = 80
RARE = 8  # classes that may share a rare shingle
MOST_BITS = 27  # of the map of shared shingles that is broadcast: 16 MB
TURNS = 3  # of stars
GROUP = 100  # shingles of a set for each token class of frequent ones
CHARS = 2_000_000

_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted hashes of the different shingles of each text (UTF-8)."""
    parts = [t.translate(_TO_LOWER).split() if t else [] for t in texts]
    words = [w for p in parts for w in p]
    h = _mixed(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    odd = np.array([_ODD[k % 5] * np.uint64(2 * (k // 5) + 1) for k in range(width)], np.uint64)
    n = max(len(h) - width + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled += h[k : k + n] * odd[k]
    rolled = _mixed(rolled)
    out, at = [], 0
    for p in parts:
        if len(p) >= width:
            s = np.sort(rolled[at : at + len(p) - width + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif p:
            out.append(_mixed((h[at : at + len(p)] * odd[: len(p)]).sum(keepdims=True) + np.uint64(len(p))))
        else:
            out.append(np.zeros(0, np.uint64))
        at += len(p)
    return out


def overlap(n: int, percent: int = PERCENT) -> int:
    """Fewest shingles that a set of n shares with any partner."""
    return -(-percent * n // 100)


def extension(n: int) -> int:
    """By how many shingles the least prefix is extended. The more, the larger the share of a prefix that partners
    have in common, and the fewer classes qualify by a passage alone."""
    return 1 + n // 4


def prefix(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set of n that are indexed."""
    a = overlap(n, percent)
    return n - a + min(extension(n), a)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Prefix shingles that a set of n shares at least with any partner (which has ``overlap(n)`` shingles or more)."""
    return min(extension(overlap(n, percent)), overlap(overlap(n, percent), percent))


def _sets(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        texts = batch.column(column)
        first, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
            size += n or 0
            if size > CHARS or i + 1 == len(texts):
                yield batch.slice(first, i + 1 - first), shingle_sets(texts.slice(first, i + 1 - first).to_pylist())
                first, size = i + 1, 0


def _signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def shared_map(documents: DataFrame) -> np.ndarray:
    """Bits, by the low bits of their hash, of prefix shingles that two or more classes have."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, 0):
            by_class = {_signature(s): s[: prefix(len(s))] for s in sets if len(s)}
            if by_class:
                kinds = np.array([int.from_bytes(k[:8], "little", signed=True) for k in by_class], np.int64)
                sizes = [len(s) for s in by_class.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(list(by_class.values())).view(np.int64)), pa.array(np.repeat(kinds, sizes))], ["token", "kind"])

    rows = documents.select(F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(tokens, "token long, kind long")
    shared = stored(rows.groupBy("token").agg(F.min("kind").alias("a"), F.max("kind").alias("b")).filter("a <> b").select("token"))
    bits = min(max(int(16 * shared.count()).bit_length(), 16), MOST_BITS)
    place = F.col("token").bitwiseAND(F.lit((1 << bits) - 1))
    words = shared.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((token & {(1 << bits) - 1}L) % 64 as int))")).alias("bits")).toArrow()  # 32 MB at most
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _is_shared(tokens: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = tokens & np.uint64(len(bits) * 64 - 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def described(documents: DataFrame, bits) -> DataFrame:
    """(doc_id, key, n, sig, tokens): each document's class, and the whole set for classes that can have a partner.
    ``key`` is the digest of the text; with it, rows that repeat an id are told apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part, sets in _sets(batches, 1):
            sigs = [_signature(s) if len(s) else None for s in sets]
            whole = []
            if len(seen) > 100_000:
                seen.clear()
            for sig, s in zip(sigs, sets):
                able = sig is not None and sig not in seen and int(_is_shared(s[: prefix(len(s))], bits.value).sum()) >= least_shared(len(s))
                whole.append(s.tobytes() if able else None)
                if able:
                    seen.add(sig)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary()), pa.array(whole, pa.binary())],
                ["doc_id", "key", "n", "sig", "tokens"])

    text = F.col("text").cast("string")
    rows = documents.select(F.col("doc_id").cast("long"), text.cast("binary").alias("text"), _row_key(text).alias("key"))
    return rows.mapInArrow(run, "doc_id long, key binary, n long, sig binary, tokens binary")


def _row_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def verified(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets reach the likeness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            right = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                right.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(right, pa.bool_()))

    side = lambda name: classes.select(F.col("sig").alias(f"_{name}"), F.col("tokens").alias(f"t{name}"))
    both = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b")).select("a", "b", "ta", "tb")
    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(sig, comp) of every class with a link: the smallest class of its component. Labels fall along links
    and along themselves until none changes."""
    both = stored(links.union(links.select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("sig")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = both.join(labels, F.col("b") == F.col("sig")).groupBy("a").agg(F.min("comp").alias("near"))
        new = labels.join(near, F.col("sig") == F.col("a")).select("sig", F.least("comp", "near").alias("comp"), F.col("comp").alias("old"))
        up = labels.select(F.col("sig").alias("_s"), F.col("comp").alias("up"))
        new = stored(new.join(up, F.col("comp") == F.col("_s"), "left").select("sig", F.least("comp", "up").alias("comp"), "old"))
        changed = not new.filter(F.col("comp") != F.col("old")).isEmpty()
        labels = new.select("sig", "comp")
        if not changed:
            return labels


def _close(percent: int = PERCENT):
    """Whether classes of na and nb shingles, of which other components have ma and mb, can be partners: all that
    two classes of different components share is found in other components."""
    return (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (
        (100 + percent) * F.least("ma", "mb") >= percent * (F.col("na") + F.col("nb")))


def _known(rows: DataFrame, comps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(sig, n, comp, s): per class its component and list of (token, k), the shingles found in two or more components
    and in how many classes. Classes with too few of them have no partner outside their component and are left out."""
    known = rows.select("sig", "n", "token").join(comps.select(F.col("sig").alias("_s"), "comp"), F.col("sig") == F.col("_s"), "left").select(
        "sig", "n", "token", F.coalesce("comp", "sig").alias("comp"))
    mixed = known.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("k")).filter("x <> y").select(
        F.col("token").alias("_t"), "k")
    known = known.join(mixed, F.col("token") == F.col("_t"))
    return stored(known.groupBy("sig", "n", "comp").agg(F.collect_list(F.struct("token", "k")).alias("s")).filter(
        F.size("s") >= F.ceil(percent * F.col("n") / 100)))


def _rows(lists: DataFrame) -> DataFrame:
    """One row for each shingle of the lists."""
    return lists.select("sig", "n", "comp", F.size("s").alias("m"), F.explode("s").alias("t")).select("sig", "n", "comp", "m", "t.token")


def _stars(lists: DataFrame, turn: int) -> DataFrame:
    """(a, b): each class with one of another component for each of three of its shingles. That one is the class most
    of whose shingles others have, which is the most likely to be near many, in every other turn; in those between, it
    and the shingles go by hashes that change with each turn."""
    hashed = F.xxhash64("sig", F.lit(turn))
    best = F.struct((-F.col("m") / F.col("n")).alias("share"), hashed.alias("h")) if turn % 2 == 0 else hashed
    centre = _rows(lists).groupBy("token").agg(F.min_by(F.struct("sig", "n", "comp", "m"), best).alias("c"))
    order = F.array_sort(F.transform("s", lambda x: F.struct(F.xxhash64(x["token"], F.lit(turn)).alias("h"), x["token"].alias("token"))))
    first = lists.select("sig", "n", "comp", F.size("s").alias("m"), F.explode(F.slice(order, 1, 3)).alias("t"))
    pairs = first.join(centre, F.col("t.token") == F.col("token")).filter(F.col("comp") != F.col("c.comp"))
    return pairs.select(
        F.col("sig").alias("a"), F.col("c.sig").alias("b"), F.col("n").alias("na"), F.col("c.n").alias("nb"),
        F.col("m").alias("ma"), F.col("c.m").alias("mb")).filter(_close()).select("a", "b").distinct()


def _level(n: int) -> int:
    """Sizes of two partners differ by one level at most."""
    level, bound = 0, 1
    while bound * 5 // 4 + 1 <= n:
        level, bound = level + 1, bound * 5 // 4 + 1
    return level


def _level_size(level: int) -> int:
    bound = 1
    for _ in range(level):
        bound = bound * 5 // 4 + 1
    return bound


def keys(n: int, tokens: list[int], counts: list[int], percent: int = PERCENT) -> dict[int, tuple[int, int]]:
    """Keys of a class by its mixed shingles, each with the rank of its last shingle in order of rarity and g. Of two
    sets that share o of their m and m' shingles, the first m - o + g + 1 and m' - o + g + 1 in that order share g + 1:
    rare ones are keys singly, frequent ones in pairs out of one of g token classes. g goes by level, so that partners
    agree on it. Here o is the least that any partner shares; what a pair at hand must share is looked at where it meets."""
    order = sorted(zip(counts, tokens))
    out: dict[int, tuple[int, int]] = {}
    for lv in {_level(n), max(_level(n) - 1, 0)}:
        groups = min(max(_level_size(lv) // GROUP, 1), overlap(_level_size(lv), percent) - 1)
        by_group: dict[int, list[tuple[int, int]]] = {}
        for rank, (c, t) in enumerate(order[: max(len(order) - overlap(n, percent) + groups + 1, 0)]):
            if c <= RARE:
                out[t] = (rank, max(groups, out.get(t, (0, 0))[1]))
            elif groups < 1:
                out[xxhash.xxh3_64_intdigest(f"{lv}:{t}") - (1 << 63)] = (rank, groups)
            else:
                by_group.setdefault(t % groups, []).append((t, rank))
        for g in by_group.values():
            for (x, i), (y, j) in combinations(sorted(g), 2):
                out[xxhash.xxh3_64_intdigest(f"{lv}:{x}:{y}") - (1 << 63)] = (max(i, j), groups)
    return out


def _candidates(lists: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): classes of different components that meet in a key within the prefixes that this pair needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                got = [keys(n, [x["token"] for x in s], [x["k"] for x in s]) for n, s in zip(part.column(1).to_pylist(), part.column(3).to_pylist())]
                at = pa.array(np.repeat(np.arange(len(got)), [len(g) for g in got]))
                sizes = pa.array([len(s) for s in part.column(3)], pa.int32())
                places = [p for g in got for p in g.values()]
                yield pa.RecordBatch.from_arrays(
                    [*part.select(["sig", "n", "comp"]).take(at).columns, sizes.take(at), pa.array([k for g in got for k in g], pa.int64()),
                     pa.array([p[0] for p in places], pa.int32()), pa.array([p[1] for p in places], pa.int32())], names)

    kinds = "sig long, n long, comp long, m int, key long, rank int, g int"
    names = [c.split()[0] for c in kinds.split(", ")]
    keyed = stored(lists.mapInArrow(run, kinds))
    useful = keyed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select(F.col("key").alias("_k"))
    keyed = stored(keyed.join(useful, F.col("key") == F.col("_k"), "left_semi"))
    sides = {"sig": "", "n": "n", "comp": "c", "m": "m", "key": "k", "rank": "r", "g": "g"}
    side = lambda s: keyed.select(*[F.col(c).alias(f"{p}{s}") for c, p in sides.items()])
    shared = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    more = F.greatest("ga", "gb") + 1 - shared
    near = (F.col("ra") < F.col("ma") + more) & (F.col("rb") < F.col("mb") + more)
    return side("a").join(
        side("b"), (F.col("ka") == F.col("kb")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _close() & near).select("a", "b").distinct()


def members(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, key, n, and comp, the name of its component (null without shingles)."""
    spark = documents.sparkSession
    bits = spark.sparkContext.broadcast(shared_map(documents))
    sets = stored(described(documents, bits))
    # a number stands for each class from here on; written down, it stays
    classes = stored(sets.filter(F.col("tokens").isNotNull()).groupBy(F.col("sig").alias("digest")).agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens")).withColumn("sig", F.monotonically_increasing_id()))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                tokens = [np.frombuffer(t, np.int64) for t in part.column(2).to_pylist()]
                sizes = [len(t) for t in tokens]
                ids = part.select(["sig", "n"]).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(np.concatenate(tokens))], ["sig", "n", "token"])

    rows = classes.select("sig", "n", "tokens").mapInArrow(listed, "sig long, n long, token long")
    links = spark.createDataFrame([], "a long, b long")
    lists = _known(rows, components(links))
    for turn in range(TURNS):
        links = links.union(stored(verified(stored(_stars(lists, turn)), classes)))
        lists = _known(_rows(lists), components(links))  # a shingle found in one component only is of no more use
    comps = components(links.union(stored(verified(stored(_candidates(lists)), classes))))
    groups = stored(classes.select("digest", "sig").join(comps.withColumnRenamed("sig", "_s"), F.col("sig") == F.col("_s"), "left").select(
        "digest", F.coalesce("comp", "sig").cast("string").alias("comp")))
    return stored(sets.select("doc_id", "key", "n", "sig").join(groups, F.col("sig") == F.col("digest"), "left").select(
        "doc_id", "key", "n", F.coalesce("comp", F.hex("sig")).alias("comp")))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    found = members(documents)
    least = found.filter(F.col("comp").isNotNull()).groupBy(F.col("comp").alias("_c")).agg(F.min("doc_id").alias("least"), F.count("*").alias("k")).filter("k > 1")
    return found.join(least, F.col("comp") == F.col("_c"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def distinct(documents: DataFrame) -> DataFrame:
    """One row of each component, with its own columns: that of the smallest doc_id, null ids last; among rows of that
    id the one whose text has the smallest digest; of equal rows any one. Rows without shingles stay, all of them."""
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    grouped = members(documents).filter(F.col("comp").isNotNull()).groupBy("comp", "doc_id", "key").agg(F.count("*").alias("k"))
    grouped = stored(grouped.withColumn("rank", rank))
    several = grouped.groupBy(F.col("comp").alias("_c")).agg(F.min("rank").alias("first"), F.sum("k").alias("all")).filter(F.col("all") > 1)
    judged = grouped.join(several, F.col("comp") == F.col("_c")).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "k", F.col("rank").eqNullSafe(F.col("first")).alias("stays"))
    same = F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_key"))
    rows = packed(documents, _row_key(F.col("text").cast("string")).alias("_digest"))
    left = rows.join(judged.filter(~F.col("stays")).select("_id", "_key"), same, "left_anti")
    repeated = stored(judged.filter(F.col("stays") & (F.col("k") > 1)).select("_id", "_key"))
    if not repeated.isEmpty():
        once = left.join(repeated, same).dropDuplicates(["_id", "_key"]).select("_row")
        left = left.join(repeated, same, "left_anti").select("_row").union(once)
    return unpacked(left)
