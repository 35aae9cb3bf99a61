"""Line dedup against plain Python: shards, common lines, nulls, ties, repeated rows, empty tables."""

from __future__ import annotations

import random

import numpy as np
import pytest

from outorga.llm import lines

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, dropped int, _row string, row long, lines string"


def key(line):
    return line.strip(lines.BLANK).translate(ASCII)


def brute(rows):
    last = max([i for i, _ in rows if i is not None], default=0) + 1
    owner = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), last), last if i is None else i)
    out = []
    for i, text in rows:
        split = (text or "").split("\n")
        kept = [x for x in split if len(key(x)) < 10 or owner[key(x)] == (last if i is None else i)]
        out.append((i, len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def many(n):
    rng = random.Random(3)
    pool = [f"line number {k} of some length" for k in range(400)] + ["short", "", " \t", "ÀÉ İß ünïcödé line", "x" * 10, "y" * 9]
    rows = []
    for i in range(n):
        text = ["  The Very Common LINE \r"] * rng.randint(0, 3) + rng.choices(pool, k=rng.randint(0, 12))
        text += [f"only here {i} {rng.random()}"]
        rng.shuffle(text)
        rows.append((rng.choice([i, i, i, rng.randint(0, 20), None]), rng.choice(["\n", "\n", "\r\n"]).join(text)))
    return rows + [(5, None), (6, ""), (7, "\n\n"), (8, "\n".join(["again and again"] * 3000 + [f"long text {k}" for k in range(30_000)])),
                   (9, "again and again"), (2, "Again And Again  "), rows[0], rows[0]]


@pytest.mark.parametrize("sizes", [{}, {"shard": 64, "common": 20}, {"shard": 1 << 40, "common": 1}])
def test_lines_equal_brute_force(spark, sizes):
    rows = many(150)
    table = spark.createDataFrame([(*r, 1, "r", 2, "l") for r in rows], SCHEMA).repartition(5)
    got = lines.deduplicated(table, **sizes)
    result = got.select("_row.doc_id", "n_lines", "n_dropped", "kept", "_row").collect()
    assert sorted((tuple(r)[:4] for r in result), key=str) == brute(rows)
    assert all(r["_row"].lines == "l" and r["_row"].dropped == 1 for r in result)
    assert lines.deduplicated(table.filter("false")).count() == 0


def test_more_documents_are_asked_for(spark):
    table = spark.createDataFrame([(1, "twice in here"), (2, "twice in here\nthree times here"), (3, "three times here"), (4, "three times here")], "doc_id long, text string")
    got = {r._row.doc_id: r.kept for r in lines.deduplicated(table, least=3).collect()}
    assert got == {1: "twice in here", 2: "twice in here\nthree times here", 3: "", 4: ""}


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        hi, lo = rng.integers(-(2**63), 2**63 - 1, (2, n))
        hi[: n // 2] = 7  # half of the keys differ in one word only
        hashed = lines.PerfectHash.build(hi, lo)
        assert sorted(hashed.numbers(hi, lo)) == list(range(n))
    other = rng.integers(-(2**63), 2**63 - 1, (2, 1000))
    row = lines._shard_row(hi, lo, np.arange(n), np.arange(n))
    assert lines.Shard(row).known(*other)[1].sum() == 0 and lines.Shard(row).known(hi, lo)[1].all()
    with pytest.raises(ValueError, match="repeat"):
        lines.PerfectHash.build(np.array([1, 1]), np.array([2, 2]))
