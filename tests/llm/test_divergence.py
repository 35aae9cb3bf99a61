"""Source divergence audit against plain Python: split digests, tiles, blocks, nulls, ties, groups without terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import xxhash

from outorga.llm import divergence

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, tile int"


def brute(rows, least, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, far(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(11)
    words = ["the", "of", "İstanbul", "ﬁn", "Über", "x", "日本"] + [f"w{a}{b}" for a in "abcdefgh" for b in "klmnop"] + [f"rare{c}" for c in "qrstuv"]
    rows = []
    for i in range(260):
        lang = rng.choice(["en", "en", "de", None, "xx"])
        source = rng.choice(["hot", "hot", "hot", "s1", "s2", "s3", None, "s5", ""])
        near = words[: 20 + 7 * len(source or "")]
        rows.append((i, rng.choice([" ", ", ", "1"]).join(rng.choices(near, k=rng.randint(0, 40))), lang, source))
    return rows + [(None, None, "en", "empty"), (1, "", "fr", "only"), (2, "...", "fr", "two"), (3, "THE the tHe " * 9000, "en", "s1"), rows[0], rows[0]]


@pytest.mark.parametrize("sizes", [{}, {"bits": 3}, {"block": 5, "tile": 2}, {"bits": 4, "block": 7, "tile": 3}])
def test_audit_equals_brute_force(spark, sizes):
    rows = corpus()
    table = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], SCHEMA).repartition(6)
    got = divergence.audit(table, least=4, top=5, **sizes).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 5)


def test_nothing_kept_and_empty(spark):
    table = spark.createDataFrame([(1, "a b", "en", "x"), (2, "c", "en", "y"), (3, None, None, None)], "doc_id long, text string, lang string, source string")
    got = divergence.audit(table).collect()
    assert sorted(map(tuple, got)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergence.audit(table.filter("false")).count() == 0


def test_tally_folds_and_empties(monkeypatch):
    monkeypatch.setattr(divergence, "WORDS", 7)
    tally = divergence.Tally(64, False)
    for text in (b"a b a", b"b c", b"a a a a a a a a", b"C"):
        tally.add("en", "s", text)
    rows = [r for batch in tally.rows() for r in batch.to_pylist()]
    names = {r["digest"]: r["term"] for r in rows if r["term"]}
    cells = {names[r["digest"]]: (r["n"], r["docs"]) for r in rows if r["n"]}
    assert cells == {"a": (10, 2), "b": (2, 2), "c": (2, 2)} and list(tally.rows()) == []
    assert {r["digest"] for r in rows if r["term"]} == {xxhash.xxh64_intdigest(t) - ((xxhash.xxh64_intdigest(t) >> 63) << 64) for t in (b"a", b"b", b"c")}


def test_pairs_have_one_direction_in_every_block():
    """Rows of a block arrive in any order: partial sums of a pair must not fall under (a, b) here and (b, a) there."""
    rows = [("en", s, 0, p0, d, None, p, 0, 0, 0) for s, p0 in (("s1", 1), ("s2", 2), ("s3", 3)) for d, p in ((None, None), (7, 100 * p0), (8, 5))]
    names = ["lang", "source", "tile", "p0", "digest", "split", "p", "first", "second", "block"]
    kinds = dict.fromkeys(names, pa.int64()) | dict.fromkeys(["lang", "source", "split"], pa.string())
    schema = pa.schema(list(kinds.items()))

    def sums(rows):
        return sorted(tuple(r.values()) for r in divergence._pair_sums(pa.table(list(zip(*rows)), schema=schema)).to_pylist())

    want = sums(rows)
    assert [r[1:3] for r in want] == [("s1", "s2"), ("s1", "s3"), ("s2", "s3")]
    assert sums(rows[::-1]) == want and sums(rows[4:] + rows[:4]) == want


def test_blocks_whose_rows_arrive_in_other_orders(spark, monkeypatch):
    whole = divergence._pair_sums

    def shuffled(table):
        order = list(range(table.num_rows))
        random.Random(table.column("block")[0].as_py()).shuffle(order)
        return whole(table.take(order))

    monkeypatch.setattr(divergence, "_pair_sums", shuffled)
    rows = corpus()
    table = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], SCHEMA).repartition(6)
    got = divergence.audit(table, least=4, top=5, block=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 5)
