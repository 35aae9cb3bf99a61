"""Collocations against plain Python: small blocks, bursts and spills, nulls, ties, repeats, empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from outorga.llm import collocations

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, block long, word string, n int"


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = {}
    for (lang, *w), a in found.items():
        over = [b for (other, *v), b in found.items() if other == lang and len(v) > len(w)
                and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * b >= 80 * a for b in over):
            continue
        cuts = [(2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((" ".join(w), a, f[lang, *w[:k]], f[lang, *w[k:]], n[lang], score))
    result = []
    for lang, phrases in out.items():
        phrases.sort(key=lambda p: (-p[5], -p[1], p[0].encode()))
        result += [(lang, rank, *p) for rank, p in enumerate(phrases[:top], 1)]
    return sorted(result)


def corpus():
    rng = random.Random(5)
    words = "the of New york City É日 x y b\x1cc a-b 'q' (z) mit Über İ".split(" ") + [f"w{k}" for k in range(25)]
    fixed = ["new York city hall", "one two three four five", "go\tgo go go go", "in the city of"]
    rows = []
    for i in range(300):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(rng.randint(0, 6))]
        text = "".join(p + rng.choice([" ", ". ", ",", "; ", "\n", "\r\n", "  ", "!?", "\x0b"]) for p in parts)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(1, None, "en"), (2, "", None), (3, " \t\n..", "fr"), (4, "word " * 7000, "en"), rows[0], rows[0], (5, "a b. " * 3000, "es")]


@pytest.mark.parametrize("sizes", [{}, {"block": 50, "capacity": 4, "budget": 16}, {"block": 700, "capacity": 16, "budget": 40}])
@pytest.mark.parametrize("least,top,chunk", [(3, 1 << 20, 5), (6, 12, 1 << 18)])
def test_collocations_equal_brute_force(spark, sizes, least, top, chunk, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    rows = corpus()
    table = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], SCHEMA).repartition(5)
    got = collocations.collocations(table, least, top, **sizes).collect()
    assert sorted(map(tuple, got)) == brute(rows, least, top)


def test_nothing_frequent_and_empty(spark):
    table = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    assert collocations.collocations(table).count() == 0
    assert collocations.collocations(table.filter("false")).count() == 0


@pytest.mark.parametrize("budget", [1 << 30, 300])
def test_trie_counts_bursts_and_spills(budget):
    rng = np.random.default_rng(2)
    hot = rng.integers(1, 4, 20_000) << 32 | rng.integers(1, 2000, 20_000)  # few first words: nodes for the next one
    keys = np.concatenate([hot, rng.integers(1, 500, 20_000) << 32 | rng.integers(1, 5, 20_000)])
    total = Counter()
    for key, n in collocations._runs(np.array_split(keys, 8), 32, budget):
        assert (np.diff(key) > 0).all()
        total.update(dict(zip(key.tolist(), n.tolist())))
    assert total == Counter(keys.tolist())
    trie = collocations.HatTrie(32, 32)
    trie.add(*np.unique(keys, return_counts=True))
    assert trie.size == len(total) and any(isinstance(c, collocations.HatTrie) for c in trie.children)
    for start, end, child in zip(trie.starts, trie.starts[1:], trie.children):
        assert not isinstance(child, collocations.HatTrie) or end == start + 1  # a node stands for one word
    assert all(len(c) <= 32 for node in (trie, *trie.children) if isinstance(node, collocations.HatTrie)
               for c in node.children if not isinstance(c, collocations.HatTrie))
    assert list(trie.spill(trie.size)) == []


def test_long_text_is_cut_between_words():
    text = b"ab cd. " * 400_000
    parts = list(collocations._words(text))
    assert len(parts) > 3 and sum(parts, []) == [b"ab", b"cd", b"."] * 400_000 + [b"."]
