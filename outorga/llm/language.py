"""Language of texts, word by word, by a linear-chain conditional random field.

Each word of a text is a state, labelled with a language. Its evidence is the sum of learned weights of its
affixes, letter n-grams and, for common words, itself; learned transitions tie neighbours, so code-switched texts
get a label per word. Forward-backward gives the posteriors of the words; a text's language is that of the largest
mean posterior, its score that mean.

The field is fitted on at most SAMPLE labelled texts of each language (those of the smallest hashes of doc_id, a
stretch of STRETCH characters out of each), spliced to sequences that change language; every text is labelled
whole. Every language is learned.

Defined results: null, empty and letterless texts are ``und`` with score 0; if nothing can be learned, all are;
ties go to the first language by name; repeated documents get equal rows; an empty table gives an empty result.
Extra columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 500
STRETCH = 600
LENGTH, BATCH, STEPS, RATE = 48, 64, 400, 0.05
CHARS = 8_000_000  # characters labelled at a time
WORDS = 300_000  # words a worker remembers


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def core(word: str) -> str:
    """The letters of a word in small letters, without what stands around them."""
    return "".join(c for c in word.lower() if c.isalpha() or c in "'’-").strip("'’-")


def features(word: str) -> list[str]:
    """Letter n-grams of the word between its marks of start and end (so also its affixes), and the word."""
    p = f"^{word}$"
    grams = [p[i : i + n] for n in (2, 3) for i in range(len(p) - n + 1)]
    return [*grams, p[:5] + "<", ">" + p[-5:], p]


class Field:
    """Weights of features and transitions."""

    def __init__(self, labels: list[str], index: dict[str, int]) -> None:
        self.labels, self.index = labels, index
        self.weights = np.zeros((len(index) + 1, len(labels)))  # the last row, of unknown features, stays 0
        self.moves = np.zeros((len(labels), len(labels)))

    def known(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature rows of the words, one after the other, and where each word's begin."""
        get, unknown = self.index.get, len(self.index)
        rows, starts = [], []
        for w in words:
            starts.append(len(rows))
            rows.append(unknown)
            rows.extend(k for f in features(w) if (k := get(f)) is not None)
        return np.array(rows, np.int64), np.array(starts, np.int64)

    def evidence(self, words: list[str]) -> np.ndarray:
        rows, starts = self.known(words)
        return np.add.reduceat(self.weights[rows], starts, axis=0) if len(starts) else np.zeros((0, len(self.labels)))


def posteriors(evidence: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Mean posterior of each label over the words of each sequence, all sequences side by side."""
    order = np.argsort(-sizes, kind="stable")
    n_at = np.searchsorted(-sizes[order], -np.arange(sizes.max()), "left")  # sequences that have a t-th word
    offset = np.r_[0, np.cumsum(n_at)]
    place, first = np.empty(len(sizes), np.int64), np.cumsum(sizes) - sizes
    place[order] = np.arange(len(sizes))
    t = np.arange(len(evidence)) - np.repeat(first, sizes)
    e = np.empty_like(evidence)
    e[offset[t] + np.repeat(place, sizes)] = np.exp(evidence - evidence.max(1, keepdims=True))
    a = np.exp(moves - moves.max()).astype(evidence.dtype)
    ahead = np.empty_like(e)
    x = e[: n_at[0]] / e[: n_at[0]].sum(1, keepdims=True)
    ahead[: n_at[0]] = x
    for t in range(1, len(n_at)):
        lo, n = offset[t], n_at[t]
        x = (x[:n] @ a) * e[lo : lo + n]
        x /= x.sum(1, keepdims=True)
        ahead[lo : lo + n] = x
    total, back = np.zeros((len(sizes), evidence.shape[1])), np.ones((n_at[-1], evidence.shape[1]), e.dtype)
    for t in range(len(n_at) - 1, -1, -1):
        lo, n = offset[t], n_at[t]
        both = ahead[lo : lo + n] * back
        total[:n] += both / both.sum(1, keepdims=True)
        if t:
            x = (e[lo : lo + n] * back) @ a.T
            back = np.ones((n_at[t - 1], evidence.shape[1]), e.dtype)
            back[:n] = x / x.sum(1, keepdims=True) * evidence.shape[1]
    return total[place] / sizes[:, None]


def learned(stretches: list[tuple[str, str]]) -> Field | None:
    """Fit a field to (language, text) by Adam on spliced sequences."""
    lines = [(lang, [c for w in text.split() if (c := core(w))]) for lang, text in stretches]
    lines = [(lang, words) for lang, words in lines if words]
    if not lines:
        return None
    labels = sorted({lang for lang, _ in lines})
    count = Counter(f for _, words in lines for w in words for f in set(features(w)))
    field = Field(labels, {f: k for k, f in enumerate(sorted(f for f, n in count.items() if n > 1))})
    number, rng = {lang: k for k, lang in enumerate(labels)}, np.random.default_rng(7)
    words = sorted({w for _, ws in lines for w in ws})
    at = {w: k for k, w in enumerate(words)}
    rows, starts = field.known(words)
    sizes = np.diff(np.r_[starts, len(rows)])
    coded = [(number[lang], np.array([at[w] for w in ws])) for lang, ws in lines]
    by_label = [[ws for k, ws in coded if k == number[lang]] for lang in labels]
    k, n = len(labels), len(field.index) + 1
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (field.weights, field.moves)]
    for step in range(1, STEPS + 1):
        x, y = np.zeros((BATCH, LENGTH), np.int64), np.zeros((BATCH, LENGTH), np.int64)
        for b in range(BATCH):
            filled = 0
            while filled < LENGTH:  # runs of 4 to 32 words of one language
                label = rng.integers(k)
                ws = by_label[label][rng.integers(len(by_label[label]))]
                run = min(int(rng.integers(4, 33)), LENGTH - filled, len(ws))
                begin = rng.integers(len(ws) - run + 1)
                x[b, filled : filled + run], y[b, filled : filled + run] = ws[begin : begin + run], label
                filled += run
        flat = x.ravel()
        size = sizes[flat]
        ends = np.cumsum(size)
        used = rows[np.arange(ends[-1]) + np.repeat(starts[flat] - (ends - size), size)]
        e = np.add.reduceat(field.weights[used], ends - size, axis=0).reshape(BATCH, LENGTH, k)
        e = np.exp(e - e.max(2, keepdims=True))
        a = np.exp(field.moves)
        f, b = np.empty_like(e), np.empty_like(e)
        f[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for t in range(1, LENGTH):
            f[:, t] = (f[:, t - 1] @ a) * e[:, t]
            f[:, t] /= f[:, t].sum(1, keepdims=True)
        b[:, -1] = 1
        for t in range(LENGTH - 2, -1, -1):
            b[:, t] = (e[:, t + 1] * b[:, t + 1]) @ a.T
            b[:, t] /= b[:, t].sum(1, keepdims=True)
        g = f * b
        g /= g.sum(2, keepdims=True)
        pair = f[:, :-1, :, None] * a * (e[:, 1:] * b[:, 1:])[:, :, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        seen = np.zeros((k, k))
        np.add.at(seen, (y[:, :-1], y[:, 1:]), 1)
        error = g.reshape(-1, k).copy()
        error[np.arange(len(error)), y.ravel()] -= 1
        spread = np.repeat(error, size, axis=0)
        slopes = (np.stack([np.bincount(used, spread[:, c], n) for c in range(k)], 1) / BATCH + 1e-4 * field.weights,
                  (pair.sum((0, 1)) - seen) / BATCH + 1e-4 * field.moves)
        slopes[0][-1] = 0
        for p, slope, (m, v) in zip((field.weights, field.moves), slopes, state):
            m *= 0.9
            m += 0.1 * slope
            v *= 0.99
            v += 0.01 * slope * slope
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def fit(documents: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Learn from the documents that are not held out and have a language and a text."""
    rows = documents.select(F.col("doc_id"), F.col("text"), F.col("lang").cast("string").alias("lang")).filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return None
    # about 1.5 times the sample of each language by hash, then no more than the sample
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.5 * sample / r["count"], 1.0))])
    mixed = F.xxhash64(F.col("doc_id"), F.lit("language"))
    some = rows.filter(F.coalesce(F.pmod(mixed, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20), F.lit(False)))
    begin = F.pmod(mixed, F.greatest(F.length("text") - STRETCH, F.lit(1))).cast("int") + 1
    some = some.select("lang", F.substring("text", begin, F.lit(STRETCH)).alias("part"), mixed.alias("h")).orderBy("h", "lang", "part")
    taken: Counter[str] = Counter()
    stretches = []
    for r in some.limit(2 * sample * len(counts)).collect():
        if taken[r["lang"]] < sample:
            taken[r["lang"]] += 1
            stretches.append((r["lang"], r["part"]))
    return learned(stretches)


class Labeller:
    """Evidence of words by dictionary, for one worker."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(self.field.labels)), np.float32)

    def look(self, words: list[str]) -> np.ndarray:
        """Rows of ``table`` for the words, -1 for those without a letter."""
        if len(self.known) > WORDS:
            self.forget()
        if new := list(set(words) - self.known.keys()):
            forms = [core(w) for w in new]
            forms = [f if any(map(str.isalpha, f)) else "" for f in forms]
            different = list({f for f in forms if f})
            n = len(self.table)
            self.table = np.concatenate([self.table, self.field.evidence(different).astype(np.float32)])
            row = dict(zip(different, range(n, n + len(different))))
            self.known.update((w, row.get(f, -1)) for w, f in zip(new, forms))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        parts = [t.split() if t else [] for t in texts]
        rows = self.look([w for p in parts for w in p])
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])[rows >= 0]
        rows = rows[rows >= 0]
        sizes = np.bincount(owner, minlength=len(parts))
        names, scores = ["und"] * len(parts), [0.0] * len(parts)
        some = np.flatnonzero(sizes)
        if len(some):
            means = posteriors(self.table[rows], sizes[some], self.field.moves)
            for i, best, p in zip(some, means.argmax(1), means.max(1)):
                names[i], scores[i] = self.field.labels[best], min(float(p), 1.0)
        return names, scores


def identify(documents: DataFrame, field: Field | None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    rows = documents.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    if field is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(field)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in batches:
            texts = batch.column(2)
            first, size = 0, 0
            for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
                size += n or 0
                if size > CHARS or i + 1 == len(texts):
                    names, scores = labeller.label(texts.slice(first, i + 1 - first).to_pylist())
                    part = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                        ["doc_id", "held_out", "lang_pred", "score"])
                    first, size = i + 1, 0

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
