"""Toxicity: a counterfactual-regularised logistic classifier over words and word beginnings.

A text is described by its words (A-Z lower-cased, runs of letters, digits and non-ASCII) and their first bytes, hashed to 64 bits, and by how often
each occurs (once, or as often as one of `LEVELS`). It is fitted on a bounded sample of labelled rows (`FIT_ROWS`): Spark counts the features of toxic
and other texts, keeps the `FEATURES` most telling ones, and the driver gets those alone. The loss is logistic with an L2 penalty, plus
`COUNTERFACTUAL` times the squared change of score between each labelled sentence with an identity term and the same sentence with
that term swapped for another, so that naming a group moves no score by itself.

Whole texts are scored, long ones by all their words: features that tell nothing have no weight, so length alone adds nothing. Null and
empty texts score as a text without known features. Without labelled rows of both kinds the score is the share of toxic labels (0 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import LETTERS, LOWER, Words, chunks, mixed, span_hashes

FIT_ROWS, FEATURES, PREFIXES, LEVELS = 8_000, 1_000, (3, 4, 5, 6, 8, 10), (1, 2, 4, 8)
#: Least likelihood-ratio statistic of a feature that is kept.
TELLING = 15.0
L2, COUNTERFACTUAL, STEPS, RATE = 2e-4, 1.0, 200, 0.05
THRESHOLD = 0.3

#: Identity terms, in groups within which they are swapped.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("black", "white", "asian", "latino", "arab", "african", "european", "american"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "foreigners", "natives", "locals"), ("old", "young", "elderly"),
    ("deaf", "blind", "disabled"), ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("musulmans", "chrétiens", "juifs"), ("muslime", "christen", "juden"),
)
_SENTENCE_END = np.isin(np.arange(256), list(b".!?\n"))


@dataclass(frozen=True)
class Classifier:
    keys: np.ndarray  # sorted hashes of words and beginnings
    weights: np.ndarray  # of each and each level
    bias: float


def _word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their beginnings, and the word each belongs to."""
    keys, of = [span_hashes(data, start, end)], [np.arange(len(start))]
    for n in PREFIXES:
        at = np.flatnonzero(end - start > n)
        keys.append(mixed(span_hashes(data, start[at], start[at] + n) + np.uint64(n)))
        of.append(at)
    return np.concatenate(keys), np.concatenate(of)


def _row_features(texts: pa.Array, known: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, rows, features, levels) of chunks: each level that a feature of a row reaches. Features are hashes, or
    indices into `known` if that is given."""
    for a, z, data, off in chunks(texts):
        w = Words(LOWER[data], off, LETTERS)
        keys, of = _word_features(w.data, w.start, w.end)
        rows = w.row[of]
        if known is not None:
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[at] == keys) if len(known) else np.empty(0, np.int64)
            rows, keys = rows[hit], at[hit]
        order = np.lexsort((keys, rows))
        rows, keys = rows[order], keys[order]
        begin = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1]))[: len(rows)])
        count = np.diff(np.append(begin, len(rows)))
        reached = [begin[count >= n] for n in LEVELS]
        level = np.repeat(np.arange(len(LEVELS)), [len(r) for r in reached])
        first = np.concatenate(reached)
        yield a, z, rows[first], keys[first], level


def _features_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    w = Words(LOWER[data], np.array([0, len(data)]), LETTERS)
    return np.unique(_word_features(w.data, w.start, w.end)[0])


def _swaps() -> dict[str, list[str]]:
    return {t: [o for o in group if o != t] for group in IDENTITY_TERMS for t in group}


def counterfactuals(text: str) -> Iterator[tuple[str, str]]:
    """Sentences of a text that name a group, each with one such term swapped for the next of its kind."""
    swaps, at = _swaps(), 0
    data = np.frombuffer(text.encode(), np.uint8)
    for end in [*(np.flatnonzero(_SENTENCE_END[data]) + 1).tolist(), len(data)]:
        sentence = data[at:end].tobytes().decode("utf-8", "replace")
        at = end
        words = sentence.split()
        for i, word in enumerate(words):
            term = word.strip(",;:.!?\"'()").lower()
            for other in swaps.get(term, ()):
                yield sentence, " ".join([*words[:i], other, *words[i + 1 :]])


def _telling(sample: DataFrame) -> np.ndarray:
    """The features that tell toxic texts from others best, by the likelihood ratio of their document counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = np.array(b.column(1).to_pylist(), bool)
            for a, _, rows, keys, level in _row_features(b.column(0)):
                order = np.lexsort((level, keys))
                keys, level, kind = keys[order], level[order], toxic[a + rows[order]]
                begin = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (level[1:] != level[:-1]))[: len(keys)])
                ones = np.add.reduceat(kind.astype(np.int64), begin) if len(begin) else begin
                zeros = np.diff(np.append(begin, len(keys))) - ones
                yield pa.RecordBatch.from_arrays([pa.array(keys[begin].view(np.int64)), pa.array(level[begin]), pa.array(ones), pa.array(zeros)], ["key", "level", "ones", "zeros"])

    n1, n0 = (sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first() or (0, 0))[:2]
    if not n1 or not n0:
        return np.empty(0, np.uint64)
    rate = n1 / (n1 + n0)
    seen = F.col("ones") + F.col("zeros")
    part = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    missing1, missing0 = F.lit(n1) - F.col("ones"), F.lit(n0) - F.col("zeros")
    unseen = F.lit(n1 + n0) - seen
    ratio = 2 * (part(F.col("ones"), seen * rate) + part(F.col("zeros"), seen * (1 - rate)) + part(missing1, unseen * rate) + part(missing0, unseen * (1 - rate)))
    counts = sample.mapInArrow(count, "key bigint, level bigint, ones bigint, zeros bigint").groupBy("key", "level").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    best = counts.where(seen >= 3).select("key", "level", ratio.alias("g")).where(F.col("g") >= TELLING).orderBy(F.desc("g"), "key", "level").limit(FEATURES)
    return np.unique(np.array([r.key for r in best.collect()], np.int64).view(np.uint64))


def learn(sample: DataFrame, counterfactual: float = COUNTERFACTUAL) -> Classifier:
    """Fit on a sample of (text, label) that is small enough for the driver, of which it gets the kept features only."""
    terms = np.concatenate([_features_of(t) for group in IDENTITY_TERMS for t in group])
    known = np.unique(np.concatenate((_telling(sample), terms)))
    size = len(known) * len(LEVELS)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, rows, index, level in _row_features(b.column(0), known):
                order = np.argsort(rows, kind="stable")
                index = (index * len(LEVELS) + level)[order]
                cut = np.searchsorted(rows[order], np.arange(z - a + 1))
                pairs: list[list[list[int]]] = []
                for text in b.column(0).slice(a, z - a).to_pylist():
                    both = [(np.searchsorted(known, np.intersect1d(_features_of(x), known)), np.searchsorted(known, np.intersect1d(_features_of(y), known))) for x, y in counterfactuals(text)]
                    pairs.append([[*(np.setdiff1d(x, y) * len(LEVELS)).tolist(), *(~(np.setdiff1d(y, x) * len(LEVELS))).tolist()] for x, y in both])
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(a, z - a), pa.array([index[cut[i] : cut[i + 1]].tolist() for i in range(z - a)], pa.list_(pa.int64())), pa.array(pairs, pa.list_(pa.list_(pa.int64())))],
                    ["label", "features", "swaps"],
                )

    rows = sample.mapInArrow(reduce, "label int, features array<bigint>, swaps array<array<bigint>>").collect()
    y = np.array([r.label for r in rows], float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Classifier(known, np.zeros(size), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    x = np.zeros((len(y), size), np.float32)
    for i, r in enumerate(rows):
        x[i, r.features] = 1
    swaps = [s for r in rows for s in r.swaps]
    change = np.zeros((len(swaps), size), np.float32)
    for i, s in enumerate(swaps):
        for j in s:
            change[i, j if j >= 0 else ~j] = 1 if j >= 0 else -1
    return Classifier(known, *_fit(x, y.astype(np.float32), change, counterfactual))


def _fit(x: np.ndarray, y: np.ndarray, change: np.ndarray, counterfactual: float) -> tuple[np.ndarray, float]:
    """Adam steps on the whole loss; `change` holds the difference of features of each swapped pair."""
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    for step in range(1, STEPS + 1):
        error = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))) - y
        slope = x.T @ error / len(y) + L2 * w[:-1]
        if len(change):
            slope += 2 * counterfactual * (change.T @ (change @ w[:-1])) / len(change)
        g = np.append(slope, error.mean()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def score_texts(model: Classifier, texts: pa.Array) -> np.ndarray:
    out = np.full(len(texts), model.bias)
    for a, z, rows, index, level in _row_features(texts, model.keys):
        out[a:z] += np.bincount(rows, model.weights[index * len(LEVELS) + level], z - a)
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def predict(docs: DataFrame, model: Classifier, keep: list[Column | str], text_col: str = "text") -> DataFrame:
    """Columns `keep` of each row, `score`, and `predicted` (1 from a score of `THRESHOLD` on). No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    kept = rows.drop("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = score_texts(shared.value, b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], [*b.schema.names[:-1], "score", "predicted"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "score double, predicted int"])
    return rows.mapInArrow(run, schema)
