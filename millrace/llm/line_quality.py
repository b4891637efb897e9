"""Document quality from lines: a linear-chain conditional random field labels each line good or bad.

A line (cut at \\n, with a word in it) is seen through its own features and those of the lines before and after it. The field has a weight for
each feature and for each pair of neighbouring labels. It is fitted on a bounded sample of labelled documents (`FIT_ROWS`), whose lines take the
document's label. Forward-backward gives each line's chance to be good; their mean, weighted by the characters of the lines, is the document's
quality, which a logistic curve fitted on the same sample turns into a score.

Every line of a whole text takes part. Texts without a line (null, empty, blanks) have quality 0. Without labelled rows of both
kinds the score is the share of good labels (0 if none). Rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import Words, chunks, mixed, span_hashes

FIT_ROWS, STEPS, RATE, L2 = 6_000, 250, 0.05, 1e-4
THRESHOLD = 0.3

_ASCII = np.arange(256)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_LOWER = (_ASCII >= 97) & (_ASCII <= 122)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_LETTER = _UPPER | _LOWER | (_ASCII >= 0x80)
_MARK = (_ASCII > 32) & (_ASCII < 127) & ~_LETTER & ~_DIGIT & ~np.isin(_ASCII, list(b".,;:'\"-()"))
_SHOUT = np.isin(_ASCII, list(b"!?"))
_STOP = np.isin(_ASCII, list(b".!?:;\"')"))


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # of the features, for good over bad
    pairs: np.ndarray  # 2 x 2, from the label before to the label
    curve: tuple[float, float]  # slope and offset of the logistic curve over the logit of quality


def _lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, row, characters) of the lines with a word."""
    w = Words(data, off)
    cuts = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, off)))
    start, end = cuts[:-1], cuts[1:]
    a, z = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    full = z > a
    a, z = a[full], z[full]
    start, end = w.start[a] if len(a) else a, w.end[z - 1] if len(a) else a
    row = np.searchsorted(off, start, "right") - 1
    total = lambda x: (lambda c: c[end] - c[start])(np.concatenate(([0], np.cumsum(x))))
    by_word = lambda x: (lambda c: c[z] - c[a])(np.concatenate(([0], np.cumsum(x))))
    chars = np.maximum(total(((data & 0xC0) != 0x80) & w.inside), 1)
    words = np.maximum(z - a, 1)
    letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
    blank = letters[w.end] == letters[w.start]  # words without a letter
    hashes = w.hashes()
    same = np.zeros(len(hashes), bool)
    line = np.repeat(np.arange(len(a)), z - a)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    again = np.zeros(len(hashes), bool)
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (line[order[1:]] == line[order[:-1]])
    keys = span_hashes(data, start, end) ^ mixed(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    repeated = np.zeros(len(keys), bool)
    repeated[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    upper, lower = total(_UPPER[data]), total(_LOWER[data])
    base = np.stack(
        [
            np.minimum(np.log1p(words) / 6, 1.5), np.minimum(chars / words / 12, 2.0), total(_MARK[data]) / chars, upper / np.maximum(upper + lower, 1), total(_DIGIT[data]) / chars,
            by_word(blank) / words, by_word(same) / words, by_word(again) / words, repeated, total(_SHOUT[data]) / chars, _STOP[data[end - 1]] if len(end) else end, words < 4,
        ], axis=1,
    ).astype(np.float64)
    own = np.concatenate((base, np.sqrt(base[:, 2:10]), base[:, 2:10] > 0.02, base[:, 2:10] > 0.2), axis=1)
    before, after = np.zeros((len(own), own.shape[1] + 1)), np.zeros((len(own), own.shape[1] + 1))
    inside = np.flatnonzero(row[1:] == row[:-1])
    before[inside + 1, :-1], before[inside + 1, -1] = own[inside], 1
    after[inside, :-1], after[inside, -1] = own[inside + 1], 1
    return np.concatenate((np.ones((len(own), 1)), own, before, after), axis=1), row, chars


def _chains(row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each place in a chain the lines there, longest chains first, and which of the chains of the place before go on."""
    if not len(row):
        return
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    size = np.diff(np.append(first, len(row)))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    alive = np.searchsorted(-size, -np.arange(size[0]), "left")  # chains longer than each place
    for t in range(size[0]):
        yield first[: alive[t]] + t, size[: alive[t]]


def marginals(emission: np.ndarray, pairs: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of each line to be good, expected counts of label pairs, and the log partition function, over all chains."""
    places = [lines for lines, _ in _chains(row)]
    scores = np.stack((np.zeros(len(emission)), emission), axis=1)
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    for t, lines in enumerate(places):
        forward[lines] = scores[lines]
        if t:
            step = forward[lines - 1][:, :, None] + pairs
            top = step.max(axis=1)
            forward[lines] += top + np.log(np.exp(step - top[:, None, :]).sum(axis=1))
    expected = np.zeros((2, 2))
    for t in range(len(places) - 1, 0, -1):
        lines = places[t]
        step = pairs + (scores[lines] + backward[lines])[:, None, :]
        top = step.max(axis=2)
        backward[lines - 1] = top + np.log(np.exp(step - top[:, :, None]).sum(axis=2))
        both = forward[lines - 1][:, :, None] + step
        both -= both.max(axis=(1, 2), keepdims=True)
        both = np.exp(both)
        expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    total = forward + backward
    good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
    last = np.flatnonzero(np.append(row[1:] != row[:-1], True)) if len(row) else np.empty(0, np.int64)
    top = forward[last].max(axis=1) if len(last) else np.empty(0)
    log_z = float((top + np.log(np.exp(forward[last] - top[:, None]).sum(axis=1))).sum()) if len(last) else 0.0
    return good, expected, log_z


def _quality(good: np.ndarray, row: np.ndarray, chars: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, good * chars, n) / np.maximum(np.bincount(row, chars, n), 1)


def _logit(quality: np.ndarray) -> np.ndarray:
    q = np.clip(quality, 1e-3, 1 - 1e-3)
    return np.log(q / (1 - q))


def _adam(w: np.ndarray, slope, steps: int = STEPS) -> np.ndarray:
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        g = slope(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def learn(sample: DataFrame) -> Field:
    """Fit on a sample of (text, label) that is small enough for the driver, which gets the features of its lines."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, data, off in chunks(b.column(0)):
                x, row, chars = _lines(data, off)
                cut = np.searchsorted(row, np.arange(z - a + 1))
                body = [x[cut[i] : cut[i + 1]].astype(np.float32).tobytes() for i in range(z - a)]
                size = [chars[cut[i] : cut[i + 1]].astype(np.int64).tobytes() for i in range(z - a)]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(a, z - a), pa.array(body, pa.binary()), pa.array(size, pa.binary())], ["label", "features", "chars"])

    rows = sample.mapInArrow(features, "label int, features binary, chars binary").collect()
    width = _lines(np.frombuffer(b"a", np.uint8), np.array([0, 1]))[0].shape[1]
    label = np.array([r.label for r in rows], int)
    if not len(label) or label.min() == label.max():
        share = min(max(float(label.mean()) if len(label) else 0.0, 1e-6), 1 - 1e-6)
        return Field(np.zeros(width), np.zeros((2, 2)), (0.0, float(np.log(share / (1 - share)))))
    chars = [np.frombuffer(r.chars, np.int64) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(c) for c in chars])
    x, chars = np.concatenate([np.frombuffer(r.features, np.float32).reshape(-1, width) for r in rows]), np.concatenate(chars)
    y = label[row].astype(float)
    inside = np.flatnonzero(row[1:] == row[:-1])
    seen = np.bincount((2 * y[inside] + y[inside + 1]).astype(int), minlength=4).reshape(2, 2)

    def slope(w: np.ndarray) -> np.ndarray:
        good, expected, _ = marginals(x @ w[:-4], w[-4:].reshape(2, 2), row)
        return np.concatenate((x.T @ (good - y), (expected - seen).ravel())) / max(len(y), 1) + L2 * w

    w = _adam(np.zeros(width + 4), slope)
    good, _, _ = marginals(x @ w[:-4], w[-4:].reshape(2, 2), row)
    z = _logit(_quality(good, row, chars, len(rows)))
    curve = _adam(np.array([1.0, 0.0]), lambda c: (lambda e: np.array([(e * z).mean(), e.mean()]))(1 / (1 + np.exp(-np.clip(c[0] * z + c[1], -30, 30))) - label))
    return Field(w[:-4], w[-4:].reshape(2, 2), (float(curve[0]), float(curve[1])))


def score_texts(model: Field, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, lines and good lines (those that are likelier good) of each text."""
    score, lines, good_lines = np.zeros(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for a, z, data, off in chunks(texts):
        x, row, chars = _lines(data, off)
        good, _, _ = marginals(x @ model.weights, model.pairs, row)
        score[a:z] = _quality(good, row, chars, z - a)
        lines[a:z], good_lines[a:z] = np.bincount(row, minlength=z - a), np.bincount(row[good >= 0.5], minlength=z - a)
    return 1 / (1 + np.exp(-np.clip(model.curve[0] * _logit(score) + model.curve[1], -30, 30))), lines, good_lines


def predict(docs: DataFrame, model: Field, keep: list[Column | str], text_col: str = "text") -> DataFrame:
    """Columns `keep` of each row, `score`, `predicted` (1 from a score of `THRESHOLD` on), `n_lines` and `n_good_lines`. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    kept = rows.drop("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score, lines, good = score_texts(shared.value, b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(lines), pa.array(good)], [*b.schema.names[:-1], "score", "predicted", "n_lines", "n_good_lines"]
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "score double, predicted int, n_lines bigint, n_good_lines bigint"])
    return rows.mapInArrow(run, schema)
