"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are taken over all training rows in one pass (a row for each language, bucket and task reaches the shuffle), so they follow
the whole corpus. The model is a matrix of languages by `BUCKETS`; that, and not the data, bounds what is collected and broadcast.

Texts are lower-cased and read whole; what is not a letter counts as one kind of blank. Null texts and texts without a letter get
`und` and score 0, as does every text if nothing could be learned. Ties go to the language that sorts first. Rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import mixed

BUCKETS, LENGTHS, SMOOTHING = 1 << 14, (1, 2, 3), 0.5
UNKNOWN = "und"
CHUNK_CHARS = 1 << 19


@dataclass(frozen=True)
class NaiveBayes:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_probability: np.ndarray  # bucket x language


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, their rows, and the number of letters of each row."""
    low = [(t or "").lower() for t in texts]
    sizes = np.fromiter(map(len, low), np.int64, len(low)) + 1
    code = np.frombuffer(" ".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(low)), sizes)
    letter = _letters()[code]
    code = np.where(letter, code, 32).astype(np.uint64)
    buckets, rows = [], []
    for n in LENGTHS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        key, any_letter = np.full(size, np.uint64(n)), np.zeros(size, bool)
        for i in range(n):
            key = (key << np.uint64(21)) ^ code[i : i + size]
            any_letter |= letter[i : i + size]
        keep = any_letter & (row[:size] == row[n - 1 :])
        buckets.append((mixed(key[keep]) & np.uint64(BUCKETS - 1)).astype(np.int32))
        rows.append(row[:size][keep])
    return np.concatenate(buckets), np.concatenate(rows), np.bincount(row, letter, len(low))


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> NaiveBayes:
    """Count n-grams by language over every row with a text and a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for b in batches:
            langs, texts = np.array(b.column(0).to_pylist(), object), b.column(1).to_pylist()
            for a, z in _chunks(texts):
                buckets, rows, _ = _features(texts[a:z])
                names, which = np.unique(langs[a:z].astype(str), return_inverse=True)
                seen = np.bincount(which[rows].astype(np.int64) * BUCKETS + buckets, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names.tolist()):
                    found[name] = found.get(name, 0) + seen[k * BUCKETS : (k + 1) * BUCKETS]
                    docs[name] = docs.get(name, 0) + int((which == k).sum())
        for name, seen in found.items():
            full = np.flatnonzero(seen)
            yield pa.RecordBatch.from_pydict({"lang": [name] * (len(full) + 1), "bucket": np.append(full, -1), "n": np.append(seen[full], docs[name])})

    rows = train.select(lang_col, text_col).dropna()
    table = rows.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["lang"].unique())
    counts, docs = np.zeros((BUCKETS, len(names))), np.zeros(len(names))
    of = table["lang"].map({name: k for k, name in enumerate(names)}).to_numpy(int)
    bucket, n = table["bucket"].to_numpy(int), table["n"].to_numpy(float)
    counts[bucket[bucket >= 0], of[bucket >= 0]] = n[bucket >= 0]
    docs[of[bucket < 0]] = n[bucket < 0]
    total = counts.sum(axis=0, keepdims=True)
    log_probability = np.log(counts + SMOOTHING) - np.log(total + SMOOTHING * BUCKETS)
    return NaiveBayes(tuple(names), np.log(docs / max(docs.sum(), 1.0)), log_probability)


def score_texts(model: NaiveBayes, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Most likely language of each text and its posterior probability."""
    out, probability = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return out, probability
    for a, z in _chunks(texts):
        buckets, rows, letters = _features(texts[a:z])
        logs = np.stack([np.bincount(rows, model.log_probability[buckets, k], z - a) for k in range(len(model.languages))], axis=1) + model.log_prior
        best = logs.argmax(axis=1)
        odds = np.exp(logs - logs.max(axis=1, keepdims=True))
        for i in np.flatnonzero(letters):
            out[a + i], probability[a + i] = model.languages[best[i]], 1 / odds[i].sum()
    return out, probability


def predict(docs: DataFrame, model: NaiveBayes, keep: list[Column | str], text_col: str = "text") -> DataFrame:
    """Columns `keep` of each row, `lang_pred` and `score`. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    kept = rows.drop("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, probability = score_texts(shared.value, b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names, pa.string()), pa.array(probability)], [*b.schema.names[:-1], "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "lang_pred string", "score double"])
    return rows.mapInArrow(run, schema)
