"""Benchmark decontamination with suffix arrays of the training text.

Each task lays out its rows in shards, builds a suffix array over the words of a shard, and binary-searches every suffix of the test
items in it: word by word the interval of training suffixes narrows until the longest verbatim match is found. A training suffix can
only be reached by a search if the words it begins with all occur in the test set, so the array is sparse: it leaves out the others. The test set
is the query set. It goes out in blocks of `BLOCK_BYTES` at most, each held against all rows; nothing of the training text is shuffled.

Words: A-Z lower-cased, then runs of bytes other than ASCII that is no digit or letter. A window is `window` consecutive words of an item; an item
with fewer words, but not none, is one window. Null and empty texts have no words and no hits; null items and items without words match nothing.
Rows are judged one by one; repeated items count once by id (as text, null as `null`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import CHUNK, LETTERS, LOWER, Words, chunks

WINDOW = 10
#: Most bytes of test text that one broadcast holds (one longer item makes a block of its own size).
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 4 * CHUNK
_SPANS = "array<struct<start:bigint,end:bigint>>"
MATCH_SCHEMA = f"n_words bigint, hits {_SPANS}, items array<string>, longest bigint"


@dataclass(frozen=True)
class TestSet:
    __test__ = False
    vocabulary: np.ndarray  # sorted word hashes
    words: np.ndarray  # vocabulary index + 1 of each word, items one after another
    end: np.ndarray  # where the item of each word ends
    item: np.ndarray  # item of each word
    start: np.ndarray  # words that begin a window
    need: np.ndarray  # words of that window
    ids: tuple[str, ...]


def test_set(rows: list[tuple[str, str]], window: int = WINDOW) -> TestSet:
    texts = pa.array([t for _, t in rows], pa.string())
    parts = [(lambda w: (w.hashes(), w.row + a))(Words(LOWER[data], off, LETTERS)) for a, _, data, off in chunks(texts)]
    hashes = np.concatenate([h for h, _ in parts]) if parts else np.empty(0, np.uint64)
    item = np.concatenate([r for _, r in parts]) if parts else np.empty(0, np.int64)
    vocabulary, words = np.unique(hashes, return_inverse=True)
    size = np.bincount(item, minlength=len(rows)) if len(rows) else np.empty(0, np.int64)
    end = np.repeat(np.cumsum(size), size)
    need = np.minimum(size, window)[item] if len(item) else np.empty(0, np.int64)
    start = np.flatnonzero(end - np.arange(len(end)) >= need)
    return TestSet(vocabulary, words.astype(np.int64) + 1, end, item, start, need[start], tuple(i for i, _ in rows))


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions `at` in the order of the `depth` words (at least) from there; 0 ends a suffix. Every position outside `at` holds 0."""
    rank = np.zeros(len(words) + 1, np.int64)
    rank[at] = words[at]
    h, distinct = 1, 0
    while h < depth and distinct < len(at):
        beyond = np.minimum(at + h, len(words))
        values, inverse = np.unique(rank[at] * (rank.max() + 1) + rank[beyond], return_inverse=True)
        rank[at], distinct, h = inverse + 1, len(values), h * 2
    return at[np.argsort(rank[at], kind="stable")]


def _bound(value_at, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
    """First place in [lo, hi) whose value is not below `wanted` (or above it, if `right`); for all searches at once."""
    lo, hi = lo.copy(), hi.copy()
    while len(open_ := np.flatnonzero(lo < hi)):
        mid = (lo[open_] + hi[open_]) // 2
        value = value_at(mid)
        below = value <= wanted[open_] if right else value < wanted[open_]
        lo[open_[below]], hi[open_[~below]] = mid[below] + 1, mid[~below]
    return lo


def search(test: TestSet, words: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of the windows in a shard: (index into `test.start`, position in the shard, words of the longest match from there)."""
    n = len(test.start)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(array))
    live, d = np.arange(n), 0
    first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    while len(live):
        value_at = lambda mid, d=d: words[np.minimum(array[mid] + d, len(words) - 1)]
        wanted = test.words[test.start[live] + d]
        a = _bound(value_at, lo[live], hi[live], wanted, False)
        z = _bound(value_at, a, hi[live], wanted, True)
        lo[live], hi[live] = a, z
        d += 1
        done = (z > a) & (test.need[live] == d)
        first[live[done]], last[live[done]] = a[done], z[done]
        live = live[(z > a) & (test.need[live] > d)]
    found = last - first
    which = np.repeat(np.arange(n), found)
    place = array[np.repeat(first - (np.cumsum(found) - found), found) + np.arange(found.sum())] if found.any() else np.empty(0, np.int64)
    length, grow = test.need[which], np.arange(len(which))
    while len(grow):
        i, p = test.start[which[grow]] + length[grow], place[grow] + length[grow]
        ok = (i < test.end[test.start[which[grow]]]) & (p < len(words))
        ok[ok] = test.words[i[ok]] == words[p[ok]]
        grow = grow[ok]
        length[grow] += 1
    return which, place, length


def _merged(start: np.ndarray, size: np.ndarray) -> list[dict]:
    out: list[list[int]] = []
    for s, e in sorted(zip(start.tolist(), (start + size).tolist(), strict=True)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


def match_texts(test: TestSet, texts: pa.Array) -> tuple[np.ndarray, list, list, np.ndarray]:
    """Of each text: words, spans of words inside windows, items with such windows, longest verbatim match."""
    n_words, spans, items, longest = [np.empty(0, np.int64)], [], [], [np.empty(0, np.int64)]
    least, depth = (int(test.need.min()), int(np.bincount(test.item).max())) if len(test.start) else (1, 0)
    for a, z, data, off in chunks(texts, SHARD_BYTES):
        w = Words(LOWER[data], off, LETTERS)
        n_words.append(w.count)
        best, rows = np.zeros(z - a, np.int64), {}
        if len(test.start) and len(w.start):
            hashes = w.hashes()
            known = np.minimum(np.searchsorted(test.vocabulary, hashes), len(test.vocabulary) - 1)
            ids = np.zeros(len(hashes) + z - a, np.int64)  # a 0 after each text
            to = np.arange(len(hashes)) + w.row
            ids[to] = np.where(test.vocabulary[known] == hashes, known + 1, 0)
            edge = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0])).astype(np.int8)))
            begin, size = edge[::2], edge[1::2] - edge[::2]
            begin, size = begin[size >= least], size[size >= least]
            at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            shard = np.zeros_like(ids)
            shard[at] = ids[at]
            which, place, length = search(test, shard, suffix_array(shard, at, depth)) if len(at) else (np.empty(0, np.int64),) * 3
            head = w.first[:-1] + np.arange(z - a)  # where texts begin among ids
            row = np.searchsorted(head, place, "right") - 1
            np.maximum.at(best, row, length)
            for r in np.unique(row).tolist():
                own = row == r if len(row) < 1000 else np.flatnonzero(row == r)
                rows[r] = (_merged(place[own] - head[r], test.need[which[own]]), sorted({test.ids[i] for i in test.item[test.start[which[own]]].tolist()}))
        longest.append(best)
        spans += [rows[r][0] if r in rows else [] for r in range(z - a)]
        items += [rows[r][1] if r in rows else [] for r in range(z - a)]
    return np.concatenate(n_words), spans, items, np.concatenate(longest)


def _union(x: list[dict], y: list[dict]) -> list[dict]:
    """Spans of two lists, those that touch or overlap made one."""
    out: list[dict] = []
    for span in sorted(x + y, key=lambda s: (s["start"], s["end"])):
        if out and span["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], span["end"])}
        else:
            out.append(span)
    return out


def test_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[TestSet]:
    """The test set in blocks, each read by itself; there is at least one."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text")).dropna()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 if total <= block_bytes else int(2 * total // block_bytes) + 1
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield test_set([tuple(r) for r in own.collect()], window)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of `docs`: id, n_words, `hits` (merged spans of words inside windows), `items` (sorted), `longest` match in words.

    Each block of test items goes over the same rows and adds to what earlier blocks found, so rows stay rows whatever their ids and however many blocks there are."""
    kind = docs.schema[id_col].dataType.simpleString()
    names, rows = [id_col, "_text", "n_words", "hits", "items", "longest"], docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    for k, test in enumerate(test_blocks(benchmark, window=window, block_bytes=block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(test)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, later=k > 0) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n_words, spans, items, longest = match_texts(shared.value, b.column(1))
                if later:
                    spans = [_union(x, y) for x, y in zip(b.column(3).to_pylist(), spans, strict=True)]
                    items = [sorted({*x, *y}) for x, y in zip(b.column(4).to_pylist(), items, strict=True)]
                    longest = np.maximum(longest, b.column(5).to_numpy())
                found = [pa.array(n_words), pa.array(spans, pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))), pa.array(items, pa.list_(pa.string())), pa.array(longest)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *found], names)

        rows = rows.mapInArrow(run, f"`{id_col}` {kind}, _text string, {MATCH_SCHEMA}")
    return rows.drop("_text")


def hit_words(hits: str = "hits"):
    """Words inside any of the spans, overlaps counted once."""
    ends = F.aggregate(
        F.array_sort(hits),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(s["start"], acc["upto"]))).alias("n"), F.greatest(acc["upto"], s["end"]).alias("upto")),
    )
    return ends["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of `docs` without any window of a test item, all columns as they are. Each block of test items is one more filter over the rows."""
    at = docs.columns.index(text_col)
    for test in test_blocks(benchmark, window=window, block_bytes=block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(test)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not items for items in match_texts(shared.value, b.column(at))[2]], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
