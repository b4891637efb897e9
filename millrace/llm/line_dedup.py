"""Fuzzy line dedup: of each group of equal or nearly equal lines in all documents, the first occurrence stays.

A line (cut at \\n) is normalised to its words: A-Z lower-cased, runs of letters, digits and non-ASCII. Lines without a word always stay. Two lines link if at least `PERCENT` of the longer
line's words stay when the one is edited into the other (insert, delete, replace). No pair of lines that link is missed, at any length.

SimHash and pigeonhole blocks, the usual way, can't find such pairs: with a fifth of the words replaced 12 to 13 of 64 bits differ on average whatever the line's length, and with one word of ten 8 do, so blocks
that are intact in most pairs are too short to tell lines apart (measured recall in the README). Instead, lines meet under rare words:
1. One pass gives every line a 128-bit hash of its word sequence and counts words in a table of counters. Lines with equal hashes are one node.
2. An edit changes two pairs of neighbouring words at most, so linked lines share one of their first pairs (about 2 / 5 of them, see `_taken`) in a common order, rare words
   first. Only these are keys (single words where `percent` is 75 or less). They are shuffled in packed columns with the line's length, dealt to buckets by hash, and kept if another line under the key
   is about as long. Then the parities of a line's words (of how many fall on each of 256 places) are joined to them, and a line stays under a key if another one is there whose length and
   parities allow so few edits (an edit changes two parities at most). Keys with more than `CROWD` lines are kept as they are.
3. For the nodes that are left words are fetched, pairs made and verified by their edit distance (see `_linked`; a crowded key is split by the other first words). A pair inside a group that is known already is not made.
4. Of every connected group the occurrence with the smallest (id, line) stays, the others go.

Null and empty texts have no lines. Rows with a null id take no part and keep all their lines. Rows that repeat an id with the same text lose the same lines; with another text they are documents of
their own, in the order of a hash of their texts. Nodes are named by half of the hash, so a fuzzy link could reach a wrong line with a chance of 2^-64 for each pair; equality always takes all
128 bits. Other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.linking import _pairs_left, _split, components
from millrace.llm.ngram_join import PART, SLOTS, _counters
from millrace.llm.shared import discard, identified, light, written
from millrace.llm.words import LETTERS, LOWER, Words, chunks, mixed

PERCENT = 80
#: Lines of a key whose lengths and parities are compared at once; buckets of a shuffle partition; rows that a task packs, or holds before it drops repeated ones.
CROWD, BUCKETS, PACK = 2_048, 4, 1 << 18
#: Lines of a key that others are held against first, and under how many of its keys a line gets one of them; rounds of likeliest partners after that, as long as one pair in `FEW` links.
LEADS, LED, ROUNDS, FEW = 32, 4, 4, 16
#: Columns with the parities of a line's words, 64 places each.
PARITIES = ("p1", "p2", "p3", "p4")
_LINE = [("line", "int"), ("h1", "bigint"), ("h2", "bigint"), ("size", "int"), *((p, "bigint") for p in PARITIES)]
_LINES = f"array<struct<{','.join(f'{n}:{t}' for n, t in _LINE)}>>"
H1, H2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _chunk_lines(data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and of each line with a word: its row, its number in the text, its first word and the word after its last."""
    w = Words(LOWER[data], off, LETTERS)
    cuts = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, off)))
    start, end = cuts[:-1], cuts[1:]
    a, z = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    row = np.searchsorted(off, start, "right") - 1
    breaks = np.concatenate(([0], np.cumsum(data == 10)))
    number = breaks[start] - breaks[off[row]]
    full = z > a
    return w, row[full], number[full], a[full], z[full]


def _ones(hashes: np.ndarray, a: np.ndarray, z: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the word sequence of each line; no line is empty."""
    if not len(a):
        return np.empty(0, np.int64)
    place = np.arange(len(hashes)) - np.repeat(a, z - a)
    return np.add.reduceat(mixed(hashes + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(salt)), a).view(np.int64)


def _parities(hashes: np.ndarray, a: np.ndarray) -> list[np.ndarray]:
    """Of how many words of each line, modulo 2, fall on each place; 64 places to a number."""
    if not len(a):
        return [np.empty(0, np.int64) for _ in PARITIES]
    part, bit = (hashes >> np.uint64(40)) % np.uint64(len(PARITIES)), np.uint64(1) << ((hashes >> np.uint64(48)) & np.uint64(63))
    return [np.bitwise_xor.reduceat(np.where(part == k, bit, np.uint64(0)), a).view(np.int64) for k in range(len(PARITIES))]


def _hashed(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: (id, row, lines) of documents (id, row, text), and (part, counts) of the word counters of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(SLOTS, np.int64)
        for b in batches:
            for x, y, data, off in chunks(b.column(2)):
                w, row, number, a, z = _chunk_lines(data, off)
                hashes = w.hashes()
                counters += np.bincount((hashes & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
                columns = (number.astype(np.int32), _ones(hashes, a, z, H1), _ones(hashes, a, z, H2), (z - a).astype(np.int32), *_parities(hashes, a))
                body = pa.StructArray.from_arrays([pa.array(v) for v in columns], [n for n, _ in _LINE])
                upto = np.searchsorted(row, np.arange(y - x + 1)).astype(np.int32)
                none = [None] * (y - x)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), b.column(1).slice(x, y - x), pa.ListArray.from_arrays(pa.array(upto), body), pa.array(none, pa.int32()), pa.array(none, pa.binary())], names)
        full = [k for k in range(SLOTS // PART) if counters[k * PART : (k + 1) * PART].any()]
        none = [None] * len(full)
        body = [counters[k * PART : (k + 1) * PART].astype(np.uint32).tobytes() for k in full]
        yield pa.RecordBatch.from_arrays([pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, lines), pa.array(full, pa.int32()), pa.array(body, pa.binary())], names)

    names = ["id", "row", "lines", "part", "counts"]
    lines = pa.list_(pa.struct([(n, pa.int32() if t == "int" else pa.int64()) for n, t in _LINE]))
    return docs.mapInArrow(run, f"id bigint, row bigint, lines {_LINES}, part int, counts binary")


def _edits(most, percent: int):
    """Edits that two lines may be apart, the longer one of `most` words."""
    return most * (100 - percent) // 100


def _width(percent: int) -> int:
    """Neighbouring words to a key: two, unless so many edits are allowed that lines that link need not share two pairs of words."""
    return 2 if percent > 75 else 1


def _taken(size: int, percent: int, width: int = 1) -> int:
    """How many runs of `width` words of a line, in order, are keys; 0 if it can link to equal lines only.

    An edit changes `width` runs at most, so lines that link have all but `width` times the edits of the longer one's runs in common."""
    edits = ((m, _edits(m, percent)) for m in range(size, size * 100 // percent + 1))
    return max((size - m + 1 + width * e for m, e in edits if m - size <= e > 0), default=0)


def _first_runs(hashes: np.ndarray, a: np.ndarray, z: np.ndarray, take: np.ndarray, table: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the first `take` runs of `width` words of each line, those of rare words first; a run's second occurrence in a line is another run."""
    size = np.maximum(z - a - width + 1, 0)
    line = np.repeat(np.arange(len(a)), size)
    begins = np.concatenate(([0], np.cumsum(size)[:-1])) if len(a) else size
    at = np.arange(len(line)) - begins[line] + a[line]
    common = table[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)]
    own, rank = hashes[at], common[at]
    for i in range(1, width):
        own, rank = mixed(own * np.uint64(H1) + hashes[at + i]), rank + common[at + i]
    rank = rank << np.uint64(54) | own >> np.uint64(10)
    # lines are few and rank is 64 bits, so sort by rank first, then, stably, by line
    by_rank = np.argsort(rank)
    order = by_rank[np.argsort(line[by_rank].astype(np.uint16 if len(a) <= 1 << 16 else np.int64), kind="stable")]
    own, i = own[order], np.arange(len(line))
    same = np.concatenate(([False], (own[1:] == own[:-1]) & (line[1:] == line[:-1])))[: len(line)]
    again = i - np.maximum.accumulate(np.where(same, 0, i)) if len(line) else i
    first = i - begins[line] < take[line]
    return line[first], mixed(own + again.astype(np.uint64) * np.uint64(H2))[first]


def _commonness(counters: np.ndarray) -> np.ndarray:
    """Sixteenths of the binary logarithm of each counter, so that the sum of two needs 10 bits."""
    return np.round(16 * np.log2(1 + np.minimum(counters, (1 << 20) - 1))).astype(np.uint64)


def _take(sizes: np.ndarray, percent: int, more: int = 0) -> np.ndarray:
    """How many keys a line of each size has, and so many `more` where there are any."""
    sizes, which = np.unique(sizes, return_inverse=True)
    keys = np.array([_taken(int(n), percent, _width(percent)) for n in sizes], np.int64)
    return np.where(keys > 0, keys + more, 0)[which]


def _packed(docs: DataFrame, shared, buckets: int, percent: int) -> DataFrame:
    """(bucket, keys, nodes, sizes): packed columns of the first runs of words of lines. A line that comes again in the same chunk has no more rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, rows = shared.value, [], 0
        for b in batches:
            known = np.flatnonzero(b.column(0).is_valid().to_numpy(zero_copy_only=False))
            for x, _, data, off in chunks(b.column(2)):
                w, row, _, a, z = _chunk_lines(data, off)
                if not len(a):
                    continue
                hashes = w.hashes()
                node, take = _ones(hashes, a, z, H1), _take(z - a, percent)
                usable = np.flatnonzero(np.isin(row + x, known) & (take > 0))
                once = usable[np.unique(node[usable], return_index=True)[1]]
                line, key = _first_runs(hashes, a[once], z[once], take[once], table, _width(percent))
                # lines of 65,535 words and more count as that long, which only lets more of them through
                held.append((key, node[once][line], np.minimum((z - a)[once][line], 65_535).astype(np.uint16)))
                rows += len(key)
                if rows >= PACK:
                    yield pack(held)
                    held, rows = [], 0
        if rows:
            yield pack(held)

    def pack(held: list) -> pa.RecordBatch:
        key, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        which, first = np.unique(bucket[order], return_index=True)
        cuts = np.append(first, len(key))
        # the upper half of a key will do inside a bucket: two that agree by chance are told apart when their lines are compared
        columns = [(key >> np.uint64(32)).astype(np.uint32), *columns]
        blobs = [pa.array([c[a:z].tobytes() for a, z in zip(cuts, cuts[1:], strict=False)], pa.binary()) for c in (v[order] for v in columns)]
        return pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), *blobs], ["bucket", "keys", "nodes", "sizes"])

    return docs.mapInArrow(run, "bucket int, keys binary, nodes binary, sizes binary")


_KINDS = (np.uint32, np.int64, np.uint16)


def _runs(key: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, in sorted ones."""
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])


def _shared(packed: DataFrame, percent: int) -> DataFrame:
    """(key, node) of lines under whose key another line's length allows so few edits."""

    def sifted(key: np.ndarray, node: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """In the order of keys and sizes, each node of a key once."""
        order = np.lexsort((node, size, key))
        key, node = key[order], node[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))[: len(key)]
        return key[new], node[new], size[order[new]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows, limit = 0, 8 * PACK
        for b in batches:
            for bucket, *blobs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key, *columns = (np.frombuffer(v, t) for v, t in zip(blobs, _KINDS, strict=True))
                held.append((key.astype(np.uint64) | np.uint64(bucket << 32), *columns))
                rows += len(key)
            if rows > limit:  # a line of many documents comes again and again
                held = [sifted(*(np.concatenate(c) for c in zip(*held, strict=True)))]
                rows = len(held[0][0])
                limit = max(limit, 2 * rows)
        if not held:
            return
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        held.clear()
        # most keys come once
        order = np.argsort(columns[0])
        first = _runs(columns[0][order])
        number = np.diff(np.append(first, len(order)))
        order = order[np.repeat(number > 1, number)]
        key, node, size = sifted(*(c[order] for c in columns))
        size = size.astype(np.int64)
        # of the lines under a key the next longer one is the likeliest partner, or the next shorter one
        near = (key[1:] == key[:-1]) & (size[1:] - size[:-1] <= _edits(size[1:], percent))
        kept = np.flatnonzero(np.append(near, False) | np.append(False, near)) if len(key) else np.empty(0, np.int64)
        for a in range(0, len(kept), 10_000):
            i = kept[a : a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(key[i].view(np.int64)), pa.array(node[i])], ["key", "node"])

    return packed.mapInArrow(run, "key bigint, node bigint")


def with_partner(sizes: np.ndarray, parities: Sequence[np.ndarray], percent: int, asked: np.ndarray | slice = slice(None)) -> np.ndarray:
    """For rows of lines that share a key, whether lengths and parities of another one of the row allow few enough edits; only for the columns `asked`, if given."""
    x, y = sizes[:, asked, None].astype(np.int64), sizes[:, None, :].astype(np.int64)
    apart = np.abs(x - y)
    edits = _edits(np.maximum(x, y), percent)
    changed = sum(np.bitwise_count(p[:, asked, None] ^ p[:, None, :]).astype(np.int64) for p in parities)
    fits = (apart <= edits) & (changed <= 2 * edits - apart)
    itself = np.arange(sizes.shape[1])[asked]
    fits[:, np.arange(len(itself)), itself] = False
    return fits.any(2)


def _spare(x, y, size: np.ndarray, parities: Sequence[np.ndarray], percent: int) -> np.ndarray:
    """How many more parities lines `x` and `y` could differ in and yet be near enough; below 0 for lines that can't be linked."""
    xs, ys = size[x], size[y]
    apart = np.abs(xs - ys)
    edits = _edits(np.maximum(xs, ys), percent)
    changed = sum(np.bitwise_count(p[x] ^ p[y]).astype(np.int32) for p in parities)
    return np.where(apart <= edits, 2 * edits - apart - changed, -1)


def _blocks(number: np.ndarray, first: np.ndarray, against: int) -> Iterator[tuple[np.ndarray, slice]]:
    """Places of runs of equal length, a row to a run, and which of its columns to take now: about `PACK` pairs at once when each is held against `against` others of the run at most."""
    for n in np.unique(number[number > 1]).tolist():
        begins, wide = first[number == n], min(n, against)
        step, columns = max(1, PACK // (n * wide)), max(1, PACK // wide)
        for k in range(0, len(begins), step):
            at = begins[k : k + step, None] + np.arange(n)
            for c in range(0, n, columns):
                yield at, slice(c, c + columns)


def _held(batches: Iterator[pa.RecordBatch]) -> tuple | None:
    """Columns of rows (key, node, size, parities) and maybe label."""
    held = list(batches)
    if not held:
        return None
    key, node, size, *rest = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
    # bits of a negative number are those of its absolute value
    return key, node, size.astype(np.int32), [p.view(np.uint64) for p in rest[: len(PARITIES)]], *rest[len(PARITIES) :]


def _close(rows: DataFrame, percent: int) -> DataFrame:
    """(key, node, lead) of those `rows` (key, node, size, parities), all of a key in one partition, that may link to another one under the key.

    Keys with more than `CROWD` lines are kept as they are. `lead`, under about `LED` keys of a line: the first line of the key, in an order that all keys share, that it may link to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _held(batches)
        if held is None:
            return
        key, node, size, parities = held
        order = np.lexsort((mixed(node.view(np.uint64)), key))
        key, node, size, parities = key[order], node[order], size[order], [p[order] for p in parities]
        first = _runs(key)
        number = np.diff(np.append(first, len(key)))
        keep, lead = np.repeat(number > CROWD, number), np.full(len(key), -1)
        for at, now in _blocks(number, first, LEADS):
            x, y = at[:, now, None], at[:, None, :LEADS]
            fit = (_spare(x, y, size, parities, percent) >= 0) & (x != y)
            keep[at[:, now]] |= fit.any(2)
            best = np.take_along_axis(at[:, :LEADS], fit.argmax(2), 1)
            lead[at[:, now]] = np.where(fit.any(2) & (best < at[:, now]), best, -1)
        for a, n in zip(first[number > LEADS].tolist(), number[number > LEADS].tolist(), strict=True):
            left = np.flatnonzero(~keep[a : a + n])
            step = max(1, PACK // n)
            for k in range(0, len(left), step):
                asked = left[k : k + step]
                keep[a + asked] = with_partner(size[None, a : a + n], [p[None, a : a + n] for p in parities], percent, asked)[0]
        led = (mixed(key.view(np.uint64)) >> np.uint64(11)) * 2.0**-53 * _take(size, percent) < LED
        kept = np.flatnonzero(keep)
        for a in range(0, len(kept), 10_000):
            i = kept[a : a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(key[i]), pa.array(node[i]), pa.array(node[lead[i]], mask=(lead[i] < 0) | ~led[i])], ["key", "node", "lead"])

    return rows.mapInArrow(run, "key bigint, node bigint, lead bigint")


def _apart(rows: DataFrame, percent: int) -> DataFrame:
    """(key, node, other) of those `rows` (key, node, size, parities, label), all of a key in one partition, that may link to one of another label under the key.

    `other`: the likeliest one. Rows of a key's largest label may do without it, as the others of the key have theirs; so may rows of a key that has more than `CROWD` of other labels, which are kept as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _held(batches)
        if held is None:
            return
        key, node, size, parities, label = held
        order = np.lexsort((label, key))
        first = _runs(key[order])
        number = np.diff(np.append(first, len(key)))
        order = order[np.repeat(label[order[first]] != label[order[first + number - 1]], number)]
        key, node, size, parities, label = key[order], node[order], size[order], [p[order] for p in parities], label[order]
        first = _runs(key)
        number = np.diff(np.append(first, len(key)))
        alive, other = np.zeros(len(key), bool), np.full(len(key), -1)
        few = number <= LEADS
        for at, _ in _blocks(number[few], first[few], LEADS):
            x, y = at[:, :, None], at[:, None, :]
            spare = np.where(label[x] != label[y], _spare(x, y, size, parities, percent), -1)
            best = spare.argmax(2)
            alive[at] = np.take_along_axis(spare, best[:, :, None], 2)[:, :, 0] >= 0
            other[at] = np.where(alive[at], np.take_along_axis(at, best, 1), -1)
        for a, n in zip(first[~few].tolist(), number[~few].tolist(), strict=True):
            of = label[a : a + n]
            begins = _runs(of)
            counts = np.diff(np.append(begins, n))
            largest = of[begins[counts.argmax()]]
            rest, every = a + np.flatnonzero(of != largest), np.arange(a, a + n)
            if len(rest) > CROWD:
                alive[every] = True
                every = every[np.argsort(mixed(node[every].view(np.uint64)))[:LEADS]]
            step = max(1, PACK // len(every))
            for k in range(0, len(rest), step):
                at = rest[k : k + step]
                x, y = at[:, None], every[None, :]
                spare = np.where(label[x] != label[y], _spare(x, y, size, parities, percent), -1)
                best = spare.argmax(1)
                fit = np.take_along_axis(spare, best[:, None], 1)[:, 0] >= 0
                alive[at] |= fit
                alive[every] |= (spare >= 0).any(0)
                other[at] = np.where(fit, every[best], -1)
        kept = np.flatnonzero(alive)
        for a in range(0, len(kept), 10_000):
            i = kept[a : a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(key[i]), pa.array(node[i]), pa.array(node[other[i]], mask=other[i] < 0)], ["key", "node", "other"])

    return rows.mapInArrow(run, "key bigint, node bigint, other bigint")


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of `rows` (key, node, size, parities, label), all of a key in one partition, that may link across labels. Of a key's largest label no pair is made, however large it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _held(batches)
        if held is None:
            return
        key, node, size, parities, label = held
        order = np.lexsort((label, key))
        key, node, size, parities, label = key[order], node[order], size[order], [p[order] for p in parities], label[order]
        first = _runs(key)
        number = np.diff(np.append(first, len(key)))
        found, ready = [], 0
        for a, n in zip(first[number > 1].tolist(), number[number > 1].tolist(), strict=True):
            of = label[a : a + n]
            begins = _runs(of)
            counts = np.diff(np.append(begins, n))
            largest = of[begins[counts.argmax()]]
            rest, every = a + np.flatnonzero(of != largest), np.arange(a, a + n)
            step = max(1, PACK // n)
            for k in range(0, len(rest), step):
                x, y = rest[k : k + step, None], every[None, :]
                # of two rows outside the largest label the first one makes the pair
                i, j = np.nonzero((label[x] != label[y]) & ((label[y] == largest) | (x < y)) & (_spare(x, y, size, parities, percent) >= 0))
                x, y = node[rest[k + i]], node[every[j]]
                found.append(np.stack((np.minimum(x, y), np.maximum(x, y)), 1))
                ready += len(x)
            if ready > 4 * PACK:
                found = [np.unique(np.concatenate(found), axis=0)]
                ready = len(found[0]) // 2
        out = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
        for k in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out[k : k + 10_000].T], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _linked(close: DataFrame, about: DataFrame, texts: DataFrame, marks: DataFrame, percent: int, partitions: int) -> DataFrame:
    """(node, component) of the nodes that have a link, from `close` (key, node, lead), `about` (node, size, parities) and what `_texts` and `_marks` give.

    First every line is held against its lead. From then on only rows of keys under which lines of different components may link are left, and they get fewer with every round: each is
    held against its likeliest partner, as long as one such pair in `FEW` links. At last all pairs that are left are verified, so the components are those that all pairs would give."""
    verify = _verifier(texts, percent)

    def verified(pairs: DataFrame) -> tuple[DataFrame, int]:
        """The pairs that are linked, and how many were tried."""
        pairs = written(pairs)
        new, tried = written(verify(pairs)), pairs.count()
        discard(pairs)
        return new, tried

    def rows_of(rows: DataFrame, groups: DataFrame) -> DataFrame:
        of = about.join(groups, "node", "left").select("node", "size", *PARITIES, F.coalesce("component", "node").alias("label"))
        return rows.join(of.hint("shuffle_hash"), "node").select("key", "node", "size", *PARITIES, "label").repartition(partitions, "key")

    def best(rows: DataFrame, other: str) -> DataFrame:
        shared = rows.where(F.col(other).isNotNull()).groupBy("node", other).agg(F.count("*").alias("n"))
        return shared.groupBy("node").agg(F.max(F.struct("n", other)).alias("best")).select(F.least("node", f"best.{other}").alias("a"), F.greatest("node", f"best.{other}").alias("b")).distinct()

    found, _ = verified(best(close, "lead"))
    groups = components(found)
    left = written(_apart(rows_of(close.select("key", "node"), groups), percent))
    for _ in range(ROUNDS):
        new, tried = verified(best(left, "other"))
        links = new.count()
        if links:
            groups = components(new.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))
            # labels only ever grow together, so a row that has no partner of another label never has one again
            after = written(_apart(rows_of(left.select("key", "node"), groups), percent))
            discard(left)
            left = after
        if FEW * links <= tried:
            break
    rows = written(left.select("key", "node").join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label")))
    keys = written(_pairs_left(rows, CROWD))
    pairs = _across(rows_of(rows.join(keys.where("not crowded"), "key", "left_semi").select("key", "node"), groups), percent)
    crowd = rows.join(keys.where("crowded"), "key", "left_semi")
    if not keys.where("crowded").isEmpty():
        pairs = pairs.unionByName(_across(rows_of(_split(crowd, marks, []).select("key", "node"), groups), percent))
    new, _ = verified(pairs.distinct())
    for table in (left, rows, keys, found):
        discard(table)
    return groups if new.isEmpty() else components(new.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def edit_distance(x: list, y: list) -> int:
    """Levenshtein distance of two sequences, all of a column at once in the bits of a number."""
    where: dict = {}
    for i, w in enumerate(x):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << len(x)) - 1, 1 << max(len(x) - 1, 0)
    plus, minus, distance = full, 0, len(x)
    if not x:
        return len(y)
    for w in y:
        eq = where.get(w, 0)
        d = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = (minus | ~(d | plus)) & full, plus & d
        distance += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = (down | ~(d | up)) & full, up & d
    return distance


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, words) of the `wanted` (node, row, line) from documents (id, row, text)."""
    lists = written(wanted.groupBy("row").agg(F.collect_list("line").alias("at"), F.collect_list("node").alias("nodes")))
    rows = docs.dropna().join(light(lists, 1 + 2 * F.size("at")), "row").select("text", "at", "nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, words = [], []
            for text, at, named in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lines = text.split("\n")
                for k, node in zip(at, named, strict=True):
                    data = np.frombuffer(lines[k].encode(), np.uint8)
                    w = Words(LOWER[data], np.array([0, len(data)]), LETTERS)
                    nodes.append(node)
                    words.append(b" ".join(w.texts(0, len(w.start))).decode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(words, pa.string())], ["node", "words"])

    return rows.mapInArrow(run, "node bigint, words string").dropDuplicates(["node"])


def _marks(texts: DataFrame, shared, buckets: int, percent: int) -> DataFrame:
    """(node, mark): one first run of words more than the keys, named like those. Linked lines that share a key share another one of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, data, off in chunks(b.column(1)):
                w = Words(data, off, LETTERS)
                line, key = _first_runs(w.hashes(), w.first[:-1], w.first[1:], _take(w.count, percent, 1), shared.value, _width(percent))
                named = (key % np.uint64(buckets)) << np.uint64(32) | key >> np.uint64(32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x).take(pa.array(line)), pa.array(named.view(np.int64))], ["node", "mark"])

    return texts.mapInArrow(run, "node bigint, mark bigint")


def _verifier(texts: DataFrame, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = x.split(" "), y.split(" ")
                most = max(len(x), len(y))
                keep.append(100 * (most - abs(len(x) - len(y))) >= percent * most and 100 * (most - edit_distance(x, y)) >= percent * most)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("words").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")

    return verify


def _removed(docs: DataFrame, percent: int) -> DataFrame:
    """(id, row, n_lines, removed_lines) of documents (id, row, text); removed_lines may be null."""
    spark = docs.sparkSession
    first = written(_hashed(docs))
    hashed = first.where("part is null").select("id", "row", "lines")
    counters = _counters(first.where("part is not null"))
    shared = spark.sparkContext.broadcast(_commonness(counters))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS * partitions
    met = written(_shared(_packed(docs, shared, buckets, percent).repartition(partitions, "bucket"), percent))

    lines = hashed.where("id is not null").select("id", "row", F.explode("lines").alias("l")).select("id", "row", "l.*")
    place = F.struct("id", "row", "line")
    nodes = met.select(F.col("node").alias("h1"), F.lit(True).alias("met")).distinct()
    kinds = lines.groupBy("h1", "h2").agg(F.min(F.struct("id", "row", "line", "size", *PARITIES)).alias("first"), F.count("*").alias("n")).join(nodes, "h1", "left")
    kinds = written(kinds.where("n > 1 or met"))
    sketches = kinds.where("met").select(F.col("h1").alias("node"), "first.size", *[f"first.{p}" for p in PARITIES]).dropDuplicates(["node"])
    close = written(_close(met.join(sketches.hint("shuffle_hash"), "node").select("key", "node", "size", *PARITIES).repartition(partitions, "key"), percent))
    discard(met)
    named = written(close.select("node").distinct())
    about = written(sketches.join(named, "node", "left_semi"))
    wanted = kinds.join(named.withColumnRenamed("node", "h1"), "h1").select(F.col("h1").alias("node"), "first.row", "first.line")
    texts = written(_texts(docs, wanted))
    groups = _linked(close, about, texts, _marks(texts, shared, buckets, percent), percent, partitions)
    shared.destroy()
    for table in (close, named, about, texts):
        discard(table)

    kinds = kinds.select("h1", "h2", "n", F.struct(*[F.col("first")[c].alias(c) for c in ("id", "row", "line")]).alias("first"))
    kinds = kinds.join(groups.withColumnRenamed("node", "h1"), "h1", "left").withColumn("component", F.coalesce("component", "h1"))
    in_groups = kinds.join(groups.select("component").distinct(), "component", "left_semi")
    firsts = in_groups.groupBy("component").agg(F.min("first").alias("stays"))
    often = kinds.where("n > 1").join(firsts, "component", "left_anti").select("h1", "h2", F.col("first").alias("stays"))
    often = often.unionByName(in_groups.join(firsts, "component").select("h1", "h2", "stays"))
    gone = lines.join(often, ["h1", "h2"]).where(place != F.col("stays")).groupBy("row").agg(F.array_sort(F.collect_set("line")).alias("removed_lines"))
    return hashed.select("id", "row", F.size("lines").cast("bigint").alias("n_lines")).join(gone, "row", "left")


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """For each row of `docs`: id, n_lines (with a word), n_removed, removed_lines (numbers from 0, in order)."""
    removed = _removed(identified(docs, id_col, text_col), percent)
    return removed.select(
        F.col("id").alias(id_col), "n_lines", F.coalesce(F.size("removed_lines"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, percent: int = PERCENT) -> DataFrame:
    """Rows of `docs` without the lines that go; `length_col`, if given, is set to the characters that are left. All rows stay, other columns as they are."""
    found = _removed(identified(docs, id_col, text_col), percent).where("removed_lines is not null").select("row", "removed_lines").dropDuplicates(["row"])
    found = light(written(found), 1 + F.size("removed_lines"))
    # the columns of the input in one struct, so that no name of theirs can clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own")).withColumn("row", F.xxhash64(F.col("own")[id_col].cast("bigint"), F.col("own")[text_col]))
    text, gone = F.col("own")[text_col], F.col("removed_lines")
    numbered = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.when(~F.array_contains(gone, i), x)), lambda x: x.isNotNull())
    joined = rows.join(found, "row", "left").withColumn("left", F.when(gone.isNull(), text).otherwise(F.array_join(numbered, "\n")))

    def column(name: str) -> Column:
        if name == text_col:
            return F.col("left").alias(name)
        own = F.col("own")[name]
        if name == length_col:
            return F.when(gone.isNull(), own).otherwise(F.length("left")).cast(docs.schema[name].dataType).alias(name)
        return own.alias(name)

    return joined.select(*[column(c) for c in docs.columns])
