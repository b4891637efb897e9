"""Substring dedup by repeated-phrase automata: words inside passages that also start earlier in the corpus go.

A passage is a window of `WINDOW` consecutive words. Its anchor is the smallest hash among its phrases of `PHRASE` words, so equal windows have equal anchors, and the
windows of a text fall into runs of neighbours with one anchor, each run a piece of the text.
1. Anchors are counted over all documents. One that occurs once can't belong to a repeated window; the others are joined back to their documents.
2. Documents are streamed and cut: pieces whose anchor recurs go to the shard of the anchor, equal pieces only once with their first place. A
   piece of an anchor above `HOT` is cut into its single windows, which are dealt by their own hash, so no shard gets a crowd.
3. Each shard confirms which windows recur, compiles them into Aho-Corasick automata (at most `AUTOMATON` pieces each) over word numbers, and streams its
   pieces through them: every occurrence is located word by word, and the earliest one (smaller id, or earlier start) is known for each window.
4. Pieces take that back to all their places; a window whose earliest place is another one covers words that go. All windows are judged on the input.

Words: runs of anything but \\x20 and \\x09-\\x0D, unchanged. Null and empty texts have none. Rows that repeat an id with the same text are one document
and each get its row; rows with a null id take no part and keep all words. Anchors and piece names are hashes that only route; what is removed is decided by the
words themselves and, for equal pieces, by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import Words, chunks, grams, mixed, sliding_min

WINDOW, PHRASE = 20, 6
HOT, AUTOMATON = 20_000, 5_000


def _runs(w: Words, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, number of windows, anchor) of the runs of windows with one anchor."""
    hashes = w.hashes()
    size = len(hashes) - window + 1
    if size <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    anchor = sliding_min(grams(hashes, phrase), window - phrase + 1)
    at = np.flatnonzero(w.left[:size] >= window)
    row, anchor = w.row[at], anchor[at]
    begin = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))[: len(at)])
    return row[begin], at[begin], np.diff(np.append(begin, len(at))), anchor[begin]


def _occurrences(w: Words, window: int, phrase: int) -> np.ndarray:
    """The anchor at every place where it is the smallest phrase of a window; a text that repeats itself has one anchor at several places."""
    hashes = w.hashes()
    size = len(hashes) - window + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    found, width = grams(hashes, phrase), window - phrase + 1
    smallest = np.where(w.left[:size] >= window, sliding_min(found, width), np.uint64(0))
    edge = np.zeros(width - 1, np.uint64)
    largest = ~sliding_min(~np.concatenate((edge, smallest, edge)), width)
    return found[largest == found]


def _anchors(docs: DataFrame, window: int, phrase: int, by_doc: bool) -> DataFrame:
    """(anchor, n) with the places of a chunk counted, or the distinct (anchor, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.array(b.column(0).to_pylist(), np.int64)
            for a, _, data, off in chunks(b.column(1)):
                w = Words(data, off)
                if by_doc:
                    row, _, _, anchor = _runs(w, window, phrase)
                    order = np.lexsort((anchor, row))
                    row, anchor = row[order], anchor[order]
                    once = np.append(True, (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]))[: len(row)]
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[once].view(np.int64)), pa.array(ids[a + row[once]])], ["anchor", "id"])
                else:
                    values, n = np.unique(_occurrences(w, window, phrase), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["anchor", "n"])

    return docs.mapInArrow(run, "anchor bigint, id bigint" if by_doc else "anchor bigint, n bigint")


def _cut(w: Words, ids: list[int], wanted: list[list[int]], crowded: list[list[int]], window: int, phrase: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Pieces of a chunk whose anchor recurs: their columns, and the first and last word of each."""
    row, start, n, anchor = _runs(w, window, phrase)
    signed = anchor.view(np.int64)
    mark, hot = np.zeros(len(row), bool), np.zeros(len(row), bool)
    cut = np.searchsorted(row, np.arange(len(ids) + 1))
    for i in range(len(ids)):
        own = slice(cut[i], cut[i + 1])
        mark[own] = np.isin(signed[own], np.array(wanted[i], np.int64))
        if crowded[i]:
            hot[own] = np.isin(signed[own], np.array(crowded[i], np.int64))
    row, start, n, signed, hot = row[mark], start[mark], n[mark], signed[mark], hot[mark]
    times = np.where(hot, n, 1)  # a piece of a crowded anchor becomes single windows
    inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    row, start, n, signed, hot = np.repeat(row, times), np.repeat(start, times) + inner, np.repeat(np.where(hot, 1, n), times), np.repeat(signed, times), np.repeat(hot, times)
    size = n + window - 1
    heads = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(heads, size)
    flat = w.hashes()[np.repeat(start, size) + place]
    name = [np.add.reduceat(mixed(flat + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(salt)), heads).view(np.int64) if len(heads) else heads for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
    columns = {"key": np.where(hot, name[0], signed), "p1": name[0], "p2": name[1], "id": np.array(ids, np.int64)[row], "start": start - w.first[row]}
    return columns, start, start + size - 1


def _distinct(columns: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The earliest place of each piece, and how often it is there."""
    order = np.lexsort((columns["start"], columns["id"], columns["p2"], columns["p1"]))
    p1, p2 = columns["p1"][order], columns["p2"][order]
    begin = np.flatnonzero(np.append(True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]))[: len(order)])
    times = columns["times"][order] if "times" in columns else np.ones(len(order), np.int64)
    return order[begin], np.add.reduceat(times, begin) if len(begin) else begin


def _pieces(rows: DataFrame, window: int, phrase: int) -> DataFrame:
    """Every piece of (id, text, anchors, hot) and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, wanted, crowded = (b.column(i).to_pylist() for i in (0, 2, 3))
            for a, z, data, off in chunks(b.column(1)):
                columns, _, _ = _cut(Words(data, off), ids[a:z], wanted[a:z], crowded[a:z], window, phrase)
                names = ["p1", "p2", "id", "start"]
                yield pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in names], names)

    return rows.mapInArrow(run, "p1 bigint, p2 bigint, id bigint, start bigint")


def _streams(rows: DataFrame, window: int, phrase: int) -> DataFrame:
    """The words of every piece, once for each batch that has it, with its first place there."""
    names = ["key", "p1", "p2", "id", "start", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, wanted, crowded = (b.column(i).to_pylist() for i in (0, 2, 3))
            parts: list[dict[str, np.ndarray]] = []
            texts: list[str] = []
            for a, z, data, off in chunks(b.column(1)):
                w = Words(data, off)
                columns, head, tail = _cut(w, ids[a:z], wanted[a:z], crowded[a:z], window, phrase)
                first, times = _distinct(columns)
                parts.append({c: x[first] for c, x in columns.items()} | {"times": times})
                body = data.tobytes()
                texts += [body[s:e].decode() for s, e in zip(w.start[head[first]].tolist(), w.end[tail[first]].tolist(), strict=True)]
            if parts:
                columns = {c: np.concatenate([p[c] for p in parts]) for c in names}
                first, times = _distinct(columns)
                columns = {c: x[first] for c, x in columns.items()} | {"times": times}
                yield pa.RecordBatch.from_arrays([*(pa.array(columns[c]) for c in names), pa.array([texts[i] for i in first.tolist()], pa.string())], [*names, "words"])

    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in names) + ", words string")


def earliest(pieces: list[tuple[int, int, list[bytes]]], window: int) -> list[list[tuple[int, int]]]:
    """For each window of each piece (id, start, words) the first place among all pieces where its words occur.

    The windows are confirmed by counting; an automaton of those that recur then locates every occurrence."""
    number: dict[bytes, int] = {}
    coded = [tuple(number.setdefault(w, len(number)) for w in words) for _, _, words in pieces]
    count: dict[tuple[int, ...], int] = {}
    for c in coded:
        for i in range(len(c) - window + 1):
            count[c[i : i + window]] = count.get(c[i : i + window], 0) + 1
    out = [[(id_, start + i) for i in range(len(c) - window + 1)] for (id_, start, _), c in zip(pieces, coded, strict=True)]
    recurring = [k for k, n in count.items() if n > 1]
    if not recurring:
        return out
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for k, passage in enumerate(recurring):
        automaton.add_word(passage, k)
    automaton.make_automaton()
    found = [[(end - window + 1, k) for end, k in automaton.iter(c)] for c in coded]
    first: list[tuple[int, int] | None] = [None] * len(recurring)
    for (id_, start, _), hits in zip(pieces, found, strict=True):
        for i, k in hits:
            if first[k] is None or (id_, start + i) < first[k]:
                first[k] = (id_, start + i)
    for p, hits in enumerate(found):
        for i, k in hits:
            out[p][i] = first[k]
    return out


def _located(streams: DataFrame, window: int) -> DataFrame:
    """(p1, p2, lo, hi, first_id, first_start): windows lo to hi (exclusive) of a piece first occur from that place on. Pieces that occur once and have no
    window from elsewhere are left out."""

    def shard(rows: list[tuple]) -> Iterator[tuple]:
        merged: dict[tuple[int, int], list] = {}
        for p1, p2, id_, start, times, words in rows:
            have = merged.get((p1, p2))
            if have is None:
                merged[p1, p2] = [id_, start, times, words]
            else:
                have[:3] = [*min((have[0], have[1]), (id_, start)), have[2] + times]
        pieces = [(id_, start, words.encode().split()) for id_, start, _, words in merged.values()]
        for (name, (id_, start, times, _)), places in zip(merged.items(), earliest(pieces, window), strict=True):
            lo = 0
            for i in range(1, len(places) + 1):
                if i == len(places) or places[i] != (places[lo][0], places[lo][1] + i - lo):
                    if times > 1 or places[lo] != (id_, start + lo):
                        yield *name, lo, i, *places[lo]
                    lo = i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["p1", "p2", "lo", "hi", "first_id", "first_start"]
        held, last = [], None

        def out() -> pa.RecordBatch:
            found = list(zip(*shard(held), strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)

        for b in batches:
            for key, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != last and len(held) >= AUTOMATON:
                    yield out()
                    held = []
                last = key
                held.append(tuple(row))
        yield out()

    rows = streams.repartition("key").sortWithinPartitions("key").select("key", "p1", "p2", "id", "start", "times", "words")
    return rows.mapInArrow(run, "p1 bigint, p2 bigint, lo bigint, hi bigint, first_id bigint, first_start bigint")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """For each row of `docs`: id, n_words, n_removed, kept_text (the words that stay, joined by one blank)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    real = rows.where("id is not null and text is not null")
    anchors = _anchors(real, window, phrase, by_doc=False).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    anchors = _anchors(real, window, phrase, by_doc=True).join(anchors, "anchor")
    lists = anchors.groupBy("id").agg(F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("n") >= HOT, F.col("anchor"))).alias("hot"))
    cut = real.join(lists, "id").select("id", "text", "anchors", "hot")
    located = _located(_streams(cut, window, phrase), window)
    gone = (
        _pieces(cut, window, phrase)
        .join(located, ["p1", "p2"])
        .where("first_id <> id or first_start <> start + lo")
        .groupBy("id")
        .agg(F.collect_list(F.struct((F.col("start") + F.col("lo")).alias("s"), (F.col("start") + F.col("hi") + F.lit(window - 1)).alias("e"))).alias("spans"))
        .withColumnRenamed("id", "_of")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int32)
                for span in spans or ():
                    gone[min(span["s"], len(words))] += 1
                    gone[min(span["e"], len(words))] -= 1
                stays = np.cumsum(gone[:-1]) == 0
                n_words.append(len(words))
                n_removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join(words if not spans else compress(words, stays.tolist())).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], [id_col, "n_words", "n_removed", "kept_text"])

    schema = f"`{id_col}` bigint, n_words bigint, n_removed bigint, kept_text string"
    # the same rows by the same key as in `cut`, so that Spark shuffles the texts once; null ids and texts have no part in it
    known = real.join(gone, F.col("id") == F.col("_of"), "left").select("id", "text", "spans").mapInArrow(run, schema)
    others = rows.where("id is null or text is null").withColumn("spans", F.lit(None).cast("array<struct<s:bigint,e:bigint>>"))
    return known.unionByName(others.mapInArrow(run, schema))
